"""Every registered query with an oracle, against DuckDB on the sf0.001 tables."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _keys():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


def _norm(v):
    import pandas as pd
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return v if math.isinf(v) else round(v, 6) + 0.0
    if isinstance(v, pd.Timestamp):
        return str(v)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v)) if hasattr(v, "hour") else str(v)
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from zonepulse.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date"}


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    sdf = E.queries()[key](spark, SF)
    rel = duck.sql(E.oracle_sql()[key])
    # same column types, not only the same values
    assert dict(sdf.dtypes) == {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    got = _canon(sdf.toPandas())
    exp = _canon(rel.df())
    assert got[0] == exp[0]
    assert len(got[1]) == len(exp[1])
    assert got[1] == exp[1]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 5
