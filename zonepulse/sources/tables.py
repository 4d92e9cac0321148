"""Driver tables and the incident-shaped views derived from them.

The views are written once as SQL expression lists so that the Spark plan
and the DuckDB oracle use literally the same expressions.  Reading goes
through ``spark.read.parquet`` so column pruning and filter pushdown reach
the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed view definitions (same text in Spark and DuckDB).
VIEWS: dict[str, tuple[str, list[str]]] = {
    # events as incidents: 150 zones, about 1 % null coordinates
    "outages": ("events", [
        "event_id AS record_id",
        "CAST(ts AS TIMESTAMP) AS datetime",
        "user_id AS zone_id",
        "event_type AS area",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(-6.5 AS DOUBLE) "
        "+ CAST((event_id*7919) % 1300 AS DOUBLE)/CAST(100 AS DOUBLE) END AS latitude",
        "CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(32 AS DOUBLE) "
        "+ CAST((event_id*104729) % 1200 AS DOUBLE)/CAST(100 AS DOUBLE) END AS longitude",
    ]),
    # orders as incidents: whole days over seven years, with time ties
    "orders_ev": ("orders", [
        "o_orderkey AS record_id",
        "CAST(o_orderdate AS TIMESTAMP) AS datetime",
        "o_custkey % 50 AS zone_id",
    ]),
    # five tight groups plus isolated points
    "hubs": ("events", [
        "event_id AS record_id",
        "CAST(user_id % 5 AS INT) AS hub",
        "event_id % 101 = 0 AS is_noise",
        "CASE WHEN event_id % 101 = 0 "
        "THEN CAST(10 AS DOUBLE) + CAST(CAST(FLOOR(event_id/101) AS BIGINT) % 100 AS DOUBLE)*CAST(0.05 AS DOUBLE) "
        "ELSE CAST(-1.3 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE) "
        "+ CAST((event_id*7919) % 1000 AS DOUBLE)/CAST(50000 AS DOUBLE) END AS latitude",
        "CASE WHEN event_id % 101 = 0 "
        "THEN CAST(45 AS DOUBLE) + FLOOR(CAST(FLOOR(event_id/101) AS BIGINT)/100)*CAST(0.05 AS DOUBLE) "
        "ELSE CAST(36.8 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE)*CAST(0.5 AS DOUBLE) "
        "+ CAST((event_id*104729) % 1000 AS DOUBLE)/CAST(50000 AS DOUBLE) END AS longitude",
    ]),
    # a scored binary classification with many score ties
    "scored": ("events", [
        "event_id AS record_id",
        "CASE WHEN event_type='error' THEN 1 ELSE 0 END AS label",
        "CAST((event_id*7919) % 90 + CASE WHEN event_type='error' AND event_id % 2 = 0 "
        "THEN 10 ELSE 0 END AS DOUBLE) / CAST(100 AS DOUBLE) AS p1",
    ]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # day numbers and calendar fields are defined on UTC instants
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the incident-shaped views as a Spark DataFrame."""
    base, exprs = VIEWS[name]
    df = read_table(spark, sf_dir, base).selectExpr(*exprs)
    if name == "scored":
        from pyspark.sql import functions as F
        df = df.withColumn("pred", (F.col("p1") > 0.5).cast("int"))
    return df


def view_sql(name: str) -> str:
    """The same view as a DuckDB ``SELECT`` (used inside oracle CTEs)."""
    base, exprs = VIEWS[name]
    sql = f"SELECT {', '.join(exprs)} FROM {base}"
    if name == "scored":
        sql = f"SELECT *, CAST(p1 > 0.5 AS INTEGER) AS pred FROM ({sql})"
    return sql


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views."""
    ctes = ",\n".join(f"{n} AS ({view_sql(n)})" for n in names)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
