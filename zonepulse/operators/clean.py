"""Projections and filters (inventory rows 7-15).

One chained select/filter: Catalyst folds it into a single stage and
pushes the coordinate predicates into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import basic_calendar, parse_time

# Coordinate limits.
WORLD_LAT = (-90.0, 90.0)
WORLD_LON = (-180.0, 180.0)
# Regional box used when cleaning (longitude limit 43) ...
CLEAN_BOX = {"lat": (-5.0, 6.0), "lon": (33.0, 43.0)}
# ... and the one used by the quality checks (longitude limit 42).
CHECK_BOX = {"lat": (-5.0, 6.0), "lon": (33.0, 42.0)}

# Columns that are never model features.
# List A (library class) and list B (training script).
NON_FEATURES_A = ["target", "datetime", "isoDate", "latitude", "longitude",
                  "coordinates", "_id", "location"]
NON_FEATURES_B = ["target", "future_outage_days", "datetime", "isoDate", "latitude",
                  "longitude", "coordinates", "_id", "location", "month"]
# Our explicit row identity replaces the pandas index; it is never a feature either.
ID_COLUMNS = ["record_id"]

def project_nested_coords(df: DataFrame, struct_col: str = "coordinates") -> DataFrame:
    """Row 7: lift latitude/longitude out of the nested struct (null stays null)."""
    if struct_col not in df.columns:
        return df
    return df.withColumns({
        "latitude": F.col(f"{struct_col}.latitude").cast("double"),
        "longitude": F.col(f"{struct_col}.longitude").cast("double"),
    })


def project_parse_time(df: DataFrame, src: str = "isoDate", dst: str = "datetime") -> DataFrame:
    """Row 8: ISO text -> TIMESTAMP (bad text -> null, rejected downstream)."""
    if src not in df.columns:
        return df
    return df.withColumn(dst, parse_time(F.col(src)))


def valid_coords(lat: str = "latitude", lon: str = "longitude") -> Column:
    return (F.col(lat).between(*WORLD_LAT) & F.col(lon).between(*WORLD_LON))


def in_box(box: dict = CLEAN_BOX, lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).between(*box["lat"]) & F.col(lon).between(*box["lon"])


def filter_valid_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Row 10: drop null or out-of-world coordinates (inclusive bounds)."""
    return df.filter(valid_coords(lat, lon))


def filter_bbox(df: DataFrame, box: dict = CLEAN_BOX, lat: str = "latitude",
                lon: str = "longitude") -> DataFrame:
    """Row 11: keep rows inside the regional box (inclusive)."""
    return df.filter(in_box(box, lat, lon))


def preprocess(df: DataFrame, box: dict = CLEAN_BOX, time_col: str = "datetime") -> DataFrame:
    """Row 12: nested coordinates -> parsed time -> calendar -> coordinate cleaning."""
    df = project_nested_coords(df)
    df = project_parse_time(df, "isoDate", time_col)
    if time_col in df.columns:
        df = basic_calendar(df, time_col)
    if "latitude" in df.columns and "longitude" in df.columns:
        df = filter_bbox(filter_valid_coords(df), box)
    return df


def filter_drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Row 13."""
    return df.dropna(subset=subset)


def project_drop_nonfeatures(df: DataFrame, exclude: list[str] = NON_FEATURES_B) -> DataFrame:
    """Row 14: all columns except the exclude list."""
    drop = set(exclude) | set(ID_COLUMNS)
    return df.drop(*[c for c in df.columns if c in drop])


def predicate_threshold(df: DataFrame, threshold: float = 0.5, score: str = "p1",
                        out: str = "pred") -> DataFrame:
    """Row 15: class label from a probability, strict ``>``."""
    return df.withColumn(out, (F.col(score) > F.lit(threshold)).cast("int"))
