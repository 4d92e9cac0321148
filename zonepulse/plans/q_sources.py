"""Round-trip queries for sources and sinks (rows 1-6): records derived by Spark from the
``outages`` view are written in the source format (JSON array files), then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import records as R
from ..sources import sinks
from ..sources.tables import load_view
from .q_models import HELD
from .registry import register


def _raw_records(spark, sf):
    """outages as raw nested records: coordinates struct, ISO text time, epoch seconds."""
    o = load_view(spark, sf, "outages")
    return o.select(
        F.concat(F.lit("id_"), F.col("record_id").cast("string")).alias("_id"),
        F.col("area"),
        F.when(F.col("latitude").isNotNull() | F.col("longitude").isNotNull(),
               F.struct("latitude", "longitude")).alias("coordinates"),
        F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("isoDate"),
        F.unix_seconds("datetime").alias("dateInSeconds"),
        F.col("record_id"))


def _array_files(spark, sf, records: int = 5_000):
    """The raw records as JSON array files of a bounded length, in record order over the file names."""
    path = _tmp(spark, "records-array")
    one = F.to_json(F.struct("_id", "area", "coordinates", "isoDate", "dateInSeconds", "record_id"))
    arrays = (_raw_records(spark, sf).groupBy(F.floor(F.col("record_id") / records).alias("part"))
              .agg(F.sort_array(F.collect_list(F.struct("record_id", one.alias("j")))).alias("a"))
              .select("part", F.concat(F.lit("["), F.array_join(F.col("a.j"), ","), F.lit("]")).alias("value")))
    arrays.orderBy("part").select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def _tmp(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("scan_flatten_validate", """
SELECT latitude, longitude, strftime(datetime, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso_date,
  CAST(floor(epoch_us(datetime) / 1000000.0) AS BIGINT) AS date_seconds, record_id, datetime
FROM (SELECT * EXCLUDE (record_id), row_number() OVER (ORDER BY record_id) - 1 AS record_id FROM outages)
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", ("outages",))
def scan_flatten_validate(spark, sf):
    recs, _ = R.scan_flatten_validate(spark, _array_files(spark, sf))
    return recs


@register("scan_sorted", """
SELECT record_id, area, strftime(datetime, '%Y-%m-%dT%H:%M:%S.%fZ') AS isoDate, datetime,
  CAST(row_number() OVER (ORDER BY datetime, record_id) - 1 AS BIGINT) AS position
FROM outages""", ("outages",))
def scan_sorted(spark, sf):
    return R.scan_sorted(spark, _array_files(spark, sf), renumber=True).select(
        "record_id", "area", "isoDate", "datetime", "position")


@register("sink_csv", """
SELECT record_id, zone_id, area, latitude, longitude FROM outages""", ("outages",))
def sink_csv(spark, sf):
    path = _tmp(spark, "table-csv")
    df = load_view(spark, sf, "outages").select("record_id", "zone_id", "area", "latitude",
                                                "longitude")
    sinks.sink_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@register("sink_csv_head", """
SELECT record_id, zone_id, area, latitude, longitude FROM outages ORDER BY record_id LIMIT 100""", ("outages",))
def sink_csv_head(spark, sf):
    """The processed-sample file: the first 100 rows by id."""
    path = _tmp(spark, "sample-csv")
    df = load_view(spark, sf, "outages").select("record_id", "zone_id", "area", "latitude", "longitude")
    sinks.sink_csv(df, path, head=100, order=[F.asc("record_id")])
    return spark.read.schema(df.schema).option("header", True).csv(path)


@register("sink_json", """
SELECT record_id, zone_id, area, latitude, longitude FROM outages""", ("outages",))
def sink_json(spark, sf):
    path = _tmp(spark, "table-json")
    df = load_view(spark, sf, "outages").select("record_id", "zone_id", "area", "latitude",
                                                "longitude")
    sinks.sink_json(df, path)
    return spark.read.schema(df.schema).json(path)


@register("scan_json_array", """
SELECT record_id, 'id_' || CAST(record_id AS VARCHAR) AS _id, area, latitude, longitude,
  strftime(datetime, '%Y-%m-%dT%H:%M:%S.%fZ') AS isoDate,
  CAST(floor(epoch_us(datetime) / 1000000.0) AS BIGINT) AS dateInSeconds
FROM outages""", ("outages",))
def scan_json_array(spark, sf):
    df = R.scan_json_array(spark, _array_files(spark, sf))
    return df.select("record_id", "_id", "area", F.col("coordinates.latitude").alias("latitude"),
                     F.col("coordinates.longitude").alias("longitude"), "isoDate", "dateInSeconds")


@register("model_save_load", f"SELECT record_id, label, label AS pred, true AS same_after_reload FROM {HELD}", ("hubs",))
def model_save_load(spark, sf):
    """Fit, save (model + metadata), load back, predict with both models."""
    from ..operators import models as ML
    from .q_models import NAMES, _data
    train, test = _data(spark, sf)
    m = ML.fit(train, "random_forest")
    path = _tmp(spark, "model")
    sinks.save_model(m, path, {"model_name": "random_forest_baseline",
                               "model_type": "random_forest", "feature_names": NAMES})
    loaded, meta = sinks.load_model(path)
    if meta["feature_names"] != NAMES:
        raise RuntimeError("metadata changed on the way")
    before = ML.predict(m, test).select("record_id", F.col("p1").alias("p0"))
    after = ML.predict(loaded, test)
    return after.join(before, "record_id").select(
        "record_id", F.col("label").cast("int").alias("label"), "pred", (F.col("p1") == F.col("p0")).alias("same_after_reload"))
