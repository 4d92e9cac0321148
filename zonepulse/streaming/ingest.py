"""Incremental ingestion of incident records with Structured Streaming.

The reference reads one complete file; the same source rules (rows 1-2) and
cleaning plan (row 12) apply unchanged to JSON-lines files arriving in a
folder.  Output is appended Parquet; progress lives in a checkpoint under
the shared ``spark.checkpoint.dir`` so a restarted or re-scheduled query
resumes exactly once.  ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import parse_time
from ..operators.clean import preprocess
from ..session import scratch_path
from ..sources.records import RECORD_SCHEMA


def read_records_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """JSON-lines records as a stream with the fixed record schema."""
    return (spark.readStream.schema(RECORD_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(folder))


def valid_records(stream: DataFrame) -> DataFrame:
    """Row 2's skip rules on a stream: coordinates and a parseable time are required."""
    lat, lon = F.col("coordinates.latitude"), F.col("coordinates.longitude")
    return stream.filter(lat.isNotNull() & lon.isNotNull() & parse_time(F.col("isoDate")).isNotNull())


def rejected_records(stream: DataFrame) -> DataFrame:
    """The records that :func:`valid_records` leaves out, with the reason."""
    lat, lon = F.col("coordinates.latitude"), F.col("coordinates.longitude")
    iso = F.col("isoDate")
    reason = (F.when(lat.isNull() | lon.isNull() | iso.isNull(), F.lit("missing_field"))
               .when(parse_time(iso).isNull(), F.lit("bad_time")))
    return stream.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def progress_folder(spark: SparkSession, folder: str, out_path: str) -> str:
    """The progress log of one ingest: named after its input and its output, so that two ingests
    never share one and a restarted one finds its own."""
    name = hashlib.sha256(f"{folder}\n{out_path}".encode()).hexdigest()[:20]
    return scratch_path(spark, f"stream-ingest-{name}")


def ingest(spark: SparkSession, folder: str, out_path: str, checkpoint: str | None = None,
           once: bool = True, rejects_path: str | None = None):
    """Start the incremental clean-and-store query; returns the ``StreamingQuery``.

    With ``rejects_path`` the records left out are kept there, by a second query that is
    returned with the first one.
    """
    records = read_records_stream(spark, folder)

    def start(rows: DataFrame, path: str, progress: str):
        w = (rows.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", progress).outputMode("append"))
        return (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start()

    main = start(preprocess(valid_records(records)), out_path, checkpoint or progress_folder(spark, folder, out_path))
    if rejects_path is None:
        return main
    return main, start(rejected_records(records), rejects_path, progress_folder(spark, folder, rejects_path))
