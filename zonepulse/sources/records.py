"""Incident record sources (inventory rows 1-3).

Input formats: one JSON array per file (the reference's format), JSON lines,
or Parquet.  Array files are read in splits whose states are composed afterwards
(:func:`scan_json_array` alone reads a file as one value, as Spark's own reader does); parse
them once and write Parquet for everything downstream.  JSON lines and
Parquet split and stream normally; their ``record_id`` must come from the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.calendar import parse_time
from ..session import materialize

# The raw record as the reference reads it.
RECORD_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("coordinates", T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType())])),
    T.StructField("isoDate", T.StringType()),
    T.StructField("dateInSeconds", T.LongType()),
    T.StructField("record_id", T.LongType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def _require(spark: SparkSession, path: str) -> None:
    if not _exists(spark, path):
        raise FileNotFoundError(f"Data file not found: {path}")


def scan_json_array(spark: SparkSession, path: str, fmt: str = "json_array") -> DataFrame:
    """Row 1: read raw records (``json_array``, ``json_lines`` or ``parquet``) with a fixed schema."""
    _require(spark, path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(RECORD_SCHEMA).json(path, multiLine=(fmt == "json_array"))


BLOCK = ["_file", "_block"]


def _exclusive(*over: str):
    return Window.partitionBy(*over).rowsBetween(Window.unboundedPreceding, -1)


def _before(value, window) -> Column:
    """The sum of ``value`` over the rows before this one."""
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The array files cut after each ``}``, with what each piece does to the reader's state.

    Files are read in splits.  A piece doesn't know whether it begins inside a string, so the depth
    is added up for both cases: ``_turns`` is the parity of quotes before the piece in its block,
    ``_deep0`` and ``_deep1`` the change of depth before it if the block begins outside or inside a
    string.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    pieces = raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")                      # without escaped characters
    bare = lambda text: F.regexp_replace(text, r'"[^"]*("|$)', "")          # noqa: E731  without strings
    step = lambda out: F.length(F.translate(out, "]", "")) - F.length(F.translate(out, "{[", ""))
    quotes = F.length(plain) - F.length(F.translate(plain, '"', ""))
    odd = quotes % 2
    here = pieces.withColumns({
        "_odd": odd, "_d0": step(bare(plain)) - F.when(odd == 0, 1).otherwise(0),
        "_d1": step(bare(F.regexp_replace(plain, r'^[^"]*("|$)', ""))) - F.when(odd == 1, 1).otherwise(0)})
    w = _exclusive(*BLOCK).orderBy("_at")
    turned = here.withColumn("_turns", _before("_odd", w) % 2)
    if0 = F.when(F.col("_turns") == 0, F.col("_d0")).otherwise(F.col("_d1"))
    if1 = F.when(F.col("_turns") == 0, F.col("_d1")).otherwise(F.col("_d0"))
    stepped = turned.withColumns({"_s0": if0, "_s1": if1})
    return materialize(stepped.withColumns({"_deep0": _before("_s0", w), "_deep1": _before("_s1", w)}).drop("_d0", "_d1"))


def _element_runs(pieces: DataFrame) -> DataFrame:
    """The pieces put together to runs (_file, _block, _run, _last, text), each up to the ``}`` that
    closes an object of the array; ``_block`` is where the run begins.

    Blocks hand on their state in a table of one row a block: first the parity of quotes, then the
    depth that goes with it, then the number of closed objects.
    """
    blocks = pieces.groupBy(*BLOCK).agg(F.sum("_odd").alias("o"), F.sum("_s0").alias("s0"), F.sum("_s1").alias("s1"), F.max("_at").alias("_top"))
    along = _exclusive("_file").orderBy("_block")
    blocks = blocks.withColumn("_in", _before("o", along) % 2).withColumn(
        "s", F.when(F.col("_in") == 0, F.col("s0")).otherwise(F.col("s1")))
    end = F.max(F.struct("_block", "_top")).over(Window.partitionBy("_file"))
    # a row a block: it goes to the pieces, whose texts are many, and not they to it
    start = F.broadcast(materialize(blocks.select(*BLOCK, "_in", _before("s", along).alias("_from"), end.alias("_end"))))
    inside = (F.col("_in") + F.col("_turns") + F.col("_odd")) % 2           # after the piece
    deep = F.col("_from") + F.when(F.col("_in") == 0, F.col("_deep0") + F.col("_s0")).otherwise(F.col("_deep1") + F.col("_s1"))
    state = pieces.join(start, BLOCK).select(
        *BLOCK, "_at", "value", (F.struct("_block", "_at") == F.col("_end")).alias("_last"),
        F.when((inside == 0) & (deep == 1), 1).otherwise(0).alias("_closes"))
    closed = F.broadcast(state.groupBy(*BLOCK).agg(F.sum("_closes").alias("c")).select(*BLOCK, _before("c", along).alias("_runs")))
    runs = state.join(closed, BLOCK).withColumn("_run", F.col("_runs") + _before("_closes", _exclusive(*BLOCK).orderBy("_at")))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))
    text = runs.groupBy("_file", "_run").agg(F.min("_block").alias("_block"), F.max("_last").alias("_last"), parts.alias("p"))
    return text.select("_file", "_block", "_run", "_last", F.concat(
        F.array_join(F.col("p.value"), "}"), F.when(F.col("_last"), F.lit("")).otherwise(F.lit("}"))).alias("text"))


def _array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``record_id``, ``e``: each element of the array files as JSON text, numbered through all files.

    A file is read in many tasks: it is cut after each ``}``, the state of the reader (inside a
    string or not, depth) is composed over the blocks, and the pieces of an element are put together
    again (an element, with the elements before it that are no objects, is one value).  Positions go
    on from block to block and from file to file in the order of their paths: the counts per block
    (a row each) are added up.  A file that is no array, an empty one included, is an error.
    """
    pieces = _pieces(spark, path)
    runs = _element_runs(pieces)
    text = F.regexp_replace("text", r"^\s+|\s+$", "")
    first, last = F.col("_run") == 0, F.col("_last")
    core = F.when(~last, text).when(text.endswith("]"), F.substr(text, F.lit(1), F.length(text) - 1))
    body = F.when(core.startswith(F.when(first, F.lit("[")).otherwise(F.lit(","))), F.substr(core, F.lit(2)))
    none = last & F.when(first, F.trim(F.regexp_replace(body, r"\s", "")) == "").otherwise(F.regexp_replace(core, r"\s", "") == "")
    many = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>")
    found = materialize(runs.select("_file", "_block", "_run", F.when(none, F.array().cast("array<string>")).when(
        F.regexp_replace(body, r"\s", "") != "", many).alias("a")))
    if found.where("a IS NULL").limit(1).count() or found.select("_file").distinct().count() < len(
            spark.read.text(path).inputFiles()):
        raise ValueError("Invalid JSON format: expected a JSON array of records")
    per = found.groupBy(*BLOCK).agg(F.sum(F.size("a")).alias("n"))
    offs = per.select(*BLOCK, _before("n", _exclusive().orderBy(*BLOCK)).alias("_off"))
    own = _before(F.size("a"), _exclusive(*BLOCK).orderBy("_run"))
    return (found.withColumn("_own", own).join(offs, BLOCK).select("_off", "_own", F.posexplode("a").alias("_pos", "e"))
            .select((F.col("_off") + F.col("_own") + F.col("_pos")).cast("bigint").alias("record_id"), "e"))


def scan_flatten_validate(spark: SparkSession, path: str, fmt: str = "json_array"):
    """Row 2: flatten, skip records without latitude, longitude or isoDate, keep positions.

    Returns ``(records, rejects)``: records have ``latitude, longitude, iso_date,
    date_seconds, record_id, datetime``; rejects have ``record_id, reason``.
    Broken JSON, a non-array document, or no valid record raise ``ValueError``.
    """
    _require(spark, path)
    if fmt == "json_array":
        # array elements first become *strings*: a malformed element then nulls only itself
        elems = _array_elements(spark, path)
        # only JSON objects are records; any other element (string, number, array) is malformed
        is_obj = F.substring(F.ltrim("e"), 1, 1) == F.lit("{")
        parsed = elems.select("record_id", F.when(is_obj, F.from_json("e", RECORD_SCHEMA)).alias("r"))
    elif fmt == "json_lines":
        # a broken line is kept as text in its own column, and is malformed
        schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
        raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
        parsed = raw.select("record_id", F.when(F.col("_corrupt").isNull(), F.struct(*RECORD_SCHEMA.names)).alias("r"))
    else:
        raw = scan_json_array(spark, path, fmt)
        parsed = raw.select(F.col("record_id"), F.struct(*raw.columns).alias("r"))
    lat, lon = F.col("r.coordinates.latitude"), F.col("r.coordinates.longitude")
    iso = F.col("r.isoDate")
    reason = (F.when(F.col("r").isNull(), F.lit("malformed"))
               .when(F.col("record_id").isNull(), F.lit("missing_id"))
               .when(lat.isNull() | lon.isNull() | iso.isNull(), F.lit("missing_field"))
               .when(parse_time(iso).isNull(), F.lit("bad_time")))
    # written once: a filter on what was parsed would parse again, for each field it looks at
    tagged = materialize(parsed.select(
        lat.alias("latitude"), lon.alias("longitude"), iso.alias("iso_date"),
        F.col("r.dateInSeconds").alias("date_seconds"), "record_id",
        parse_time(iso).alias("datetime"), reason.alias("_reason")))
    records = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    rejects = tagged.filter(F.col("_reason").isNotNull()).select(
        "record_id", F.col("_reason").alias("reason"))
    if records.limit(1).count() == 0:
        raise ValueError("No valid records found in the data file")
    return records, rejects


def scan_sorted(spark: SparkSession, path: str, fmt: str = "json_array",
                renumber: bool = False) -> DataFrame:
    """Row 3: all columns, ``datetime`` parsed from ``isoDate``, sorted by (datetime, record_id).

    ``renumber`` adds a dense 0-based position in that order (distributed rank,
    see ``operators.splits``) instead of the reference's driver-side reset.
    """
    try:
        df = scan_json_array(spark, path, fmt)
    except AnalysisException as e:  # pragma: no cover - surfaced as a clear error
        raise FileNotFoundError(str(e)) from e
    if fmt == "json_array":
        elems = _array_elements(spark, path)
        df = elems.select("record_id", F.from_json("e", RECORD_SCHEMA).alias("r")).select(
            *[F.col(f"r.{c}").alias(c) for c in RECORD_SCHEMA.names if c != "record_id"],
            F.coalesce("r.record_id", "record_id").alias("record_id"))
    if "isoDate" in df.columns:
        df = df.withColumn("datetime", parse_time(F.col("isoDate")))
    if renumber:
        from ..operators.splits import rank_rows
        late = df.withColumn("_late", F.col("datetime").isNull())
        return rank_rows(late, ["_late", "datetime"], "record_id", "position").drop("_late").orderBy("position")
    return df.orderBy(F.col("datetime").asc_nulls_last(), "record_id")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Persist parsed records once (optionally partitioned, e.g. by year and month)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
