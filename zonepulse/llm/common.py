"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: ASCII white space that separates words: space and the controls 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Scratch folders of this process: path -> (session, owner).
_SCRATCH: dict[str, tuple[SparkSession, str]] = {}
_OWNER: contextvars.ContextVar[str] = contextvars.ContextVar("scratch_owner", default="")


@contextlib.contextmanager
def owned(owner: str):
    """Scratch folders made inside belong to ``owner``, and ``drop_scratch(owner)`` deletes them alone."""
    token = _OWNER.set(owner)
    try:
        yield
    finally:
        _OWNER.reset(token)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, which ``drop_scratch`` or the driver's exit deletes."""
    path = os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "tables", f"{name}-{uuid.uuid4().hex}")
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH[path] = (spark, _OWNER.get())
    return path


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name first and by case-insensitive name else.

    Other columns go at once, so their names can't clash with those an
    operator adds, not even when they differ from ``names`` in case alone.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = []
    for name in names:
        at = [i for i, c in enumerate(df.columns) if c == name] or \
             [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not at:
            raise ValueError(f"no column {name!r} in {df.columns}")
        out.append(F.col(f"c{at[0]}").alias(name))
    return plain.select(*out)


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and the whole row as the struct column ``row_``.

    For operators that return whole rows: the caller's columns are out of
    reach of name clashes inside the struct; ``unpacked`` restores them.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    row = F.struct(*[F.col(f"c{i}") for i in range(len(df.columns))]).alias("row_")
    own = []
    for name in names:
        at = [i for i, c in enumerate(df.columns) if c == name] or \
             [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not at:
            raise ValueError(f"no column {name!r} in {df.columns}")
        own.append(F.col(f"c{at[0]}").alias(name))
    return plain.select(*own, row)


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """Inverse of ``packed``: the rows under ``row_``, with the caller's names."""
    return df.select(*[F.col(f"row_.c{i}") for i in range(len(names))]).toDF(*names)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes that name a document: its id (null included) and its whole text.

    Rows that repeat both count as one document wherever a key is needed.
    """
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                                  F.lit(":"), F.coalesce(F.col(text), F.lit("")))))


def text_of(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


BATCH_ROWS = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, sent to Python workers in batches of at most ``BATCH_ROWS`` rows from now on.

    Spark's default of 10,000 rows a batch holds each batch of texts several times over in
    the executor and its workers; the session keeps a smaller setting if it has one.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs only a second read.  Unlike
    ``checkpoint()`` the reread table has no inherited partitioning, so a join
    on a hot key gets exchanges on both sides, which adaptive execution splits.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_keys(rows: DataFrame, keys: DataFrame, cell_bits: int = 20) -> DataFrame:
    """The ``rows`` (with a column key) whose key is not in ``keys``.

    Only rows in the hash cell of such a key are shuffled; the set of cells has
    ``2**cell_bits`` rows at most and is broadcast.
    """
    cell = F.pmod(F.xxhash64("key"), F.lit(1 << cell_bits))
    cells = keys.select(cell.alias("cell")).distinct().withColumn("hit", F.lit(True))
    marked = rows.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left").drop("cell")
    clear = marked.where("hit IS NULL").drop("hit")
    return clear.unionByName(marked.where("hit").drop("hit").join(keys.select("key").distinct(), "key", "left_anti"))


def once_a_key(rows: DataFrame, keys: DataFrame, cell_bits: int = 20) -> DataFrame:
    """The ``rows`` (with a column key), those of a key in ``keys`` once.

    Rows outside the hash cells of such keys are not moved; the others are reduced
    before the shuffle, so a key with very many rows costs one row a task.
    """
    cell = F.pmod(F.xxhash64("key"), F.lit(1 << cell_bits))
    cells = keys.select(cell.alias("cell")).distinct().withColumn("hit", F.lit(True))
    marked = rows.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left").drop("cell")
    # keys that only share a cell have one row each, or the caller would name them too
    return marked.where("hit IS NULL").drop("hit").unionByName(marked.where("hit").drop("hit").dropDuplicates(["key"]))


def drop_scratch(owner: str | None = None, path: str | None = None) -> None:
    """Delete the scratch folders of ``owner`` (or ``path`` alone, or all of this process) once the results that read them are written."""
    for at, (spark, whose) in list(_SCRATCH.items()):
        if (owner is not None and whose != owner) or (path is not None and at != path):
            continue
        del _SCRATCH[at]
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(at)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session has ended; nothing is left to ask
            pass
