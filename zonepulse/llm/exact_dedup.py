"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each level keeps only the cells that still hold two or more rows; the full
text is hashed only for rows whose cell survived both cheaper levels.  What a
level hands to the next is a set of surviving cell numbers below
``2**cell_bits``: its size is bounded whatever the input, so it is broadcast.
Cells are a superset filter.  On a corpus so large that every cell survives,
more rows are hashed than needed, and the result is the same.

The decision rests on length and SHA-256 of the whole text.  Groups are found
by a pre-aggregated count and maximum, and rows learn their group from a join
of narrow rows, which adaptive execution splits at a hot group.

Edge cases: null text is an empty text; rows with a null id take part and rank
below every id; of several rows that share the largest id exactly one stays; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, scratch_table, text_of

CELL_BITS = 20
PREFIX_CHARS = 128


def _repeated(cells: DataFrame) -> DataFrame:
    """The cell numbers that two or more rows share."""
    return (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("cell"))


def exact_dedup(docs: DataFrame, extra: dict[str, Column] | None = None,
                prefix_chars: int = PREFIX_CHARS, cell_bits: int = CELL_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept for every row of ``docs``.

    ``extra`` names columns made from ``doc_id`` and ``text`` that each row carries along.
    """
    cells = 1 << cell_bits
    length = F.octet_length("t")
    by_length = F.pmod(length, F.lit(cells))
    by_prefix = F.pmod(F.xxhash64(length, F.substring("t", 1, prefix_chars)), F.lit(cells))

    texts = pick(docs, "doc_id", "text").withColumn("t", text_of())
    level1 = _repeated(texts.select(by_length.alias("cell")))
    near = texts.select("t", by_length.alias("cell")).join(F.broadcast(level1), "cell", "left_semi")
    level2 = _repeated(near.select(by_prefix.alias("cell"))).withColumn("hit", F.lit(True))

    rows = (texts.withColumn("cell", by_prefix).join(F.broadcast(level2), "cell", "left")
            .select("doc_id", F.monotonically_increasing_id().alias("rid"),
                    length.alias("len"),
                    F.when(F.col("hit"), F.unhex(F.sha2("t", 256))).alias("full"),
                    *[c.alias(f"x_{k}") for k, c in (extra or {}).items()]))
    rows = scratch_table(rows, "exact_rows")
    groups = (rows.where("full IS NOT NULL").groupBy("len", "full")
              .agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    groups = scratch_table(groups, "exact_groups")
    alone = F.col("n").isNull()
    return (rows.join(groups, ["len", "full"], "left")
            .select("doc_id",
                    F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                    (alone | (F.col("keep.rid") == F.col("rid"))).alias("kept"),
                    *[F.col(f"x_{k}").alias(k) for k in (extra or {})]))
