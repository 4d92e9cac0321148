"""Line dedup: repeated runs of lines, found by prefix doubling over line-id sequences.

Each text is a sequence of line ids (128-bit hashes).  The suffix that starts at a
line gets a rank by its first 1, 2, 4, ... lines: the rank for 2k lines is named
by the pair of ranks for k lines at its start and k lines on.  Ranks are hashes:
suffixes with the same first lines share a rank, which is all that the intervals
of a longest common prefix need, so no global sort is made.  A suffix whose rank
is alone goes no further, since nothing longer repeats there.

A run counts if it has at least ``min_words`` words.  Every maximal repeated run
of that size is the union of its smallest runs of that size, those that begin
at a line and those that end at one.  Two overlapping ranks name such a run of
any length.  The occurrence in the smallest (doc_id, line) stays, and all later ones
are deleted; a copy that overlaps its first occurrence loses what lies beyond it.

Only narrow rows (document key, line, rank) are shuffled, and the runs' first
places are pre-aggregated.  A text moves only if it may lose lines.

Edge cases: null text has no lines and stays null; blank lines belong to runs but
hold no words; null ids come after all ids; rows that repeat id and text are one
document and share its fate; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, row_key, scratch_table, text_batches

MIN_WORDS = 50
CELL_BITS = 20
LINES = "key binary, doc_id bigint, line int, h binary, ahead int, back int"


def _windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, how many lines from it on (and up to it) hold ``least`` words; 0 if none do."""
    total = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    end = np.searchsorted(total, total[:-1] + least, "left")
    ahead = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    back = np.where(total[1:] >= least, np.arange(1, n + 1) - start, 0)
    return ahead, back


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """A row for each line: its document, hash and the smallest runs that begin and end there."""
    def run(batches):
        import pyarrow as pa
        import xxhash
        for batch in batches:
            at, line, h, ahead, back = [], [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                if t is None:
                    continue
                own = t.encode("utf-8", "surrogatepass").split(b"\n")
                a, b = _windows(np.array([len(x.split()) for x in own]), least)
                at.append(np.full(len(own), i))
                line.append(np.arange(len(own), dtype=np.int32))
                h += [xxhash.xxh3_128_digest(x) for x in own]
                ahead.append(a)
                back.append(b)
            if h:
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(at), batch.column("doc_id").take(at), pa.array(np.concatenate(line)), pa.array(h, pa.binary()),
                     pa.array(np.concatenate(ahead).astype(np.int32)), pa.array(np.concatenate(back).astype(np.int32))],
                    ["key", "doc_id", "line", "h", "ahead", "back"])
    return text_batches(docs).select("key", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, LINES)


def _named(*parts):
    return F.unhex(F.md5(F.concat(*parts)))


def _repeated(rows: DataFrame) -> DataFrame:
    """The rows whose ``rank`` another row shares.

    The shared ranks are counted with pre-aggregation and written; the join has exchanges
    on both sides, so adaptive execution splits the rows of a hot rank.
    """
    many = rows.groupBy("rank").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("rank")
    return rows.join(scratch_table(many, "line_shared"), "rank")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """key, start, end of the later copies, a row for each smallest run; ``docs`` has key, doc_id, text."""
    lines = scratch_table(_lines(docs, min_words), "line_rows")
    active = scratch_table(_repeated(lines.withColumnRenamed("h", "rank")).dropDuplicates(["key", "line"]), "line_ranks")
    longest = active.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    # prefix doubling: the ranks of all suffixes for 1, 2, 4, ... lines, while something repeats
    ranks = active.select("key", "line", "rank")
    levels, size = [ranks.withColumn("size", F.lit(1))], 1
    while 2 * size <= longest:
        ahead = ranks.select("key", (F.col("line") - size).alias("line"), F.col("rank").alias("next"))
        longer = ranks.join(ahead, ["key", "line"]).select("key", "line", _named("rank", "next").alias("rank"))
        ranks = scratch_table(_repeated(longer), "line_ranks")
        size *= 2
        if ranks.isEmpty():
            break
        levels.append(ranks.withColumn("size", F.lit(size)))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)

    # a run of size to 2 * size - 1 lines is named by the ranks at its first and its last ``size`` lines
    runs = (active.where("ahead > 0").select("key", "doc_id", F.col("line").alias("start"), F.col("ahead").alias("len"))
            .union(active.where("back > 0").select("key", "doc_id", F.col("line") - F.col("back") + 1, "back")).distinct())
    runs = runs.withColumn("size", F.expr("shiftleft(1, length(bin(len)) - 1)"))
    named = (runs.withColumn("tail", F.col("start") + F.col("len") - F.col("size"))
             .join(every.select("key", "size", F.col("line").alias("start"), F.col("rank").alias("r1")), ["key", "size", "start"])
             .join(every.select("key", "size", F.col("line").alias("tail"), F.col("rank").alias("r2")), ["key", "size", "tail"])
             .select("key", "doc_id", "start", "len", _named("r1", "r2", F.col("len").cast("string").cast("binary")).alias("run")))
    named = scratch_table(named, "line_runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    firsts = (named.groupBy("run").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
              .select("run", F.col("f.key").alias("fkey"), F.col("f.start").alias("fstart")))
    same = F.col("key") == F.col("fkey")
    return (named.join(scratch_table(firsts, "line_firsts"), "run").where(~(same & (F.col("start") == F.col("fstart"))))
            .select("key", F.when(same, F.greatest("start", F.col("fstart") + F.col("len"))).otherwise(F.col("start")).alias("start"),
                    (F.col("start") + F.col("len")).alias("end")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row_ (see ``common.packed``), text without the later copies, n_lines, n_deleted, and the deleted runs as start:end."""
    rows = packed(docs, "doc_id", "text").withColumn("key", row_key())
    cuts = (repeated_runs(rows.select("key", "doc_id", "text"), min_words).groupBy("key")
            .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts")))
    cuts = scratch_table(cuts, "line_cuts")
    cell = F.pmod(F.xxhash64("key"), F.lit(1 << CELL_BITS))
    touched = cuts.select(cell.alias("cell")).distinct().withColumn("hit", F.lit(True))     # 2**CELL_BITS rows at most
    marked = rows.withColumn("cell", cell).join(F.broadcast(touched), "cell", "left").drop("cell")
    none = F.array().cast("array<struct<start:int,end:int>>")
    clean = marked.where("hit IS NULL").drop("hit").withColumn("cuts", none)
    cut = marked.where("hit").drop("hit").join(cuts, "key", "left").withColumn("cuts", F.coalesce("cuts", none))
    whole = clean.unionByName(cut)
    # runs by start: merged into maximal ones
    empty = F.array().cast("array<struct<start:int,end:int>>")
    joined = F.aggregate("cuts", empty, lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    whole = whole.withColumn("runs", F.when(F.size("cuts") > 0, joined).otherwise(empty)).withColumn("lines", F.split("text", "\n", -1))
    kept = F.filter("lines", lambda x, i: ~F.exists("runs", lambda r: (r["start"] <= i) & (i < r["end"])))
    return whole.select(
        "row_", "doc_id", F.when(F.size("runs") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("n_deleted"),
        F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string"))), ",").alias("runs"))


def without_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its own columns and shortened texts; a document that loses all its lines goes.

    A column ``n_chars`` follows the text where lines were deleted.
    """
    out = dedup_lines(docs, min_words).where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    names = docs.columns
    text_at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")
    fields = []
    for i, c in enumerate(names):
        own = F.col(f"row_.c{i}")
        if i == text_at:
            own = F.col("text")
        elif c.lower() == "n_chars":
            own = F.when(F.col("n_deleted") > 0, F.length("text").cast(docs.schema.fields[i].dataType)).otherwise(own)
        fields.append(own.alias(f"c{i}"))
    return out.select(*fields).toDF(*names)
