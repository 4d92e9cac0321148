"""Mixing sources to target weights by hash-threshold histograms.

Every document has a place in [0, 2**60) from a hash of its id and text.  A
source whose target is ``r`` times its size takes each document ``floor(r)``
times, and once more where the place lies below the source's threshold.  The
thresholds are nested: a larger target keeps all that a smaller one takes.

Thresholds are found without sorting: words are summed by (source, hash
bucket), the bucket in which the budget ends is located in each source's
bounded histogram, and only the documents of that boundary bucket are
histogrammed again by their next hash bits, until the bits are used up.  The
sums are pre-aggregated, so a hot source spreads over all tasks; documents meet
their source's threshold in a join salted by hash bits.

Targets: sources by code point (null last) weigh 1, 2, 3, 1, ... and share all
words; a target stops at ``max_epochs`` times the source's size, and the excess
is reshared by weight until no target is above.

Edge cases: null text has size 0; null source is a source of its own, null ids
are hashed by their text; rows that repeat id and text have one place and are
taken alike; an empty table gives an empty result; a corpus without words has
targets of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import WORD, packed, pick, scratch_table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
STEP_BITS = 12          # hash bits a refinement adds: 4,096 buckets a source
PLACE_BITS = 60
SALTS = 32


def n_words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def place():
    """60 bits of a hash of id and text, as a long; a fixed rule, so reruns agree."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                            F.coalesce(F.col("text"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their position in code point order, null last; no task sees them all.

    Ranges of the sorted sources are counted, the bounded list of counts gives each range
    its offset, and rows are numbered within their range.
    """
    spark = sources.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (sources.withColumn("none", F.col("source").isNull())
              .repartitionByRange(parts, "none", "source")
              .withColumn("part", F.spark_partition_id()))
    ranged = scratch_table(ranged, "mix_ranges")
    counts = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = {}, 0
    for p in sorted(counts):
        offsets[p], total = total, total + counts[p]
    base = F.lit(0).cast("long")
    if offsets:
        table = F.create_map(*[x for p, o in offsets.items() for x in (F.lit(p), F.lit(o))])
        base = F.element_at(table, F.col("part"))
    w = Window.partitionBy("part").orderBy("none", "source")
    return ranged.withColumn("rank", base + F.row_number().over(w) - 1).drop("part", "none")


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size) with weight and target."""
    per = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                       (F.col("rank") % len(weights)).cast("int") + 1).cast("long")
    s = scratch_table(_ranked(sources).withColumn("weight", per).drop("rank"), "mix_sources")
    limit = F.col("source_size") * max_epochs
    total = s.agg(F.sum("source_size")).first()[0] or 0
    rest, weight = total, s.agg(F.sum("weight")).first()[0] or 1
    while True:
        # the share of one weight is rest / weight; compare in whole numbers
        over = F.col("weight").cast("decimal(38,0)") * F.lit(rest) > limit.cast("decimal(38,0)") * F.lit(weight)
        held = s.where(over).agg(F.sum(limit), F.sum("weight"), F.count(F.lit(1))).first()
        left = s.where(~over).agg(F.sum("weight")).first()[0] or 0
        now = total - (held[0] or 0)
        if not left or (now, left) == (rest, weight):
            break
        rest, weight = now, left
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(weight))
    return s.withColumn("target", F.when(over, limit.cast("double")).otherwise(share))


def _thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """source, cut: the place below which a document is taken once more.

    ``plan`` has source and budget, the words that the extra round may take.  A
    source whose budget covers all its words has no boundary: its cut is 2**60.
    """
    state = plan.select("source", F.col("budget").alias("left"), F.lit(1 << PLACE_BITS).alias("cut"))
    inside = rows
    for bits in range(STEP_BITS, PLACE_BITS + 1, STEP_BITS):
        shift = PLACE_BITS - bits
        bucket = F.shiftright("place", shift)
        hist = (inside.groupBy("source", bucket.alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("place").alias("low"), F.max("place").alias("high")))
        w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0).cast("long")))
        state2 = state.select(F.col("source").alias("s2"), "left")
        hit = (hist.join(state2, F.col("source").eqNullSafe(F.col("s2")))
               .where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("words") > F.col("left")))
               .select(F.col("source").alias("s2"), "bucket", "words", "low", "high",
                       (F.col("left") - F.col("before")).alias("rest")))
        hit = scratch_table(hit, "mix_boundary")
        many = hit.where("low < high")
        last = shift == 0 or many.isEmpty()
        edge = F.shiftleft("bucket", shift)
        if last:
            # each boundary bucket is one place now: take it if that ends nearer to the budget
            edge = F.when(F.col("words") - F.col("rest") < F.col("rest"), F.col("low") + 1).otherwise(F.col("low"))
        state = scratch_table(
            state.join(hit, F.col("source").eqNullSafe(F.col("s2")), "left")
            .select("source", F.coalesce("rest", "left").alias("left"), F.coalesce(edge, F.col("cut")).alias("cut")),
            "mix_state")
        if last:
            break
        # source and bucket are the join key: a hot source meets its boundary in one small bucket
        inside = scratch_table(
            inside.join(hit.select("s2", F.col("bucket").alias("b2")),
                        F.col("source").eqNullSafe(F.col("s2")) & (bucket == F.col("b2")), "left_semi"), "mix_inside")
    return state.select("source", "cut")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, whole_rows: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for every row of ``docs``.

    With ``whole_rows`` each row comes as ``row_`` (see ``common.packed``) with its copies.
    """
    names = ("doc_id", "text", "source")
    base = packed(docs, *names) if whole_rows else pick(docs, *names)
    keyed = base.withColumn("size", n_words()).withColumn("place", place())
    keyed = keyed.drop("text")
    narrow = scratch_table(keyed.select("source", "size", "place", *([] if whole_rows else ["doc_id"])), "mix_rows")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(scratch_table(sources, "mix_sizes"), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("full", F.least(epochs, F.lit(max_epochs)).cast("long"))
    goal = scratch_table(goal.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")), "mix_goal")
    cuts = _thresholds(narrow.select("source", "size", "place").where("size > 0"), goal)
    plan = (goal.join(cuts.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")))
            .select(F.col("source").alias("s"), "source_size", "target", "full",
                    F.when(F.col("full") >= max_epochs, 0).otherwise(F.col("cut")).alias("cut"),
                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    plan = scratch_table(plan, "mix_plan")          # Spark broadcasts it if its files are small, and else joins by salt
    rows = (keyed if whole_rows else narrow).withColumn("salt_", (F.col("place") % SALTS).cast("int"))
    copies = F.col("full") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt_") == F.col("salt")))
    return joined.select("row_" if whole_rows else "doc_id", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"))
