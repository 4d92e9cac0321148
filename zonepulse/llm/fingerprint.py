"""Document fingerprints: threshold-scaled sketches of word shingles.

The sketch of a text holds every shingle hash below a fixed fraction of the hash
range.  Texts of any length are cut by the same threshold, so sketches can be
merged (``merge``) and compared by resemblance or, between very unequal texts, by
containment.  Where no hash is below (short texts alone), the sketch holds the
smallest as a witness.  A witness is above the threshold and so equals no kept hash:
it tells two such texts apart, and containment never counts it.

``fingerprint_pairs`` compares each text with an edited text and with the next
document.  Documents are dealt into ranges of ids, cut at quantiles; the first
document of each range is also dealt to the range before it, as a guard, so the
next document is always in the same range and texts move once.

Edge cases: null text is empty, has an empty sketch and edits to itself; two
empty sketches are alike (1), an empty and another one are not (0); null ids
come before all ids; rows that share an id are ordered by text; a single
document is its own next one; the containment of a text with a witness alone is
unknown (null) unless both sketches are equal (1); very long texts are sketched
whole; only doc_id and text are read, so other columns can't clash; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import SPACE, pick, text_of
from .spans import let

SHINGLE = 5
KEEP_ONE_IN = 4
LOWEST = -(1 << 63)


def sketch(text: Column, shingle: int = SHINGLE, keep_one_in: int = KEEP_ONE_IN) -> Column:
    """Sorted distinct kept hashes (array of long) of the text's lower-case word shingles."""
    limit = (1 << 63) // keep_one_in
    words = F.array_remove(F.split(F.lower(text), SPACE), "")

    def hashes(w: Column) -> Column:
        # the hash's upper 63 bits; shorter texts are one shingle
        at = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]), 1)
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0))), at)

    def kept(h: Column) -> Column:
        return let(F.filter(h, lambda x: x < limit),
                   lambda k: F.when(F.size(k) > 0, F.array_sort(F.array_distinct(k))).otherwise(F.array(F.array_min(h))))
    return let(F.transform(words, lambda x: F.xxhash64(x)),
               lambda w: F.when(F.size(w) > 0, let(hashes(w), kept)).otherwise(F.array().cast("array<bigint>")))


def merge(a: Column, b: Column, keep_one_in: int = KEEP_ONE_IN) -> Column:
    """The sketch of both texts' shingles together."""
    limit = (1 << 63) // keep_one_in
    return let(F.array_sort(F.array_union(a, b)), lambda u: F.when(
        F.exists(u, lambda x: x < limit), F.filter(u, lambda x: x < limit)).otherwise(F.slice(u, F.lit(1), F.lit(1))))


def resemblance(a: Column, b: Column) -> Column:
    """Share of common hashes among all of both; of two witnesses: whether they are equal."""
    return let(F.size(F.array_intersect(a, b)), lambda both: F.when(
        (F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both)))


def containment(a: Column, b: Column, keep_one_in: int = KEEP_ONE_IN) -> Column:
    """Share of the hashes of ``a`` that ``b`` has too; null where ``a`` has none below the threshold."""
    limit = (1 << 63) // keep_one_in
    return let(F.filter(a, lambda x: x < limit), lambda k: F.when(a == b, 1.0).when(F.size(a) == 0, 0.0)
               .when(F.size(k) > 0, F.size(F.array_intersect(k, b)) / F.size(k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lower(F.hex(x))), ",")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at or below ``value``, in two steps of about sqrt(n)."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[::step]])
    block = F.size(F.filter(coarse, lambda b: b <= value))
    return F.when(block == 0, 0).otherwise(
        (block - 1) * step + F.size(F.filter(F.slice(fine, (block - 1) * step + 1, F.lit(step)), lambda b: b <= value)))


def with_next(docs: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """``docs`` (doc_id, t, ...) with ``next_<c>`` of the next document, by id, for each of ``columns``."""
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    ids = docs.select(key.alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] or []
    bounds = sorted(set(cuts))
    firsts = {r["r"]: r["first"] for r in ids.groupBy(_range_of(F.col("id"), bounds).alias("r"))
              .agg(F.min("id").alias("first")).collect()}                      # ``ranges`` rows at most
    order = sorted(firsts)
    guard_of = {firsts[r]: order[i - 1] for i, r in enumerate(order)}
    own = F.struct(_range_of(F.col("id"), bounds).cast("int").alias("r"), F.lit(False).alias("guard"))
    dealt = F.array(own)
    if guard_of:
        guards = F.create_map(*[x for f, r in guard_of.items() for x in (F.lit(f).cast("long"), F.lit(r).cast("int"))])
        dealt = F.when(F.map_contains_key(guards, F.col("id")),
                       F.array(own, F.struct(F.element_at(guards, F.col("id")).alias("r"), F.lit(True).alias("guard")))
                       ).otherwise(dealt)
    rows = docs.withColumn("id", key).withColumn("x", F.explode(dealt)).select("*", "x.r", "x.guard").drop("x")
    w = Window.partitionBy("r").orderBy("guard", "id", "t")
    return (rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .where(~F.col("guard")).drop("r", "guard", "id"))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited text, sketches of text, edited text and next document, and how alike they are.

    The edited text has its last floor(n_chars / 2) characters replaced by the
    first as many (or all) of the next document.
    """
    spark = docs.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    t = pick(docs, "doc_id", "text").select("doc_id", text_of().alias("t"))
    t = t.withColumn("sk", sketch(F.col("t")))
    t = with_next(t, ["t", "sk"], ranges)
    half = F.floor(F.length("t") / 2).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring("next_t", F.lit(1), half))
    t = t.select("doc_id", F.length("t").cast("long").alias("n_chars"), edited.alias("edited"), "sk", "next_sk")
    t = t.withColumn("edited_sk", sketch(F.col("edited")))
    return t.select("doc_id", "n_chars", "edited", "sk", "edited_sk", "next_sk",
                    resemblance(F.col("sk"), F.col("edited_sk")).alias("near_edited"),
                    resemblance(F.col("sk"), F.col("next_sk")).alias("near_next"),
                    containment(F.col("sk"), F.col("edited_sk")).alias("kept_in_edited"))
