"""Train / validation / test splits and folds (inventory rows 30, 62, 74, 75).

No global window over the rows:

* selection (the k-th row in (time, id) order, medians) refines histograms:
  a round counts the rows below, at and between a few hundred bounds and goes
  on inside the open interval that holds the rank, until the rank falls on a
  bound itself or the interval's rows are few enough to be listed.  All columns
  and ranks share the passes of a round;
* stratified splits and folds rank rows inside (label, hash bucket)
  partitions; hash buckets are uniform, so a class holding most rows is
  spread over many tasks, and bucket offsets come from a table of counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 48          # fixed value: leading bits of the digest that orders ids
BUCKET_BITS = 16        # of which the first ones name the hash bucket
FAN = 256               # bounds per round of a selection
LISTED = 4096           # rows that an interval may hold when its values are listed on the driver
EXACT_DOUBLE = 1 << 53  # whole numbers up to this size are exact as doubles


def mix_hash(id_col: str, seed: int = 42) -> Column:
    """The leading 48 bits of md5("seed:id") as a long: any SQL engine computes the same value."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def select_ranks(df: DataFrame, targets: dict[str, tuple[Column, int]], fan: int = FAN, listed: int = LISTED, sizes: dict | None = None) -> dict:
    """For each name the value at a rank (1-based, nulls left out), the rank among its equals and their number.

    ``targets`` maps a name to (column expression, rank).  A rank outside the
    column gives None.  Each round makes two passes for all targets together:
    bounds (approximate quantiles; even steps for whole numbers that doubles
    can't tell apart), then an exact count of the rows in, and between, them.
    Intervals of at most ``listed`` rows end with one pass that lists their values;
    ``sizes`` tells how many rows a target starts with, where that is known.
    """
    kinds = {n: df.select(c.alias("v")).schema["v"].dataType for n, (c, _) in targets.items()}
    state = {n: {"rank": k, "lo": None, "hi": None, "rows": (sizes or {}).get(n)} for n, (_, k) in targets.items() if k >= 1}
    found: dict = {n: None for n in targets}
    quantiles = [j / fan for j in range(1, fan)]

    def inside(n: str) -> Column:
        v, st = targets[n][0], state[n]
        cond = v.isNotNull()
        if st["lo"] is not None:
            cond &= v > F.lit(st["lo"]).cast(kinds[n])
        if st["hi"] is not None:
            cond &= v < F.lit(st["hi"]).cast(kinds[n])
        return F.when(cond, v)

    while state:
        for kind in {kinds[n] for n, st in state.items() if st["rows"] is not None and st["rows"] <= listed}:
            few = [n for n, st in state.items() if kinds[n] == kind and st["rows"] is not None and st["rows"] <= listed]
            cells = F.array(*[F.struct(F.lit(i).alias("i"), inside(n).alias("v")) for i, n in enumerate(few)])
            values: dict = {}
            for r in (df.select(F.explode(cells).alias("c")).where("c.v IS NOT NULL")
                      .groupBy("c.i", "c.v").count().collect()):            # targets * listed rows at most
                values.setdefault(r["i"], []).append((r["v"], r["count"]))
            for i, n in enumerate(few):
                rank = state.pop(n)["rank"]
                for v, c in sorted(values.get(i, []), key=lambda x: (x[0] != x[0], x[0])):     # not-a-number last
                    if rank <= c:
                        found[n] = (v, rank, c)
                        break
                    rank -= c
        names = list(state)
        if not names:
            break
        aggs = []
        for n in names:
            aggs.append(F.struct(F.min(inside(n)).alias("lo"), F.max(inside(n)).alias("hi"),
                                 F.percentile_approx(inside(n), quantiles, 16 * fan).alias("q")).alias(f"s{len(aggs)}"))
        stats = df.agg(*aggs).first()
        cells, bounds = [], {}
        for i, n in enumerate(names):
            lo, hi, q = stats[i]["lo"], stats[i]["hi"], stats[i]["q"]
            if lo is None:                       # fewer values than the rank
                del state[n]
                continue
            whole = isinstance(kinds[n], T.IntegralType)
            if whole and max(abs(lo), abs(hi)) >= EXACT_DOUBLE:
                q = [lo + (hi - lo) * j // fan for j in range(fan + 1)]
            bounds[n] = sorted({lo, hi, *q})
            b = F.array(*[F.lit(x).cast(kinds[n]) for x in bounds[n]])
            v = inside(n)
            cells.append(F.struct(F.lit(i).alias("i"), _cell(b, v).alias("b")))
        if not cells:
            break
        counts: dict = {}
        for r in (df.select(F.explode(F.array(*cells)).alias("c")).where("c.b IS NOT NULL")
                  .groupBy("c.i", "c.b").count().collect()):          # targets * (2 * fan + 5) rows at most
            counts.setdefault(names[r["i"]], []).append((r["b"], r["count"]))
        for n in list(state):
            rank, edge = state[n]["rank"], bounds[n]
            for b, c in sorted(counts[n]):
                if rank <= c:
                    if b % 2:                    # on a bound
                        found[n] = (edge[b // 2], rank, c)
                        del state[n]
                    else:
                        state[n] = {"rank": rank, "lo": edge[b // 2 - 1], "hi": edge[b // 2], "rows": c}
                    break
                rank -= c
            else:
                del state[n]
    return found


def _cell(bounds: Column, v: Column) -> Column:
    """2 j + 1 on the j-th bound, 2 j between bounds j - 1 and j; null for null."""
    return F.when(v.isNotNull(), 2 * F.size(F.filter(bounds, lambda x: x < v))
                  + F.array_contains(bounds, v).cast("int"))


def kth_key(df: DataFrame, k: int, key_col: str, id_col: str, fan: int = FAN) -> tuple | None:
    """(key, id) of the k-th smallest row (1-based) in (key, id) order, or None if there is none."""
    at = select_ranks(df, {"key": (F.col(key_col), k)}, fan)["key"]
    if at is None:
        return None
    key, rank, c = at
    ties = df.where(F.col(key_col) == F.lit(key))
    return key, select_ranks(ties, {"id": (F.col(id_col), rank)}, fan, sizes={"id": c})["id"][0]


def split_temporal(df: DataFrame, test_size: float = 0.2, time_col: str = "datetime",
                   id_col: str = "record_id", out: str = "split") -> DataFrame:
    """Row 62: the oldest ``int(n * (1 - test_size))`` rows are ``train``, the rest ``test``.

    Ties in time are broken by ``id_col`` so the split is stable.  The passes of the selection
    read a written copy of the two columns alone.
    """
    from ..session import materialize
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    keyed = materialize(df.select(us.alias("_us"), F.col(id_col)))
    k = int(keyed.count() * (1 - test_size))
    cut = kth_key(keyed, k, "_us", id_col)
    if cut is None:
        return df.withColumn(out, F.lit("test"))
    t, i = cut
    is_train = (us < F.lit(t)) | ((us == F.lit(t)) & (F.col(id_col) <= F.lit(i)))
    return df.withColumn(out, F.when(is_train, F.lit("train")).otherwise(F.lit("test")))


def rank_within_class(df: DataFrame, label_col: str, id_col: str, seed: int = 42) -> DataFrame:
    """Add ``_rank`` (1-based) inside each class in (hash, id) order, plus ``_n_class``.

    Partitioned by (label, hash bucket); offsets of earlier buckets come from a table
    of counts per (label, bucket).  With 10^12 rows a bucket holds a few million rows,
    so even a class with a third of all rows is sorted in many small tasks.  Rows
    without a label are a class of their own.
    """
    x = df.withColumn("_h", mix_hash(id_col, seed)).withColumn(
        "_hb", F.shiftright("_h", HASH_BITS - BUCKET_BITS).cast("int"))
    counts = x.groupBy(label_col, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy(label_col).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(F.col(label_col).alias("_lab"), F.col("_hb").alias("_ob"),
                         F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy(label_col)).alias("_n_class"))
    x = x.join(offs, F.col(label_col).eqNullSafe(F.col("_lab")) & (F.col("_hb") == F.col("_ob")))
    w = Window.partitionBy(label_col, "_hb").orderBy("_h", id_col)
    return x.withColumn("_rank", F.col("_off") + F.row_number().over(w)).drop("_hb", "_off", "_lab", "_ob")


def split_stratified(df: DataFrame, share: float = 0.2, label_col: str = "target",
                     id_col: str = "record_id", seed: int = 42, out: str = "split",
                     names: tuple[str, str] = ("train", "val")) -> DataFrame:
    """Row 74: per class the first ``round(share * n_class)`` rows in hash order go to
    ``names[1]``; exact sizes, stable under repartitioning."""
    r = rank_within_class(df, label_col, id_col, seed)
    take = F.round(F.col("_n_class") * F.lit(share))
    return (r.withColumn(out, F.when(F.col("_rank") <= take, F.lit(names[1]))
                         .otherwise(F.lit(names[0])))
             .drop("_h", "_rank", "_n_class"))


def fold_stratified(df: DataFrame, k: int = 5, label_col: str = "target",
                    id_col: str = "record_id", seed: int = 42, out: str = "fold") -> DataFrame:
    """Row 75: shuffled, stratified k folds: fold = (rank in class - 1) mod k."""
    r = rank_within_class(df, label_col, id_col, seed)
    return r.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop(
        "_h", "_rank", "_n_class")


def pick_split(df: DataFrame, name: str, split_col: str = "split") -> DataFrame:
    """Row 30: rows of one split (a filter on the split column; no join)."""
    return df.filter(F.col(split_col) == name)


def rank_rows(df: DataFrame, time_col: str | list[str], id_col: str, out: str = "position",
              ranges: int | None = None) -> DataFrame:
    """0-based position in (time, id) order without a single-partition window.

    Range-partition on the total order (sampled bounds keep ranges balanced,
    and the unique id splits even a hot timestamp), count each range, turn the
    counts into offsets (one row per range: broadcast), number rows inside
    each range.
    """
    from ..session import materialize
    spark = df.sparkSession
    n_ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*([time_col] if isinstance(time_col, str) else time_col), id_col]
    # written once: the range of every row must be the same for the counts and the numbering
    ranged = materialize(df.repartitionByRange(n_ranges, *order).withColumn(
        "_rng", F.spark_partition_id()))
    counts = ranged.groupBy("_rng").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy().orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_rng", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_rng").orderBy(*order)
    return (ranged.join(F.broadcast(offs), "_rng")
                  .withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
                  .drop("_rng", "_off"))


def kth_value(df: DataFrame, col: str, k: int, fan: int = FAN):
    """The k-th smallest non-null value of ``col`` (1-based), or None."""
    at = select_ranks(df, {"v": (F.col(col), k)}, fan)["v"]
    return None if at is None else at[0]


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5) -> dict[str, float | None]:
    """Exact quantiles with linear interpolation (as SQL ``percentile`` / ``quantile_cont``) of
    several columns in shared passes; no column's values are gathered into one task."""
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    targets, place = {}, {}
    for i, c in enumerate(cols):
        if counts[i]:
            place[c] = (counts[i] - 1) * q
            lo = int(math.floor(place[c]))
            targets[f"{i}:lo"] = (F.col(c), lo + 1)
            if place[c] > lo:
                targets[f"{i}:hi"] = (F.col(c), lo + 2)
    got = select_ranks(df, targets) if targets else {}
    out: dict[str, float | None] = {}
    for i, c in enumerate(cols):
        if c not in place:
            out[c] = None
            continue
        low = float(got[f"{i}:lo"][0])
        high = float(got[f"{i}:hi"][0]) if f"{i}:hi" in got else low
        out[c] = low + (high - low) * (place[c] - math.floor(place[c]))
    return out


def exact_quantile(df: DataFrame, col: str, q: float = 0.5):
    """:func:`exact_quantiles` of one column."""
    return exact_quantiles(df, [col], q)[col]
