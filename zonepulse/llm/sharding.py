"""Sharding by a k-d tree over document metadata, balanced in bytes.

Equal texts form one group and stay together; a group weighs the bytes of all
its rows.  Groups are points with four coordinates (smallest id, bytes of one
text, hashes of source and language).  A node stands for a number of leaves, 8 at
the root.  A group as heavy as a leaf's share of its node takes one leaf alone;
the rest shares the other leaves.  Every node is split, by the leaves of its
halves, at the weighted quantile (the median where the leaves are even) of the
coordinate that is widest there against the whole table, level by level for all
nodes together, until each has one leaf.

Medians come from histograms, never from a sort: bytes are summed per (node,
bin), the bin in which the median falls is found in the node's bounded
histogram, and while it holds more than ``slack`` of the node's bytes only its
groups are binned again, by value and, among equal values, by group hash.  The
bin at the median goes to the side that leaves the halves nearer.

Slots number the rows of a shard without a gap: rows are counted per (shard,
hash cell), the bounded table of counts gives each cell its offset, and rows are
numbered within their cell.

Edge cases: null text has no bytes (size 1) and forms a group of its own; null
ids, sources and languages are coordinates of 0; one group larger than a shard
is kept whole and alone, so its shard exceeds the others, which stay even;
repeated rows are rows of one group; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import pick, scratch_table, text_of

LEVELS = 3
BINS = 4096
SLACK = 0.0005
CELLS = 4096
DIMS = ("d0", "d1", "d2", "d3")


def _group_rows(docs: DataFrame) -> DataFrame:
    t = pick(docs, "doc_id", "text", "source", "lang")
    size = (F.octet_length(text_of()) + 1).cast("long")
    hashed = lambda c: F.coalesce(F.crc32(F.col(c).cast("binary")), F.lit(0)).cast("double")
    return t.select(
        "doc_id", size.alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.unhex(F.md5("text"))).otherwise(F.lit(b"")).alias("group"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)).alias("d0"), size.cast("double").alias("d1"),
        hashed("source").alias("d2"), hashed("lang").alias("d3"))


def _medians(points: DataFrame, widths: DataFrame, leaves: dict[int, int], bins: int, slack: float) -> DataFrame:
    """Points with ``right``: whether they lie above the quantile that splits their node's leaves."""
    hash01 = F.pmod(F.xxhash64("group"), F.lit(1 << 52)).cast("double")
    value = F.element_at(F.array(*DIMS), F.col("dim"))
    pts = points.join(F.broadcast(widths), "node").select("group", "node", "weight", value.alias("v"), hash01.alias("h"))
    pts = scratch_table(pts, "kd_points")
    # per node: what the left half still lacks, and the open box (by value, then by hash)
    state = {r["node"]: {"need": r["total"] * (leaves[r["node"]] // 2) / leaves[r["node"]], "total": r["total"], "lo": r["lo"], "hi": r["hi"],
                         "by": "v", "at": None, "rules": []} for r in widths.collect()}
    rules: dict[int, dict] = {}
    while state:
        spark = points.sparkSession
        box = spark.createDataFrame(
            [(n, s["by"] == "h", float(s["lo"]), float(s["hi"]), float(s["at"] or 0.0)) for n, s in state.items()],
            "node int, by_hash boolean, lo double, hi double, at double")
        x = F.when(F.col("by_hash"), F.col("h")).otherwise(F.col("v"))
        cell = F.when(F.col("hi") > F.col("lo"),
                      F.least(F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0)
        hist = (pts.join(F.broadcast(box), "node")
                .where(~F.col("by_hash") | (F.col("v") == F.col("at")))
                .where((x >= F.col("lo")) & (x <= F.col("hi")))
                .groupBy("node", cell.cast("int").alias("cell"))
                .agg(F.sum("weight").alias("w"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(F.lit(1)).alias("n")))
        w = Window.partitionBy("node").orderBy("cell")
        upto = hist.withColumn("upto", F.sum("w").over(w))
        needs = spark.createDataFrame([(n, float(s["need"])) for n, s in state.items()], "node int, need double")
        found = (upto.join(F.broadcast(needs), "node").where(F.col("upto") >= F.col("need"))
                 .groupBy("node").agg(F.min_by(F.struct("upto", "w", "lo", "hi", "n"), "cell").alias("b")).collect())
        nxt = {}
        for r in found:
            n, b, s = r["node"], r["b"], state[r["node"]]
            below = b["upto"] - b["w"]
            small = b["w"] <= slack * s["total"] or b["n"] == 1
            if small or (b["lo"] == b["hi"] and s["by"] == "h"):
                take = b["upto"] - s["need"] < s["need"] - below
                edge = b["hi"] if take else b["lo"]
                rules[n] = {"by_hash": s["by"] == "h", "edge": float(edge), "closed": take, "at": float(s["at"] or 0.0)}
            elif b["lo"] == b["hi"]:
                nxt[n] = dict(s, need=s["need"] - below, by="h", at=b["lo"], lo=0.0, hi=float((1 << 52) - 1))
            else:
                nxt[n] = dict(s, need=s["need"] - below, lo=b["lo"], hi=b["hi"])
        state = nxt
    spark = points.sparkSession
    table = spark.createDataFrame([(n, r["by_hash"], r["edge"], r["closed"], r["at"]) for n, r in rules.items()],
                                  "node int, by_hash boolean, edge double, closed boolean, at double")
    past = lambda c: F.when(F.col("closed"), c > F.col("edge")).otherwise(c >= F.col("edge"))
    right = F.when(F.col("by_hash"), (F.col("v") > F.col("at")) | ((F.col("v") == F.col("at")) & past(F.col("h")))
                   ).otherwise(past(F.col("v")))
    return pts.join(F.broadcast(table), "node").select("group", right.alias("right"))


def _alone(points: DataFrame, leaves: dict[int, int]) -> tuple[DataFrame, list[tuple[bytes, int]]]:
    """Takes groups as heavy as a leaf's share out of ``points`` and out of their node's ``leaves``; returns (group, leaf) too.

    At most one group a leaf goes through the driver.
    """
    spark, placed = points.sparkSession, []
    while any(n > 1 for n in leaves.values()):
        total = {r["node"]: r["total"] for r in points.groupBy("node").agg(F.sum("weight").alias("total")).collect()}
        shares = spark.createDataFrame([(k, w / leaves[k]) for k, w in total.items() if leaves[k] > 1], "node int, share double")
        heavy = (points.join(F.broadcast(shares), "node").where(F.col("weight") >= F.col("share"))
                 .select("node", "group", "weight").collect())
        gone = []
        for r in sorted(heavy, key=lambda r: (-r["weight"], bytes(r["group"]))):
            k = r["node"]
            if leaves[k] > 1 and r["weight"] * leaves[k] >= total[k]:
                leaves[k] -= 1
                total[k] -= r["weight"]
                gone.append((bytes(r["group"]), k + leaves[k]))
        if not gone:
            break
        placed += gone
        out = spark.createDataFrame([(g,) for g, _ in gone], "group binary")
        points = scratch_table(points.join(F.broadcast(out), "group", "left_anti"), "kd_rest")
    return points, placed


def kd_shards(groups: DataFrame, levels: int = LEVELS, bins: int = BINS, slack: float = SLACK) -> DataFrame:
    """group, shard for ``groups`` (group, weight, d0..d3): ``2**levels`` leaves near equal in weight.

    A node is named by its first leaf.  The tables of nodes that go through the driver have at most
    ``2**levels`` rows.
    """
    spark = groups.sparkSession
    whole = groups.agg(*[(F.max(d) - F.min(d)).alias(d) for d in DIMS]).first()
    points, leaves, placed, done = groups.withColumn("node", F.lit(0)), {0: 2 ** levels}, [], []
    while True:
        points, alone = _alone(points, leaves)
        placed += alone
        ends = [k for k, n in leaves.items() if n == 1]
        done.append(points.where(F.col("node").isin(ends)).select("group", F.col("node").alias("shard")))
        leaves = {k: n for k, n in leaves.items() if n > 1}
        if not leaves:
            break
        points = points.where(~F.col("node").isin(ends))
        spread = points.groupBy("node").agg(
            F.sum("weight").alias("total"),
            *[F.struct((F.max(d) - F.min(d)).alias("span"), F.min(d).alias("lo"), F.max(d).alias("hi")).alias(d) for d in DIMS])
        width = [F.struct((F.col(f"{d}.span") / F.lit(float(whole[d] or 1.0))).alias("width"), F.lit(-i).alias("order"),
                          F.lit(i + 1).alias("dim"), F.col(f"{d}.lo").alias("lo"), F.col(f"{d}.hi").alias("hi"))
                 for i, d in enumerate(DIMS)]
        widths = (spread.select("node", "total", F.greatest(*width).alias("x"))
                  .select("node", "total", "x.dim", "x.lo", "x.hi"))
        widths = scratch_table(widths, "kd_widths")
        side = _medians(points, widths, leaves, bins, slack)
        first = spark.createDataFrame([(k, n // 2) for k, n in leaves.items()], "node int, step int")
        points = scratch_table(points.join(side, "group").join(F.broadcast(first), "node")
                               .withColumn("node", F.col("node") + F.when(F.col("right"), F.col("step")).otherwise(0))
                               .drop("right", "step").select(*groups.columns, "node"), "kd_nodes")
        leaves = {x: m for k, n in leaves.items() for x, m in ((k, n // 2), (k + n // 2, n - n // 2))}
    if placed:
        done.append(spark.createDataFrame(placed, "group binary, shard int"))
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def shard(docs: DataFrame, levels: int = LEVELS, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``docs``."""
    rows = scratch_table(_group_rows(docs), "kd_rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("weight"), F.min("d0").alias("d0"), F.min("d1").alias("d1"),
                                       F.min("d2").alias("d2"), F.min("d3").alias("d3"))
    leaf = kd_shards(scratch_table(groups, "kd_groups"), levels)
    cell = F.pmod(F.xxhash64("doc_id", "group"), F.lit(cells)).cast("int")
    placed = rows.select("doc_id", "size", "text_crc32", "group", cell.alias("cell")).join(leaf, "group")
    placed = scratch_table(placed.drop("group"), "kd_placed")
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("at", F.row_number().over(within))
            .join(F.broadcast(offsets), ["shard", "cell"])     # 2**levels * cells rows at most
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at") - 1).alias("slot")))
