"""Nearest neighbours by low-dimensional stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected on ``M`` random Gaussian directions.  The normal law is 2-stable: if two
vectors are r apart, the squared distance of their projections is r**2 times a chi-square
variable with M degrees of freedom.  So once every vector whose projection lies within R of
the query's has been verified (its true distance computed), a vector nearer than the present
k-th distance d has been missed with a probability of at most 1 - chi2_M(R**2 / d**2).  A
search visits projections in the order of their distance and stops when that chi-square
value reaches ``SURE``.

1. Equal vectors are one point with the smallest k + 1 ids of its rows: no answer needs more,
   and a vector that a third of all rows repeat is as cheap as any other.  The rank that
   selects them is limited in each task before the shuffle.
2. Index: a kd-tree over the projections.  A tier cuts every cell of more than ``BLOCK``
   points into at most ``WAYS`` at medians along the widest direction, found on about
   ``SAMPLE`` points of the cell (chosen by hash; all points are indexed), until cells are
   small: the depth follows the input.  Points whose projections can't be told apart stay in one cell and
   are dealt to blocks of it by hash.
3. A query first searches the block it lies in.  That gives a k-th distance, the test a
   radius, and the tree, descended tier by tier, the other cells whose boxes the radius
   reaches.  Cells and the queries that reach them meet in groups of one block and at most
   ``ASKS`` queries.
4. In a group a small kd-tree of its own gives the projections in increasing distance, in
   steps that double; verified distances tighten the radius as the search goes on.

Distances are computed in double precision from the original vectors.  Neighbours are ranked
by distance, ties by id.

Edge cases: rows without an id, null, empty and zero vectors, and those with null or
non-finite components take no part; where lengths differ, the commonest one does (the
shortest of several); rows that repeat an id or a vector are candidates of their own, and a
query leaves out one row with its own id and vector; fewer candidates than k are all
returned; an empty table gives an empty result; other columns are left out at once.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, scratch_table

K = 10
M = 12                  # projected directions, an even number
SURE = 0.99             # chi-square value at which a search stops
BLOCK = 4096            # points of a cell or block
LEAF = 64               # points of a leaf in a block's own tree
WAYS = 64               # cells that a tier makes of one
SAMPLE = 2048           # points that a cell is cut by
ASKS = 512              # queries that meet a block in one group
SMALL_TIERS = 2         # tiers whose tables have at most WAYS**2 rows and are broadcast
SEED = 20240913


def chi_square(x: float, m: int = M) -> float:
    """The chi-square distribution function with ``m`` (even) degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def stop_factor(sure: float = SURE, m: int = M) -> float:
    """The least ratio of squared distances, projected to true, at which the test holds."""
    low, high = 0.0, 1.0
    while chi_square(high, m) < sure:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if chi_square(mid, m) >= sure else (mid, high)
    return high


# ---- a block's own tree and a query's search in it

def split_points(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """The rows of ``points`` in leaves of at most ``leaf``, by medians along the widest direction."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = points[rows]
        half = len(rows) // 2
        order = np.argpartition(own[:, int(np.argmax(np.ptp(own, axis=0)))], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


class Block:
    """Points with their projections, in the leaves of a kd-tree."""

    def __init__(self, vecs: np.ndarray, proj: np.ndarray, ids: list, leaf: int = LEAF):
        parts = split_points(proj, leaf) if len(proj) else []
        order = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.vecs, self.proj, self.ids = vecs[order].astype(np.float64), proj[order], [ids[i] for i in order]
        self.many = np.array([len(x) for x in self.ids], np.int64)
        self.ends = np.cumsum([len(p) for p in parts])
        self.starts = self.ends - [len(p) for p in parts]
        self.low = np.array([proj[p].min(axis=0) for p in parts])
        self.high = np.array([proj[p].max(axis=0) for p in parts])

    def search(self, vec: np.ndarray, proj: np.ndarray, need: int, factor: float, bound: float) -> list[tuple[float, int]]:
        """(squared distance, id) of the ``need`` nearest within the squared distance ``bound``, fewer if no more are found."""
        if not len(self.ids):
            return []
        gap = np.maximum(np.maximum(self.low - proj, proj - self.high), 0.0)
        reach = (gap * gap).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        found, dist = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 1
        while at < len(order) and reach[order[at]] <= factor * bound:      # else the stopping test holds
            take = [x for x in order[at:at + step] if reach[x] <= factor * bound]
            rows = np.concatenate([np.arange(self.starts[x], self.ends[x]) for x in take])
            gap = self.proj[rows] - proj
            rows = rows[(gap * gap).sum(axis=1) <= factor * bound]
            gap = self.vecs[rows] - vec
            found, dist = np.append(found, rows), np.append(dist, (gap * gap).sum(axis=1))
            best = np.argsort(dist, kind="stable")
            found, dist = found[best], dist[best]
            full = np.searchsorted(np.cumsum(self.many[found]), need)
            if full < len(found):
                bound = min(bound, dist[full])
            keep = np.searchsorted(dist, bound, "right")        # ties stay
            found, dist = found[:keep], dist[:keep]
            at, step = at + step, 2 * step
        return sorted((float(d), i) for d, row in zip(dist, found) for i in self.ids[row])[:need]


# ---- Spark: points, index, searches

def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec (array of doubles) of the rows that take part."""
    rows = pick(vectors, id_col, vec_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.coalesce(F.col("vec_id").isNotNull() & ~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.where(good)
    length = (rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("c"))
              .orderBy(F.desc("c"), "dim").first())
    return rows.where(F.size("vec") == (length["dim"] if length else 0))


def _points(rows: DataFrame, need: int, m: int, seed: int) -> DataFrame:
    """key, ids (the smallest ``need``), asks, v (bytes) and p (projections) of every distinct vector."""
    def pack(batches):
        import pyarrow as pa
        import xxhash
        for batch in batches:
            v = [(np.array(x, np.float64) + 0.0).tobytes() for x in batch.column("vec").to_pylist()]     # no negative zeros
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([xxhash.xxh3_128_digest(x) for x in v], pa.binary()), pa.array(v, pa.binary())], ["vec_id", "key", "v"])

    def project(batches):
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.float64).reshape(batch.num_rows, -1)
            p = x @ np.random.default_rng(seed).normal(size=(x.shape[1], m))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, m, dtype=np.int32)), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "ids", "asks", "v")], flat], ["key", "ids", "asks", "v", "p"])

    packed = scratch_table(rows.mapInArrow(pack, "vec_id bigint, key binary, v binary"), "nn_rows")
    first = packed.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("rank") <= need)
    points = first.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    asking = packed.where("vec_id % 100 = 0").select("key", "vec_id")
    asked = scratch_table(asking, "nn_queries")
    points = points.join(asked.select("key").distinct().withColumn("asks", F.lit(True)), "key", "left")
    points = points.select("key", "ids", F.coalesce("asks", F.lit(False)).alias("asks"), "v")
    points = points.mapInArrow(project, "key binary, ids array<bigint>, asks boolean, v binary, p array<double>")
    # the root cell is written with them: a literal would turn the equi-joins on cells into nested loops
    return scratch_table(points.withColumn("cell", F.lit(0).cast("long")), "nn_points"), asked


def _cuts(sample: DataFrame, ways: int, block: int) -> DataFrame:
    """cell, depth, dims, cuts: a tree in heap order for each cell of ``sample`` (cell, c, p)."""
    def fit(pdf):
        import pandas as pd
        p = np.stack(pdf["p"].to_numpy())
        depth = min(int(math.log2(ways)), max(1, math.ceil(math.log2(2 * pdf["c"].iloc[0] / block))))
        dims, cuts = [0] * 2 ** depth, [0.0] * 2 ** depth
        rows = {1: np.arange(len(p))}
        for at in range(1, 2 ** depth):
            own = p[rows[at]]
            if len(own):
                dims[at] = int(np.argmax(np.ptp(own, axis=0)))
                cuts[at] = float(np.median(own[:, dims[at]]))
            right = own[:, dims[at]] > cuts[at] if len(own) else np.zeros(0, bool)
            rows[2 * at], rows[2 * at + 1] = rows[at][~right], rows[at][right]
        return pd.DataFrame({"cell": [int(pdf["cell"].iloc[0])], "depth": [depth], "dims": [dims], "cuts": [cuts]})
    return sample.groupBy("cell").applyInPandas(fit, "cell bigint, depth int, dims array<int>, cuts array<double>")


def _indexed(points: DataFrame, ways: int, block: int, sample: int) -> tuple[DataFrame, int]:
    """``points`` with their cell of the tree, and the tree's tiers; the children of a cell are cell * ways and on."""
    at, n, tiers = points, points.count(), 0
    small = lambda t: F.broadcast(t) if tiers < SMALL_TIERS else t  # noqa: E731  at most ways**tiers rows
    most = math.ceil(math.log(max(n, 2) / block, ways)) + 2 if n > block else 0
    while tiers < most:
        counts = scratch_table(at.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > block), "nn_large")
        if counts.isEmpty():
            break
        share = F.pmod(F.xxhash64("key", F.lit(tiers)), F.lit(1 << 30)) < F.lit(float(sample << 30)) / F.col("c")
        cuts = scratch_table(_cuts(at.join(small(counts), "cell").where(share).select("cell", "c", "p"), ways, block), "nn_cuts")
        way = F.aggregate(F.sequence(F.lit(1), F.col("depth")), F.lit(1), lambda node, _: 2 * node + F.when(
            F.element_at("p", F.element_at("dims", node + 1) + 1) > F.element_at("cuts", node + 1), 1).otherwise(0))
        child = F.when(F.col("depth").isNull(), 0).otherwise(way - F.expr("shiftleft(1, depth)"))
        at = at.join(small(cuts), "cell", "left").withColumn("cell", F.col("cell") * ways + child).drop("depth", "dims", "cuts")
        at = scratch_table(at, "nn_cells")
        tiers += 1
    return at, tiers


def _boxes(at: DataFrame, tiers: int, ways: int, m: int, block: int) -> list[DataFrame]:
    """For each tier from the top: cell and its children (cell, box, blocks), at most ``ways`` of them."""
    low = F.array(*[F.min(F.col("p")[i]) for i in range(m)])
    high = F.array(*[F.max(F.col("p")[i]) for i in range(m)])
    blocks = F.ceil(F.count(F.lit(1)) / (2 * block)).cast("int")
    boxes = scratch_table(at.groupBy("cell").agg(low.alias("low"), high.alias("high"), blocks.alias("blocks")), "nn_boxes")
    out = []
    for _ in range(max(tiers, 1)):
        kids = boxes.withColumn("up", F.floor(F.col("cell") / ways))
        out.insert(0, scratch_table(kids.groupBy("up").agg(F.collect_list(F.struct("cell", "low", "high", "blocks")).alias("kids")), "nn_kids"))
        boxes = kids.groupBy("up").agg(F.array(*[F.min(F.col("low")[i]) for i in range(m)]).alias("low"),
                                       F.array(*[F.max(F.col("high")[i]) for i in range(m)]).alias("high"), F.lit(1).alias("blocks")).withColumnRenamed("up", "cell")
    return out


def _reached(asking: DataFrame, boxes: list[DataFrame], factor: float) -> DataFrame:
    """cell, block and query columns for every block whose cell the query's radius reaches, its own block left out."""
    gap = lambda x, i: F.greatest(x["low"][i] - F.col("p")[i], F.col("p")[i] - x["high"][i], F.lit(0.0))
    at = asking
    for tier, table in enumerate(boxes):
        table = F.broadcast(table) if tier <= SMALL_TIERS else table        # at most WAYS**tier rows
        far = lambda x: sum(gap(x, i) * gap(x, i) for i in range(M))
        at = (at.join(table, "up").withColumn("kid", F.explode("kids"))
              .where(far(F.col("kid")) <= F.lit(factor) * F.col("bound")).drop("kids").withColumn("up", F.col("kid.cell")))
    at = at.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("kid.blocks") - 1)))
    return (at.where((F.col("up") != F.col("cell")) | (F.col("b") != F.col("block")))
            .select(F.col("up").alias("cell"), F.col("b").alias("block"), "key", "v", "p", "bound"))


def _unpack(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", sure: float = SURE,
            block: int = BLOCK, ways: int = WAYS, sample: int = SAMPLE, asks: int = ASKS, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by 100."""
    need, factor = k + 1, stop_factor(sure)
    points, asked = _points(_valid(vectors, id_col, vec_col), need, M, seed)
    at, tiers = _indexed(points, ways, block, sample)
    boxes = _boxes(at, tiers, ways, M, block)
    blocks = boxes[-1].select(F.explode("kids").alias("x")).select(F.col("x.cell").alias("cell"), F.col("x.blocks").alias("blocks"))
    at = at.join(F.broadcast(blocks) if tiers <= SMALL_TIERS else blocks, "cell")
    at = scratch_table(at.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).drop("blocks"), "nn_index")
    found = "key binary, v binary, p array<double>, cell bigint, block int, up bigint, bound double, near array<struct<d:double,id:bigint>>"

    def at_home(pdf):
        import pandas as pd
        vecs, proj = _unpack(pdf["v"]), np.stack(pdf["p"].to_numpy())
        own = Block(vecs, proj, [list(x) for x in pdf["ids"]])
        rows = []
        for i in np.flatnonzero(pdf["asks"].to_numpy()):
            near = own.search(vecs[i], proj[i], need, factor, math.inf)
            rows.append((near[-1][0] if len(near) == need else math.inf, [{"d": d, "id": x} for d, x in near]))
        out = pdf[pdf["asks"]][["key", "v", "p", "cell", "block"]].copy()
        return out.assign(up=0, bound=[r[0] for r in rows], near=pd.Series([r[1] for r in rows], index=out.index, dtype=object))

    home = scratch_table(at.groupBy("cell", "block").applyInPandas(at_home, found), "nn_home")
    away = scratch_table(_reached(home.drop("near"), boxes, factor), "nn_reached")
    lots = away.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / asks).cast("int").alias("lots"))
    lots = scratch_table(lots, "nn_lots")
    there = at.join(lots, ["cell", "block"]).withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).select("cell", "block", "lot", "ids", "v", "p")
    away = away.join(lots, ["cell", "block"]).withColumn("lot", F.pmod(F.xxhash64("key"), F.col("lots")).cast("int")).drop("lots")

    def visit(left, right):
        import pandas as pd
        rows = []
        if len(left) and len(right):
            own = Block(_unpack(left["v"]), np.stack(left["p"].to_numpy()), [list(x) for x in left["ids"]])
            for key, vec, proj, bound in zip(right["key"], _unpack(right["v"]), right["p"], right["bound"]):
                rows += [(key, d, i) for d, i in own.search(vec, np.asarray(proj), need, factor, bound)]
        return pd.DataFrame(rows, columns=["key", "d", "id"])

    group = ["cell", "block", "lot"]
    more = there.groupBy(*group).cogroup(away.groupBy(*group)).applyInPandas(visit, "key binary, d double, id bigint")
    all_found = home.select("key", F.explode("near").alias("x")).select("key", "x.d", "x.id").unionByName(scratch_table(more, "nn_more"))
    ranked = all_found.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("d", "id"))).where(F.col("r") <= need)
    lists = ranked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("r", "d", "id"))).alias("near"))
    return _ranked(asked, scratch_table(lists, "nn_lists"), k)


def _ranked(asked: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """One row an answer; the query's own row is left out once."""
    own = F.array_position(F.transform("near", lambda x: (x["d"] == 0) & (x["id"] == F.col("vec_id"))), F.lit(True))
    rest: Column = F.filter("near", lambda x, i: i + 1 != F.col("own"))
    answers = asked.join(lists, "key").withColumn("own", own).select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(rest, 1, k)).alias("i", "x"))
    return answers.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.sqrt("x.d").alias("score"))
