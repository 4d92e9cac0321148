"""Near-duplicate groups by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Each text becomes a set of word-shingle hashes and a signature of ``SIG``
   minima, a byte each.  Texts with the same set are one class; only classes go on.
2. Forest: ``TREES`` orders of the signature's bytes.  Classes are sorted by the bytes in
   each order, and those next to each other share the longest prefixes.  A class and its
   neighbours are candidates as long as they share ``FIRST`` bytes; how deep the prefix goes
   beyond that follows from the region's density.  Candidates whose signatures agree in at
   least ``ROUGH`` of the bytes are edges; both are decided inside the sorted pass.
3. The first ``LEADING`` orders tie what is obviously near.  Their components are labels, and
   in the other orders a neighbour is the next class with another label: members of a large
   group are passed over, so a group of any size proposes no pairs of its own again.
4. A class looks at ``WIDTH`` such neighbours on each side.  If all of them share ``CROWDED``
   bytes the region is dense and more may follow: such classes, and only they, go through
   ``MORE`` further orders.  Where the last neighbour shares ``DEEP`` bytes even there,
   the classes are joined exactly, by a prefix filter on rare shingles.
5. Components of all edges are clusters.  Clusters only gather what must be
   compared, and decide nothing.
6. Exact step: each cluster's texts are compared on their full sets in chunks of
   about ``CHUNK`` classes with a few pivots of the cluster in every chunk.
   Texts that a chunk did not join to the cluster's largest component ask on: an
   equi-join on rare shingles (prefix filter with sizes and places, exact) finds
   whom they can be near to, and blocks of at most about ``ASKS`` asking texts and
   one chunk are compared on their shingle hashes.  A shingle that leads more than
   ``HOLDERS`` texts is not joined on, since its pairs grow with the square of their number:
   its texts are compared whole, in blocks of about ``LOAD`` shingles.  Only joining links leave a
   task, never all pairs of a group.

Two texts above the threshold are missed only if no chain of candidates puts
them into one cluster: for a pair alone, if it shares ``FIRST`` bytes in no order; in a dense region, if it shares
``DEEP`` in none of the further orders; the README has the measured shares.  Neighbours on two sides of a range's border are not seen in
that order.

Edge cases: null and blank texts have an empty set and are linked with nothing;
shorter texts than a shingle are one shingle; texts of any length are taken whole (one set of hashes in a
task); rows with null ids take part, and a group of null ids alone has a null component; rows that repeat an id are
kept or dropped alike; an empty table gives an empty result; other columns are left out before any is added.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, once_a_key, packed, pick, row_key, scratch_table, text_batches, unpacked, without_keys
from .components import components

SHINGLE = 5
PERCENT = 80
SIG = 64
TREES = 32
LEADING = 8             # orders whose components are labels for the others
FIRST = 4               # bytes that candidates share
CROWDED = 5             # bytes shared with the last neighbour looked at, from which a region is dense
MORE = 64               # further orders for dense regions
DEEP = 9                # bytes from which classes of a dense region are joined exactly
WIDTH = 2               # neighbours with another label on each side
ROUGH = 0.55
BLOCK = 1 << 16         # sorted entries that a task holds at a time
CARRY = 512             # and those it keeps from the block before
CHUNK = 256
PIVOTS = 8
ASKS = 128              # asking texts in a block
COUNTED = 256           # classes of a cluster on which shingles are counted, to order them
COMMON = 512            # shingles known to be common in a cluster
HOLDERS = 32            # texts that a shingle leads, beyond which it is not joined on
LOAD = 1 << 18          # shingles in a block of the texts that are compared whole
CELL_BITS = 20
KNOWN_WORDS = 1 << 16
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


class Shingler:
    """Text -> sorted distinct 64-bit hashes of its word shingles; words are cut at ASCII white space."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def word(self, w: bytes) -> int:
        import xxhash
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        h = self.known[w] = xxhash.xxh3_64_intdigest(w)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # lower-cases A-Z alone
        if not words:
            return np.zeros(0, np.uint64)
        known, word = self.known, self.word
        h = np.array([known.get(w) or word(w) for w in words], np.uint64)
        k = min(self.width, len(h))
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = (out ^ (h[i:i + n] * np.uint64(MIX[i % 5] + 2 * (i // 5)))) * np.uint64(MIX[0])
            out ^= out >> np.uint64(29)
        return np.unique(out)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240611)
    return (rng.integers(0, 1 << 63, SIG, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, SIG, dtype=np.uint64))


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(SIG, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):                       # blocks that stay in the cache
        np.minimum(low, (hashes[at:at + 256, None] * a + b).min(axis=0), out=low)
    low = (low ^ (low >> np.uint64(31))) * np.uint64(MIX[1])
    return (low >> np.uint64(56)).astype(np.uint8)


def _orders() -> np.ndarray:
    """The signature's places in each tree's order; the first ``FIRST`` places of consecutive trees differ."""
    rng = np.random.default_rng(20240612)
    deck, out = np.zeros(0, np.int64), []
    for _ in range(TREES + MORE):
        if len(deck) < FIRST:
            deck = rng.permutation(SIG)
        head, deck = deck[:FIRST], deck[FIRST:]
        out.append(np.concatenate([head, rng.permutation(np.setdiff1d(np.arange(SIG), head))]))
    return np.array(out)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """key, doc_id, n, cls (16 bytes, null for empty sets) and sig of every row."""
    def run(batches):
        import pyarrow as pa
        import xxhash
        make, (a, b) = Shingler(width), _permutations()
        for batch in batches:
            n, cls, sig = [], [], []
            for t in batch.column("text").to_pylist():
                h = make(t)
                n.append(len(h))
                cls.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                sig.append(signature(h, a, b).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())],
                ["key", "doc_id", "n", "cls", "sig"])
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "key binary, doc_id bigint, n bigint, cls binary, sig binary")


def _entries(classes: DataFrame, first: int, last: int) -> DataFrame:
    """tree, place (the signature in the tree's order), cls and label of every class (cls, sig, label) and tree."""
    def run(batches):
        import pyarrow as pa
        orders = _orders()[first:last]
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, SIG)
            for at in range(0, len(sig), 256):                  # 8,192 entries a batch
                part = sig[at:at + 256]
                rows = pa.array(np.tile(np.arange(at, at + len(part)), len(orders)))
                place = np.ascontiguousarray(part[:, orders].transpose(1, 0, 2)).reshape(-1, SIG)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(first, last, dtype=np.int32), len(part))), pa.array([p.tobytes() for p in place], pa.binary()),
                     batch.column("cls").take(rows), batch.column("label").take(rows)], ["tree", "place", "cls", "label"])
    return classes.select("cls", "sig", "label").mapInArrow(run, "tree int, place binary, cls binary, label bigint")


def _onward(place: np.ndarray, tree: np.ndarray, label: np.ndarray, width: int, deep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted entries i and j, j the first near one among the ``width`` next with another label; and the i in dense regions."""
    n = len(tree)
    cuts = np.append(np.flatnonzero(label[1:] != label[:-1]) + 1, n)
    end = cuts[np.searchsorted(cuts, np.arange(n), "right")]    # behind each entry's run of one label
    i, j, pairs, open_ = np.arange(n), end, [], np.ones(n, bool)
    for step in range(width):
        if step:
            j = j + 1
            same = (j < n) & (label[np.minimum(j, n - 1)] == label[i])
            j = np.where(same, end[np.minimum(j, n - 1)], j)
        here = (j < n) & (tree[np.minimum(j, n - 1)] == tree[i])
        i, j = i[here], j[here]
        equal = place[i] == place[j]
        depth = np.where(equal.all(axis=1), SIG, equal.argmin(axis=1))
        i, j, equal, depth = (x[depth >= FIRST] for x in (i, j, equal, depth))
        near = (equal.mean(axis=1) >= ROUGH) & open_[i]
        open_[i[near]] = False
        pairs.append(np.column_stack([i[near], j[near]]))
    pairs = np.concatenate(pairs)
    return pairs[:, 0], pairs[:, 1], i[depth >= deep]


def neighbours(entries: DataFrame, width: int = WIDTH, deep: int = CROWDED) -> DataFrame:
    """a, b: near neighbours (a < b) in the sorted orders; with b null: classes whose last neighbour shares ``deep`` bytes."""
    def run(batches):
        import pyarrow as pa

        def found(tree, place, cls, label):
            n, out, dense = len(tree), [], []
            for back in (False, True):
                x = [v[::-1] if back else v for v in (place, tree, label)]
                i, j, more = _onward(*x, width, deep)
                out.append(np.column_stack([i, j]) if not back else n - 1 - np.column_stack([j, i]))
                dense.append(n - 1 - more if back else more)
            at = np.concatenate(out)
            ends = np.sort(label[at], axis=1)                   # two labels are tied once a block
            at = at[np.unique(ends, axis=0, return_index=True)[1]]
            pairs = {(min(cls[i], cls[j]), max(cls[i], cls[j])) for i, j in at}
            return sorted(pairs) + [(c, None) for c in sorted({cls[i] for i in np.concatenate(dense)})]

        held, rows = [], 0
        empty = pa.RecordBatch.from_arrays([pa.array([], pa.int32()), *[pa.array([], pa.binary())] * 2, pa.array([], pa.int64())], ["tree", "place", "cls", "label"])
        for batch in (*batches, None):
            if batch is not None:
                held.append(batch)
                rows += batch.num_rows
                if rows < BLOCK:
                    continue
            table = pa.Table.from_batches(held or [empty]).combine_chunks()
            if table.num_rows:
                place = np.frombuffer(b"".join(table["place"].to_pylist()), np.uint8).reshape(-1, SIG)
                pairs = found(table["tree"].to_numpy(), place, table["cls"].to_pylist(), table["label"].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])
            held = table.slice(max(0, table.num_rows - CARRY)).to_batches()
            rows = sum(b.num_rows for b in held)
    order = ("tree", "place", "cls")
    return entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "a binary, b binary").distinct()


def _dense_edges(dense: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: pairs of the ``dense`` classes of different ties, by the exact prefix filter: all that are near are tied."""
    named = _with_texts(classes.join(dense.select(F.col("a").alias("cls")), "cls", "left_semi").select("cls", "key", "tie"), texts)
    named = named.select("cls", F.unhex(F.lit("")).alias("cluster"), F.col("tie").alias("label"), F.lit(0).alias("chunk"), F.lit(True).alias("asks"), "text")
    sets = scratch_table(_sets(named, width), "near_dense")
    led = _led(sets, percent)
    pairs = _candidates(sets, percent, led).select(F.col("q").alias("a"), F.col("o").alias("b"))
    return scratch_table(pairs.union(_confirm_crowded(sets, percent, led)), "near_dense_edges")


def _merged(known: DataFrame, edges: DataFrame) -> DataFrame:
    """``known`` (cls, sig, tie) with the ties that follow from further ``edges`` (a, b) between classes."""
    at = lambda c: known.select(F.col("cls").alias(c), F.col("tie").alias(f"t{c}"))
    between = edges.join(at("a"), "a").join(at("b"), "b").where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
    tops = components(between).select(F.col("node").alias("tie"), F.col("label").alias("top"))
    return scratch_table(known.join(tops, "tie", "left").withColumn("tie", F.coalesce("top", "tie")).drop("top"), "near_tied")


def forest(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls, tie) of the ``classes`` (cls, sig), and the classes (a) of dense regions that are to be joined exactly."""
    labelled = lambda x: x.select("cls", "sig", F.xxhash64("tie").alias("label"))
    known = classes.select("cls", "sig", F.col("cls").alias("tie"))
    leading = scratch_table(neighbours(_entries(labelled(known), 0, LEADING), 1, SIG), "near_ties").where("b IS NOT NULL")
    tied = components(leading).select(F.col("node").alias("cls"), F.col("label").alias("tie"))
    known = scratch_table(known.drop("tie").join(tied, "cls", "left").withColumn("tie", F.coalesce("tie", "cls")), "near_tied")
    found = scratch_table(neighbours(_entries(labelled(known), LEADING, TREES)), "near_neighbours")
    known = _merged(known, found.where("b IS NOT NULL"))
    dense = found.where("b IS NULL").select("a")
    if not dense.isEmpty():
        again = labelled(known).join(dense.select(F.col("a").alias("cls")), "cls", "left_semi")
        found = scratch_table(neighbours(_entries(again, TREES, TREES + MORE), deep=DEEP), "near_further")
        known = _merged(known, found.where("b IS NOT NULL"))
        dense = found.where("b IS NULL").select("a")
    return known.select("cls", "tie"), dense


def gathered(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """cls, cluster and m, the cluster's size, of the ``classes`` (cls, key, sig) that have to be compared with others."""
    known, dense = forest(classes)
    if not dense.isEmpty():
        known = _merged(known, _dense_edges(dense, classes.join(known, "cls"), texts, width, percent))
    clusters = known.select("cls", F.col("tie").alias("cluster"))
    many = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return scratch_table(clusters.join(many, "cluster"), "near_gathered")


def _with_texts(places: DataFrame, texts: DataFrame) -> DataFrame:
    """``places`` (cls, key, ..) with the text of each class's key; only texts that may be among them move."""
    cell = F.pmod(F.xxhash64("key"), F.lit(1 << CELL_BITS)).alias("cell")
    wanted = places.select(cell).distinct()                    # 2**CELL_BITS rows at most, whatever the input
    near = (texts.select(row_key().alias("key"), "text").withColumn("cell", cell)
            .join(F.broadcast(wanted), "cell", "left_semi").drop("cell"))
    return places.join(near, "key").dropDuplicates(["cls"]).drop("key")


def _similar(sets: list[np.ndarray], queries: range | list[int], percent: int):
    """For each query place, the places whose sets are near enough, by exact counts."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for q in queries:
        lo, hi = np.searchsorted(flat, sets[q], "left"), np.searchsorted(flat, sets[q], "right")
        runs = hi - lo
        places = np.repeat(lo - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
        common = np.bincount(owner[places], minlength=len(sets))
        yield q, np.flatnonzero(100 * common >= percent * (sizes + len(sets[q]) - common))


def _confirm(members: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: links that join what can be joined within each (cluster, chunk) of ``members`` (.., cls, text)."""
    def run(pdf):
        import pandas as pd
        make = Shingler(width)
        pdf = pdf.drop_duplicates("cls").sort_values("cls", ignore_index=True)
        ids, sets = list(pdf["cls"]), [make(t) for t in pdf["text"]]
        label = np.arange(len(ids))
        for q, near in _similar(sets, range(len(ids)), percent):
            low = label[near].min() if len(near) else label[q]
            label[np.isin(label, label[near])] = min(low, label[q])
        return pd.DataFrame({"a": [ids[x] for x in label], "b": ids})
    return members.groupBy("cluster", "chunk").applyInPandas(run, "a binary, b binary")


def _sets(named: DataFrame, width: int) -> DataFrame:
    """cls, cluster, label, chunk, asks, n and h (shingle hashes) of ``named`` (.., text)."""
    def run(batches):
        import pyarrow as pa
        make = Shingler(width)
        for b in batches:
            sets = [make(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("cls", "cluster", "label", "chunk", "asks")]
                + [pa.array([len(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                ["cls", "cluster", "label", "chunk", "asks", "n", "h"])
    return (named.select("cls", "cluster", "label", "chunk", "asks", "text")
            .mapInArrow(run, "cls binary, cluster binary, label binary, chunk int, asks boolean, n bigint, h array<bigint>"))


def _frequent(sets: DataFrame) -> DataFrame:
    """cluster, frequent: the commonest shingles of each cluster, rarest first, counted on about ``COUNTED`` of its classes."""
    sizes = scratch_table(sets.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / COUNTED).alias("lots")), "near_lots")
    some = sets.select("cls", "cluster", "h").join(sizes, "cluster").where(F.pmod(F.xxhash64("cls"), F.col("lots")) == 0)
    counts = some.select("cluster", F.explode("h").alias("h")).groupBy("cluster", "h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("f"), "h"))).where(F.col("r") <= COMMON)
    lists = top.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct(F.col("r"), "h")), False).alias("x"))
    return scratch_table(lists.select("cluster", F.col("x.h").alias("frequent")), "near_frequent")


def _heads(sets: DataFrame, percent: int) -> DataFrame:
    """The shingles of each set that may be the first one it shares with a near set, with their places."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            rows, at, h, least = [], [], [], []
            for k, (own, common) in enumerate(zip(batch.column("h").to_pylist(), batch.column("frequent").to_pylist())):
                own, n = np.asarray(own, np.int64), len(own)
                rank = np.full(n, -1)
                if common:
                    common = np.asarray(common, np.int64)
                    order = np.argsort(common)
                    place = np.minimum(np.searchsorted(common[order], own), len(common) - 1)
                    rank = np.where(common[order][place] == own, order[place], -1)
                head = n - (percent * n + 99) // 100 + 1
                own = own[np.lexsort((own, rank))][:head]
                rows.append(np.full(len(own), k))
                at.append(np.arange(len(own)))
                h.append(own)
                least.append(np.full(len(own), n - (2 * percent * n + 99 + percent) // (100 + percent) + 1))
            if rows:
                rows = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(rows) for c in ("cls", "cluster", "label", "asks", "n")],
                     *[pa.array(np.concatenate(x).astype(np.int64)) for x in (least, at, h)]], ["cls", "cluster", "label", "asks", "n", "least", "i", "h"])
    wide = sets.join(_frequent(sets), "cluster", "left").select("cls", "cluster", "label", "asks", "n", "h", "frequent")
    return scratch_table(wide.mapInArrow(run, "cls binary, cluster binary, label binary, asks boolean, n bigint, least bigint, i bigint, h bigint"), "near_heads")


def _led(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The ``_heads`` of the sets, and the crowded shingles (cluster, h): those that lead more than ``HOLDERS`` sets and may join two of them."""
    heads = _heads(sets, percent)
    per = heads.groupBy("cluster", "h").agg(F.count(F.lit(1)).alias("held"), F.max("asks").alias("asks"), F.max(F.col("i") < F.col("least")).alias("first"),
                                            F.min("label").alias("low"), F.max("label").alias("high"))
    return heads, scratch_table(per.where(F.col("held") > HOLDERS).where("asks AND first AND low <> high").select("cluster", "h"), "near_crowded")


def _candidates(sets: DataFrame, percent: int, led: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """cluster, q, o: asking classes and classes of other components that may be near them by a shingle that is not crowded.

    No near pair is left out but those that crowded shingles alone join (``_confirm_crowded``).  In each cluster the shingles stand in one order, the commonest last.  Of two sets that are near enough, the smaller
    has one of its first n - 2tn/(1+t) + 1 shingles among the larger one's first n - tn + 1, and the
    places of the first one they share leave room for the overlap needed.  Any order is exact; a good one gives few pairs.
    """
    heads, crowded = led or _led(sets, percent)
    p, heads = F.lit(percent), heads.join(crowded, ["cluster", "h"], "left_anti")
    side = lambda t: heads.select("cluster", "h", *[F.col(c).alias(f"{t}_{c}") for c in ("cls", "label", "asks", "n", "least", "i")])
    room = F.least(F.col("x_n") - F.col("x_i"), F.col("y_n") - F.col("y_i"))
    pairs = (side("x").where("x_i < x_least").join(side("y"), ["cluster", "h"])
             .where("(x_asks OR y_asks) AND x_label <> y_label")
             .where((F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_cls") < F.col("y_cls"))))
             .where((100 * F.col("x_n") >= p * F.col("y_n")) & ((100 + p) * room >= p * (F.col("x_n") + F.col("y_n")))))
    asking = lambda a, b: F.when(F.col("x_asks"), F.col(a)).otherwise(F.col(b))
    return pairs.select("cluster", asking("x_cls", "y_cls").alias("q"), asking("y_cls", "x_cls").alias("o")).distinct()


def _confirm_crowded(sets: DataFrame, percent: int, led: tuple[DataFrame, DataFrame]) -> DataFrame:
    """a, b: classes of different labels, tying all that are near and led by the same crowded shingle.

    Texts that share one, directly or by others, are a group.  Its asking texts and all its texts are dealt to blocks of about
    ``LOAD`` shingles, and each block of the ones meets each of the others in a task.  A task's links are no more than its labels.
    """
    def run(pdf):
        import pandas as pd
        ids, own = list(pdf["cls"]), [np.asarray(h, np.int64).view(np.uint64) for h in pdf["h"]]
        label, first = pd.factorize(pdf["label"])[0], {}
        for x, at in enumerate(label):
            first.setdefault(at, ids[x])
        root = label.copy()
        for _, near in _similar(own, np.flatnonzero(pdf["asked"].to_numpy()), percent):
            if len(near) and (root[near] != root[near[0]]).any():
                root[np.isin(root, root[near])] = root[near].min()
        tied = sorted({(r, at) for r, at in zip(root.tolist(), label.tolist()) if r != at})
        return pd.DataFrame({"a": [first[r] for r, _ in tied], "b": [first[at] for _, at in tied]})

    heads, crowded = led
    if crowded.isEmpty():
        return heads.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    shingle = F.concat("cluster", F.encode(F.concat(F.lit("h"), F.lpad(F.hex("h"), 16, "0")), "UTF-8"))        # no class is as long
    holders = heads.join(crowded, ["cluster", "h"]).select(F.col("cls").alias("a"), shingle.alias("b"))
    group = scratch_table(components(holders).select(F.col("node").alias("cls"), F.col("label").alias("group"))
                          .join(sets.select("cls", "label", "asks", "n"), "cls"), "near_crowds")
    load = lambda c: F.ceil(F.sum(c) / LOAD).cast("int")
    loads = group.groupBy("group").agg(load(F.when(F.col("asks"), F.col("n"))).alias("asking"), load("n").alias("others"))
    dealt = group.join(scratch_table(loads.where("asking > 0"), "near_loads"), "group")
    place = lambda c: F.pmod(F.xxhash64("cls"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asked = dealt.where("asks").select("group", "cls", place("asking").alias("block"), every("others").alias("other"), F.lit(True).alias("asked"))
    met = dealt.select("group", "cls", every("asking").alias("block"), place("others").alias("other"), F.lit(False).alias("asked"))
    members = asked.union(met).groupBy("group", "block", "other", "cls").agg(F.max("asked").alias("asked"))
    members = scratch_table(members, "near_crowds_met").join(sets.select("cls", "label", "h"), "cls")
    return members.groupBy("group", "block", "other").applyInPandas(run, "a binary, b binary")


def _confirm_rest(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links between asking classes and classes of other components of their cluster, each named by any of its classes."""
    def run(pdf):
        import pandas as pd
        ids, labels = list(pdf["cls"]), list(pdf["label"])
        own = [np.asarray(h, np.int64).view(np.uint64) for h in pdf["h"]]
        asked = np.flatnonzero(pdf["asked"].to_numpy())
        out = set()
        for q, near in _similar(own, asked, percent):
            out |= {(labels[q], labels[x]) for x in near if labels[x] != labels[q]}
        return pd.DataFrame(sorted(out), columns=["a", "b"])

    led = _led(sets, percent)
    found = scratch_table(_candidates(sets, percent, led), "near_candidates")
    counts = sets.where("asks").groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / ASKS).alias("blocks"))
    at = sets.select(F.col("cls").alias("o"), "chunk")
    dealt = (found.join(scratch_table(counts, "near_asking"), "cluster").join(at, "o")
             .select("cluster", "q", "o", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int").alias("block"), "chunk"))
    dealt = scratch_table(dealt, "near_dealt")
    members = [dealt.select("cluster", "block", "chunk", F.col(c).alias("cls"), F.lit(c == "q").alias("asked")) for c in "qo"]
    members = (members[0].union(members[1]).groupBy("cluster", "block", "chunk", "cls").agg(F.max("asked").alias("asked"))
               .join(sets.select("cls", "label", "h"), "cls"))
    links = members.groupBy("cluster", "block", "chunk").applyInPandas(run, "a binary, b binary")
    return links.union(_confirm_crowded(sets, percent, led))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, chunk: int = CHUNK, keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``; with ``keyed`` also its ``row_key`` and its group's ``label``."""
    texts = text_batches(pick(docs, "doc_id", "text"))
    rows = scratch_table(_signed(texts, width), "near_rows")
    classes = (rows.where("cls IS NOT NULL").groupBy("cls")
               .agg(F.min("doc_id").alias("low_id"), F.min("key").alias("key"), F.first("sig").alias("sig"), F.max("n").alias("n")))
    classes = scratch_table(classes, "near_classes")
    clusters = gathered(classes.select("cls", "key", "sig"), texts, width, percent)

    chunks = F.ceil(F.col("m") / chunk).cast("int")
    places = (clusters.join(classes.select("cls", "key"), "cls")
              .select("key", "cls", "cluster", chunks.alias("chunks"), F.pmod(F.xxhash64("cls"), chunks).cast("int").alias("chunk"),
                      ((chunks > 1) & (F.pmod(F.xxhash64("cls", F.lit(1)), F.ceil(F.col("m") / PIVOTS)) == 0)).alias("pivot")))
    members = scratch_table(_with_texts(scratch_table(places, "near_places"), texts), "near_members")

    everywhere = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))
    dealt = members.select("cluster", "cls", "text", F.explode(everywhere).alias("chunk"))
    links = scratch_table(_confirm(dealt, width, percent), "near_links")
    large = members.where("chunks > 1").select("cls", "cluster", "chunks", "chunk", "text")
    if large.isEmpty():
        joined = links.select(F.col("b").alias("cls"), F.col("a").alias("label"))
    else:
        found = components(links)
        label = lambda: found.select(F.col("node").alias("cls"), "label")
        named = scratch_table(large.join(label(), "cls", "left")
                              .withColumn("label", F.coalesce("label", "cls")), "near_named")
        parts = named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
        main = parts.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("x")).select("cluster", F.col("x.label").alias("main"))
        named = named.join(scratch_table(main, "near_main"), "cluster")
        asking = named.where("label <> main").select("cluster").distinct()
        named = named.withColumn("asks", F.col("label") != F.col("main")).join(scratch_table(asking, "near_asking"), "cluster", "left_semi")
        more = scratch_table(_confirm_rest(scratch_table(_sets(named, width), "near_sets"), percent), "near_more")
        joined = components(links.union(more)).select(F.col("node").alias("cls"), "label")
    named = (classes.select("cls", "low_id").join(scratch_table(joined.distinct(), "near_joined"), "cls", "left")
             .select("cls", "low_id", F.coalesce("label", "cls").alias("label")))
    named = scratch_table(named, "near_labels")
    lows = named.groupBy("label").agg(F.min("low_id").alias("component_id"))
    of_class = scratch_table(named.join(scratch_table(lows, "near_lows"), "label").select("cls", "label", "component_id"), "near_of_class")

    group = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = (rows.join(of_class, "cls", "left")
              .select("key", "label", "doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"),
                      F.col("doc_id").eqNullSafe(group).alias("kept")))
    return result if keyed else result.drop("key", "label")


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with its own columns, one row of each group; texts move only if they may go.

    The row with the smallest id stays (null ids last), and of rows that repeat its id and text
    one.  Texts without words are in no group and all stay.
    """
    found = near_duplicates(docs, width, percent, keyed=True).where("label IS NOT NULL")
    keys = scratch_table(found.groupBy("label", "key").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "near_keys")
    stays = keys.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("x")).select("label", F.col("x.key").alias("first"))
    chosen = keys.join(scratch_table(stays, "near_stays"), "label")
    gone = scratch_table(chosen.where("key <> first").select("key"), "near_gone")
    again = scratch_table(chosen.where("key = first AND n > 1").select("key"), "near_again")
    rows = packed(docs, "doc_id", "text").withColumn("key", row_key())
    worded = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    left = without_keys(rows.where(worded).select("key", "row_"), gone)
    once = once_a_key(left, again).unionByName(rows.where(~worded).select("key", "row_"))
    return unpacked(once, docs.columns)
