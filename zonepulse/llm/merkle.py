"""Merkle manifest of a dataset: a hash tree for each source, one over the sources, and proofs.

A row's leaf is the SHA-256 of its fields.  In a source, leaves ascend by id, and every
``FAN`` consecutive nodes become their parent until one is left, the source's subroot.  The
subroots, in the order of their sources, are the leaves of the upper tree, whose last node
is the dataset's root.

Builders work on aligned blocks: a block is 16**3 (``FAN ** CLIMB``) consecutive nodes of a tree, so
its three levels above need nothing from outside.  A builder appends nodes to a log in the
order in which they are complete (postorder), and the log is written as one value.  Block
roots are the nodes of the next tier, until a tree is one block.  No task holds more than a
block, and the tiers are as many as 4,096 has powers below the largest tree.

A proof needs the siblings on the way up.  Nothing is searched for: the postorder position of
node j of level l follows from the sizes of the complete subtrees in front of it
(``position``).  Proofs go down tier by tier: a block hands each of its nodes the siblings
from its own log and those that it was handed itself.

Positions inside a source come from range partitions over (source, id, leaf, row), so that
a source with a third of all rows, or one row repeated as often, is spread over many tasks.

Edge cases: nulls in any field have a mark of their own, so null and empty differ; a null
source is a source, ordered first; null ids come first in their source; rows that repeat an
id are ordered by their leaf, and wholly equal rows take neighbouring places; texts of any
length are hashed whole in the JVM; a lone leaf is its source's subroot and a lone subroot is
the root; an empty table gives an empty result; other columns are left out at once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, scratch_table

FAN = 16
CLIMB = 3                       # levels that a block builds over its 16**3 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "t string, block bigint, total bigint, n int, climb int, log binary, root string"
PATH = "t string, block bigint, places array<int>, sibs array<string>, subroot string, root string"
PROOF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def node(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value in a leaf: its length in bytes, a colon and its text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields=FIELDS, **other: Column) -> Column:
    """The leaf of a row as 32 bytes; ``other`` replaces fields."""
    return F.unhex(F.sha2(F.concat(*[field(other.get(f, F.col(f))) for f in fields]), 256))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- one block

def levels(n: int) -> int:
    """The levels above ``n`` leaves until one node is left."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def append_log(digests: list[str], climb: int) -> list[str]:
    """The block's nodes in the order of their completion; the last one is its root."""
    log, open_runs = [], [[] for _ in range(climb + 1)]

    def push(level: int, digest: str) -> None:
        log.append(digest)
        run = open_runs[level]
        run.append(digest)
        if level < climb and len(run) == FAN:
            close(level)

    def close(level: int) -> None:
        run = open_runs[level]
        open_runs[level] = []
        push(level + 1, node("".join(run)))

    for d in digests:
        push(0, d)
    for level in range(climb):      # the last run of a level may be short
        if open_runs[level]:
            close(level)
    return log


def position(level: int, j: int, n: int, climb: int) -> int:
    """Where node j of ``level`` stands in the log of a block with ``n`` leaves.

    In front of it are the nodes of its own and lower levels up to its last leaf, and those
    of higher levels that were complete before its first one.
    """
    first = j * FAN ** level
    end = min(first + FAN ** level, n)
    return (sum(-(-end // FAN ** k) for k in range(level + 1))
            + sum(first // FAN ** k for k in range(level + 1, climb + 1)) - 1)


def siblings(log: str, i: int, n: int, climb: int) -> tuple[list[int], list[str]]:
    """For each level above leaf i: its place in its run, and the run's other digests in one string."""
    places, sibs, count = [], [], n
    for level in range(climb):
        start = i - i % FAN
        run = [position(level, j, n, climb) * 64 for j in range(start, min(start + FAN, count)) if j != i]
        places.append(i - start)
        sibs.append("".join(log[p:p + 64] for p in run))
        i, count = i // FAN, -(-count // FAN)
    return places, sibs


def fold(digest: str, places, sibs) -> str:
    """The root that follows from a leaf and the siblings on its way up."""
    for at, others in zip(places, sibs):
        digest = node(others[:64 * at] + digest + others[64 * at:])
    return digest


# ---- Spark: positions, tiers, proofs

def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with i, their place in their tree t by ``order``, and total, the tree's number of rows.

    Rows are sorted once through range partitions and written; a row's place is its distance
    from the first row of its tree in its range, plus what earlier ranges hold of the tree.
    """
    ranged = rows.repartitionByRange("t", *order).sortWithinPartitions("t", *order)
    placed = scratch_table(ranged.withColumn("place", F.monotonically_increasing_id()), "merkle_placed")
    placed = placed.withColumn("range", F.shiftright("place", 33))
    parts = placed.groupBy("t", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c"))
    tree = Window.partitionBy("t")
    before = F.coalesce(F.sum("c").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = scratch_table(parts.select("t", "range", "first", before.alias("before"), F.sum("c").over(tree).alias("total")), "merkle_parts")
    return (placed.join(parts, ["t", "range"])
            .withColumn("i", F.col("before") + F.col("place") - F.col("first")).drop("place", "range", "first", "before"))


def _tiers(nodes: DataFrame, climb: int) -> list[DataFrame]:
    """The segments (one log a block) of every tier above ``nodes`` (t, i, total, digest)."""
    span = FAN ** climb

    def build(pdf):
        import pandas as pd
        pdf = pdf.sort_values("i")
        t, block, total, n = pdf["t"].iloc[0], int(pdf["block"].iloc[0]), int(pdf["total"].iloc[0]), len(pdf)
        up = levels(n) if total <= span else climb
        log = append_log([d.hex() for d in pdf["digest"]], up)
        return pd.DataFrame({"t": [t], "block": [block], "total": [total], "n": [n], "climb": [up],
                             "log": [bytes.fromhex("".join(log))], "root": [log[-1]]})

    out = []
    while True:
        blocks = nodes.select("t", "i", "total", "digest", F.floor(F.col("i") / span).alias("block"))
        out.append(scratch_table(blocks.groupBy("t", "block").applyInPandas(build, SEGMENT), "merkle_log"))
        more = out[-1].where(F.col("total") > span)
        if more.isEmpty():
            return out
        nodes = more.select("t", F.col("block").alias("i"), F.ceil(F.col("total") / span).alias("total"), F.unhex("root").alias("digest"))


def _roots(tiers: list[DataFrame], climb: int) -> DataFrame:
    """t, root of every tree."""
    parts = [x.where(F.col("total") <= FAN ** climb).select("t", "root") for x in tiers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _block_paths(tiers: list[DataFrame], above: DataFrame, climb: int) -> DataFrame:
    """PATH rows of the blocks of the lowest tier: what each of them needs from higher tiers and from
    ``above`` (t, places, sibs, subroot, root: what its tree's root needs)."""
    span = FAN ** climb

    def hand_down(pdf):
        import pandas as pd
        r = pdf.iloc[0]
        log, n, up, block = bytes(r["log"]).hex(), int(r["n"]), int(r["climb"]), int(r["block"])
        rows = []
        for i in range(n):
            places, sibs = siblings(log, i, n, up)
            rows.append((r["t"], block * span + i, places + [int(x) for x in r["places"]], sibs + list(r["sibs"]), r["subroot"], r["root"]))
        return pd.DataFrame(rows, columns=["t", "block", "places", "sibs", "subroot", "root"])

    paths = None
    for tier in reversed(tiers):
        own = tier.where(F.col("total") <= span).select("t", "block").join(above, "t").select("t", "block", "places", "sibs", "subroot", "root")
        paths = own if paths is None else paths.unionByName(own)
        if tier is not tiers[0]:
            wide = tier.select("t", "block", "n", "climb", "log").join(paths, ["t", "block"])
            paths = scratch_table(wide.groupBy("t", "block").applyInPandas(hand_down, PATH), "merkle_paths")
    return paths


def _proofs(rows: DataFrame, tiers: list[DataFrame], above: DataFrame, climb: int, prove, schema: str) -> DataFrame:
    """``prove(rows of a block, its segment with its path)`` for every block of the lowest tier."""
    wide = tiers[0].select("t", "block", "n", "climb", "log").join(_block_paths(tiers, above, climb), ["t", "block"])
    blocks = rows.withColumn("block", F.floor(F.col("i") / FAN ** climb))
    return blocks.groupBy("t", "block").cogroup(wide.groupBy("t", "block")).applyInPandas(prove, schema)


def manifest(docs: DataFrame, presented: Column | None = None, when: Column | None = None, fields=FIELDS, climb: int = CLIMB) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    ``presented`` is the text that a row shows when it is checked, on the rows where ``when``
    holds (a changed copy, say); elsewhere the row's own text.  ``folded_root`` is what follows
    from that and the original siblings, and a row is verified if it is the dataset's root.
    """
    span = FAN ** climb
    own = pick(docs, *dict.fromkeys([*fields, "doc_id", "source", "text"]))
    shown = F.when(when, leaf(fields, text=presented)) if presented is not None else F.lit(None).cast("binary")
    # a tree's key: sources by code point behind a letter, and the null source before them
    rows = own.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("t"), F.col("doc_id").cast("long").alias("doc_id"),
                      leaf(fields).alias("digest"), shown.alias("shown"), F.monotonically_increasing_id().alias("row"))
    rows = _numbered(scratch_table(rows, "merkle_leaves"), "doc_id", "digest", "row").drop("row")
    rows = scratch_table(rows, "merkle_rows")
    tiers = _tiers(rows, climb)

    subroots = _roots(tiers, climb).select(F.lit("").alias("t"), F.col("t").alias("source"), F.col("root").alias("subroot"), F.unhex("root").alias("digest"))
    sources = scratch_table(_numbered(scratch_table(subroots, "merkle_subroots"), "source"), "merkle_sources")
    upper = _tiers(sources, climb)
    nothing = (F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("sibs"))
    top = _roots(upper, climb).select("t", *nothing, F.lit("").alias("subroot"), "root")

    def hand(left, right):
        import pandas as pd
        r = right.iloc[0]
        log, n, up = bytes(r["log"]).hex(), int(r["n"]), int(r["climb"])
        out = []
        for source, subroot, i in zip(left["source"], left["subroot"], left["i"]):
            places, sibs = siblings(log, int(i) % span, n, up)
            out.append((source, places + [int(x) for x in r["places"]], sibs + list(r["sibs"]), subroot, r["root"]))
        return pd.DataFrame(out, columns=["t", "places", "sibs", "subroot", "root"])

    above = scratch_table(_proofs(sources, upper, top, climb, hand, PATH.replace(" block bigint,", "")), "merkle_above")

    def prove(left, right):
        import pandas as pd
        r = right.iloc[0]
        log, n, up = bytes(r["log"]).hex(), int(r["n"]), int(r["climb"])
        high, others = [int(x) for x in r["places"]], list(r["sibs"])
        out = []
        for doc_id, digest, other, i in zip(left["doc_id"], left["digest"], left["shown"], left["i"]):
            places, sibs = siblings(log, int(i) % span, n, up)
            places, sibs = places + high, sibs + others
            own = digest.hex()
            folded = fold(own if other is None else other.hex(), places, sibs)
            out.append((doc_id, own, r["subroot"], r["root"], node("".join(sibs)), folded, folded == r["root"]))
        return pd.DataFrame(out, columns=[x.split()[0] for x in PROOF.split(", ")])

    # ids travel as text: pandas would turn whole numbers beside nulls into doubles
    texts = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    return _proofs(texts, tiers, above, climb, prove, PROOF).withColumn("doc_id", F.col("doc_id").cast("long"))
