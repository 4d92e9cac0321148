"""Connected components of an edge table, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import scratch_table


def _written(df: DataFrame, name: str, what: Column) -> tuple[DataFrame, int]:
    """``df`` written as a scratch table, and how many rows fulfil ``what``, counted while writing."""
    seen = Observation()
    table = scratch_table(df.observe(seen, F.count_if(what).alias("n")), name)
    return table, int(seen.get["n"])


def _roots(hooks: DataFrame) -> DataFrame:
    """node, label with each label replaced by the end of its chain of labels, by pointer jumping."""
    while True:
        up = hooks.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = hooks.join(up, "label").select("node", F.col("label").alias("old"), F.col("above").alias("label"))
        after, changed = _written(jumped, "cc_roots", F.col("old") != F.col("label"))
        hooks = after.select("node", "label")
        if not changed:
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of ``edges`` (a, b); the label is the component's smallest node.

    A round hooks every node to its smallest neighbour if that is smaller (pre-aggregated, so
    a hub costs no single task), follows the chains to their roots, and contracts the edges
    to edges between roots, which are few after the first round.  Rounds end when no edge is left.
    """
    ends = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    e = scratch_table(edges.where("a <> b").select(*ends("a", "b")).distinct(), "cc_edges")
    result = None
    while True:
        both = e.union(e.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label"))
        roots = _roots(scratch_table(hooks, "cc_hooks"))
        if result is None:
            result = roots
        else:
            top = roots.select(F.col("node").alias("label"), F.col("label").alias("top"))
            result = scratch_table(result.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "cc_labels")
        at = lambda c: roots.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
        e, left = _written(e.join(at("a"), "a").join(at("b"), "b").where("la <> lb").select(*ends("la", "lb")).distinct(), "cc_edges", F.lit(True))
        if not left:
            return result
