"""Match positions as column expressions: code point spans of a regular expression.

``split`` and ``regexp_extract_all`` cut a text into alternating gaps and
matches, whose summed lengths are the positions.  Sums are built in blocks, so
a text with n matches costs far less than n * n steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64
SPAN = "array<struct<s:int,e:int,m:string,before:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def preceding_sums(a: Column) -> Column:
    """For an array of ints: at each place the sum of what stands before it."""
    def in_blocks(v: Column) -> Column:
        n = F.ceil(F.size(v) / BLOCK).cast("int")
        blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                                           lambda b: _sum(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
                        ).otherwise(F.array().cast("array<int>"))
        return let(blocks, lambda bs: let(
            F.transform(bs, lambda _, i: _sum(F.slice(bs, F.lit(1), i))),
            lambda base: F.transform(v, lambda _, i: F.get(base, F.floor(i / BLOCK).cast("int"))
                                     + _sum(F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))))
    return let(a, in_blocks)


def match_spans(text: Column, regex: str, context: int = 0, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches: array of (s, e, m, before), e exclusive.

    ``before`` holds up to ``context`` characters between the match and the one
    before it.  ``guard`` may name a cheap condition without which nothing matches.
    """
    def spans(v: Column) -> Column:
        gaps, hits = v["gaps"], v["hits"]
        widths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
        return let(preceding_sums(widths), lambda base: F.transform(hits, lambda h, i: F.struct(
            (F.get(base, i) + F.length(F.get(gaps, i))).alias("s"),
            (F.get(base, i) + F.length(F.get(gaps, i)) + F.length(h)).alias("e"),
            h.alias("m"),
            (F.right(F.get(gaps, i), F.lit(context)) if context else F.lit("")).alias("before"))))
    found = F.rlike(text, F.lit(regex))
    return F.when(found if guard is None else guard & found,
                  let(F.struct(F.split(text, regex, -1).alias("gaps"),
                               F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("hits")), spans).cast(SPAN)
                  ).otherwise(F.array().cast(SPAN))


def label(spans: Column, kind: str) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(spans, lambda x: F.concat(F.lit(kind + ":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))


def overlaps(x: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["s"] < x["e"]) & (o["e"] > x["s"]))
