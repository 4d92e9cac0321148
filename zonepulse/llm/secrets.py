"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

Candidates are maximal runs of a character class (hexadecimal, lower-case
alphanumeric, base64) of at least one window.  A window of ``WINDOW`` characters
slides along a candidate with a count per symbol; entering and leaving
characters change the counts and the sum of c * log2(c), so no window is counted
anew.  A candidate is a secret if no allow-list rule fits it whole and a window
outside its harmless stretches has at least its class's entropy.  Found spans
that overlap a pattern's span are not repeated, and those that overlap each other
(a token may fit several classes) are one span of the longest one's class.

Letters and separators alone are harmless only if they read as words: no long run
of consonants and no chain of one or two letters between capitals (``SCRAMBLED``).

Everything is a column expression; no row is moved.

Edge cases: null text is empty and has no spans; null ids and repeated rows are
kept as they are; very long candidates take one step a character; only doc_id and
text are read, so other columns can't clash; empty tables work.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, text_of
from .spans import let, match_spans, overlaps

KINDS = ("assign", "access", "hex")
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+")
ASSIGN_VALUE = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Class, its characters, bits a character in the densest window.
CLASSES = (
    ("entropy_hex", "0-9A-Fa-f", 3.0),
    ("entropy_lower", "0-9a-z", 3.6),
    ("entropy_base64", r"A-Za-z0-9+/_=-", 3.9),
)
#: Candidates that the allow list lets pass whole.
ALLOWED = (
    r"^[A-Za-z_-]+$",                                     # words and identifiers
    r"^[A-Za-z]+[0-9]{0,4}$",                             # a word with a short number
    r"^(?:[A-Za-z]+[0-9]{0,4}[/_-])+[A-Za-z]+[0-9]{0,4}$",  # paths and slugs
)
DIGITS = r"^[0-9+_=-]+$"                                  # digits and rules pass in any case
#: Fixed value: what words and identifiers don't hold, so the allow list passes nothing that has it.
SCRAMBLED = r"(?i:[bcdfghjklmnpqrstvwxz]{6,})|(?:[A-Z][a-z]{1,2}(?=[A-Z])){5,}|(?:[a-z][A-Z]{1,2}(?=[a-z])){5,}"
#: Stretches that no window may touch; what is left of a candidate is measured.
HARMLESS = r"(?i:example|sample|dummy|placeholder|changeme|x{6,}|0{8,}|1234567890|abcdefgh)|(.)\1{7,}"


def max_entropy(s: Column, window: int = WINDOW) -> Column:
    """Bits a character in the densest window of ``s`` (at least one window long)."""
    c_log_c = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    at = lambda c: F.get(c_log_c, c)
    empty = F.array_repeat(F.lit(0), len(ALPHABET) + 1)

    def slide(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            come, go = F.get(codes, i), F.when(i >= window, F.get(codes, i - window)).otherwise(-1)
            def counted(c: Column) -> Column:  # noqa: E306
                more = F.get(c, come) + F.when(come == go, 0).otherwise(1)
                less = F.get(c, F.greatest(go, F.lit(0)))
                total = (state["sum"] + F.when(come == go, 0.0).otherwise(
                    at(more) - at(more - 1) + F.when(go >= 0, at(less - 1) - at(less)).otherwise(0.0)))
                return F.struct(
                    F.transform(c, lambda x, k: x + F.when(k == come, 1).otherwise(0) - F.when(k == go, 1).otherwise(0)).alias("counts"),
                    total.alias("sum"),
                    F.when(i >= window - 1, F.least(state["best"], total)).otherwise(state["best"]).alias("best"))
            return let(state["counts"], counted)
        start = F.struct(empty.alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step,
                           lambda state: F.lit(math.log2(window)) - state["best"] / window)
    return let(F.transform(F.array_remove(F.split(s, ""), ""), lambda ch: F.instr(F.lit(ALPHABET), ch)), slide)


def allowed(m: Column) -> Column:
    """Whether the allow list lets the candidate pass whole."""
    digits = F.rlike(m, F.lit(DIGITS))
    return digits | (reduce(or_, [F.rlike(m, F.lit(p)) for p in ALLOWED]) & ~F.rlike(m, F.lit(SCRAMBLED)))


def one_a_token(spans: Column) -> Column:
    """Overlapping (s, e, kind) as one, with the kind of the longest (of equal ones: the class listed first)."""
    none = F.array().cast("array<struct<s:int,c:bigint,e:int,kind:string,n:int>>")
    ranked = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["s"], F.array_position(F.array(*[F.lit(k) for k, _, _ in CLASSES]), x["kind"]).alias("c"), x["e"], x["kind"],
        (x["e"] - x["s"]).alias("n"))))
    def add(acc: Column, x: Column) -> Column:  # noqa: E306
        last = F.element_at(acc, -1)
        whole = F.struct(last["s"], last["c"], F.greatest(last["e"], x["e"]).alias("e"),
                         F.when(x["n"] > last["n"], x["kind"]).otherwise(last["kind"]).alias("kind"), F.greatest(last["n"], x["n"]).alias("n"))
        return F.when((F.size(acc) > 0) & (last["e"] > x["s"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(whole))
                      ).otherwise(F.concat(acc, F.array(x)))
    return F.transform(F.aggregate(ranked, none, add), lambda x: F.struct(x["s"], x["e"], x["kind"]))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the spans of each fixed kind, and ``entropy``: (kind, s, e) of further spans by start."""
    t = pick(docs, "doc_id", "text").withColumn("t", text_of())
    t = t.withColumn("assign", F.filter(
        match_spans(F.col("t"), ASSIGN),
        lambda x: F.length(F.regexp_extract(x["m"], ASSIGN_VALUE, 1)) >= 6))
    t = t.withColumn("access", match_spans(F.col("t"), ACCESS, guard=F.contains("t", F.lit("AKIA"))))
    t = t.withColumn("hex", match_spans(F.col("t"), HEX))
    base = F.concat("assign", "access", "hex")
    for kind, chars, _ in CLASSES:
        runs = match_spans(F.col("t"), f"(?<![{chars}])[{chars}]{{{WINDOW},}}+")
        t = t.withColumn(kind, F.filter(runs, lambda x: ~allowed(x["m"])))
    t = t.withColumn("base", base)
    def measured(x: Column) -> Column:
        return F.filter(F.split(x["m"], HARMLESS), lambda p: F.length(p) >= WINDOW)
    def dense(kind: str, bits: float) -> Column:
        own = F.filter(F.col(kind), lambda x: ~overlaps(x, F.col("base")))
        return F.transform(F.filter(own, lambda x: F.exists(measured(x), lambda p: max_entropy(p) >= bits)),
                           lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind")))
    found = [dense(kind, bits) for kind, _, bits in CLASSES]
    return t.select("doc_id", *KINDS, one_a_token(F.concat(*found)).alias("entropy"))


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the listed span columns, by start and then by kind as listed."""
    def ranked(k: str, rank: int) -> Column:
        return F.transform(F.col(k), lambda x: F.struct(
            x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e"),
            (x["kind"] if k == "entropy" else F.lit(k)).alias("kind")))
    rows = F.concat(*[ranked(k, i) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(rows), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
