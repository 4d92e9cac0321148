"""Fill-in-the-middle, the Merkle manifest and nearest neighbours against plain Python versions."""

import collections
import hashlib
import math
import os
import random
import re

import brute as B
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

pytest.importorskip("zonepulse.llm")
SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TEXTS = [None, "", " ", "word", "two words", "a<P>b", "x<S", "tail <", "<M", ">P> <", "é😀 ab\u0000c\nd", "ABC def GHI " * 300, "😀" * 5000, "x" * 30000,
         "Only Upper", "only lower", "<S>", "1 2 3", "\r\n\t"]


@pytest.fixture(scope="module")
def messy(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, and columns that clash."""
    rows = [(i * 3 - 4, t, random.Random(i).choice([None, "", "en", "de"]), random.Random(i).choice([None, "", "a", "é", "Z"]), i % 5 or None)
            for i, t in enumerate(TEXTS * 12)]
    rows += [(None, "no id", "en", "a", 1), (None, None, None, None, None)] + [(7, "same row", "en", "hot", 3)] * 40 + [(8, "lone", "en", "lone", 1), (2 ** 62 + 1, "large id", "en", "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["t", "i", "n", "form", "output", "digest", "shown", "row", "place", "range", "total", "block", "log", "places", "sibs", "DOC_ID2"]
    return rows, df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- fill in the middle

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def check_fim(rows, df):
    from zonepulse.llm.fim import fill_in_middle, restored
    got = fill_in_middle(df).withColumn("again", restored(F.col("form"), F.col("output"))).collect()
    show = lambda d, x, t: repr((d, *x, t or ""))
    want = collections.Counter(show(d, plain_fim(d, t), t) for d, t in rows)
    assert collections.Counter(show(r["doc_id"], (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]), r["again"]) for r in got) == want


def test_fim_messy(messy):
    check_fim([(r[0], r[1]) for r in messy[0]], messy[1])


@data
def test_fim_docs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_fim([(r["doc_id"], r["text"]) for r in docs.collect()], docs)


def test_fim_empty_table(empty):
    from zonepulse.llm.fim import fill_in_middle
    out = fill_in_middle(empty)
    assert out.count() == 0 and out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=600), st.integers(2, 20))
def test_skip_list_reaches_every_rank(widths, fan):
    from zonepulse.llm.fim import SkipList
    lanes = SkipList(np.array(widths, np.int64), fan)
    ends = [0, *np.cumsum(widths)] if widths else [0]
    assert [lanes.chars_before(r) for r in range(len(widths) + 1)] == ends


def test_skip_list_lanes_thin_out():
    from zonepulse.llm.fim import SkipList
    lanes = SkipList(np.ones(100_000, np.int64)).lanes
    sizes = [len(x[0]) for x in lanes]
    assert len(sizes) >= 4 and all(4 * b < a for a, b in zip(sizes, sizes[1:]))
    assert all(x[0].sum() == 100_000 for x in lanes)


def test_fim_other_markers_and_shares(spark):
    from zonepulse.llm.fim import fill_in_middle, restored
    marks = ("[a.]", "[b*]", "[c$]")
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("one two <P> three [a] b").alias("text"))
    out = fill_in_middle(df, seed=5, markers=marks, cut_percent=100, spm_percent=50)
    forms = {r["form"]: r["count"] for r in out.groupBy("form").count().collect()}
    assert set(forms) == {"psm", "spm"} and min(forms.values()) > 150
    assert out.where(restored(F.col("form"), F.col("output"), marks) != "one two <P> three [a] b").count() == 0


# ---- Merkle manifest

def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def up(nodes):
    """All levels above ``nodes``, themselves included."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def plain_leaf(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H("".join(part(v) for v in (doc_id, source, lang, n_chars, text)))


def plain_manifest(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[s] = up([plain_leaf(*r) for r in by[s]])
    top = up([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]) if r[1] is not None else None
            change = r[0] is not None and B.crc(str(r[0])) % 5 == 0
            own = cur = plain_leaf(*r)
            if change:
                cur = plain_leaf(r[0], low, *r[2:])
            sibs = []
            for tree, at in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    run = level[at - at % 16:at - at % 16 + 16]
                    place = at % 16
                    sibs += run[:place] + run[place + 1:]
                    cur = H("".join([*run[:place], cur, *run[place + 1:]]))
                    at //= 16
            out.append((r[0], own, trees[s][-1][0], root, H("".join(sibs)), cur, cur == root))
    return out


def check_manifest(rows, df, **kw):
    from zonepulse.llm.merkle import lower_ascii, manifest
    got = manifest(df, lower_ascii(F.col("text")), F.crc32(F.col("doc_id").cast("string")) % 5 == 0, **kw).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(plain_manifest(rows))
    return got


def test_manifest_messy(messy):
    got = check_manifest(*messy)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_many_tiers(messy):
    """Blocks of 16 nodes instead of 4,096: three tiers in a source of 600 rows."""
    rows = [(i, f"text {i} A", "en", "big" if i % 10 else f"s{i:03}", i) for i in range(600)]
    check_manifest(rows, messy[1].sparkSession.createDataFrame(rows, SCHEMA), climb=1)


def test_manifest_of_a_large_source(spark):
    rows = [(i, f"t{i}", None, "one", None) for i in range(9000)]
    check_manifest(rows, spark.createDataFrame(rows, SCHEMA).repartition(8))


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "X", "en", "a", 1) for i in range(n)]
    check_manifest(rows, spark.createDataFrame(rows, SCHEMA))


def test_manifest_empty_table(empty):
    from zonepulse.llm.merkle import manifest
    assert manifest(empty).count() == 0


def test_log_positions():
    from zonepulse.llm.merkle import append_log, levels, position
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4096):
        leaves = [H(str(i)) for i in range(n)]
        for climb in {levels(n), 3}:
            log, level, count = append_log(leaves, climb), leaves, n
            for k in range(climb + 1):
                assert [log[position(k, j, n, climb)] for j in range(count)] == level
                level = [H("".join(level[i:i + 16])) for i in range(0, count, 16)]
                count = len(level)


# ---- nearest neighbours

def plain_nearest(rows, k=10):
    """{query row number: [(distance, id)]} of (id, vector) rows that take part."""
    out = {}
    x = np.array([v for _, v in rows], np.float64)
    for q, (i, v) in enumerate(rows):
        if i % 100 == 0:
            d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            out[q] = sorted((d[j], rows[j][0]) for j in range(len(rows)) if j != q)[:k]
    return out


def check_nearest(rows, df, least, **kw):
    from zonepulse.llm.neighbours import nearest
    got = collections.defaultdict(list)
    for r in sorted(nearest(df, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    want, hit, n = plain_nearest(rows, kw.get("k", 10)), 0, 0
    by = collections.defaultdict(list)
    for q, near in want.items():
        by[rows[q][0]].append(near)
    assert set(got) <= set(by)
    for i, lists in by.items():
        if len(lists) > 1:          # a repeated query id: every list once
            assert len(got[i]) == sum(map(len, lists))
            continue
        near = lists[0]
        assert [r for r, _, _ in got[i]] == list(range(1, len(near) + 1))
        assert [(s, v) for _, s, v in got[i]] == sorted((s, v) for _, s, v in got[i])
        true = collections.Counter((round(d, 9), v) for d, v in near)
        hit += sum((true & collections.Counter((round(s, 9), v) for _, s, v in got[i])).values())
        n += len(near)
    assert hit >= least * n, (hit, n)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, KEY string")


@data
@pytest.mark.parametrize("kw", [{}, {"block": 40, "ways": 4, "sample": 64, "asks": 2}])
def test_nearest_in_the_table(spark, kw):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    check_nearest([(r["vec_id"], r["embedding"]) for r in df.collect()], df, 0.9, **kw)


def test_nearest_in_clusters_with_small_cells(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=24)).tolist()) for i in range(4000)]
    check_nearest(rows, frame(spark, rows, "double"), 0.95, block=64, ways=8, sample=128, asks=8)


def test_nearest_messy(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    hot = rng.normal(size=8).astype(np.float32).tolist()
    good += [(1000 + i, hot) for i in range(700)] + [(5, good[7][1]), (50, good[50][1]), (200, good[9][1])]
    bad = [(7000, None), (7100, []), (7200, [0.0] * 8), (7300, [None] + [1.0] * 7), (7400, [float("nan")] + [1.0] * 7), (7500, [math.inf] + [1.0] * 7),
           (7600, [1.0] * 5), (None, [1.0] * 8)]
    check_nearest(good, frame(spark, good + bad), 0.97)
    check_nearest(good, frame(spark, good + bad), 0.97, block=16, ways=4, sample=32, asks=4)


def test_nearest_of_few_vectors_and_none(spark):
    from zonepulse.llm.neighbours import nearest
    check_nearest([(0, [1.0, 2.0]), (3, [2.0, 2.0]), (2, [0.0, 2.0])], frame(spark, [(0, [1.0, 2.0]), (3, [2.0, 2.0]), (2, [0.0, 2.0])]), 1)
    assert nearest(frame(spark, [(100, [1.0])])).count() == 0
    assert nearest(frame(spark, [])).columns == ["query_id", "rank", "vec_id", "score"] and nearest(frame(spark, [])).count() == 0


def test_chi_square_factor():
    from zonepulse.llm.neighbours import chi_square, stop_factor
    assert abs(chi_square(18.307, 10) - 0.95) < 1e-4 and abs(stop_factor(0.99, 12) - 26.217) < 1e-2
