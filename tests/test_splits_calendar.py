"""Splits (exact sizes, selection) and calendar edge dates."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from zonepulse.functions import calendar as cal
from zonepulse.operators import splits


def test_kth_key_refines_exactly(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([10, 20, 20, 20, 30]) * 1000 + rnd.randint(0, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long")
    order = sorted((k, i) for i, k in rows)
    for k in (1, 1234, 2999, 3000):
        assert splits.kth_key(df, k, "k", "id", fan=8) == order[k - 1]
    assert splits.kth_key(df, 0, "k", "id") is None


def test_temporal_split_sizes_and_ties(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(days=i // 7)) for i in range(101)]  # 7-way time ties
    df = spark.createDataFrame(rows, "record_id long, datetime timestamp")
    out = splits.split_temporal(df, 0.2)
    train = sorted(r["record_id"] for r in out.filter(F.col("split") == "train").collect())
    assert train == list(range(80))


def test_stratified_exact_sizes_and_folds(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "record_id long, target int")
    s = splits.split_stratified(df, 0.2, "target")
    counts = {(r["target"], r["split"]): r["count"] for r in s.groupBy("target", "split").count().collect()}
    assert counts == {(0, "val"): 180, (0, "train"): 720, (1, "val"): 20, (1, "train"): 80}
    f = splits.fold_stratified(df, 5, "target")
    per = {(r["target"], r["fold"]): r["count"] for r in f.groupBy("target", "fold").count().collect()}
    assert all(per[(0, k)] == 180 and per[(1, k)] == 20 for k in range(5))


def test_rank_rows(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + (i * 7) % 20)) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id long, datetime timestamp")
    got = [(r["datetime"], r["record_id"], r["position"])
           for r in splits.rank_rows(df, "datetime", "record_id", ranges=7).collect()]
    got.sort(key=lambda x: x[2])
    assert [g[2] for g in got] == list(range(200))
    assert [(g[0], g[1]) for g in got] == sorted((g[0], g[1]) for g in got)


def test_calendar_edges(spark):
    days = ["2020-12-31", "2021-01-03", "2024-02-29", "2024-09-15", "2024-12-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.to_timestamp("d").alias("datetime"))
    a = cal.temporal_features(df).collect()
    b = cal.temporal_features_b(df).collect()
    assert [r["week_of_year"] for r in a] == [53, 53, 9, 37, 48]
    assert [r["day_of_week"] for r in a] == [3, 6, 3, 6, 6]
    assert [r["season"] for r in a] == ["dry", "dry", "dry", "short_rains", "dry"]
    assert [r["season"] for r in b] == ["short_rains", "dry", "dry", "dry", "short_rains"]
    assert cal.temporal_features_b(df, "missing").columns == df.columns
    t = spark.createDataFrame([("long_rains",)], "s string").select(cal.title_case("s")).first()[0]
    assert t == "Long_Rains"


def test_exact_quantile_matches_interpolated_percentile(spark):
    import numpy as np
    rnd = random.Random(2)
    vals = [rnd.choice([1.0, 2.0, 2.0, 7.0]) + rnd.random() * (i % 4) for i in range(2001)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    for q in (0.5, 0.1, 0.75):
        assert splits.exact_quantile(df, "x", q) == pytest.approx(float(np.quantile(vals, q)))
    assert splits.kth_value(df, "x", 1000, fan=8) == sorted(vals)[999]


def test_selection_on_heavy_ties_and_wide_ids(spark):
    """99.95 % zeros in two million rows, and ids that doubles can't tell apart."""
    df = spark.range(2_000_000).select(F.when(F.col("id") % 2000 == 0, F.col("id") + 1.0).otherwise(0.0).alias("x"))
    assert splits.exact_quantile(df, "x", 0.5) == 0.0
    assert splits.kth_value(df, "x", 1_999_001) == 1.0
    wide = spark.range(500).select((F.lit(1 << 62) + F.col("id")).alias("id"), (F.col("id") % 2).alias("k"))
    assert splits.kth_key(wide, 250, "k", "id") == (0, (1 << 62) + 498)
    assert splits.kth_key(wide, 251, "k", "id") == (1, (1 << 62) + 1)


def test_quantiles_of_several_columns_share_passes(spark):
    df = spark.createDataFrame([(i, float(i * i), None) for i in range(101)], "a int, b double, c double")
    assert splits.exact_quantiles(df, ["a", "b", "c"], 0.25) == {"a": 25.0, "b": 625.0, "c": None}


def test_rows_without_label_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "record_id long, target int")
    for out in (splits.split_stratified(df, 0.2, "target"), splits.fold_stratified(df, 5, "target")):
        assert out.count() == 100 and out.where("target IS NULL").count() == 10


def test_null_time_has_no_season(spark):
    df = spark.createDataFrame([(1, None)], "id int, datetime timestamp")
    for f in (cal.temporal_features, cal.temporal_features_b):
        r = f(df).first()
        assert r["season"] is None and r["is_weekend"] == 0


def test_one_hot_of_any_number_of_levels(spark):
    from zonepulse.operators import prep
    rows = [(i, f"area {i:05d}" if i else None, i % 2, None if i == 5 else float(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "record_id long, area string, target int, x double")
    table, columns, names = prep.feature_table(df)
    assert columns == ["x", "area_vec"] or columns == ["area_vec", "x"]
    assert len(names) == 1199 and table.count() == 1200
    by = {r["record_id"]: r for r in table.collect()}
    slots = [n for n in names if n != "x"]
    assert by[0]["area_vec"].numNonzeros() == 0 and by[1]["area_vec"].numNonzeros() == 0
    assert slots[int(by[7]["area_vec"].indices[0])] == "area_area 00007"
    assert by[5]["x"] == 600.0


def test_levels_are_numbered_without_the_driver(spark):
    """10^5 levels, one of them in a third of the rows: ranks in byte order, nothing listed on the driver."""
    from zonepulse.operators import prep
    n = 100_000
    df = spark.range(n).withColumn("area", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 7, "0"))))
    known = prep.level_slots(df.unionByName(df.withColumn("area", F.lit(None).cast("string"))), "area")
    assert known.count() == known.select("level").distinct().count() == 1 + n - (n + 2) // 3
    assert known.where("slot = 0").first()["level"] == "hot"
    off = known.alias("a").join(known.alias("b"), F.expr("a.slot = b.slot + 1")).where("a.level <= b.level").count()
    assert off == 0 and known.agg(F.max("slot")).first()[0] == known.count() - 1
    out, slots = prep.one_hot_vector(df, ["area"])
    v = {r["id"]: r["area_vec"] for r in out.where("id in (0, 1, 2, 99998)").collect()}
    assert v[0].numNonzeros() == 0 and list(v[1].indices) == [0] and list(v[2].indices) == [1] and v[1].size == known.count() - 1
    assert slots["area_vec"].where(F.col("slot") == 1).first()["feature"] == "area_é0000002"
    with pytest.raises(ValueError):
        prep.one_hot(df, ["area"])


def test_feature_names_read_like_a_list(spark):
    from zonepulse.operators import models, prep
    df = spark.createDataFrame([(i, f"z{i % 4}", "uv"[i % 2], float(i), 2.0, i % 2) for i in range(40)],
                               "record_id long, area string, side string, x double, y double, target int")
    table, columns, names = prep.feature_table(df)
    want = [n for c in columns for n in {"area_vec": ["area_z1", "area_z2", "area_z3"], "side_vec": ["side_v"]}.get(c, [c])]
    assert list(names) == want and names == want and len(names) == 6 and names[-1] == want[-1] and names[1:3] == want[1:3]
    assert "area_z3" in names and "area_z0" not in names and names != want[:-1]
    with pytest.raises(IndexError):
        names[6]
    model = models.fit(models.assemble(table, columns), "logistic_regression")
    got = [tuple(r) for r in models.feature_importance(model, names).collect()]
    assert got == [tuple(r) for r in models.feature_importance(model, want).collect()] and got[0][0] == "side_v" and len(got) == 6


def test_one_hot_of_columns_without_levels(spark):
    from zonepulse.operators import prep
    df = spark.createDataFrame([(1, None, "a", ""), (2, None, "a", "b"), (3, None, None, "b")], "id long, none string, one string, two string")
    out, slots = prep.one_hot_vector(df, ["none", "one", "two"])
    assert out.columns == ["id", "two_vec"] and list(slots) == ["two_vec"]
    assert {r["id"]: list(r["two_vec"].indices) for r in out.collect()} == {1: [], 2: [0], 3: [0]}
    out, slots = prep.one_hot_vector(df.limit(0), ["two"], fit_df=df)
    assert out.count() == 0 and slots["two_vec"].count() == 1
    out, _ = prep.one_hot_vector(df, ["two"], fit_df=df.where("id = 0"))
    assert out.columns == ["id", "none", "one"] and out.count() == 3


@pytest.mark.parametrize("bits", [2, 16])
def test_time_order_over_gaps_in_the_ids(spark, bits):
    from zonepulse.operators import summaries as S
    t0 = dt.datetime(2024, 1, 1)

    def ordered(rows):
        df = spark.createDataFrame([(i, t0 + dt.timedelta(days=d)) for i, d in rows], "record_id long, datetime timestamp")
        return S.in_time_order(df, bits=bits).first()[0]
    assert not ordered([(0, 5), (1, 6), (500_000, 2), (500_001, 3)])
    assert not ordered([(-(1 << 62), 5), (1 << 62, 2)])
    assert ordered([(-(1 << 62), 0), (0, 1), (1, 1), (500_000, 2), (1 << 62, 3)])


def test_selection_lists_small_intervals_only(spark):
    """The same value, rank and ties whether the last interval is listed or refined to the end."""
    df = spark.range(20_000).select((F.col("id") * 7919 % 3001).alias("v"), F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("w"))
    vs = sorted(i * 7919 % 3001 for i in range(20_000))
    ws = sorted(i / 7 for i in range(0, 20_000, 3))
    for k in (1, 77, 6000, 6667):
        want = {"v": (vs[k - 1], k - vs.index(vs[k - 1]), vs.count(vs[k - 1])), "w": (ws[k - 1], 1, 1)}
        for listed in (0, 50, 4096):
            assert splits.select_ranks(df, {"v": (F.col("v"), k), "w": (F.col("w"), k)}, fan=16, listed=listed) == want
    assert splits.select_ranks(df, {"v": (F.col("v"), 20_001)}) == {"v": None}
    assert splits.select_ranks(df, {"v": (F.col("v"), 5)}, sizes={"v": 3}) == splits.select_ranks(df, {"v": (F.col("v"), 5)})


def test_temporal_split_takes_few_passes(spark):
    """A written copy of the two columns, its count, two passes and a listing for the time, and one listing for the ids."""
    df = spark.range(30_000).select(F.col("id").alias("record_id"), F.timestamp_seconds(F.col("id") % 9000 * 600).alias("datetime"))
    tracker, group = spark.sparkContext.statusTracker(), "temporal-split"
    spark.sparkContext.setJobGroup(group, "passes")
    try:
        out = splits.split_temporal(df)
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 14, jobs         # a pass with a shuffle counts as two
    assert out.where("split = 'train'").count() == 24_000
