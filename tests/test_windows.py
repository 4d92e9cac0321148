"""Window core against a brute-force model of the reference's row loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonepulse.operators import windows as W

DAY = dt.timedelta(days=1)
US = dt.timedelta(microseconds=1)


def brute(rows):
    """rows: list of (record_id, zone, datetime). Returns dict id -> features."""
    out = {}
    for rid, z, t in rows:
        same = [(r, tt) for r, zz, tt in rows if zz == z]
        fut = {tt.date() for r, tt in same if t + DAY < tt <= t + 7 * DAY}
        p7 = {tt.date() for r, tt in same if t - 7 * DAY <= tt < t}
        p30 = {tt.date() for r, tt in same if t - 30 * DAY <= tt < t}
        prev = [tt for r, tt in same if tt < t]
        c7 = sum(1 for r, tt in same if tt > t - 7 * DAY and (tt, r) <= (t, rid))
        anyn = int(any(t < tt <= t + 7 * DAY for r, tt in same))
        before = sum(1 for r, tt in same if t - 7 * DAY <= tt < t)
        out[rid] = dict(future_outage_days=len(fut), outages_last_7d=len(p7),
                        outages_last_30d=len(p30),
                        days_since_last_outage=((t - max(prev)).days if prev else 999),
                        outage_count_7d=c7, target_any=anyn, events_prev_7d=before)
    # lag of the 7-day count along (time, id) inside each zone
    for z in {z for _, z, _ in rows}:
        seq = sorted((t, r) for r, zz, t in rows if zz == z)
        prev = None
        for t, r in seq:
            out[r]["outages_last_week"] = prev
            prev = out[r]["outage_count_7d"]
    return out


def make_df(spark, rows):
    return spark.createDataFrame([(r, z, t) for r, z, t in rows],
                                 "record_id long, cluster_id int, datetime timestamp")


def check(spark, rows, slot_us=W.HOUR_US):
    df = make_df(spark, rows)
    feats = W.zone_window_features(df, "cluster_id", "datetime", "record_id", rolling_days=(7,),
                                   rolling_lag=True, lookback_days=(7, 30), future=(7, 1),
                                   any_within_days=7, prev_event=True, count_before_days=7,
                                   slot_us=slot_us)
    got = {r["record_id"]: r for r in feats.collect()}
    exp = brute(rows)
    assert set(got) == set(exp)
    for rid, e in exp.items():
        g = got[rid]
        assert g["future_days"] == e["future_outage_days"], rid
        assert g["days_7d"] == e["outages_last_7d"], rid
        assert g["days_30d"] == e["outages_last_30d"], rid
        assert g["cnt_7d"] == e["outage_count_7d"], rid
        assert g["any_next"] == e["target_any"], rid
        assert g["cnt_before_7d"] == e["events_prev_7d"], rid
        assert g["lag_cnt_7d"] == e["outages_last_week"], rid
        prev_days = 999 if g["prev_us"] is None else \
            (g["datetime"].replace(tzinfo=None) - dt.datetime(1970, 1, 1)) // US
        if g["prev_us"] is not None:
            prev_days = (prev_days - g["prev_us"]) // (86_400_000_000)
        assert prev_days == e["days_since_last_outage"], rid


T0 = dt.datetime(2024, 3, 10, 15, 30, 0)


def test_lookahead_bounds(spark):
    # strict start (t+1d excluded), inclusive end (t+7d included)
    times = [T0, T0 + DAY, T0 + DAY + US, T0 + 7 * DAY, T0 + 7 * DAY + US]
    check(spark, [(i, 1, t) for i, t in enumerate(times)])


def test_lookback_bounds(spark):
    # inclusive start t-30d, strict end t; (t-7d, t] for the rolling count
    times = [T0 - 30 * DAY - US, T0 - 30 * DAY, T0 - 7 * DAY, T0 - 7 * DAY + US, T0]
    check(spark, [(i, 1, t) for i, t in enumerate(times)])


def test_ties_and_day_borders(spark):
    rows = [(1, 1, T0), (2, 1, T0), (3, 1, T0),
            (4, 1, dt.datetime(2024, 3, 11, 23, 59, 59, 999999)),
            (5, 1, dt.datetime(2024, 3, 12)), (6, 2, T0), (7, -1, T0 + DAY)]
    check(spark, rows)


def test_strict_threshold_three_and_four_days(spark):
    base = [T0 + k * DAY + dt.timedelta(hours=1) for k in range(2, 6)]  # 4 future days
    rows = [(0, 1, T0)] + [(i + 1, 1, t) for i, t in enumerate(base)]
    df = make_df(spark, rows)
    out = {r["record_id"]: r for r in W.target_high_activity(df).collect()}
    assert out[0]["future_outage_days"] == 4 and out[0]["target"] == 1
    rows3 = rows[:-1]
    out3 = {r["record_id"]: r for r in W.target_high_activity(make_df(spark, rows3)).collect()}
    assert out3[0]["future_outage_days"] == 3 and out3[0]["target"] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        z = rnd.randint(0, 4)
        t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 40 * 86400))
        if rnd.random() < 0.1 and rows:  # exact time ties
            t = rows[-1][2]
        rows.append((i, z, t))
    check(spark, rows)
    # a finer slot width gives the same answers
    check(spark, rows, slot_us=60_000_000)


def test_single_event_and_empty(spark):
    check(spark, [(1, 3, T0)])
    empty = make_df(spark, [])
    assert W.historical_features(empty).count() == 0


def test_days_since_row_ties_give_zero(spark):
    rows = [(1, 1, T0), (2, 1, T0), (3, 1, T0 + 2 * DAY + US)]
    out = {r["record_id"]: r["days_since_last_outage"]
           for r in W.days_since_row(make_df(spark, rows)).collect()}
    assert out == {1: 0, 2: 0, 3: 2}


def test_unknown_target_type(spark):
    with pytest.raises(ValueError):
        W.target_any(make_df(spark, [(1, 1, T0)]), "major_outage")


def test_rate_columns(spark):
    rows = [(i, 1, T0 + i * DAY) for i in range(10)]
    out = W.historical_features(make_df(spark, rows)).orderBy("record_id").collect()
    assert out[-1]["outages_last_7d"] == 7
    assert out[-1]["cluster_outage_rate_7d"] == pytest.approx(1.0)
    assert out[0]["days_since_last_outage"] == 999
    assert F is not None


def test_null_zone_is_one_zone(spark):
    rows = [(1, None, T0), (2, None, T0 + DAY + dt.timedelta(hours=2)), (3, 1, T0 + 2 * DAY),
            (4, None, T0 + 3 * DAY)]
    check(spark, rows)


def test_a_burst_in_one_zone(spark):
    rows = [(i, 7, T0 + dt.timedelta(seconds=37 * i)) for i in range(50)] + [(99, 8, T0)]
    check(spark, rows)
    check(spark, rows, slot_us=W.HOUR_US)


def test_rows_without_time_can_be_listed(spark):
    df = make_df(spark, [(1, 1, T0), (2, 1, None)])
    assert [r["record_id"] for r in W.rows_without_time(df).collect()] == [2]
    assert W.historical_features(df).count() == 1


def test_censored_flag(spark):
    rows = [(1, 1, T0), (2, 1, T0 + 2 * DAY), (3, 1, T0 + 10 * DAY)]
    out = {r["record_id"]: r for r in
           W.target_high_activity(make_df(spark, rows), censored=True).collect()}
    assert [out[i]["censored"] for i in (1, 2, 3)] == [False, False, True]
