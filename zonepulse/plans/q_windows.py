"""Queries for the window core (rows 31-32, 52-60, 63).

Oracles are brute-force range self-joins in DuckDB (the O(n^2) form the
reference loops compute), independent of the ledger plan used in Spark.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources.tables import load_view
from .registry import register

D = 86_400_000_000
US_A, US_B = "epoch_us(a.datetime)", "epoch_us(b.datetime)"
TIE_LE = f"({US_B} < {US_A} OR ({US_B} = {US_A} AND b.record_id <= a.record_id))"
Z = dict(zone_col="zone_id")


def _v(spark, sf, name):
    return load_view(spark, sf, name).select("record_id", "zone_id", "datetime")


@register("join_self_range", f"""
SELECT a.record_id, a.zone_id, CAST(count(b.record_id) AS BIGINT) AS events_prev_7d
FROM outages a LEFT JOIN outages b ON a.zone_id = b.zone_id
  AND {US_B} >= {US_A} - {7 * D} AND {US_B} < {US_A}
GROUP BY a.record_id, a.zone_id""", ("outages",))
def join_self_range(spark, sf):
    return W.events_before(_v(spark, sf, "outages"), 7, **Z).select(
        "record_id", "zone_id", "events_prev_7d")


@register("join_asof_prev", """
SELECT a.record_id, a.zone_id, max(b.datetime) AS prev_datetime
FROM orders_ev a LEFT JOIN orders_ev b ON a.zone_id = b.zone_id AND b.datetime < a.datetime
GROUP BY a.record_id, a.zone_id""", ("orders_ev",))
def join_asof_prev(spark, sf):
    return W.asof_previous(_v(spark, sf, "orders_ev"), **Z).select(
        "record_id", "zone_id", "prev_datetime")


@register("win_rolling_count", f"""
SELECT a.record_id, a.zone_id, CAST(count(*) AS BIGINT) AS outage_count_7d,
  count(*) / 7.0 AS outage_rate_7d
FROM orders_ev a JOIN orders_ev b ON a.zone_id = b.zone_id
  AND {US_B} > {US_A} - {7 * D} AND {TIE_LE}
GROUP BY a.record_id, a.zone_id""", ("orders_ev",))
def win_rolling_count(spark, sf):
    return W.win_rolling_count(_v(spark, sf, "orders_ev"), 7, **Z).select(
        "record_id", "zone_id", "outage_count_7d", "outage_rate_7d")


@register("win_rolling_rate", f"""
SELECT a.record_id, count(*) / 7.0 AS outage_rate_7d
FROM outages a JOIN outages b ON a.zone_id = b.zone_id
  AND {US_B} > {US_A} - {7 * D} AND {TIE_LE}
GROUP BY a.record_id""", ("outages",))
def win_rolling_rate(spark, sf):
    return W.win_rolling_count(_v(spark, sf, "outages"), 7, **Z).select(
        "record_id", "outage_rate_7d")


@register("win_lag_counts", f"""
SELECT record_id, zone_id,
  CAST(lag(c7) OVER w AS DOUBLE) AS outages_last_week,
  CAST(lag(c30) OVER w AS DOUBLE) AS outages_last_month
FROM (SELECT a.record_id, a.zone_id, a.datetime,
        count(*) FILTER (WHERE {US_B} > {US_A} - {7 * D}) AS c7, count(*) AS c30
      FROM orders_ev a JOIN orders_ev b ON a.zone_id = b.zone_id
        AND {US_B} > {US_A} - {30 * D} AND {TIE_LE}
      GROUP BY a.record_id, a.zone_id, a.datetime)
WINDOW w AS (PARTITION BY zone_id ORDER BY datetime, record_id)""", ("orders_ev",))
def win_lag_counts(spark, sf):
    return W.aggregation_features(_v(spark, sf, "orders_ev"), **Z).select(
        "record_id", "zone_id", "outages_last_week", "outages_last_month")


@register("win_lookback_days", f"""
SELECT a.record_id, a.zone_id,
  CAST(count(DISTINCT CASE WHEN {US_B} >= {US_A} - {7 * D} THEN CAST(b.datetime AS DATE) END) AS BIGINT)
    AS outages_last_7d,
  CAST(count(DISTINCT CAST(b.datetime AS DATE)) AS BIGINT) AS outages_last_30d,
  count(DISTINCT CASE WHEN {US_B} >= {US_A} - {7 * D} THEN CAST(b.datetime AS DATE) END) / 7.0
    AS cluster_outage_rate_7d,
  count(DISTINCT CAST(b.datetime AS DATE)) / 30.0 AS cluster_outage_rate_30d
FROM orders_ev a LEFT JOIN orders_ev b ON a.zone_id = b.zone_id
  AND {US_B} >= {US_A} - {30 * D} AND {US_B} < {US_A}
GROUP BY a.record_id, a.zone_id""", ("orders_ev",))
def win_lookback_days(spark, sf):
    return W.historical_features(_v(spark, sf, "orders_ev"), (7, 30), **Z).select(
        "record_id", "zone_id", "outages_last_7d", "outages_last_30d",
        "cluster_outage_rate_7d", "cluster_outage_rate_30d")


DAYS_SINCE_SQL = f"""
SELECT a.record_id, a.zone_id,
  CAST(coalesce(floor(({US_A} - max({US_B})) / {D}.0), 999) AS BIGINT) AS days_since_last_outage
FROM {{v}} a LEFT JOIN {{v}} b ON a.zone_id = b.zone_id AND {US_B} < {US_A}
GROUP BY a.record_id, a.zone_id, a.datetime"""


@register("win_days_since_prev", DAYS_SINCE_SQL.format(v="orders_ev"), ("orders_ev",))
def win_days_since_prev(spark, sf):
    return W.days_since_prev(_v(spark, sf, "orders_ev"), **Z).select(
        "record_id", "zone_id", "days_since_last_outage")


@register("win_days_since_row", f"""
SELECT record_id, zone_id,
  CAST(coalesce(floor((epoch_us(datetime) - lag(epoch_us(datetime)) OVER
    (PARTITION BY zone_id ORDER BY datetime, record_id)) / {D}.0), 0) AS BIGINT) AS days_since_last_outage
FROM outages""", ("outages",))
def win_days_since_row(spark, sf):
    return W.days_since_row(_v(spark, sf, "outages"), **Z).select(
        "record_id", "zone_id", "days_since_last_outage")


FUTURE_SQL = f"""
SELECT a.record_id, a.zone_id,
  CAST(count(DISTINCT CAST(b.datetime AS DATE)) AS BIGINT) AS future_outage_days,
  CAST(count(DISTINCT CAST(b.datetime AS DATE)) > 3 AS INTEGER) AS target
FROM {{v}} a LEFT JOIN {{v}} b ON a.zone_id = b.zone_id
  AND {US_B} > {US_A} + {D} AND {US_B} <= {US_A} + {7 * D}
GROUP BY a.record_id, a.zone_id"""


@register("win_future_days", FUTURE_SQL.format(v="orders_ev"), ("orders_ev",))
def win_future_days(spark, sf):
    return W.target_high_activity(_v(spark, sf, "orders_ev"), **Z).select(
        "record_id", "zone_id", "future_outage_days", "target")


@register("win_target_high", FUTURE_SQL.format(v="outages"), ("outages",))
def win_target_high(spark, sf):
    return W.target_high_activity(_v(spark, sf, "outages"), **Z).select(
        "record_id", "zone_id", "future_outage_days", "target")


@register("win_target_any", f"""
SELECT a.record_id, a.zone_id, CAST(count(b.record_id) > 0 AS INTEGER) AS target
FROM orders_ev a LEFT JOIN orders_ev b ON a.zone_id = b.zone_id
  AND {US_B} > {US_A} AND {US_B} <= {US_A} + {7 * D}
GROUP BY a.record_id, a.zone_id""", ("orders_ev",))
def win_target_any(spark, sf):
    return W.target_any(_v(spark, sf, "orders_ev"), **Z).select("record_id", "zone_id", "target")


@register("sort_zone_time", """
SELECT record_id, zone_id, datetime,
  CAST(row_number() OVER (PARTITION BY zone_id ORDER BY datetime, record_id) AS INTEGER) AS seq_in_zone
FROM orders_ev""", ("orders_ev",))
def sort_zone_time(spark, sf):
    # the per-zone sequence number is the sort made visible; output is range-sorted
    df = W.zone_window_features(_v(spark, sf, "orders_ev"), "zone_id", sequence=True)
    return df.orderBy("zone_id", "seq_in_zone")


@register("setop_union_groups", """
SELECT 'outages' AS source, zone_id, CAST(count(*) AS BIGINT) AS n FROM outages GROUP BY zone_id
UNION ALL
SELECT 'orders_ev' AS source, zone_id, CAST(count(*) AS BIGINT) AS n FROM orders_ev GROUP BY zone_id
""", ("outages", "orders_ev"))
def setop_union_groups(spark, sf):
    parts = [load_view(spark, sf, v).groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(v).alias("source"), "zone_id", "n") for v in ("outages", "orders_ev")]
    return parts[0].unionByName(parts[1])
