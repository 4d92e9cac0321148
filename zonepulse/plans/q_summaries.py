"""Queries for summary tables (rows 28-30, 33-51, 61, 64)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import clean, summaries as S
from ..operators import windows as W
from ..sources.tables import load_view
from .q_calendar import SEASON_A_SQL
from .q_clean import PREPROCESS_SQL
from .registry import register

DATE = "strftime(datetime, '%Y-%m-%d')"


def _outages_c(spark, sf):
    """outages with the zone as cluster label."""
    return load_view(spark, sf, "outages").withColumnRenamed("zone_id", "cluster_id")


OUT_C = "(SELECT * EXCLUDE (zone_id), zone_id AS cluster_id FROM outages)"
CLEAN = f"({PREPROCESS_SQL})"


@register("agg_daily_counts", f"""
SELECT {DATE} AS date, CAST(count(*) AS BIGINT) AS n FROM {CLEAN} GROUP BY 1""", ("outages",))
def agg_daily_counts(spark, sf):
    d = S.daily_counts(clean.preprocess(load_view(spark, sf, "outages")))
    return d.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("agg_monthly_counts", """
SELECT strftime(date_trunc('month', datetime), '%Y-%m-%d') AS month_start, CAST(count(*) AS BIGINT) AS n
FROM orders_ev GROUP BY 1""", ("orders_ev",))
def agg_monthly_counts(spark, sf):
    m = S.monthly_counts(load_view(spark, sf, "orders_ev"))
    return m.withColumn("month_start", F.date_format("month_start", "yyyy-MM-dd"))


@register("agg_dow_counts", """
SELECT d.day_of_week, d.day_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(i AS INTEGER) AS day_of_week,
             ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i + 1] AS day_name
      FROM range(7) t(i)) d
LEFT JOIN (SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week, count(*) AS n
           FROM orders_ev GROUP BY 1) c USING (day_of_week)""", ("orders_ev",))
def agg_dow_counts(spark, sf):
    return S.dow_counts(load_view(spark, sf, "orders_ev"))


@register("agg_hour_counts", """
SELECT CAST(hour(datetime) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS n,
  count(*) OVER () > 1 AS many_hours
FROM outages GROUP BY 1""", ("outages",))
def agg_hour_counts(spark, sf):
    return S.hour_counts(load_view(spark, sf, "outages"))


@register("agg_month_of_year", """
SELECT d.month, d.month_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(i AS INTEGER) AS month,
             ['January','February','March','April','May','June','July','August','September',
              'October','November','December'][i] AS month_name FROM range(1, 13) t(i)) d
LEFT JOIN (SELECT CAST(month(datetime) AS INTEGER) AS month, count(*) AS n FROM orders_ev GROUP BY 1) c
USING (month)""", ("orders_ev",))
def agg_month_of_year(spark, sf):
    return S.month_of_year(load_view(spark, sf, "orders_ev"))


@register("agg_quarter", """
SELECT CAST(quarter(datetime) AS INTEGER) AS quarter, CAST(count(*) AS BIGINT) AS n
FROM orders_ev GROUP BY 1""", ("orders_ev",))
def agg_quarter(spark, sf):
    return S.quarter_counts(load_view(spark, sf, "orders_ev"))


@register("agg_year_quarter", """
SELECT CAST(year(datetime) AS INTEGER) AS year, CAST(quarter(datetime) AS INTEGER) AS quarter,
  CAST(count(*) AS BIGINT) AS n,
  CAST(year(datetime) AS VARCHAR) || '-Q' || CAST(quarter(datetime) AS VARCHAR) AS period
FROM orders_ev GROUP BY 1, 2, 4""", ("orders_ev",))
def agg_year_quarter(spark, sf):
    return S.year_quarter_counts(load_view(spark, sf, "orders_ev"))


@register("agg_cluster_counts", f"""
SELECT cluster_id, n, count(*) OVER () AS n_clusters, max(n) OVER () AS largest,
  min(n) OVER () AS smallest
FROM (SELECT cluster_id, CAST(count(*) AS BIGINT) AS n FROM {OUT_C} GROUP BY 1)""", ("outages",))
def agg_cluster_counts(spark, sf):
    return S.cluster_counts(_outages_c(spark, sf))


@register("agg_cluster_month_pivot", "SELECT zone_id AS cluster_id, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE month(datetime) = {m}) AS BIGINT) AS m{m}" for m in range(1, 13))
    + " FROM orders_ev GROUP BY 1", ("orders_ev",))
def agg_cluster_month_pivot(spark, sf):
    df = load_view(spark, sf, "orders_ev").withColumnRenamed("zone_id", "cluster_id")
    return S.cluster_month_pivot(df)


@register("join_cluster_summary", f"""
SELECT cluster_id, round(CAST(avg(CAST(latitude AS DECIMAL(38,15))) AS DOUBLE), 6) AS center_lat,
  round(CAST(avg(CAST(longitude AS DECIMAL(38,15))) AS DOUBLE), 6) AS center_lon,
  CAST(count(*) AS BIGINT) AS n
FROM {OUT_C} WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND cluster_id IS NOT NULL
GROUP BY cluster_id""", ("outages",))
def join_cluster_summary(spark, sf):
    s = S.cluster_summary(_outages_c(spark, sf), exact=True)
    return s.withColumns({"center_lat": F.round("center_lat", 6), "center_lon": F.round("center_lon", 6)})


@register("agg_cluster_centers", f"""
SELECT cluster_id, round(CAST(avg(CAST(latitude AS DECIMAL(38,15))) AS DOUBLE), 4) AS center_lat,
  round(CAST(avg(CAST(longitude AS DECIMAL(38,15))) AS DOUBLE), 4) AS center_lon,
  CAST(count(*) AS BIGINT) AS n
FROM {OUT_C} WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND cluster_id IS NOT NULL
GROUP BY cluster_id ORDER BY cluster_id LIMIT 10""", ("outages",))
def agg_cluster_centers(spark, sf):
    return S.cluster_centers_top(_outages_c(spark, sf), 10, exact=True)


@register("agg_map_points", f"""
SELECT record_id, cluster_id, latitude, longitude, 'marker' AS layer FROM {OUT_C}
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND cluster_id <> -1
UNION ALL
SELECT record_id, cluster_id, latitude, longitude, 'heat' AS layer FROM {OUT_C}
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", ("outages",))
def agg_map_points(spark, sf):
    df = _outages_c(spark, sf).select("record_id", "cluster_id", "latitude", "longitude")
    return S.map_points(df)


@register("agg_density_grid", """
SELECT CAST(floor(latitude / 0.1) AS BIGINT) AS cell_lat, CAST(floor(longitude / 0.1) AS BIGINT) AS cell_lon,
  CAST(count(*) AS BIGINT) AS n
FROM outages WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""", ("outages",))
def agg_density_grid(spark, sf):
    return S.density_grid(load_view(spark, sf, "outages"), 0.1)


@register("agg_data_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS total_records,
  strftime(min(datetime), '%Y-%m-%d') AS date_range_start,
  strftime(max(datetime), '%Y-%m-%d') AS date_range_end,
  CAST((SELECT count(*) FROM (SELECT DISTINCT latitude, longitude FROM outages)) AS BIGINT) AS unique_coordinates,
  min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max,
  CASE WHEN floor((epoch_us(max(datetime)) - epoch_us(min(datetime))) / 86400000000.0) > 0
       THEN count(*) / floor((epoch_us(max(datetime)) - epoch_us(min(datetime))) / 86400000000.0) END
    AS records_per_day
FROM outages""", ("outages",))
def agg_data_summary(spark, sf):
    return S.data_summary(load_view(spark, sf, "outages"))


def _quality_sql(view: str, ordered_col: str = "record_id") -> str:
    return f"""
SELECT true AS has_required_columns,
  coalesce(bool_and(coalesce(latitude IS NOT NULL AND longitude IS NOT NULL, false)), true) AS no_missing_coordinates,
  coalesce(bool_and(coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false)), true) AS valid_coordinate_ranges,
  coalesce(bool_and(datetime IS NOT NULL), true) AS no_missing_timestamps,
  (SELECT coalesce(bool_and(coalesce(datetime >= prev, true) AND datetime IS NOT NULL), true)
   FROM (SELECT datetime, lag(datetime) OVER (ORDER BY {ordered_col}) AS prev FROM {view})) AS chronological_order,
  count(*) >= 100 AS reasonable_sample_size,
  coalesce(bool_and(coalesce(latitude BETWEEN -5 AND 6 AND longitude BETWEEN 33 AND 42, false)), true) AS within_kenya_bounds
FROM {view}"""


@register("agg_quality_checks", _quality_sql("outages"), ("outages",))
def agg_quality_checks(spark, sf):
    return S.quality_checks(load_view(spark, sf, "outages"))


@register("agg_quality_checks_unordered", _quality_sql(
    "(SELECT *, -1.0 AS latitude, 35.0 AS longitude FROM orders_ev)"), ("orders_ev",))
def agg_quality_checks_unordered(spark, sf):
    df = load_view(spark, sf, "orders_ev").withColumns(
        {"latitude": F.lit(-1.0), "longitude": F.lit(35.0)})
    return S.quality_checks(df)


KPI_SQL = f"""
WITH d AS (SELECT CAST(datetime AS DATE) AS date, count(*) AS n FROM {OUT_C} GROUP BY 1),
     a AS (SELECT area, count(*) AS n FROM {OUT_C} GROUP BY 1)
SELECT CAST((SELECT sum(n) FROM d) AS BIGINT) AS total_outages,
  (SELECT strftime(min(date), '%Y-%m-%d') FROM d) AS date_start,
  (SELECT strftime(max(date), '%Y-%m-%d') FROM d) AS date_end,
  (SELECT avg(n) FROM d) AS avg_daily,
  (SELECT strftime(date, '%Y-%m-%d') FROM d ORDER BY n DESC, date LIMIT 1) AS peak_day,
  CAST((SELECT max(n) FROM d) AS BIGINT) AS peak_count,
  CAST((SELECT count(DISTINCT cluster_id) FROM {OUT_C}) AS BIGINT) AS n_clusters,
  (SELECT area FROM a ORDER BY n DESC, area LIMIT 1) AS top_area,
  CAST((SELECT max(n) FROM a) AS BIGINT) AS top_area_count"""


@register("agg_kpis", KPI_SQL, ("outages",))
def agg_kpis(spark, sf):
    return S.kpis(_outages_c(spark, sf)).withColumn("avg_daily", F.col("avg_daily"))


@register("agg_basic_stats", f"""
WITH s AS (SELECT count(*) AS rows, min(datetime) AS t0, max(datetime) AS t1,
             min(latitude) AS lat_min, max(latitude) AS lat_max,
             min(longitude) AS lon_min, max(longitude) AS lon_max FROM {OUT_C}),
     c AS (SELECT count(*) AS n_clusters, max(n) AS largest, min(n) AS smallest
           FROM (SELECT cluster_id, count(*) AS n FROM {OUT_C} GROUP BY 1))
SELECT 'overview' AS section, 'rows' AS metric, CAST(rows AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM s
UNION ALL SELECT 'overview', 'columns', 6.0, NULL FROM s
UNION ALL SELECT 'temporal', 'start', NULL, strftime(t0, '%Y-%m-%d %H:%M:%S') FROM s
UNION ALL SELECT 'temporal', 'end', NULL, strftime(t1, '%Y-%m-%d %H:%M:%S') FROM s
UNION ALL SELECT 'temporal', 'duration_days', floor((epoch_us(t1) - epoch_us(t0)) / 86400000000.0), NULL FROM s
UNION ALL SELECT 'geographic', 'lat_min', round(lat_min, 4), NULL FROM s
UNION ALL SELECT 'geographic', 'lat_max', round(lat_max, 4), NULL FROM s
UNION ALL SELECT 'geographic', 'lon_min', round(lon_min, 4), NULL FROM s
UNION ALL SELECT 'geographic', 'lon_max', round(lon_max, 4), NULL FROM s
UNION ALL SELECT 'clusters', 'n_clusters', n_clusters, NULL FROM c
UNION ALL SELECT 'clusters', 'largest', largest, NULL FROM c
UNION ALL SELECT 'clusters', 'smallest', smallest, NULL FROM c""", ("outages",))
def agg_basic_stats(spark, sf):
    return S.basic_stats(_outages_c(spark, sf))


@register("agg_missing_report", """
SELECT * FROM (
  SELECT 'latitude' AS "column", CAST(count(*) FILTER (WHERE latitude IS NULL) AS BIGINT) AS n_missing,
    round(count(*) FILTER (WHERE latitude IS NULL) * 100.0 / count(*), 4) AS pct FROM outages
  UNION ALL
  SELECT 'longitude', CAST(count(*) FILTER (WHERE longitude IS NULL) AS BIGINT),
    round(count(*) FILTER (WHERE longitude IS NULL) * 100.0 / count(*), 4) FROM outages)
WHERE n_missing > 0""", ("outages",))
def agg_missing_report(spark, sf):
    return S.missing_report(load_view(spark, sf, "outages"))


@register("agg_mode_peaks", f"""
WITH o AS (SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS dow, CAST(month(datetime) AS INTEGER) AS m,
                  {SEASON_A_SQL} AS season, zone_id AS cluster_id FROM orders_ev)
SELECT (SELECT dow FROM o GROUP BY dow ORDER BY count(*) DESC, dow LIMIT 1) AS top_day_of_week,
  (SELECT m FROM o GROUP BY m ORDER BY count(*) DESC, m LIMIT 1) AS top_month,
  (SELECT season FROM o GROUP BY season ORDER BY count(*) DESC, season LIMIT 1) AS peak_season,
  (SELECT CAST(count(*) AS BIGINT) FROM o GROUP BY season ORDER BY count(*) DESC LIMIT 1) AS peak_season_count,
  (SELECT CAST(count(DISTINCT cluster_id) AS BIGINT) FROM o) AS n_clusters,
  (SELECT CAST(count(*) AS BIGINT) FROM o GROUP BY cluster_id ORDER BY count(*) DESC LIMIT 1) AS largest_cluster
""", ("orders_ev",))
def agg_mode_peaks(spark, sf):
    df = cal.temporal_features(load_view(spark, sf, "orders_ev")).withColumnRenamed(
        "zone_id", "cluster_id")
    return S.mode_peaks(df)


@register("agg_target_stats", f"""
WITH f AS (
  SELECT a.record_id, CAST(count(DISTINCT CAST(b.datetime AS DATE)) AS BIGINT) AS fut
  FROM outages a LEFT JOIN outages b ON a.zone_id = b.zone_id
    AND epoch_us(b.datetime) > epoch_us(a.datetime) + 86400000000
    AND epoch_us(b.datetime) <= epoch_us(a.datetime) + 7 * 86400000000
  GROUP BY a.record_id)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN fut > 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
  CAST(sum(CASE WHEN fut > 3 THEN 0 ELSE 1 END) AS BIGINT) AS n_negative,
  round(avg(CASE WHEN fut > 3 THEN 1.0 ELSE 0.0 END), 8) AS positive_share,
  round(avg(fut), 8) AS future_mean, median(fut)::DOUBLE AS future_median, max(fut) AS future_max,
  CAST(sum(CASE WHEN fut > 3 THEN 1 ELSE 0 END) AS BIGINT) AS future_gt3
FROM f""", ("outages",))
def agg_target_stats(spark, sf):
    df = W.target_high_activity(load_view(spark, sf, "outages").select(
        "record_id", "zone_id", "datetime"), zone_col="zone_id")
    out = S.target_stats(df)
    return out.withColumns({"positive_share": F.round("positive_share", 8),
                            "future_mean": F.round("future_mean", 8),
                            "future_median": F.col("future_median").cast("double")})


@register("topk_limits", f"""
SELECT cluster_id, CAST(count(*) AS BIGINT) AS n FROM {OUT_C} GROUP BY 1
ORDER BY n DESC, cluster_id LIMIT 10""", ("outages",))
def topk_limits(spark, sf):
    per = _outages_c(spark, sf).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return S.top_k(per, [F.desc("n"), F.asc("cluster_id")], 10)


@register("setop_distinct_coords", """
SELECT DISTINCT latitude, longitude FROM outages""", ("outages",))
def setop_distinct_coords(spark, sf):
    return S.distinct_coords(load_view(spark, sf, "outages"))


@register("join_label_align", f"""
SELECT record_id, CASE WHEN latitude IS NULL OR longitude IS NULL THEN -1 ELSE cluster_id END AS cluster_id
FROM {OUT_C}""", ("outages",))
def join_label_align(spark, sf):
    from ..operators.spatial import align_labels
    return align_labels(_outages_c(spark, sf)).select("record_id", "cluster_id")
