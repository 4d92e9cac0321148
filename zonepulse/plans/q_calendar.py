"""Queries for calendar and scalar functions (rows 16-27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..sources.tables import load_view
from .registry import register

# DuckDB spellings of the same calendar expressions (oracle side).
Y = "CAST(year(datetime) AS INTEGER)"
M = "CAST(month(datetime) AS INTEGER)"
DOW = "CAST(isodow(datetime) - 1 AS INTEGER)"
SEASON_A_SQL = ("CASE WHEN month(datetime) IN (3,4,5) THEN 'long_rains' "
                "WHEN month(datetime) IN (9,10,11) THEN 'short_rains' ELSE 'dry' END")
SEASON_B_SQL = ("CASE WHEN month(datetime) IN (3,4,5) THEN 'long_rains' "
                "WHEN month(datetime) IN (10,11,12) THEN 'short_rains' ELSE 'dry' END")
TEMPORAL_SQL = f"""{Y} AS year, {M} AS month, CAST(day(datetime) AS INTEGER) AS day,
  {DOW} AS day_of_week, CAST(dayofyear(datetime) AS INTEGER) AS day_of_year,
  CAST(weekofyear(datetime) AS INTEGER) AS week_of_year, CAST(quarter(datetime) AS INTEGER) AS quarter,
  CAST(isodow(datetime) >= 6 AS INTEGER) AS is_weekend, {SEASON_A_SQL} AS season"""


@register("fn_temporal_features", f"SELECT record_id, zone_id, {TEMPORAL_SQL} FROM orders_ev",
          ("orders_ev",))
def fn_temporal_features(spark, sf):
    return cal.temporal_features(load_view(spark, sf, "orders_ev")).drop("datetime")


@register("fn_season_a", f"SELECT record_id, {M} AS month, {SEASON_A_SQL} AS season FROM orders_ev",
          ("orders_ev",))
def fn_season_a(spark, sf):
    m = F.month("datetime")
    return load_view(spark, sf, "orders_ev").select(
        "record_id", m.alias("month"), cal.season(m, "A").alias("season"))


@register("fn_temporal_features_b", f"""
SELECT record_id, zone_id, {Y} AS year, {M} AS month, CAST(day(datetime) AS INTEGER) AS day,
  {DOW} AS day_of_week, CAST(weekofyear(datetime) AS INTEGER) AS week_of_year,
  CAST(quarter(datetime) AS INTEGER) AS quarter, CAST(isodow(datetime) >= 6 AS INTEGER) AS is_weekend,
  {SEASON_B_SQL} AS season
FROM orders_ev""", ("orders_ev",))
def fn_temporal_features_b(spark, sf):
    return cal.temporal_features_b(load_view(spark, sf, "orders_ev")).drop("datetime")


@register("fn_season_b", f"SELECT record_id, {M} AS month, {SEASON_B_SQL} AS season FROM orders_ev",
          ("orders_ev",))
def fn_season_b(spark, sf):
    m = F.month("datetime")
    return load_view(spark, sf, "orders_ev").select(
        "record_id", m.alias("month"), cal.season(m, "B").alias("season"))


@register("fn_dashboard_calendar", f"""
SELECT record_id, strftime(datetime, '%Y-%m-%d') AS date, CAST(hour(datetime) AS INTEGER) AS hour,
  strftime(datetime, '%A') AS day_name, {M} AS month, strftime(datetime, '%B') AS month_name,
  CAST(quarter(datetime) AS INTEGER) AS quarter, {Y} AS year
FROM outages""", ("outages",))
def fn_dashboard_calendar(spark, sf):
    df = load_view(spark, sf, "outages").select("record_id", "datetime")
    out = cal.dashboard_calendar(df).drop("datetime")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("fn_month_period", """
SELECT record_id, strftime(date_trunc('month', datetime), '%Y-%m-%d') AS month_start FROM orders_ev
""", ("orders_ev",))
def fn_month_period(spark, sf):
    return load_view(spark, sf, "orders_ev").select(
        "record_id", F.date_format(cal.month_period("datetime"), "yyyy-MM-dd").alias("month_start"))


@register("fn_year_quarter_label", f"""
SELECT record_id, CAST(year(datetime) AS VARCHAR) || '-Q' || CAST(quarter(datetime) AS VARCHAR) AS year_quarter
FROM orders_ev""", ("orders_ev",))
def fn_year_quarter_label(spark, sf):
    return load_view(spark, sf, "orders_ev").select(
        "record_id",
        cal.year_quarter_label(F.year("datetime"), F.quarter("datetime")).alias("year_quarter"))


@register("fn_format_date", """
SELECT record_id, strftime(datetime, '%Y-%m-%d') AS date_text FROM outages
""", ("outages",))
def fn_format_date(spark, sf):
    return load_view(spark, sf, "outages").select(
        "record_id", cal.format_date("datetime").alias("date_text"))


ANCHOR = "1998-06-15 12:00:00"


@register("fn_floor_days", f"""
SELECT record_id,
  CAST(floor((epoch_us(datetime) - epoch_us(TIMESTAMP '{ANCHOR}')) / 86400000000.0) AS BIGINT) AS days_from_anchor
FROM orders_ev""", ("orders_ev",))
def fn_floor_days(spark, sf):
    df = load_view(spark, sf, "orders_ev")
    anchor = F.lit(ANCHOR).cast("timestamp")
    return df.select("record_id", cal.floor_days_us(cal.us("datetime"), cal.us(anchor))
                     .alias("days_from_anchor"))


@register("fn_title_case", f"""
SELECT record_id, CASE WHEN month(datetime) IN (3,4,5) THEN 'Long_Rains'
  WHEN month(datetime) IN (9,10,11) THEN 'Short_Rains' ELSE 'Dry' END AS season_title
FROM orders_ev""", ("orders_ev",))
def fn_title_case(spark, sf):
    return load_view(spark, sf, "orders_ev").select(
        "record_id", cal.title_case(cal.season(F.month("datetime"), "A")).alias("season_title"))


@register("fn_round_pct", f"""
SELECT season, CAST(count(*) AS BIGINT) AS n,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM (SELECT {SEASON_A_SQL} AS season FROM orders_ev) GROUP BY season""", ("orders_ev",))
def fn_round_pct(spark, sf):
    from pyspark.sql import Window
    per = (load_view(spark, sf, "orders_ev")
           .groupBy(cal.season(F.month("datetime"), "A").alias("season"))
           .agg(F.count(F.lit(1)).alias("n")))
    # the grouped table has one row per season, so an unpartitioned window is tiny
    return per.withColumn("pct", cal.round_pct(F.col("n"), F.sum("n").over(Window.partitionBy())))


@register("fn_code_to_name", f"""
SELECT record_id, strftime(datetime, '%A') AS weekday_name, strftime(datetime, '%B') AS month_name
FROM orders_ev""", ("orders_ev",))
def fn_code_to_name(spark, sf):
    df = load_view(spark, sf, "orders_ev")
    return df.select("record_id",
                     cal.weekday_name(cal.weekday0("datetime")).alias("weekday_name"),
                     cal.month_name(F.month("datetime")).alias("month_name"))
