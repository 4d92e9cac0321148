"""Summary tables (inventory rows 28, 33-51, 61, 64).

Every summary is a grouped aggregate with map-side partial aggregation;
tables that must be zero-filled are left-joined to a tiny fixed domain
(7 weekdays, 12 months) whose size is known in advance.  Global scalar
summaries are single ``agg`` calls (a tree of partial aggregates, never a
collect).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import (MONTH_NAMES, WEEKDAY_NAMES, floor_days_us,
                                  month_period, weekday0, year_quarter_label)
from .clean import CHECK_BOX, WORLD_LAT, WORLD_LON


def _count() -> Column:
    return F.count(F.lit(1))


def _domain(spark: SparkSession, name: str, values: list, start: int) -> DataFrame:
    """A fixed small domain table (weekdays, months): size known up front, safe to broadcast."""
    rows = [(start + k, v) for k, v in enumerate(values)]
    return F.broadcast(spark.createDataFrame(rows, f"{name} int, {name}_name string"))


def daily_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 33: events per calendar day; days without events are absent."""
    return df.groupBy(F.to_date(time_col).alias("date")).agg(_count().alias("n"))


def monthly_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 34: events per calendar month (first day of the month)."""
    return df.groupBy(month_period(time_col).alias("month_start")).agg(_count().alias("n"))


def dow_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 35: per weekday in Monday..Sunday order, missing weekdays as 0."""
    spark = df.sparkSession
    per = df.groupBy(weekday0(time_col).alias("day_of_week")).agg(_count().alias("n"))
    dom = _domain(spark, "day_of_week", WEEKDAY_NAMES, 0).withColumnRenamed(
        "day_of_week_name", "day_name")
    return (dom.join(per, "day_of_week", "left")
               .select("day_of_week", "day_name", F.coalesce("n", F.lit(0)).alias("n")))


def hour_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 36: per hour, plus whether more than one distinct hour occurs (chart shown)."""
    per = df.groupBy(F.hour(time_col).alias("hour")).agg(_count().alias("n"))
    # the grouped table has at most 24 rows, so an unpartitioned window is tiny
    return per.withColumn("many_hours", F.count(F.lit(1)).over(Window.partitionBy()) > 1)


def month_of_year(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 37: twelve month slots, zero-filled, with month names in calendar order."""
    spark = df.sparkSession
    per = df.groupBy(F.month(time_col).alias("month")).agg(_count().alias("n"))
    dom = _domain(spark, "month", MONTH_NAMES, 1)
    return (dom.join(per, "month", "left")
               .select("month", "month_name", F.coalesce("n", F.lit(0)).alias("n")))


def quarter_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 38."""
    return df.groupBy(F.quarter(time_col).alias("quarter")).agg(_count().alias("n"))


def year_quarter_counts(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 39: per (year, quarter) with a ``2024-Q1`` label."""
    per = df.groupBy(F.year(time_col).alias("year"), F.quarter(time_col).alias("quarter")).agg(
        _count().alias("n"))
    return per.withColumn("period", year_quarter_label(F.col("year"), F.col("quarter")))


def cluster_counts(df: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Row 40: per cluster (ordered by id), with number of clusters, largest and smallest.

    One pass over the rows; the window runs over the grouped table (a row per cluster).
    """
    per = df.groupBy(cluster_col).agg(_count().alias("n"))
    w = Window.partitionBy()
    return per.select(cluster_col, "n", F.count(F.lit(1)).over(w).alias("n_clusters"),
                      F.max("n").over(w).alias("largest"), F.min("n").over(w).alias("smallest")
                      ).orderBy(cluster_col)


def cluster_month_pivot(df: DataFrame, cluster_col: str = "cluster_id",
                        time_col: str = "datetime") -> DataFrame:
    """Row 41: cluster x month matrix (columns m1..m12), missing = 0."""
    months = list(range(1, 13))
    out = (df.withColumn("_m", F.month(time_col)).groupBy(cluster_col)
             .pivot("_m", months).agg(_count()))
    return out.select(cluster_col, *[F.coalesce(F.col(str(m)), F.lit(0)).alias(f"m{m}")
                                     for m in months])


def exact_avg(c) -> Column:
    """Mean with an exact (decimal) sum: independent of summation order, so the result is
    the same however the rows are partitioned."""
    return F.avg(F.col(c).cast("decimal(38,15)")).cast("double")


def cluster_summary(df: DataFrame, cluster_col: str = "cluster_id", lat="latitude",
                    lon="longitude", exact: bool = False) -> DataFrame:
    """Rows 28 + 42: mean centre and size per cluster (the reference's merge of two groupbys)."""
    clean = df.dropna(subset=[lat, lon, cluster_col])
    mean = exact_avg if exact else F.avg
    return clean.groupBy(cluster_col).agg(mean(lat).alias("center_lat"),
                                          mean(lon).alias("center_lon"),
                                          _count().alias("n"))


def cluster_centers_top(df: DataFrame, k: int = 10, cluster_col: str = "cluster_id",
                        lat="latitude", lon="longitude", exact: bool = False) -> DataFrame:
    """Row 42: centres rounded to 4 places, first ``k`` clusters by id (top-k plan)."""
    s = cluster_summary(df, cluster_col, lat, lon, exact)
    return (s.select(cluster_col, F.round("center_lat", 4).alias("center_lat"),
                     F.round("center_lon", 4).alias("center_lon"), "n")
             .orderBy(cluster_col).limit(k))


def map_points(df: DataFrame, cluster_col: str = "cluster_id", lat="latitude",
               lon="longitude") -> DataFrame:
    """Row 43: marker layer (non-null coordinates, cluster != -1) and heat layer (all non-null)."""
    pts = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    markers = pts.filter(F.col(cluster_col) != -1).withColumn("layer", F.lit("marker"))
    heat = pts.withColumn("layer", F.lit("heat"))
    return markers.unionByName(heat)


def density_grid(df: DataFrame, cell_deg: float = 0.1, lat="latitude", lon="longitude") -> DataFrame:
    """Row 44: counts per grid cell behind the heat layer."""
    pts = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    g = F.lit(cell_deg)
    return pts.groupBy(F.floor(F.col(lat) / g).alias("cell_lat"),
                       F.floor(F.col(lon) / g).alias("cell_lon")).agg(_count().alias("n"))


def data_summary(df: DataFrame, time_col="datetime", lat="latitude", lon="longitude") -> DataFrame:
    """Row 45: one row: count, first/last date, distinct coordinate pairs, bounds, records/day."""
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    s = df.agg(_count().alias("total_records"),
               F.min(us).alias("_t0"), F.max(us).alias("_t1"),
               F.count_distinct(F.struct(lat, lon)).alias("unique_coordinates"),
               F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
               F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))
    span = floor_days_us(F.col("_t1"), F.col("_t0"))
    return s.select(
        "total_records",
        F.date_format(F.timestamp_micros("_t0"), "yyyy-MM-dd").alias("date_range_start"),
        F.date_format(F.timestamp_micros("_t1"), "yyyy-MM-dd").alias("date_range_end"),
        "unique_coordinates", "lat_min", "lat_max", "lon_min", "lon_max",
        # the reference divides by a zero-day span; we give null
        F.when(span > 0, F.col("total_records") / span).alias("records_per_day"))


def in_time_order(df: DataFrame, order_col: str = "record_id", time_col: str = "datetime",
                  bits: int = 16) -> DataFrame:
    """One row ``chronological_order``: time never decreases along ``order_col``.

    No global window: a row is checked against its predecessor inside its block of
    ``2**bits`` ids, then the blocks that have rows against each other inside blocks of
    blocks, and so on until one block spans all 64-bit ids.
    """
    t, o = F.col(time_col), F.col(order_col).cast("bigint")
    led = df.select(o.alias("_o"), t.alias("_first"), t.alias("_last"), t.isNull().alias("_bad"))
    steps = -(-64 // bits)
    for step in range(steps + 1):
        # the last step compares the negative ids with the others: two rows
        led = led.withColumn("_b", F.shiftright("_o", bits) if step < steps else F.lit(0))
        w = Window.partitionBy("_b").orderBy("_o")
        led = led.withColumn("_bad", F.col("_bad") | F.coalesce(F.col("_first") < F.lag("_last").over(w), F.lit(False)))
        led = led.groupBy("_b").agg(F.max("_bad").alias("_bad"), F.min_by("_first", "_o").alias("_first"),
                                    F.max_by("_last", "_o").alias("_last")).withColumnRenamed("_b", "_o")
    return led.agg(F.coalesce(F.bool_and(~F.col("_bad")), F.lit(True)).alias("chronological_order"))


def combine_rows(*parts: DataFrame) -> DataFrame:
    """Merge single-row aggregates that have disjoint columns into one row.

    Union (with missing columns as null) followed by one ``max`` per column;
    this avoids a cross join and stays a tiny final aggregation.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    cols = []
    for p in parts:
        cols += [c for c in p.columns if c not in cols]
    return out.agg(*[F.max(c).alias(c) for c in cols])


def quality_checks(df: DataFrame, lat="latitude", lon="longitude", time_col="datetime",
                   order_col: str = "record_id", box: dict = CHECK_BOX,
                   min_rows: int = 100) -> DataFrame:
    """Row 46: the seven validation booleans in one row.

    A missing required column gives ``has_required_columns = false`` and null
    for the checks that need it (the reference raised there).
    """
    # fixed values: the names of the checks
    names = ["has_required_columns", "no_missing_coordinates", "valid_coordinate_ranges",
             "no_missing_timestamps", "chronological_order", "reasonable_sample_size",
             "within_kenya_bounds"]
    if not all(c in df.columns for c in (lat, lon, time_col)):
        vals = {n: F.lit(None).cast("boolean") for n in names}
        vals["has_required_columns"] = F.lit(False)
        vals["reasonable_sample_size"] = _count() >= min_rows
        return df.agg(*[v.alias(n) for n, v in vals.items()])

    def all_true(cond: Column) -> Column:
        return F.coalesce(F.bool_and(F.coalesce(cond, F.lit(False))), F.lit(True))

    la, lo, t = F.col(lat), F.col(lon), F.col(time_col)
    main = df.agg(
        F.lit(True).alias("has_required_columns"),
        all_true(la.isNotNull() & lo.isNotNull()).alias("no_missing_coordinates"),
        all_true(la.between(*WORLD_LAT) & lo.between(*WORLD_LON)).alias("valid_coordinate_ranges"),
        all_true(t.isNotNull()).alias("no_missing_timestamps"),
        (_count() >= min_rows).alias("reasonable_sample_size"),
        all_true(la.between(*box["lat"]) & lo.between(*box["lon"])).alias("within_kenya_bounds"),
    )
    return combine_rows(main, in_time_order(df, order_col, time_col)).select(*names)


def kpis(df: DataFrame, time_col="datetime", cluster_col="cluster_id",
         area_col: str = "area") -> DataFrame:
    """Row 47: total, date range, clusters, mean per active day, peak day (+count), top area.

    One pass: day, cluster and area counts come from one GROUPING SETS aggregate;
    the KPI row is a small aggregation of that.
    """
    panels = {"daily": F.to_date(time_col)}
    if cluster_col in df.columns:
        panels["clusters"] = F.col(cluster_col)
    if area_col in df.columns:
        panels["area"] = F.col(area_col)
    g = panel_counts(df, panels)

    def on(panel: str, value: Column) -> Column:
        return F.when(F.col("panel") == panel, value)

    n, key = F.col("n"), F.col("key")
    aggs = [F.sum(on("daily", n)).alias("total_outages"), F.min(on("daily", key)).alias("date_start"),
            F.max(on("daily", key)).alias("date_end"), F.avg(on("daily", n)).alias("avg_daily"),
            # the earliest day wins a tie, like idxmax over date-sorted groups
            F.min_by(key, on("daily", F.struct(-n, key))).alias("peak_day"),
            F.max(on("daily", n)).alias("peak_count")]
    if "clusters" in panels:
        aggs.append(F.count(on("clusters", key)).alias("n_clusters"))
    if "area" in panels:
        named = F.when(key.isNotNull(), F.struct(-n, key))
        aggs += [F.min_by(key, on("area", named)).alias("top_area"),
                 F.max(on("area", F.when(key.isNotNull(), n))).alias("top_area_count")]
    return g.agg(*aggs)


def basic_stats(df: DataFrame, time_col="datetime", cluster_col="cluster_id",
                lat="latitude", lon="longitude") -> DataFrame:
    """Row 48: (section, metric, value, text) rows: shape, range, duration, bounds, clusters."""
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    aggs = [_count().alias("rows"), F.min(us).alias("t0"), F.max(us).alias("t1")]
    geo = lat in df.columns and lon in df.columns
    if geo:
        aggs += [F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                 F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max")]
    s = df.agg(*aggs)
    fmt = "yyyy-MM-dd HH:mm:ss"
    rows = [("overview", "rows", F.col("rows").cast("double"), F.lit(None)),
            ("overview", "columns", F.lit(float(len(df.columns))), F.lit(None)),
            ("temporal", "start", F.lit(None), F.date_format(F.timestamp_micros("t0"), fmt)),
            ("temporal", "end", F.lit(None), F.date_format(F.timestamp_micros("t1"), fmt)),
            ("temporal", "duration_days",
             floor_days_us(F.col("t1"), F.col("t0")).cast("double"), F.lit(None))]
    if geo:
        rows += [("geographic", m, F.round(F.col(m), 4), F.lit(None))
                 for m in ("lat_min", "lat_max", "lon_min", "lon_max")]
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("section"), F.lit(b).alias("metric"),
                                         c.cast("double").alias("value"),
                                         d.cast("string").alias("text"))
                                for a, b, c, d in rows]))
    out = s.select(stack.alias("r")).select("r.*")
    if cluster_col in df.columns:
        cc = df.groupBy(cluster_col).agg(_count().alias("n")).agg(
            F.count(F.lit(1)).alias("n_clusters"), F.max("n").alias("largest"),
            F.min("n").alias("smallest"))
        cl = cc.select(F.explode(F.array(*[
            F.struct(F.lit("clusters").alias("section"), F.lit(m).alias("metric"),
                     F.col(m).cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
            for m in ("n_clusters", "largest", "smallest")])).alias("r")).select("r.*")
        out = out.unionByName(cl)
    return out


def missing_report(df: DataFrame, places: int = 4) -> DataFrame:
    """Row 49: per column null count and percent, only columns with nulls (one pass)."""
    cols = df.columns
    s = df.agg(_count().alias("_n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = s.unpivot("_n", cols, "column", "n_missing")
    return (long.filter(F.col("n_missing") > 0)
                .select("column", "n_missing",
                        F.round(F.col("n_missing") * 100.0 / F.col("_n"), places).alias("pct")))


def mode_peaks(df: DataFrame, time_col="datetime", cluster_col="cluster_id",
               season_col: str = "season") -> DataFrame:
    """Row 50: most common weekday / month (smallest wins ties), peak season, clusters.

    One pass: the four groupings come from one GROUPING SETS aggregate.
    """
    panels = {"dow": weekday0(time_col), "month": F.month(time_col)}
    if season_col in df.columns:
        panels["season"] = F.col(season_col)
    if cluster_col in df.columns:
        panels["cluster"] = F.col(cluster_col)
    g = panel_counts(df, panels)

    def top(panel: str, cast: str = "string") -> Column:
        k = F.col("key").cast(cast)
        here = (F.col("panel") == panel) & F.col("key").isNotNull()
        return F.min_by(F.when(here, k), F.when(here, F.struct(-F.col("n"), F.when(here, k))))

    aggs = [top("dow", "int").alias("top_day_of_week"), top("month", "int").alias("top_month")]
    if "season" in panels:
        aggs += [top("season").alias("peak_season"),
                 F.max(F.when((F.col("panel") == "season") & F.col("key").isNotNull(), F.col("n"))).alias("peak_season_count")]
    if "cluster" in panels:
        here = F.when((F.col("panel") == "cluster") & F.col("key").isNotNull(), F.col("n"))
        aggs += [F.count(here).alias("n_clusters"), F.max(here).alias("largest_cluster")]
    return g.agg(*aggs)


def target_stats(df: DataFrame, target_col="target", future_col="future_outage_days",
                 lookbacks=(7, 30)) -> DataFrame:
    """Row 51: class counts and share, future-day and look-back statistics (exact median)."""
    aggs = [_count().alias("n"),
            F.sum((F.col(target_col) == 1).cast("long")).alias("n_positive"),
            F.sum((F.col(target_col) == 0).cast("long")).alias("n_negative"),
            F.avg(F.col(target_col).cast("double")).alias("positive_share")]
    if future_col in df.columns:
        f = F.col(future_col)
        aggs += [F.avg(f).alias("future_mean"), F.median(f).alias("future_median"),
                 F.max(f).alias("future_max"), F.sum((f > 3).cast("long")).alias("future_gt3")]
    for d in lookbacks:
        c = f"outages_last_{d}d"
        if c in df.columns:
            aggs += [F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max")]
    if "days_since_last_outage" in df.columns:
        aggs += [F.avg("days_since_last_outage").alias("days_since_mean"),
                 F.median("days_since_last_outage").alias("days_since_median")]
    return df.agg(*aggs)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Row 61: ``orderBy(...).limit(k)``, planned as a TakeOrderedAndProject (top-k per
    partition, then merge) rather than a full sort; ``order`` must be total."""
    return df.orderBy(*order).limit(k)


def distinct_coords(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    """Row 64: distinct coordinate pairs (null pairs kept, as pandas drop_duplicates)."""
    return df.select(lat, lon).distinct()


def panel_counts(df: DataFrame, panels: dict[str, Column],
                 zero_fill: dict[str, list[str]] | None = None) -> DataFrame:
    """Counts for several groupings in one pass: ``GROUPING SETS`` over the panel keys.

    One scan and one (map-side combined) shuffle instead of one per panel; the
    result is long: (panel, key, n) with the key as text.  ``zero_fill`` adds
    missing keys of fixed domains (weekdays, months) with 0 on the small result.
    """
    names = list(panels)
    cols = [f"_p{j}" for j in range(len(names))]
    base = df.select(*[panels[n].alias(c) for n, c in zip(names, cols)])
    agg = base.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"_g{j}") for j, c in enumerate(cols)])
    panel = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for j, (n, c) in enumerate(zip(names, cols)):
        hit = F.col(f"_g{j}") == 0
        panel = F.when(hit, F.lit(n)).otherwise(panel)
        key = F.when(hit, F.col(c).cast("string")).otherwise(key)
    out = agg.select(panel.alias("panel"), key.alias("key"), F.col("n").cast("bigint").alias("n"))
    if zero_fill:
        spark = df.sparkSession
        dom = spark.createDataFrame([(p, k, 0) for p, ks in zero_fill.items() for k in ks],
                                    "panel string, key string, n bigint")
        out = out.unionByName(dom).groupBy("panel", "key").agg(F.sum("n").cast("bigint").alias("n"))
    return out
