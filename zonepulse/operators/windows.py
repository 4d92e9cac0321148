"""Zone x time window features (inventory rows 31-32, 52-59).

Skew-robust plan
----------------
A window partitioned by zone alone sends a whole zone to one task; a hot
zone holding a third of the rows would then be one enormous sort.  Instead
the event-level work is partitioned by ``(zone, slot)`` where a slot is one
minute, whatever the data:

1. Every event, plus for every rolling width W a narrow copy shifted forward
   by W days (one scan, one ``explode``).  A window over ``(zone, slot)``
   ordered by ``(us, kind, id)`` yields in-slot ranks, in-slot "shifted copies
   at or before t" counts and the previous event inside the slot.
2. A *slot ledger* (a row per zone and active slot) with running totals inside
   its zone and day: at most 1,440 rows a partition.
3. A *day ledger* (a row per zone and active day) with running totals per
   zone, and RANGE frames over the integer day number for the distinct-day
   counts: active days wholly inside a window plus two boundary-day tests on
   min / max time.  Its size is bounded by the number of days, not of events.
4. Day totals are joined to slots on ``(zone, day)``, slots to events on
   ``(zone, slot)``; the events are already partitioned on those keys.

Every frame is on integers (microseconds ``us`` and days since the epoch),
so strict bounds are exact and time zones cannot interfere.  Events of one
zone in one minute share a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import DAY_US, floor_days_us

SLOT_US = 60_000_000    # fixed value: one minute
HOUR_US = 3_600_000_000
NO_PREVIOUS_DAYS = 999  # fixed value: "days since last" when a zone has no earlier event

_P = "_zp_"  # prefix of internal columns


def _n(name: str) -> str:
    return _P + name


def _zone_key(df: DataFrame, zone_col: str) -> Column:
    """Non-null internal zone key (null zones form one zone of their own).

    Plain equi-joins on this key keep the big side's hash partitioning, which a
    null-safe join (rewritten by Spark to coalesce / isnull keys) would not.
    """
    t = dict(df.dtypes)[zone_col]
    if t in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(zone_col).cast("bigint"), F.lit(-(1 << 63)))
    return F.coalesce(F.col(zone_col).cast("string"), F.lit("\u0000null"))


def rows_without_time(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """The rows that window features leave out: their time is null (or could not be read)."""
    return df.filter(F.col(time_col).isNull())


def zone_window_features(
    df: DataFrame,
    zone_col: str = "cluster_id",
    time_col: str = "datetime",
    id_col: str = "record_id",
    rolling_days: tuple[int, ...] = (),
    rolling_lag: bool = False,
    lookback_days: tuple[int, ...] = (),
    future: tuple[int, int] | None = None,
    any_within_days: int | None = None,
    prev_event: bool = False,
    prev_row: bool = False,
    count_before_days: int | None = None,
    sequence: bool = False,
    slot_us: int = SLOT_US,
) -> DataFrame:
    """Add window features; returns ``df`` (rows with a null time are dropped, see
    :func:`rows_without_time`) plus:

    * ``cnt_{W}d``: events in (t-W days, t] including self; an earlier row of a
      time tie does not see later ones (order ``time, id``)          [row 52]
    * ``lag_cnt_{W}d``: previous row's ``cnt_{W}d`` in the zone (null first) [row 54]
    * ``days_{d}d``: distinct days with an event in [t-d days, t)      [row 55]
    * ``future_days``: distinct days with an event in (t+g, t+N days], future=(N, g) [row 57]
    * ``any_next``: 1 if an event lies in (t, t+D days]                 [row 59]
    * ``prev_us``: time (us) of the latest strictly earlier event, null if none [rows 32, 56]
    * ``prev_row_us``: time (us) of the previous row in (time, id) order [row 56b]
    * ``cnt_before_{d}d``: events in [t-d days, t)                      [row 31]
    * ``seq_in_zone``: 1-based position in (time, id) order             [row 60]
    """
    if DAY_US % slot_us:
        raise ValueError("slot_us must divide a day")
    i = id_col
    Z, US, SLOT, DAY, KIND, R = _n("z"), _n("us"), _n("slot"), _n("day"), _n("kind"), _n("r")
    base = df.filter(F.col(time_col).isNotNull()).select(
        F.struct(*df.columns).alias(_n("row")), F.col(i).alias(_n("id")), _zone_key(df, zone_col).alias(Z),
        F.unix_micros(F.col(time_col).cast("timestamp")).alias(US))
    i = _n("id")

    shift_days = sorted(set(rolling_days) | ({count_before_days} if count_before_days else set()))
    shift_cols = {w: _n(f"s{w}") for w in shift_days}
    if shift_days:
        # the event itself (shift 0), and its narrow copies
        u = base.withColumn(_n("w"), F.explode(F.array(*[F.lit(w) for w in (0, *shift_days)])))
        real = F.col(_n("w")) == 0
        u = u.withColumns({_n("row"): F.when(real, F.col(_n("row"))), US: F.col(US) + F.col(_n("w")).cast("bigint") * DAY_US,
                           KIND: real.cast("int"), R: real.cast("int"),
                           **{c: (F.col(_n("w")) == w).cast("int") for w, c in shift_cols.items()}}).drop(_n("w"))
    else:
        u = base.withColumns({KIND: F.lit(1), R: F.lit(1)})
    u = u.withColumn(SLOT, F.floor((F.col(US) - F.pmod(F.col(US), F.lit(slot_us))) / F.lit(slot_us)).cast("bigint"))

    # ---- event-level window inside (zone, slot): the one shuffle of the big side ----------
    part = Window.partitionBy(Z, SLOT)
    w_rows = part.orderBy(US, KIND, i).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_prev = part.orderBy(US, KIND, i).rowsBetween(Window.unboundedPreceding, -1)
    w_lt = part.orderBy(US).rangeBetween(Window.unboundedPreceding, -1)
    r = F.col(R)
    real_us = F.when(r == 1, F.col(US))
    ev_cols = {_n("rank"): F.sum(r).over(w_rows)}
    for w, c in shift_cols.items():
        ev_cols[c + "_le"] = F.sum(c).over(w_rows)
        if count_before_days == w:
            ev_cols[c + "_lt"] = F.coalesce(F.sum(c).over(w_lt), F.lit(0))
    if count_before_days:
        ev_cols[_n("real_lt")] = F.coalesce(F.sum(r).over(w_lt), F.lit(0))
    if prev_event:
        ev_cols[_n("prev_in")] = F.max(real_us).over(w_lt)
    if prev_row:
        ev_cols[_n("prevrow_in")] = F.max(real_us).over(w_prev)
    ev = u.withColumns(ev_cols)

    # ---- slot ledger: totals of a slot, and before it on its day ---------------------------
    lag = bool(rolling_lag and rolling_days)
    aggs = [F.sum(r).alias(_n("n")), F.max(real_us).alias(_n("max")), F.min(real_us).alias(_n("min"))]
    aggs += [F.sum(c).alias(c + "_n") for c in shift_cols.values()]
    if lag:     # shifted copies up to the slot's last event
        aggs += [F.max(F.when(r == 1, F.col(c + "_le"))).alias(c + "_last") for c in shift_cols.values()]
    sl = (ev if lag else u).groupBy(Z, SLOT).agg(*aggs).withColumn(
        DAY, F.floor(F.col(SLOT) / F.lit(DAY_US // slot_us)).cast("bigint"))
    in_day = Window.partitionBy(Z, DAY).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    sl = sl.withColumns({_n("in_r"): zero(_n("n"), in_day), _n("in_max"): F.max(_n("max")).over(in_day),
                         **{c + "_in": zero(c + "_n", in_day) for c in shift_cols.values()}})
    if lag:
        sl = sl.withColumns({c + "_at": F.col(c + "_in") + F.col(c + "_last") for c in shift_cols.values()})
        sl = sl.withColumns({c + "_inat": F.last(c + "_at", ignorenulls=True).over(in_day) for c in shift_cols.values()})

    # ---- day ledger: totals of a day, and before it in its zone ----------------------------
    aggs = [F.sum(_n("n")).alias(_n("n")), F.max(_n("max")).alias(_n("dmax")), F.min(_n("min")).alias(_n("dmin"))]
    aggs += [F.sum(c + "_n").alias(c + "_n") for c in shift_cols.values()]
    if lag:
        aggs += [F.max_by(c + "_at", F.when(F.col(c + "_at").isNotNull(), F.col(SLOT))).alias(c + "_dat") for c in shift_cols.values()]
    dl = sl.groupBy(Z, DAY).agg(*aggs)
    zd = Window.partitionBy(Z).orderBy(DAY)
    before = zd.rowsBetween(Window.unboundedPreceding, -1)
    dcols = {_n("day_r"): zero(_n("n"), before), _n("day_max"): F.max(_n("dmax")).over(before),
             **{c + "_day": zero(c + "_n", before) for c in shift_cols.values()}}
    horizons = []
    if future is not None:
        horizons.append(("f", future[0], future[1]))
    if any_within_days is not None:
        horizons.append(("a", any_within_days, 0))
    active = (F.col(_n("n")) > 0).cast("int")

    def frame(lo: int, hi: int):
        return zd.rangeBetween(lo, hi)

    for d in lookback_days:
        dcols[_n(f"pfull{d}")] = zero(active, frame(-(d - 1), -1)) if d >= 2 else F.lit(0)
        dcols[_n(f"pmax{d}")] = F.max(_n("dmax")).over(frame(-d, -d))
    for tag, n_days, g in horizons:
        if n_days > g:
            dcols[_n(f"{tag}full")] = zero(active, frame(g + 1, n_days - 1)) if n_days - 1 >= g + 1 else F.lit(0)
            dcols[_n(f"{tag}gmax")] = F.max(_n("dmax")).over(frame(g, g))
            dcols[_n(f"{tag}nmin")] = F.min(_n("dmin")).over(frame(n_days, n_days))
    dl = dl.withColumns(dcols)
    if lag:
        dl = dl.withColumns({c + "_dat": F.col(c + "_dat") + F.col(c + "_day") for c in shift_cols.values()})
        dl = dl.withColumns({c + "_dayat": F.last(c + "_dat", ignorenulls=True).over(before) for c in shift_cols.values()})

    # ---- totals before each active slot, in its zone ----------------------------------------
    led = sl.filter(F.col(_n("n")) > 0).join(dl.drop(_n("n"), _n("dmax"), *[c + x for c in shift_cols.values() for x in ("_n", "_dat")]), [Z, DAY])
    keep = {_n("cum_r"): F.col(_n("in_r")) + F.col(_n("day_r")), _n("prev_slot_max"): F.coalesce(_n("in_max"), _n("day_max"))}
    for c in shift_cols.values():
        keep[c + "_cum"] = F.col(c + "_in") + F.col(c + "_day")
        if lag:
            keep[c + "_prev"] = F.coalesce(F.col(c + "_inat") + F.col(c + "_day"), F.col(c + "_dayat"))
    days = [c for c in dl.columns if c.startswith((_n("dmin"), _n("pfull"), _n("pmax"), _n("f"), _n("a")))]
    led = led.select(Z, SLOT, *[v.alias(k) for k, v in keep.items()], *days)

    # join back on (zone, slot): the big side is already partitioned on exactly these keys
    out = ev.filter(r == 1).join(led, [Z, SLOT], "left")

    t = F.col(US)
    new = {}
    for w in rolling_days:
        c = shift_cols[w]
        new[f"cnt_{w}d"] = (F.col(_n("cum_r")) - F.col(c + "_cum") + F.col(_n("rank"))
                            - F.col(c + "_le")).cast("bigint")
    if count_before_days:
        c = shift_cols[count_before_days]
        new[f"cnt_before_{count_before_days}d"] = (
            F.col(_n("cum_r")) + F.col(_n("real_lt")) - F.col(c + "_cum") - F.col(c + "_lt")
        ).cast("bigint")
    for d in lookback_days:
        new[f"days_{d}d"] = (
            F.col(_n(f"pfull{d}"))
            + F.coalesce((F.col(_n(f"pmax{d}")) >= t - F.lit(d * DAY_US)).cast("int"), F.lit(0))
            + (F.col(_n("dmin")) < t).cast("int")
        ).cast("bigint")
    for tag, n_days, g in horizons:
        name = "future_days" if tag == "f" else "any_next"
        if n_days > g:
            val = (F.col(_n(f"{tag}full"))
                   + F.coalesce((F.col(_n(f"{tag}gmax")) > t + F.lit(g * DAY_US)).cast("int"), F.lit(0))
                   + F.coalesce((F.col(_n(f"{tag}nmin")) <= t + F.lit(n_days * DAY_US)).cast("int"),
                                F.lit(0)))
        else:
            val = F.lit(0)
        new[name] = (val > 0).cast("int") if tag == "a" else val.cast("bigint")
    if prev_event:
        new["prev_us"] = F.coalesce(F.col(_n("prev_in")), F.col(_n("prev_slot_max")))
    if prev_row:
        new["prev_row_us"] = F.coalesce(F.col(_n("prevrow_in")), F.col(_n("prev_slot_max")))
    if sequence:
        new["seq_in_zone"] = (F.col(_n("cum_r")) + F.col(_n("rank"))).cast("int")
    out = out.withColumns(new)
    if lag:
        # the previous row's count: inside the slot a plain lag; for the first row of a slot
        # the events up to the last earlier one, less their shifted copies (from the ledgers)
        wl = Window.partitionBy(Z, SLOT).orderBy(US, i)
        out = out.withColumns({f"lag_cnt_{w}d": F.when(F.col(_n("rank")) > 1, F.lag(f"cnt_{w}d").over(wl)).otherwise(
            (F.col(_n("cum_r")) - F.col(shift_cols[w] + "_prev")).cast("bigint")) for w in rolling_days})
    return out.select(f"{_n('row')}.*", *[c for c in out.columns if not c.startswith(_P)])


# ---- user-level operators (one per inventory row) ------------------------------------

def win_rolling_count(df, window_days: int = 7, zone_col="cluster_id", time_col="datetime",
                      id_col="record_id") -> DataFrame:
    """Row 52 + 53: ``outage_count_{W}d`` and ``outage_rate_{W}d`` (= count / W)."""
    out = zone_window_features(df, zone_col, time_col, id_col, rolling_days=(window_days,))
    return (out.withColumnRenamed(f"cnt_{window_days}d", f"outage_count_{window_days}d")
               .withColumn(f"outage_rate_{window_days}d",
                           F.col(f"outage_count_{window_days}d") / F.lit(float(window_days))))


def aggregation_features(df, zone_col="cluster_id", time_col="datetime", id_col="record_id",
                         window_days: int = 7) -> DataFrame:
    """Rows 52-54, 56b: the older chain's rolling, lag and gap features in one pass."""
    out = zone_window_features(df, zone_col, time_col, id_col, rolling_days=(window_days, 30),
                               rolling_lag=True, prev_row=True)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    return (out.withColumns({
        "outage_count_7d": F.col(f"cnt_{window_days}d"),
        "outage_rate_7d": F.col(f"cnt_{window_days}d") / F.lit(float(window_days)),
        "outages_last_week": F.col(f"lag_cnt_{window_days}d").cast("double"),
        "outages_last_month": F.col("lag_cnt_30d").cast("double"),
        "days_since_last_outage": F.coalesce(floor_days_us(t, F.col("prev_row_us")), F.lit(0)),
    }).drop(f"cnt_{window_days}d", "cnt_30d", f"lag_cnt_{window_days}d", "lag_cnt_30d",
            "prev_row_us"))


def historical_features(df, lookback_days=(7, 30), zone_col="cluster_id", time_col="datetime",
                        id_col="record_id") -> DataFrame:
    """Rows 55-56: distinct active days in [t-d, t), their rate, days since last event."""
    out = zone_window_features(df, zone_col, time_col, id_col, lookback_days=tuple(lookback_days),
                               prev_event=True)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    cols = {}
    for d in lookback_days:
        cols[f"outages_last_{d}d"] = F.col(f"days_{d}d")
    cols["days_since_last_outage"] = F.coalesce(floor_days_us(t, F.col("prev_us")),
                                                F.lit(NO_PREVIOUS_DAYS).cast("bigint"))
    for d in lookback_days:
        cols[f"cluster_outage_rate_{d}d"] = F.col(f"days_{d}d") / F.lit(float(d))
    return out.withColumns(cols).drop(*[f"days_{d}d" for d in lookback_days], "prev_us")


def target_high_activity(df, window_days: int = 7, high_activity_threshold: int = 3,
                         gap_days: int = 1, zone_col="cluster_id", time_col="datetime",
                         id_col="record_id", censored: bool = False) -> DataFrame:
    """Rows 57-58: ``future_outage_days`` in (t+gap, t+N] and ``target`` = days > threshold.

    Like the reference, a look-ahead that runs past the end of the data counts 0
    there; ``censored=True`` adds a ``censored`` flag for those rows (one scalar
    aggregate: the last time in the data).
    """
    out = zone_window_features(df, zone_col, time_col, id_col, future=(window_days, gap_days))
    out = (out.withColumnRenamed("future_days", "future_outage_days")
              .withColumn("target", (F.col("future_outage_days") > high_activity_threshold)
                          .cast("int")))
    if censored:
        t = F.unix_micros(F.col(time_col).cast("timestamp"))
        last = df.agg(F.max(F.unix_micros(F.col(time_col).cast("timestamp")))).first()[0]
        out = out.withColumn("censored", t + F.lit(window_days * DAY_US) > F.lit(last))
    return out


def target_any(df, target_type: str = "outage_next_week", zone_col="cluster_id",
               time_col="datetime", id_col="record_id", days: int = 7) -> DataFrame:
    """Row 59: 1 when the zone has any event in (t, t+7 days]."""
    if target_type != "outage_next_week":
        raise ValueError(f"Unknown target type: {target_type}")
    out = zone_window_features(df, zone_col, time_col, id_col, any_within_days=days)
    return out.withColumnRenamed("any_next", "target")


def asof_previous(df, zone_col="cluster_id", time_col="datetime", id_col="record_id") -> DataFrame:
    """Row 32: time of the latest strictly earlier event in the zone (as-of, strict <)."""
    out = zone_window_features(df, zone_col, time_col, id_col, prev_event=True)
    return out.withColumn("prev_datetime", F.timestamp_micros(F.col("prev_us"))).drop("prev_us")


def days_since_prev(df, zone_col="cluster_id", time_col="datetime", id_col="record_id") -> DataFrame:
    """Row 56: whole days since the latest strictly earlier event, 999 if none."""
    out = zone_window_features(df, zone_col, time_col, id_col, prev_event=True)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    return out.withColumn("days_since_last_outage", F.coalesce(
        floor_days_us(t, F.col("prev_us")), F.lit(NO_PREVIOUS_DAYS).cast("bigint"))).drop("prev_us")


def days_since_row(df, zone_col="cluster_id", time_col="datetime", id_col="record_id") -> DataFrame:
    """Row 56b: whole days since the previous row (ties give 0), 0 for the first."""
    out = zone_window_features(df, zone_col, time_col, id_col, prev_row=True)
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    return out.withColumn("days_since_last_outage", F.coalesce(
        floor_days_us(t, F.col("prev_row_us")), F.lit(0).cast("bigint"))).drop("prev_row_us")


def events_before(df, days: int = 7, zone_col="cluster_id", time_col="datetime",
                  id_col="record_id") -> DataFrame:
    """Row 31: number of other events of the zone in [t-days, t) (the range self-join, as windows)."""
    out = zone_window_features(df, zone_col, time_col, id_col, count_before_days=days)
    return out.withColumnRenamed(f"cnt_before_{days}d", f"events_prev_{days}d")
