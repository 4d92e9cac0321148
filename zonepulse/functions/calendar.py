"""Calendar and scalar column functions (inventory rows 8-9, 16-27).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Weekday numbering is Monday = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000  # microseconds per day

# Season calendars (month -> season).
# Calendar A (feature builder, pipeline default): Mar-May long rains, Sep-Nov short rains.
SEASON_A = {"long_rains": (3, 4, 5), "short_rains": (9, 10, 11)}
# Calendar B (preprocessing helper): Mar-May long rains, Oct-Dec short rains.
SEASON_B = {"long_rains": (3, 4, 5), "short_rains": (10, 11, 12)}
SEASON_OTHER = "dry"

# English weekday names Monday..Sunday and month names January..December.
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def us(c) -> Column:
    """Timestamp -> integer microseconds since the epoch."""
    return F.unix_micros(_c(c).cast("timestamp"))


def parse_time(c) -> Column:
    """ISO-8601 string -> TIMESTAMP; unparseable -> null (row 8)."""
    return F.coalesce(
        F.try_to_timestamp(_c(c)),
        F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX")),
    )


def weekday0(c) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(c))


def season(month: Column, calendar: str = "A") -> Column:
    """Season of a month number; null for null."""
    cal = SEASON_A if calendar == "A" else SEASON_B
    expr = F.when(month.between(1, 12), F.lit(SEASON_OTHER))
    for name, months in cal.items():
        expr = F.when(month.isin(*months), F.lit(name)).otherwise(expr)
    return expr


def is_weekend(c) -> Column:
    """1 on Saturday and Sunday, else 0 (also for a null time)."""
    return F.coalesce((weekday0(c) >= 5).cast("int"), F.lit(0))


def basic_calendar(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 9: year, month, day_of_week, quarter as added during preprocessing."""
    t = F.col(time_col)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t),
        "day_of_week": weekday0(t), "quarter": F.quarter(t),
    })


def temporal_features(df: DataFrame, date_col: str = "datetime") -> DataFrame:
    """Row 16 (+17): the feature builder's calendar, season calendar A."""
    t = F.col(date_col)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
        "day_of_week": weekday0(t), "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t), "quarter": F.quarter(t),
        "is_weekend": is_weekend(t),
        "season": season(F.month(t), "A"),
    })


def temporal_features_b(df: DataFrame, date_column: str = "datetime") -> DataFrame:
    """Row 18 (+19): the preprocessing calendar, season calendar B.

    A missing column returns the input unchanged (checked on the driver,
    from the schema, before any job runs).
    """
    if date_column not in df.columns:
        return df
    t = F.col(date_column)
    if dict(df.dtypes)[date_column] == "string":
        df = df.withColumn(date_column, parse_time(t))
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
        "day_of_week": weekday0(t), "week_of_year": F.weekofyear(t),
        "quarter": F.quarter(t), "is_weekend": is_weekend(t),
        "season": season(F.month(t), "B"),
    })


def dashboard_calendar(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Row 20: the dashboard's calendar columns (weekday as a name in ``day_name``)."""
    t = F.col(time_col)
    return df.withColumns({
        "date": F.to_date(t), "hour": F.hour(t),
        "day_name": F.date_format(t, "EEEE"), "month": F.month(t),
        "month_name": F.date_format(t, "MMMM"), "quarter": F.quarter(t), "year": F.year(t),
    })


def month_period(c) -> Column:
    """Row 21: first day of the month."""
    return F.trunc(_c(c), "MM")


def year_quarter_label(year: Column, quarter: Column) -> Column:
    """Row 22: ``2024-Q1``."""
    return F.concat_ws("-Q", year.cast("string"), quarter.cast("string"))


def format_date(c) -> Column:
    """Row 23: ``yyyy-MM-dd``."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def floor_days(later, earlier) -> Column:
    """Row 24: whole days between two times, floored (not calendar days)."""
    return F.floor((us(later) - us(earlier)) / F.lit(DAY_US)).cast("bigint")


def floor_days_us(later_us: Column, earlier_us: Column) -> Column:
    """Whole days between two microsecond instants, floored, in integer arithmetic."""
    d = later_us - earlier_us
    # d - pmod(d, DAY) is an exact multiple of DAY, so the quotient is exact
    return ((d - F.pmod(d, F.lit(DAY_US))) / F.lit(DAY_US)).cast("bigint")


def title_case(c) -> Column:
    """Row 25: Python ``str.title`` for snake words: ``long_rains`` -> ``Long_Rains``."""
    return F.replace(F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("_"))


def round_pct(part: Column, total: Column, places: int = 4) -> Column:
    """Row 26: share of a total in percent, rounded."""
    return F.round(part * F.lit(100.0) / total, places)


def weekday_name(code: Column) -> Column:
    """Row 27: 0..6 (Monday = 0) -> name."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), (code + 1).cast("int"))


def month_name(code: Column) -> Column:
    """Row 27: 1..12 -> name."""
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), code.cast("int"))
