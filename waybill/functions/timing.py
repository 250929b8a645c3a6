"""Time parts, delivery timing rules and run ids as column expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.geo import col
from waybill.schemas import ON_TIME_MINUTES, PEAK_HOURS

MICROS_PER_MINUTE = 60 * 1_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# Fixed value: compact run id.
RUN_ID_FORMAT = "%Y%m%d%H%M%S"
RUN_ID_PATTERN = "yyyyMMddHHmmss"


def micros(ts: Column | str) -> Column:
    """Timestamp as microseconds since the epoch."""
    return F.unix_micros(col(ts))


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def delay_minutes(actual="actual_delivery_minutes", expected="expected_delivery_minutes") -> Column:
    """Minutes over the expectation; negative when early."""
    return col(actual) - col(expected)


def delay_flag(delay: Column | str) -> Column:
    return flag(col(delay) > ON_TIME_MINUTES)


def on_time_flag(delay: Column | str) -> Column:
    return flag(col(delay) <= ON_TIME_MINUTES)


def clip(value: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (``least``/``greatest`` would skip it)."""
    value = col(value)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def traffic_score(actual="actual_delivery_minutes", expected="expected_delivery_minutes") -> Column:
    """How far the actual time exceeds the expected one, 0-10, one decimal (ties to even).

    With zero expected minutes the ratio is infinite: 10 or 0 by its sign, null for 0/0.
    """
    actual, expected = col(actual).cast("double"), col(expected).cast("double")
    no_expectation = F.when(actual > 0, F.lit(10.0)).when(actual < 0, F.lit(0.0))
    score = F.bround(clip((actual / F.when(expected != 0, expected) - 1) * 10, 0.0, 10.0), 1)
    return F.when(expected == 0, no_expectation).otherwise(score)


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", col(ts))


def day_of_week(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(ts))


def is_peak_hour(hour: Column | str) -> Column:
    return flag(col(hour).isin(PEAK_HOURS))


def plus_minutes(ts: Column | str, minutes: Column | str) -> Column:
    zero = F.lit(0)
    return col(ts) + F.make_dt_interval(zero, zero, col(minutes), F.lit(0).cast("decimal(18,6)"))


def delivered_at(created="created_at", actual="actual_delivery_minutes") -> Column:
    return plus_minutes(created, actual)


def is_late(event_ts: Column | str, deadline: Column | str, grace_minutes: int = 0) -> Column:
    """Event strictly after the deadline plus grace; unknown deadlines are not late."""
    limit = plus_minutes(deadline, F.lit(grace_minutes)) if grace_minutes else col(deadline)
    return F.coalesce(col(event_ts) > limit, F.lit(False))


def percentage(share: Column, digits: int = 2) -> Column:
    """Share as a percentage, ties to even."""
    return F.bround(share * 100, digits)


def relative_variance(source: Column | str, target: Column | str) -> Column:
    source, target = col(source), col(target)
    return F.abs(target - source) / F.greatest(source, F.lit(1))


def run_id(at: datetime) -> str:
    """The run's moment to the second; a fraction follows where it has one, so runs of one second stay apart."""
    return at.strftime(RUN_ID_FORMAT) + (f"-{at.microsecond:06d}" if at.microsecond else "")


def run_id_of(ts: Column | str) -> Column:
    part = F.pmod(micros(ts), F.lit(1_000_000))
    return F.concat(F.date_format(col(ts), RUN_ID_PATTERN), F.when(part == 0, "").otherwise(F.concat(F.lit("-"), F.lpad(part.cast("string"), 6, "0"))))


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text; fractions only where there are any."""
    ts = col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.pmod(micros(ts), F.lit(1_000_000)) == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def parse_iso(text: Column | str) -> Column:
    """ISO text with or without fractions to a timestamp, null when it is neither."""
    return F.try_to_timestamp(col(text))


def to_utc(df: DataFrame, name: str, local_zone: str | None = None) -> DataFrame:
    """Column as a UTC instant; naive local times are shifted from ``local_zone``."""
    value = F.col(name).cast("timestamp")
    return df.withColumn(name, F.to_utc_timestamp(value, local_zone) if local_zone else value)


# Partition levels (fixed values): column name and text pattern of each level.
DATE_LEVELS = {"year": "yyyy", "month": "MM", "day": "dd"}


def date_levels(depth: str = "year/month/day") -> list[str]:
    return [level for level in DATE_LEVELS if level in depth]


def with_date_levels(df: DataFrame, ts: Column | str, depth: str = "year/month/day") -> DataFrame:
    """Add zero-padded partition columns for a date."""
    return df.withColumns(
        {level: F.date_format(col(ts), DATE_LEVELS[level]) for level in date_levels(depth)}
    )


def partition_path(ts: Column | str, depth: str = "year/month/day") -> Column:
    """Partition path text such as ``year=2024/month=01/day=15``."""
    pattern = "/".join(f"'{level}='{DATE_LEVELS[level]}" for level in date_levels(depth))
    return F.date_format(col(ts), pattern) if pattern else F.lit("")


def instant(at: datetime | str) -> Column:
    """A moment as a literal; without a zone it is UTC, wherever the driver runs. A text is read in the session's zone."""
    if isinstance(at, str):
        return F.lit(at).cast("timestamp")
    return F.lit(at if at.tzinfo else at.replace(tzinfo=timezone.utc)).cast("timestamp")
