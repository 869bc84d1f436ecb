"""Column functions over half-hourly time: local clock, slots, seasons, grids, and a few numeric ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 1800  # seconds


def to_local(ts: Column | str, zone: str = "Europe/London") -> Column:
    """UTC clock time to local clock time, both without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts) if isinstance(ts, str) else ts)


def slot(ts: Column | str) -> Column:
    """Half-hour of the day, 0 to 47."""
    return F.hour(ts) * 2 + F.floor(F.minute(ts) / 30).cast("int")


def as_of(moment: str | None = None) -> Column:
    """The pipeline's now: a given moment, else the clock."""
    return F.lit(moment).cast("timestamp_ntz") if moment else F.localtimestamp()


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "Winter").when(month.between(3, 5), "Spring").when(month.between(6, 8), "Summer").otherwise("Autumn")


def season_order(name: str) -> Column:
    return F.array_position(F.array(*map(F.lit, ("Winter", "Spring", "Summer", "Autumn"))), F.col(name)).cast("int")


def date_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def iso_weekday(day: Column | str) -> Column:
    return F.weekday(day) + 1


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def floor_half_hour(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts - F.make_dt_interval(mins=F.minute(ts) % 30, secs=F.date_part(F.lit("SECOND"), ts))


def ceil_half_hour(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    floor = floor_half_hour(ts)
    return F.when(floor == ts, ts).otherwise(floor + F.expr("INTERVAL 30 MINUTES"))


def year_split(ts: Column | str) -> Column:
    """The last half-hour of the year that ts + 30 minutes lies in: no interval may cross it."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    following = F.year(ts + F.expr("INTERVAL 30 MINUTES")) + 1
    return F.make_timestamp_ntz(following, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) - F.expr("INTERVAL 30 MINUTES")


def slot_label(number: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(number / 2).cast("int"), (number % 2) * 30)


def year_angle(day: Column | str) -> Column:
    return 2 * F.pi() * (F.dayofyear(day) - 1) / 365.25


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def grid_index(ts: Column | str, start: Column | str) -> Column:
    """Position on the half-hour grid that begins at start; null where ts is off the grid."""
    seconds = epoch_seconds(ts) - epoch_seconds(start)
    return F.when(seconds % STEP == 0, (seconds / STEP).cast("long"))


def grid_time(index: Column | str, start: Column | str) -> Column:
    start = F.col(start) if isinstance(start, str) else start
    index = F.col(index) if isinstance(index, str) else index
    return F.timestamp_add("MINUTE", index.cast("int") * 30, start)


def is_interval(start: Column | str, end: Column | str) -> Column:
    """Both ends on half-hours and in order."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return (epoch_seconds(start) % STEP == 0) & (epoch_seconds(end) % STEP == 0) & (end > start)


def lead_band(horizon: Column) -> Column:
    """Quarter-day number of a horizon in half-hours."""
    return F.floor((horizon - 1) / 12).cast("int")


def last_known_offset(horizon: Column) -> Column:
    """Half-hours back from the target to the same slot of the last day known at the origin."""
    return (F.ceil(horizon / 48) * 48).cast("int")


# A published rational approximation of erfc on x >= 0, as (t = 1 / (1 + p x)) polynomial, error below 1.5e-7.
ERFC_P = 0.3275911
ERFC_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc(x: Column) -> Column:
    t = 1 / (1 + ERFC_P * F.abs(x))
    poly = F.lit(0.0)
    for a in reversed(ERFC_A):
        poly = (poly + a) * t
    tail = poly * F.exp(-x * x)
    return F.when(x >= 0, tail).otherwise(2 - tail)


def shown_p(p: Column) -> Column:
    return F.when(p < 0.001, F.lit("<0.001")).otherwise(F.format_string("%.3f", p))
