"""Time zones: detection, conversion to UTC, daylight saving."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.catalog import PLACE_ZONES
from vitalgrid.operators.columns import add_calendar
from vitalgrid.plans.summaries import mode_of


def zone_of(place: Column) -> Column:
    """The zone of a place by name, or the place itself when it names a zone, else UTC."""
    lowered = F.lower(place)
    by_name = F.lit(None).cast("string")
    for name, zone in reversed(PLACE_ZONES.items()):
        by_name = F.when(lowered.contains(name), F.lit(zone)).otherwise(by_name)
    named = F.when(place.isin(*sorted(available_timezones())), place)
    return F.coalesce(by_name, named, F.lit("UTC"))


def to_utc(local: Column, zone: Column) -> Column:
    return F.to_utc_timestamp(local, zone)


def normalize_timestamps(
    df: DataFrame, ts: str, zone: Column, target: str = "UTC", calendar: bool = True
) -> DataFrame:
    """Local wall times to ``target`` time, each row by its own zone. ``nonexistent_shifted`` marks
    wall times skipped in spring (moved forward by the gap), ``ambiguous`` those that occur twice
    in autumn (read with the earlier offset)."""
    kind = df.schema[ts].dataType
    local = F.col(ts).cast("timestamp")
    utc = F.to_utc_timestamp(local, zone)
    back = F.from_utc_timestamp(utc, zone)
    twice = F.lit(False)
    for minutes in (30, 60):
        shift = F.make_dt_interval(mins=F.lit(minutes))
        twice = twice | (F.from_utc_timestamp(utc + shift, zone) == local)
        twice = twice | (F.from_utc_timestamp(utc - shift, zone) == local)
    moved = df.withColumns(
        {
            "timestamp_utc": utc.cast(kind),
            "nonexistent_shifted": back != local,
            "ambiguous": twice,
            ts: (utc if target == "UTC" else F.from_utc_timestamp(utc, F.lit(target))).cast(kind),
        }
    )
    return add_calendar(moved, ts) if calendar else moved


def _offset_hours(utc: Column, zone: Column) -> Column:
    return (F.unix_micros(F.from_utc_timestamp(utc, zone)) - F.unix_micros(utc)) / F.lit(3600e6)


def mark_daylight_saving(df: DataFrame, utc: str, zone: Column) -> DataFrame:
    """``dst_offset`` hours above the standard offset (the smaller one of January and July)."""
    t = F.col(utc).cast("timestamp")
    year = F.year(t)
    january = F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    july = F.make_timestamp(year, F.lit(7), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    standard = F.least(_offset_hours(january, zone), _offset_hours(july, zone))
    offset = _offset_hours(t, zone) - standard
    return df.withColumns({"is_dst": offset != 0, "dst_offset": offset})


def peak_hour(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    hours = df.select(*keys, F.hour(ts).alias("peak_hour"))
    return mode_of(hours, keys, "peak_hour")
