"""Labels and flags derived from hours, keys and event fields."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import schemas as S


def part_of_day(hour: Column) -> Column:
    return (
        F.when(hour < S.AFTERNOON_FROM, "Morning")
        .when(hour < S.EVENING_FROM, "Afternoon")
        .otherwise("Evening")
    )


def is_rush_hour(hour: Column) -> Column:
    return hour.isin(*S.RUSH_HOURS)


def time_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def hour_range_label(hour: Column) -> Column:
    return F.format_string("%02d:00 - %02d:00", hour, hour + 1)


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def in_store_hours(hour: Column) -> Column:
    return hour.between(S.OPEN_HOUR, S.LAST_HOUR)


def day_number(ts: Column, first_day: str) -> Column:
    """1 for ``first_day`` (ISO text), counting calendar days."""
    return (F.datediff(ts, F.lit(first_day).cast("date")) + 1).cast("int")


def at_clock(day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A date plus a time of day, as a timestamp without time zone."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(
        hours=hour, mins=minute, secs=second.cast("decimal(18,6)")
    )


def time_key(day: Column, hour: Column) -> Column:
    """Key of a (day, open hour) row, computable on both sides so that no lookup join is needed.
    NULL outside store hours, when no such row exists."""
    hours = S.LAST_HOUR - S.OPEN_HOUR + 1
    key = (day.cast("long") - 1) * hours + (hour - S.OPEN_HOUR) + 1
    return F.when(in_store_hours(hour), key)


def flag_label(flag: Column, yes: str, no: str) -> Column:
    """SQL CASE on a flag: NULL takes the ELSE label."""
    return F.when(flag, yes).otherwise(no)


def recode(value: Column, mapping: Mapping[object, str]) -> Column:
    """Dictionary recode: a value without an entry becomes NULL."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, value)


def flag_from_text(value: Column) -> Column:
    """``t``/``f`` as Postgres exports it, or ``True``/``False``; anything else is NULL."""
    text = F.lower(F.trim(value))
    return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)


def or_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def cart_text(items: Column) -> Column:
    """``[{2, A}, {1, B}]`` as ``2x A, 1x B``."""
    parts = F.transform(
        items, lambda i: F.concat(i["quantity"].cast("string"), F.lit("x "), i["product"])
    )
    return F.array_join(parts, ", ")
