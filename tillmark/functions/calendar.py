"""Calendar and clock columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.config import DAY_NAMES, DAY_PARTS, OTHER_DAY_PART, WEEKEND_DAYS


def day_number(day: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(day) - 1


def day_name(day: Column) -> Column:
    # get(), as element_at() on an array of literals does not give null for a null index
    return F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), day_number(day))


def calendar_parts(day: Column, weekend: Iterable[int] = WEEKEND_DAYS) -> dict[str, Column]:
    return {
        "order_year": F.year(day),
        "order_month": F.month(day),
        "order_week": F.weekofyear(day),
        "day_of_week": day_number(day),
        "day_name": day_name(day),
        "is_weekend": F.coalesce(day_number(day).isin(*weekend), F.lit(False)),
    }


# A time of day as the exports write it; other spellings take the slower way through a cast.
_CANONICAL = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def clock_text(time: Column) -> Column:
    """A time of day as canonical HH:mm:ss text; anything that is no time of day is an error.

    Text, since a TIME column cannot be written to every sink.
    """
    moment = F.concat(F.lit("1970-01-01 "), time).cast("timestamp_ntz")
    return F.when(time.rlike(_CANONICAL), time).otherwise(
        F.substring(moment.cast("string"), 12, 15)
    )


def clock_hour(time: Column) -> Column:
    return F.substring(time, 1, 2).cast("int")


def day_part(hour: Column) -> Column:
    part = F.lit(OTHER_DAY_PART)
    for name, first, last in DAY_PARTS:  # the bands don't overlap
        part = F.when(hour.between(first, last), F.lit(name)).otherwise(part)
    return part
