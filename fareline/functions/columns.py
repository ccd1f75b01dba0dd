"""Column expressions shared by the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the period inside a file name.
PERIOD_PATTERN = "[0-9]{4}-[0-9]{2}"

# Fixed value: text form of a timestamp inside the trip key.
KEY_TIME = "yyyy-MM-dd HH:mm:ss"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def seconds_between(start: Column, end: Column) -> Column:
    """Second marks crossed from start to end (fractions are dropped on both sides first)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute marks crossed from start to end."""

    def minute(ts: Column) -> Column:
        return F.floor(F.unix_timestamp(ts) / 60)

    return minute(end) - minute(start)


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def date_key(ts: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def yes_no(text: Column) -> Column:
    """Y -> true, N -> false, anything else -> NULL."""
    letter = F.upper(F.trim(text))
    return F.when(letter == "Y", True).when(letter == "N", False)


def text_or_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def file_period(file_name: Column) -> Column:
    """First day of the month named in the file name; NULL when it names none.

    An impossible month raises (ANSI mode), so a bad name stops the load.
    """
    month = F.regexp_substr(file_name, F.lit(PERIOD_PATTERN))
    return F.to_date(F.concat(month, F.lit("-01")))


def trip_key(vendor: Column, pickup: Column, dropoff: Column, origin: Column, dest: Column) -> Column:
    """MD5 over the five parts that identify a trip; NULL as soon as one part is NULL."""
    parts = [
        vendor.cast("string"),
        F.date_format(pickup, KEY_TIME),
        F.date_format(dropoff, KEY_TIME),
        origin.cast("string"),
        dest.cast("string"),
    ]
    missing = any_of([part.isNull() for part in (vendor, pickup, dropoff, origin, dest)])
    return F.when(~missing, F.md5(F.concat_ws("|", *parts)))


def pick(index: Column, words: tuple[str, ...]) -> Column:
    """Word at a 1-based position."""
    return F.element_at(F.array(*[F.lit(word) for word in words]), index)


def row_hash(names: list[str]) -> Column:
    """64-bit hash of a row. The places of its NULLs are part of it: a hash alone passes over them."""
    empty = F.concat(*[F.when(F.col(name).isNull(), "1").otherwise("0") for name in names])
    return F.xxhash64(*names, empty)
