"""Dates as written by feeds, to ``yyyy-MM-dd HH:mm`` in wall-clock time: offsets are dropped, not converted."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens.functions.text import once, strip

#: Forms that every feed date may have, tried in this order after the exact form; day before month. The ones of
#: RFC 2822 and ISO 8601 come first, those with names or slashes after them.
MAIL = ("d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm")
ISO = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyyMMdd")
OTHER = (
    "MMM d, yyyy HH:mm:ss", "MMM d, yyyy HH:mm", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy",
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd", "dd-MM-yyyy HH:mm", "dd-MM-yyyy",
    "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
)
WEEK = r"^([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?(?=$|[T ])"


def _trimmed(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def _plain(trimmed: Column) -> Column:
    """Without the weekday's name, parts of seconds and the zone."""
    plain = F.regexp_replace(trimmed, r"^[A-Za-z]{3,9}, ?(?=\d)", "")
    plain = F.regexp_replace(plain, r"(?<=\d{2}:\d{2})(?::(\d{2}))?(?:\.\d+)?\s*(?:Z|[A-Z]{2,4}|[+-]\d{2}:?\d{2})$", ":$1")
    plain = F.regexp_replace(plain, r"(?<=\d{2}:\d{2}:\d{2})\.\d+$", "")
    return F.regexp_replace(plain, r":$", "")


def _week_day(plain: Column) -> Column:
    """The date of an ISO week form, as text before what follows it; null if there is none or the year has no such week."""
    year, week, day = (F.nullif(F.regexp_extract(plain, WEEK, i), F.lit("")).cast("int") for i in (1, 2, 3))
    monday = F.date_trunc("week", F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))).cast("date")
    found = F.date_add(monday, (week - 1) * 7 + F.coalesce(day, F.lit(1)) - 1)
    return F.when(plain.rlike(WEEK) & (F.weekofyear(found) == week), F.concat(F.date_format(found, "yyyy-MM-dd"), F.regexp_replace(plain, WEEK, "")))


def _dated(trimmed: Column) -> Column:
    return once(_plain(trimmed), lambda plain: F.when(plain.rlike(WEEK), F.coalesce(_week_day(plain), plain)).otherwise(plain))


_PARTS = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "'T'": "T", "d": r"\d{1,2}"} | dict.fromkeys(("MM", "dd", "HH", "mm", "ss"), r"\d{2}")


def _shape(pattern: str) -> str:
    """A regular expression of what a pattern can read."""
    return "^" + re.sub("yyyy|MMMM|MMM|MM|dd|d|HH|mm|ss|'T'", lambda m: _PARTS[m[0]], pattern) + "$"


def _parsed(plain: Column, patterns: tuple[str, ...]) -> Column:
    """By the first pattern that reads it; one that cannot, by its shape, is not tried, as a failed parse is slow."""
    tried = [F.when(plain.rlike(_shape(p)), F.try_to_timestamp(plain, F.lit(p))) for p in patterns]
    return F.date_format(F.coalesce(*tried), "yyyy-MM-dd HH:mm")


def norm_date(text: Column) -> Column:
    """The normalised date; empty if nothing fits. The exact form is passed on without a check of its numbers."""

    def read(trimmed: Column) -> Column:
        exact = trimmed.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$")
        return F.when(exact, trimmed).otherwise(F.coalesce(once(_dated(trimmed), lambda dated: _parsed(dated, (*ISO, *MAIL, *OTHER))), F.lit("")))

    return once(_trimmed(text), read)


def to_iso(text: Column) -> Column:
    """What a collector keeps of a feed's date: the mail and ISO forms normalised, else the first 16 characters."""

    def read(trimmed: Column) -> Column:
        made = once(_dated(trimmed), lambda dated: _parsed(dated, (*MAIL, *ISO)))
        return F.when(trimmed == "", "").otherwise(F.coalesce(made, F.left(trimmed, F.lit(16))))

    return once(_trimmed(text), read)


def partition_key(text: Column) -> Column:
    """The day a row is stored under; null if the text does not start like a date."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def stored_timestamp(text: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(F.left(text, F.lit(16)), F.lit("yyyy-MM-dd HH:mm")), F.try_to_timestamp(F.left(text, F.lit(10)), F.lit("yyyy-MM-dd")))


def day_of(text: Column) -> Column:
    """The first ten characters; empty if there is no date."""
    return F.coalesce(F.left(text, F.lit(10)), F.lit(""))


def day_month_year(text: Column) -> Column:
    """``dd/MM/yyyy`` of a text that starts with an ISO date, else the text itself; empty if null."""
    return F.coalesce(F.regexp_replace(text, r"^(\d{4})-(\d{2})-(\d{2}).*$", "$3/$2/$1"), F.lit(""))


def site_window(day: Column, reference: Column, days: int = 7) -> Column:
    """From ``days`` - 1 days before the reference day to the day after it."""
    return day.between(F.date_sub(reference, days - 1), F.date_add(reference, 1))


def publishable(day: Column, reference: Column, days: int = 7) -> Column:
    """Undated, or older than the window by more than two days: no later run will change it."""
    return day.isNull() | (day < F.date_sub(reference, days + 2))
