"""Source reliability, interest and the scores made of them."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Index and rating of an outlet without a usable card.
DEFAULT_INDEX, DEFAULT_RATING = 4.5, "F"


def reliability_index(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text.cast("string")), F.lit("")).try_cast("double"), F.lit(DEFAULT_INDEX))


def rating(text: Column) -> Column:
    return F.upper(F.trim(F.coalesce(F.nullif(text, F.lit("")), F.lit(DEFAULT_RATING))))


def score_columns(index: Column, interest: Column) -> dict[str, Column]:
    reliability = F.round(F.lit(0.6) / index, 4)
    marine = F.round(interest * 0.4 / 40, 4)
    return {"reliability2": reliability, "marine": marine, "reliability_score": F.round(F.lit(40.0) / index, 4), "composite": F.round(reliability + marine, 4)}


def whole_composite(index: Column, interest: Column) -> Column:
    """The composite as a full rescan makes it: rounded once, from terms that are not."""
    return F.round(F.lit(0.6) / index + interest * 0.4 / 40, 4)


def round_exact(value: Column, places: int = 2) -> Column:
    """A number of up to 2^45 rounded on its exact binary value, ties away from zero.

    ``value * 10^places`` is taken as the exact sum of two doubles (the value is split into halves of 26 bits), so a product
    that only looks like a tie after rounding is told from one that is.
    """
    factor = F.lit(float(10**places))
    size = F.abs(value)
    big = size * 134217729.0  # 2^27 + 1
    high = big - (big - size)
    a, b = high * factor, (size - high) * factor
    near = a + b
    rest = b - (near - a)
    whole = F.floor(near).cast("double")
    over = near - whole
    up = (over > 0.5) | ((over == 0.5) & (rest >= 0))
    return F.signum(value) * (whole + F.when(up, 1.0).otherwise(0.0)) / factor


def security(index: Column, interest: Column) -> Column:
    """(6 - index) * interest / 100 to two places, rounded on its exact binary value; a missing index is 5 here."""
    return round_exact((F.lit(6.0) - F.coalesce(index, F.lit(5.0))) * F.coalesce(interest, F.lit(0.0)) / 100)


def interest_bucket(value: Column) -> Column:
    """0 for none, then one bucket per started ten, over 50 in the last."""
    return F.when(F.coalesce(value, F.lit(0.0)) <= 0, 0).otherwise(F.least(F.ceil(value / 10), F.lit(6)).cast("int"))


def site_number(text: Column) -> Column:
    """A number as the site shows it: decimal commas are read, four places kept; null if it is none."""
    return F.round(F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast("double"), 4)


def percent_of_max(value: Column) -> Column:
    """Length of a bar against the largest of a (small, aggregated) table, of which 1 is the least."""
    return F.round(value * 100 / F.greatest(F.max(value).over(Window.partitionBy(F.lit(0))), F.lit(1)))
