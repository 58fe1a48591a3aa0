"""Means, star buckets and colour bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rating_sum(rating: Column, exact_scale: int | None = None) -> Column:
    """Sum of ratings. Half-step ratings add up exactly as doubles; for other inputs `exact_scale` names the number of
    decimals they carry, and the sum is then taken in decimals so that the order of rows cannot change it.

    Ratings no such decimal can hold (NaN, infinite, too large) count as they do without `exact_scale`: they are added as
    doubles, so NaN makes the sum NaN, and every rating that is counted is also in the sum.
    """
    if exact_scale is None:
        return F.sum(rating)
    exact = rating.try_cast(f"decimal(18,{exact_scale})")
    held, others = F.sum(exact).cast("double"), F.sum(F.when(exact.isNull(), rating))
    return F.coalesce(held + others, held, others)


def rounded_mean(total: Column, count: Column) -> Column:
    """C4: mean to two decimals, half up; NULL without ratings."""
    return F.round(F.try_divide(total, count), 2)


def is_number(value: Column) -> Column:
    """neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def star_buckets(rating: Column) -> tuple[Column, Column, Column]:
    """Of five stars, how many are full, half and empty. A missing or NaN rating has five empty ones."""
    usable = F.when(is_number(rating), rating).otherwise(F.lit(0.0))
    full = F.greatest(F.least(F.floor(usable), F.lit(5)), F.lit(0)).cast("int")
    half = F.when((full < 5) & (usable >= full + 0.5), 1).otherwise(0)
    return full, half, F.lit(5) - full - half


def rating_band(rating: Column) -> Column:
    """P10: `high` from 4, `mid` from 3, otherwise `low`; a missing or NaN rating is `low`."""
    return F.when(~is_number(rating), "low").when(rating >= 4, "high").when(rating >= 3, "mid").otherwise("low")
