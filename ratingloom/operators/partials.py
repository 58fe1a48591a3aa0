"""Partial statistics that can be merged: over micro-batches, days or sources.

Sums of ratings are kept as decimals, so that no order of merging changes them; ratings that no such decimal holds (NaN,
infinite, beyond a million) are added as doubles. Distinct movies are kept as a sketch, which has a bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.numbers import rounded_mean

LARGEST_EXACT = 1_000_000
# Of a sketch, the logarithm of its size, and the relative standard error that comes with it (at most 1.04 / sqrt(size)).
SKETCH_LOG_SIZE = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG_SIZE / 2)

SOURCE_PARTS = "source STRING, votes BIGINT, exact DECIMAL(38, 2), other DOUBLE, movies BINARY"


def exact_rating(rating: Column, scale: int = 2) -> Column:
    """The rating as a decimal, NULL if none holds it."""
    return F.when(F.abs(rating) <= LARGEST_EXACT, rating.try_cast(f"decimal({7 + scale},{scale})"))


def sum_parts(rating: Column, scale: int = 2) -> list[Column]:
    """Aggregates `votes`, `exact` and `other` of the ratings."""
    exact = exact_rating(rating, scale)
    return [
        F.count(rating).alias("votes"),
        F.sum(exact).cast(f"decimal(38,{scale})").alias("exact"),
        F.sum(F.when(exact.isNull(), rating)).alias("other"),
    ]


def square_parts(rating: Column, scale: int = 2) -> list[Column]:
    """Aggregates `exact_squares` and `other_squares`, the sums of squares."""
    exact = exact_rating(rating, scale)
    return [
        F.sum(exact * exact).cast(f"decimal(38,{2 * scale})").alias("exact_squares"),
        F.sum(F.when(exact.isNull(), rating * rating)).alias("other_squares"),
    ]


def total(exact: Column, other: Column) -> Column:
    held = exact.cast("double")
    return F.coalesce(held + other, held, other)


def mean() -> Column:
    """C4 of merged parts."""
    return rounded_mean(total(F.col("exact"), F.col("other")), F.col("votes"))


def deviation() -> Column:
    """A11 of merged parts: the deviation of a sample, NULL for a single vote."""
    n = F.col("votes")
    summed = total(F.col("exact"), F.col("other"))
    spread = total(F.col("exact_squares"), F.col("other_squares")) - summed * summed / n
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))


def source_parts(ratings: DataFrame, scale: int = 2, log_size: int = SKETCH_LOG_SIZE) -> DataFrame:
    """Per source: votes, sums, and a sketch of its movies. Sketches are built on the map side, at most 2^log_size bytes each."""
    # An empty text counts in no sketch, so every movie gets a character in front.
    movie = F.concat(F.lit("_"), "movieId")
    return ratings.groupBy("source").agg(
        *sum_parts(F.col("rating"), scale), F.hll_sketch_agg(movie, log_size).alias("movies")
    )


def merged_sources(parts: DataFrame) -> DataFrame:
    """Parts of the same sources as one row each; the union of sketches is the sketch of the union."""
    return parts.groupBy("source").agg(
        F.sum("votes").alias("votes"),
        F.sum("exact").cast("decimal(38,2)").alias("exact"),
        F.sum("other").alias("other"),
        F.hll_union_agg("movies").alias("movies"),
    )


def source_stats(parts: DataFrame) -> DataFrame:
    """A6 of merged parts: source, totalRatings, avgRating and approximate uniqueMovies."""
    return parts.select(
        "source",
        F.col("votes").alias("totalRatings"),
        mean().alias("avgRating"),
        F.hll_sketch_estimate("movies").alias("uniqueMovies"),
    )


def movie_moments(ratings: DataFrame, *also: Column, scale: int = 2) -> DataFrame:
    """Per movie and source: votes, sums and sums of squares; a few numbers of streaming state for each pair.

    `also` are further aggregates.
    """
    rating = F.col("rating")
    return ratings.groupBy("movieId", "source").agg(*sum_parts(rating, scale), *square_parts(rating, scale), *also)


def movie_stats(moments: DataFrame, *also: str) -> DataFrame:
    """A5 with A11: movieId, source, avgRating, totalVotes, stddev."""
    return moments.select(
        "movieId", "source", mean().alias("avgRating"), F.col("votes").alias("totalVotes"), deviation().alias("stddev"), *also
    )
