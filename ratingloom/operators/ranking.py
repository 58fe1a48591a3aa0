"""Orders, top lists and tails per movie.

Ties are settled by further columns, so a run gives the same rows every time. For the full sorts that also matters for
balance: rounded means take few values, and a range partitioning on them alone would put most rows into few tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.fixed_values import (
    FEED_SIZE,
    MIN_VOTES,
    RECENT_PER_MOVIE,
    SAMPLE_SIZE,
    TOP_MOVIES,
    TOP_STRICT_MEANS,
    UNKNOWN_MOVIE,
)
from ratingloom.functions.numbers import is_number, rounded_mean
from ratingloom.operators.stats import enough_votes


def by_rating(stats: DataFrame) -> DataFrame:
    """O1: movie stats, best first."""
    return stats.orderBy(F.desc_nulls_last("avgRating"), F.desc("totalVotes"), "movieId")


def top_movies(stats: DataFrame, k: int = TOP_MOVIES, min_votes: int = MIN_VOTES) -> DataFrame:
    """The `k` best movies with at least `min_votes`."""
    return by_rating(enough_votes(stats, min_votes)).limit(k)


def genres_by_rating(genre_stats: DataFrame) -> DataFrame:
    """O3: genres, best first."""
    return genre_stats.orderBy(F.desc_nulls_last("avgRating"), "genre")


def by_rating_value(distribution: DataFrame) -> DataFrame:
    """The histogram in ascending order, a NULL rating first."""
    return distribution.orderBy(F.asc_nulls_first("rating"))


def top_strict_means(means: DataFrame, k: int = TOP_STRICT_MEANS) -> DataFrame:
    """The `k` best of the strict means as read back."""
    return means.orderBy(F.desc("avgRating"), "movieId").limit(k)


def _latest_first() -> list[Column]:
    return [F.desc_nulls_last("event_ts"), F.asc("userId"), F.asc("rating"), F.asc("source")]


def recent_per_movie(archive: DataFrame, n: int = RECENT_PER_MOVIE) -> DataFrame:
    """The `n` latest ratings of each movie; ratings without a movie share one group.

    The rank limit stands directly on the window, so Spark keeps only `n` rows per movie and input partition before
    the shuffle; no movie arrives whole in one task. Spark does so up to its `windowGroupLimitThreshold`; a larger `n`
    takes a first pass over slices of each movie.
    """
    rows = archive.withColumn("movieId", F.coalesce("movieId", F.lit(UNKNOWN_MOVIE)))
    threshold = int(archive.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        slice_of = F.pmod(F.xxhash64("userId", "event_ts", "source"), F.lit(256))
        rows = _first_per_group(rows.withColumn("slice", slice_of), ["movieId", "slice"], n).drop("slice")
    return _first_per_group(rows, ["movieId"], n)


def _first_per_group(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*_latest_first())
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n).drop("rank")


def shuffled_sample(rows: DataFrame, n: int = SAMPLE_SIZE, seed: int = 0) -> DataFrame:
    """`n` rows in an order without pattern that depends on the rows and `seed` alone.

    A digest stands in for a random number: it gives the same sample however the rows are partitioned, also when a lost
    task is run again.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "movieId", "userId", "source", F.col("event_ts").cast("string")))
    return rows.orderBy(digest, "rating").limit(n)


def recent_feed(sample: DataFrame, n: int = FEED_SIZE) -> DataFrame:
    """The `n` latest rows of the sample, latest first."""
    return sample.orderBy(*_latest_first(), "movieId").limit(n)


def sample_means(sample: DataFrame) -> DataFrame:
    """Mean rating per movie of the sample in ascending order of movies, an empty id being unknown."""
    movie = F.when(F.col("movieId") != "", F.col("movieId")).otherwise(UNKNOWN_MOVIE)
    return (
        sample.where(is_number(F.col("rating")))
        .groupBy(movie.alias("movieId"))
        .agg(F.sum("rating").alias("total"), F.count("rating").alias("votes"))
        .select("movieId", rounded_mean(F.col("total"), F.col("votes")).alias("avgRating"))
        .orderBy("movieId")
    )
