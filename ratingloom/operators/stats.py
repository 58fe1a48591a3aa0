"""Rating statistics.

Everything starts from per-key totals (sum and count), which Spark combines on the map side: a movie that holds a third
of all ratings reaches the shuffle as one row per input partition. Joins to movies and genres come after the totals, so
they see one row per movie instead of one per rating, and reuse the partitioning by movie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.fixed_values import GENRE_SEPARATOR, MIN_VOTES, TEXT_OUTPUT_SEPARATOR
from ratingloom.functions.numbers import rating_sum, rounded_mean
from ratingloom.functions.text import real_number

# Fixed value: the mean of the strict text output has two decimals.
MEAN_FORMAT = "%.2f"


def rating_totals(ratings: DataFrame, *keys: str, exact_scale: int | None = None) -> DataFrame:
    """Sum (`total`) and number (`votes`) of the ratings per key; NULL ratings count nowhere, but keep their key."""
    return ratings.groupBy(*keys).agg(
        rating_sum(F.col("rating"), exact_scale).alias("total"), F.count("rating").alias("votes")
    )


def rating_cube(ratings: DataFrame) -> DataFrame:
    """Votes per movie and rating value. With a rating scale of few steps this is as small as the list of movies, and
    all batch outputs follow from it, so that the raw ratings are read once.
    """
    return ratings.groupBy("movieId", "rating").agg(F.count("rating").alias("votes"))


def cube_totals(cube: DataFrame, *keys: str) -> DataFrame:
    """`rating_totals` of the ratings behind a cube."""
    return cube.groupBy(*keys).agg(
        F.sum(F.col("rating") * F.col("votes")).alias("total"), F.sum("votes").alias("votes")
    )


def mean_and_votes(totals: DataFrame, *keys: str, votes_name: str = "totalVotes") -> DataFrame:
    return totals.select(
        *keys,
        rounded_mean(F.col("total"), F.col("votes")).alias("avgRating"),
        F.col("votes").alias(votes_name),
    )


def movie_stats(ratings: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """A2: movieId, avgRating, totalVotes."""
    return mean_and_votes(rating_totals(ratings, "movieId", exact_scale=exact_scale), "movieId")


def live_movie_stats(unified: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """A5: movieId, source, avgRating, totalVotes; on a stream it keeps one state entry per pair."""
    keys = ("movieId", "source")
    return mean_and_votes(rating_totals(unified, *keys, exact_scale=exact_scale), *keys)


def with_titles(stats: DataFrame, movies: DataFrame) -> DataFrame:
    """Stats of known movies with their titles."""
    return stats.join(movies.select("movieId", "title"), "movieId").select(
        "movieId", "title", "avgRating", "totalVotes"
    )


def movie_genres(movies: DataFrame) -> DataFrame:
    """One row per movie and genre. No genre list, no row; an empty list is the genre ''."""
    return movies.select("movieId", F.explode(F.split("genres", f"[{GENRE_SEPARATOR}]", -1)).alias("genre"))


def genre_stats(totals: DataFrame, movies: DataFrame) -> DataFrame:
    """Genre, avgRating, totalRatings from the totals per movie; a rating counts once per genre of its movie."""
    per_genre = (
        totals.join(movie_genres(movies), "movieId")
        .groupBy("genre")
        .agg(F.sum("total").alias("total"), F.sum("votes").alias("votes"))
    )
    return mean_and_votes(per_genre, "genre", votes_name="totalRatings")


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """A4: votes per rating value; NULL ratings make a row with count 0."""
    return ratings.groupBy("rating").agg(F.count("rating").alias("count"))


def cube_distribution(cube: DataFrame) -> DataFrame:
    """`rating_distribution` of the ratings behind a cube."""
    return cube.groupBy("rating").agg(F.sum("votes").alias("count"))


def enough_votes(stats: DataFrame, min_votes: int = MIN_VOTES) -> DataFrame:
    """F7."""
    return stats.where(F.col("totalVotes") >= min_votes)


def strict_means(pairs: DataFrame) -> DataFrame:
    """movieId, avg (text, two decimals), count of the strictly parsed pairs.

    Ratings that are no number do not count, and a movie without any other has no row.
    """
    return (
        pairs.select("movieId", real_number(F.col("rating")).alias("rating"))
        .where(F.col("rating").isNotNull())
        .groupBy("movieId")
        .agg(F.sum("rating").alias("total"), F.count("rating").alias("count"))
        .select(
            "movieId", F.format_string(MEAN_FORMAT, F.col("total") / F.col("count")).alias("avg"), "count"
        )
    )


def strict_mean_lines(means: DataFrame, partitions: int | None = None) -> DataFrame:
    """`value` lines in key order within each partition.

    The means are already partitioned by movie; only an explicit number of `partitions` moves them again.
    """
    spread = means if partitions is None else means.repartition(partitions, "movieId")
    return spread.sortWithinPartitions("movieId").select(
        F.concat_ws(TEXT_OUTPUT_SEPARATOR, "movieId", "avg", F.col("count").cast("string")).alias("value")
    )


def source_stats(unified: DataFrame, relative_error: float = 0.05, exact_scale: int | None = None) -> DataFrame:
    """Source, totalRatings, avgRating and approximate uniqueMovies; works on streams."""
    return (
        unified.groupBy("source")
        .agg(
            rating_sum(F.col("rating"), exact_scale).alias("total"),
            F.count("rating").alias("votes"),
            F.approx_count_distinct("movieId", relative_error).alias("uniqueMovies"),
        )
        .select(
            "source",
            F.col("votes").alias("totalRatings"),
            rounded_mean(F.col("total"), F.col("votes")).alias("avgRating"),
            "uniqueMovies",
        )
    )


def source_stats_exact(unified: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """The batch twin of `source_stats` with an exact uniqueMovies.

    Grouping by (source, movie) first spreads a large source over all tasks.
    """
    return (
        rating_totals(unified, "source", "movieId", exact_scale=exact_scale)
        .groupBy("source")
        .agg(
            F.sum("total").alias("total"),
            F.sum("votes").alias("votes"),
            F.count("movieId").alias("uniqueMovies"),
        )
        .select(
            "source",
            F.col("votes").alias("totalRatings"),
            rounded_mean(F.col("total"), F.col("votes")).alias("avgRating"),
            "uniqueMovies",
        )
    )


def stats_with_stddev(ratings: DataFrame, *keys: str, exact_scale: int | None = None) -> DataFrame:
    """Keys, avgRating, totalVotes, stddev. The deviation is that of a sample: NULL for a single vote."""
    stats = ratings.groupBy(*keys).agg(
        rating_sum(F.col("rating"), exact_scale).alias("total"),
        F.count("rating").alias("votes"),
        F.stddev_samp("rating").alias("stddev"),
    )
    return stats.select(
        *keys,
        rounded_mean(F.col("total"), F.col("votes")).alias("avgRating"),
        F.col("votes").alias("totalVotes"),
        "stddev",
    )


def is_extreme(rating: Column) -> Column:
    return (rating <= 1.0) | ((rating >= 5.0) & ~F.isnan(rating))


def rating_alerts(ratings: DataFrame, min_share: float = 0.5, min_total: int = 1) -> DataFrame:
    """movieId, alertType, total, extremeCount, avgRating of movies where at least `min_share` of the ratings are
    1 or lower, or 5 or higher. The rule is ours: alerts have a place to be stored, but no definition to match.
    """
    counted = ratings.groupBy("movieId").agg(
        F.sum("rating").alias("sum"),
        F.count("rating").alias("total"),
        F.count_if(is_extreme(F.col("rating"))).alias("extremeCount"),
    )
    return counted.where(
        (F.col("total") >= max(min_total, 1)) & (F.col("extremeCount") >= F.col("total") * F.lit(min_share))
    ).select(
        "movieId",
        F.lit("extreme_ratings").alias("alertType"),
        "total",
        "extremeCount",
        rounded_mean(F.col("sum"), F.col("total")).alias("avgRating"),
    )


def row_count(rows: DataFrame, name: str = "count") -> DataFrame:
    """Number of movies with stats, number of genres."""
    return rows.agg(F.count("*").alias(name))


def total_ratings(distribution: DataFrame) -> DataFrame:
    """All ratings of a distribution."""
    return distribution.agg(F.sum("count").alias("total"))
