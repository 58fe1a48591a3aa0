"""Names, stars and colour bands for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.fixed_values import MISSING_NAME
from ratingloom.functions.numbers import rating_band, star_buckets
from ratingloom.functions.text import is_numeric_id, words_from_slug

FEW_ROWS = 10_000


def movie_map(movie_stats: DataFrame) -> DataFrame:
    """One title per movie; rows without a movie or title are left out."""
    return (
        movie_stats.where(F.col("movieId").isNotNull() & F.col("title").isNotNull())
        .groupBy("movieId")
        .agg(F.max("title").alias("title"))
    )


def with_display_name(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Adds displayName. Numeric ids take the title from `titles` (see `movie_map`), or `#id`; slugs become words.

    `titles` may be too large to broadcast. Then both sides are shuffled by movie, and AQE splits a movie that holds
    much of `rows`, which a left join allows on that side.
    """
    names = titles.select(F.col("movieId").cast("string").alias("_id"), F.col("title").alias("_title"))
    names = names.where(is_numeric_id(F.col("_id")) & (F.col("_title") != ""))
    movie = F.col("movieId")
    return (
        rows.join(names, movie == F.col("_id"), "left")
        .withColumn(
            "displayName",
            F.when(movie.isNull() | (movie == ""), MISSING_NAME)
            .when(F.col("_title").isNotNull(), F.col("_title"))
            .when(is_numeric_id(movie), F.concat(F.lit("#"), movie))
            .otherwise(words_from_slug(movie)),
        )
        .drop("_id", "_title")
    )


def at_most(rows: DataFrame) -> int | None:
    """How many rows there can be by the plan, such as after a limit; None if the plan sets no bound."""
    bound = rows._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def with_few_display_names(rows: DataFrame, movies: DataFrame) -> DataFrame:
    """J3 for a bounded sample: `with_display_name` with the titles of its movies only, as `movie_map` takes them from `movies`.

    The ids of the sample go to the movies instead of the titles to the sample: movies are filtered where they are read,
    before any shuffle, so that a large list of them does not cross the network for a few names. Rows whose plan does not
    say that they are few are joined the usual way.
    """
    bound = at_most(rows)
    if bound is None or bound > FEW_ROWS:
        return with_display_name(rows, movie_map(movies))
    ids = rows.select(F.col("movieId").cast("string").alias("_wanted")).where(is_numeric_id(F.col("_wanted"))).distinct()
    wanted = movies.join(F.broadcast(ids), F.col("movieId").cast("string") == F.col("_wanted"), "left_semi")
    return with_display_name(rows, F.broadcast(movie_map(wanted)))


def with_stars(rows: DataFrame, rating: str = "rating") -> DataFrame:
    """Adds full_stars, half_star, empty_stars."""
    full, half, empty = star_buckets(F.col(rating))
    return rows.withColumns({"full_stars": full, "half_star": half, "empty_stars": empty})


def with_band(rows: DataFrame, rating: str = "rating") -> DataFrame:
    """P10: adds band."""
    return rows.withColumn("band", rating_band(F.col(rating)))
