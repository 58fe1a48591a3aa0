"""Views over the stored outputs, as a dashboard needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingloom import schemas
from ratingloom.operators import display, ranking, stats
from ratingloom.sources.stored import availability, read_csv, read_strict_means
from ratingloom.sinks.archive import read_archive
from ratingloom.sinks.cells import read_cells
from ratingloom.operators.cells import movie_stats_rows
from ratingloom.streaming.queries import read_recent, read_source_stats


def status(spark: SparkSession, output_path: str, counted: bool = False) -> DataFrame:
    """Which outputs there are; the archive is only listed unless its rows are to be counted."""
    return availability(
        spark,
        {
            "mapreduce": (f"{output_path}/strict-means", "text"),
            "spark_batch": (f"{output_path}/top10", "csv"),
            "streaming": (f"{output_path}/raw-stream", "csv"),
        },
        counted,
    )


def batch_views(spark: SparkSession, output_path: str) -> dict[str, DataFrame]:
    movie_stats = read_csv(spark, f"{output_path}/movie-stats", schemas.MOVIE_STATS)
    genres = read_csv(spark, f"{output_path}/genre-stats", schemas.GENRE_STATS)
    distribution = read_csv(spark, f"{output_path}/rating-distribution", schemas.RATING_DISTRIBUTION)
    return {
        "strict_top": ranking.top_strict_means(read_strict_means(spark, f"{output_path}/strict-means")),
        "movie_map": display.movie_map(movie_stats),
        "movie_count": stats.row_count(movie_stats),
        "top10": display.with_stars(read_csv(spark, f"{output_path}/top10", schemas.MOVIE_STATS), "avgRating"),
        "genre_stats": ranking.genres_by_rating(genres),
        "genre_count": stats.row_count(genres),
        "rating_distribution": ranking.by_rating_value(distribution),
        "total_ratings": stats.total_ratings(distribution),
    }


def live_views(spark: SparkSession, output_path: str, movies: DataFrame, seed: int = 0) -> dict[str, DataFrame]:
    """The sample of recent ratings, its means per movie, and the feed with names, stars and bands.

    The recent ratings are those the live job keeps, so a refresh does not read the archive again. The sample is bounded,
    so the titles in `movies` (movieId, title) are looked up for its movies only.
    """
    sample = ranking.shuffled_sample(read_recent(spark, f"{output_path}/recent"), seed=seed)
    named = display.with_few_display_names(ranking.recent_feed(sample), movies)
    feed = display.with_band(display.with_stars(named))
    return {
        "sample": sample,
        "sample_means": display.with_few_display_names(ranking.sample_means(sample), movies).orderBy("movieId"),
        "feed": feed.orderBy("event_ts", ascending=False),
    }


def live_tables(spark: SparkSession, output_path: str, now_ms: int | None = None) -> dict[str, DataFrame]:
    """What the live job keeps, as rows: statistics per movie and source from the cells, per source, recent and archived ratings."""
    return {
        "movie_stats": movie_stats_rows(read_cells(spark, f"{output_path}/cells", now_ms), now_ms, with_stddev=True),
        "source_stats": read_source_stats(spark, f"{output_path}/sources"),
        "recent": read_recent(spark, f"{output_path}/recent"),
        "archive": read_archive(spark, f"{output_path}/raw-stream"),
    }
