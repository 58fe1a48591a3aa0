"""The batch job: ratings and movies in, four CSV outputs and the strict means out (K1-K3).

    python -m ratingloom.plans.batch <ratings> <movies> <output>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from ratingloom import schemas
from ratingloom.fixed_values import MIN_VOTES, TOP_MOVIES
from ratingloom.operators import ranking, stats
from ratingloom.session import build_session, remove_folder, shared_folder
from ratingloom.sinks.csv import write_csv, write_strict_means
from ratingloom.sources.lines import read_movies, read_ratings, read_strict_ratings
from ratingloom.sources.stored import read_csv


def reports(
    ratings: DataFrame, movies: DataFrame, cube_path: str, min_votes: int = MIN_VOTES, k: int = TOP_MOVIES
) -> dict[str, DataFrame]:
    """The four outputs by name.

    The ratings are read and shuffled once, for the cube of votes per movie and rating value. It is written to
    `cube_path`, so the outputs neither repeat that pass nor depend on executors that hold cached blocks.
    """
    stats.rating_cube(ratings).write.mode("overwrite").parquet(cube_path)
    cube = ratings.sparkSession.read.parquet(cube_path)
    totals = stats.cube_totals(cube, "movieId")
    titled = stats.with_titles(stats.mean_and_votes(totals, "movieId"), movies)
    return {
        "movie-stats": ranking.by_rating(titled),
        "top10": ranking.top_movies(titled, k, min_votes),
        "genre-stats": ranking.genres_by_rating(stats.genre_stats(totals, movies)),
        "rating-distribution": ranking.by_rating_value(stats.cube_distribution(cube)),
    }


def write_reports(outputs: dict[str, DataFrame], path: str) -> None:
    """K1."""
    for name, rows in outputs.items():
        write_csv(rows, f"{path}/{name}")


def run(spark: SparkSession, ratings_path: str, movies_path: str, output_path: str) -> None:
    cube_path = shared_folder(spark, "cube")
    try:
        outputs = reports(read_ratings(spark, ratings_path), read_movies(spark, movies_path), cube_path)
        write_reports(outputs, output_path)
    finally:
        remove_folder(spark, cube_path)
    show(spark, output_path)


# K3: how many rows of the small outputs are shown.
SHOWN = {"top10": 10, "genre-stats": 20, "rating-distribution": 20}


def show(spark: SparkSession, output_path: str) -> None:
    """K3: the first rows of the small outputs, untruncated, in order, as they were written."""
    kinds = {"top10": schemas.MOVIE_STATS, "genre-stats": schemas.GENRE_STATS, "rating-distribution": schemas.RATING_DISTRIBUTION}
    orders = {
        "top10": ranking.by_rating,
        "genre-stats": ranking.genres_by_rating,
        "rating-distribution": ranking.by_rating_value,
    }
    for name, rows in SHOWN.items():
        orders[name](read_csv(spark, f"{output_path}/{name}", kinds[name])).show(rows, truncate=False)


def run_strict(
    spark: SparkSession, ratings_path: str, output_path: str, partitions: int | None = None
) -> None:
    """A1, K2: the tab-separated means, in the `STRICT_OUTPUT_PARTITIONS` files of old if asked for."""
    means = stats.strict_means(read_strict_ratings(spark, ratings_path))
    write_strict_means(stats.strict_mean_lines(means, partitions), output_path)


def main() -> None:
    if len(sys.argv) != 4:
        sys.exit("usage: python -m ratingloom.plans.batch <ratings> <movies> <output>")
    ratings_path, movies_path, output_path = sys.argv[1:]
    spark = build_session("rating reports")
    run(spark, ratings_path, movies_path, output_path)
    run_strict(spark, ratings_path, f"{output_path}/strict-means")
    spark.stop()


if __name__ == "__main__":
    main()
