"""Statistics against brute force, and their edge cases."""

import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ratingloom.functions.numbers import rating_band, star_buckets
from ratingloom.operators import display, stats

RATINGS = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"


def rounded(total, count):
    return None if not count else float(Decimal(repr(total / count)).quantize(Decimal("0.01"), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the ratings belong to movie 1, a third have no movie or no rating at times."""
    dice = random.Random(7)
    rows = []
    for i in range(6000):
        movie = 1 if i % 3 == 0 else dice.choice([None, *range(2, 60)])
        rating = None if dice.random() < 0.1 or movie == 59 else dice.randint(1, 10) / 2
        rows.append((i, movie, rating, i))
    return rows, spark.createDataFrame(rows, RATINGS).repartition(7)


def test_movie_stats(skewed):
    rows, frame = skewed
    groups = defaultdict(list)
    for _, movie, rating, _ in rows:
        groups[movie].extend([] if rating is None else [rating])
        groups[movie]
    expected = sorted(((m, rounded(sum(r), len(r)), len(r)) for m, r in groups.items()), key=repr)
    assert (59, None, 0) in expected
    assert rows_of(stats.movie_stats(frame)) == expected
    assert rows_of(stats.movie_stats(frame, exact_scale=2)) == expected
    cube = stats.rating_cube(frame)
    assert rows_of(stats.mean_and_votes(stats.cube_totals(cube, "movieId"), "movieId")) == expected


def test_distribution(skewed):
    rows, frame = skewed
    counts = defaultdict(int)
    for _, _, rating, _ in rows:
        counts[rating] += rating is not None
    assert dict(rows_of(stats.rating_distribution(frame))) == counts and counts[None] == 0
    assert dict(rows_of(stats.cube_distribution(stats.rating_cube(frame)))) == counts
    assert stats.total_ratings(stats.rating_distribution(frame)).first().total == sum(counts.values())
    votes = stats.movie_stats(frame).agg(F.sum("totalVotes")).first()[0]
    assert votes == sum(counts.values())


def test_genres(spark, skewed):
    rows, frame = skewed
    movies = [(1, "A", "X|Y"), (2, "B", "Y"), (3, "C", ""), (4, "D", None), (5, "E", "X|X"), (59, "F", "Z"), (99, "G", "X")]
    groups = defaultdict(list)
    for _, movie, rating, _ in rows:
        for movie_id, _, genres in movies:
            if movie is not None and movie == movie_id and genres is not None:
                for genre in genres.split("|"):
                    groups[genre].append(rating)
    expected = []
    for genre, all_ratings in groups.items():
        valid = [r for r in all_ratings if r is not None]
        expected.append((genre, rounded(sum(valid), len(valid)), len(valid)))
    titles = spark.createDataFrame(movies, "movieId INT, title STRING, genres STRING")
    totals = stats.rating_totals(frame, "movieId")
    assert rows_of(stats.genre_stats(totals, titles)) == sorted(expected, key=repr)
    assert ("Z", None, 0) in expected and any(genre == "" for genre, _, _ in expected)


def test_titles_drop_unrated_and_unknown_movies(spark):
    rated = spark.createDataFrame([(1, 10, 4.0, 0), (1, 11, 3.0, 0), (2, None, 3.0, 0)], RATINGS)
    movies = spark.createDataFrame([(10, "A", ""), (12, "B", ""), (None, "C", "")], "movieId INT, title STRING, genres STRING")
    assert rows_of(stats.with_titles(stats.movie_stats(rated), movies)) == [(10, "A", 4.0, 1)]


def test_null_groups(spark):
    rated = spark.createDataFrame([(0, 1, None, 0), (0, 1, None, 0), (0, 2, 4.0, 0), (0, None, 3.0, 0)], RATINGS)
    assert rows_of(stats.movie_stats(rated)) == sorted([(1, None, 0), (2, 4.0, 1), (None, 3.0, 1)], key=repr)
    assert rows_of(stats.rating_distribution(rated)) == sorted([(None, 0), (3.0, 1), (4.0, 1)], key=repr)


def test_strict_means(spark):
    pairs = [("1", "4"), ("1", "3.5"), ("1", "x"), ("2", "x"), ("", "5"), ("3", "NaN"), ("4", "1"), ("4", "1.01")]
    means = stats.strict_means(spark.createDataFrame(pairs, "movieId STRING, rating STRING"))
    assert rows_of(means) == [("", "5.00", 1), ("1", "3.75", 2), ("3", "NaN", 1), ("4", "1.01", 2)]
    texts = {row.value for row in stats.strict_mean_lines(means).collect()}
    assert texts == {"\t5.00\t1", "1\t3.75\t2", "3\tNaN\t1", "4\t1.01\t2"}


def test_strict_lines_are_in_key_order_in_each_partition(spark):
    pairs = [(str(i), "4") for i in range(500)]
    means = stats.strict_means(spark.createDataFrame(pairs, "movieId STRING, rating STRING"))
    out = stats.strict_mean_lines(means, partitions=2).withColumn("part", F.spark_partition_id()).collect()
    parts = defaultdict(list)
    for line in out:
        parts[line.part].append(line.value.split("\t")[0])
    assert len(parts) == 2 and sum(map(len, parts.values())) == 500
    assert all(keys == sorted(keys) for keys in parts.values())


def unified(spark, rows):
    return spark.createDataFrame(rows, "userId STRING, movieId STRING, rating DOUBLE, source STRING, event_ts BIGINT")


def test_source_stats(spark):
    rows = [("u", f"m{i % 40}", 0.5 * (i % 10 + 1), "a" if i % 3 else "b", i) for i in range(900)]
    exact = stats.source_stats_exact(unified(spark, rows)).collect()
    rough = {row.source: row for row in stats.source_stats(unified(spark, rows)).collect()}
    for row in exact:
        mine = [r for r in rows if r[3] == row.source]
        assert row.totalRatings == len(mine) and row.uniqueMovies == len({r[1] for r in mine}) == 40
        assert row.avgRating == rounded(sum(r[2] for r in mine), len(mine)) == rough[row.source].avgRating
        assert abs(rough[row.source].uniqueMovies - 40) <= 4


def test_stddev_and_alerts(spark):
    rated = spark.createDataFrame(
        [(0, 1, 1.0, 0), (0, 1, 5.0, 0), (0, 1, 3.0, 0), (0, 2, 3.0, 0), (0, 3, 0.5, 0), (0, 4, None, 0)], RATINGS
    )
    spread = {row.movieId: row for row in stats.stats_with_stddev(rated, "movieId").collect()}
    assert spread[1].stddev == 2.0 and spread[2].stddev is None and spread[4].totalVotes == 0
    alerts = stats.rating_alerts(rated, min_share=0.5)
    assert rows_of(alerts) == [(1, "extreme_ratings", 3, 2, 3.0), (3, "extreme_ratings", 1, 1, 0.5)]
    assert rows_of(stats.rating_alerts(rated, min_share=0.5, min_total=2)) == [(1, "extreme_ratings", 3, 2, 3.0)]


def test_rounding_is_half_up_on_decimals(spark):
    rated = spark.createDataFrame([(0, 1, 1.0, 0), (0, 1, 1.01, 0), (0, 2, 2.0, 0), (0, 2, 2.25, 0)], RATINGS)
    assert rows_of(stats.movie_stats(rated, exact_scale=2)) == [(1, 1.01, 2), (2, 2.13, 2)]


@pytest.mark.parametrize("rating", [None, math.nan, -1.0, -0.3, 0.0, 0.4, 0.5, 1.0, 2.49, 2.5, 4.5, 4.99, 5.0, 5.7, 9.0])
def test_stars(spark, rating):
    usable = rating is not None and not math.isnan(rating)
    marks = ["full" if usable and rating >= i else "half" if usable and rating >= i - 0.5 else "empty" for i in range(1, 6)]
    frame = spark.createDataFrame([(rating,)], "rating DOUBLE")
    assert tuple(frame.select(*star_buckets(F.col("rating"))).first()) == tuple(
        marks.count(kind) for kind in ("full", "half", "empty")
    )


def test_bands(spark):
    rows = [(None,), (math.nan,), (2.9,), (3.0,), (3.99,), (4.0,), (5.0,)]
    frame = spark.createDataFrame(rows, "rating DOUBLE")
    assert [row[0] for row in frame.select(rating_band(F.col("rating"))).collect()] == [
        "low", "low", "low", "mid", "mid", "high", "high",
    ]


def test_display_names(spark):
    titles = spark.createDataFrame([(1, "One"), (2, ""), (3, "A"), (3, "B"), (4, None), (None, "x")], "movieId INT, title STRING")
    mapped = display.movie_map(titles)
    assert rows_of(mapped) == [(1, "One"), (2, ""), (3, "B")]
    rows = spark.createDataFrame([(x,) for x in ["1", "2", "3", "9", None, "", "the-end", "1.0"]], "movieId STRING")
    names = {row.movieId: row.displayName for row in display.with_display_name(rows, mapped).collect()}
    assert names == {
        "1": "One", "2": "#2", "3": "B", "9": "#9", None: "—", "": "—", "the-end": "The End", "1.0": "#1.0",
    }


def test_ratings_no_decimal_holds_count_as_without_exact_scale(spark):
    nan, large, endless = float("nan"), 1e17, float("inf")
    rows = [(1, 4.0), (1, nan), (2, large), (2, 1.5), (3, endless), (3, 1.0), (4, None), (5, nan), (6, 0.5), (6, None)]
    frame = spark.createDataFrame(rows, "movieId int, rating double")
    by_movie = {row.movieId: row for row in stats.movie_stats(frame, exact_scale=2).collect()}
    plain = {row.movieId: row for row in stats.movie_stats(frame).collect()}
    assert str(by_movie) == str(plain)
    assert str(by_movie[1].avgRating) == "nan" and by_movie[1].totalVotes == 2
