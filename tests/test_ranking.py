"""Orders, top lists, tails per movie and samples."""

import random
from collections import defaultdict

import pytest
from conftest import rows_of

from ratingloom.operators import ranking
from ratingloom.schemas import ARCHIVE

STATS = "movieId INT, title STRING, avgRating DOUBLE, totalVotes BIGINT"


@pytest.fixture(scope="module")
def archive():
    dice = random.Random(3)
    rows = [
        (
            f"u{dice.randint(1, 50)}",
            "hot" if i % 3 == 0 else dice.choice([None, "", *[f"m{k}" for k in range(40)]]),
            dice.choice([None, *[k / 2 for k in range(1, 11)]]),
            dice.choice(["a", "b"]),
            dice.choice([None, *range(400)]),
        )
        for i in range(3000)
    ]
    return rows + [("u1", "copies", 3.0, "a", 5)] * 1500


def order(row):
    user, _, rating, source, ts = row
    return (ts is None, -(ts or 0), user, (rating is not None, rating or 0), source)


def tails(rows, n):
    groups = defaultdict(list)
    for row in rows:
        movie = "unknown" if row[1] is None else row[1]
        groups[movie].append((row[0], movie, *row[2:]))
    return sorted((row for group in groups.values() for row in sorted(group, key=order)[:n]), key=repr)


@pytest.mark.parametrize("n", [1, 15, 40])
def test_recent_per_movie(spark, archive, n):
    frame = spark.createDataFrame(archive, ARCHIVE).repartition(5)
    assert rows_of(ranking.recent_per_movie(frame, n)) == tails(archive, n)


def test_recent_per_movie_beyond_the_rank_limit(spark, archive):
    frame = spark.createDataFrame(archive, ARCHIVE).repartition(5)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert rows_of(ranking.recent_per_movie(frame, 30)) == tails(archive, 30)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_sample_does_not_depend_on_partitions(spark, archive):
    frame = spark.createDataFrame(archive, ARCHIVE)
    first = rows_of(ranking.shuffled_sample(frame.repartition(2), 120, seed=1))
    assert len(first) == 120
    assert rows_of(ranking.shuffled_sample(frame.repartition(9), 120, seed=1)) == first
    assert rows_of(ranking.shuffled_sample(frame, 120, seed=2)) != first


def test_feed_and_means(spark):
    rows = [("u", "m1", 4.0, "a", 1), ("v", "m1", float("nan"), "a", 3), ("w", "", 2.0, "a", 2), ("x", None, 3.0, "a", 0)]
    frame = spark.createDataFrame(rows, ARCHIVE)
    assert [row.userId for row in ranking.recent_feed(frame, 2).collect()] == ["v", "w"]
    assert [tuple(row) for row in ranking.sample_means(frame).collect()] == [("m1", 4.0), ("unknown", 2.5)]


def test_top_movies(spark):
    rows = [(1, "a", 4.5, 100), (2, "b", 4.5, 120), (3, "c", 5.0, 99), (4, "d", 4.5, 120), (5, "e", None, 200)]
    frame = spark.createDataFrame(rows, STATS)
    assert [row.movieId for row in ranking.top_movies(frame, 3).collect()] == [2, 4, 1]
    assert [row.movieId for row in ranking.top_movies(frame).collect()] == [2, 4, 1, 5]
    assert [row.movieId for row in ranking.by_rating(frame).collect()] == [3, 2, 4, 1, 5]


def test_other_orders(spark):
    genres = spark.createDataFrame([("b", 3.0, 1), ("a", 3.0, 1), ("c", 4.0, 1)], "genre STRING, avgRating DOUBLE, totalRatings BIGINT")
    assert [row.genre for row in ranking.genres_by_rating(genres).collect()] == ["c", "a", "b"]
    values = spark.createDataFrame([(4.0, 1), (None, 0), (0.5, 2)], "rating DOUBLE, count BIGINT")
    assert [row.rating for row in ranking.by_rating_value(values).collect()] == [None, 0.5, 4.0]
    means = spark.createDataFrame([(str(i), 3.0 if i else 4.0, 1) for i in range(30)], "movieId STRING, avgRating DOUBLE, count BIGINT")
    top = [row.movieId for row in ranking.top_strict_means(means).collect()]
    assert top[0] == "0" and len(top) == 20 and top[1:] == sorted(str(i) for i in range(1, 30))[:19]
