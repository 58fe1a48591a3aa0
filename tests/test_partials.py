"""Partial statistics must give, however they are split and merged, what the whole gives."""

import math
import random
import statistics

import pytest
from conftest import rows_of

from ratingloom import schemas
from ratingloom.operators import partials


def ratings(count, seed):
    dice = random.Random(seed)
    return [
        (f"u{i}", "hot" if i % 3 == 0 else f"m{dice.randint(1, 40)}", dice.randint(1, 500) / 100, dice.choice(["s", "t", None]), i)
        for i in range(count)
    ]


def merged_of(spark, rows, pieces):
    parts = None
    for k in range(pieces):
        part = partials.source_parts(spark.createDataFrame(rows[k::pieces], schemas.ARCHIVE))
        parts = part if parts is None else partials.merged_sources(parts.unionByName(part))
    return rows_of(partials.source_stats(parts))


def test_sources_do_not_depend_on_how_they_are_split(spark):
    rows = ratings(900, 1)
    whole = merged_of(spark, rows, 1)
    assert merged_of(spark, rows, 2) == merged_of(spark, rows, 7) == whole
    for source, total, mean, movies in whole:
        some = [row for row in rows if row[3] == source]
        assert total == len(some) and movies == len({row[1] for row in some})
        assert abs(mean - statistics.fmean(row[2] for row in some)) <= 0.005 + 1e-9


def test_an_estimate_is_within_three_standard_errors(spark):
    frame = spark.range(60_000).selectExpr(
        "'u' AS userId", "CAST(id % 20000 AS STRING) AS movieId", "3.0D AS rating", "CAST(id % 3 AS STRING) AS source", "id AS event_ts"
    )
    parts = partials.source_parts(frame).unionByName(partials.source_parts(frame.where("id % 2 = 0")))
    for row in partials.source_stats(partials.merged_sources(parts)).collect():
        assert abs(row.uniqueMovies - 20_000) <= 3 * partials.SKETCH_ERROR * 20_000
    size = partials.merged_sources(parts).selectExpr("max(length(movies))").first()[0]
    assert size <= 2**partials.SKETCH_LOG_SIZE + 100


def test_a_movie_without_a_name_counts(spark):
    frame = spark.createDataFrame([("u", "", 1.0, "s", 1), ("u", "m", 1.0, "s", 1)], schemas.ARCHIVE)
    assert partials.source_stats(partials.source_parts(frame)).first().uniqueMovies == 2


def test_deviations(spark):
    rows = ratings(600, 2)
    frame = spark.createDataFrame(rows, schemas.ARCHIVE).repartition(5)
    for row in partials.movie_stats(partials.movie_moments(frame)).collect():
        some = [r[2] for r in rows if (r[1], r[3]) == (row.movieId, row.source)]
        assert row.totalVotes == len(some)
        assert row.stddev is None if len(some) == 1 else math.isclose(row.stddev, statistics.stdev(some), abs_tol=1e-9)


@pytest.mark.parametrize(
    ("values", "mean", "deviation"),
    [
        ([3.0], 3.0, None),
        ([3.0, 3.0, 3.0], 3.0, 0.0),
        ([float("nan"), 3.0], "nan", "nan"),
        ([float("inf"), 3.0], math.inf, "nan"),
        ([4e6, 2e6], 3e6, 1414213.562373095),
        ([None, None], None, None),
    ],
)
def test_ratings_no_decimal_holds(spark, values, mean, deviation):
    rows = spark.createDataFrame([("u", "m", value, "s", 1) for value in values], schemas.ARCHIVE)
    found = partials.movie_stats(partials.movie_moments(rows)).first()
    for got, wanted in ((found.avgRating, mean), (found.stddev, deviation)):
        assert math.isnan(got) if wanted == "nan" else got == wanted or math.isclose(got, wanted)


def test_a_large_source_is_a_row_per_task(spark):
    frame = spark.createDataFrame(ratings(300, 3), schemas.ARCHIVE)
    plan = partials.source_parts(frame)._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan.lower() or "partial_hllsketchagg" in plan.lower() or plan.count("hll_sketch_agg") >= 2
