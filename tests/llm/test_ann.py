import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import ann


def brute(vectors, k=5):
    """The nearest of every vector whose id is divisible by 50."""
    ids = np.array(sorted(vectors))
    table = np.array([vectors[i] for i in ids], float)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    out = {}
    for at in np.flatnonzero(ids % 50 == 0):
        score = table @ table[at]
        order = [o for o in np.lexsort((ids, -np.round(score, 12))) if o != at][:k]
        out[ids[at]] = [(ids[o], score[o]) for o in order]
    return out


def found_in(table, **settings):
    out = {}
    for row in ann.nearest(table, F.col("vec_id") % 50 == 0, **settings).orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def recall(found, truth):
    hits = sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in near}) for q, near in truth.items())
    return hits / sum(map(len, truth.values()))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_recall_on_the_table(spark, size):
    table = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")
    vectors = {row.vec_id: row.vector for row in ann.usable(table, 64).collect()}
    truth, found = brute(vectors), found_in(table)
    assert set(found) == set(truth)
    assert recall(found, truth) >= 0.9
    scores = {(q, v): s for q, near in truth.items() for v, s in near}
    assert all(abs(s - scores[q, v]) < 1e-9 for q, near in found.items() for v, s in near if (q, v) in scores)


def test_odd_rows(spark):
    choose = np.random.default_rng(0)
    rows = [(i, choose.normal(size=64).tolist(), 1, "x") for i in range(1, 120)]
    rows += [(0, [1.0] * 64, 1, "x"), (200, [2.0] * 64, 1, "x"), (201, [3.0] * 64, 1, "x"), (None, [1.0] * 64, 1, "x")]
    rows += [(250, None, 1, "x"), (300, [0.0] * 64, 1, "x"), (350, [float("nan")] * 64, 1, "x")]
    rows += [(400, [None] * 64, 1, "x"), (450, [float("inf")] * 64, 1, "x"), (500, [1.0], 1, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score string")
    found = found_in(table, lists=4, probes=4, part=20)
    assert set(found) == {0, 50, 100, 200}
    assert [v for v, _ in found[0]][:2] == [200, 201] and [v for v, _ in found[200]][:2] == [0, 201]
    kept = {row[0]: row[1] for row in rows if row[0] is not None and (row[0] < 120 or row[0] in (200, 201))}
    assert recall(found, brute(kept)) >= 0.9


def test_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    assert found_in(spark.createDataFrame([], schema)) == {}
    two = spark.createDataFrame([(0, [1.0] * 64), (3, [-1.0] * 64)], schema)
    assert [v for v, _ in found_in(two)[0]] == [3]


def test_repeated_ids_of_a_query(spark):
    choose = np.random.default_rng(4)
    centre = choose.normal(size=64)
    rows = [(i, (centre + choose.normal(size=64)).tolist()) for i in range(1, 200) if i % 50]
    rows += [(0, (centre + 0.01 * choose.normal(size=64)).tolist())] * 12
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = found_in(table, lists=1, probes=1)
    assert [v for v, _ in found[0]] == [v for v, _ in brute(dict(rows))[0]]
    two = spark.createDataFrame([*rows, (0, (-centre).tolist())], "vec_id long, embedding array<double>")
    assert ann.nearest(two, F.col("vec_id") % 50 == 0, lists=1, probes=1).count() == 10


def test_recall_of_the_scan_in_long_lists(spark):
    choose = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(choose.normal(size=(3000, 64)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = found_in(table, lists=8, probes=8, block=7)
    assert recall(found, brute(dict(rows))) >= 0.95
