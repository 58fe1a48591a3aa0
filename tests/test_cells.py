"""Keyed cells."""

import random
import shutil
from collections import defaultdict

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ratingloom.operators import cells
from ratingloom.sinks.cells import compact_cells, maintain_cells, read_cells, write_cells

DAY = 86_400_000
CELLS = "row_key STRING, family STRING, qualifier STRING, value STRING, version_ts BIGINT"


def without_put(frame):
    """Cells as they are compared here; the identity of the put has tests of its own."""
    return rows_of(frame.drop("put_id"))


def test_live_cells(spark):
    rows = [("m1", "a", 4.25, 4), ("null", "a", 1.0, 1), (None, "a", 1.0, 1), ("m2", None, None, 0)]
    frame = spark.createDataFrame(rows, "movieId STRING, source STRING, avgRating DOUBLE, totalVotes BIGINT")
    assert without_put(cells.live_stats_cells(frame, 7)) == sorted(
        [
            ("m1_a", "ratings", "avgRating", "4.25", 7),
            ("m1_a", "ratings", "totalVotes", "4", 7),
            ("m1_a", "info", "source", "a", 7),
            ("m1_a", "info", "lastUpdated", "7", 7),
            ("m2_null", "ratings", "totalVotes", "0", 7),
            ("m2_null", "info", "lastUpdated", "7", 7),
        ],
        key=repr,
    )


def test_batch_cells_take_title_and_deviation_where_there(spark):
    frame = spark.createDataFrame([(1, "T", 4.0, 2, None)], "movieId INT, title STRING, avgRating DOUBLE, totalVotes BIGINT, stddev DOUBLE")
    names = {(row.family, row.qualifier) for row in cells.batch_stats_cells(frame, 7).collect()}
    assert names == {("ratings", "avgRating"), ("ratings", "totalVotes"), ("info", "source"), ("info", "lastUpdated"), ("info", "title")}
    with_value = cells.batch_stats_cells(frame.withColumn("stddev", F.lit(0.5)).drop("title"), 7)
    assert ("1_batch", "ratings", "stddev", "0.5", 7) in without_put(with_value)


def test_event_and_alert_keys(spark):
    events = spark.createDataFrame([("u", "m", 4.5, "s", 12)], "userId STRING, movieId STRING, rating DOUBLE, source STRING, timestamp BIGINT")
    assert {row.row_key for row in cells.rating_event_cells(events, 7).collect()} == {"m_0000000000012"}
    alerts = spark.createDataFrame([(3, "t", 2, 1, 4.0)], "movieId INT, alertType STRING, total BIGINT, extremeCount BIGINT, avgRating DOUBLE")
    assert {row.row_key for row in cells.alert_cells(alerts, 7).collect()} == {"3_7"}
    genres = spark.createDataFrame([("Drama", 4.0, 2)], "genre STRING, avgRating DOUBLE, totalRatings BIGINT")
    assert {row.row_key for row in cells.genre_stats_cells(genres, 7).collect()} == {"Drama"}


def test_the_clock_is_used_unless_a_time_is_given(spark):
    genres = spark.createDataFrame([("Drama", 4.0, 2)], "genre STRING, avgRating DOUBLE, totalRatings BIGINT")
    assert all(row.version_ts > 1_700_000_000_000 for row in cells.genre_stats_cells(genres).collect())


def test_undeclared_families_are_refused(spark):
    frame = spark.createDataFrame([("g",)], "genre STRING")
    with pytest.raises(ValueError, match="meta"):
        cells.to_cells(frame, "genre_stats", F.col("genre"), {("meta", "x"): F.col("genre")}, F.lit(1))


@pytest.fixture(scope="module")
def versions():
    """One cell has a third of all rows, many of them copies of one version."""
    dice = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{dice.randint(1, 60)}"
        version = 20 * DAY if key == "hot" and i % 2 else dice.randint(1, 30) * DAY
        rows.append((key, "ratings", dice.choice(["a", "b"]), str(dice.randint(1, 9)), version))
    return rows


def kept(rows, now, versions, ttl):
    groups = defaultdict(dict)
    for *cell, value, version in rows:
        if version > now - ttl:
            old = groups[tuple(cell)].get(version)
            groups[tuple(cell)][version] = value if old is None else max(old, value)
    return sorted(
        ((*cell, value, version) for cell, all_versions in groups.items()
         for version, value in sorted(all_versions.items(), reverse=True)[:versions]),
        key=repr,
    )


def test_retention(spark, versions):
    frame = spark.createDataFrame(versions, CELLS).repartition(6)
    now = 28 * DAY
    once = cells.retained_cells(frame, now)
    assert rows_of(once) == kept(versions, now, 5, 7 * DAY)
    assert rows_of(cells.retained_cells(once, now)) == rows_of(once)
    assert rows_of(cells.retained_cells(frame, now, 2, 30 * DAY)) == kept(versions, now, 2, 30 * DAY)


def test_latest(spark, versions):
    frame = spark.createDataFrame(versions, CELLS).repartition(6)
    assert rows_of(cells.latest_cells(frame)) == kept(versions, 10**12, 1, 10**12)


def test_a_repeated_batch_changes_nothing_and_a_later_one_wins(spark, tmp_path):
    path = str(tmp_path / "cells")

    def stats(mean, votes):
        return spark.createDataFrame([("m", "s", mean, votes)], "movieId STRING, source STRING, avgRating DOUBLE, totalVotes BIGINT")

    write_cells(cells.live_stats_cells(stats(3.0, 1), 5), path, 0)
    write_cells(cells.live_stats_cells(stats(4.0, 2), 5), path, 1)  # in the same millisecond
    before = rows_of(read_cells(spark, path))
    write_cells(cells.live_stats_cells(stats(3.0, 1), 5), path, 0)
    assert rows_of(read_cells(spark, path)) == before
    assert rows_of(cells.movie_stats_rows(read_cells(spark, path))) == [("m_s", "s", 4.0, 2)]
    assert rows_of(cells.lookup_stats(read_cells(spark, path), "m_s")) == [("m_s", "s", 4.0, 2)]
    assert rows_of(cells.lookup_stats(read_cells(spark, path), "nobody")) == []
    compact_cells(spark, path, str(tmp_path / "compact"), now_ms=6)
    compacted = read_cells(spark, str(tmp_path / "compact"))
    assert rows_of(cells.movie_stats_rows(compacted)) == [("m_s", "s", 4.0, 2)] and compacted.count() == 4


def test_readers_hide_expired_cells(spark):
    schema = "movieId STRING, source STRING, avgRating DOUBLE, totalVotes BIGINT"
    old = cells.live_stats_cells(spark.createDataFrame([("m", "s", 4.0, 2)], schema), DAY)
    stored = old.union(cells.live_stats_cells(spark.createDataFrame([("n", "s", 3.0, 1)], schema), 3 * DAY))
    both = [("m_s", "s", 4.0, 2), ("n_s", "s", 3.0, 1)]
    assert rows_of(cells.movie_stats_rows(stored, 8 * DAY - 1)) == both
    assert rows_of(cells.movie_stats_rows(stored, 8 * DAY)) == both[1:]
    assert rows_of(cells.lookup_stats(stored, "m_s", 8 * DAY)) == []
    assert rows_of(cells.lookup_stats(stored, "n_s", 8 * DAY)) == both[1:]


def test_batch_cells_of_the_source_of_each_row(spark):
    rows = [("m", "a", 4.0, 2, 0.5), ("m", None, 3.0, 1, 0.25)]
    frame = spark.createDataFrame(rows, "movieId STRING, source STRING, avgRating DOUBLE, totalVotes BIGINT, stddev DOUBLE")
    found = without_put(cells.batch_stats_cells(frame, 7, F.col("source")))
    assert {("m_a", "ratings", "stddev", "0.5", 7), ("m_null", "ratings", "stddev", "0.25", 7)} <= set(found)
    assert [r for r in found if r[2] == "source"] == [("m_a", "info", "source", "a", 7)]


EVENTS = "userId STRING, movieId STRING, rating DOUBLE, source STRING, timestamp BIGINT"


def test_a_put_is_read_back_whole(spark, tmp_path):
    """Events of one movie and time never mix, also where they lack values."""
    dice = random.Random(3)
    events = [
        (f"u{dice.randint(1, 9)}", f"m{dice.randint(1, 5)}", dice.choice([None, 1.0, 4.5]), dice.choice([None, "a", "b"]), dice.randint(1, 3))
        for _ in range(400)
    ]
    path = str(tmp_path / "e")
    for batch, part in enumerate((events[:150], events[150:], events[:20])):
        write_cells(cells.rating_event_cells(spark.createDataFrame(part, EVENTS), 5).repartition(7), path, batch)
    found = cells.rating_event_rows(read_cells(spark, path)).collect()
    assert len(found) == 15
    for row in found:
        assert tuple(row)[1:] in set(events) and row.row_key == f"{row.movieId}_{row.timestamp:013d}"
    # Cell by cell, a value that the winner lacks comes from another put.
    assert rows_of(cells.rating_event_rows(read_cells(spark, path))) == rows_of(cells.rating_event_rows(read_cells(spark, path).repartition(3)))


def test_the_identity_of_a_put(spark):
    rows = [("u", "m", 4.5, "s", 12), ("u", "m", 4.5, "s", 12), ("u", "m", 4.5, None, 12), ("u", "m", None, "s", 12), ("v", "m", 4.5, "s", 12)]
    ids = [
        {row.put_id for row in cells.rating_event_cells(spark.createDataFrame([row], EVENTS), 7).collect()} for row in rows
    ]
    assert all(len(found) == 1 for found in ids)
    assert ids[0] == ids[1] and len(set().union(*ids)) == 4
    assert {row.put_id for row in cells.rating_event_cells(spark.createDataFrame(rows[:1], EVENTS), 8).collect()} != ids[0]


def test_days_are_merged_and_expire(spark, tmp_path, versions):
    path = str(tmp_path / "c")
    frame = spark.createDataFrame(versions, CELLS)
    now = 28 * DAY
    for batch in range(4):
        write_cells(frame.where(F.pmod(F.hash("row_key", "version_ts"), F.lit(4)) == batch), path, batch, split=2)
        maintain_cells(spark, path, batch - 1, now)
        if batch == 1:
            maintain_cells(spark, path, batch - 1, now)  # again
    expected = kept(versions, now, 5, 7 * DAY)
    stored = read_cells(spark, path, now)
    assert rows_of(cells.retained_cells(stored, now).drop("put_id")) == expected
    maintain_cells(spark, path, 3, now)
    stored = read_cells(spark, path)
    assert not list((tmp_path / "c/level=new").iterdir())
    assert {int(folder.name[4:]) for folder in (tmp_path / "c").rglob("day=*")} == set(range(22, 31))
    assert rows_of(cells.retained_cells(stored, now).drop("put_id")) == expected
    # A day that nobody writes to any more goes as a whole.
    maintain_cells(spark, path, 3, now + 3 * DAY)
    assert min(int(folder.name[4:]) for folder in (tmp_path / "c").rglob("day=*")) == 24


def test_a_merge_that_was_cut_off_changes_nothing(spark, tmp_path, versions):
    """What was merged may still be there: it counts once."""
    path, copy = str(tmp_path / "c"), str(tmp_path / "before")
    frame = spark.createDataFrame(versions, CELLS)
    now = 28 * DAY
    write_cells(frame.where("hash(row_key) % 2 = 0"), path, 0)
    write_cells(frame.where("hash(row_key) % 2 <> 0"), path, 1)
    shutil.copytree(tmp_path / "c/level=new", copy)
    maintain_cells(spark, path, 1, now)
    expected = rows_of(cells.retained_cells(read_cells(spark, path), now).drop("put_id"))
    shutil.copytree(copy, tmp_path / "c/level=new", dirs_exist_ok=True)
    assert expected == kept(versions, now, 5, 7 * DAY)
    assert rows_of(cells.retained_cells(read_cells(spark, path), now).drop("put_id")) == expected
    maintain_cells(spark, path, 1, now)
    assert rows_of(cells.retained_cells(read_cells(spark, path), now).drop("put_id")) == expected
    assert not list((tmp_path / "c/level=new").iterdir())


def test_tables_without_cells(spark, tmp_path):
    empty = spark.createDataFrame([], EVENTS)
    write_cells(cells.rating_event_cells(empty, 5), str(tmp_path / "e"), 0)
    maintain_cells(spark, str(tmp_path / "e"), 0, 5)
    maintain_cells(spark, str(tmp_path / "none"), 0, 5)


def one_bucket(spark, rows):
    return spark.range(0, rows, 1, 8).selectExpr(
        "CAST(id % 997 AS STRING) AS row_key", "'ratings' AS family", "'rating' AS qualifier", "CAST(id % 7 AS STRING) AS value", f"{20 * DAY} + id AS version_ts"
    )


def rows_a_file(spark, path):
    return [row["count"] for row in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]


def test_no_task_sorts_a_whole_bucket(spark, tmp_path, monkeypatch):
    """The tasks of a write are bounded in bytes, also for one day and one bucket."""
    from ratingloom.sinks import cells as sink

    monkeypatch.setattr(sink, "SORTED_BYTES", 50_000, raising=False)
    key, path = "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(tmp_path / "c")
    before = spark.conf.get(key)
    write_cells(one_bucket(spark, 80_000), path, 0, split=1, buckets=1)
    assert spark.conf.get(key) == before
    assert len(found := rows_a_file(spark, path)) >= 4 and max(found) <= 20_000
    assert rows_of(read_cells(spark, path).groupBy("row_key").count()) == rows_of(one_bucket(spark, 80_000).groupBy("row_key").count())
    compact_cells(spark, path, str(tmp_path / "compact"), 20 * DAY, buckets=1)
    kept_now = cells.retained_cells(one_bucket(spark, 80_000), 20 * DAY)
    assert rows_of(read_cells(spark, str(tmp_path / "compact")).select(*kept_now.columns)) == rows_of(kept_now)


def test_merging_a_day_is_no_task_of_its_own(spark, tmp_path, monkeypatch):
    """A day with one bucket is merged by several tasks, and nothing is lost."""
    from ratingloom.sinks import cells as sink

    monkeypatch.setattr(sink, "SORTED_BYTES", 50_000, raising=False)
    path, now, frame = str(tmp_path / "c"), 21 * DAY, one_bucket(spark, 80_000).withColumn("row_key", F.expr("CAST(version_ts % 40009 AS STRING)"))
    for batch in range(2):
        write_cells(frame.where(f"version_ts % 2 = {batch}"), path, batch, split=1, buckets=1)
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(smallest, "1k")  # else tables of this size are one task from the first aggregate on
    try:
        maintain_cells(spark, path, 1, now, buckets=1)
    finally:
        spark.conf.unset(smallest)
    assert not list((tmp_path / "c/level=new").iterdir())
    assert len(found := rows_a_file(spark, path)) >= 3 and max(found) <= 40_000 and sum(found) == 80_000
    assert rows_of(cells.latest_cells(read_cells(spark, path, now))) == rows_of(cells.latest_cells(frame))


def test_the_cells_of_a_put_lie_together(spark, tmp_path):
    """However a bucket is dealt out, a put is in one file, and puts of one key are in several."""
    path = str(tmp_path / "e")
    rows = spark.range(400).selectExpr("CAST(id AS STRING) AS userId", "'m' AS movieId", "id / 2.0D AS rating", "'s' AS source", "7L AS timestamp")
    with_tasks = "spark.sql.adaptive.enabled"
    spark.conf.set(with_tasks, "false")
    try:
        write_cells(cells.rating_event_cells(rows, 5), path, 0)
    finally:
        spark.conf.unset(with_tasks)
    files = defaultdict(list)
    for row in spark.read.parquet(path).select("put_id", F.input_file_name().alias("file")).collect():
        files[row.put_id].append(row.file)
    assert len(files) == 400 and all(len(found) == 5 and len(set(found)) == 1 for found in files.values())
    assert len(rows_a_file(spark, path)) > 1


def test_reading_events_carries_no_names_of_columns(spark):
    """What the aggregates sort and shuffle has neither family nor qualifier."""
    stored = spark.createDataFrame([], CELLS + ", put_id BIGINT")
    plan = plan_of(cells.rating_event_rows(stored))
    aggregates = [line for line in plan.splitlines() if "SortAggregate" in line]
    assert len(aggregates) == 2 and not any("qualifier" in line for line in aggregates)


def test_columns_of_the_same_cell(spark):
    stored = spark.createDataFrame([("k", "f", "q", "1", 5), ("k", "f", "q", "2", 6), ("k", "f", "r", "3", 5), ("k", "f", "s", "4", 7)], CELLS)
    columns = {"text": ("f", "q", "string"), "number": ("f", "q", "bigint"), "other": ("f", "r", "string")}
    assert rows_of(cells.rows_from_cells(stored, columns)) == [("k", "2", 2, "3")]
    assert rows_of(cells.whole_rows(stored, columns)) == [("k", "2", 2, None)]
    assert rows_of(cells.whole_rows(stored, {"text": ("f", "q", "string")})) == [("k", "2")]


def test_tasks_that_sort_stored_cells_read_a_bounded_part(spark, tmp_path, monkeypatch):
    """Aggregates of a table read it by tasks of bounded bytes, however few cores there are; the session stays as it was."""
    from ratingloom.sinks import cells as sink

    monkeypatch.setattr(sink, "SORTED_BYTES", 50_000)
    monkeypatch.setattr(sink, "READ_BYTES", 30_000)
    monkeypatch.setattr(sink, "OPENED_BYTES", 1_000)
    path, keys = str(tmp_path / "c"), ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(key) for key in keys]
    frame = one_bucket(spark, 80_000)
    write_cells(frame, path, 0, split=1, buckets=1)
    with sink.small_scans(spark):
        assert read_cells(spark, path).rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    scans = []
    small_scans = sink.small_scans
    monkeypatch.setattr(sink, "small_scans", lambda session: scans.append(session) or small_scans(session))
    assert rows_of(sink.read_latest(spark, path, 21 * DAY)) == rows_of(cells.latest_cells(frame))
    maintain_cells(spark, path, 0, 21 * DAY, buckets=1)
    compact_cells(spark, path, str(tmp_path / "compact"), 21 * DAY, buckets=1)
    assert len(scans) == 3 and [spark.conf.get(key) for key in keys] == before
