"""Streams over several micro-batches must end where a batch over the same messages does."""

import random
import time
from collections import defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.operators import cells, ranking, stats
from ratingloom.plans import live, serving
from ratingloom.session import STREAMING_SETTINGS
from ratingloom.sinks.archive import HOUR_MS, drop_hours, read_archive, write_archive
from ratingloom.sinks.batches import MergedTable, complete_batches
from ratingloom.sinks.cells import read_cells
from ratingloom.sources.stored import read_csv
from ratingloom.sources.streams import read_message_stream, read_table_stream, read_text_stream
from ratingloom.streaming import normalise, queries, state

FILES = 4


def texts(count, seed):
    """Lines and messages in turn, some of them broken, with a third of all ratings for one movie."""
    dice = random.Random(seed)
    out = []
    for i in range(count):
        movie = "hot" if i % 3 == 0 else f"m{dice.randint(1, 12)}"
        rating = dice.randint(1, 10) / 2
        kind = dice.randint(0, 9)
        if kind < 4:
            out.append(f"u{i}::{movie}::{rating}::{i}")
        elif kind < 8:
            source = dice.choice(["s", "t"])
            out.append(f'{{"userId":"u{i}","movieId":"{movie}","rating":{rating},"source":"{source}","timestamp":{i}}}')
        else:
            out.append(dice.choice(["", "a::b", "{broken", f"u{i}::{movie}::x::1"]))
    return out


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for i in range(FILES):
        (path / f"part-{i}.txt").write_text("\n".join(texts(60, i)) + "\n")
    return path


@pytest.fixture
def stream(spark, folder):
    def start():
        return normalise.from_mixed(read_text_stream(spark, str(folder), files_per_trigger=1), "lines")

    return start


def batch(spark, folder):
    return normalise.from_mixed(spark.read.text(str(folder)).withColumnRenamed("value", "raw"), "lines")


def add_file(folder):
    (folder / "part-9.txt").write_text("\n".join(texts(60, 9)) + "\n")


def finish(query):
    query.awaitTermination()
    return query


def test_complete_mode_and_restart(spark, stream, folder, tmp_path):
    def run():
        return finish(
            queries.start_snapshot(
                stats.live_movie_stats(stream()), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None
            )
        )

    assert run().lastProgress["batchId"] == FILES - 1
    expected = rows_of(stats.live_movie_stats(batch(spark, folder)))
    assert rows_of(queries.read_snapshot(spark, f"{tmp_path}/out")) == expected
    run()  # nothing new
    assert rows_of(queries.read_snapshot(spark, f"{tmp_path}/out")) == expected
    add_file(folder)
    run()
    after = rows_of(stats.live_movie_stats(batch(spark, folder)))
    assert after != expected
    assert rows_of(queries.read_snapshot(spark, f"{tmp_path}/out")) == after


def test_update_mode_writes_changed_keys_as_cells(spark, stream, folder, tmp_path):
    def run():
        return finish(
            queries.start_cell_upsert(
                stats.live_movie_stats(stream()), f"{tmp_path}/cells", f"{tmp_path}/check", trigger=None
            )
        )

    def expected():
        rows = stats.live_movie_stats(batch(spark, folder))
        return rows_of(
            rows.select(F.concat_ws("_", "movieId", "source").alias("row_key"), "source", "avgRating", "totalVotes")
        )

    run()
    stored = read_cells(spark, f"{tmp_path}/cells")
    assert stored.select("batch_id").distinct().count() == FILES
    assert rows_of(cells.movie_stats_rows(stored)) == expected()
    before = rows_of(stored)
    run()
    assert rows_of(read_cells(spark, f"{tmp_path}/cells")) == before
    add_file(folder)
    run()
    assert rows_of(cells.movie_stats_rows(read_cells(spark, f"{tmp_path}/cells"))) == expected()


def test_archive_appends_once(spark, stream, folder, tmp_path):
    def run():
        return finish(queries.start_archive(stream(), f"{tmp_path}/raw", f"{tmp_path}/check", trigger=None))

    run()
    run()
    archived = read_csv(spark, f"{tmp_path}/raw", schemas.ARCHIVE)
    assert rows_of(archived) == rows_of(batch(spark, folder))
    add_file(folder)
    run()
    assert rows_of(read_csv(spark, f"{tmp_path}/raw", schemas.ARCHIVE)) == rows_of(batch(spark, folder))


def test_source_stats_on_a_stream(spark, stream, folder, tmp_path):
    finish(
        queries.start_snapshot(stats.source_stats(stream()), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None)
    )
    got = {row.source: row for row in queries.read_snapshot(spark, f"{tmp_path}/out").collect()}
    for row in stats.source_stats_exact(batch(spark, folder)).collect():
        assert (row.totalRatings, row.avgRating) == (got[row.source].totalRatings, got[row.source].avgRating)
        assert abs(row.uniqueMovies - got[row.source].uniqueMovies) <= 2


def test_state_outside_the_heap_gives_the_same(spark, stream, folder, tmp_path):
    for key, value in STREAMING_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        finish(
            queries.start_snapshot(
                stats.live_movie_stats(stream()), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None
            )
        )
    finally:
        for key in STREAMING_SETTINGS:
            spark.conf.unset(key)
    assert rows_of(queries.read_snapshot(spark, f"{tmp_path}/out")) == rows_of(
        stats.live_movie_stats(batch(spark, folder))
    )


def test_a_failing_sink_fails_the_query(spark, stream, tmp_path):
    (tmp_path / "cells").write_text("a file where a folder is needed")
    query = queries.start_cell_upsert(
        stats.live_movie_stats(stream()), f"{tmp_path}/cells", f"{tmp_path}/check", trigger=None
    )
    with pytest.raises(Exception):
        query.awaitTermination()
    assert query.exception() is not None


def test_recent_ratings_follow_the_stream(spark, stream, folder, tmp_path):
    def run():
        finish(queries.start_recent(stream(), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None, n=3, fold_every=2))
        expected = rows_of(ranking.recent_per_movie(batch(spark, folder), 3))
        assert rows_of(queries.read_recent(spark, f"{tmp_path}/out", 3).select(expected_columns)) == expected

    expected_columns = ranking.recent_per_movie(batch(spark, folder), 3).columns
    run()
    run()
    add_file(folder)
    run()


def stored_bytes(folder):
    return sum(file.stat().st_size for file in folder.rglob("*.parquet"))


def test_a_batch_writes_the_tails_of_its_own_movies_only(spark, tmp_path):
    """However many movies there are, a batch with ratings of one movie writes one movie."""
    written = []
    for movies in (10, 3_000):
        path = tmp_path / str(movies)
        table = queries.recent_table(spark, str(path), 15)
        first = spark.range(movies * 5).selectExpr(
            "CAST(id AS STRING) AS userId", f"CAST(id % {movies} AS STRING) AS movieId", "3.0D AS rating", "'s' AS source", "id AS event_ts"
        )
        queries.recent_sink(str(path), 15, fold_every=1).write(first, 0)
        new = spark.createDataFrame([("u", "1", 4.0, "s", 10**9)], schemas.ARCHIVE)
        queries.recent_sink(str(path), 15, fold_every=100).write(new, 1)
        written.append(stored_bytes(path / "parts/batch_id=1"))
        assert ("u", "1", 4.0, "s", 10**9) in rows_of(table.read())
        assert table.read().count() == movies * 5 + 1
    assert abs(written[0] - written[1]) < 100


def test_a_merged_table_folds_and_keeps_what_readers_have_open(spark, tmp_path):
    def merge(parts):
        return parts.groupBy("key").agg(F.sum("n").alias("n"))

    table = MergedTable(spark, str(tmp_path / "t"), "key STRING, n BIGINT", merge)
    assert table.read().collect() == []
    total = 0
    for number in range(12):
        early = table.read()
        rows = spark.createDataFrame([("a", number), (f"b{number}", 1)], "key STRING, n BIGINT")
        before = total
        for _ in range(2):  # a batch may be repeated
            table.update(rows, number, fold_every=3)
        total += number
        found = {row.key: row.n for row in table.read().collect()}
        assert found["a"] == total and len(found) == number + 2
        assert {row.key: row.n for row in early.collect()}.get("a", 0) == before
    assert len(complete_batches(spark, table.wholes)) == 2
    assert len(complete_batches(spark, table.parts)) <= 6
    assert {row.key: row.n for row in table.read(until=10).collect()}["a"] == total - 11


def test_a_part_that_is_not_complete_does_not_count(spark, tmp_path):
    table = queries.recent_table(spark, str(tmp_path / "t"), 5)
    table.append(spark.createDataFrame([("u", "m", 1.0, "s", 1)], schemas.ARCHIVE), 0)
    table.append(spark.createDataFrame([("u", "m", 2.0, "s", 2)], schemas.ARCHIVE), 1)
    (tmp_path / "t/parts/batch_id=1/_SUCCESS").unlink()
    assert [row.rating for row in table.read().collect()] == [1.0]


SETTINGS = live.Settings(state_partitions=3, fold_every=2, console_rows=2)


def live_rows(spark, path):
    return {name: frame for name, frame in serving.live_tables(spark, path).items()}


def test_the_live_job_has_named_queries_and_several_sinks_each(spark, folder, stream, tmp_path, capfd):
    path = str(tmp_path / "out")

    def run():
        started = live.start(stream(), path, SETTINGS, once=True)
        assert [query.name for query in started] == ["statistics", "ratings"]
        for query in started:
            finish(query)
        return started

    for _ in range(2):
        for query in run():
            assert query.lastProgress is None or "ForeachBatch" in query.lastProgress["sink"]["description"]
        expected = batch(spark, folder)
        kept = live_rows(spark, path)
        assert rows_of(kept["archive"].select(*expected.columns)) == rows_of(expected)
        assert rows_of(kept["recent"].select(*expected.columns)) == rows_of(ranking.recent_per_movie(expected))
        wanted = expected.groupBy("movieId", "source").agg(
            F.round(F.avg("rating"), 2), F.count("*"), F.round(F.stddev_samp("rating"), 9)
        )
        found = kept["movie_stats"].select("row_key", "source", "avgRating", "totalVotes", F.round("stddev", 9))
        assert rows_of(found) == sorted((tuple([f"{m}_{s}", s, *rest]) for m, s, *rest in wanted.collect()), key=repr)
        exact = {row.source: row for row in stats.source_stats_exact(expected).collect()}
        for row in kept["source_stats"].collect():
            assert (row.totalRatings, row.avgRating) == (exact[row.source].totalRatings, exact[row.source].avgRating)
            assert abs(row.uniqueMovies - exact[row.source].uniqueMovies) <= 1
        add_file(folder)
    assert "only showing top 2 rows" in capfd.readouterr().out


def test_statistics_do_not_wait_for_the_archive(spark, stream, folder, tmp_path):
    """A rating is in the statistics before the next batch of the slower query."""
    path = str(tmp_path / "out")
    settings = live.Settings("100 milliseconds", "1 hour", state_partitions=3)
    started = live.start(stream(), path, settings)
    try:
        deadline = time.time() + 60
        while started[1].lastProgress is None and time.time() < deadline:
            time.sleep(0.1)
        archived = rows_of(live_rows(spark, path)["archive"])
        (folder / "part-new.txt").write_text("u::brand-new::4.5::7\n")
        found = []
        while not found and time.time() < deadline:
            started[0].processAllAvailable()
            found = [row for row in live_rows(spark, path)["movie_stats"].collect() if row.row_key == "brand-new_lines"]
        assert [(row.avgRating, row.totalVotes) for row in found] == [(4.5, 1)]
        assert rows_of(live_rows(spark, path)["archive"]) == archived
        assert started[1].isActive and started[1].lastProgress["batchId"] == 0
    finally:
        for query in started:
            query.stop()


def test_a_sink_that_fails_fails_the_batch_which_is_then_repeated(spark, stream, folder, tmp_path):
    seen, broken = [], [True]

    def second(rows, batch_id):
        if broken[0] and batch_id == 1:
            raise RuntimeError("not yet")

    def run():
        sinks = [
            queries.Sink("count", lambda rows, batch_id: seen.append((batch_id, rows.count()))),
            queries.recent_sink(f"{tmp_path}/recent", 500),
            queries.Sink("second", second),
        ]
        return queries.start_fan_out(stream(), sinks, f"{tmp_path}/check", "both", None)

    with pytest.raises(Exception, match="not yet"):
        finish(run())
    broken[0] = False
    finish(run())
    assert [number for number, _ in seen] == [0, 1, 1, 2, 3]
    assert seen[1] == seen[2]
    assert rows_of(queries.read_recent(spark, f"{tmp_path}/recent", 500)) == rows_of(
        ranking.recent_per_movie(batch(spark, folder), 500)
    )


def test_the_source_is_read_once_for_all_sinks_of_a_query(spark, stream, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    rows = stream().withColumn("userId", counted("userId").alias("userId"))
    sinks = [queries.recent_sink(f"{tmp_path}/recent"), queries.source_sink(f"{tmp_path}/sources"), queries.Sink("n", lambda rows, _: rows.count())]
    finish(queries.start_fan_out(rows, sinks, f"{tmp_path}/check", "all", None))
    assert read.value == queries.read_source_stats(spark, f"{tmp_path}/sources").agg(F.sum("totalRatings")).first()[0]


def test_archived_hours_are_folders_and_go_as_such(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.createDataFrame(
        [("u1", "a\nb", 4.0, "s", 1, 5 * HOUR_MS + 1), ("u2", "m", 3.0, None, None, 7 * HOUR_MS)], f"{schemas.ARCHIVE}, ms BIGINT"
    ).withColumn("seen", F.timestamp_millis("ms"))
    for _ in range(2):
        write_archive(rows, path, 0)
    write_archive(rows.where("userId = 'u2'"), path, 1)
    assert read_archive(spark, path).count() == 3
    assert sorted(folder.name for folder in (tmp_path / "raw").glob("hour=*")) == ["hour=5", "hour=7"]
    drop_hours(spark, path, 8 * HOUR_MS, 2)
    assert [row.userId for row in read_archive(spark, path).collect()] == ["u2", "u2"]


def test_the_log_of_the_file_sink_stays_bounded(spark, tmp_path):
    """K6: with a retention, the sink forgets old files; without, it lists them all for ever."""
    names = {
        "spark.sql.streaming.fileSink.log.compactInterval": "3",
        "spark.sql.streaming.fileSink.log.cleanupDelay": "0",
        "spark.sql.streaming.minBatchesToRetain": "2",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        listed = {}
        for retention in ("1s", None):
            source = tmp_path / f"in-{retention}"
            source.mkdir()
            out = tmp_path / f"raw-{retention}"
            for k in range(14):
                (source / f"{k}.txt").write_text(f"u{k}::m::4.0::1\n")
                rows = normalise.from_lines(read_text_stream(spark, str(source)))
                finish(queries.start_archive(rows, str(out), f"{out}-check", None, retention=retention, hourly=True))
                time.sleep(0.3 if retention else 0)
            compact = max((out / "_spark_metadata").glob("*.compact"), key=lambda file: int(file.name.split(".")[0]))
            listed[retention] = compact.read_text().count("path")
            assert len([name for name in (out / "_spark_metadata").iterdir() if not name.name.startswith(".")]) < 14
            assert all(folder.name.startswith("hour=") for folder in out.iterdir() if not folder.name.startswith("_"))
        assert listed["1s"] < 8 <= listed[None]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_files_of_a_folder_source_may_go_once_they_are_read(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(6):
        (source / f"{k}.txt").write_text(f"u{k}::m::4.0::1\n")
        rows = normalise.from_lines(read_text_stream(spark, str(source), when_read="delete"))
        finish(queries.start_archive(rows, f"{tmp_path}/raw", f"{tmp_path}/check", None))
    time.sleep(1)  # files are removed in the background
    assert len(list(source.glob("*.txt"))) < 6
    assert read_archive(spark, f"{tmp_path}/raw").count() == 6


def test_state_has_as_many_partitions_as_asked_for(spark, stream, folder, tmp_path):
    """And their number stays with the checkpoint."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")

    def run(partitions):
        finish(
            queries.start_snapshot(
                stats.live_movie_stats(stream()), f"{tmp_path}/out", f"{tmp_path}/check", None, partitions=partitions
            )
        )
        return state.state_summary(spark, f"{tmp_path}/check").first()

    entries = batch(spark, folder).select("movieId", "source").distinct().count()
    found = run(7)
    assert (found.partitions, found.entries) == (7, entries) and entries / 7 <= found.largest < entries
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    add_file(folder)
    assert run(2).partitions == 7
    rows = state.state_rows(spark, f"{tmp_path}/check").select("key.movieId", "key.source", "partition_id").collect()
    assert len({(row.movieId, row.source) for row in rows}) == len(rows)
    assert {row.partition_id for row in rows} <= set(range(7))


def test_options_of_the_command_line():
    output, kind, where, settings = live.parsed(
        ["out", "mixed", "host:1", "topic", "--state-partitions", "64", "--statistics-interval", "1 second", "--archive-hours", "48"]
    )
    assert (output, kind, where) == ("out", "mixed", ["host:1", "topic"])
    assert settings == live.Settings("1 second", state_partitions=64, archive_hours=48)
    with pytest.raises(SystemExit):
        live.parsed(["out", "files", "one"])


def test_queries_keep_running_with_an_interval(spark, stream, folder, tmp_path):
    query = queries.start_archive(stream(), f"{tmp_path}/raw", f"{tmp_path}/check", trigger="100 milliseconds")
    try:
        query.processAllAvailable()
        add_file(folder)
        query.processAllAvailable()
        assert query.isActive and query.name == "archive"
    finally:
        query.stop()
    assert rows_of(read_csv(spark, f"{tmp_path}/raw", schemas.ARCHIVE)) == rows_of(batch(spark, folder))


def test_tables_and_messages_as_streams(spark, tmp_path):
    frame = spark.createDataFrame([(f"k{i}", f"u::m::{i}::{i}") for i in range(9)], "key STRING, value STRING")
    frame.coalesce(1).write.parquet(f"{tmp_path}/topic")
    part = next((tmp_path / "topic").glob("*.parquet"))
    single = tmp_path / "one.parquet"
    single.write_bytes(part.read_bytes())
    other = tmp_path / "other.parquet"
    other.write_bytes(part.read_bytes())
    sources = {
        "folder": read_message_stream(spark, f"{tmp_path}/topic"),
        "file": read_table_stream(spark, str(single), "key STRING, value STRING").select(F.col("value").alias("raw")),
    }
    for name, raw in sources.items():
        finish(
            queries.start_archive(
                normalise.from_lines(raw), f"{tmp_path}/{name}-raw", f"{tmp_path}/{name}-check", trigger=None
            )
        )
        assert read_csv(spark, f"{tmp_path}/{name}-raw", schemas.ARCHIVE).count() == 9


def test_one_hot_movie_is_one_state_entry_per_source(spark, stream, tmp_path):
    finish(
        queries.start_snapshot(
            stats.live_movie_stats(stream()), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None
        )
    )
    groups = defaultdict(int)
    for row in queries.read_snapshot(spark, f"{tmp_path}/out").collect():
        groups[row.movieId] += 1
    assert groups["hot"] == 3  # lines, s, t


def test_line_breaks_and_quotes_in_texts_go_through_the_live_job(spark, tmp_path):
    texts = ["a\nb", "a\rb", 'a"b', "a,b", "a\\nb", " a "]
    rows = [(text, f"m{text}", 4.0 + k / 2, f"s{text}", k) for k, text in enumerate(texts)]
    ratings = spark.createDataFrame(rows, schemas.ARCHIVE)
    ratings.write.parquet(f"{tmp_path}/in")

    def run():
        source = spark.readStream.schema(schemas.ARCHIVE).parquet(f"{tmp_path}/in")
        for query in live.start(source, f"{tmp_path}/out", SETTINGS, once=True):
            finish(query)

    for _ in range(2):
        run()
        kept = live_rows(spark, f"{tmp_path}/out")
        assert rows_of(kept["recent"].select(*ratings.columns)) == rows_of(ratings)
        assert {tuple(row)[:4] for row in kept["movie_stats"].collect()} == {
            (f"m{t}_s{t}", f"s{t}", 4.0 + k / 2, 1) for k, t in enumerate(texts)
        }
        assert kept["archive"].count() == len(texts)


def test_a_reader_gets_the_batch_before_while_one_is_written(spark, tmp_path):
    spark.range(8).write.parquet(f"{tmp_path}/out/batch_id=9")
    spark.range(3).write.parquet(f"{tmp_path}/out/batch_id=10")
    assert queries.read_snapshot(spark, f"{tmp_path}/out").count() == 3
    (tmp_path / "out/batch_id=10/_SUCCESS").unlink()
    assert queries.read_snapshot(spark, f"{tmp_path}/out").count() == 8
    with pytest.raises(ValueError):
        queries.read_snapshot(spark, f"{tmp_path}/none")
