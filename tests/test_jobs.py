"""The batch job and the serving views over its outputs."""

import math

import pytest
from conftest import SF_DIR, plan_of, rows_of
from pyspark.sql import functions as F

from ratingloom import schemas, session
from ratingloom.fixed_values import STRICT_OUTPUT_PARTITIONS
from ratingloom.plans import batch, live, serving
from ratingloom.sources.stored import availability, read_csv, read_strict_means
from ratingloom.sinks.csv import write_csv
from ratingloom.streaming import normalise
from ratingloom.sources.streams import read_text_stream
from verification import views


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    views.rating_lines(spark, SF_DIR).where("value IS NOT NULL").write.text(f"{folder}/ratings")
    views.movie_lines(spark, SF_DIR).write.text(f"{folder}/movies")
    return folder


@pytest.fixture(scope="module")
def output(spark, inputs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("out"))
    batch.run(spark, f"{inputs}/ratings", f"{inputs}/movies", path)
    batch.run_strict(spark, f"{inputs}/ratings", f"{path}/strict-means", STRICT_OUTPUT_PARTITIONS)
    return path


def test_small_outputs_are_single_files_with_a_header(output):
    from pathlib import Path

    for name in ("movie-stats", "top10", "genre-stats", "rating-distribution"):
        files = list(Path(output, name).glob("part-*.csv"))
        assert len(files) == 1
    assert files[0].read_text().splitlines()[0] == "rating,count"
    assert len(list(Path(output, "strict-means").glob("part-*"))) == 2


def test_outputs_agree_with_each_other(spark, output):
    views_by_name = serving.batch_views(spark, output)
    counted = views_by_name["movie_count"].first()[0]
    movie_stats = read_csv(spark, f"{output}/movie-stats", schemas.MOVIE_STATS)
    assert counted == movie_stats.count() > 0
    assert views_by_name["movie_map"].count() <= counted
    assert views_by_name["total_ratings"].first()[0] == (
        read_csv(spark, f"{output}/rating-distribution", schemas.RATING_DISTRIBUTION).agg(F.sum("count")).first()[0]
    )
    assert views_by_name["strict_top"].count() == 20
    genres = views_by_name["genre_stats"].collect()
    assert views_by_name["genre_count"].first()[0] == len(genres)
    assert [row.avgRating for row in genres] == sorted((row.avgRating for row in genres), reverse=True)
    # No movie of this scale has the 100 votes of the default.
    assert views_by_name["top10"].count() == 0
    assert {"full_stars", "half_star", "empty_stars"} <= set(views_by_name["top10"].columns)


def test_strict_means_read_back(spark, output, tmp_path):
    means = read_strict_means(spark, f"{output}/strict-means")
    assert means.count() > 0 and means.where("avgRating IS NULL").count() == 0
    (tmp_path / "part-0").write_text("1\t3.50\t2\n2\tx\t1\n3\t4.00\n\n4\tNaN\t1\n5\t1\t1.5\n6\t2.345\t3\tmore\n")
    rows = {row.movieId: row for row in read_strict_means(spark, str(tmp_path)).collect()}
    assert set(rows) == {"1", "4", "6"} and math.isnan(rows["4"].avgRating) and rows["6"].avgRating == 2.35


def test_csv_keeps_every_text(spark, tmp_path):
    titles = ['say "hi"', "a, b", " blanks ", "", None, "back\\slash", "tab\there", "Amélie"]
    frame = spark.createDataFrame([(i, t, None if i % 2 else 1.5, i) for i, t in enumerate(titles)], schemas.MOVIE_STATS)
    write_csv(frame, str(tmp_path / "csv"))
    assert rows_of(read_csv(spark, str(tmp_path / "csv"), schemas.MOVIE_STATS)) == rows_of(frame)


def test_availability(spark, output, tmp_path):
    rows = {row.dataset: row for row in serving.status(spark, output, counted=True).collect()}
    assert rows["mapreduce"].available and rows["mapreduce"].row_count > 0
    assert rows["spark_batch"].available and rows["spark_batch"].row_count == 0
    assert not rows["streaming"].available and rows["streaming"].row_count == 0
    views.ratings(spark, SF_DIR).write.parquet(str(tmp_path / "p"))
    found = availability(spark, {"p": (str(tmp_path / "p"), "parquet")}).first()
    assert found.available and found.row_count == views.ratings(spark, SF_DIR).count()


def test_what_is_there_is_told_by_the_listing(spark, output, tmp_path):
    """No file is opened unless rows are to be counted."""
    listed = serving.status(spark, output)
    assert "Scan" not in plan_of(listed).replace("LocalTableScan", "")
    assert {(row.dataset, row.available, row.row_count) for row in listed.collect()} == {
        ("mapreduce", True, None), ("spark_batch", True, None), ("streaming", False, None),
    }
    for name, there in [("_SUCCESS", False), (".part-0.crc", False), ("_temporary/part-0", False), ("hour=3/part-0", True)]:
        file = tmp_path / "d" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
        assert availability(spark, {"d": (str(tmp_path / "d"), "text")}, counted=False).first().available is there
    (tmp_path / "e").mkdir()
    (tmp_path / "e/part-0").write_text("")
    assert not availability(spark, {"e": (str(tmp_path / "e"), "text")}, counted=False).first().available


def test_the_cube_goes_also_when_the_job_fails(spark, inputs, tmp_path, monkeypatch):
    def fails(*_):
        raise RuntimeError("no room")

    monkeypatch.setattr(batch, "write_reports", fails)
    folder = tmp_path / "shared"
    monkeypatch.setattr(batch, "shared_folder", lambda spark, label: str(folder / label))
    with pytest.raises(RuntimeError):
        batch.run(spark, f"{inputs}/ratings", f"{inputs}/movies", str(tmp_path / "out"))
    assert not (folder / "cube").exists()


def test_small_outputs_are_shown_as_written(spark, output, capfd):
    batch.show(spark, output)
    shown = capfd.readouterr().out
    assert shown.count("avgRating") == 2 and "|rating|count|" in shown.replace(" ", "")


def test_live_views(spark, inputs, output, tmp_path):
    path = str(tmp_path / "live")
    unified = normalise.from_mixed(read_text_stream(spark, f"{inputs}/ratings"))
    for query in live.start(unified, path, once=True):
        query.awaitTermination()
    titles = serving.batch_views(spark, output)["movie_map"]
    shown = serving.live_views(spark, path, titles)
    assert shown["sample"].count() == 120
    feed = shown["feed"].collect()
    assert len(feed) == 30 and all(row.displayName for row in feed)
    assert [row.event_ts for row in feed if row.event_ts] == sorted((r.event_ts for r in feed if r.event_ts), reverse=True)
    assert {"band", "full_stars", "displayName"} <= set(shown["feed"].columns)
    means = shown["sample_means"].collect()
    assert [row.movieId for row in means] == sorted(row.movieId for row in means)


def test_the_shared_folder_is_the_one_of_the_cluster(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert first.startswith(f"{base}/") and first != second


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(), "x")
