"""All registered queries. A check without SQL has no exact counterpart in DuckDB; its tests say what holds instead."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.fixed_values import JSON_SOURCE, LINE_SOURCE
from ratingloom.operators import cells, display, ranking, stats
from ratingloom.operators.partials import SKETCH_ERROR
from ratingloom.plans import batch, live, serving
from ratingloom.session import shared_folder
from ratingloom.sinks.cells import compact_cells, maintain_cells, read_cells, read_latest, write_cells
from ratingloom.sinks.csv import write_csv, write_strict_means
from ratingloom.sinks.messages import json_messages, line_messages, publish
from ratingloom.sources import lines, pages, stored
from ratingloom.streaming import normalise, queries, state
from verification import views
from verification.views import NOW_MS, exact_mean, round2, sql_json_rows, with_views

# At the given scales no movie has 100 votes.
MIN_VOTES = 30


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None = None, *sql_views: str):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        CHECKS[run.__name__] = Check(run, with_views(sql, *sql_views) if sql and sql_views else sql)
        return run

    return register


# ---- lines ----------------------------------------------------------------------------------------------------------


@check("SELECT * FROM lenient_view", "lenient")
def parse_lenient_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, P1, P2, F1"""
    return lines.lenient_ratings(views.rating_lines(spark, sf_dir))


@check(
    f"""SELECT {views.sql_whole('p[1]')} AS movieId, p[2] AS title, p[3] AS genres
    FROM (SELECT string_split(value, '::') AS p FROM movie_lines_view)""",
    "movie_lines",
)
def parse_lenient_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2"""
    return lines.lenient_movies(views.movie_lines(spark, sf_dir))


@check("SELECT * FROM lenient_view", "lenient")
def scan_rating_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 from text files"""
    path = shared_folder(spark, "rating-lines")
    views.rating_lines(spark, sf_dir).where("value IS NOT NULL").write.text(path)
    return lines.read_ratings(spark, path)


@check("SELECT movieId, rating FROM strict_view", "strict")
def parse_strict_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, C3, F2, F3"""
    return lines.strict_ratings(views.rating_lines(spark, sf_dir))


@check("SELECT movieId AS key, line AS value FROM strict_view", "strict")
def replay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published and read back"""
    path = shared_folder(spark, "replay")
    publish(line_messages(lines.replay_lines(views.rating_lines(spark, sf_dir))), path)
    return spark.read.parquet(path)


@check("SELECT * FROM strict_means_view", "strict_means")
def strict_movie_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, F8, F9, C5"""
    return stats.strict_means(lines.strict_ratings(views.rating_lines(spark, sf_dir)))


def _stored_strict_means(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    path = shared_folder(spark, "strict-means")
    write_strict_means(stats.strict_mean_lines(strict_movie_average(spark, sf_dir), partitions), path)
    return stored.read_strict_means(spark, path)


@check("SELECT movieId, CAST(avg AS DOUBLE) AS avgRating, count FROM strict_means_view", "strict_means")
def strict_text_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written and read back"""
    return _stored_strict_means(spark, sf_dir, 2)


@check(
    """SELECT movieId, CAST(avg AS DOUBLE) AS avgRating, count FROM strict_means_view
    ORDER BY avgRating DESC, movieId LIMIT 20""",
    "strict_means",
)
def strict_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5"""
    return ranking.top_strict_means(_stored_strict_means(spark, sf_dir, None))


# ---- batch reports --------------------------------------------------------------------------------------------------


def _movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_titles(stats.movie_stats(views.ratings(spark, sf_dir)), views.movies(spark, sf_dir))


def _genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = stats.rating_totals(views.ratings(spark, sf_dir), "movieId")
    return stats.genre_stats(totals, views.movies(spark, sf_dir))


@check("SELECT * FROM movie_stats_view", "movie_stats")
def movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, J1, O1"""
    return ranking.by_rating(_movie_stats(spark, sf_dir))


@check(
    f"""SELECT * FROM movie_stats_view WHERE totalVotes >= {MIN_VOTES}
    ORDER BY avgRating DESC, totalVotes DESC, movieId LIMIT 10""",
    "movie_stats",
)
def top_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, O2"""
    return ranking.top_movies(_movie_stats(spark, sf_dir), min_votes=MIN_VOTES)


@check("SELECT * FROM genre_stats_view", "genre_stats")
def genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, A3, C2, O3"""
    return ranking.genres_by_rating(_genre_stats(spark, sf_dir))


@check("SELECT rating, count(rating) AS count FROM ratings_view GROUP BY rating", "ratings")
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, O4"""
    return ranking.by_rating_value(stats.rating_distribution(views.ratings(spark, sf_dir)))


@check(
    f"""SELECT 'movie' AS kind, movieId, NULL AS rating, {round2('avg(rating)')} AS avgRating, count(rating) AS votes
    FROM lenient_view GROUP BY movieId UNION ALL
    SELECT 'rating', NULL, rating, NULL, count(rating) FROM lenient_view GROUP BY rating""",
    "lenient",
)
def null_rating_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A4 on defective lines: keys without any valid rating keep a row with 0 votes."""
    parsed = lines.lenient_ratings(views.rating_lines(spark, sf_dir))
    by_movie = stats.movie_stats(parsed).select(
        F.lit("movie").alias("kind"),
        "movieId",
        F.lit(None).cast("double").alias("rating"),
        "avgRating",
        F.col("totalVotes").alias("votes"),
    )
    by_value = stats.rating_distribution(parsed).select(
        F.lit("rating").alias("kind"),
        F.lit(None).cast("int").alias("movieId"),
        "rating",
        F.lit(None).cast("double").alias("avgRating"),
        F.col("count").alias("votes"),
    )
    return by_movie.unionByName(by_value)


@check("SELECT * FROM movie_stats_view", "movie_stats")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, S7"""
    path = shared_folder(spark, "csv")
    write_csv(movie_stats(spark, sf_dir), path)
    return stored.read_csv(spark, path, schemas.MOVIE_STATS)


@check(
    f"""SELECT 'movie-stats' AS output, CAST(movieId AS VARCHAR) AS name, avgRating AS value, totalVotes AS votes
    FROM movie_stats_view UNION ALL
    (SELECT 'top10', CAST(movieId AS VARCHAR), avgRating, totalVotes FROM movie_stats_view
     WHERE totalVotes >= {MIN_VOTES} ORDER BY avgRating DESC, totalVotes DESC, movieId LIMIT 10) UNION ALL
    SELECT 'genre-stats', genre, avgRating, totalRatings FROM genre_stats_view UNION ALL
    SELECT 'rating-distribution', NULL, rating, count(rating) FROM ratings_view GROUP BY rating""",
    "movie_stats",
    "genre_stats",
)
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job: all four outputs written and read back, as one list."""
    path = shared_folder(spark, "reports")
    outputs = batch.reports(
        views.ratings(spark, sf_dir), views.movies(spark, sf_dir), f"{path}/cube", min_votes=MIN_VOTES
    )
    batch.write_reports(outputs, path)
    columns = {
        "movie-stats": (schemas.MOVIE_STATS, "CAST(movieId AS STRING)", "avgRating", "totalVotes"),
        "top10": (schemas.MOVIE_STATS, "CAST(movieId AS STRING)", "avgRating", "totalVotes"),
        "genre-stats": (schemas.GENRE_STATS, "genre", "avgRating", "totalRatings"),
        "rating-distribution": (schemas.RATING_DISTRIBUTION, "CAST(NULL AS STRING)", "rating", "count"),
    }
    parts = [
        stored.read_csv(spark, f"{path}/{output}", schema).selectExpr(
            f"'{output}' AS output", f"{name} AS name", f"{value} AS value", f"`{votes}` AS votes"
        )
        for output, (schema, name, value, votes) in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@check("SELECT movieId, title FROM movie_stats_view", "movie_stats")
def movie_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8"""
    return display.movie_map(_movie_stats(spark, sf_dir))


@check("SELECT count(*) AS count FROM movie_stats_view", "movie_stats")
def movie_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7"""
    return stats.row_count(_movie_stats(spark, sf_dir))


@check("SELECT CAST(count(rating) AS BIGINT) AS total FROM ratings_view", "ratings")
def total_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8"""
    return stats.total_ratings(stats.rating_distribution(views.ratings(spark, sf_dir)))


@check("SELECT count(DISTINCT genre) AS count FROM ratings_view JOIN genres_view USING (movieId)", "ratings", "genres")
def genre_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9"""
    return stats.row_count(_genre_stats(spark, sf_dir))


# ---- messages and streams -------------------------------------------------------------------------------------------


@check(
    f"""SELECT concat('item-', movieId) AS key, concat('{{"userId":"user', userId, '","movieId":"item-', movieId,
    '","rating":', CAST(rating AS VARCHAR), ',"ratingRaw":', CAST(rating * 2 AS INTEGER),
    ',"source":"{JSON_SOURCE}","timestamp":', timestamp * 1000, '}}') AS value FROM ratings_view""",
    "ratings",
)
def json_rating_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published and read back"""
    path = shared_folder(spark, "messages")
    rated = views.ratings(spark, sf_dir).selectExpr(
        "concat('user', userId) AS userId",
        "concat('item-', movieId) AS movieId",
        "rating",
        "CAST(rating * 2 AS INT) AS ratingRaw",
        "timestamp * 1000 AS timestamp",
    )
    publish(json_messages(rated), path)
    return spark.read.parquet(path)


@check(sql_json_rows("raw", "json_texts_view"), "json_texts")
def parse_json_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, C6, P5, F4, F5"""
    return normalise.from_json_messages(views.json_texts(spark, sf_dir))


_MIXED_SQL = f"""SELECT * FROM (SELECT p[1] AS userId, p[2] AS movieId, {views.sql_real('p[3]')} AS rating,
    '{LINE_SOURCE}' AS source, {views.sql_whole('p[4]', 'BIGINT')} * 1000 AS event_ts
    FROM (SELECT string_split(raw, '::') AS p FROM mixed_view WHERE raw IS NOT NULL AND raw NOT LIKE '{{%'))
    WHERE movieId IS NOT NULL AND rating IS NOT NULL
    UNION ALL {sql_json_rows('raw', 'mixed_view', "raw LIKE '{%'")}"""


@check(_MIXED_SQL, "mixed")
def mixed_topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6, F6, U1"""
    return normalise.from_mixed(views.mixed_texts(views.table(spark, sf_dir, "lineitem")))


def _unified_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.unify(
        normalise.from_lines(views.lines_of(views.table_as_stream(spark, sf_dir, "lineitem"), "raw")),
        normalise.from_json_messages(views.event_messages(views.table_as_stream(spark, sf_dir, "events"))),
    )


def _unified_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.unify(
        normalise.from_lines(views.lines_of(views.table(spark, sf_dir, "lineitem"), "raw")),
        normalise.from_json_messages(views.event_messages(views.table(spark, sf_dir, "events"))),
    )


_LIVE_STATS_SQL = f"""SELECT movieId, source, {exact_mean('rating')} AS avgRating, count(rating) AS totalVotes
    FROM unified_view GROUP BY movieId, source"""


@check(_LIVE_STATS_SQL, "unified")
def live_movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete results of a stream"""
    folder = shared_folder(spark, "live-stats")
    running = stats.live_movie_stats(_unified_stream(spark, sf_dir), exact_scale=2)
    queries.start_snapshot(running, f"{folder}/result", f"{folder}/checkpoint", trigger=None).awaitTermination()
    return queries.read_snapshot(spark, f"{folder}/result")


@check(
    f"""SELECT concat(movieId, '_', source) AS row_key, source, {exact_mean('rating')} AS avgRating,
    count(rating) AS totalVotes FROM unified_view GROUP BY movieId, source""",
    "unified",
)
def live_movie_stats_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed results of a stream as cells, and their latest view"""
    folder = shared_folder(spark, "live-cells")
    running = stats.live_movie_stats(_unified_stream(spark, sf_dir), exact_scale=2)
    queries.start_cell_upsert(running, f"{folder}/cells", f"{folder}/checkpoint", trigger=None).awaitTermination()
    return cells.movie_stats_rows(read_cells(spark, f"{folder}/cells"))


@check(
    f"""SELECT source, count(rating) AS totalRatings, {exact_mean('rating')} AS avgRating,
    count(DISTINCT movieId) AS exactMovies, TRUE AS close FROM unified_view GROUP BY source""",
    "unified",
)
def live_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the movies per source, stored by batch and merged; `close` is an estimate within three standard errors"""
    folder = shared_folder(spark, "live-sources")
    queries.start_fan_out(
        _unified_stream(spark, sf_dir), [queries.source_sink(folder)], f"{folder}/checkpoint", "sources", None
    ).awaitTermination()
    exact = stats.source_stats_exact(_unified_batch(spark, sf_dir), exact_scale=2)
    found = queries.read_source_stats(spark, folder).join(exact.select("source", F.col("uniqueMovies").alias("exactMovies")), "source")
    error = F.abs(F.col("uniqueMovies") - F.col("exactMovies"))
    close = error <= F.greatest(F.lit(1.0), 3 * SKETCH_ERROR * F.col("exactMovies"))
    return found.select("source", "totalRatings", "avgRating", "exactMovies", close.alias("close"))


@check(
    f"""SELECT concat(movieId, '_', source) AS row_key, source, {exact_mean('rating')} AS avgRating,
    count(rating) AS totalVotes, round(stddev_samp(rating), 6) AS stddev FROM unified_view GROUP BY movieId, source""",
    "unified",
)
def live_stats_with_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics with deviation and source from streaming state, written as cells and read back"""
    folder = shared_folder(spark, "live-stddev")
    queries.start_fan_out(
        queries.running_statistics(_unified_stream(spark, sf_dir)), [queries.cell_sink(f"{folder}/cells")],
        f"{folder}/checkpoint", "statistics", None, mode="complete",
    ).awaitTermination()
    rows = cells.movie_stats_rows(read_cells(spark, f"{folder}/cells"), with_stddev=True)
    return rows.withColumn("stddev", F.round("stddev", 6))


@check(
    "SELECT 'stateStoreSave' AS operator, 6 AS partitions, count(*) AS entries FROM (SELECT DISTINCT movieId, source FROM unified_view)",
    "unified",
)
def live_state_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the running statistics, in as many partitions as asked for, read back from the checkpoint"""
    folder = shared_folder(spark, "live-state")
    queries.start_snapshot(
        stats.live_movie_stats(_unified_stream(spark, sf_dir)), f"{folder}/result", f"{folder}/checkpoint", None, partitions=6
    ).awaitTermination()
    return state.state_summary(spark, f"{folder}/checkpoint").drop("largest")


@check(
    f"""SELECT 'movie_stats' AS output, concat(movieId, '_', source) AS key, source, {exact_mean('rating')} AS mean,
    count(rating) AS number, round(stddev_samp(rating), 6) AS stddev FROM unified_view GROUP BY movieId, source
    UNION ALL SELECT 'source_stats', source, source, {exact_mean('rating')}, count(rating), NULL FROM unified_view GROUP BY source
    UNION ALL SELECT 'archive', movieId, source, rating, event_ts, NULL FROM unified_view
    UNION ALL SELECT 'recent', movieId, source, rating, event_ts, NULL FROM (SELECT *, row_number() OVER (PARTITION BY movieId
    ORDER BY event_ts DESC NULLS LAST, userId, rating, source) AS rank FROM unified_view) WHERE rank <= 15""",
    "unified",
)
def live_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming job over what is there, and everything it wrote"""
    folder = shared_folder(spark, "live-job")
    settings = live.Settings(state_partitions=8)
    for query in live.start(_unified_stream(spark, sf_dir), folder, settings, once=True):
        query.awaitTermination()
    kept = serving.live_tables(spark, folder)
    rated = {name: kept[name].selectExpr(f"'{name}' AS output", "movieId AS key", "source", "rating AS mean", "event_ts AS number", "CAST(NULL AS DOUBLE) AS stddev") for name in ("archive", "recent")}
    return reduce(
        DataFrame.unionByName,
        [
            *rated.values(),
            kept["movie_stats"].selectExpr(
                "'movie_stats' AS output", "row_key AS key", "source", "avgRating AS mean", "totalVotes AS number", "round(stddev, 6) AS stddev"
            ),
            kept["source_stats"].selectExpr(
                "'source_stats' AS output", "source AS key", "source", "avgRating AS mean", "totalRatings AS number", "CAST(NULL AS DOUBLE) AS stddev"
            ),
        ],
    )


@check(
    f"""SELECT source, count(rating) AS totalRatings, {exact_mean('rating')} AS avgRating,
    count(DISTINCT movieId) AS uniqueMovies FROM unified_view GROUP BY source""",
    "unified",
)
def source_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 with exact distinct movies, in batch"""
    return stats.source_stats_exact(_unified_batch(spark, sf_dir), exact_scale=2)


@check("SELECT userId, movieId, rating, source, event_ts FROM unified_view", "unified")
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream archived as CSV and read back"""
    folder = shared_folder(spark, "archive")
    queries.start_archive(
        _unified_stream(spark, sf_dir), f"{folder}/raw-stream", f"{folder}/checkpoint", trigger=None
    ).awaitTermination()
    # An empty user of a line is still a text.
    return stored.read_csv(spark, f"{folder}/raw-stream", schemas.ARCHIVE)


@check(
    f"""SELECT movieId, source, {exact_mean('rating')} AS avgRating, count(rating) AS totalVotes
    FROM ({_MIXED_SQL}) GROUP BY movieId, source""",
    "mixed",
)
def live_mixed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream of both formats"""
    folder = shared_folder(spark, "live-mixed")
    mixed = normalise.from_mixed(views.mixed_texts(views.table_as_stream(spark, sf_dir, "lineitem")))
    running = stats.live_movie_stats(mixed, exact_scale=2)
    queries.start_snapshot(running, f"{folder}/result", f"{folder}/checkpoint", trigger=None).awaitTermination()
    return queries.read_snapshot(spark, f"{folder}/result")


# ---- cells ----------------------------------------------------------------------------------------------------------


def _cells_sql(view: str, key: str, values: dict[tuple[str, str], str], where: str = "TRUE") -> str:
    """One SELECT per cell of a row."""
    return " UNION ALL ".join(
        f"""SELECT {key} AS row_key, '{family}' AS family, '{name}' AS qualifier, CAST({value} AS VARCHAR) AS value,
        CAST({NOW_MS} AS BIGINT) AS version_ts FROM {view} WHERE ({where}) AND {value} IS NOT NULL"""
        for (family, name), value in values.items()
    )


@check(
    _cells_sql(
        "movie_stats_view",
        "concat(movieId, '_batch')",
        {
            ("ratings", "avgRating"): "avgRating",
            ("ratings", "totalVotes"): "totalVotes",
            ("info", "source"): "'batch'",
            ("info", "lastUpdated"): str(NOW_MS),
            ("info", "title"): "title",
        },
    ),
    "movie_stats",
)
def cells_movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8, C11, C12, F14, F15"""
    return cells.batch_stats_cells(_movie_stats(spark, sf_dir), NOW_MS).drop("put_id")


@check(
    _cells_sql(
        "genre_stats_view",
        "genre",
        {
            ("ratings", "avgRating"): "avgRating",
            ("ratings", "totalRatings"): "totalRatings",
            ("info", "lastUpdated"): str(NOW_MS),
        },
    ),
    "genre_stats",
)
def cells_genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.genre_stats_cells(_genre_stats(spark, sf_dir), NOW_MS).drop("put_id")


@check(
    _cells_sql(
        "lenient_view",
        "concat(movieId, '_', lpad(CAST(timestamp AS VARCHAR), 13, '0'))",
        {
            ("info", "userId"): "userId",
            ("info", "movieId"): "movieId",
            ("ratings", "rating"): "rating",
            ("meta", "source"): "'lines'",
            ("meta", "timestamp"): "timestamp",
        },
        "movieId IS NOT NULL AND timestamp IS NOT NULL",
    ),
    "lenient",
)
def cells_rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10, C5"""
    parsed = lines.lenient_ratings(views.rating_lines(spark, sf_dir))
    return cells.rating_event_cells(parsed.withColumn("source", F.lit("lines")), NOW_MS).drop("put_id")


# Times of a month are one, so that many events share movie and time, and with them the key.
_MONTH_SQL = "timestamp - timestamp % 2592000"


@check(
    f"""SELECT concat(movieId, '_', lpad(CAST({_MONTH_SQL} AS VARCHAR), 13, '0')) AS row_key, count(*) AS events, TRUE AS written
    FROM ratings_view GROUP BY ALL""",
    "ratings",
)
def cells_whole_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the same key stored as cells in two batches and read back; each row is one of the events put"""
    path = shared_folder(spark, "events")
    events = views.ratings(spark, sf_dir).selectExpr(
        "CAST(userId AS STRING) AS userId", "CAST(movieId AS STRING) AS movieId", "rating",
        "CASE WHEN userId % 3 = 0 THEN 'a' WHEN userId % 3 = 1 THEN 'b' END AS source", f"{_MONTH_SQL} AS timestamp",
    )
    for batch, part in enumerate((events.where("userId % 2 = 0"), events.where("userId % 2 = 1"))):
        write_cells(cells.rating_event_cells(part, NOW_MS), path, batch)
    rows = cells.rating_event_rows(read_cells(spark, path, NOW_MS), NOW_MS)
    key = F.concat("movieId", F.lit("_"), F.format_string("%013d", "timestamp"))
    # Dealt by key, events are where their group and the row to compare it with are.
    put = (
        events.withColumn("row_key", key).repartition("row_key").groupBy("row_key", "movieId", "timestamp")
        .agg(F.count("*").alias("events"), F.collect_set(F.struct("userId", "rating", "source")).alias("all"))
    )
    return put.join(rows.select("row_key", F.struct("userId", "rating", "source").alias("one")), "row_key", "left").select(
        "row_key", "events", F.exists("all", lambda event: event.eqNullSafe(F.col("one"))).alias("written")
    )


# Ten "milliseconds" per second of the ratings: their seven years become a month, of which a week is kept.
RETENTION_NOW_MS = 10_050_000_000


def _versioned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ratings(spark, sf_dir).selectExpr(
        "CAST(movieId AS STRING) AS row_key",
        "'ratings' AS family",
        "'rating' AS qualifier",
        "CAST(rating AS STRING) AS value",
        "timestamp * 10 AS version_ts",
    )


@check(
    f"""SELECT row_key, family, qualifier, value, version_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY version_ts DESC) AS rank FROM (
    SELECT CAST(movieId AS VARCHAR) AS row_key, 'ratings' AS family, 'rating' AS qualifier,
    max(CAST(rating AS VARCHAR)) AS value, timestamp * 10 AS version_ts FROM ratings_view
    WHERE timestamp * 10 > {RETENTION_NOW_MS - 7 * 86_400_000} GROUP BY ALL)) WHERE rank <= 5""",
    "ratings",
)
def cell_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, compacted, read back"""
    folder = shared_folder(spark, "retention")
    write_cells(_versioned_cells(spark, sf_dir), f"{folder}/cells", 0, 1, buckets=2)
    compact_cells(spark, f"{folder}/cells", f"{folder}/compacted", RETENTION_NOW_MS, buckets=2)
    return read_cells(spark, f"{folder}/compacted").select("row_key", "family", "qualifier", "value", "version_ts")


@check(
    f"""SELECT CAST(movieId AS VARCHAR) AS row_key, max(timestamp * 10) AS version_ts,
    max_by(CAST(rating AS VARCHAR), concat(lpad(CAST(timestamp * 10 AS VARCHAR), 20, '0'), CAST(rating AS VARCHAR))) AS value
    FROM ratings_view WHERE timestamp * 10 > {RETENTION_NOW_MS - 7 * 86_400_000} GROUP BY movieId""",
    "ratings",
)
def cells_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of cells merged into their days, expired days dropped; the latest versions are what they were"""
    path = shared_folder(spark, "days")
    versioned = _versioned_cells(spark, sf_dir)
    for batch in range(3):
        write_cells(versioned.where(F.pmod(F.xxhash64("row_key", "version_ts"), F.lit(3)) == batch), path, batch, 1, 2)
        if batch > 0:
            maintain_cells(spark, path, batch - 1, RETENTION_NOW_MS, buckets=2)
    maintain_cells(spark, path, 2, RETENTION_NOW_MS, buckets=2)
    return read_latest(spark, path, RETENTION_NOW_MS).select("row_key", "version_ts", "value")


@check(
    """SELECT CAST(movieId AS VARCHAR) AS row_key, 'ratings' AS family, 'rating' AS qualifier,
    max_by(CAST(rating AS VARCHAR), concat(lpad(CAST(timestamp * 10 AS VARCHAR), 20, '0'), CAST(rating AS VARCHAR)))
    AS value, max(timestamp * 10) AS version_ts FROM ratings_view GROUP BY movieId""",
    "ratings",
)
def cell_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: latest version per cell"""
    return cells.latest_cells(_versioned_cells(spark, sf_dir))


@check(
    """SELECT concat(movieId, '_batch') AS row_key, 'batch' AS source, avgRating, totalVotes
    FROM movie_stats_view WHERE movieId = 42""",
    "movie_stats",
)
def lookup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key of the stored cells of all movies"""
    folder = shared_folder(spark, "lookup")
    write_cells(cells.batch_stats_cells(_movie_stats(spark, sf_dir), NOW_MS), folder, 0)
    return cells.lookup_stats(read_cells(spark, folder), "42_batch", NOW_MS)


@check(
    f"""SELECT movieId, {round2('avg(rating)')} AS avgRating, count(rating) AS totalVotes,
    round(stddev_samp(rating), 6) AS stddev FROM ratings_view GROUP BY movieId""",
    "ratings",
)
def stats_with_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11; K9 stores it"""
    return stats.stats_with_stddev(views.ratings(spark, sf_dir), "movieId").withColumn("stddev", F.round("stddev", 6))


_ALERTS_SQL = f"""SELECT movieId, 'extreme_ratings' AS alertType, count(rating) AS total,
    count(*) FILTER (WHERE rating <= 1 OR rating >= 5) AS extremeCount, {round2('avg(rating)')} AS avgRating
    FROM ratings_view GROUP BY movieId HAVING count(*) FILTER (WHERE rating <= 1 OR rating >= 5) >= 0.4 * count(rating)"""


@check(_ALERTS_SQL, "ratings")
def rating_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12"""
    return stats.rating_alerts(views.ratings(spark, sf_dir), min_share=0.4)


@check(
    _cells_sql(
        f"({_ALERTS_SQL})",
        f"concat(movieId, '_', '{NOW_MS}')",
        {
            ("info", "movieId"): "movieId",
            ("info", "alertType"): "alertType",
            ("meta", "total"): "total",
            ("meta", "extremeCount"): "extremeCount",
            ("meta", "avgRating"): "avgRating",
        },
    ),
    "ratings",
)
def cells_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K11"""
    return cells.alert_cells(rating_alerts(spark, sf_dir), NOW_MS).drop("put_id")


# ---- pages ----------------------------------------------------------------------------------------------------------

# A link is a user if one path segment is left once a slash at either end is gone.
_USER_SQL = "regexp_replace(regexp_replace(link, '^/', ''), '/$', '')"


@check(
    f"""SELECT page_id, {_USER_SQL} AS userId FROM links_view
    WHERE {_USER_SQL} <> '' AND NOT contains({_USER_SQL}, '/')""",
    "links",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10, C8"""
    return pages.page_links(views.table(spark, sf_dir, "pages"), "page_id")


# Stated from the links and their numbers, not by reading the pages that were made from them.
@check(
    f"""SELECT userId, movieId, raw / 2.0 AS rating, raw AS ratingRaw FROM (
    SELECT {_USER_SQL} AS userId, page_id AS movieId, CAST(CASE (i + page_id) % 7 WHEN 0 THEN NULL WHEN 1 THEN 7
    WHEN 2 THEN NULL ELSE (i * 3 + page_id) % 10 + 1 END AS INTEGER) AS raw
    FROM links_view l WHERE page_id % 3 = 0 OR i % 4 <> 0
    OR NOT EXISTS (SELECT 1 FROM links_view o WHERE o.page_id = l.page_id AND o.i % 4 <> 0))
    WHERE raw IS NOT NULL AND userId <> '' AND NOT contains(userId, '/')""",
    "links",
)
def page_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9, F10, F11, C8, C9, C10"""
    return pages.page_ratings(views.rated_pages(spark, sf_dir))


# ---- serving --------------------------------------------------------------------------------------------------------


@check("SELECT * FROM recent_view", "recent")
def recent_per_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1"""
    return ranking.recent_per_movie(views.stream_events(spark, sf_dir))


@check(
    """SELECT userId, movieId, rating, source, event_ts FROM (SELECT *, row_number() OVER (PARTITION BY movieId
    ORDER BY event_ts DESC NULLS LAST, userId, rating, source) AS rank FROM unified_view) WHERE rank <= 15""",
    "unified",
)
def live_recent_per_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 kept current on a stream"""
    folder = shared_folder(spark, "live-recent")
    queries.start_recent(
        _unified_stream(spark, sf_dir), f"{folder}/result", f"{folder}/checkpoint", trigger=None
    ).awaitTermination()
    return queries.read_recent(spark, f"{folder}/result")


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.shuffled_sample(recent_per_movie(spark, sf_dir))


@check("SELECT * FROM sample_view", "sample")
def recent_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6, C17"""
    return _sample(spark, sf_dir)


@check(
    "SELECT * FROM sample_view ORDER BY event_ts DESC, userId, rating, source, movieId LIMIT 30",
    "sample",
)
def recent_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O7"""
    return ranking.recent_feed(_sample(spark, sf_dir))


@check(f"SELECT movieId, {round2('avg(rating)')} AS avgRating FROM sample_view GROUP BY movieId", "sample")
def live_sample_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, F13"""
    return ranking.sample_means(_sample(spark, sf_dir))


_ANY_IDS = """SELECT userId, rating, CASE userId % 6 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN concat('great-item-', movieId)
    WHEN 4 THEN CAST(movieId + 100000000 AS {text}) ELSE CAST(movieId AS {text}) END AS movieId FROM {ratings}"""


@check(
    f"""SELECT userId, rating, r.movieId, CASE WHEN r.movieId IS NULL OR r.movieId = '' THEN '—'
    WHEN r.movieId LIKE 'great%' THEN concat('Great Item ', split_part(r.movieId, '-', 3))
    ELSE coalesce(m.title, concat('#', r.movieId)) END AS displayName
    FROM ({_ANY_IDS.format(text='VARCHAR', ratings='ratings_view')}) r
    LEFT JOIN movies_view m ON r.movieId = CAST(m.movieId AS VARCHAR)""",
    "ratings",
    "movies",
)
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3, C14, C16"""
    rows = spark.sql(_ANY_IDS.format(text="STRING", ratings="{rated}"), rated=views.ratings(spark, sf_dir))
    return display.with_display_name(rows, display.movie_map(views.movies(spark, sf_dir)))


@check(
    """SELECT userId, s.movieId, event_ts, coalesce(m.title, concat('#', s.movieId)) AS displayName
    FROM sample_view s LEFT JOIN movies_view m ON s.movieId = CAST(m.movieId AS VARCHAR)""",
    "sample",
    "movies",
)
def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 for a bounded sample: only the titles of its movies are looked up"""
    named = display.with_few_display_names(_sample(spark, sf_dir), views.movies(spark, sf_dir))
    return named.select("userId", "movieId", "event_ts", "displayName")


@check(
    """SELECT movieId, avgRating, CAST(floor(avgRating) AS INTEGER) AS full_stars,
    CASE WHEN avgRating < 5 AND avgRating - floor(avgRating) >= 0.5 THEN 1 ELSE 0 END AS half_star,
    CAST(5 - floor(avgRating) AS INTEGER)
        - CASE WHEN avgRating < 5 AND avgRating - floor(avgRating) >= 0.5 THEN 1 ELSE 0 END AS empty_stars
    FROM movie_stats_view""",
    "movie_stats",
)
def star_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9"""
    return display.with_stars(_movie_stats(spark, sf_dir).select("movieId", "avgRating"), "avgRating")


@check(
    """SELECT userId, movieId, rating, CASE WHEN rating >= 4 THEN 'high' WHEN rating >= 3 THEN 'mid' ELSE 'low' END
    AS band FROM lenient_view""",
    "lenient",
)
def rating_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10"""
    parsed = lines.lenient_ratings(views.rating_lines(spark, sf_dir))
    return display.with_band(parsed.select("userId", "movieId", "rating"))


@check(
    f"""SELECT 'mapreduce' AS dataset, TRUE AS available, count(*) AS row_count FROM strict_means_view UNION ALL
    SELECT 'spark_batch', TRUE, count(*) FROM (SELECT 1 FROM movie_stats_view WHERE totalVotes >= {MIN_VOTES} LIMIT 10)
    UNION ALL SELECT 'streaming', FALSE, 0""",
    "strict_means",
    "movie_stats",
)
def dataset_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs written, the third not yet"""
    folder = shared_folder(spark, "status")
    write_strict_means(stats.strict_mean_lines(strict_movie_average(spark, sf_dir)), f"{folder}/strict-means")
    write_csv(top_movies(spark, sf_dir), f"{folder}/top10")
    return stored.availability(
        spark,
        {
            "mapreduce": (f"{folder}/strict-means", "text"),
            "spark_batch": (f"{folder}/top10", "csv"),
            "streaming": (f"{folder}/raw-stream", "csv"),
        },
    )
