"""Keyed cells: rows to cells and back, latest values, retention.

A cell is (row_key, family, qualifier, value, version_ts, put_id); all values are text. Writers only ever add cells. Readers
take the latest version of each, so no write has to read first, and a write that is repeated changes nothing.

All cells that come from one row are a put and carry its `put_id`, a digest of the key, the version and all values. Between
puts of the same version it decides, the same way for each cell, so two puts never mix where both have the same cells; and
`whole_rows` leaves out what other puts have written to a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.fixed_values import BATCH_SOURCE, CELL_FAMILIES, CELL_TIME_TO_LIVE_MS, MAX_CELL_VERSIONS
from ratingloom.functions.keys import clock_ms, event_key, joined_key

CELL_KEY = ("row_key", "family", "qualifier")
CELL_BUCKETS = 8
DAY_MS = 86_400_000


def version_day(version_ts: Column) -> Column:
    """Days since the epoch, by which cells are stored."""
    return F.floor(version_ts / DAY_MS).cast("bigint")


def first_day(now_ms: int, time_to_live_ms: int = CELL_TIME_TO_LIVE_MS) -> int:
    """The first day that may hold cells within their time to live."""
    return (now_ms - time_to_live_ms) // DAY_MS


def cell_bucket(row_key: Column, buckets: int = CELL_BUCKETS) -> Column:
    """The bucket that the cells of a key are stored in."""
    return F.pmod(F.xxhash64(row_key), F.lit(buckets)).cast("int")


def to_cells(
    rows: DataFrame, table: str, row_key: Column, values: dict[tuple[str, str], Column], version_ts: Column
) -> DataFrame:
    """One cell per row and value; NULL values make no cell and rows without a key no cells.

    Equal rows are the same put.
    """
    undeclared = {family for family, _ in values} - set(CELL_FAMILIES[table])
    if undeclared:
        raise ValueError(f"table {table} has no families {sorted(undeclared)}")
    names = [f"value_{position}" for position in range(len(values))]
    keyed = rows.select(
        row_key.alias("row_key"),
        version_ts.alias("version_ts"),
        *[value.cast("string").alias(name) for name, value in zip(names, values.values())],
    )
    # NULLs are skipped by the digest, so each value is preceded by its place.
    placed = [part for k, name in enumerate(names) for part in (F.when(F.col(name).isNotNull(), F.lit(k)), F.col(name))]
    put_id = F.xxhash64("row_key", "version_ts", *placed)
    # Behind a generator, so that the digest is not computed again for every cell.
    keyed = keyed.select("row_key", "version_ts", *names, F.explode(F.array(put_id)).alias("put_id"))
    # Keys are part of the generated rows, so the filter on them stays above and computes nothing again.
    entries = [
        F.struct(
            "row_key",
            F.lit(family).alias("family"),
            F.lit(qualifier).alias("qualifier"),
            F.col(name).alias("value"),
            "version_ts",
            "put_id",
        )
        for name, (family, qualifier) in zip(names, values)
    ]
    return keyed.select(F.inline(F.array(*entries))).where(F.col("row_key").isNotNull() & F.col("value").isNotNull())


def _usable_movie(movie: Column) -> Column:
    """neither missing nor the text `null`."""
    return F.when(movie.cast("string") != "null", movie.cast("string"))


def live_stats_cells(stats: DataFrame, now_ms: int | None = None) -> DataFrame:
    """K7, K9: cells of movieId, source, avgRating, totalVotes and, where there, stddev."""
    now = clock_ms(now_ms)
    values = {
        ("ratings", "avgRating"): F.col("avgRating"),
        ("ratings", "totalVotes"): F.col("totalVotes"),
        ("info", "source"): F.col("source"),
        ("info", "lastUpdated"): now,
    }
    if "stddev" in stats.columns:
        values["ratings", "stddev"] = F.col("stddev")
    key = joined_key(_usable_movie(F.col("movieId")), F.coalesce("source", F.lit("null")))
    return to_cells(stats, "movie_stats", key, values, now)


def batch_stats_cells(stats: DataFrame, now_ms: int | None = None, source: str | Column = BATCH_SOURCE) -> DataFrame:
    """K8, K9: cells of movieId, avgRating, totalVotes and, where there, title and stddev.

    `source` is one source of all rows, or a column with that of each.
    """
    now = clock_ms(now_ms)
    source = source if isinstance(source, Column) else F.lit(source)
    optional = {("info", "title"): "title", ("ratings", "stddev"): "stddev"}
    values = {
        ("ratings", "avgRating"): F.col("avgRating"),
        ("ratings", "totalVotes"): F.col("totalVotes"),
        ("info", "source"): source,
        ("info", "lastUpdated"): now,
        **{cell: F.col(name) for cell, name in optional.items() if name in stats.columns},
    }
    key = joined_key(_usable_movie(F.col("movieId")), F.coalesce(source, F.lit("null")))
    return to_cells(stats, "movie_stats", key, values, now)


def genre_stats_cells(stats: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Cells of genre, avgRating, totalRatings in the table declared for them."""
    now = clock_ms(now_ms)
    values = {
        ("ratings", "avgRating"): F.col("avgRating"),
        ("ratings", "totalRatings"): F.col("totalRatings"),
        ("info", "lastUpdated"): now,
    }
    return to_cells(stats, "genre_stats", F.col("genre"), values, now)


def rating_event_cells(ratings: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Cells of userId, movieId, rating, source, timestamp, keyed by movie and time."""
    values = {
        ("info", "userId"): F.col("userId"),
        ("info", "movieId"): F.col("movieId"),
        ("ratings", "rating"): F.col("rating"),
        ("meta", "source"): F.col("source"),
        ("meta", "timestamp"): F.col("timestamp"),
    }
    key = event_key(_usable_movie(F.col("movieId")), F.col("timestamp"))
    return to_cells(ratings, "real_time_ratings", key, values, clock_ms(now_ms))


def alert_cells(alerts: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Cells of movieId, alertType, total, extremeCount, avgRating, keyed by movie and the time of writing."""
    now = clock_ms(now_ms)
    values = {
        ("info", "movieId"): F.col("movieId"),
        ("info", "alertType"): F.col("alertType"),
        ("meta", "total"): F.col("total"),
        ("meta", "extremeCount"): F.col("extremeCount"),
        ("meta", "avgRating"): F.col("avgRating"),
    }
    key = joined_key(_usable_movie(F.col("movieId")), now.cast("string"))
    return to_cells(alerts, "rating_alerts", key, values, now)


def _version(cells: DataFrame) -> list[str]:
    """What decides between cells: the later version, then the later batch, then the identity of the put."""
    return ["version_ts", *[name for name in ("batch_id", "put_id") if name in cells.columns]]


def _latest(cells: DataFrame) -> Column:
    """The version and value of a cell as a struct whose order is that of the versions."""
    return F.struct(*_version(cells), "value")


def latest_cells(cells: DataFrame) -> DataFrame:
    """One row per cell: its latest value. A plain aggregate, so versions are combined before the shuffle."""
    return (
        cells.groupBy(*CELL_KEY)
        .agg(F.max(_latest(cells)).alias("latest"))
        .select(*CELL_KEY, "latest.value", "latest.version_ts")
    )


def rows_from_cells(cells: DataFrame, columns: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Latest values as columns: {column: (family, qualifier, type)} per row_key, in one aggregation.

    A cell that the latest put of a row lacks keeps the value of an earlier one.
    """
    picked, values = _picked(cells, columns)
    return picked.select("row_key", *[F.col(f"{name}.value").cast(kind).alias(name) for name, kind in values])


def whole_rows(cells: DataFrame, columns: dict[str, tuple[str, str, str]]) -> DataFrame:
    """The latest put of each row as columns, and nothing of any other: {column: (family, qualifier, type)} per row_key."""
    picked, values = _picked(cells, columns)
    version = lambda at: F.struct(*[F.col(f"{at}.{part}") for part in _version(cells)])
    same = lambda name: version(name).eqNullSafe(version("last"))
    names = [F.col(name) for name, _ in values]
    picked = picked.withColumn("last", F.greatest(*names) if len(names) > 1 else names[0])
    return picked.select("row_key", *[F.when(same(name), F.col(f"{name}.value")).cast(kind).alias(name) for name, kind in values])


def _picked(cells: DataFrame, columns: dict[str, tuple[str, str, str]]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Per row_key, the latest version with its value of every column.

    The aggregate sorts what it reads, so a cell comes to it with the number of its column in place of family and qualifier.
    """
    wanted = list(dict.fromkeys((family, qualifier) for family, qualifier, _ in columns.values()))
    conditions = [(F.col("family") == family) & (F.col("qualifier") == qualifier) for family, qualifier in wanted]
    any_wanted = F.lit(False)
    for condition in conditions:
        any_wanted = any_wanted | condition
    place = F.coalesce(*[F.when(condition, F.lit(k)) for k, condition in enumerate(conditions)]).alias("place")
    latest = _latest(cells)
    picked = (
        cells.where(any_wanted)
        .select("row_key", *_version(cells), "value", place)
        .groupBy("row_key")
        .agg(*[F.max(F.when(F.col("place") == wanted.index(of[:2]), latest)).alias(name) for name, of in columns.items()])
    )
    return picked, [(name, kind) for name, (_, _, kind) in columns.items()]


def unexpired(cells: DataFrame, now_ms: int | None, time_to_live_ms: int = CELL_TIME_TO_LIVE_MS) -> DataFrame:
    """The cells younger than `time_to_live_ms`; all without a `now_ms`."""
    if now_ms is None:
        return cells
    if "day" in cells.columns:
        cells = cells.where(F.col("day") >= first_day(now_ms, time_to_live_ms))
    return cells.where(F.col("version_ts") > now_ms - time_to_live_ms)


def movie_stats_rows(cells: DataFrame, now_ms: int | None = None, with_stddev: bool = False) -> DataFrame:
    """The movie_stats cells as row_key, source, avgRating, totalVotes; with `now_ms`, without what is past its time to live."""
    return rows_from_cells(
        unexpired(cells, now_ms),
        {
            "source": ("info", "source", "string"),
            "avgRating": ("ratings", "avgRating", "double"),
            "totalVotes": ("ratings", "totalVotes", "bigint"),
            **({"stddev": ("ratings", "stddev", "double")} if with_stddev else {}),
        },
    )


def rating_event_rows(cells: DataFrame, now_ms: int | None = None) -> DataFrame:
    """The real_time_ratings cells as the events that were put: row_key, userId, movieId, rating, source, timestamp."""
    return whole_rows(
        unexpired(cells, now_ms),
        {
            "userId": ("info", "userId", "string"),
            "movieId": ("info", "movieId", "string"),
            "rating": ("ratings", "rating", "double"),
            "source": ("meta", "source", "string"),
            "timestamp": ("meta", "timestamp", "bigint"),
        },
    )


def cells_of_key(cells: DataFrame, row_key: str, buckets: int = CELL_BUCKETS) -> DataFrame:
    """The cells of one key. In a stored table these are the files of one bucket."""
    found = cells.where(F.col("row_key") == row_key)
    return found.where(F.col("bucket") == cell_bucket(F.lit(row_key), buckets)) if "bucket" in cells.columns else found


def lookup_stats(
    cells: DataFrame, row_key: str, now_ms: int | None = None, buckets: int = CELL_BUCKETS
) -> DataFrame:
    """The stats under one key, or no row. Bucket, day and key are filters of the scan; so is, with `now_ms`, the time
    to live."""
    return movie_stats_rows(cells_of_key(unexpired(cells, now_ms), row_key, buckets), now_ms)


def retained_cells(
    cells: DataFrame,
    now_ms: int,
    max_versions: int = MAX_CELL_VERSIONS,
    time_to_live_ms: int = CELL_TIME_TO_LIVE_MS,
) -> DataFrame:
    """At most `max_versions` latest versions per cell, none older than `time_to_live_ms`.

    Writes of the same version count as one, the last write winning. That step is an aggregate, and the rank limit
    stands directly on the window, so both cut a cell with many versions down before its rows are shuffled.
    """
    versions = (
        cells.where(F.col("version_ts") > now_ms - time_to_live_ms)
        .groupBy(*CELL_KEY, "version_ts")
        .agg(F.max(_latest(cells)).alias("last"))
        .select(*CELL_KEY, "last.value", "version_ts", *[f"last.{name}" for name in ("put_id",) if name in cells.columns])
    )
    newest_first = Window.partitionBy(*CELL_KEY).orderBy(F.desc("version_ts"))
    return (
        versions.withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") <= max_versions)
        .drop("rank")
    )
