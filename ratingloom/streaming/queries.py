"""Starting streaming queries.

Every query has a checkpoint, and every sink survives the repetition of a micro-batch: the archive through the file
sink's log, all others because a batch replaces its own output. `trigger=None` runs over what is there now and
stops; otherwise it is an interval such as "5 seconds". `partitions` is the number of state partitions of a stateful query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ratingloom import schemas
from ratingloom.fixed_values import (
    ARCHIVE_TRIGGER,
    CELL_TRIGGER,
    CONSOLE_ROWS,
    MOVIE_STATS_TRIGGER,
    RECENT_PER_MOVIE,
    SOURCE_STATS_TRIGGER,
)
from ratingloom.operators import partials
from ratingloom.operators.cells import live_stats_cells
from ratingloom.operators.ranking import recent_per_movie
from ratingloom.session import remove_folder
from ratingloom.sinks.archive import hour_of
from ratingloom.sinks.batches import MergedTable, batch_folder, complete_batches
from ratingloom.sinks.cells import write_cells
from ratingloom.sinks.csv import CSV_OPTIONS, on_one_line
from ratingloom.streaming.state import state_partitions

# Results of so many batches stay, for readers that are slower than an interval.
KEPT_RESULTS = 3
# Parts of a merged table are folded together after so many batches.
FOLD_EVERY = 60


def _writer(rows: DataFrame, name: str, mode: str, checkpoint: str, trigger: str | None) -> DataStreamWriter:
    writer = rows.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def _started(writer: DataStreamWriter, rows: DataFrame, partitions: int | None) -> StreamingQuery:
    with state_partitions(rows.sparkSession, partitions):
        return writer.start()


# ---- one read, several sinks ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sink:
    """What is done with the rows of a micro-batch; doing it again must leave things as they were."""

    name: str
    write: Callable[[DataFrame, int], None]


def start_fan_out(
    rows: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    name: str,
    trigger: str | None,
    mode: str = "append",
    partitions: int | None = None,
) -> StreamingQuery:
    """One read of the source for several sinks, which get the rows of each micro-batch in turn.

    The rows are computed once and kept on the executors' disks while the sinks run; what is lost with an executor is computed again.
    A sink that fails fails the batch, which is then repeated for all of them.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            for sink in sinks:
                sink.write(batch, batch_id)
        finally:
            batch.unpersist()

    return _started(_writer(rows, name, mode, checkpoint, trigger).foreachBatch(write_batch), rows, partitions)


def with_time(rows: DataFrame) -> DataFrame:
    """The rows with `seen`, the time of their micro-batch; a batch that is repeated has the same time again."""
    return rows.withColumn("seen", F.current_timestamp())


def running_statistics(unified: DataFrame) -> DataFrame:
    """A5, A11 with K9's columns: movieId, source, avgRating, totalVotes, stddev, and when a rating was last seen.

    On a stream, the state of a pair is some sums.
    """
    moments = partials.movie_moments(with_time(unified), F.max("seen").alias("seen"))
    return partials.movie_stats(moments, "seen")


def console_sink(rows: int = CONSOLE_ROWS) -> Sink:
    """K4: the first `rows` of complete statistics."""

    def show(result: DataFrame, batch_id: int) -> None:
        # Ordered, so that every state partition is computed and saved, but only the rows shown leave the tasks.
        print(f"Batch: {batch_id}")
        result.drop("seen").orderBy("movieId", "source").show(rows, truncate=False)

    return Sink("console", show)


def cell_sink(path: str, after: Callable[[SparkSession, int, int], None] | None = None) -> Sink:
    """K7, K9: the complete statistics of the pairs that this batch has ratings of, as cells.

    The version is the time of the batch, so a repeated batch writes the same cells. `after` is called with the batch
    and its time when they are written.
    """

    def write(result: DataFrame, batch_id: int) -> None:
        now = result.agg(F.max(F.unix_millis("seen"))).first()[0]
        if now is not None:
            # One put a key.
            write_cells(live_stats_cells(result.where(F.unix_millis("seen") == now), now), path, batch_id, split=1)
            if after is not None:
                after(result.sparkSession, batch_id, now)

    return Sink("cells", write)


def recent_table(spark: SparkSession, path: str, n: int = RECENT_PER_MOVIE) -> MergedTable:
    """W1 kept current: the tails of the movies of each batch, cut to `n` again when they are read or folded."""
    return MergedTable(spark, path, schemas.ARCHIVE, lambda parts: recent_per_movie(parts, n))


def recent_sink(path: str, n: int = RECENT_PER_MOVIE, fold_every: int = FOLD_EVERY) -> Sink:
    """A batch writes the tails of its own movies, so its cost does not grow with the number of movies or the archive."""

    def write(new: DataFrame, batch_id: int) -> None:
        table = recent_table(new.sparkSession, path, n)
        table.update(recent_per_movie(new, n).select(*schemas.ARCHIVE_COLUMNS), batch_id, fold_every)

    return Sink("recent", write)


def read_recent(spark: SparkSession, path: str, n: int = RECENT_PER_MOVIE) -> DataFrame:
    return recent_table(spark, path, n).read()


def source_table(spark: SparkSession, path: str) -> MergedTable:
    """A6 kept current: votes, sums and a sketch of the movies per source and batch."""
    return MergedTable(spark, path, partials.SOURCE_PARTS, partials.merged_sources)


def source_sink(path: str, fold_every: int = FOLD_EVERY, show: bool = False) -> Sink:
    """A row per source and batch; shown merged with all before, if asked for."""

    def write(new: DataFrame, batch_id: int) -> None:
        table = source_table(new.sparkSession, path)
        table.update(partials.source_parts(new), batch_id, fold_every)
        if show:
            print(f"Batch: {batch_id}")
            partials.source_stats(table.read(batch_id)).orderBy("source").show(truncate=False)

    return Sink("sources", write)


def read_source_stats(spark: SparkSession, path: str) -> DataFrame:
    return partials.source_stats(source_table(spark, path).read())


# ---- single queries -------------------------------------------------------------------------------------------------


def start_movie_stats_console(
    stats: DataFrame,
    checkpoint: str,
    trigger: str | None = MOVIE_STATS_TRIGGER,
    name: str = "movie_stats_shown",
    rows: int = CONSOLE_ROWS,
    partitions: int | None = None,
) -> StreamingQuery:
    """The running stats per movie and source on the console."""
    sink = console_sink(rows)
    return _started(_writer(stats, name, "complete", checkpoint, trigger).foreachBatch(sink.write), stats, partitions)


def start_source_stats_console(
    stats: DataFrame,
    checkpoint: str,
    trigger: str | None = SOURCE_STATS_TRIGGER,
    name: str = "source_stats_shown",
    partitions: int | None = None,
) -> StreamingQuery:
    """K5: the running stats per source on the console."""
    writer = _writer(stats, name, "complete", checkpoint, trigger).format("console").option("truncate", "false")
    return _started(writer, stats, partitions)


def start_archive(
    unified: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = ARCHIVE_TRIGGER,
    name: str = "archive",
    retention: str | None = None,
    hourly: bool = False,
) -> StreamingQuery:
    """Append the normalised ratings as CSV, one line each: line breaks in texts are written as `\\n` and `\\r`.

    `hourly` puts what is written in the same hour into one folder. With a `retention`, such as "30d", the sink's log
    forgets files that are older, so that neither it nor what readers find grows for ever; the files stay until
    `ratingloom.sinks.archive.drop_hours` removes them.
    """
    texts = [field.name for field in unified.schema.fields if field.dataType.simpleString() == "string"]
    escaped = {name: on_one_line(F.col(name)) for name in texts}
    rows = unified.withColumns(escaped) if escaped else unified
    if hourly:
        rows = rows.withColumn("hour", hour_of(F.current_timestamp()))
    writer = _writer(rows, name, "append", checkpoint, trigger).format("csv").options(**CSV_OPTIONS)
    if hourly:
        writer = writer.partitionBy("hour")
    if retention is not None:
        writer = writer.option("retention", retention)
    return writer.start(path)


def start_cell_upsert(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = CELL_TRIGGER,
    name: str = "cell_writer",
    now_ms: int | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """The stats that changed, as cells; one distributed write per micro-batch, which fails as a whole."""

    def write_batch(changed: DataFrame, batch_id: int) -> None:
        write_cells(live_stats_cells(changed, now_ms), path, batch_id, split=1)

    return _started(_writer(stats, name, "update", checkpoint, trigger).foreachBatch(write_batch), stats, partitions)


def start_snapshot(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = MOVIE_STATS_TRIGGER,
    name: str = "snapshot",
    partitions: int | None = None,
) -> StreamingQuery:
    """T3 into a table: the whole result after each micro-batch, in a folder of its own.

    Older ones are removed some batches later, as readers may have them open.
    """

    def write_batch(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(batch_folder(path, batch_id))
        spark = result.sparkSession
        for number in complete_batches(spark, path):
            if number <= batch_id - KEPT_RESULTS:
                remove_folder(spark, batch_folder(path, number))

    return _started(_writer(stats, name, "complete", checkpoint, trigger).foreachBatch(write_batch), stats, partitions)


def start_recent(
    unified: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = ARCHIVE_TRIGGER,
    name: str = "recent",
    n: int = RECENT_PER_MOVIE,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """W1 kept current, by `recent_sink` alone; `read_recent` reads it."""
    sink = recent_sink(path, n, fold_every)
    return _writer(unified, name, "append", checkpoint, trigger).foreachBatch(sink.write).start()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The latest whole result of `start_snapshot`; it stays readable for `KEPT_RESULTS` batches."""
    complete = complete_batches(spark, path)
    if not complete:
        raise ValueError(f"no complete result in {path}")
    return spark.read.parquet(batch_folder(path, complete[-1]))
