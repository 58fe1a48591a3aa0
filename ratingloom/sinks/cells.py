"""Storing keyed cells by day of version and bucket of key.

    <table>/level=new/batch_id=N/day=D/bucket=B    what a batch wrote
    <table>/level=old/batch_id=N/day=D/bucket=B    the cells of day D up to batch N, cut to the versions to keep

Days and buckets are partitions, so a reader with a time to live skips days, and a lookup opens the files of one bucket.
Within a file cells are sorted by key, with a bloom filter on it. Cells that are present twice count once, so it does not
matter whether a batch that has been merged into its day is still there: merging a day is a write, followed by removals. Days past their time
to live are removed as folders, without reading them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.fixed_values import CELL_TIME_TO_LIVE_MS
from ratingloom.operators.cells import CELL_BUCKETS, cell_bucket, first_day, latest_cells, retained_cells, unexpired, version_day
from ratingloom.session import folder_bytes, remove_folder, setting, shared_folder
from ratingloom.sinks.batches import batch_folder, numbered


FILE_BYTES = 128 << 20
# What a task shuffles in to sort and write; cells are compressed there and take 10 to 20 times as much in memory.
SORTED_BYTES = 16 << 20
# What a task reads of stored cells to sort, whatever the size of the table; a small file counts as OPENED_BYTES more than it has.
READ_BYTES = 4 << 20
OPENED_BYTES = 256 << 10


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Tasks that read stored cells are cut by READ_BYTES inside, as aggregates of cells sort all that a task has read."""
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(READ_BYTES)):
        with setting(spark, "spark.sql.files.openCostInBytes", str(OPENED_BYTES)):
            yield


def _level(path: str, level: str) -> str:
    return f"{path}/level={level}"


def _write(cells: DataFrame, folder: str, split: int, buckets: int) -> None:
    names = [name for name in schemas.CELL_COLUMNS if name in cells.columns]
    day, bucket = version_day(F.col("version_ts")), cell_bucket(F.col("row_key"), buckets)
    # The cells of a put stay together, so that in shuffle and file its key and identity are next to their copies.
    put = [name for name in ("row_key", "version_ts", "put_id") if name in names]
    part = F.pmod(F.xxhash64(*put), F.lit(split)).alias("part")
    placed = cells.select(*names, day.alias("day"), bucket.alias("bucket"), part)
    sorted_cells = (
        placed.hint("rebalance", "day", "bucket", "part")
        .sortWithinPartitions("day", "bucket", "row_key", "family", "qualifier")
        .drop("part")
    )
    # Unlike repartition, rebalance also cuts what is larger than the advised size, so no task sorts a whole bucket.
    with setting(cells.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SORTED_BYTES)):
        (
            sorted_cells.write.mode("overwrite")
            .partitionBy("day", "bucket")
            .option("parquet.bloom.filter.enabled#row_key", "true")
            .parquet(folder)
        )


def write_cells(cells: DataFrame, path: str, batch_id: int, split: int = 4, buckets: int = CELL_BUCKETS) -> None:
    """Replace the cells of one batch. Running a batch again therefore leaves the table as it was.

    A bucket of a day is dealt out to `split` tasks, so that a key with very many versions does not land in one; where keys
    have few versions, 1 makes fewer files. Adaptive execution cuts tasks over `SORTED_BYTES` further. All writers and readers
    of a table agree on `buckets`.
    """
    _write(cells, batch_folder(_level(path, "new"), batch_id), split, buckets)


def read_cells(spark: SparkSession, path: str, now_ms: int | None = None) -> DataFrame:
    """The cells of a table with `day` and `bucket`; with `now_ms`, without the days past their time to live."""
    cells = spark.read.schema(schemas.CELLS).parquet(path).drop("level")
    return cells if now_ms is None else cells.where(F.col("day") >= first_day(now_ms))


def read_latest(spark: SparkSession, path: str, now_ms: int | None = None) -> DataFrame:
    """K7: the latest version of every cell of a table, as a table in the shared folder made by tasks of bounded size."""
    kept = shared_folder(spark, "latest")
    latest = latest_cells(unexpired(read_cells(spark, path, now_ms), now_ms))
    with small_scans(spark):
        latest.write.parquet(kept)
    return spark.read.schema(latest.schema).parquet(kept)


def compact_cells(spark: SparkSession, source: str, target: str, now_ms: int, buckets: int = CELL_BUCKETS) -> None:
    """Write the retained cells of `source` to `target` as its only batch."""
    with small_scans(spark):
        write_cells(retained_cells(read_cells(spark, source, now_ms), now_ms), target, 0, 1, buckets)


def maintain_cells(
    spark: SparkSession,
    path: str,
    batch_id: int,
    now_ms: int,
    time_to_live_ms: int = CELL_TIME_TO_LIVE_MS,
    buckets: int = CELL_BUCKETS,
) -> None:
    """Merge the batches up to `batch_id` into their days, and remove the days past their time to live.

    Reads and writes the days those batches have cells of, and no others, in files of at most about `FILE_BYTES`. If it is cut
    off, running it again, or later with another batch, ends the work.
    """
    new, old = _level(path, "new"), _level(path, "old")
    first = first_day(now_ms, time_to_live_ms)
    merged = [number for number in numbered(spark, new, "batch_id") if number <= batch_id]
    days = {day for number in merged for day in numbered(spark, batch_folder(new, number), "day")}
    kept = sorted(day for day in days if day >= first)
    if kept:
        folders = [batch_folder(new, number) for number in merged]
        folders += [batch_folder(old, number) for number in numbered(spark, old, "batch_id") if number <= batch_id]
        size = sum(folder_bytes(spark, f"{folder}/day={day}") for folder in folders for day in kept)
        cells = spark.read.schema(schemas.CELLS).parquet(path).where(F.col("day").isin(kept) & (F.col("batch_id") <= batch_id))
        retained = retained_cells(cells, now_ms, time_to_live_ms=time_to_live_ms)
        with small_scans(spark):
            _write(retained, batch_folder(old, batch_id), 1 + size // (buckets * FILE_BYTES), buckets)
    for number in merged:
        remove_folder(spark, batch_folder(new, number))
    for number in numbered(spark, old, "batch_id"):
        folder = batch_folder(old, number)
        found = numbered(spark, folder, "day")
        gone = [day for day in found if day < first or (number < batch_id and day in days)]
        for day in gone:
            remove_folder(spark, f"{folder}/day={day}")
        if len(gone) == len(found):
            remove_folder(spark, folder)
