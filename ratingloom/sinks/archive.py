"""The archive of ratings as CSV in hourly folders, which are dropped as a whole (K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.session import remove_folder
from ratingloom.sinks.batches import numbered
from ratingloom.sinks.csv import CSV_OPTIONS, CSV_READ_OPTIONS, on_one_line

HOUR_MS = 3_600_000


def hour_of(time: Column) -> Column:
    """Hours since the epoch, in whatever time zone the session is."""
    return F.floor(F.unix_millis(time) / HOUR_MS).cast("bigint")


def write_archive(rows: DataFrame, path: str, batch_id: int) -> None:
    """The ratings of a batch, by the hour of `seen`; a batch that is repeated replaces its own files and no others."""
    fields = schemas.ARCHIVE_COLUMNS
    texts = {name: on_one_line(F.col(name)) for name in ("userId", "movieId", "source")}
    placed = rows.select(*fields, hour_of(F.col("seen")).alias("hour"), F.lit(batch_id).alias("batch_id")).withColumns(texts)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("hour", "batch_id")
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archived ratings, whether in hourly folders or not."""
    return spark.read.options(**CSV_READ_OPTIONS).schema(schemas.ARCHIVE).csv(path).select(*schemas.ARCHIVE_COLUMNS)


def drop_hours(spark: SparkSession, path: str, now_ms: int, kept_hours: int) -> None:
    """Remove the folders of hours that ended `kept_hours` ago or earlier."""
    for hour in numbered(spark, path, "hour"):
        if hour < now_ms // HOUR_MS - kept_hours:
            remove_folder(spark, f"{path}/hour={hour}")
