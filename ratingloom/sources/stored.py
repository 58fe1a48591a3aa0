"""Reading back what the jobs wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.fixed_values import TEXT_OUTPUT_SEPARATOR
from ratingloom.functions.text import field
from ratingloom.session import has_data
from ratingloom.sinks.csv import CSV_READ_OPTIONS


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All part files of a CSV output; the header of each is left out. Schemas are in `ratingloom.schemas`."""
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def read_strict_means(spark: SparkSession, path: str) -> DataFrame:
    """All parts of the tab-separated means; lines that lack a field or do not parse are skipped."""
    parts = F.split("value", TEXT_OUTPUT_SEPARATOR)
    return (
        spark.read.text(path)
        .select(
            field(parts, 0).alias("movieId"),
            F.round(field(parts, 1).try_cast("double"), 2).alias("avgRating"),
            field(parts, 2).try_cast("bigint").alias("count"),
        )
        .where(F.col("avgRating").isNotNull() & F.col("count").isNotNull())
    )


def availability(spark: SparkSession, datasets: dict[str, tuple[str, str]], counted: bool = True) -> DataFrame:
    """Dataset, available, row_count for {dataset: (path, format)}. CSV files are expected to have a header.

    Whether there is data is told by the file listing alone, so an output without any row file is not available. Rows are counted
    only if asked for, and `row_count` is NULL otherwise: for Parquet from the footers, for text by reading it.
    """

    def status(name: str, path: str, file_format: str) -> DataFrame:
        there = has_data(spark, path)
        row = spark.range(1).select(F.lit(name).alias("dataset"), F.lit(there).alias("available"))
        if not counted:
            return row.withColumn("row_count", F.lit(None).cast("bigint"))
        if not there:
            return row.withColumn("row_count", F.lit(0).cast("bigint"))
        reader = spark.read.options(**CSV_READ_OPTIONS) if file_format == "csv" else spark.read
        # One column is enough to count lines and spares the pass that would infer names.
        rows = reader.schema("value STRING").format(file_format).load(path) if file_format != "parquet" else (
            reader.parquet(path)
        )
        return rows.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("dataset"), F.lit(True).alias("available"), "row_count"
        )

    return reduce(
        DataFrame.unionByName, [status(name, path, file_format) for name, (path, file_format) in datasets.items()]
    )
