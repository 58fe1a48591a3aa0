"""What several operators of this package use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratingloom.session import remove_folder, setting, shared_folder


def once(value: Column) -> Column:
    """`value` behind a generator over one element, so that later steps cannot compute it again for each of their uses."""
    return F.explode(F.array(value))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Written:
    """Intermediate tables in the shared folder, which cut the lineage and outlive a lost executor.

    What was shuffled to make a table is removed when the table is written, not at some later collection of garbage.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def __call__(self, rows: DataFrame, name: str) -> DataFrame:
        path = shared_folder(self.spark, f"{self.label}-{name}")
        with setting(self.spark, SHUFFLE_CLEANUP, "true"):
            rows.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def remove(self, count: int | None = None) -> None:
        """Remove the oldest `count` tables, or all; nobody may read them any more."""
        gone, self.paths = (self.paths, []) if count is None else (self.paths[:count], self.paths[count:])
        for path in gone:
            remove_folder(self.spark, path)


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files are; RATINGLOOM_TOKENIZERS names another folder."""
    folder = os.environ.get("RATINGLOOM_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


PACKAGE = Path(__file__).resolve().parent.parent
SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, unless they already look where it lies."""
    context = spark.sparkContext
    near = context.master.startswith("local") and str(PACKAGE.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if near or context.applicationId in SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(PACKAGE.rglob("*.py")):
            packed.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    SHIPPED.add(context.applicationId)


def in_arrow(rows: DataFrame, run, schema: StructType | str) -> DataFrame:
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def in_pandas(rows: DataFrame, run, schema: StructType | str) -> DataFrame:
    ship(rows.sparkSession)
    return rows.mapInPandas(run, schema)
