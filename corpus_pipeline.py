"""A corpus cleaned and packed: five stages, each over all that the one before kept, with a written table in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import near, packing, quality, secret_scan, suffixes
from ratingloom.llm.shared import Written, once, table, tokenizer_file


def with_text(columns: list[str], kept: dict) -> list:
    """All columns in order, those in `kept` by what it says."""
    return [kept[name].alias(name) if name in kept else F.col(f"row.`{name}`") for name in columns]


def of_row(documents: DataFrame) -> list:
    return [F.col(f"row.`{name}`") for name in documents.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return quality.assess(docs, trusted, carry=True).filter("kept").select(*of_row(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every class."""
    return near.one_each(docs, Written(spark, "near"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that are in earlier ones, or earlier in the same."""
    found = suffixes.without_repeats(docs, Written(spark, "suffixes"), as_text=True)
    text = F.col("kept")
    return found.select(*with_text(docs.columns, {"text": text, "n_chars": F.length(text).cast("long")})).select(
        *(F.col(f"`{name}`").cast(docs.schema[name].dataType) for name in docs.columns)
    )


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets are masked unless so many owners hold the same that they are copied examples."""
    told = docs.select(
        F.struct("doc_id", F.xxhash64("text").alias("copy")).alias("doc_id"),
        "text",
        F.col("source").alias("owner"),
        F.concat_ws("/", "source", "lang").alias("repository"),
    )
    own = F.filter("spans", lambda s: ~s["copied"])
    found = (
        secret_scan.scan(told, Written(spark, "secrets"))
        .select("doc_id", own.alias("spans"))
        .filter(F.size("spans") > 0)
        .groupBy("doc_id")
        .agg(F.first("spans").alias("spans"))
        .select("doc_id", F.explode("spans").alias("span"))
        .select("doc_id", "span.start", "span.end")
    )
    groups = secret_scan.grouped(found, "doc_id").select(
        F.col("doc_id.doc_id").alias("in_id"), F.col("doc_id.copy").alias("in_copy"), "groups"
    )
    # By other names, so that none can clash.
    place = {name: f"column{k}" for k, name in enumerate(docs.columns)}
    rows, text = docs.toDF(*place.values()), F.col(place["text"])
    same = F.col(place["doc_id"]).eqNullSafe(F.col("in_id")) & (F.xxhash64(text) == F.col("in_copy"))
    chunks = F.when(F.col("groups").isNotNull(), secret_scan.chunked(text))
    joined = rows.join(groups, same, "left").select(*place.values(), "groups", once(chunks).alias("chunks"))
    masked = F.when(F.col("groups").isNull(), text).otherwise(secret_scan.masked(F.col("chunks"), F.col("groups")))
    joined = joined.select(*place.values(), once(masked).alias("masked"))
    kept = {"text": F.col("masked"), "n_chars": F.length("masked")}
    return joined.select(
        *(kept.get(name, F.col(place[name])).cast(docs.schema[name].dataType).alias(name) for name in docs.columns)
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of 2048 tokens."""
    return packing.digests(packing.pack(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("secret_scans", secrets),
    ("packing", packed),
]
# Packing, and the stages before it, follow no SQL; a test compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), Written(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        written.remove(len(written.paths) - 1)  # what the stage has read
    return STAGES[-1][1](spark, docs, sf_dir)
