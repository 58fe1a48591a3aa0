"""Quality rules: repetition counts, and the hashed n-gram likelihood ratio of a document to trusted text.

Native: DataFrame functions only.

The score of a document is the mean, over its hashed word unigrams and bigrams, of the log likelihood ratio between two
multinomials: that of trusted documents and that of the whole corpus. Both are counted over hash buckets, so the table has
`buckets` rows whatever the size of the corpus; it is the only thing that reaches the driver. Counts of the corpus come from
all documents. The trusted multinomial is fitted on at most `trusted_limit` trusted documents, those with the smallest
hashes of their ids, which bounds the broadcast of their ids to 16 bytes each.

Defined cases: a null or empty text has no words, so it fails the base rules; a null id is never trusted and otherwise
treated like any other; repeated rows give repeated results; without any trusted document every ratio is zero, so that the
base rules alone decide; an empty table gives an empty result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.shared import once

BLANKS = r"[\x20\x09-\x0D]+"
BUCKETS = 1 << 15
TRUSTED_LIMIT = 20_000
THRESHOLD = -0.06
# N-grams added to both sides of a ratio: a bucket that few documents use says nothing.
PRIOR = 5.0


def hashes_of(text: Column) -> Column:
    """The hash of every word, in order."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def neighbours(hashes: Column, width: int) -> Column:
    """The hash of every window of `width` words."""
    out = hashes
    for k in range(1, width):
        shifted = F.slice(hashes, k + 1, F.greatest(F.size(hashes), F.lit(1)))
        out = F.zip_with(out, shifted, lambda left, right: F.xxhash64(left, right))
    return F.slice(out, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))


def bucket_list(hashes: Column, buckets: int) -> Column:
    grams = F.concat(hashes, neighbours(hashes, 2))
    return F.transform(grams, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def ratio_table(
    documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, trusted_limit: int = TRUSTED_LIMIT
) -> list[float]:
    """The log ratio of every bucket. `documents` has doc_id and text, `trusted` the ids of trusted documents."""
    ids = (
        trusted.select(F.col("doc_id").alias("trusted_id"))
        .filter(F.col("trusted_id").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("trusted_id"), "trusted_id")
        .limit(trusted_limit)
    )
    grams = (
        documents.select("doc_id", once(hashes_of(F.col("text"))).alias("hashes"))
        .join(F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left")
        .select(
            F.col("trusted_id").isNotNull().cast("int").alias("good"),
            F.explode(bucket_list(F.col("hashes"), buckets)).alias("bucket"),
        )
    )
    counted = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).collect()
    every, good = sum(row.n for row in counted), sum(row.good for row in counted)
    ratios = [0.0] * buckets
    for row in counted if good else []:
        ratios[row.bucket] = round(log((row.good + PRIOR) / (row.n * good / every + PRIOR)), 4)
    return ratios


def assess(
    documents: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    trusted_limit: int = TRUSTED_LIMIT,
    threshold: float = THRESHOLD,
    carry: bool = False,
) -> DataFrame:
    """Every document with its counts, score and verdict.

    `documents` needs doc_id and text, `trusted` doc_id. A document is kept unless the base rules fail or its mean log
    ratio is below `threshold`. With `carry`, all columns of `documents` come along in a struct `row`.
    """
    row = ["row"] if carry else []
    documents = documents.select("doc_id", "text", *([F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")] if carry else []))
    ratios = ratio_table(documents, trusted, buckets, trusted_limit)
    # As one text, folded into one literal before the query runs.
    ratio = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = documents.select(
        "doc_id",
        *row,
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        once(hashes_of(F.col("text"))).alias("hashes"),
    )
    hashed = measured.select(
        "doc_id",
        *row,
        F.size("hashes").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(
            bucket_list(F.col("hashes"), buckets), F.lit(0.0), lambda total, b: total + F.get(ratio, b)
        ).alias("total"),
        once(neighbours(F.col("hashes"), 3)).alias("windows"),
    )
    # Windows by hash and place; only texts in which some window repeats are sorted.
    ordered = hashed.select(
        *hashed.columns[:-1],
        once(
            F.when(
                F.size(F.array_distinct("windows")) < F.size("windows"),
                F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            )
        ).alias("ordered"),
    )
    repeated = F.filter(
        F.col("ordered"),
        lambda x, j: F.coalesce(x["h"] == F.get(F.col("ordered"), j - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(F.col("ordered"), j + 1)["h"], F.lit(False)),
    )
    placed = ordered.select(
        *ordered.columns[:-1], once(F.sort_array(F.transform(repeated, lambda x: x["i"]))).alias("places")
    )
    covered = F.aggregate(
        F.transform(
            F.col("places"), lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("places"), j + 1) - p, F.lit(3)))
        ),
        F.lit(0).cast("long"),
        lambda total, p: total + p,
    )
    counted = placed.select(
        "doc_id",
        *row,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        (F.col("total") / F.greatest(2 * F.col("n_words") - 1, F.lit(1))).alias("score"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
