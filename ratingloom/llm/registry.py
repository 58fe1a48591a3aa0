"""The queries of this package, each over the whole of its tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import ann, bpe, chat, collocations, extract, near, packing, quality, search, secret_scan, suffixes, tokens, warc
from ratingloom.llm.shared import Written, pre_token_pattern, table, tokenizer_file
from ratingloom.session import shared_folder


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), pre_token_pattern())


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(table(spark, sf_dir, "documents"), Written(spark, "op3")).select("doc_id", "class_id")


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.without_repeats(table(spark, sf_dir, "documents"), Written(spark, "op4")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_chats(chat.with_example(table(spark, sf_dir, "conversations"))))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return quality.assess(table(spark, sf_dir, "documents"), trusted)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), shared_folder(spark, "op8"))
    return warc.read(archives.index, with_payload=False).drop("payload")


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("source").alias("owner"), F.concat_ws("/", "source", "lang").alias("repository")
    )
    return secret_scan.counts(secret_scan.scan(documents, Written(spark, "op10")))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Written(spark, "op11"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = tokenizer_file("byte_bpe_50k.json")
    return tokens.digests(tokens.write(table(spark, sf_dir, "documents"), file, shared_folder(spark, "op12")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), Written(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_ann": op2_ann,
    "op3_near": op3_near,
    "op4_suffixes": op4_suffixes,
    "op5_chat": op5_chat,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_extract": op9_extract,
    "op10_secret_scans": op10_secret_scans,
    "op11_search": op11_search,
    "op12_tokens": op12_tokens,
    "op13_collocations": op13_collocations,
}

# Every document is scored for every item.
SEARCH_SQL = r"""
WITH held AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term),
corpus AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS documents, CAST(sum(len(words)) AS BIGINT) AS total FROM held),
postings AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM held)
    GROUP BY doc_id, n, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0 * documents + 2) / (2.0 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus),
scores AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total))))
        AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""

# All phrases of one to five words are counted one by one, and every longer candidate is held against every shorter one in it.
COLLOCATIONS_SQL = r"""
WITH words AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
counted AS (
    SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM words, (SELECT unnest(range(1, 6)) AS k)) GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 100),
cuts AS (
    SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scores AS (
    SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, CAST(n AS BIGINT) AS n,
        CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score, cut
    FROM cuts c JOIN totals t ON t.lang = c.lang JOIN counted x ON x.lang = c.lang AND x.phrase = head
    JOIN counted y ON y.lang = c.lang AND y.phrase = rest),
best AS (SELECT * EXCLUDE (cut) FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
    SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase FROM (
        SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM candidates))),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN covers USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000"""

SQL: dict[str, str] = {"op11_search": SEARCH_SQL, "op13_collocations": COLLOCATIONS_SQL}
