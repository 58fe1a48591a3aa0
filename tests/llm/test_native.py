"""Quality rules and secret scans against plain versions over whole texts."""

import math
import random
import re
import time
from collections import Counter, defaultdict
from hashlib import sha256

import corpus_pipeline
import pytest
from ratingloom.llm import quality, secret_scan
from ratingloom.llm.shared import Written
from xxhash import xxh64_intdigest

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,  # a long s is no letter of these words
)


def rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def base_spans(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def made(pieces, seed, n=150):
    choose = random.Random(seed)
    texts = ["".join(choose.choices(pieces, k=choose.choice([1, 5, 60, 200]))) for _ in range(n)]
    return [*texts, None, "", " \n\t", texts[0], texts[0] * 30]


def test_counts_of_quality_rules(spark):
    texts = made(["a ", "b ", "cd\n", "é#\x0b", " x ", "\U0001f600 ", "e\tf ", "same line\n", "\n", "<|> "], 5)
    texts += [" ".join(f"w{k}" for k in range(n)) for n in (49, 50, 3000)]
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    trusted = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    found = quality.assess(table.repartition(3), trusted).collect()
    assert len(found) == len(texts)
    for row in found:
        ours = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert ours == rules(texts[row.doc_id]), texts[row.doc_id]
        assert not (row.base_failed and row.kept)


def test_without_trusted_documents_the_base_rules_decide(spark):
    texts = [" ".join(f"w{k}" for k in range(60)), "short", None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nobody = spark.createDataFrame([], "doc_id long")
    assert {r.doc_id: r.kept for r in quality.assess(table, nobody).collect()} == {0: True, 1: False, 2: False}
    assert quality.assess(table.limit(0), nobody).collect() == []


def test_base_spans_of_secret_scans(spark):
    pieces = ["password", "PassWd = '", "api_key:", "apikey\": \"", "ToKen=", "abc123", "AKIA", "ABCDEFGH", "0123456789",
              "deadbeef", " ", "\n", "é", "\U0001f600", "ſecret=", "secret", "=x", "Zz9", "_-"]
    texts = made(pieces, 7)
    table = spark.createDataFrame(
        [(i, t, f"o{i % 3}" if i % 7 else None, "r") for i, t in enumerate(texts)],
        "doc_id long, text string, owner string, repository string",
    )
    found = secret_scan.counts(secret_scan.scan(table.repartition(3), Written(spark, "t"))).collect()
    assert len(found) == len(texts)
    names = ("assign", "access", "hex")
    for row in found:
        spans = base_spans(texts[row.doc_id])
        written = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)
        assert row.base_sha256 == sha256(written.encode()).hexdigest(), texts[row.doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert [s for s in row.spans.split(",") if s and not s.startswith("token")] == [s for s in written.split(",") if s]


def test_copied_tokens_are_not_live(spark):
    shared, own = "aB3" * 8 + "x", "Q7r" + "kLm92" * 5
    rows = [(i, f"{i} see {shared} here", f"o{i}", "r") for i in range(6)] + [(9, f"see {own} here", "o1", "r")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, owner string, repository string")
    found = secret_scan.counts(secret_scan.scan(table, Written(spark, "t"))).collect()
    assert sorted((r.doc_id, r.spans) for r in found) == [*((i, "") for i in range(6)), *[(9, f"token:4:{4 + len(own)}")] * 2]
    assert secret_scan.scan(table.limit(0), Written(spark, "t")).collect() == []


def test_a_secret_in_few_of_many_sources_is_masked(spark):
    few, wide = "Q7r" + "kLm92" * 5, "aB3" * 8 + "x"
    rows = [(i, f"text {i} password = {wide}", "en", f"s{i}", 1) for i in range(7)]
    rows += [(10 + i, f"other {i} password = {few}", "en", f"s{i}", 1) for i in range(4)]
    rows += [(20 + i, "nothing", "en", f"s{i}", 1) for i in range(10)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for row in corpus_pipeline.secrets(spark, table, "").collect():
        expected = f"other {row.doc_id - 10} [SECRET]" if 10 <= row.doc_id < 14 else rows[[r[0] for r in rows].index(row.doc_id)][1]
        assert row.text == expected
    tokens = [(i, f"{i} see {few}", f"s{i}", "r") for i in range(2)] + [(9, "", "s9", "r")]
    told = spark.createDataFrame(tokens, "doc_id long, text string, owner string, repository string")
    found = secret_scan.counts(secret_scan.scan(told, Written(spark, "t"))).collect()
    assert sorted((r.doc_id, r.n_live, r.n_copied) for r in found) == [(0, 1, 0), (1, 1, 0), (9, 0, 0)]


def test_owners_and_repositories_of_thousands(spark):
    """Against a plain count over distinct texts; what other owners hold changes nothing."""
    choose = random.Random(6)
    values = [f"Qx{k}" + "".join(choose.choices("abcXYZ0123456789", k=22)) for k in range(12)]
    rows = [(f"{i} password={values[0]}", f"o{i}", f"r{i}") for i in range(1000)]
    rows += [("one text, password=" + values[1], f"o{i}", f"r{i}") for i in range(200)]
    for k, (owners, repositories) in enumerate([(1, 1), (1, 120), (2, 120), (3, 50), (3, 51), (5, 5), (6, 6), (5, 50), (5, 60)], 2):
        rows += [(f"{i} token: {values[k]}", f"o{i % owners}", f"o{i % owners}/{i}") for i in range(repositories)]
    rows += [(f"{i} secret={values[11]}", None, None) for i in range(9)]
    others = [(f"words {i}", f"o{i}", f"r{i}") for i in range(3000)]
    holders = defaultdict(dict)
    for text, owner, repository in sorted(rows, key=repr):
        for value in values:
            if value in text:
                holder = holders[value].setdefault(text, (owner or "", repository or ""))
                holders[value][text] = min(holder, (owner or "", repository or ""))
    expected = {}
    for value, texts in holders.items():
        owners, repositories = len({o for o, _ in texts.values()}), len(set(texts.values()))
        expected[value] = (owners, repositories, owners > 5 or (owners > 2 and repositories > 50))
    assert [expected[value][2] for value in values] == [True, False, False, False, False, False, True, False, True, False, True, False]
    for more in ([], others):
        every = [(i, *row) for i, row in enumerate(rows + more)]
        table = spark.createDataFrame(every, "doc_id long, text string, owner string, repository string").repartition(5)
        for row in secret_scan.scan(table, Written(spark, "t")).collect():
            text = every[row.doc_id][1]
            assert [(s.owners, s.repositories, s.copied) for s in row.spans] == [expected[v] for v in values if v in text]


def plain_mask(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
            at = end
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_masks_against_a_plain_version(spark, monkeypatch):
    choose = random.Random(8)
    monkeypatch.setattr(secret_scan, "CHUNK", 7)
    rows, spans = [], []
    for i in range(60):
        text = "".join(choose.choices("ab\n\r é\U0001f600", k=choose.choice([1, 6, 7, 8, 14, 40, 90])))
        rows.append((i, text))
        for _ in range(choose.randint(1, 6)):
            start = choose.randint(0, len(text))
            spans.append((i, start, min(len(text), start + choose.choice([0, 1, 3, 7, 20]))))
    groups = secret_scan.grouped(spark.createDataFrame(spans, "doc_id long, start int, end int").distinct(), "doc_id")
    texts = spark.createDataFrame(rows, "doc_id long, text string").join(groups, "doc_id")
    cut = texts.select("doc_id", "groups", secret_scan.once(secret_scan.chunked(secret_scan.F.col("text"))).alias("chunks"))
    found = cut.select("doc_id", secret_scan.masked(secret_scan.F.col("chunks"), secret_scan.F.col("groups")).alias("text"))
    for row in found.collect():
        own = {(start, end) for i, start, end in spans if i == row.doc_id}
        assert row.text == plain_mask(rows[row.doc_id][1], own)


def test_very_many_spans_in_one_text(spark):
    choose = random.Random(9)
    secret = lambda: "".join(choose.choices("abcYZ0123456789", k=24)) + "aB1"
    parts = []
    for _ in range(16_000):
        parts += [f"password={secret()}", secret()]
    text = " é ".join(parts)
    docs = spark.createDataFrame([(1, text, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = Written(spark, "t")(docs, "docs")
    started = time.time()
    row = corpus_pipeline.secrets(spark, docs, "").first()
    assert time.time() - started < 60
    assert row.text == " é ".join(["[SECRET]"] * 32_000)


def plain_scores(texts, trusted, buckets, threshold):
    """(score, kept) of every text, from counters over the buckets of its words and pairs of words."""

    def number(data, seed=42):
        return xxh64_intdigest(data, seed)

    def grams(text):
        words = [number(word.encode()) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        pairs = [number(b.to_bytes(8, "little"), number(a.to_bytes(8, "little"))) for a, b in zip(words, words[1:], strict=False)]
        return [h % buckets for h in [*words, *pairs]]

    every, good = Counter(), Counter()
    for i, text in texts:
        every.update(grams(text))
        if i in trusted:
            good.update(grams(text))
    share = sum(good.values()) / sum(every.values())
    ratio = {b: round(math.log((good[b] + 5.0) / (n * share + 5.0)), 4) for b, n in every.items()}
    out = {}
    for i, text in texts:
        found = grams(text)
        score = sum(ratio[b] for b in found) / max(len(found), 1)
        out.setdefault(i, []).append((score, not rules(text)[-1] and score >= threshold))
    return out


@pytest.mark.parametrize("buckets", [64, quality.BUCKETS])
def test_scores_and_verdicts_against_counting(spark, buckets):
    choose = random.Random(4)
    clean, junk = [f"word{k}" for k in range(400)], [f"x{k}#" for k in range(300)]
    texts = []
    for i in range(160):
        words = choose.choices(clean, k=choose.randint(20, 300))
        if i % 3 == 0:
            words = [choose.choice(junk) if choose.random() < i / 160 else word for word in words]
        texts.append((i, choose.choice([" ", "\n", "\t "]).join(words)))
    texts += [(1000, None), (1001, ""), (1002, " \x0b "), (5, texts[5][1]), (None, texts[6][1]), (1003, "é " * 70)]
    trusted = {i for i, _ in texts if i is not None and i % 3 == 1 and i < 100}
    table = spark.createDataFrame([(*row, 1.5) for row in texts], "doc_id long, text string, score double")
    found = quality.assess(table.repartition(4), spark.createDataFrame([(i,) for i in trusted], "doc_id long"), buckets).collect()
    expected = plain_scores(texts, trusted, buckets, quality.THRESHOLD)
    assert len(found) == len(texts)
    verdicts = Counter()
    for row in found:
        for score, kept in expected[row.doc_id]:
            assert math.isclose(row.score, score, abs_tol=1e-9) and row.kept == kept
        verdicts[row.kept, row.base_failed] += 1
    if buckets == quality.BUCKETS:  # with few, ratios come close to zero
        assert verdicts[True, False] > 20 and verdicts[False, False] > 20
