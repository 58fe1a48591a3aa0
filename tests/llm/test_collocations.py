"""Collocations against counting every phrase by itself."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ratingloom.llm import collocations
from ratingloom.llm.shared import Written

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top=None):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if a >= candidates[lang, words[i : i + k]]:
                    covered.add((lang, words[i : i + k]))
    out = []
    for lang in n:
        rows = []
        for (of, words), a in candidates.items():
            if of == lang and (of, words) not in covered:
                score, k = min(
                    (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))
                )
                rows.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(spark, rows, least, **settings):
    documents = spark.createDataFrame([(*row, 1) for row in rows], "lang string, text string, n long").repartition(3)
    return sorted(tuple(row) for row in collocations.mine(documents, Written(spark, "c"), least, **settings).collect())


def texts(count, seed):
    dice = random.Random(seed)
    words = ["a", "B", "cé", "É", "d\x1c", "e f", "-", "x\0"] + [f"w{i}" for i in range(30)]
    ends = [" ", "  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "\x0b", " ; ", "!?"]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(dice.randint(0, 60)):
            chosen = dice.choice(words) if dice.random() < 0.6 else "hot stock tip for you"
            parts += [chosen, dice.choices(ends, [60, 5, 5, 2, 3, 3, 3, 1, 1, 1, 1])[0]]
        out.append((dice.choice(["en", "en", "en", "de", None, "", "und"]), "".join(parts)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_counting_each_phrase(spark, seed):
    rows = texts(150, seed)
    expected = plain(rows, 4)
    assert expected and mined(spark, rows, 4) == expected
    assert mined(spark, rows, 4, top=3) == plain(rows, 4, 3)


FULL = np.full(collocations.BITMAP_BITS // 8, 255, np.uint8)


def test_small_tables_in_tasks(monkeypatch):
    rows = texts(60, 9)
    monkeypatch.setattr(collocations, "KEPT_WINDOWS", 60)
    monkeypatch.setattr(collocations, "KEPT_HASHES", 60)
    monkeypatch.setattr(collocations, "KEPT_WORDS", 40)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 200)
    windows, phrases, total = Counter(), {1: Counter(), 2: Counter(), 3: Counter()}, 0
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total += len(words)
            windows.update(tuple([*words, None, None, None][k : k + 4]) for k in range(len(words)))
            for order, found in phrases.items():
                found.update(tuple(words[k : k + order]) for k in range(len(words) - order + 1))

    def counts(order):
        of_lang, batches = collocations.Counts("x", order, 4, [FULL] * 3), []
        names = ["lang", "w1", "w2", "w3", "w4", "n"] if order is None else ["lang", "hash", "n"]
        for _, text in rows:
            for chunk in collocations.chunks(text.encode().translate(collocations.TABLE)):
                of_lang.add(chunk)
                if of_lang.full():
                    batches += of_lang.batches(names)
        batches += of_lang.batches(names)
        assert len(batches) > 5
        return [row for batch in batches for row in batch.to_pylist()]

    found = Counter()
    for row in counts(None):
        found[row["w1"], row["w2"], row["w3"], row["w4"]] += row["n"]
    assert found == windows
    for order in (1, 2, 3):
        found = Counter()
        for row in counts(order):
            found[row["hash"]] += row["n"]
        if order == 1:
            assert found.pop(None) == total
        assert sorted(found.values()) == sorted(phrases[order].values())


def test_what_passes_by_chance_changes_nothing(spark, monkeypatch):
    rows = texts(120, 5)
    monkeypatch.setattr(collocations, "bits_of", lambda hashes: FULL.tobytes())
    assert mined(spark, rows, 4) == plain(rows, 4)
    monkeypatch.undo()
    monkeypatch.setattr(collocations, "HASH_BITS", 5)
    assert mined(spark, rows, 4) == plain(rows, 4)


def test_bits(spark):
    hashes = spark.createDataFrame([(3,), (3,), (32_767,), (32_768 + 9,), (1 << 39,)], "hash long")
    table = collocations.bits_of(hashes)
    found = {k for k in range(len(table) * 8) if table[k >> 3] >> (k & 7) & 1}
    assert found == {h & (len(table) * 8 - 1) for h in (3, 32_767, 32_777, 1 << 39)}


def test_nulls_empty_long_and_equal_texts(spark):
    rows = [(None, None), ("en", None), ("en", ""), ("en", " \t . "), ("und", "p q r"), (None, "p q r"), ("en", "One two " * 4_000)]
    rows += [("en", "same same")] * 5
    assert mined(spark, rows, 2) == plain(rows, 2)


def test_an_empty_table(spark):
    assert mined(spark, [], 2) == []
    assert mined(spark, [(None, None)], 2) == []


def test_products_past_64_bits(spark):
    phrases = spark.createDataFrame(
        [("x", "", 0, 9 * 10**15), ("x", "a", 1, 8 * 10**15), ("x", "b", 1, 7 * 10**15), ("x", "a b", 2, 10**14)],
        "lang string, phrase string, k int, f long",
    )
    [row] = collocations.scored(phrases).collect()
    assert row.score == 1000 * 10**14 * 9 * 10**15 // (8 * 10**15 * 7 * 10**15)


def test_rare_words_are_not_kept_and_end_a_window():
    """A word that the table does not tell to be frequent takes no place in the tables of a task."""
    seen = collocations.Counts("x", 1, 4, [])
    seen.add(b"a b")
    table = np.zeros(collocations.BITMAP_BITS // 8, np.uint8)
    for value in seen.hashes[1:]:
        at = value & (len(table) * 8 - 1)
        table[at >> 3] |= 1 << (at & 7)
    windows = collocations.Counts("x", None, 4, [table, FULL, FULL])
    windows.add(b" ".join([b"a b rare%d" % k for k in range(500)] + [b"a\nb"]))
    assert len(windows.words) < 60 and {b"a", b"b"} <= set(windows.words)
    [batch] = windows.batches(["lang", "w1", "w2", "w3", "w4", "n"])
    found = {(row["w1"], row["w2"], row["w3"]): row["n"] for row in batch.to_pylist()}
    assert found["a", "b", None] > 450 and found["a", None, None] == 1 and found["b", None, None] > 450


def test_windows_are_counted_by_no_more_tasks_than_cores_can_use(spark):
    """The rows of the windows grow with frequent windows, not with them times the partitions of the input."""
    rows = [("en", "one two three")] * 640
    documents = spark.createDataFrame(rows, "lang string, text string").repartition(64)
    full = spark.sparkContext.broadcast(FULL.tobytes())
    counted = collocations.counted(documents, None, 4, [full] * 3)
    most = 3 * collocations.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert counted.count() <= most < 3 * 64
    assert {tuple(row) for row in counted.groupBy("w1").sum("n").collect()} == {("one", 640), ("two", 640), ("three", 640)}
    assert mined(spark, rows, 4) == plain(rows, 4)


def test_languages_together_are_summed_before_they_are_given_away(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 400)
    monkeypatch.setattr(collocations, "KEPT_WINDOWS", 100)
    full = spark.sparkContext.broadcast(FULL.tobytes())
    documents = spark.createDataFrame([(("en", "de")[k % 2], "one two three four") for k in range(2_000)], "lang string, text string").coalesce(1)
    assert collocations.counted(documents, None, 4, [full] * 3).count() == 8
