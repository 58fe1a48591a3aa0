"""Ranked search against scoring every document, and the blocks that it skips."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ratingloom.llm import search
from ratingloom.llm.shared import Written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(documents, items, k=10):
    held = [(key, Counter(terms(text))) for key, text in documents]
    sizes = [sum(counted.values()) for _, counted in held]
    count, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(term for _, counted in held for term in counted)
    texts = {}
    for key, text in items:
        texts.setdefault(key, set()).add(text)
    out = []
    for item, asked in texts.items():
        wanted = Counter(term for text in asked for term in terms(text))
        scored = []
        for (key, counted), n in zip(held, sizes, strict=True):
            score = 0
            for term, times in wanted.items():
                if counted[term]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * n * count) // total
                    score += times * w * ((1000000000 * counted[term]) // (1000 * counted[term] + 8 * m))
            if score > 0 and key is not None:
                scored.append((-score, key))
        out += [(item, rank, key, -score) for rank, (score, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, documents, items, k=10):
    left = spark.createDataFrame([(*row, 1) for row in documents], "doc_id long, text string, n long").repartition(3)
    right = spark.createDataFrame([(*row, "x") for row in items], "item_id long, text string, term string")
    rows = search.search(left, right, Written(spark, "s"), k).collect()
    return sorted(((row.item_id, row["rank"], row.doc_id, row.score) for row in rows), key=repr)


def corpus(count, seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "你好", "x y", "A1"]
    marks = [" ", ", ", "-", "\n", "\x7f", "'", "_"]
    out = []
    for i in range(count):
        topic = words[dice.randint(0, 100) :][:12]
        chosen = [dice.choice(topic if dice.random() < 0.7 else words[:20]) for _ in range(dice.choice([0, 1, 5, 40, 200]))]
        out.append((i * 3 - 20, "".join(word + dice.choice(marks) for word in chosen)))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_against_scoring_every_document(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCUMENTS", 90)
    monkeypatch.setattr(search, "SHARD_POSTINGS", 900)
    documents = corpus(400, seed)
    items = [(i, text) for i, (_, text) in enumerate(corpus(25, seed + 50))]
    assert found(spark, documents, items) == plain(documents, items)
    assert found(spark, documents, items, 3) == plain(documents, items, 3)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_PAIRS", 60)
    documents = corpus(80, 7)
    items = [(i, text) for i, (_, text) in enumerate(corpus(12, 8))]
    assert found(spark, documents, items) == plain(documents, items)


def test_ties_repeated_rows_nulls_and_long_texts(spark):
    documents = [(i % 17, "same words here") for i in range(60)]
    documents += [(None, "same words here"), (100, None), (101, ""), (102, "same " * 5_000), (103, "..."), (104, "same\x00words")]
    items = [(1, "same words"), (1, "same words"), (2, None), (3, ""), (4, "nowhere"), (None, "HERE here"), (5, "same"), (5, "words")]
    assert found(spark, documents, items) == plain(documents, items)


@pytest.mark.parametrize(("documents", "items"), [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, documents, items):
    assert found(spark, documents, items) == []


def test_bounds_hold_and_blocks_are_skipped():
    choose = np.random.default_rng(3)
    count, size = 300, 1_500
    ends, names, values = [], [], []
    for i in range(size):
        topic = i % 10
        some = np.unique(np.concatenate([choose.integers(topic * 25, topic * 25 + 25, 12), choose.integers(250, 300, 15)]))
        names.append(some)
        values.append(choose.integers(50_000, 990_000, len(some)))
        ends.append((ends[-1] if ends else 0) + len(some))
    items = [np.concatenate([np.arange(topic * 25, topic * 25 + 6), [260, 270, 280]]) for topic in range(10)] + [np.arange(count)]
    for companions in (search.Companions(items[:-1] + [np.arange(k, k + 1) for k in range(count)], count), search.Companions(items, count)):
        check_shard(count, size, ends, names, values, items, companions)


def check_shard(count, size, ends, names, values, items, companions):
    made = search.shard(
        np.arange(size) * 2, np.array(ends), np.concatenate(names), np.concatenate(values), count, 32, companions
    )
    one = search.Shard({key: made[key].astype(kind) for key, kind in search.ARRAYS.items()}, count)
    dense = np.zeros((size, count), np.int64)
    for i in range(size):
        dense[i, names[i]] = values[i]
    # Every posting is in one block of its term, and summaries are upper bounds.
    for term in range(count):
        blocks = range(one.lists[term], one.lists[term + 1])
        docs = np.concatenate([one.members[one.blocks[b] : one.blocks[b + 1]] for b in blocks])
        assert sorted(docs) == np.flatnonzero(dense[:, term]).tolist()
        for b in blocks:
            inside = one.members[one.blocks[b] : one.blocks[b + 1]]
            assert 0 < len(inside) <= 32
            together = slice(None) if companions[term] is None else companions[term]
            assert (one.summary[b].astype(np.int64) * search.STEP >= dense[inside].max(0))[together].all()
    visited = total = 0
    for topic in range(10):
        asked = items[topic]
        weights = np.zeros(count, np.int64)
        weights[asked] = [5_000] * 6 + [100] * 3
        none = np.zeros(0, np.int64)
        (scores, ids), all_blocks, scored = one.search(asked, weights, (none, none), 10)
        exact = dense @ weights
        first = np.lexsort((np.arange(size), -exact))[:10]
        assert scores.tolist() == exact[first].tolist() and ids.tolist() == (first * 2).tolist()
        visited, total = visited + scored, total + all_blocks
    assert visited < 0.6 * total
