import random
from hashlib import sha256

import numpy as np

from ratingloom.llm import suffixes
from ratingloom.llm.shared import Written

LENGTH = suffixes.LENGTH


def brute(documents):
    """Every document's result from a table of all strings of 100 bytes."""
    seen, out = {}, {}
    order = sorted(set(documents), key=lambda d: (d[0] is not None, d[0] or 0))
    for doc_id, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for start in range(len(data) - LENGTH + 1):
            string = data[start : start + LENGTH]
            if string in seen:
                gone[start : start + LENGTH] = True
            seen.setdefault(string, (doc_id, start))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0
        out[doc_id] = (len(data), int(gone.sum()), spans, sha256(kept).hexdigest())
    return out


def made(seed):
    choose = random.Random(seed)
    words = ["".join(choose.choices("abcdeé", k=choose.randint(2, 8))) for _ in range(400)]
    passages = [" ".join(choose.choices(words, k=60)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [" ".join(choose.choices(words, k=choose.randint(0, 80))) for _ in range(3)]
        parts.insert(choose.randint(0, 3), choose.choice(passages)[choose.randint(0, 60) :])
        texts.append(" ".join(parts))
    for text in texts[:15]:
        edited = text.split(" ")
        edited[choose.randrange(len(edited))] = "edited"
        texts.append(" ".join(edited))
    texts += texts[:5] + ["x" * 700, "ab" * 300 + "x" * 250, "", None, "q" * 99, "q" * 100, "q" * 101, words[0] * 60]
    choose.shuffle(texts)
    return list(enumerate(texts))


def test_against_all_strings(spark):
    for seed in (1, 2):
        rows = [*made(seed), (None, "x" * 300)]
        table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, kept int, `a.b` int")
        found = suffixes.digests(suffixes.without_repeats(table.repartition(3), Written(spark, "t"))).collect()
        assert {row[0]: tuple(row[1:]) for row in found} == brute(rows)
        assert len(found) == len(rows)


def test_repeated_rows_are_one_document(spark):
    text = " ".join(map(str, range(200)))
    table = spark.createDataFrame([(1, text), (1, text), (2, text), (2, "short")], "doc_id long, text string")
    found = suffixes.digests(suffixes.without_repeats(table, Written(spark, "t"))).collect()
    assert sorted((row.doc_id, row.n_bytes, row.n_removed) for row in found) == [
        (1, len(text), 0), (1, len(text), 0), (2, 5, 0), (2, len(text), len(text))
    ]


def test_empty(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.without_repeats(table, Written(spark, "t")).collect() == []


def test_shuffles_are_gone_when_a_table_is_written(spark):
    """Disk holds no shuffle of a step whose table is there, whether or not the driver has collected its garbage."""
    from ratingloom.llm.shared import SHUFFLE_CLEANUP, Written

    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_") and name.endswith(".data")}

    before, asked = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    written = Written(spark, "test")
    rows = written(spark.range(50_000).selectExpr("id % 20011 AS a", "id AS b").repartitionByRange(4, "a").groupBy("b").count(), "rows")
    wide = written(rows.join(rows.withColumnRenamed("count", "n").hint("merge"), "b"), "wide")
    written.remove(1)
    assert shuffled() <= before
    assert wide.count() == 50_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == asked
