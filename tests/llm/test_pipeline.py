from collections import defaultdict

import corpus_pipeline as pipeline
from test_suffixes import brute

from ratingloom.llm import near, quality
from ratingloom.llm.shared import Written, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    written, kept = Written(spark, "test"), [docs]
    for name, stage in pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], SF), name))
        assert kept[-1].columns == docs.columns
        assert [f.dataType for f in kept[-1].schema] == [f.dataType for f in docs.schema]
    texts = [{row.doc_id: row.text for row in frame.collect()} for frame in kept]

    trusted = table(spark, SF, "labels").filter("quality = 1 AND toxic = 0")
    verdicts = quality.assess(docs, trusted).filter("kept").collect()
    assert texts[1] == {row.doc_id: texts[0][row.doc_id] for row in verdicts}

    classes = {row.class_id for row in near.classes(kept[1], Written(spark, "test")).collect()}
    assert texts[2] == {i: texts[1][i] for i in classes}

    expected = brute(list(texts[2].items()))
    assert set(texts[3]) == set(texts[2])
    for i, (size, removed, spans, _) in expected.items():
        assert 0 <= size - removed - len((texts[3][i] or "").encode()) <= 6 * spans

    changed = [i for i in texts[3] if texts[3][i] != texts[4][i]]
    assert set(texts[4]) == set(texts[3])
    assert all("[SECRET]" in texts[4][i] for i in changed)

    size, held = {}, defaultdict(int)
    for row in pipeline.packed(spark, kept[4], SF).collect():
        size[row.doc_id] = row.doc_tokens
        held[row.doc_id] += row.length
    assert size == held and set(size) == set(texts[4])


def test_empty(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_odd_rows(spark):
    text = " ".join(f"word{k}" for k in range(80)) + " password=abc12345"
    rows = [(1, text, None, None, 1, 2), (1, text, None, None, 1, 2), (2, None, "en", "a", None, 2), (None, text + " é", "en", "a", 3, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    docs = Written(spark, "odd")(docs, "docs")
    for _, stage in pipeline.STAGES[1:-1]:
        docs = Written(spark, "odd")(stage(spark, docs, SF), "docs")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    assert {row.doc_id for row in docs.collect()} >= {1, 2}
    assert any("[SECRET]" in (row.text or "") for row in docs.collect())
