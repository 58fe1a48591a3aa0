import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import crf, extract
from ratingloom.llm.dom import blocks_of


def test_blocks():
    page = """<!DOCTYPE html><title>x</title><script>var a="</p>";</script><body>loose<p>one<b> two<br>three<p>four &amp;&nbsp;five
    <ul><li>a<li><a href="x>y">b</a> c</ul><!-- <p>no</p> --><style>p{}</style><textarea>no</textarea>last <"""
    blocks = blocks_of(page)
    assert [block.text for block in blocks] == ["loose", "one two three", "four & five", "a", "b c", "last <"]
    assert [block.last for block in blocks] == ["body", "p", "p", "li", "li", "body"]
    assert blocks[4].linked == 1


@pytest.mark.parametrize("page", ["", "<", "<p", "<p class='", "</p></div>", "<!-- open", "<script>never", "a" * 100_000, "<div>" * 5000])
def test_broken_markup(page):
    assert isinstance(extract.main_text(page, extract.trained()), str)


def test_decoding_finds_the_best_path():
    numbers = np.random.default_rng(3)
    for _ in range(50):
        model = crf.Model({"a": 0, "b": 1}, numbers.normal(size=(2, 2)), numbers.normal(size=(2, 2)), numbers.normal(size=2))
        rows = [[["a"], ["b"], ["a", "b"], []][k] for k in numbers.integers(0, 4, 6)]
        scores = model.scores(rows)

        def value(bits, scores=scores, model=model):
            path = [bits >> k & 1 for k in range(6)]
            moves = sum(model.moves[x, y] for x, y in zip(path, path[1:], strict=False))
            return model.starts[path[0]] + moves + sum(scores[k, x] for k, x in enumerate(path))

        found = model.decode(rows)
        assert value(sum(x << k for k, x in enumerate(found))) == pytest.approx(max(map(value, range(64))))


def test_held_out_accuracy():
    layouts, model = extract.Layouts(99), extract.trained()
    right = total = 0
    for _ in range(150):
        rows, labels = extract.labelled(layouts.page())
        right += sum(a == b for a, b in zip(model.decode(rows), labels, strict=True))
        total += len(labels)
    assert right / total > 0.97


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search("<article>(.*?)</article>", row.html, re.S)[1].replace("<br>", " ")
        parts = (" ".join(unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split("</?(?:p|h1)>", inside))
        assert row.text == "\n".join(filter(None, parts)) and row.n_chars == len(row.text)


def test_odd_rows(spark):
    rows = [(None, None, None, 5), (1, "u", "", 5), (1, "u", "", 5), (2, "v", "<article><p>" + "word " * 50000, 5)]
    found = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert found.agg(F.sum("n_chars")).first()[0] == 249_999 and found.count() == 4
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
