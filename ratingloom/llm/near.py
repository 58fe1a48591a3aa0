"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text is a bag of shingles of five words; a shorter one is one shingle of all its words. A shingle weighs its count in the
text times 1 + IDF_SHARE * ln(n / df) / ln(n), where n is the number of documents and df that of the shingle's hash bucket
over all of them. The share is small, so that passages a group of copies has in common do not weigh less than its edits.

Forty samples a text, in ten bands of four, give the slots in which texts meet. In each round, the texts of a slot are compared with
a few of them, one at first and then `REPS`, by exact weighted Jaccard similarity, unless they are in their classes by now;
these then leave the slot. Slots of one class are done. So a round is linear in the members of its slots, and no pairs within a class are made. Slots of
up to 1 + (THOROUGH - 1) * REPS texts are thus compared in full. What is left of larger ones after `THOROUGH` rounds is joined
exactly, by weighted prefixes: with the shingles of a text in one order for all texts, two texts of the least similarity
have a first shingle in common before either text's remaining weight falls below that share of its total. The order is that of
the exact number of these texts that hold a shingle; what only one class holds comes first of all, as it meets nothing.
So passages that many texts share are used only where a text has little else.
All pairs of different classes with such a shingle are compared, unless their weights from there on rule them out. So every
two similar texts that share a slot end in one class; only texts whose samples never meet can be missed.
The classes are the components of the links, found by alternating star contractions over written tables.

Copies count once: nodes are digests of texts, so a text that a third of all rows hold is one node.

Defined cases: a null text counts as empty; a text without words is in a class with equal texts only; the class id is the
smallest doc_id of a class, null if it has none; repeated rows are rows of one class; an empty table gives an empty result.
Words are kept as they are, case included. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.quality import hashes_of
from ratingloom.llm.shared import Written, in_arrow
from ratingloom.llm.suffixes import M1, M2, M3, paired

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
BUCKETS = 1 << 16
IDF_SHARE = 0.25
THOROUGH = 2
# Texts of a slot that the others are compared with in each round but the first.
REPS = 8
CHUNK_WORDS = 1 << 15
# Quantiles of the exponential distribution's sum of two, drawn once; 4096 of each are told apart by 12 bits of a hash.
DRAWN = np.random.default_rng(11)
GAMMA = DRAWN.gamma(2.0, 1.0, 4096)
LOG_GAMMA = np.log(DRAWN.gamma(2.0, 1.0, 4096))
SEEDS = DRAWN.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def bags(words: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of texts given as hashes of words, one after another; sorted by text and shingle."""
    texts = np.flatnonzero(length)
    begin = (np.cumsum(length) - length)[texts]
    size = length[texts]
    number = np.maximum(size - WIDTH + 1, 1)
    text = np.repeat(np.arange(len(texts)), number)
    start = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number - begin, number)
    name = np.repeat(np.minimum(size, WIDTH), number).astype(np.uint64) * M2
    for k in range(WIDTH):
        inside = k < np.repeat(size, number)
        word = words[np.minimum(start + k, len(words) - 1)] if len(words) else name
        name = np.where(inside, paired(name, word), name)
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (name[1:] != name[:-1])][: len(text)])
    return texts[text[first]], name[first], np.diff(np.r_[first, len(text)])


def chunks(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, hashes of words, number of words of each text) of a column of lists, some texts at a time."""
    ends = words.offsets.to_numpy()
    values = words.values.to_numpy().view(np.uint64)
    at = 0
    while at < len(words):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK_WORDS, "right")) - 1)
        yield at, values[ends[at] : ends[to]], np.diff(ends[at : to + 1]).astype(np.int64)
        at = to


def bucket(name: np.ndarray) -> np.ndarray:
    return (name >> np.uint64(20)) & np.uint64(BUCKETS - 1)


def frequencies(documents: DataFrame) -> np.ndarray:
    """Factor of every bucket, from all documents. Its size does not depend on the corpus."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, texts = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, words, length in chunks(batch.column("words")):
                n += np.bincount(bucket(bags(words, length)[1]).astype(np.int64), minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[texts, n[some]])], names=["bucket", "n"])

    rows = in_arrow(documents.select(hashes_of(F.col("text")).alias("words")), counted, "bucket long, n long")
    found = {row.bucket: row.n for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = max(found.pop(-1, 0), 2)
    df = np.ones(BUCKETS)
    df[list(found)] = list(found.values())
    return 1 + IDF_SHARE * np.clip(np.log(total / df) / log(total), 0, 1)


def samples(text: np.ndarray, name: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One row per text in `text`: a name for each of its weighted samples. Buffers are used again for each sample."""
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(text)]))
    level = np.log(weight)
    z, part = np.empty(len(name), np.uint64), np.empty(len(name), np.uint64)
    spot = np.empty(len(name), np.int64)
    r, t, beta = np.empty(len(name)), np.empty(len(name)), np.empty(len(name))
    out = np.empty((len(first), len(SEEDS)), np.uint64)
    for k, seed in enumerate(SEEDS):
        np.multiply(np.bitwise_xor(name, seed, out=z), M1, out=z)
        np.bitwise_xor(z, np.right_shift(z, np.uint64(32), out=part), out=z)
        np.multiply(z, M3, out=z)
        # The upper bits, which are the best mixed: 12 for r, 12 for the level, 16 for beta.
        np.right_shift(z, np.uint64(52), out=spot, casting="unsafe")
        GAMMA.take(spot, out=r, mode="clip")
        np.bitwise_and(np.right_shift(z, np.uint64(40), out=part), np.uint64(4095), out=spot, casting="unsafe")
        np.bitwise_and(np.right_shift(z, np.uint64(24), out=part), np.uint64(0xFFFF), out=part)
        np.multiply(part, 2.0**-16, out=beta)
        np.floor(np.add(np.divide(level, r, out=t), beta, out=t), out=t)
        # a = log c - r * (t - beta + 1)
        np.multiply(np.add(np.subtract(t, beta, out=beta), 1.0, out=beta), r, out=beta)
        np.subtract(LOG_GAMMA.take(spot, out=r, mode="clip"), beta, out=r)
        least = np.flatnonzero(r == np.minimum.reduceat(r, first)[owner])
        drawn = paired(name[least], t[least].astype(np.int64).view(np.uint64))
        out[:, k] = np.minimum.reduceat(drawn, np.searchsorted(owner[least], np.arange(len(first))))
    return out


def slots(documents: DataFrame, factor: np.ndarray) -> DataFrame:
    """(key, slot) of every text with words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words, length in chunks(batch.column("words")):
                text, name, count = bags(words, length)
                if len(text):
                    drawn = samples(text, name, count * factor[bucket(name).astype(np.int64)])
                    keys = batch.column("key").take(pa.array(at + np.unique(text)))
                    for band in range(BANDS):
                        slot = np.full(len(drawn), band, np.uint64)
                        for k in range(band * ROWS, (band + 1) * ROWS):
                            slot = paired(slot, drawn[:, k])
                        yield pa.RecordBatch.from_arrays([keys, pa.array(slot.view(np.int64))], names=["key", "slot"])

    return in_arrow(documents.select("key", hashes_of(F.col("text")).alias("words")), run, "key binary, slot long")


def similarity(left: tuple, right: tuple) -> np.ndarray:
    """Weighted Jaccard similarity of the n-th bag on each side, for all n."""
    text, name = np.r_[left[0], right[0]], np.r_[left[1], right[1]]
    weight, side = np.r_[left[2], right[2]], np.r_[np.zeros(len(left[0]), bool), np.ones(len(right[0]), bool)]
    order = np.lexsort((side, name, text))
    text, name, weight = text[order], name[order], weight[order]
    both = np.flatnonzero((text[1:] == text[:-1]) & (name[1:] == name[:-1]))
    n = int(text.max()) + 1 if len(text) else 0
    common = np.bincount(text[both], np.minimum(weight[both], weight[both + 1]), n)
    return common / (np.bincount(text, weight, n) - common)


def similar(pairs: DataFrame, factor: np.ndarray, least: float) -> DataFrame:
    """The rows (key, rep) of pairs whose texts `mine` and `other`, as hashes of words, are similar."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                some, sides = batch.slice(k, 64), []
                for side in ("mine", "other"):
                    lists = pa.concat_arrays([some.column(side)])
                    ends = lists.offsets.to_numpy()
                    words = lists.values.to_numpy().view(np.uint64)[ends[0] : ends[-1]]
                    text, name, count = bags(words, np.diff(ends).astype(np.int64))
                    sides.append((text, name, count * factor[bucket(name).astype(np.int64)]))
                near = similarity(*sides) >= least
                yield some.select(["key", "rep"]).take(pa.array(np.flatnonzero(near)))

    return in_arrow(pairs, run, "key binary, rep binary")


def weighted(texts: DataFrame, factor: np.ndarray) -> DataFrame:
    """(key, class, shingle, weight, total) of every shingle of `texts` (key, class, text); `total` is the weight of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words, length in chunks(batch.column("words")):
                text, name, count = bags(words, length)
                if not len(text):
                    continue
                weight = count * factor[bucket(name).astype(np.int64)]
                first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                total = np.repeat(np.add.reduceat(weight, first), np.diff(np.r_[first, len(text)]))
                rows = pa.array(at + text)
                columns = [batch.column("key").take(rows), batch.column("class").take(rows), pa.array(name.view(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(weight), pa.array(total)], names=names)

    names = ["key", "class", "shingle", "weight", "total"]
    rows = texts.select("key", "class", hashes_of(F.col("text")).alias("words"))
    return in_arrow(rows, run, "key binary, class binary, shingle long, weight double, total double")


def prefixes(texts: DataFrame, factor: np.ndarray, least: float, written: Written) -> DataFrame:
    """(key, class, shingle, rest, total) of the shingles of every text by which it can meet a similar one of another class.

    Shingles that only one class holds come first, then those of few texts, so that what many texts share is used where a
    text has little else. `rest` is the weight of the shingle and all after it; there are shingles up to where less than
    `least` of a text's weight is left.
    """
    bag = written(weighted(texts, factor), "bags")
    held = bag.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = written(held.filter("low != high").select("shingle", "n"), "mixed")
    # What one class holds alone meets nothing; it takes its share of the weight all the same, as the first of all.
    after = Window.partitionBy("key").orderBy(F.desc("n"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = bag.join(mixed, "shingle").withColumn("rest", F.sum("weight").over(after))
    # A little less, as sums are rounded.
    kept = rows.filter(F.col("rest") >= F.col("total") * (least * (1 - 1e-9)))
    return kept.select("key", "class", "shingle", "rest", "total")


def possible(texts: DataFrame, label: DataFrame, factor: np.ndarray, least: float, written: Written) -> DataFrame:
    """(key, rep) of all pairs of different classes among `texts` (key, text) that can be similar, each pair once."""
    told = texts.join(label, "key", "left").select("key", F.coalesce("label", "key").alias("class"), "text")
    rows = written(prefixes(told, factor, least, written), "prefixes")
    # From pairs of classes, so that no pairs within a class are made. From the first common shingle on, both texts have to hold
    # what similar texts have in common; no two of the classes can if the best of each cannot.
    common = least / (1 + least) * (1 - 1e-9)
    sets = rows.groupBy("shingle", "class").agg(
        F.max("rest").alias("most"), F.min("total").alias("low"), F.max("total").alias("high")
    )
    others = sets.select("shingle", *(F.col(c).alias(f"other_{c}") for c in ("class", "most", "low", "high")))
    of = sets.join(others, "shingle").filter(
        (F.col("class") < F.col("other_class"))
        & (F.least("most", "other_most") >= (F.col("low") + F.col("other_low")) * common)
        & (F.col("high") >= F.col("other_low") * (least * (1 - 1e-9)))
        & (F.col("other_high") >= F.col("low") * (least * (1 - 1e-9)))
    )
    of = of.select("shingle", "class", "other_class", "other_most", "other_low")
    mine = of.join(rows, ["shingle", "class"]).filter(
        F.least("rest", "other_most") >= (F.col("total") + F.col("other_low")) * common
    )
    other = rows.select("shingle", *(F.col(c).alias(f"other_{c}") for c in ("class", "key", "rest", "total")))
    enough = F.least("rest", "other_rest") >= (F.col("total") + F.col("other_total")) * common
    pairs = mine.join(other, ["shingle", "other_class"]).filter(enough)
    return pairs.select("key", F.col("other_key").alias("rep")).distinct()


def contracted(links: DataFrame, written: Written) -> DataFrame:
    """(key, label) of every key in `links` (key, rep): the smallest key of its component. Alternating stars."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        u, v = F.col("u"), F.col("v")
        around = edges.union(edges.select(v.alias("u"), u.alias("v"))) if large else edges
        least = around.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        joined = around.join(least, "u")
        out = joined.filter(v > u).select(v.alias("u"), F.col("m").alias("v")) if large else joined.select(
            v.alias("u"), F.col("m").alias("v")
        ).union(least.select("u", F.col("m").alias("v")))
        return out.filter("u != v")

    def stars(edges: DataFrame) -> bool:
        """Whether every key has one edge at most to a smaller one, and none if it has edges to larger ones."""
        ends = edges.select(F.col("u").alias("key"), F.lit(1).alias("out"), F.lit(0).alias("in"))
        ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
        open_ = ends.groupBy("key").agg(F.sum("out").alias("out"), F.max("in").alias("in")).filter("out + in > 1")
        return open_.agg(F.count(F.lit(1))).first()[0] == 0

    # Every edge goes from the larger key to the smaller. Each round is a plan of its own, which the driver keeps something of:
    # there is none more than needed, and none at all for links that are stars.
    edges = written(links.select(F.greatest("key", "rep").alias("u"), F.least("key", "rep").alias("v")).distinct(), "edges")
    while not stars(edges):
        edges = written(star(star(edges, True), False).distinct(), "edges")
    return edges.select(F.col("u").alias("key"), F.col("v").alias("label"))


def key_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def labels(documents: DataFrame, written: Written, least: float = SIMILARITY) -> DataFrame:
    """(key, label) of every text that is linked with a different one."""
    texts = documents.select(F.col("text"), key_of(F.col("text")).alias("key"))
    factor = frequencies(documents)
    met = slots(texts, factor).distinct()
    left = written(met.join(met.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "slot", "left_semi"), "slots")
    needed = left.select("key").distinct()
    # Of copies, one text. Those that meet no other are left out.
    held = written(texts.join(needed, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "texts")
    links = None
    label = written(needed.filter("false").select("key", F.col("key").alias("label")), "none")

    def linked(asked: DataFrame, links: DataFrame | None, label: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """Links and classes after the pairs (key, rep) in `asked` were compared."""
        second = held.select(F.col("key").alias("rep"), F.col("text").alias("second"))
        words = asked.join(second, "rep").join(held, "key").select(
            "key", "rep", hashes_of(F.col("text")).alias("mine"), hashes_of(F.col("second")).alias("other")
        )
        found = written(similar(words, factor, least), "found")
        if not found.isEmpty():
            links = written(found if links is None else label.select("key", F.col("label").alias("rep")).union(found), "links")
            label = contracted(links, written)
        return links, label

    for turn in range(THOROUGH):
        # The smallest key first, which is the same in most slots of a class, then several in an order of each slot.
        order = [F.xxhash64("slot", "key", F.lit(turn))] if turn else []
        place = F.row_number().over(Window.partitionBy("slot").orderBy(*order, "key"))
        told = left.join(label, "key", "left").select("slot", "key", F.coalesce("label", "key").alias("class"))
        reps = told.withColumn("place", place).filter(F.col("place") <= (REPS if turn else 1))
        reps = written(reps.select("slot", F.col("key").alias("rep"), F.col("class").alias("rep_class")), "reps")
        if reps.isEmpty():
            return label
        pairs = told.join(reps, "slot").filter("class != rep_class")
        asked = written(pairs.select("key", "rep").distinct(), "pairs")
        if not asked.isEmpty():
            links, label = linked(asked, links, label)
        # Those that the others were compared with leave.
        met = reps.select("slot", F.col("rep").alias("key"))
        after = left.join(met, ["slot", "key"], "left_anti").join(label, "key", "left")
        after = written(after.select("slot", "key", F.coalesce("label", "key").alias("class")), "after")
        open_ = after.groupBy("slot").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high")
        left = written(after.join(open_, "slot", "left_semi").select("key", "slot"), "left")
    rest = held.join(left.select("key").distinct(), "key", "left_semi")
    asked = written(possible(rest, label, factor, least, written), "asked")
    return label if asked.isEmpty() else linked(asked, links, label)[1]


def classes(documents: DataFrame, written: Written, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, `key` of its text, and class_id. `documents` needs doc_id and text."""
    own = Written(documents.sparkSession, written.label)
    label = labels(documents.select("doc_id", "text"), own, least)
    rows = documents.select("doc_id", key_of(F.col("text")).alias("key"))
    texts = rows.groupBy("key").agg(F.min("doc_id").alias("least"))
    told = texts.join(label, "key", "left").select("key", "least", F.coalesce("label", "key").alias("label"))
    told = written(told, "told")
    own.remove()
    of_label = told.groupBy("label").agg(F.min("least").alias("class_id"))
    of_key = told.join(of_label, "label").select("key", "class_id")
    return rows.join(of_key, "key").select("doc_id", "key", "class_id")


def one_each(documents: DataFrame, written: Written) -> DataFrame:
    """The documents of smallest doc_id of every class, one row each; all columns. Rows without an id stay, once a text."""
    told = classes(documents, written)
    kept = told.filter("doc_id <=> class_id").groupBy("doc_id", "class_id").agg(F.min("key").alias("key"))
    loose = told.filter("class_id IS NULL").groupBy("key").agg(F.first("doc_id").alias("doc_id"))
    wanted = kept.filter("doc_id IS NOT NULL").select("doc_id", "key").union(loose.select("doc_id", "key"))
    wanted = wanted.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == key_of(F.col("text")))
    return documents.join(wanted, same).dropDuplicates(["__id", "__key"]).select(
        *(F.col(f"`{name}`") for name in documents.columns)
    )
