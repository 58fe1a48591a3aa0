"""Collocations: frequent phrases scored by their weakest cut, mined by top-order marginalisation.

A text has pieces (between the marks of `ENDS` and line breaks) and these have words. Lead columns put next to every word the
words that follow it in its piece, padded at the end of the piece. Only these longest windows, of five words, are counted;
every occurrence of a shorter phrase begins one window, so ROLLUP over the counted windows sums the phrases of five, four,
three, two words and one.

No phrase is more frequent than a phrase in it. A window therefore ends before a word, a pair or a triple that is too rare, and none
begins at a rare word. Which are too rare is found beforehand from sums over short hashes, a few bytes each, and kept in
tables of bits of bounded size. Hashes may meet, and then something rare passes; nothing frequent is ever missed,
and what passes is judged by its exact sums from the windows.

Windows and hashes are counted in bounded tables inside the tasks before they are shuffled, so a phrase that holds a third of
the corpus is a few rows. Joins are between frequent phrases only.

Defined cases: a null or empty text has no words; a null language is `und`; only A-Z are lower-cased; equal rows count each; an
empty table gives an empty result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.shared import Written, in_arrow

LONGEST = 5
LEAST = 100
COVERED_PERCENT = 100
TOP = 2000
# What ends a piece, and what stands between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

CHUNK_BYTES = 4 << 20
KEPT_WORDS = 400_000
KEPT_WINDOWS = 600_000
KEPT_HASHES = 1_500_000
MOST_LANGUAGES = 10_000
HASH_BITS = 40
MOST_BITS = 1 << 27
BITS_EACH = 32
BITMAP_BITS = 32_768  # of one row of Spark's bitmap aggregate
TASKS_A_CORE = 2
FILTERED = 3  # rare phrases of up to so many words are found beforehand

TABLE = bytes(10 if byte in ENDS else 32 if byte in BLANKS else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
END, LEFT_OUT = 0, -1


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of phrases, from those of all but their last words and those of the last words."""
    both = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + np.uint64(0x632BE59BD9B4E019))
    both = (both ^ (both >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return both ^ (both >> np.uint64(32))


class Counts:
    """What one task has counted of one language: hashes of phrases of `order` words, or windows for an `order` of None.

    `tables` hold the bits of what may be frequent, of one word, two words and so on.
    """

    def __init__(self, lang: str, order: int | None, longest: int, tables: list[np.ndarray]):
        from xxhash import xxh64_intdigest

        self.lang, self.order, self.longest, self.tables = lang, order, longest, tables
        self.digest, self.seed = xxh64_intdigest, xxh64_intdigest(lang.encode())
        self.clear()

    def clear(self) -> None:
        self.number = {b"\n": END, b"": LEFT_OUT}
        self.words: list[bytes] = [b""]
        self.hashes = array("Q", [0])
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.total = 0

    def numbers(self, data: bytes) -> np.ndarray:
        """The numbers of all words. Equal words are found by Arrow, so each is looked up once. Words that the tables tell to be rare
        end a phrase as the end of a piece does, and are not kept."""
        split = pc.split_pattern(pa.array([data.replace(b"\n", b" \n ")], pa.large_binary()), b" ")
        words = split.values.dictionary_encode()
        different = words.dictionary.to_pylist()
        number, digest, seed = self.number, self.digest, self.seed
        new = [word for word in different if word not in number]
        hashes = np.array([digest(word, seed) for word in new], np.uint64)
        if self.order != 1:
            kept = np.flatnonzero(self.told(1, hashes))
            new, hashes = [new[at] for at in kept.tolist()], hashes[kept]
        number.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
        self.words += new
        self.hashes.frombytes(hashes.tobytes())
        numbers = np.array([number.get(word, END) for word in different], np.int32)[words.indices.to_numpy()]
        return numbers[numbers != LEFT_OUT]

    def told(self, order: int, hashes: np.ndarray) -> np.ndarray:
        table = self.tables[order - 1]
        at = (hashes & np.uint64(len(table) * 8 - 1)).astype(np.int64)
        return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def add(self, data: bytes) -> None:
        """Count whole pieces, lower-cased, with line feeds between them and single kinds of blanks."""
        numbers = np.concatenate([self.numbers(data), np.zeros(self.longest, np.int32)])
        size = len(numbers) - self.longest
        self.total += int(np.count_nonzero(numbers))
        of_word = np.array(self.hashes, np.uint64)
        hashes, inside = of_word[numbers], numbers != END
        frequent = []
        for order in range(1, self.order or len(self.tables) + 1):
            if order > 1:
                hashes = mixed(hashes[:-1], of_word[numbers[order - 1 :]])
                inside = frequent[-1][:-1] & frequent[-1][1:]
            found = inside.copy()
            found[inside] = self.told(order, hashes[inside])
            frequent.append(found)
        if self.order is None:
            self.add_windows(numbers, size, frequent)
            return
        if self.order > 1:
            hashes = mixed(hashes[:-1], of_word[numbers[self.order - 1 :]])
            inside = frequent[-1][:-1] & frequent[-1][1:]
        keys = hashes[inside] & np.uint64((1 << HASH_BITS) - 1)
        self.keep(*np.unique(keys.astype(np.int64), return_counts=True))

    def add_windows(self, numbers: np.ndarray, size: int, frequent: list[np.ndarray]) -> None:
        begins = np.flatnonzero(frequent[0][:size])
        columns, inside = [numbers[begins]], np.ones(len(begins), bool)
        for k in range(1, self.longest):
            # The last words of the window that a table knows of, up to the one that is now put in.
            known = min(k, len(frequent) - 1)
            inside &= frequent[known][begins + k - known]
            columns.append(np.where(inside, numbers[begins + k], END))
        self.keep(*summed(np.stack(columns, 1), np.ones(len(begins), np.int64)))

    def keep(self, found: np.ndarray, counts: np.ndarray) -> None:
        self.counted.append((found, counts))
        self.size += len(counts)
        if self.size > self.most() and len(self.counted) > 1:
            self.together()

    def most(self) -> int:
        return KEPT_WINDOWS if self.order is None else KEPT_HASHES

    def together(self) -> None:
        if not self.size:
            return
        found, counts = (np.concatenate(parts) for parts in zip(*self.counted, strict=True))
        if self.order is None:
            found, counts = summed(found, counts)
        else:
            found, at = np.unique(found, return_inverse=True)
            counts = np.bincount(at, counts, len(found)).astype(np.int64)
        self.counted, self.size = [(found, counts)], len(counts)

    def full(self) -> bool:
        return self.size > self.most() or len(self.words) > KEPT_WORDS

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """What was counted, which is then forgotten."""
        self.together()
        if self.size:
            found, counts = self.counted[0]
            for at in range(0, len(counts), 100_000):
                some, n = found[at : at + 100_000], pa.array(counts[at : at + 100_000])
                if self.order is None:
                    yield pa.RecordBatch.from_arrays([*self.spelled(some), n], names=names)
                else:
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.array(some), n], names=names)
        if self.order == 1 and self.total:
            yield pa.RecordBatch.from_arrays([pa.array([self.lang]), pa.nulls(1, pa.int64()), pa.array([self.total])], names=names)
        self.clear()

    def spelled(self, windows: np.ndarray) -> list[pa.Array]:
        words = pa.array([None, *(word.decode() for word in self.words[1:])], pa.string())
        lang = pa.array([self.lang]).take(pa.array(np.zeros(len(windows), np.int32)))
        return [lang, *(words.take(pa.array(windows[:, k])) for k in range(self.longest))]


def summed(windows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different windows, and the sums of their counts."""
    if not len(windows):
        return windows, counts
    order = np.lexsort(windows.T[::-1])
    windows, counts = windows[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (windows[1:] != windows[:-1]).any(1)]))
    return windows[first], np.add.reduceat(counts, first)


def chunks(data: bytes) -> Iterator[bytes]:
    """`data` in parts of about CHUNK_BYTES that end where a piece does."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        end = data.find(b"\n", start + CHUNK_BYTES)
        if end < 0:
            break
        yield data[start:end]
        start = end + 1
    yield data[start:]


def counted(documents: DataFrame, order: int | None, longest: int, tables: list) -> DataFrame:
    """Counts of all texts; each in one row or a few, as tasks count by themselves.

    With an `order`, hash and n of the phrases of so many words in which no shorter one is rare by the broadcast `tables`; and for an
    order of one, rows with lang and n of all its words. Without, lang, w1 to w`longest` and n of the windows.
    """
    names = ["lang", *(f"w{k}" for k in range(1, longest + 1)), "n"] if order is None else ["lang", "hash", "n"]
    kinds = {"n": "long", "hash": "long"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(table.value, np.uint8) for table in tables]
        counts: dict[str, Counts] = {}
        gathered: dict[str, list[bytes]] = {}

        def count(lang: str) -> Iterator[pa.RecordBatch]:
            of_lang = counts.get(lang)
            if of_lang is None:
                of_lang = counts[lang] = Counts(lang, order, longest, bits)
            for chunk in chunks(b"\n".join(gathered.pop(lang))):
                of_lang.add(chunk)
                if of_lang.full():
                    yield from of_lang.batches(names)
            # All languages together stay within the bounds of one. What is equal is summed before it is given away.
            over = sum(len(one.words) for one in counts.values()) > KEPT_WORDS
            if sum(one.size for one in counts.values()) > of_lang.most():
                for one in counts.values():
                    one.together()
                over = over or sum(one.size for one in counts.values()) > of_lang.most() // 2
            if over:
                for one in counts.values():
                    yield from one.batches(names)
                counts.clear()

        waiting = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                data = text.as_py().encode().translate(TABLE)
                gathered.setdefault(lang, []).append(data)
                waiting += len(data)
                if waiting >= CHUNK_BYTES:
                    for one in list(gathered):
                        yield from count(one)
                    waiting = 0
        for one in list(gathered):
            yield from count(one)
        for one in counts.values():
            yield from one.batches(names)

    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL")
    if order is None:
        # Every task makes a row of each frequent window, so more tasks than the cores can use would only make more rows.
        texts = texts.coalesce(TASKS_A_CORE * documents.sparkSession.sparkContext.defaultParallelism)
    return in_arrow(texts, run, ", ".join(f"{name} {kinds.get(name, 'string')}" for name in names))


def bits_of(hashes: DataFrame) -> bytes:
    """A table with the bits of all rows of `hash`, MOST_BITS at most (16 MB)."""
    bits, rows = BITMAP_BITS, hashes.count()
    while bits < min(rows * BITS_EACH, MOST_BITS):
        bits *= 2
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1  # Spark's bitmaps count from one
    parts = (
        hashes.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap"))
        .collect()  # bits / 8 bytes
    )
    table = bytearray(bits // 8)
    for bucket, bitmap in parts:
        at = (bucket - 1) * (BITMAP_BITS // 8)
        table[at : at + BITMAP_BITS // 8] = bitmap
    return bytes(table)


def rolled(windows: DataFrame, longest: int) -> DataFrame:
    """lang, w1 to w`longest`, n: sums over the windows that begin alike. A shorter phrase has nulls after its words."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    sums = windows.sparkSession.sql(
        f"""SELECT lang, {", ".join(names)}, sum(n) AS n, grouping_id() AS shorter FROM {{windows}}
        GROUP BY lang, w1, ROLLUP ({", ".join(names[1:])})""",
        windows=windows,
    )
    # A null that was summed over is marked in `shorter`; one that is not is the padding of a window that ends earlier.
    padded = F.lit(False)
    for k, name in enumerate(reversed(names[1:])):
        padded = padded | (F.col(name).isNull() & (F.shiftright("shorter", k).bitwiseAND(F.lit(1)) == 0))
    return sums.filter(~padded).drop("shorter")


def frequent_phrases(documents: DataFrame, written: Written, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, k, f of all phrases of up to `longest` words seen `least` times, as a table.

    A row with k = 0 has the number of all words of a language.
    """
    context, own = documents.sparkSession.sparkContext, Written(documents.sparkSession, written.label)
    names = [f"w{k}" for k in range(1, longest + 1)]
    tables, totals = [], None
    for order in range(1, min(FILTERED, longest) + 1):
        sums = counted(documents, order, longest, tables).groupBy("lang", "hash").agg(F.sum("n").alias("n"))
        sums = own(sums.filter((F.col("n") >= least) | F.col("hash").isNull()), f"hashes{order}")
        tables.append(context.broadcast(bits_of(sums.filter("hash IS NOT NULL").select("hash"))))
        totals = totals or sums.filter("hash IS NULL")
    sums = rolled(counted(documents, None, longest, tables), longest).filter(F.col("n") >= least)
    size = sum((F.col(name).isNotNull().cast("int") for name in names), F.lit(0))
    phrases = sums.select("lang", F.concat_ws(" ", *names).alias("phrase"), size.alias("k"), F.col("n").alias("f"))
    every = phrases.unionByName(totals.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("k"), F.col("n").alias("f")))
    found = written(every, "phrases")
    own.remove()
    return found


def joined(words: Column) -> Column:
    return F.concat_ws(" ", words)


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, n, score of all phrases of two words or more; the cut with the lowest score counts."""
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = phrases.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), cut)
    words = F.split("phrase", " ")
    parts = cuts.select(
        "*",
        joined(F.slice(words, F.lit(1), F.col("cut"))).alias("left"),
        joined(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("right"),
    )
    known = phrases.filter("k > 0")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    totals = phrases.filter("k = 0").select("lang", F.col("f").alias("n"))
    if totals.limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES:
        totals = F.broadcast(totals)
    # Below 10^17 words the products fit: 38 digits above, 34 below the line.
    score = F.expr("""CAST(1000 * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)) AS DECIMAL(38, 0))
        div (CAST(l AS DECIMAL(17, 0)) * CAST(r AS DECIMAL(17, 0)))""")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return (
        parts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "k", "a", "n")
        .agg(best)
        .select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score")
    )


def uncovered(candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Those that lie in no longer candidate which is about as frequent.

    It is enough to look at candidates longer by one word: what lies between two candidates is a candidate, and at least as
    frequent as the longer.
    """
    words = F.split("phrase", " ")
    ends = F.array(joined(F.slice(words, F.lit(1), F.col("k") - 1)), joined(F.slice(words, F.lit(2), F.col("k") - 1)))
    covers = (
        candidates.filter("k > 2")
        .select("lang", F.explode(ends).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = candidates.join(covers, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def mine(documents: DataFrame, written: Written, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the `top` collocations of each language; all for None."""
    kept = uncovered(scored(frequent_phrases(documents, written, least, longest)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
