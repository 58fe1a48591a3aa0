"""WARC archives: written with an index of byte ranges, and read back by coalesced ranges.

A page is a `response` record, or a `revisit` of the page with the smallest id whose payload is the same, if that has at
least `LEAST` bytes. Records go to archives of about `ARCHIVE_BYTES`, dealt by a hash. Two line breaks end a record in this
format, so Spark's text writer, with those for a line separator, writes the files, commits them as a whole and writes them
anew when an executor is lost. The index has archive, offset, length, page id, URL and digest of every record. Readers take
any part of it, sort it by place and merge ranges that lie close to each other into one read.

Defined cases: a null html is an empty payload; a null url is an empty one, and line breaks in a URL are percent-encoded;
a null page id is never the smallest one of a group that has others; rows with the same id and payload are all responses, or
all revisits of a smaller id; an empty table gives an index without rows. Only the named columns are read, whatever else
there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.shared import Written, in_arrow, once

LEAST = 100
ARCHIVE_BYTES = 32 << 20
# Payloads of several pages that are known to all tasks, of about a hundred bytes each; more are joined by a shuffle.
MOST_BROADCAST = 100_000
GAP = 64 << 10
SPAN = 8 << 20
DATE = "2000-01-01T00:00:00Z"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Archives:
    folder: str
    index: DataFrame


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and bytes of every page."""
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    page = F.col("page_id").cast("long").alias("page_id")
    return pages.select(page, url.alias("url"), once(html).alias("html")).select(
        "*", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.octet_length("html").cast("long").alias("bytes")
    )


def copies(told: DataFrame) -> DataFrame:
    """copied, first: payloads of several pages, and the smallest id among these."""
    return (
        told.filter(F.col("bytes") >= LEAST)
        .groupBy(F.col("digest").alias("copied"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("copied", "first")
    )


def referring(pages: DataFrame, copied: DataFrame) -> DataFrame:
    """`pages` with refers_to, null for responses."""
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(copied, F.col("digest") == F.col("copied"), "left").withColumn("refers_to", other).drop("copied", "first")


def header() -> Column:
    """Everything of a record before the payload."""
    named = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda value: F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    size = F.when(revisit, F.lit(0)).otherwise(F.col("bytes") + len(HTTP))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        named("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        named("WARC-Record-ID", urn(F.col("page_id"))),
        named("WARC-Date", F.lit(DATE)),
        named("WARC-Target-URI", F.col("url")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        named("Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit, F.concat(named("WARC-Refers-To", urn(F.col("refers_to"))), named("WARC-Profile", F.lit(PROFILE)))
        ).otherwise(F.lit("")),
        named("Content-Type", F.lit("application/http; msgtype=response")),
        named("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.lit(HTTP)),
    )


PACKED = "archive int, page_id long, url string, digest string, refers_to long, bytes long, size long, payload binary"


def compressed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads as Zstandard frames, and in `size` how long they are."""
    codec = pa.Codec("zstd", compression_level=9)
    for batch in batches:
        payload = batch.column("payload")
        sizes = pc.binary_length(payload).cast(pa.int64())
        frames = pa.array([codec.compress(one.as_buffer(), asbytes=True) for one in payload], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in NAMES[:-2]), sizes, frames], names=NAMES)


def decompressed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The payloads again, in parts that stay far below what a column holds."""
    for batch in batches:
        at, sizes = 0, batch.column("size").to_pylist()
        while at < len(sizes):
            end, held = at, 0
            while end < len(sizes) and (end == at or held + sizes[end] <= SPAN):
                held += sizes[end]
                end += 1
            some = batch.slice(at, end - at)
            texts = [pa.decompress(one.as_buffer(), n, "zstd", asbytes=True) for one, n in zip(some.column("payload"), sizes[at:end], strict=True)]
            yield pa.RecordBatch.from_arrays([*(some.column(name) for name in NAMES[:-1]), pa.array(texts, pa.binary())], names=NAMES)
            at = end


NAMES = [part.split(" ")[0] for part in PACKED.split(", ")]


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> Archives:
    """Write archives to `folder`/archives and the index to `folder`/index. `pages` needs page_id, url and html."""
    spark: SparkSession = pages.sparkSession
    written = Written(spark, "warc")
    # What the records are made of but the payloads, which cross the network once, compressed, to their archives.
    told = written(digested(pages).drop("html"), "pages")
    copied = written(copies(told), "copies")
    if copied.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        copied = F.broadcast(copied)
    total = told.agg(F.sum("bytes")).first()[0] or 0
    count = max(spark.sparkContext.defaultParallelism, -(-total // archive_bytes))
    order = ["page_id", "url", "digest"]

    def records(rows: DataFrame, *more: Column) -> DataFrame:
        archive = F.pmod(F.xxhash64(*order), F.lit(count)).cast("int").alias("archive")
        return referring(rows, copied).select(archive, *order, "refers_to", "bytes", *more)

    payload = F.when(F.col("refers_to").isNull(), F.col("html")).otherwise(F.lit(""))
    held = records(digested(pages), F.lit(0).cast("long").alias("size"), F.encode(payload, "UTF-8").alias("payload"))
    packed = in_arrow(held, compressed, PACKED).repartition(count, "archive")
    texts = in_arrow(packed, decompressed, PACKED).select("archive", *order, header().alias("header"), F.decode("payload", "UTF-8").alias("payload"))
    texts.sortWithinPartitions("archive", *order).select("archive", F.concat("header", "payload").alias("value")).write.option(
        "lineSep", END
    ).option("compression", "none").partitionBy("archive").text(f"{folder}/archives")

    place = Window.partitionBy("archive").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(F.lit(0))
    sizes = records(told).select("archive", *order, (F.octet_length(header()) + held).cast("long").alias("length"))
    ends = F.coalesce(F.sum(F.col("length") + len(END)).over(place), F.lit(0).cast("long"))
    placed = sizes.select("archive", ends.alias("offset"), "length", *order)
    if total or placed.take(1):
        files = spark.read.format("binaryFile").load(f"{folder}/archives").select("archive", "path")
    else:
        files = spark.createDataFrame([], "archive int, path string")
    placed.join(files, "archive").select("path", "offset", "length", *order).sortWithinPartitions(
        "path", "offset"
    ).write.parquet(f"{folder}/index")
    written.remove()
    return Archives(folder, spark.read.schema("path string, offset long, length long, page_id long, url string, digest string").parquet(f"{folder}/index"))


def merged(ranges: list[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last) of each read for ranges (offset, length) sorted by offset; last is exclusive."""
    reads: list[tuple[int, int, int, int]] = []
    for k, (offset, length) in enumerate(ranges):
        if reads:
            start, end, first, _ = reads[-1]
            if offset - end <= gap and offset + length - start <= span:
                reads[-1] = (start, max(end, offset + length), first, k + 1)
                continue
        reads.append((offset, offset + length, k, k + 1))
    return reads


# Names that Spark's file systems have and pyarrow's have not.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
HEADER = re.compile(rb"([A-Za-z-]+): (.*)")


def parsed(record: bytes) -> tuple:
    """page id, payload (None for a revisit), its length and digest, type and refers_to of a record."""
    head, _, block = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    fields = {m[1].decode(): m[2].decode() for m in map(HEADER.fullmatch, lines) if m}
    if version != b"WARC/1.1" or len(block) != int(fields["Content-Length"]):
        raise ValueError("the index does not point to a record")
    number = lambda name: int(found[0]) if (found := re.findall(r"-?\d+", fields.get(name, ""))) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return number("WARC-Record-ID"), payload, int(fields["Payload-Length"]), digest, fields["WARC-Type"], number("WARC-Refers-To")


def place_of(path: str) -> tuple:
    """The file system of pyarrow and the path in it of a file that Spark names, which writes no character of it in another way."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    scheme, _, inside = path.partition(":")
    if scheme == "file" or not inside:
        return LocalFileSystem(), "/" + (inside or path).lstrip("/")
    return FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{quote(inside, safe="/:@=")}")


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that `index`, or any part of one, points to. Payloads of responses are checked against their digests.

    Files are opened through pyarrow, so `path` may be on any file system it knows: local, s3 (also named s3a), gs and hdfs.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, some in frame.groupby("path", sort=False):
                system, inside = place_of(path)
                ranges = list(zip(some.offset.tolist(), some.length.tolist(), strict=True))
                with system.open_input_file(inside) as file:
                    for start, end, first, last in merged(ranges):
                        data = file.read_at(end - start, start)
                        rows = [parsed(data[o - start : o - start + n]) for o, n in ranges[first:last]]
                        out = pd.DataFrame(rows, columns=names)
                        out["page_id"], out["refers_to"] = out.page_id.astype("Int64"), out.refers_to.astype("Int64")
                        if not with_payload:
                            out["payload"] = None
                        yield out

    names = ["page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = (
        "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
    ranges = index.select("path", "offset", "length").withColumn("part", F.floor(F.col("offset") / SPAN))
    sorted_ranges = ranges.repartition("path", "part").sortWithinPartitions("path", "offset")
    return sorted_ranges.select("path", "offset", "length").mapInPandas(run, schema)
