"""Secret scans: candidates judged by how many owners and repositories of the corpus hold them.

Native: DataFrame functions only.

Candidates are the matches of three base patterns and long mixed tokens. Hashes of their values are counted over the whole
corpus by distinct repository and owner; copies of one text count as one holder, whoever has them. A value is a copied example
when more than `MAX_OWNERS` owners hold it, or more than `FEW_OWNERS` in more than `MAX_REPOSITORIES` repositories; any other
that looks random is taken for live. What unrelated owners hold does not matter, so the verdict on a value does not change
with the rest of the corpus. Base matches are always reported, with their counts; tokens only if live and in no base match.

Defined cases: a null text counts as empty; a null owner or repository is one of its own; repeated rows are scanned each,
and count once as holders; empty tables give empty results. Spans are code points, end exclusive. Only the named columns are
read, whatever else there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.shared import Written, once

# The patterns of the contract. The shorter matches of `access` and `hex` would be dropped afterwards, and
# as runs are matched whole, asking for the least length at once finds the same.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Ours: what tokens of services have in common, a long run with digits and both cases.
TOKEN = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9A-Z_-]*[a-z])(?=[0-9a-z_-]*[A-Z])[A-Za-z0-9_-]{20,}"
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))
BASE = ("assign", "access", "hex")
PLACEHOLDER = r"(?i)example|sample|changeme|placeholder|your[_-]|xxxx|(.)\1{7}"
# Ours: a team shares a credential among few owners, however many repositories they have; what more than this many write in
# different texts is public. Some owners who repeat it in very many repositories spread an example, too.
MAX_OWNERS = 5
FEW_OWNERS = 2
MAX_REPOSITORIES = 50
CHUNK = 4_096  # code points
BLOCK = 512
SPAN = "array<struct<at:int,value:string>>"


def pieces(text: Column, pattern: str) -> Column:
    """(text before, match) of every match of a text that has one."""
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )
    return F.when(text.rlike(pattern), F.slice(zipped, 1, F.size(zipped) - 1))


def spans(found: Column) -> Column:
    """(start, match) of every piece. Running sums over blocks of pieces, so that many matches do not take square time."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(found, k * BLOCK + 1, F.lit(BLOCK)),
    )
    width = lambda p: F.length(p["gap"]) + F.length(p["value"])
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, p: total + width(p)))
    starts = F.aggregate(
        sums,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        lambda s: s["out"],
    )
    placed = F.zip_with(
        blocks,
        starts,
        lambda block, start: F.aggregate(
            block,
            F.struct(start.alias("at"), F.array().cast(SPAN).alias("out")),
            lambda s, p: F.struct(
                (s["at"] + width(p)).alias("at"),
                F.concat(
                    s["out"], F.array(F.struct((s["at"] + F.length(p["gap"])).alias("at"), p["value"].alias("value")))
                ).alias("out"),
            ),
            lambda s: s["out"],
        ),
    )
    return F.when(found.isNull(), F.array().cast(SPAN)).otherwise(F.flatten(placed))


def candidates(documents: DataFrame) -> DataFrame:
    """One row per document with `spans`, an array of (start, kind, end, value hash, whether the value looks live)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = documents.select(
        "doc_id",
        "owner",
        "repository",
        F.xxhash64(text).alias("copy"),
        once(F.struct(*(pieces(text, pattern).alias(kind) for kind, pattern in KINDS))).alias("found"),
    )

    def described(kind: int, name: str) -> Column:
        def one(span: Column) -> Column:
            secret = F.regexp_extract(span["value"], ASSIGN, 2) if name == "assign" else span["value"]
            return F.struct(
                span["at"].alias("start"),
                F.lit(kind).alias("kind"),
                (span["at"] + F.length(span["value"])).alias("end"),
                F.xxhash64(secret).alias("hash"),
                ((F.length(secret) >= 16) & secret.rlike("[0-9]") & secret.rlike("[A-Za-z]") & ~secret.rlike(PLACEHOLDER)).alias(
                    "random"
                ),
            )

        rows = spans(F.col(f"found.{name}"))
        if name == "assign":
            rows = F.filter(rows, lambda span: F.length(F.regexp_extract(span["value"], ASSIGN, 2)) >= 6)
        return F.transform(rows, one)

    every = found.select(
        "doc_id",
        "owner",
        "repository",
        "copy",
        once(F.struct(*(described(k, name).alias(name) for k, (name, _) in enumerate(KINDS)))).alias("s"),
    )
    tokens = F.filter(F.col("s.token"), lambda t: t["random"])
    return every.select("doc_id", "owner", "repository", "copy", F.concat(*(F.col(f"s.{name}") for name in BASE), tokens).alias("spans"))


def uncovered(each: DataFrame) -> DataFrame:
    """The spans `each` (row, kind, start, end and more) without tokens that lie in a base match, by one sweep over each row."""
    sweep = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.when(F.col("kind") < len(BASE), F.col("end"))).over(sweep)
    inside = (F.col("kind") >= len(BASE)) & F.coalesce(F.col("end") <= F.col("reached"), F.lit(False))
    return each.withColumn("reached", reached).filter(~inside).drop("reached")


def scan(
    documents: DataFrame,
    written: Written,
    max_owners: int = MAX_OWNERS,
    few_owners: int = FEW_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Every document with its spans: `spans` is an array of (start, kind, end, owners, repositories, live, copied), sorted.

    `documents` needs doc_id, text, owner and repository. `written` keeps the candidates, which are small, so that the
    texts are scanned once; its tables may be removed once the result has been read.
    """
    named = documents.select(
        "doc_id",
        "text",
        F.coalesce(F.col("owner").cast("string"), F.lit("\0")).alias("owner"),
        F.coalesce(F.col("repository").cast("string"), F.lit("\0")).alias("repository"),
    )
    rows = written(candidates(named).withColumn("row", F.monotonically_increasing_id()), "candidates")
    spans_of = rows.select("row", "owner", "repository", "copy", F.explode("spans").alias("span"))
    each = written(uncovered(spans_of.select("row", "owner", "repository", "copy", "span.*")), "spans")
    # Distinct first, so that a value a third of all documents hold is one row per text and task.
    holders = each.groupBy("hash", "copy").agg(F.min(F.struct("owner", "repository")).alias("holder"))
    holders = holders.select("hash", "holder.owner", "holder.repository").distinct()
    owners = holders.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    held = owners.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))
    copied = (F.col("owners") > max_owners) | ((F.col("owners") > few_owners) & (F.col("repositories") > max_repositories))
    live = F.col("random") & ~copied
    judged = (
        each.join(held, "hash")
        .filter((F.col("kind") < len(BASE)) | live)
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", live.alias("live"), copied.alias("copied")))
            ).alias("spans")
        )
    )
    nothing = F.array().cast(judged.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(judged, "row", "left").select(
        "row", "doc_id", F.coalesce("spans", nothing).alias("spans")
    )


def joined(found: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*(F.lit(name) for name, _ in KINDS))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def grouped(found: DataFrame, key: str) -> DataFrame:
    """`key` and `groups`, the sorted (start, end) of its spans, those that overlap being one. `found` has a row per span."""
    order = Window.partitionBy(key).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(F.col("start") < F.col("before"), 0).otherwise(1)
    counted = found.select(key, "start", "end").withColumn("before", before).withColumn("group", F.sum(first).over(order))
    groups = counted.groupBy(key, "group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return groups.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("groups"))


def chunked(text: Column) -> Column:
    """The text in chunks of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def masked(chunks: Column, groups: Column, mask: str = "[SECRET]") -> Column:
    """The text in `chunks`, a column of its own, with every group replaced by `mask`. Time grows with text and groups."""

    def between(start: Column, end: Column) -> Column:
        first, last = (F.floor(at / CHUNK).cast("int") for at in (start, end))
        head = F.coalesce(F.get(chunks, first), F.lit(""))
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.coalesce(F.get(chunks, last), F.lit("")).substr(F.lit(1), end - last * CHUNK)
        within = head.substr(start - first * CHUNK + 1, end - start)
        return F.when(first == last, within).otherwise(
            F.concat(head.substr(start - first * CHUNK + 1, F.lit(CHUNK)), inner, tail)
        )

    ended = lambda i: F.coalesce(F.get(groups, i - 1)["end"], F.lit(0))
    parts = F.transform(groups, lambda group, i: F.concat(between(ended(i), group["start"]), F.lit(mask)))
    size = F.greatest(F.size(chunks) - 1, F.lit(0)) * CHUNK + F.coalesce(F.length(F.get(chunks, F.size(chunks) - 1)), F.lit(0))
    return F.concat(F.array_join(parts, ""), between(ended(F.size(groups)), size))


def counts(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
    )
