"""Secret scan with corpus-wide ownership frequency, by DataFrame functions only.

Candidates are values of assignments, access keys, long hexadecimal runs, and any token of 20 or more signs
that mixes letters and digits. Each value is hashed; over the whole corpus a hash is counted by distinct
repositories and distinct owners. A value that several owners or many repositories have is a copied example; one that
a single owner has in few repositories, and that looks random (entropy of the whole value, letters and digits, no
placeholder word), is a live-looking credential and adds a span ``live``. The three kinds of plain matches are reported whatever their frequency.

Counting starts with distinct (hash, owner, repository) on the map side, so a value that a third of all
documents share is a few rows after the first step; the counts are written before they are joined back, so the
join is one of two plain tables and a hot value can be split.

Defined results: a null text is empty; a null owner or repository counts as one of its own; repeated rows
each get a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.common import text_or_empty
from feedloom.llm.native import joined_spans, spans_where
from feedloom.operators.stage import staged

KINDS = ("assign", "access", "hex", "live")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The same spans as those of the contract's pattern that are long enough.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
ASSIGN_VALUE = 8
PLACEHOLDERS = r"(?i)example|sample|dummy|changeme|your|placeholder|x{6,}|0{8,}|1234567|abcdef"
MIN_ENTROPY = 2.5
LIVE_OWNERS, LIVE_REPOSITORIES = 1, 2
COPIED_OWNERS, COPIED_REPOSITORIES = 2, 3


def entropy(value: Column) -> Column:
    """Bits per sign of a whole value; its signs are few, so work grows with its length."""
    signs = F.split(value, "")
    n = F.length(value).cast("double")

    def add(total: Column, sign: Column) -> Column:
        share = F.size(F.filter(signs, lambda x: x == sign)) / n
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(signs), F.lit(0.0), add)


def looks_live(value: Column) -> Column:
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return mixed & ~value.rlike(PLACEHOLDERS) & (entropy(value) >= MIN_ENTROPY)


def _ranked(spans: Column, kind: str) -> Column:
    """array<struct<start, rank, end, kind>>, which sorts by start, then by kind as listed."""
    rank = KINDS.index(kind)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _candidates(spans: Column) -> Column:
    """array<struct<start, end, hash, live>> of spans of values."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(s["match"]).alias("hash"), looks_live(s["match"]).alias("live")),
    )


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, owner, repository, base, values) of every row; ``row`` tells repeated rows apart."""
    t = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), owner.alias("owner"), repository.alias("repository"), text_or_empty(text_col).alias("_text"))
    found = rows.select(
        "doc_id",
        "owner",
        "repository",
        # An assignment has one of these signs, an access key its mark: cheap tests spare most searches.
        spans_where(t.contains(":") | t.contains("="), t, ASSIGN).alias("_assign"),
        spans_where(t.contains("AKIA"), t, ACCESS).alias("_access"),
        spans_where(t.rlike(HEX), t, HEX).alias("_hex"),
        spans_where(t.rlike(TOKEN), t, TOKEN).alias("_token"),
    )
    value = lambda s: F.regexp_extract(s["match"], ASSIGN, 2)
    found = found.withColumn("_assign", F.filter("_assign", lambda s: F.length(value(s)) >= ASSIGN_VALUE))
    values = F.transform("_assign", lambda s: F.struct((s["end"] - F.length(value(s))).cast("bigint").alias("start"), s["end"].alias("end"), value(s).alias("match")))
    found = found.withColumn("_values", F.array_distinct(F.concat(values, "_access", "_hex", "_token")))
    return found.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "owner",
        "repository",
        F.concat(_ranked(F.col("_assign"), "assign"), _ranked(F.col("_access"), "access"), _ranked(F.col("_hex"), "hex")).alias("base"),
        _candidates(F.col("_values")).alias("values"),
    )


def ownership(values: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of every candidate, from (hash, owner, repository)."""
    distinct = values.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = distinct.groupBy("hash", "owner").agg(F.count("one").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def secret_spans(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, live, n_live, n_copied, max_owners, max_repositories) of every row; base and live are arrays of spans."""
    # Written once: the number of a row then holds in all later steps.
    rows = staged(scan(docs, owner, repository, id_col, text_col), "secret-rows")
    values = rows.select("row", "owner", "repository", F.inline("values"))
    judged = values.join(staged(ownership(values), "secret-owners"), "hash")
    live = F.col("live") & (F.col("owners") <= LIVE_OWNERS) & (F.col("repositories") <= LIVE_REPOSITORIES)
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES)
    span = F.struct("start", F.lit(KINDS.index("live")).alias("rank"), "end", F.lit("live").alias("kind"))
    verdicts = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(live, span))).alias("live"),
        F.sum(live.cast("bigint")).alias("n_live"),
        F.sum(copied.cast("bigint")).alias("n_copied"),
        F.max("owners").alias("max_owners"),
        F.max("repositories").alias("max_repositories"),
    )
    nothing = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return rows.join(verdicts, "row", "left").select(
        "doc_id",
        "base",
        F.coalesce("live", nothing).alias("live"),
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_live", "n_copied", "max_owners", "max_repositories")),
    )


def span_columns() -> list[Column]:
    """Counts, the digest of the plain spans, and all spans as text."""
    base = F.col("base")
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]]
    return [
        *counts,
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.concat(base, "live")).alias("spans"),
    ]
