"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits. Two fingerprints at ``max_bits`` or fewer differing bits agree, in at least one
of two 32-bit segments, but for ``max_bits // 2`` bits. So every distinct fingerprint is stored once per
segment, and looked up once for each value in a small Hamming ball around its own segment; what the lookups
fetch is verified on the complete fingerprints, and the links are joined to components.

* Equal fingerprints are one row from the start, whatever number of documents carries them.
* A pair one bit apart in a segment is looked up from the side that has a 0 there only.
* A lookup first meets the *size* of a table entry. Entries of more than ``BUCKET_ROWS`` fingerprints are
  refined by the same rule on the two halves of the other segment, so that lookup and entry then share 48
  bits; that is exact, drops nothing, and keeps a dense crowd of near copies from pairing all with all.
* Nothing that grows with the fingerprints is broadcast: lookups are some 34 rows each, unseen by the planner.
* Components come from alternating large-star and small-star steps over the links.

Defined results: a null or empty text, or one without a word, has fingerprint 0, which links like any
other. Fewer words than a shingle make one shingle of them all. Repeated rows each get a row. A null id
never names a component unless no other id is in it. An empty table gives an empty table. Columns of
``docs`` other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.llm.common import join_shuffled, map_arrow, pieces, utf8
from feedloom.llm.components import star_components
from feedloom.operators.stage import staged

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
BUCKET_ROWS = 64
_CHUNK = 1 << 14


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one UTF-8 text; memory is bounded by a piece of the text."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        words = tail + piece.lower().split()
        shingles = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle_words)))]
        for at in range(0, len(shingles), _CHUNK):
            ones += _bits(shingles[at : at + _CHUNK])
        total += len(shingles)
        tail = words[-(shingle_words - 1) :] if shingle_words > 1 else []
    if not total:
        words = text.lower().split()
        if not words:
            return 0
        ones, total = _bits([b" ".join(words)]), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _bits(shingles: list[bytes]) -> np.ndarray:
    """For each of 64 bits, how many shingle hashes have it."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, HASH_SEED) for x in shingles), "<u8", len(shingles))
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, tie, fp) of every row; ``tie`` is a hash of the text."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(x, shingle_words) for x in utf8(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "tie", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).alias("text"))
    return map_arrow(rows, per_batch, "doc_id bigint, tie bigint, fp bigint")


def _part(value: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def _ball(value: Column, bits: int, radius: int) -> Column:
    """All values within ``radius`` bits of ``value``, as structs (value, flips)."""
    here = F.array(F.struct(value.alias("value"), F.lit(0).alias("flips")))
    for flips in range(1, radius + 1):
        wider = F.flatten(
            F.transform(
                F.filter(here, lambda x: x["flips"] == flips - 1),
                lambda x: F.transform(
                    F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits)]),
                    lambda bit: F.struct(x["value"].bitwiseXOR(bit).alias("value"), F.lit(flips).alias("flips")),
                ),
            )
        )
        here = F.array_distinct(F.concat(here, wider))
    return here


def _lookups(fps: DataFrame, radius: int) -> DataFrame:
    """(segment, value, fp) of every lookup. At radius 1, bits are only set, never cleared: see the module."""
    if radius == 1:
        bits = F.array(*[F.lit(1 << b).cast("bigint") for b in range(32)])
        ball = lambda v: F.concat(F.array(v), F.transform(F.filter(bits, lambda b: v.bitwiseAND(b) == 0), lambda b: v.bitwiseOR(b)))
    else:
        ball = lambda v: F.transform(_ball(v, 32, radius), lambda x: x["value"])
    rows = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(32))).alias("segment"))
    value = F.when(F.col("segment") == 0, _part(F.col("fp"), 0, 32)).otherwise(_part(F.col("fp"), 32, 32))
    return rows.select("fp", "segment", value.alias("own")).select("segment", F.explode(ball(F.col("own"))).alias("value"), "fp")


def _entries(fps: DataFrame) -> DataFrame:
    """(segment, value, other): each fingerprint once for each of its two segments."""
    both = F.array(
        F.struct(F.lit(0).alias("segment"), _part(F.col("fp"), 0, 32).alias("value")),
        F.struct(F.lit(32).alias("segment"), _part(F.col("fp"), 32, 32).alias("value")),
    )
    return fps.select(F.explode(both).alias("x"), F.col("fp").alias("other")).select("x.segment", "x.value", "other")


def _halves(fp: Column, segment: Column) -> list[Column]:
    """The two 16-bit halves of the segment that ``segment`` is not."""
    rest = F.when(segment == 0, _part(fp, 32, 32)).otherwise(_part(fp, 0, 32))
    return [_part(rest, 0, 16), _part(rest, 16, 16)]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct fingerprints at ``max_bits`` or fewer bits; ``fps`` has one column fp."""
    radius = max_bits // 2
    entries = _entries(fps)
    sizes = entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("segment") == 0, _part(F.col("fp"), 0, 32)).otherwise(_part(F.col("fp"), 32, 32))
    # Most lookups meet no entry, or only the fingerprint that looks; the rest is small.
    met = staged(
        join_shuffled(_lookups(fps, radius), sizes, ["segment", "value"]).filter((F.col("n") > 1) | (F.col("value") != own)), "simhash-met"
    )
    light = join_shuffled(met.filter(F.col("n") <= bucket_rows), entries, ["segment", "value"])
    crowded = sizes.filter(F.col("n") > bucket_rows).select("segment", "value")
    dense = met.filter(F.col("n") > bucket_rows)
    fine = ["segment", "value", "half", "part"]

    def refined(rows: DataFrame, name: str, wide: bool) -> DataFrame:
        parts = _halves(F.col(name), F.col("segment"))
        tags = [lambda v: F.struct(F.lit(0).alias("half"), v.alias("part")), lambda v: F.struct(F.lit(1).alias("half"), v.alias("part"))]
        choices = [
            F.transform(F.transform(_ball(p, 16, radius), lambda x: x["value"]) if wide else F.array(p), tag)
            for p, tag in zip(parts, tags)
        ]
        return rows.select("segment", "value", name, F.explode(F.concat(*choices)).alias("x")).select("segment", "value", name, "x.half", "x.part")

    inside = join_shuffled(entries, crowded, ["segment", "value"])
    close = join_shuffled(refined(dense, "fp", True), refined(inside, "other", False), fine)
    pairs = light.select("fp", "other").unionByName(close.select("fp", "other"))
    verified = pairs.filter((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits))
    return verified.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def _classes(rows: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """(fp, head) of every distinct fingerprint: the first document (missing, doc_id, tie) of its component."""
    document = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tie")
    heads = staged(rows.groupBy("fp").agg(F.min(document).alias("first")), "simhash-heads")
    members = star_components(near_links(heads.select("fp"), max_bits, bucket_rows)).withColumnRenamed("node", "fp")
    named = join_shuffled(members, heads, "fp")
    smallest = named.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = named.join(smallest, "root").select("fp", "smallest")
    return staged(heads.join(linked, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("head")), "simhash-classes")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id in reach over links."""
    rows = staged(with_fingerprints(docs, id_col, text_col, shingle_words), "simhash-rows")
    classes = _classes(rows, max_bits, bucket_rows).select("fp", F.col("head.doc_id").alias("component_id"))
    # A fingerprint may be that of a third of all rows. Both sides are plain tables here, so that large partitions of
    # this join can be split.
    return join_shuffled(rows.select("doc_id", "fp"), classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, and of repeated rows one."""
    rows = staged(with_fingerprints(docs, id_col, text_col, shingle_words), "simhash-rows")
    heads = _classes(rows, max_bits, bucket_rows).select(F.struct("head.doc_id").alias("__doc"), F.col("head.tie").alias("__tie")).distinct()
    # Ids may be null; a struct around them is not, so it joins.
    keyed = docs.withColumn("__doc", F.struct(F.col(id_col).cast("bigint").alias("doc_id"))).withColumn("__tie", F.xxhash64(F.col(text_col)))
    copy = F.row_number().over(Window.partitionBy("__doc", "__tie").orderBy(F.lit(1)))
    kept = join_shuffled(keyed, heads, ["__doc", "__tie"], "left_semi").withColumn("__copy", copy).filter(F.col("__copy") == 1)
    return kept.select(*docs.columns)
