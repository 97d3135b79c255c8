"""MinHash near-duplicates by an LSH forest.

A document's set holds the hashes of its distinct five-word shingles. Equal sets fold to one *class* first, whatever
number of documents share it. A class has ``ORDERS`` labels, each a sequence of ``LEAST_DEPTH + MORE_DEPTH`` minima
under as many permutations. Sorted by one label, classes that are alike stand near each other, and the longer
their common prefix the likelier they are: each order is a prefix tree laid flat.

1. *Longest common prefix*: a class is compared with its next neighbour in every order in which both share at least
   ``LEAST_DEPTH`` minima. Confirmed links give components.
2. *Depth by region*: a thin region, of at most ``REACH`` rows more than one, is looked at down to the least depth:
   all its rows that aren't in one component yet. In a crowded region the first step stays at the depth that the sorted
   order gives by itself, as the next rows are those with the longest prefixes.
3. *Rest*: in crowded regions pairs were left out. Their classes, and only these, are held against each other exactly: two sets of the wanted similarity share a shingle among the first few of
   any common order of shingles (here the rarest first), so early that enough of both is still ahead. Occurrences of a shingle within one component need no
   comparison, so a crowd that is already one component costs nothing, whatever its size.

A pair at 85 % shares no prefix of five in any of 24 orders less than once in a million; the rest step makes nothing
depend on how crowded a region is. Before full sets are fetched, a pair's two sketches (two bits of each of
``SKETCH`` minima) are compared: the bar lies six standard deviations below what the wanted similarity gives.
Every link is confirmed on full sets, by whole numbers.

Every step is an equi-join on narrow rows or a range-sorted rank; no bucket is enumerated, and no step lists
all pairs of a group. Texts are read once for labels, and again, for the classes that take part in a pair, for sets.

Defined results: words are as ``WORD`` in ``common``, A-Z lower-cased. Fewer than five words are one shingle; a text that is
null or has no word has an empty set, links with nothing and is its own component. Repeated rows are copies, and
each gets a row; ``kept`` holds for each row that has the component's smallest id. A null id never names a
component unless no other id is in it, and is kept only then. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.common import map_arrow, pieces, utf8
from feedloom.llm.components import star_components
from feedloom.operators.segments import add_rank
from feedloom.operators.stage import staged, staged_counted

SHINGLE_WORDS = 5
PERCENT = 85
ORDERS = 24
LEAST_DEPTH = 5
MORE_DEPTH = 5
REACH = 32
SKETCH = 128
SEED = 20240611
#: Of the 2 * SKETCH sketch bits, those that two sets at 85 % share at least, but once in a billion pairs: 0.925 less six times 0.02.
SAME_BITS = round(2 * SKETCH * 0.805)
#: Occurrences of a shingle compared in one piece of the rest step.
POST_ROWS = 1024
#: A side of a join is broadcast up to so many bytes, counted while it is written; beyond, both sides are shuffled.
BROADCAST_BYTES = 1 << 25
_LEVEL_BITS = 12
_CHUNK = 1 << 12
_WORDS = 2 * SKETCH // 64


# ---- sets, labels, sketches -----------------------------------------------------------------------------------


def shingle_set(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole UTF-8 text, read in pieces."""
    found, tail, any_word = [], [], False
    for piece in pieces(text):
        words = tail + piece.lower().split()
        any_word = any_word or bool(words)
        grams = {b" ".join(x) for x in zip(*(words[i:] for i in range(shingle_words)))}
        if grams:
            found.append(np.unique(np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))))
        tail = words[-(shingle_words - 1) :] if shingle_words > 1 else []
    if found:
        return np.unique(np.concatenate(found))
    whole = [xxhash.xxh64_intdigest(b" ".join(text.lower().split()))] if any_word else []
    return np.array(whole, np.uint64)


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    shape = (ORDERS * (LEAST_DEPTH + MORE_DEPTH), 1)
    return rng.integers(0, 2**64, shape, np.uint64), rng.integers(0, 2**63, shape, np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under every permutation, upper 32 bits."""
    flips, factors = _permutations()
    best = np.full(len(flips), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, _CHUNK * 16 // len(flips))
    for at in range(0, len(shingles), step):
        part = shingles[at : at + step] ^ flips
        part *= factors
        np.minimum(best, part.min(axis=1), out=best)
    # Multiplying leaves the low bits plain; values are told apart by a further mixing step.
    best ^= best >> np.uint64(31)
    return (best * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def labels(mins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per order: a hash of the order and its first minima (the region), and its further minima as one sortable number."""
    levels = mins.reshape(ORDERS, LEAST_DEPTH + MORE_DEPTH)
    first = np.ascontiguousarray(levels[:, :LEAST_DEPTH])
    regions = np.array([xxhash.xxh64_intdigest(row.tobytes(), at) for at, row in enumerate(first)], np.uint64).view(np.int64)
    deeper = np.zeros(ORDERS, np.int64)
    for level in levels[:, LEAST_DEPTH:].T:
        deeper = deeper << _LEVEL_BITS | (level & np.uint64((1 << _LEVEL_BITS) - 1)).astype(np.int64)
    return regions, deeper


def sketch(mins: np.ndarray) -> np.ndarray:
    """Two bits of each of the first minima, as 64-bit numbers."""
    low = (mins[:SKETCH] & np.uint64(3)).astype(np.uint8)
    return np.packbits(np.stack([low & 1, low >> 1])).view("<i8")


def _with_labels(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(doc_id, tie, set_id, n, regions, deeper, sketch) of every row; set_id is a 128-bit hash of the set."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, parts = [], [], [[], [], []]
        for text in utf8(batch.column(2)):
            found = shingle_set(text, shingle_words)
            ids.append(xxhash.xxh3_128_digest(found.tobytes()))
            sizes.append(len(found))
            mins = minima(found)
            for part, values in zip(parts, (*labels(mins), sketch(mins)) if len(found) else ([], [], [])):
                part.append(values)
        columns = [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(p, pa.list_(pa.int64())) for p in parts)], ["doc_id", "tie", "set_id", "n", "regions", "deeper", "sketch"]
        )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, tie bigint, set_id binary, n bigint, regions array<bigint>, deeper array<bigint>, sketch array<bigint>"
    return map_arrow(rows, per_batch, schema)


# ---- pairs ----------------------------------------------------------------------------------------------------


def _alike(left: str, right: str) -> Column:
    """Sketches agree in ``SAME_BITS`` bits, and sizes allow the wanted similarity."""
    differ = sum((F.bit_count(F.col(f"{left}.k{i}").bitwiseXOR(F.col(f"{right}.k{i}"))) for i in range(_WORDS)), F.lit(0))
    smaller, larger = F.least(f"{left}.n", f"{right}.n"), F.greatest(f"{left}.n", f"{right}.n")
    return (differ <= 2 * SKETCH - SAME_BITS) & (100 * smaller >= PERCENT * larger)


def _pair(left: str, right: str) -> list[Column]:
    return [F.least(f"{left}.set_id", f"{right}.set_id").alias("a"), F.greatest(f"{left}.set_id", f"{right}.set_id").alias("b")]


_FACTS = ("set_id", "n", *(f"k{i}" for i in range(_WORDS)))


def _small_side(df: DataFrame, label: str, row_bytes: int) -> DataFrame:
    """``df`` written and counted; with a broadcast hint where its rows, of ``row_bytes`` at most, are few enough."""
    table, n = staged_counted(df, label)
    return F.broadcast(table) if n * row_bytes <= BROADCAST_BYTES else table


class _Forest:
    """Classes of the documents and what the steps share."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, shingle_words: int, reach: int):
        self.docs, self.id_col, self.text_col, self.shingle_words, self.reach = docs, id_col, text_col, shingle_words, reach
        self.rows = staged(_with_labels(docs, id_col, text_col, shingle_words), "forest-rows")
        document = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tie")
        shingled = self.rows.filter("n > 0")
        self.heads = staged(shingled.groupBy("set_id").agg(F.min(document).alias("first")), "forest-heads")
        words = [F.col("sketch")[i].alias(f"k{i}") for i in range(_WORDS)]
        # Labels depend on the set alone; copies are dropped before the shuffle.
        single = shingled.select("set_id", "n", "regions", "deeper", "sketch").dropDuplicates(["set_id"])
        self.classes = staged(single.select("set_id", "n", "regions", "deeper", *words), "forest-classes")

    def entries(self) -> DataFrame:
        """Rows of all orders in regions of two or more: (region, pos, size, set_id); pos counts along the sorted order."""
        both = F.explode(F.arrays_zip("regions", "deeper")).alias("x")
        every = self.classes.select("set_id", both).select(F.col("x.regions").alias("region"), F.col("x.deeper").alias("deeper"), "set_id")
        sizes = _small_side(every.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1), "forest-regions", 32)
        met = every.join(sizes, "region")
        ranked = add_rank(met, ["region"], ["deeper", "set_id"], "pos")
        return staged(ranked.select("region", "pos", "size", "set_id"), "forest-orders")

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        """(set_id, shingles) of the classes in pairs, from the texts of their first documents."""
        asked = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
        first = self.heads.join(asked, "set_id", "left_semi")
        wanted = _small_side(first.select(F.struct("first.doc_id").alias("_doc"), F.col("first.tie").alias("_tie"), "set_id"), "forest-asked", 96)
        keyed = self.docs.select(F.struct(F.col(self.id_col).cast("bigint").alias("doc_id")).alias("_doc"), F.xxhash64(F.col(self.text_col)).alias("_tie"), F.col(self.text_col).alias("_text"))
        texts = keyed.join(wanted, ["_doc", "_tie"]).select("set_id", "_text")
        n_words = self.shingle_words

        def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, n_words).view(np.int64) for t in utf8(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["set_id", "shingles"])

        return staged(map_arrow(texts, per_batch, "set_id binary, shingles array<bigint>").dropDuplicates(["set_id"]), "forest-sets")

    def confirmed(self, pairs: DataFrame, label: str) -> DataFrame:
        """Of distinct pairs, those whose full sets have the wanted similarity."""
        pairs = staged(pairs.filter(F.col("a") < F.col("b")).distinct(), f"forest-pairs-{label}")
        sets = self.sets_of(pairs)
        left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        checked = pairs.join(left, "a").join(right, "b").withColumn("_both", both)
        linked = checked.filter(100 * F.col("_both") >= PERCENT * (F.size("x") + F.size("y") - F.col("_both")))
        return staged(linked.select("a", "b"), f"forest-links-{label}")

    def next_neighbours(self, orders: DataFrame) -> DataFrame:
        """Pairs that follow each other in an order, with at least the least depth in common."""
        after = orders.select("region", (F.col("pos") - 1).alias("pos"), F.col("set_id").alias("other"))
        pairs = orders.select("region", "pos", "set_id").join(after, ["region", "pos"]).select("set_id", "other").distinct()
        return self._sketched(pairs)

    def _sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs (set_id, other) whose sketches agree, as (a, b)."""
        facts = self.classes.select(*_FACTS)
        x, y = facts.alias("x"), facts.alias("y")
        joined = pairs.alias("p").join(x, F.col("p.set_id") == F.col("x.set_id")).join(y, F.col("p.other") == F.col("y.set_id"))
        return joined.filter(_alike("x", "y")).select(*_pair("x", "y"))

    def _facts_with_roots(self, roots: DataFrame) -> DataFrame:
        """Facts of every class with the root of its component, so far."""
        found = self.classes.select(*_FACTS).join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        return found.withColumn("root", F.coalesce("root", "set_id"))

    def in_thin_regions(self, orders: DataFrame, facts: DataFrame) -> DataFrame:
        """Alike pairs of thin regions, but for those in one component."""
        thin = orders.filter(F.col("size").between(3, self.reach + 1))
        known = staged(thin.select("region", "pos", "set_id").join(facts, "set_id"), "forest-reach")
        x, y = known.alias("x"), known.alias("y")
        ahead = (F.col("x.region") == F.col("y.region")) & (F.col("x.pos") < F.col("y.pos"))
        joined = x.join(y, ahead & (F.col("x.root") != F.col("y.root")) & _alike("x", "y"))
        return joined.select(*_pair("x", "y"))

    def rest(self, crowded: DataFrame, facts: DataFrame) -> DataFrame:
        """Alike pairs, in different components, among the classes of crowded regions: by shared rare shingles."""
        sets = self.sets_of(crowded.select(F.col("set_id").alias("a"), F.col("set_id").alias("b")))
        posted = sets.select("set_id", F.explode("shingles").alias("shingle"))
        counts = posted.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
        # A shingle of one class joins nothing, and rare ones come first: a prefix is what is left of its length after them.
        common = staged(counts.filter("df > 1"), "forest-common")
        kept = posted.join(common, "shingle").groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("post"))
        sized = kept.join(facts, "set_id")
        prefix = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
        before = F.col("n") - F.size("post")
        left_over = F.greatest(F.lit(0), (prefix - before).cast("int"))
        keys = sized.select(F.posexplode(F.slice("post", F.lit(1), left_over)).alias("_i", "p"), before.alias("_before"), "root", *_FACTS)
        # ``ahead``: the shingles from this one on; what a pair shares is among them, if this is the first it shares.
        keys = staged(keys.select("p.shingle", (F.col("n") - F.col("_before") - F.col("_i")).alias("ahead"), "root", *_FACTS), "forest-keys")
        per_root = keys.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("n"))
        roots = per_root.groupBy("shingle").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_roots"), F.max_by("root", F.struct("n", "root")).alias("main"))
        several = staged(roots.filter("n_roots > 1").select("shingle", "n_all", "main"), "forest-several")
        open_ = staged(keys.join(several, "shingle"), "forest-open")
        # Those outside a shingle's largest component meet all its classes, which are dealt into pieces.
        pieces_ = F.ceil(F.col("n_all") / POST_ROWS).cast("int")
        y = open_.withColumn("piece", F.pmod(F.xxhash64("set_id"), pieces_)).alias("y")
        x = open_.filter(F.col("root") != F.col("main")).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces_.cast("bigint") - 1))).alias("x")
        same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.piece") == F.col("y.piece"))
        # A pair of that similarity shares at least 85 of 185 parts of both sizes.
        enough = (100 + PERCENT) * F.least("x.ahead", "y.ahead") >= PERCENT * (F.col("x.n") + F.col("y.n"))
        return x.join(y, same & (F.col("x.root") != F.col("y.root")) & enough & _alike("x", "y")).select(*_pair("x", "y"))

    def components(self) -> DataFrame:
        """(set_id, root) of every class; classes in one component have one root."""
        orders = self.entries()
        links = self.confirmed(self.next_neighbours(orders), "next")
        facts = staged(self._facts_with_roots(star_components(links)), "forest-facts")
        pairs = self.in_thin_regions(orders, facts)
        crowded = staged(orders.filter(F.col("size") > self.reach + 1).select("set_id").distinct(), "forest-crowded")
        if not crowded.isEmpty():
            pairs = pairs.unionByName(self.rest(crowded, facts))
        more = self.confirmed(pairs, "more")
        # Components so far are one node each: what is left to join are the links between them.
        roots = facts.select(F.col("set_id"), "root")
        left, right = (roots.select(F.col("set_id").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
        between = more.join(left, "a").join(right, "b").select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
        merged = star_components(between.filter(F.col("a") < F.col("b")).distinct())
        final = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("_last")), "root", "left")
        return staged(final.select("set_id", F.coalesce("_last", "root").alias("root")), "forest-roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, reach: int = REACH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; component_id is the smallest id in reach over links."""
    forest = _Forest(docs, id_col, text_col, shingle_words, reach)
    named = staged(forest.components().join(forest.heads, "set_id"), "forest-named")
    smallest = staged(named.groupBy("root").agg(F.min("first")["doc_id"].alias("component")), "forest-smallest")
    heads = staged(named.join(smallest, "root").select("set_id", "component"), "forest-components")
    # A class may hold a third of all rows; both sides are plain tables, so that large partitions can be split.
    rows = forest.rows.select("doc_id", "n", "set_id")
    found = rows.filter("n > 0").join(heads, "set_id").select("doc_id", "n", "component")
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    return found.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept")
    )
