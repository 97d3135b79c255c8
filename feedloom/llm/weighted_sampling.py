"""Document fingerprints by consistent weighted sampling, by DataFrame functions only.

A text is a bag of weighted terms: its words, by their 64-bit hash, weighted by how often they occur. For each of ``SAMPLES`` samples a term has three draws that depend on the term and the sample only:
r and c from Gamma(2, 1), and b uniform. With weight S,

    t = floor(ln S / r + b),   ln y = r (t - b),   ln a = ln c - ln y - r,

and the sample is the (term, t) with the smallest a. Two texts have the same sample with a probability that
is their generalised Jaccard similarity (sum of the smaller weights over sum of the larger ones), so the
share of equal samples estimates it. As a depends on term, sample and t only, the smallest value of a names
its (term, t), and a sample is a minimum: combined on the map side, and exact in any order.

The draws are computed from (seed, sample, term) where a document's term is, after its words are counted, so
that words share no draws and there is no table of them. A text and its edited text share half of their words: their
words are counted side by side, and a term is drawn once for both.

An *edited* text ends like the next document begins. Documents are ordered by distributed ranks of narrow
rows; texts are shuffled once, by document, and only the beginnings that are needed go on to a neighbour.

Defined results: a null text is empty; without words all samples are zero, and two such texts are alike.
Repeated rows each get a row, and follow each other. Null ids come last. An only document follows itself.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedloom.llm.common import SPACE, text_or_empty
from feedloom.operators.segments import add_rank
from feedloom.operators.stage import staged

SAMPLES = 32
SEED = 1729
SAMPLES_AT_ONCE = 4
#: Texts are dealt out so that a task has about so many characters, and its weighted terms fit into memory.
TASK_CHARS = 1 << 22


def _uniform(bits: Column) -> Column:
    """A number in (0, 1) from 32 bits."""
    return (bits + F.lit(0.5)) * F.lit(2.0**-32)


def _keys(j: int, seed: int) -> list[Column]:
    """Constants of a sample: a term's hashes are those of the term with these mixed in."""
    return [F.xxhash64(F.lit(seed), F.lit(j), F.lit(part)) for part in range(3)]


def _draw(term: Column, keys: list[Column]) -> tuple[Column, Column, Column]:
    """r, b and ln c of a term in the sample of ``keys``."""
    low = lambda h: _uniform(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = lambda h: _uniform(F.shiftrightunsigned(h, 32))
    for_r, for_c, for_b = (F.xxhash64(term.bitwiseXOR(key)) for key in keys)
    return -F.ln(low(for_r) * high(for_r)), low(for_b), F.ln(-F.ln(low(for_c) * high(for_c)))


def draws(spark: SparkSession, terms: int, samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """(term, r, b, k) of terms below ``terms``: arrays with an entry per sample; k is ln c + r b - r, so that ln a is k - r t."""
    drawn = [_draw(F.col("id"), _keys(j, seed)) for j in range(samples)]
    r, b, c = (F.array(*x).alias(name) for x, name in zip(zip(*drawn), ("r", "b", "c")))
    rows = spark.range(terms).select(F.col("id").alias("term"), r, b, c)
    return rows.select("term", "r", "b", F.transform("c", lambda c, j: c + F.get("r", j) * F.get("b", j) - F.get("r", j)).alias("k"))


def weighted_terms(texts: DataFrame, keys: list[str], text_col: str = "text", terms: int | None = None, versions: int = 1) -> DataFrame:
    """(keys, term, w0, w1, ...): the weight of a term in each version of a text; ``which`` numbers the version.

    Where rows are already dealt out by some of ``keys``, this moves nothing. ``terms`` folds the words into so many
    terms; by default a term is the whole hash.
    """
    which = F.col("which") if versions > 1 else F.lit(0)
    words = texts.select(*keys, which.alias("which"), F.explode(F.split(text_col, f"[{SPACE}]+")).alias("_word")).filter(F.col("_word") != "")
    term = F.xxhash64("_word") if terms is None else F.pmod(F.xxhash64("_word"), F.lit(terms).cast("bigint"))
    counts = [F.count_if(F.col("which") == i).alias(f"w{i}") for i in range(versions)]
    return words.select(*keys, "which", term.alias("term")).groupBy(*keys, "term").agg(*counts)


def signatures(
    texts: DataFrame, keys: list[str], text_col: str = "text", terms: int | None = None, samples: int = SAMPLES, seed: int = SEED, versions: int = 1
) -> DataFrame:
    """(keys, samples, samples1, ...): the smallest ln a of each sample per version, as array<double>; no row without words.

    A term is drawn once for all versions of a text: the draws are the same expression in all of them, and no part of
    it is conditional, so that Spark computes it once per row. A term that a version lacks has no logarithm of its
    weight, so its value is null there and is passed over. Rows are multiplied by the groups of ``SAMPLES_AT_ONCE``
    samples, which keeps the generated code small enough to be compiled.
    """
    logs = [F.ln(F.col(f"w{v}").cast("double")).alias(f"_ln{v}") for v in range(versions)]
    weighted = weighted_terms(texts, keys, text_col, terms, versions).select(*keys, "term", *logs)
    places = range(SAMPLES_AT_ONCE)

    def constants(at: int) -> Column:
        each = [key.alias(f"k{i}{part}") for i in places for part, key in enumerate(_keys(at + i, seed))]
        return F.struct(F.lit(at).alias("_at"), *each)

    groups = F.explode(F.array(*(constants(at) for at in range(0, samples, SAMPLES_AT_ONCE)))).alias("_g")
    spread = weighted.select("*", groups).select(*weighted.columns, "_g.*")

    def smallest(i: int, v: int) -> Column:
        r, b, c = _draw(F.col("term"), [F.col(f"k{i}{part}") for part in range(3)])
        return F.min(c + r * (b - 1 - F.floor(F.col(f"_ln{v}") / r + b))).alias(f"s{v}_{i}")

    found = spread.groupBy(*keys, "_at").agg(*(smallest(i, v) for i in places for v in range(versions)))
    parts = [F.array_sort(F.collect_list(F.struct("_at", F.array(*(f"s{v}_{i}" for i in places)).alias("s")))) for v in range(versions)]
    names = ["samples", *(f"samples{v}" for v in range(1, versions))]
    joined = found.groupBy(*keys).agg(*(part.alias(name) for part, name in zip(parts, names)))
    signs = [F.flatten(F.transform(name, lambda x: x["s"])) for name in names]
    return joined.select(*keys, *(F.when(sign[0].isNotNull(), F.slice(sign, 1, samples)).alias(name) for sign, name in zip(signs, names)))


def as_text(samples: Column, n: int = SAMPLES) -> Column:
    """Four hexadecimal digits per sample; two different samples share them once in 65,536 times."""
    digits = F.transform(samples, lambda s: F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.xxhash64(s), 48))), 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit("0" * 4 * n))


def likeness(first: Column, second: Column, n: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    places = F.array(*(F.lit(1 + 4 * j) for j in range(n)))
    same = F.filter(places, lambda at: F.substring(first, at, F.lit(4)) == F.substring(second, at, F.lit(4)))
    return F.size(same) / F.lit(float(n))


def neighbours(docs: DataFrame) -> tuple[DataFrame, int]:
    """One row per (doc_id, tie): how many copies, the keys before and after it, and the need of the one before.

    Order is that of doc_id, descending; the last is followed by the first. Also the number of characters of all.
    """
    narrow = docs.groupBy("doc_id", "tie").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    ranked = staged(add_rank(narrow, [], [F.col("doc_id").desc_nulls_last(), F.col("tie")], "_pos"), "cws-order")
    last, chars = ranked.agg(F.max("_pos"), F.sum(F.col("n_chars") * F.col("copies"))).first()
    key = F.struct("doc_id", "tie")
    placed = ranked.withColumn("_after", F.col("_pos") % F.lit(last or 1) + 1)
    ahead = placed.select(F.col("_pos").alias("_after"), key.alias("after"))
    behind = placed.select(F.col("_after").alias("_pos"), key.alias("before"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"))
    found = placed.join(ahead, "_after").join(behind, "_pos")
    # A struct is never null, so that rows without an id join too.
    return found.select(F.struct("doc_id").alias("doc"), "tie", "copies", "after", "before", "need"), chars or 0


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and text: (doc, tie, copies, text, edited, edited_copy, after).

    doc is a struct of the id, and ``after`` the key of the next document. Of repeated rows only the last is
    followed by another document; ``edited_copy`` is the edited text of the others.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("doc_id")).alias("doc"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order, chars = neighbours(rows.select("doc.doc_id", "tie", F.length("text").alias("n_chars")))
    order = staged(order, "cws-neighbours")
    # Texts move here, once, by document; all that follows reads the same shuffle and stays where it is.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // TASK_CHARS))
    dealt = rows.repartition(tasks, "doc", "tie")
    copy = F.row_number().over(Window.partitionBy("doc", "tie").orderBy(F.lit(1)))
    known = dealt.withColumn("copy", copy).filter(F.col("copy") == 1).drop("copy").join(order, ["doc", "tie"])
    heads = known.select(F.struct("before.doc_id").alias("doc"), F.col("before.tie").alias("tie"), F.left("text", F.col("need")).alias("head"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    begins = F.left("text", n - half)
    again = F.when(F.col("copies") > 1, F.concat(begins, F.left("text", half)))
    met = known.join(heads, ["doc", "tie"])
    return met.select("doc", "tie", "copies", "text", F.concat(begins, "head").alias("edited"), again.alias("edited_copy"), "after")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    texts = edited_texts(docs, id_col, text_col)
    keys = ["doc", "tie"]
    kinds = ("text", "edited", "edited_copy")
    each = F.array(*(F.struct(F.lit(i).alias("which"), F.col(name).alias("text")) for i, name in enumerate(kinds)))
    versions = texts.select(*keys, F.explode(F.filter(each, lambda v: v["text"].isNotNull())).alias("v")).select(*keys, "v.which", "v.text")
    signed = signatures(versions, keys, versions=len(kinds))
    marks = signed.select(*keys, *(F.col(sign).alias(f"_{name}") for sign, name in zip(("samples", "samples1", "samples2"), kinds)))
    facts = texts.select(
        *keys, "copies", "after", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), F.sha2("edited_copy", 256).alias("_copy_sha256"),
    )
    signs = [as_text(F.col(f"_{name}")).alias(f"_{name}") for name in kinds]
    found = staged(facts.join(marks, keys, "left").select(*facts.columns, *signs), "cws-rows")
    following = found.select(F.struct("doc.doc_id", "tie").alias("after"), F.col("_text").alias("_next"))
    joined = found.join(following, "after").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    last = F.col("copy") == F.col("copies")
    edited = F.when(last, F.col("_edited")).otherwise(F.col("_edited_copy"))
    following = F.when(last, F.col("_next")).otherwise(F.col("_text"))
    return joined.select(
        "doc.doc_id",
        "n_chars",
        F.when(last, F.col("edited_sha256")).otherwise(F.col("_copy_sha256")).alias("edited_sha256"),
        F.col("_text").alias("fingerprint"),
        edited.alias("edited_fingerprint"),
        likeness(F.col("_text"), edited).alias("near_edited"),
        likeness(F.col("_text"), following).alias("near_next"),
    )
