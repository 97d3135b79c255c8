"""Quality rules by tokeniser fertility.

Public vocabularies read every whole text: a byte-level BPE and a piece model with byte fallback. Three
measures come from them: characters per token (of each vocabulary), the share of byte-fallback tokens of the
piece model, and the entropy of a text's tokens. They are comparable within a language only, so each is held
against a band around the median of its language, or of its script where a text has no language. The bands
come from the whole corpus: exact counts per (group, measure, bin) of a fixed grid, whose quantiles give
median and spread; a group's table has a bounded number of bins, whatever the number of documents.

The measures of short texts scatter more, so a band belongs to a group *and* order of length where there are
enough texts; entropy, which grows with length, is taken as a share of the most a text of its length can have.
Where a class has fewer than ``MIN_GROUP`` texts, or spreads ``WIDE`` times as far as the next coarser one, that
one is used: the group over all lengths, then the script, then the corpus, so every text with a token is held
against a band. Spreads are quartiles, which up to a quarter of bad texts in a group don't move.
Base rules (word and symbol counts, repeated lines and repeated eight-word windows) come from the same pass
and are not weakened by the bands: a text that fails them is not kept.

Defined results: a null or empty text has no words, fails the base rules and is not kept; its measures are
0. Texts are tokenised in pieces of at most ``PIECE_BYTES``, cut at white space, so memory is bounded. Repeated rows each get a row.
"""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedloom.llm.common import map_arrow, pieces, utf8
from feedloom.operators.stage import staged

MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"
PIECE_BYTES = 1 << 16
#: A measure may lie this many spreads (median to the lower or upper quartile) from the median.
BAND = 8.0
#: Narrower spreads than this share of the median are taken as that, so that uniform groups don't reject.
LEAST_SPREAD = 0.02
MIN_GROUP = 50
#: A class whose spread is more than so many times its parent's is mixed, and its parent's band is used.
WIDE = 2.0
#: Entropy is held against bands as if every text had this many tokens.
ENTROPY_TOKENS = 1024
GRID = {"byte_chars": 0.02, "piece_chars": 0.02, "fallback": 0.002, "entropy": 0.02}
#: Which sides of the band reject: low, high or both.
SIDES = {"byte_chars": "both", "piece_chars": "both", "fallback": "high", "entropy": "low"}

_SPACE_BYTES = np.zeros(256, bool)
_SPACE_BYTES[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(SYMBOLS)] = True


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    ranked = np.sort(rolled)
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    # Equal windows have equal hashes; the few that have are compared word by word.
    suspects = np.isin(rolled, ranked[1:][same])
    seen: dict[tuple, list[int]] = {}
    for at in np.flatnonzero(suspects).tolist():
        seen.setdefault(tuple(words[at : at + width]), []).append(at)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            edges[places] += 1
            edges[np.array(places) + width] -= 1
    return int((np.cumsum(edges)[:-1] > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    signs = np.frombuffer(text, np.uint8)
    # Bytes that continue a code point have the top bits 10.
    chars = int(np.count_nonzero(((signs & 0xC0) != 0x80) & ~_SPACE_BYTES[signs]))
    symbols = int(np.count_nonzero(_SYMBOL_BYTES[signs]))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    words = text.split()
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


@lru_cache(maxsize=2)
def _byte_bpe(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def _piece_model(proto: bytes) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    # The model has white space other than blanks as bytes; that is no fallback.
    blank = {f"<0x{b:02X}>" for b in (9, 10, 11, 12, 13)}
    return model, np.array([model.is_byte(i) and model.id_to_piece(i) not in blank for i in range(model.get_piece_size())])


@lru_cache(maxsize=1 << 16)
def _script(code: int) -> str:
    """Script of a letter by its name; empty for other signs."""
    char = chr(code)
    return unicodedata.name(char, "OTHER").split(" ")[0] if char.isalpha() else ""


def script_of(text: str) -> str:
    """The commonest script of the letters of a text: by the names of code points."""
    counts: dict[str, int] = {}
    for at in range(0, len(text), PIECE_BYTES):
        signs = np.bincount(np.frombuffer(text[at : at + PIECE_BYTES].encode("utf-32-le", "replace"), np.uint32))
        for code in np.flatnonzero(signs).tolist():
            if name := _script(code):
                counts[name] = counts.get(name, 0) + int(signs[code])
    return max(sorted(counts), key=counts.get).lower() if counts else "none"


def byte_measures(text: bytes, byte_bpe: tiktoken.Encoding) -> tuple[int, int, float]:
    """(n_chars, n_tokens, entropy) by the byte vocabulary."""
    n_chars = n_byte = 0
    # A table of the whole vocabulary costs more than a short text; texts of several pieces only sum up in one.
    table = np.zeros(byte_bpe.n_vocab, np.int64) if len(text) > PIECE_BYTES else None
    for piece in pieces(text, PIECE_BYTES):
        part = piece.decode("utf-8", "replace")
        n_chars += len(part)
        ids = np.array(byte_bpe.encode_ordinary(part), np.int32)
        n_byte += len(ids)
        tokens, counts = np.unique(ids, return_counts=True)
        if table is not None:
            table[tokens] += counts
    if not n_byte:
        return n_chars, 0, 0.0
    share = (counts if table is None else table[table > 0]) / n_byte
    return n_chars, n_byte, float(-(share * np.log2(share)).sum())


def piece_measures(text: bytes, model, is_byte: np.ndarray) -> tuple[int, int]:
    """(n_pieces, n_fallback) by the piece model."""
    n_piece = n_fallback = 0
    for piece in pieces(text, PIECE_BYTES):
        ids = np.array(model.encode(piece.decode("utf-8", "replace")), np.int32)
        n_piece += len(ids)
        n_fallback += int(np.count_nonzero(is_byte[ids]))
    return n_piece, n_fallback


def measures(texts: list[bytes], byte_bpe: tiktoken.Encoding, model, is_byte: np.ndarray) -> list[tuple[int, float, float, float, float]]:
    """(n_tokens, byte_chars, piece_chars, fallback, entropy) of every text.

    One vocabulary after the other: by turns, each would push the other's tables out of the processor's cache.
    """
    by_bytes = [byte_measures(x, byte_bpe) for x in texts]
    by_pieces = [piece_measures(x, model, is_byte) for x in texts]
    return [
        (n_byte, n_chars / n_byte, n_chars / max(1, n_piece), n_fallback / max(1, n_piece), entropy) if n_byte else (0, 0.0, 0.0, 0.0, 0.0)
        for (n_chars, n_byte, entropy), (n_piece, n_fallback) in zip(by_bytes, by_pieces)
    ]


def measure_documents(
    spark: SparkSession, docs: DataFrame, rank_path: str, pattern: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, grouping, script, base counts, n_tokens, measures) of every row. The vocabularies are below 2 MB."""
    with open(rank_path, "rb") as ranks, open(piece_path, "rb") as proto:
        sent = spark.sparkContext.broadcast((ranks.read(), pattern, proto.read()))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "byte_chars", "piece_chars", "fallback", "entropy"]

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranks, pattern, proto = sent.value
        byte_bpe, (model, is_byte) = _byte_bpe(ranks, pattern), _piece_model(proto)
        texts = utf8(batch.column(1))
        rows = [(*base_counts(x), *found) for x, found in zip(texts, measures(texts, byte_bpe, model, is_byte))]
        scripts = [script_of(x.decode("utf-8", "replace")) for x in texts]
        groups = [lang or "script:" + script for lang, script in zip(batch.column(2).to_pylist(), scripts)]
        columns = [pa.array(c, pa.int64() if i < 6 else pa.float64()) for i, c in enumerate(zip(*rows))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(groups, pa.string()), pa.array(scripts, pa.string()), *columns], ["doc_id", "grouping", "script", *names])

    schema = "doc_id bigint, grouping string, script string, " + ", ".join(f"{n} {'bigint' if i < 6 else 'double'}" for i, n in enumerate(names))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return map_arrow(rows, per_batch, schema)


def length_class() -> Column:
    """Doublings of the number of tokens."""
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))).cast("int")


def _even_entropy() -> Column:
    """Entropy as a share of the most that the number of tokens allows, times that of ENTROPY_TOKENS."""
    most = F.log2(F.col("n_tokens").cast("double"))
    share = F.when(F.col("n_tokens") < 2, F.lit(1.0)).otherwise(F.col("entropy") / most)
    return share * float(np.log2(ENTROPY_TOKENS))


def _counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, class, bin, n) of every text with a token."""
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("measure"),
                length_class().alias("class"),
                F.floor(F.col(name) / grid).cast("bigint").alias("bin"),
            )
            for name, grid in GRID.items()
        )
    )
    binned = rows.filter(F.col("n_tokens") > 0).select(*keys, F.inline(entries))
    return binned.groupBy(*keys, "measure", "class", "bin").agg(F.count(F.lit(1)).alias("n"))


def _limits(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, n, low, high) of every group: exact quantiles over counts per bin."""
    keys = [*keys, "measure"]
    counts = counts.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("_upto", upto).withColumn("_all", F.sum("n").over(group))
    quantile = lambda q: F.min(F.when(F.col("_upto") >= F.col("_all") * q, F.col("bin")))
    found = placed.groupBy(*keys).agg(
        quantile(0.25).alias("q25"), quantile(0.5).alias("q50"), quantile(0.75).alias("q75"), F.max("_all").alias("n")
    )
    grid = F.create_map(*(x for name, step in GRID.items() for x in (F.lit(name), F.lit(step))))[F.col("measure")]
    middle = (F.col("q50") + 0.5) * grid
    least = F.greatest(middle * LEAST_SPREAD, grid)
    return found.select(
        *keys,
        "n",
        (middle - BAND * F.greatest((F.col("q50") - F.col("q25")) * grid, least)).alias("low"),
        (middle + BAND * F.greatest((F.col("q75") - F.col("q50")) * grid, least)).alias("high"),
    )


def bands(rows: DataFrame) -> DataFrame:
    """(grouping, measure, class, low, high) of the classes with enough texts."""
    found = _limits(_counts(rows, ["grouping"]), ["grouping", "class"])
    return found.filter(F.col("n") >= MIN_GROUP).select("grouping", "measure", "class", "low", "high")


def verdicts(rows: DataFrame) -> DataFrame:
    """``rows`` with base_failed, band_failed (measures outside their bands) and kept."""
    rows = staged(rows, "fertility-rows")
    # A few rows per group; all levels come from them.
    counts = staged(_counts(rows.withColumn("entropy", _even_entropy()), ["grouping", "script"]), "fertility-counts")

    def level(name: str, *keys: str, place: Column) -> DataFrame:
        """One row per key, with its bands: (place -> n, low, high)."""
        entry = F.struct(place, F.struct("n", "low", "high"))
        return _limits(counts, [*keys, *(["class"] if name == "_fine" else [])]).groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(name))

    fine = level("_fine", "grouping", place=F.concat_ws(":", "measure", F.col("class").cast("string")))
    joined = rows.join(fine, "grouping", "left")
    joined = joined.join(level("_group", "grouping", place=F.col("measure")), "grouping", "left")
    joined = joined.join(level("_scripts", "script", place=F.col("measure")), "script", "left")
    joined = joined.crossJoin(F.broadcast(level("_corpus", place=F.col("measure"))))

    def outside(name: str) -> Column:
        place = F.concat_ws(":", F.lit(name), length_class().cast("string"))
        band = F.try_element_at("_corpus", F.lit(name))
        for finer in (F.try_element_at("_scripts", F.lit(name)), F.try_element_at("_group", F.lit(name)), F.try_element_at("_fine", place)):
            narrow = finer["high"] - finer["low"] <= (band["high"] - band["low"]) * WIDE
            band = F.when((finer["n"] >= MIN_GROUP) & narrow, finer).otherwise(band)
        value = _even_entropy() if name == "entropy" else F.col(name)
        low, high = value < band["low"], value > band["high"]
        wrong = {"low": low, "high": high, "both": low | high}[SIDES[name]]
        return F.when(F.coalesce(wrong, F.lit(False)), F.lit(name))

    failed = F.filter(F.array(*map(outside, GRID)), lambda x: x.isNotNull())
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return (
        joined.withColumn("base_failed", base)
        .withColumn("band_failed", F.when(F.col("n_tokens") > 0, F.array_join(failed, ",")).otherwise(F.lit("")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("band_failed") == ""))
        .drop("_fine", "_group", "_scripts", "_corpus")
    )
