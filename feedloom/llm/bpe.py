"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved until its parts have ``leaf_chars`` characters; parts are encoded by themselves, and two
neighbours are joined by encoding a window around their seam anew. The window grows until all tokens
outside of it provably stay:

* An edge of the window is *safe* where the character class changes and no match of the split pattern can
  reach over it: before white space, and between letters, digits and other signs in either order, but for an
  apostrophe followed by a letter. Nothing on one side of such an edge changes tokens on the other.
* Inside a run of one class (letters, digits, white space or other signs) longer than the window, an edge at a token boundary is accepted when
  the two tokens at the edge encode to themselves if they are encoded together. A sequence of tokens is the
  encoding of its bytes if and only if that holds for all its neighbours, so a join that keeps it at both
  edges is exact.
* Otherwise the window doubles, in the end up to both whole parts.

Parts and windows are encoded with the public rank file and the split pattern given. Decoding halves the
ids and concatenates the bytes up the tree.

Defined results: a null text is an empty one and has no tokens; text that looks like a special token is
ordinary text; repeated rows each get a row; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from feedloom.llm.common import map_arrow, text_or_empty

LEAF_CHARS = 2048
WINDOW_CHARS = 32
#: From here on a window edge may lie inside a run; shorter runs are taken into the window.
RUN_CHARS = 1024


@lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=4)
def _decimals(size: int) -> list[bytes]:
    return [b"%d" % i for i in range(size)]


@lru_cache(maxsize=1 << 16)
def _class(char: str) -> str:
    """L letter, N digit, S white space, O other, as the split pattern has them."""
    if char.isspace() and char not in "\x1c\x1d\x1e\x1f":
        return "S"
    kind = unicodedata.category(char)[0]
    return kind if kind in "LN" else "O"


def _safe(text: str, at: int) -> bool:
    """No token can reach over position ``at``, whatever surrounds these two characters."""
    if at <= 0 or at >= len(text):
        return True
    before, after = _class(text[at - 1]), _class(text[at])
    return before != "S" and before != after and not (text[at - 1] == "'" and after == "L")


class TreeCodec:
    """Encodes and decodes single texts by halves."""

    def __init__(self, ranks: bytes, pattern: str, leaf_chars: int = LEAF_CHARS, window_chars: int = WINDOW_CHARS, run_chars: int = RUN_CHARS):
        self.encoding = _encoding(ranks, pattern)
        self.leaf_chars, self.window_chars, self.run_chars = max(1, leaf_chars), max(1, window_chars), run_chars
        self.piece = lru_cache(maxsize=1 << 12)(self.encoding.decode_single_token_bytes)
        self.decimals = _decimals(self.encoding.max_token_value + 1)

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= self.leaf_chars:
            return self.encoding.encode_ordinary(text[start:end])
        middle = (start + end) // 2
        return self._join(text, start, middle, end, self._encode(text, start, middle), self._encode(text, middle, end))

    def _join(self, text: str, start: int, seam: int, end: int, left: list[int], right: list[int]) -> list[int]:
        reach = self.window_chars
        if _safe(text, seam):
            left += right
            return left
        while True:
            low = self._edge(text, seam, max(start, seam - reach), -1, start, end)
            high = self._edge(text, seam, min(end, seam + reach), 1, start, end)
            if low is not None and high is not None:
                joined = self._spliced(text, seam, low, high, left, right)
                if joined is not None:
                    return joined
            elif reach >= self.run_chars:
                joined = self._inside_run(text, start, seam, end, low, high, reach, left, right)
                if joined is not None:
                    return joined
            reach *= 2

    def _edge(self, text: str, seam: int, bound: int, step: int, start: int, end: int) -> int | None:
        """The safe position nearest to the seam, up to ``bound``; the ends of the two parts are safe for them."""
        for at in range(seam + step, bound + step, step):
            if at <= start or at >= end:
                return start if step < 0 else end
            if _safe(text, at):
                return at
        return None

    def _drop(self, ids: list[int], n_bytes: int, from_end: bool) -> int | None:
        """How many tokens cover exactly ``n_bytes`` at one side; None if a token reaches over that place."""
        count = 0
        for token in reversed(ids) if from_end else ids:
            if n_bytes <= 0:
                break
            n_bytes -= len(self.piece(token))
            count += 1
        return count if n_bytes == 0 else None

    def _spliced(self, text: str, seam: int, low: int, high: int, left: list[int], right: list[int]) -> list[int] | None:
        n_left = self._drop(left, len(text[low:seam].encode()), True)
        n_right = self._drop(right, len(text[seam:high].encode()), False)
        if n_left is None or n_right is None:
            return None
        del left[len(left) - n_left :]
        left += self.encoding.encode_ordinary(text[low:high])
        left += right[n_right:] if n_right else right
        return left

    def _inside_run(self, text, start, seam, end, low, high, reach, left, right) -> list[int] | None:
        """A join with one or both edges inside a run of one class, checked by the tokens at the edges."""
        run = text[max(start, seam - reach) if low is None else seam : min(end, seam + reach) if high is None else seam]
        kinds = {_class(x) for x in run} | {_class(text[seam - 1]), _class(text[seam])}
        if len(kinds) != 1:
            return None
        half = reach // 2
        near_left = len(text[low:seam].encode()) if low is not None else len(text[seam - half : seam].encode())
        near_right = len(text[seam:high].encode()) if high is not None else len(text[seam : seam + half].encode())
        n_left, got_left = self._cover(reversed(left), near_left)
        n_right, got_right = self._cover(right, near_right)
        if (low is not None and got_left != near_left) or (high is not None and got_right != near_right):
            return None
        # White space before a word is cut before its last sign, and other signs may end in an apostrophe of the next
        # piece, so both edges and the tokens beyond them must lie within what is known to be the run.
        if not kinds <= {"L", "N"}:
            beyond_left = got_left + (len(self.piece(left[len(left) - n_left - 1])) if n_left < len(left) else 0)
            beyond_right = got_right + (len(self.piece(right[n_right])) if n_right < len(right) else 0)
            if (low is None and beyond_left >= reach) or (high is None and beyond_right >= reach):
                return None
        middle = b"".join(map(self.piece, left[len(left) - n_left :] + right[:n_right]))
        if low is None and high is None:
            window = self.encoding._encode_single_piece(middle)
        else:
            try:
                window = self.encoding.encode_ordinary(middle.decode())
            except UnicodeDecodeError:
                return None
        if low is None and n_left < len(left) and not self._stable(left[len(left) - n_left - 1], window[0]):
            return None
        if high is None and n_right < len(right) and not self._stable(window[-1], right[n_right]):
            return None
        if (low is None and n_left == len(left)) or (high is None and n_right == len(right)):
            return None
        del left[len(left) - n_left :]
        left += window
        left += right[n_right:]
        return left

    def _cover(self, ids, n_bytes: int) -> tuple[int, int]:
        """Tokens from one side until at least ``n_bytes`` are covered, and the bytes they have."""
        count = got = 0
        for token in ids:
            if got >= n_bytes:
                break
            got += len(self.piece(token))
            count += 1
        return count, got

    def _stable(self, first: int, second: int) -> bool:
        return self.encoding._encode_single_piece(self.piece(first) + self.piece(second)) == [first, second]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_chars:
            return self.encoding.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def read_ranks(path: str) -> bytes:
    """The rank file: some 50,000 lines, below 1 MB, so it can be sent to every executor."""
    with open(path, "rb") as file:
        return file.read()


def encode_documents(
    spark: SparkSession,
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
    digests: bool = False,
) -> DataFrame:
    """Columns ``keep``, n_tokens, and ids with restored (whether they decode to the text's bytes).

    With ``digests``, ids_sha256 and decoded_sha256 instead: of the decimal ids and of the decoded bytes.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(rank_path))
    added = "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "restored"))

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = TreeCodec(ranks.value, pattern, leaf_chars)
        counts, first, second = [], [], []
        for text in batch.column(batch.num_columns - 1):
            text = text.as_py()
            ids = codec.encode(text)
            decoded = codec.decode(ids)
            counts.append(len(ids))
            if digests:
                first.append(hashlib.sha256(b" ".join([codec.decimals[x] for x in ids])).hexdigest())
                second.append(hashlib.sha256(decoded).hexdigest())
            else:
                first.append(np.array(ids, np.int32))
                second.append(decoded == text.encode())
        if digests:
            found = pa.array(first, pa.string())
        else:
            ends = np.cumsum([0, *counts], dtype=np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first)))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), found, pa.array(second)], [*keep, *added])

    kinds = ("long", "string", "string") if digests else ("long", ArrayType(IntegerType()), "boolean")
    schema = docs.select(*keep).schema
    for name, kind in zip(added, kinds):
        schema = schema.add(name, kind)
    return map_arrow(docs.select(*keep, text_or_empty(text_col).alias("__text")), per_batch, schema)


def decode_documents(spark: SparkSession, encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; bytes that are no UTF-8 become replacement signs. Null ids are none."""
    ranks = spark.sparkContext.broadcast(read_ranks(rank_path))

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = TreeCodec(ranks.value, pattern)
        texts = [codec.decode(x or []).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), ids_col), per_batch, "doc_id bigint, text string")
