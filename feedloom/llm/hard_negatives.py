"""Hard negatives by an inverted multi-index over embeddings.

Components are whole numbers, floor(256 x), so scores are exact. A vector is cut into two halves, and each half has a
codebook of its own; a pair of codes is a *cell*. The index holds every row, packed into blocks of one cell.

By Cauchy and Schwarz, half a query q scores at most  q c + |q| r  with the half of any row of code c, r being the
largest distance of such a half from c. The sum for both halves bounds the scores of a cell. Per anchor, a heap walks
the two sorted lists of half bounds and yields cells by falling sum (the multi-sequence algorithm). The walk stops where
no unvisited cell can change the answer:

1. A probe visits the best cells, some ``PROBE`` rows. Once five rows of the anchor's label are known, the fifth score
   is a floor: the walk goes on to the last cell whose bound reaches it, and the positives are certified. Otherwise it
   goes on with eight times as many rows.
2. A positive of score P opens the window from 0.8 P to P. A probe gives each window its provisional negatives, and the
   window is certified when the bound falls below its fifth score, or its lower edge. That holds for the
   whole anchor once it holds for all its windows.

So answers are those of a complete search, whatever the codebooks; these decide only how many cells are visited.

Anchors are taken in groups of ``ANCHOR_BYTES``, so what is broadcast is bounded at every size, and index blocks
stay where they are: a task scores its blocks against the anchors that visit them, and hands on at most five
rows per anchor and window. The codebooks are fitted on at most ``SAMPLE_ROWS`` rows (those of smallest
hash); nothing else is sampled.

Defined results: rows with a null label or vec_id, a null vector, a null, infinite or not-a-number component, or one of
2^31 grid steps or more take no part, nor do rows whose squared length exceeds 62 bits, as their scores would not fit.
A shorter vector has zeros behind its end. Repeated rows are candidates each by itself, never for an anchor of their own
vec_id; equal anchors are searched once. A positive below zero has no negatives, as its window is empty. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.vectors import dimensions, matrix, on_grid, padded, usable
from feedloom.operators.segments import add_rank, top_rows
from feedloom.operators.stage import staged

GRID = 256.0
TOP = 5
CODES = 32
SAMPLE_ROWS = 16384
ROUNDS = 8
PROBE = 2048
BLOCK_ROWS = 1024
ANCHOR_BYTES = 1 << 24
#: Index rows of a task, before compression.
TASK_BYTES = 1 << 25
#: Anchors scored at once against a block: bounds a matrix of scores to 16 MB.
_STRIP = 2048
_EXACT = 2**53
RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


# ---- rows -----------------------------------------------------------------------------------------------------


def rotated_label(row_id: Column, label: Column) -> Column:
    """The label, but where the id is divisible by 7 the next of ten."""
    return F.when(F.pmod(row_id, F.lit(7)) == 0, (label.cast("bigint") + 1) % 10).otherwise(label.cast("bigint"))


def grid_rows(embeddings: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the rows that take part, v of one length; and that length."""
    vector = F.col(vector_col)
    kept = embeddings.filter(usable(vector, GRID) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), on_grid(vector, GRID).alias("v")
    )
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = staged(kept.filter(F.col("label").isNotNull() & (length < 2.0**62)), "negatives-rows")
    size = dimensions(rows, "v")
    return rows.select("vec_id", "label", padded(F.col("v"), size).alias("v")), size


# ---- index ----------------------------------------------------------------------------------------------------


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmin((codes * codes).sum(axis=1) - 2.0 * points @ codes.T, axis=1)


def _codebook(points: np.ndarray, codes: int) -> np.ndarray:
    """Centres of k-means from evenly spaced sample rows; at least one."""
    centres = points[np.linspace(0, len(points) - 1, min(codes, len(points))).astype(int)].copy() if len(points) else np.zeros((1, points.shape[1]))
    for _ in range(ROUNDS if len(points) else 0):
        near = _nearest(points, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(axis=0)
    return centres


@dataclass(frozen=True)
class Index:
    """Blocks of all rows with their cell, and per half the codes and the largest distance from each."""

    blocks: DataFrame | None
    codes: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    size: int

    @property
    def half(self) -> int:
        return self.size // 2

    def half_bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest score of each half, for every code; widened by what rounding may take away."""
        parts = q[: self.half].astype(float), q[self.half :].astype(float)
        found = []
        for part, codes, radii in zip(parts, self.codes, self.radii):
            length = np.linalg.norm(part)
            slack = 1e-9 * (1.0 + length * (np.linalg.norm(codes, axis=1) + radii))
            found.append(codes @ part + length * radii + slack)
        return found[0], found[1]


def build_index(rows: DataFrame, size: int, codes: int = CODES, sample_rows: int = SAMPLE_ROWS) -> Index:
    """Fit both codebooks on a bounded sample, then place and pack every row."""
    half = size // 2
    sample = rows.orderBy(F.xxhash64("vec_id", "label"), "vec_id").limit(sample_rows).select("v").toArrow()
    points = matrix(sample.column(0).combine_chunks(), size).astype(float)
    books = _codebook(points[:, :half], codes), _codebook(points[:, half:], codes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(2), size).astype(float)
            near, away = [], []
            for part, book in ((v[:, :half], books[0]), (v[:, half:], books[1])):
                near.append(_nearest(part, book))
                away.append(np.linalg.norm(part - book[near[-1]], axis=1))
            cell = (near[0] * len(books[1]) + near[1]).astype(np.int32)
            columns = [*batch.columns, pa.array(cell), pa.array(away[0]), pa.array(away[1])]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "cell", "away1", "away2"])

    placed = staged(rows.mapInArrow(place, "vec_id bigint, label bigint, v array<bigint>, cell int, away1 double, away2 double"), "negatives-placed")
    # One row per cell in use: at most the product of the codebooks' sizes.
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away1").alias("r1"), F.max("away2").alias("r2")).collect()
    counts = np.zeros(len(books[0]) * len(books[1]), np.int64)
    radii = np.zeros(len(books[0])), np.zeros(len(books[1]))
    for c in cells:
        counts[c.cell] = c.n
        i, j = divmod(c.cell, len(books[1]))
        radii[0][i], radii[1][j] = max(radii[0][i], c.r1), max(radii[1][j], c.r2)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(cell)) + 1
            cuts = [x for a, b in zip([0, *edges], [*edges, len(cell)]) for x in range(a, b, BLOCK_ROWS)] + [len(cell)]
            ids, labels, v = batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch.column(3), size).astype("<i4")
            spans = list(zip(cuts, cuts[1:]))
            packed = [[x[a:b].tobytes() for a, b in spans] for x in (ids, labels, v)]
            arrays = [pa.array([cell[a] for a, _ in spans], pa.int32()), *(pa.array(x, pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "ids", "labels", "v"])

    # Ranges of cell and hash: a cell with a third of all rows is spread over many tasks.
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(counts.sum()) * (4 * size + 16) // TASK_BYTES)
    spread = placed.withColumn("_h", F.xxhash64("vec_id")).repartitionByRange(tasks, "cell", "_h").sortWithinPartitions("cell", "_h")
    blocks = staged(spread.select("cell", "vec_id", "label", "v").mapInArrow(pack, "cell int, ids binary, labels binary, v binary"), "negatives-index")
    return Index(blocks, books, radii, counts, size)


def walk(index: Index, q: np.ndarray, floor: float | None, rows: int) -> tuple[list[int], float]:
    """Cells by falling bound, and the bound of the next one (-inf: none is left).

    With a ``floor``, all cells whose bound reaches it; without, cells of ``rows`` rows or a few more.
    """
    bounds = index.half_bounds(q)
    orders = [np.argsort(-b, kind="stable") for b in bounds]
    first, second = (b[o] for b, o in zip(bounds, orders))
    width = len(second)
    heap, pushed, cells, seen = [(-(first[0] + second[0]), 0, 0)], {(0, 0)}, [], 0
    while heap:
        bound, i, j = heap[0]
        if -bound < floor if floor is not None else seen >= rows:
            return cells, -bound
        heapq.heappop(heap)
        cell = int(orders[0][i]) * width + int(orders[1][j])
        if index.counts[cell]:
            cells.append(cell)
            seen += int(index.counts[cell])
        for at in ((i + 1, j), (i, j + 1)):
            if at[0] < len(first) and at[1] < width and at not in pushed:
                pushed.add(at)
                heapq.heappush(heap, (-(first[at[0]] + second[at[1]]), *at))
    return cells, float("-inf")


# ---- search ---------------------------------------------------------------------------------------------------


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T  # no sum leaves 64 bits: lengths are below 2^31


class _Best:
    """The first rows of every (anchor, slot) by falling score, then id."""

    def __init__(self, floors: np.ndarray, top: int):
        self.floors, self.top = floors.copy(), top  # a row below the floor of its anchor and slot is not wanted
        self.kept = [np.empty(0, np.int64)] * 4
        self.waiting: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(anchor):
            self.waiting.append([anchor, slot, score, ids])
            self.size += len(anchor)
            if self.size > 200_000:
                self.settle()

    def settle(self) -> list[np.ndarray]:
        anchor, slot, score, ids = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((ids, -score, slot, anchor))
        anchor, slot, score, ids = (x[order] for x in (anchor, slot, score, ids))
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
        starts = np.flatnonzero(new)
        place = np.arange(len(anchor)) - np.repeat(starts, np.diff([*starts, len(anchor)]))
        last = place == self.top - 1
        self.floors[anchor[last], slot[last]] = np.maximum(self.floors[anchor[last], slot[last]], score[last])
        keep = place < self.top
        self.kept, self.waiting, self.size = [x[keep] for x in (anchor, slot, score, ids)], [], 0
        return self.kept


_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_FOUND = "anchor bigint, slot bigint, score bigint, vec_id bigint"


@dataclass
class _Group:
    """A bounded group of anchors as arrays, and what they look for: per slot, scores from ``lower`` to ``upper``.

    Rows of the anchor's own label are wanted, or those of all others. ``floors`` starts at ``lower`` and rises to the
    last score of a full slot; ``visits`` marks the cells that an anchor visits.
    """

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    own_label: bool
    lower: np.ndarray
    upper: np.ndarray
    floors: np.ndarray
    visits: np.ndarray | None = None

    def look_for(self, own_label: bool, lower: np.ndarray, upper: np.ndarray) -> None:
        self.own_label, self.lower, self.upper, self.floors = own_label, lower, upper, lower.copy()


def _score_blocks(index: Index, group: _Group, top: int) -> DataFrame:
    """(anchor, slot, score, vec_id): the first ``top`` wanted rows of the visited cells."""
    shared, size = index.blocks.sparkSession.sparkContext.broadcast(group), index.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        best = _Best(g.floors, top)
        for batch in batches:
            for cell, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                visiting = np.flatnonzero(g.visits[:, cell])
                ids, labels, v = (np.frombuffer(x, kind) for x, kind in zip(packed, ("<i8", "<i8", "<i4")))
                for at in range(0, len(visiting), _STRIP):
                    _score_strip(best, g, visiting[at : at + _STRIP], ids, labels, v.reshape(-1, size).astype(np.int64))
        found = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["anchor", "slot", "score", "vec_id"])

    found = index.blocks.mapInArrow(run, _FOUND)
    return top_rows(found, ["anchor", "slot"], [F.desc("score"), F.asc("vec_id")], top, "place").drop("place")


def _score_strip(best: _Best, g: _Group, who: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
    scores = _scores(g.v[who], v)
    wanted = (g.labels[who][:, None] == labels[None, :]) == g.own_label
    least, most = best.floors[who].min(axis=1), g.upper[who].max(axis=1)
    a, b = np.nonzero(wanted & (scores >= least[:, None]) & (scores <= most[:, None]))
    anchors, found, others = who[a], scores[a, b], ids[b]
    away = others != g.ids[anchors]
    for slot in range(g.upper.shape[1]):
        fits = away & (found >= best.floors[anchors, slot]) & (found <= g.upper[anchors, slot])
        best.add(anchors[fits], np.full(int(fits.sum()), slot, np.int64), found[fits], others[fits])


def _plan(anchors: DataFrame, index: Index, floors: dict[int, float], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that each anchor visits (as a mask) and the bound of the next one; the walks run as tasks."""
    local = Index(None, index.codes, index.radii, index.counts, index.size)
    cells = len(index.counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, bounds = [], []
            for number, q in zip(batch.column(0).to_pylist(), matrix(batch.column(1), local.size)):
                visited, bound = walk(local, q, floors.get(number), rows)
                mask = np.zeros(cells, bool)
                mask[visited] = True
                masks.append(np.packbits(mask).tobytes())
                bounds.append(bound)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(masks, pa.binary()), pa.array(bounds, pa.float64())], ["anchor", "visits", "bound"])

    found = anchors.select("anchor", "v").mapInArrow(run, "anchor bigint, visits binary, bound double").collect()
    masks, bounds = np.zeros((len(found), cells), bool), np.zeros(len(found))
    for r in found:
        masks[r.anchor] = np.unpackbits(np.frombuffer(r.visits, np.uint8), count=cells).astype(bool)
        bounds[r.anchor] = r.bound
    return masks, bounds


def _search(anchors: DataFrame, group: _Group, index: Index, top: int, probe: int) -> DataFrame:
    """The certified first ``top`` rows of every (anchor, slot)."""
    open_ = group.upper >= group.lower
    floors: dict[int, float] = {}
    rows = probe
    while True:
        group.visits, bounds = _plan(anchors, index, floors, rows)
        found = staged(_score_blocks(index, group, top), "negatives-found")
        full = found.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(F.col("n") == top)
        for r in full.collect():
            group.floors[r.anchor, r.slot] = r.s
        # A slot that can hold nothing asks for nothing.
        reach = np.where(open_, group.floors.astype(float), np.inf).min(axis=1)
        if (bounds < reach).all():
            return found
        floors = {i: float(x) for i, x in enumerate(reach) if x > float(_LEAST)}
        rows *= 8


def _collected(anchors: DataFrame, size: int) -> _Group:
    """Anchors of one bounded group, in order of their number; they look for all rows of their own label."""
    rows = anchors.select("anchor", "vec_id", "label", "v").orderBy("anchor").toArrow()
    ids, labels = (rows.column(i).to_numpy().astype(np.int64) for i in (1, 2))
    least = np.full((len(ids), 1), _LEAST)
    return _Group(ids, labels, matrix(rows.column(3).combine_chunks(), size), True, least, np.full((len(ids), 1), _MOST), least.copy())


def _mine_group(anchors: DataFrame, index: Index, top: int, probe: int) -> DataFrame:
    group = _collected(anchors, index.size)
    positives = _search(anchors, group, index, top, probe)
    ranked = staged(top_rows(positives, ["anchor"], [F.desc("score"), F.asc("vec_id")], top, "pos"), "negatives-positives")
    # A slot per positive; places that aren't taken, and scores below zero, leave it empty.
    lower, upper = np.zeros((len(group.ids), top), np.int64), np.full((len(group.ids), top), -1)
    for r in ranked.select("anchor", "pos", "score").filter("score >= 0").collect():
        lower[r.anchor, r.pos - 1], upper[r.anchor, r.pos - 1] = -(-80 * r.score // 100), r.score
    group.look_for(False, lower, upper)
    found = _search(anchors, group, index, top, probe)
    negatives = top_rows(found, ["anchor", "slot"], [F.desc("score"), F.asc("vec_id")], top, "rank")
    left = ranked.select("anchor", (F.col("pos") - 1).cast("bigint").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    right = negatives.select("anchor", "slot", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return left.join(right, ["anchor", "slot"]).join(named, "anchor").select(*RESULT)


def mine(
    rows: DataFrame, size: int, is_anchor: Column, top: int = TOP, codes: int = CODES, probe: int = PROBE, anchor_bytes: int = ANCHOR_BYTES
) -> DataFrame:
    """``RESULT`` of all anchors among ``rows`` (vec_id, label, v)."""
    spark = rows.sparkSession
    asked = rows.filter(is_anchor).dropDuplicates()
    numbered = staged(add_rank(asked, [], ["vec_id", "label", "v"], "_n").withColumn("_n", F.col("_n") - 1), "negatives-anchors")
    n = numbered.count()
    if not n or not size:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    index = build_index(rows, size, codes)
    step = max(1, anchor_bytes // (8 * size + len(index.counts) + 24 * top))
    result = None
    for at in range(0, n, step):
        group = numbered.filter(F.col("_n").between(at, at + step - 1)).withColumn("anchor", F.col("_n") - at).drop("_n")
        part = staged(_mine_group(group, index, top, probe), "negatives-group")
        result = part if result is None else result.unionByName(part)
    return result


def hard_negatives(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, with every seventh label moved on."""
    rows, size = grid_rows(embeddings, rotated_label(F.col(id_col), F.col(label_col)), id_col, vector_col)
    return mine(rows, size, F.pmod("vec_id", F.lit(every)) == 0)
