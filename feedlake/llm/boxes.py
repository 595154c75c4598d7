"""Exact searches over vectors by trees of bounding boxes, one tree per shard of rows.

A shard is a run of at most ``SHARD_ROWS`` rows of one partition.  Its rows are dealt to leaves by a
function of the caller, and the leaves with their boxes are written as rows of an index table.  A
search reads the index, builds the inner nodes over the leaves of each shard from their boxes, and
goes through them best first: every query has a queue of nodes, ordered by the highest score that
a box allows, and stops when that is strictly below the score of its kth row so far.  That score is
handed on from shard to shard within a task, and a first search over a part of the shards
(``PROBE_SHARDS``) gives it to all tasks of the second, which covers all shards.

Scores are inner products of whole numbers, and exact: they are taken in doubles where no sum can
pass 2^53, else in long doubles; where a sum may not fit a long, an OverflowError is raised.

Queries go through all rows in blocks of at most ``BLOCK`` on average, each sent to every task; the
number of blocks grows with the queries, their size does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import ship

SHARD_ROWS = 4_096
LEAF_ROWS = 128
BLOCK = 4_096
#: Of the shards, one of eight is searched first, or about this many if that is less.
PROBE_SHARDS = 32

INDEX = "shard long, leaf long, label long, ids array<long>, points binary, low binary, high binary"
FOUND = "q int, vec_id long, score long"
NOTHING = -np.inf

Leaves = Iterator[np.ndarray]


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector.cast("array<double>"), wrong)


def matrix(vectors: pa.Array) -> np.ndarray:
    """One row per vector; shorter ones end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(int)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widened(points: np.ndarray, width: int) -> np.ndarray:
    return np.pad(points, ((0, 0), (0, width - points.shape[1])))


# --- index ---------------------------------------------------------------------------


def _shards(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and scaled vectors of up to ``SHARD_ROWS`` rows at a time."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SHARD_ROWS - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == SHARD_ROWS:
                yield _shard(held, scale)
                held, n = [], 0
    if held:
        yield _shard(held, scale)


def _shard(held: list[pa.RecordBatch], scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = pa.Table.from_batches(held).combine_chunks()
    whole = lambda name: rows[name].to_numpy().astype(np.int64)
    return whole("vec_id"), whole("label"), np.floor(scale * matrix(pa.concat_arrays(rows["vec"].chunks)))


def _binary(points: np.ndarray) -> bytes:
    """Whole numbers as floats where these hold them exactly, else as doubles; the first byte tells."""
    small = bool(np.abs(points).max(initial=0) < 1 << 24)
    return bytes([small]) + points.astype(np.float32 if small else np.float64).tobytes()


def _numbers(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, np.float32 if stored[0] else np.float64, offset=1).astype(np.float64)


def build_index(rows: DataFrame, leaves: Callable[[np.ndarray], Leaves], scale: int) -> DataFrame:
    """One row per leaf; ``rows`` are ``vec_id``, ``label``, ``vec``, whose components become ``floor(scale * x)``.

    ``leaves`` deals the rows of one label of a shard to leaves, so a leaf has one label.
    """
    ship(rows.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for ids, labels, points in _shards(batches, scale):
            out = []
            for label in np.unique(labels):
                own = np.flatnonzero(labels == label)
                for picked in leaves(points[own]):
                    at = own[picked]
                    box = points[at].min(axis=0), points[at].max(axis=0)
                    out.append((shard, len(out), int(label), ids[at], _binary(points[at]), *map(_binary, box)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _INDEX_TYPES, strict=True)],
                ["shard", "leaf", "label", "ids", "points", "low", "high"],
            )
            shard += 1

    plain = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vec").cast("array<double>"))
    return plain.mapInArrow(build, INDEX)


_INDEX_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


class Tree:
    """The leaves of a shard, which come first, and the nodes over each ``fan`` neighbouring ones, up to the root."""

    def __init__(self, rows: list[dict], fan: int, width: int) -> None:
        self.ids = [np.array(r["ids"], np.int64) for r in rows]
        self.points = [_numbers(r["points"]).reshape(len(i), -1) for r, i in zip(rows, self.ids, strict=True)]
        self.width = max(width, *(p.shape[1] for p in self.points))
        self.points = [widened(p, self.width) for p in self.points]
        box = lambda name: [widened(_numbers(r[name])[None], self.width)[0] for r in rows]
        low, high = box("low"), box("high")
        first = [r["label"] for r in rows]
        last = list(first)
        self.children: list[list[int]] = []
        level = [(r["leaf"], i) for i, r in enumerate(rows)]
        while len(level) > 1:
            above = []
            for number, group in groupby(level, key=lambda x: x[0] // fan):
                kids = [i for _, i in group]
                above.append((number, len(low)))
                low.append(np.min([low[i] for i in kids], axis=0))
                high.append(np.max([high[i] for i in kids], axis=0))
                first.append(min(first[i] for i in kids))
                last.append(max(last[i] for i in kids))
                self.children.append(kids + [-1] * (fan - len(kids)))
            level = above
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last = np.array(first), np.array(last)
        self.kids = np.array(self.children, int).reshape(-1, fan)


def _trees(batches: Iterator[pa.RecordBatch], fan: int, width: int) -> Iterator[Tree]:
    """The trees of an index; leaves of a shard that lie in two batches make a tree in each."""
    for batch in batches:
        for _, rows in groupby(batch.to_pylist(), key=lambda r: r["shard"]):
            yield Tree(sorted(rows, key=lambda r: r["leaf"]), fan, width)


# --- search --------------------------------------------------------------------------


@dataclass(frozen=True)
class Queries:
    """A block of queries, by number.

    ``own``: rows of this id are never found.  ``label``: only rows of the same label count
    (``same``), or only rows of others.  ``low`` and ``high``: scores that count.  ``floor``: a score that
    the kth row is known to reach.
    """

    own: np.ndarray
    vectors: np.ndarray
    floor: np.ndarray
    label: np.ndarray | None = None
    same: bool = True
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Best:
    """The first ``k`` rows of each query so far: highest score, then smallest id."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.k, self.kth = k, floor.astype(np.longdouble)
        self.q, self.ids, self.scores = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.longdouble)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, ids = np.concatenate([self.q, q]), np.concatenate([self.ids, ids])
        scores = np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.q, self.ids, self.scores = q[keep], ids[keep], scores[keep]
        last = place == self.k - 1
        self.kth[q[last]] = np.maximum(self.kth[q[last]], scores[last])


def _exact(queries: np.ndarray, tree: Tree) -> type:
    reach = int(np.abs(queries).max(initial=0)) * int(max(np.abs(tree.low).max(initial=0), np.abs(tree.high).max(initial=0)))
    reach *= max(1, tree.width)
    if reach >= 1 << 63:
        raise OverflowError("inner products may not fit a long")
    return np.float64 if reach < 1 << 53 else np.longdouble


def best_first(tree: Tree, queries: Queries, best: Best) -> None:
    """Bring ``best`` up to date with the rows of a tree."""
    own_vectors = widened(queries.vectors, tree.width)
    kind = _exact(own_vectors, tree)
    vectors, low, high = own_vectors.astype(kind), tree.low.astype(kind), tree.high.astype(kind)
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    # What a box allows: each coordinate gives an interval of products, and their sums bound the score.
    most = up @ high.T + down @ low.T
    if queries.low is not None:
        least = up @ low.T + down @ high.T
        outside = (most < queries.low[:, None]) | (least > queries.high[:, None])
        most = np.where(outside, NOTHING, np.minimum(most, queries.high[:, None]))
    if queries.label is not None:
        label = queries.label[:, None]
        inside = (tree.first <= label) & (label <= tree.last)
        most[~inside if queries.same else inside & (tree.first == tree.last)] = NOTHING
    most = np.hstack([most, np.full((len(most), 1), NOTHING, most.dtype)])  # for children that are not there
    leaves = len(tree.ids)
    queue = np.full(most.shape, NOTHING, most.dtype)
    root = len(tree.low) - 1
    queue[:, root] = most[:, root]
    active = np.arange(len(vectors))
    while len(active):
        open_nodes = queue[active]
        node = open_nodes.argmax(axis=1)
        value = open_nodes[np.arange(len(active)), node]
        go = (value > NOTHING) & (value >= best.kth[active])
        active, node = active[go], node[go]
        queue[active, node] = NOTHING
        inner = node >= leaves
        parents = active[inner][:, None]
        kids = tree.kids[node[inner] - leaves]
        queue[parents, kids] = most[parents, kids]
        if not inner.all():
            _read_leaves(tree, queries, vectors, best, active[~inner], node[~inner])


def _read_leaves(tree: Tree, queries: Queries, vectors: np.ndarray, best: Best, active: np.ndarray, leaf: np.ndarray) -> None:
    order = np.argsort(leaf, kind="stable")
    active, leaf = active[order], leaf[order]
    numbers, starts = np.unique(leaf, return_index=True)
    met = []
    for number, q in zip(numbers, np.split(active, starts[1:]), strict=True):
        ids = tree.ids[number]
        scores = vectors[q] @ tree.points[number].astype(vectors.dtype).T
        fits = (scores >= best.kth[q][:, None]) & (ids != queries.own[q][:, None])
        if queries.low is not None:
            fits &= (scores >= queries.low[q][:, None]) & (scores <= queries.high[q][:, None])
        if scores.shape[1] > best.k:  # rows behind k others of this leaf alone
            kth = np.partition(np.where(fits, scores, NOTHING), -best.k, axis=1)[:, -best.k]
            fits &= scores >= kth[:, None]
        i, j = np.nonzero(fits)
        met.append((q[i], ids[j], scores[i, j]))
    best.add(*map(np.concatenate, zip(*met, strict=True)))


def _search(index: DataFrame, queries: Queries, k: int, fan: int) -> DataFrame:
    """``FOUND``: of each task the first ``k`` rows of each query, by its number."""
    sent = index.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = Best(block.floor, k)
        for tree in _trees(batches, fan, block.vectors.shape[1]):
            best_first(tree, block, best)
        # A long double holds every long exactly.
        columns = [pa.array(best.q, pa.int32()), pa.array(best.ids, pa.int64()), pa.array(best.scores.astype(np.int64), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["q", "vec_id", "score"])

    return index.mapInArrow(search, FOUND)


def first_k(found: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """The first ``k`` rows of each query with their ``rank``: highest score, then smallest id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def find(index: DataFrame, queries: Queries, k: int, fan: int, shards: int) -> DataFrame:
    """``q``, ``vec_id``, ``score``, ``rank`` of the first ``k`` rows of each query, over all shards."""
    share = max(8, shards // PROBE_SHARDS)
    probe = index.filter(F.pmod(F.xxhash64("shard"), F.lit(share)) == 0)
    # One number per query of the block.
    known = first_k(_search(probe, queries, k, fan), k, ["q"]).filter(F.col("rank") == k).select("q", "score").toArrow()
    floor = queries.floor.copy()
    floor[known["q"].to_numpy()] = known["score"].to_numpy()
    return first_k(_search(index, replace(queries, floor=floor), k, fan), k, ["q"])


def no_floor(n: int) -> np.ndarray:
    return np.full(n, NOTHING, np.longdouble)


def blocks(queries: DataFrame, most: int = BLOCK) -> Iterator[pa.Table]:
    """The rows of a stored table of queries, ``most`` at a time on average, dealt by their ``vec_id``."""
    n = -(-queries.count() // most)
    for b in range(n):
        yield queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == b).toArrow()
