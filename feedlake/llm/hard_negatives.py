"""Hard-negative mining with an STR-packed R-tree per shard.

Rows are dealt to shards by ranges of (label, first coordinate, id), so that a shard holds few labels and
a label of any size is split.  Within a shard the rows of a label are packed by sort-tile-recursive:
sorted by one coordinate and cut into slabs, each slab sorted by the next one, down to leaves; neighbouring
leaves make nodes of ``FAN`` children.  Each box gives, coordinate by coordinate, an interval of products with
an anchor, and their sums an interval of scores.

Two searches go through the trees best first.  The first finds the positives of an anchor: the rows of its label
with the highest scores.  The second finds negatives for each pair of anchor and positive: rows of
other labels whose score lies in a window below the positive's.  A box whose interval misses the window is pruned, and
so is one strictly below the kth score so far; see ``boxes`` for how that score is handed on and for exact sums.

Rows.  Rows with a null id, label or vector, or with a null or non-finite component take no part;
vectors of different lengths count as ending in zeros.  Ties go to the smaller id.  Repeated rows
count once each, as positives and as negatives.  A row that bears the id of an anchor is never its positive or negative; of
anchor rows that share an id, the smallest (label, vector) is the anchor.  A positive with a
negative score has an empty window.  An empty table, or one label alone, gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import boxes
from feedlake.llm.common import remove, store

FAN = 8
#: Coordinates that the tiles are cut along: those of the widest spread.
TILE_DIMS = 3
#: Anchors at a time: each has several positives, and each pair is a query of the second search.
ANCHORS = 1_024

FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def str_leaves(points: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the leaves by sort-tile-recursive, neighbours next to each other."""
    spread = np.argsort(-np.ptp(points, axis=0), kind="stable")[:TILE_DIMS]
    yield from _tiles(points, np.arange(len(points)), list(spread))


def _tiles(points: np.ndarray, rows: np.ndarray, dims: list[int]) -> Iterator[np.ndarray]:
    leaves = -(-len(rows) // boxes.LEAF_ROWS)
    if leaves <= 1:
        yield rows
        return
    if dims:
        rows = rows[np.argsort(points[rows, dims[0]], kind="stable")]
    slabs = int(np.ceil(leaves ** (1 / len(dims)))) if len(dims) > 1 else leaves
    size = -(-leaves // slabs) * boxes.LEAF_ROWS
    for start in range(0, len(rows), size):
        yield from _tiles(points, rows[start : start + size], dims[1:])


def mine(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its ``positives``, the first ``negatives`` rows of other labels within the window.

    ``window``: percent of the positive's score.  Components become ``floor(scale * x)``.  Gives ``anchor_id``,
    ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.
    """
    spark = rows.sparkSession
    clean = rows.filter(F.col(id_col).isNotNull() & label.isNotNull() & boxes.usable(F.col(vec_col)))
    vectors = clean.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec"))
    ranged = vectors.repartitionByRange("label", F.get("vec", F.lit(0)), "vec_id")
    index = store(boxes.build_index(ranged, str_leaves, scale), "str_index")
    shards = index.select("shard").distinct().count()
    asked = clean.filter(is_anchor).select(
        F.col(id_col).cast("long").alias("vec_id"), F.struct(label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec")).alias("row")
    )
    anchors = store(asked.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"), "anchors")
    parts = []
    for block in boxes.blocks(anchors, ANCHORS):
        ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
        vec = np.floor(scale * boxes.matrix(block["vec"].combine_chunks()))
        asks = boxes.Queries(ids, vec, boxes.no_floor(len(ids)), labels)
        # At most ``positives`` rows for each anchor of the block.
        pairs = boxes.find(index, asks, positives, FAN, shards).select("q", "vec_id", "score").toArrow()
        q, score = pairs["q"].to_numpy(), pairs["score"].to_numpy()
        low, high = _share(score, window[0], up=True), _share(score, window[1], up=False)
        asks = boxes.Queries(ids[q], vec[q], boxes.no_floor(len(q)), labels[q], False, low, high)
        found = boxes.find(index, asks, negatives, FAN, shards).withColumnRenamed("score", "negative_score")
        named = _numbered(spark, ids[q], pairs["vec_id"].to_numpy(), score)
        mined = found.withColumnRenamed("vec_id", "negative_id").join(F.broadcast(named), "q")  # of one block
        parts.append(store(mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "mined"))
    remove(index)
    remove(anchors)
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], FOUND)


def _share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` of whole scores, rounded up or down to a whole number."""
    exact = [percent * int(s) for s in score]
    return np.array([-(-e // 100) if up else e // 100 for e in exact], np.longdouble)


def _numbered(spark, anchors: np.ndarray, positives: np.ndarray, scores: np.ndarray) -> DataFrame:
    names = ["q", "anchor_id", "positive_id", "positive_score"]
    columns = [np.arange(len(anchors), dtype=np.int32), anchors, positives, scores]
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))))
