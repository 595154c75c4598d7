"""Exact top-k search by inner product: a KD-tree per shard, gone through best first.

Rows are split at the median of the coordinate with the widest spread, again and again, until
a leaf holds at most ``LEAF_ROWS``; every node has the tight box around its rows.  The highest inner product
that a box allows bounds what stands below it, and a box strictly below the kth score so far is
never opened; see ``boxes`` for how that score is handed on and for exact sums.

A shard is a run of rows as they lie, so no vector is shuffled to build the index; the index is
written once, and each block of queries reads it.  What meets in a shuffle are at most k rows per query
and task.

Rows.  Rows with a null id, a null vector, or a null or non-finite component take no part; vectors of
different lengths count as ending in zeros; an empty vector scores 0.  Ties go to the smaller
id.  Repeated rows are found once each.  A row that bears the id of a query is never found by it; of query rows that
share an id, the smallest vector is the query.  Without rows or queries the result is empty.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import boxes
from feedlake.llm.common import remove, store


def median_leaves(points: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the leaves, in the order of the tree; all leaves lie equally deep."""
    parts = [np.arange(len(points))]
    while max(map(len, parts)) > boxes.LEAF_ROWS:
        parts = [half for rows in parts for half in _halves(points, rows)]
    yield from parts


def _halves(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, middle = points[rows], len(rows) // 2
    widest = np.ptp(own, axis=0).argmax() if own.shape[1] else 0
    order = np.argpartition(own[:, widest], middle) if own.shape[1] else np.arange(len(rows))
    return rows[order[:middle]], rows[order[middle:]]


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row that ``is_query``, the ``k`` best other rows.

    Components become ``floor(scale * x)``.
    """
    clean = rows.filter(F.col(id_col).isNotNull() & boxes.usable(F.col(vec_col)))
    vectors = clean.select(F.col(id_col).alias("vec_id"), F.lit(0).alias("label"), F.col(vec_col).alias("vec"))
    index = store(boxes.build_index(vectors, median_leaves, scale), "kd_index")
    shards = index.select("shard").distinct().count()
    asked = clean.filter(is_query).groupBy(F.col(id_col).cast("long").alias("vec_id"))
    queries = store(asked.agg(F.min(F.col(vec_col).cast("array<double>")).alias("vec")), "queries")
    parts = []
    for block in boxes.blocks(queries):
        ids = block["vec_id"].to_numpy()
        vec = np.floor(scale * boxes.matrix(block["vec"].combine_chunks()))
        found = boxes.find(index, boxes.Queries(ids, vec, boxes.no_floor(len(ids))), k, 2, shards)
        named = F.broadcast(_numbered(rows.sparkSession, ids))  # of one block
        parts.append(store(found.join(named, "q").select("query_id", "rank", "vec_id", "score"), "top"))
    remove(index)
    remove(queries)
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionAll, parts)


def _numbered(spark, ids: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "q int, query_id long")
