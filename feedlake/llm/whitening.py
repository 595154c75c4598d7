"""Embedding whitening with principal components from FEAST contour integration.

*Moments.*  Each task sums its rows once: count, exact sums per dimension, and the centred products of its own
rows, merged batch by batch.  A second step centres these on the overall mean; Spark adds them up.  So a
covariance is never taken as a difference of two large sums.

*Components.*  The covariance has as many rows as a vector has entries, whatever the number of vectors.  The inertia of
``V - s I`` (signs of an L D L' factorisation) counts the eigenvalues above any ``s``.  By such counts the line is cut, in gaps
of the spectrum, into intervals that hold a few of the wanted eigenvalues each.  Each interval is a row of a
Spark job: quadrature along a circle around it, of solutions of ``(z I - V) X = Y`` for complex ``z``, projects a random block onto the
eigenvectors inside, Rayleigh-Ritz extracts them, and the block is filtered again until the residuals are at rounding level.
An interval that ends with another number than the inertia count is an error, so none is missed.

*Whitening.*  Rows are projected where they lie, without a shuffle.

Rows.  A null vector, or one with a null or non-finite entry, takes no part.  Vectors of different lengths count as ending in
entries of 0.  Repeated rows, rows with equal vectors and rows with a null id all count and are all returned.  Components of no
variance (below 1e-12 of the largest) do not exist, so fewer than ``most`` may be returned; of one row, of equal rows, or
of an empty table there are none and the result is empty.  Of equal eigenvalues any orthonormal basis may come.  A sum
of deviations beyond a long is null; an entry beyond ``2^52`` is an error.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.boxes import matrix, usable, widened
from feedlake.llm.common import remove, ship, store

SCALE, OFFSET = 1024, 100_000
#: Points of the quadrature on the upper half of a circle, and rounds of filtering.
POINTS, ROUNDS = 16, 20
#: Wanted eigenvalues in one interval, and its radius in terms of the room between its ends and the eigenvalues beyond.
PER_INTERVAL = 4
ROOM = 8
#: Two eigenvalues closer than this share of the largest are not parted by a cut.
GAP = 1e-7
SMALLEST = 1e-12
#: The covariance is held whole by the driver and by the tasks of the intervals.
MAX_WIDTH = 4_096


# --- moments -------------------------------------------------------------------------


@dataclass
class Moments:
    """Count, sums and centred products of some rows."""

    n: int
    sums: list[int]
    products: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        centred = x - x.mean(axis=0)
        return cls(len(x), [int(s) for s in _column_sums(x)], centred.T @ centred)

    def widened(self, width: int) -> Moments:
        """With further dimensions, whose entries were all 0."""
        more = width - len(self.sums)
        return Moments(self.n, self.sums + [OFFSET * self.n] * more, np.pad(self.products, ((0, more), (0, more))))

    def merged(self, other: Moments) -> Moments:
        width = max(len(self.sums), len(other.sums))
        a, b = self.widened(width), other.widened(width)
        apart = b.mean - a.mean
        between = np.outer(apart, apart) * (a.n * b.n / (a.n + b.n))
        return Moments(a.n + b.n, [s + t for s, t in zip(a.sums, b.sums, strict=True)], a.products + b.products + between)


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of whole numbers."""
    if len(x) * np.abs(x).max(initial=0) < 1 << 53:
        return x.sum(axis=0)
    return x.astype(np.int64).astype(object).sum(axis=0)


def scaled(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """``floor(SCALE * c) + OFFSET`` of each entry, exact in doubles; at least ``width`` of them."""
    entries = matrix(vectors)
    x = np.floor(SCALE * widened(entries, max(width, entries.shape[1]))) + OFFSET
    if np.abs(x).max(initial=0) >= 1 << 52:
        raise OverflowError("entries of 2^52 or more are not exact")
    return x


def partial_moments(rows: DataFrame) -> DataFrame:
    """``n``, ``sums`` and ``products`` of the rows (``vec``) of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = Moments.of(scaled(batch.column(0)))
                total = own if total is None else total.merged(own)
        if total is not None:
            sums = pa.array([total.sums], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([total.n]), sums, pa.array([total.products.tobytes()])], ["n", "sums", "products"])

    return rows.select("vec").mapInArrow(task, "n long, sums array<long>, products binary")


def _total(partials: DataFrame) -> tuple[int, list[int]]:
    """Count and sums of all rows: one number per dimension reaches the driver."""
    size = partials.agg(F.sum("n").alias("n"), F.max(F.size("sums")).alias("width")).first()
    if size.n is None:
        return 0, []
    if size.width > MAX_WIDTH:
        raise ValueError(f"vectors of {size.width} entries; at most {MAX_WIDTH}")
    padded = F.concat("sums", F.array_repeat(F.col("n") * OFFSET, F.lit(size.width) - F.size("sums")))
    sums = partials.select(F.posexplode(padded).alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return size.n, [int(r.s) for r in sums.orderBy("i").collect()]


def _covariance(partials: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Products centred on the overall mean, added up by Spark, over ``n``."""
    width = len(sums)
    above = np.triu_indices(width)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for r in batch.to_pylist():
                d = len(r["sums"])
                own = Moments(r["n"], r["sums"], np.frombuffer(r["products"]).reshape(d, d)).widened(width)
                # The part's mean is taken from whole numbers, so that nothing is lost where means are large.
                apart = np.array([(n * s - own.n * t) / (own.n * n) for s, t in zip(own.sums, sums, strict=True)])
                total += own.products + own.n * np.outer(apart, apart)
        yield pa.RecordBatch.from_arrays([*map(pa.array, above), pa.array(total[above])], ["i", "j", "v"])

    added = partials.mapInArrow(centred, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    i, j, v = (added[c].to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v / n
    return out


# --- spectrum ------------------------------------------------------------------------


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: positive signs of D in P(v - shift I)P' = L D L'.

    The pivot is the largest entry of the diagonal, or a block of two rows around the largest entry beside it.
    """
    a = v - shift * np.eye(len(v))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        beside = np.abs(a - np.diag(np.diagonal(a)))
        i, j = np.unravel_index(beside.argmax(), a.shape)
        largest = beside[i, j]
        if diagonal[p] == largest == 0:
            return positive  # the rest is zero
        rows = [p] if diagonal[p] >= 0.64 * largest else [i, j]
        rest = np.delete(np.arange(len(a)), rows)
        pivot, side = a[np.ix_(rows, rows)], a[np.ix_(rest, rows)]
        positive += int(pivot[0, 0] > 0) if len(rows) == 1 else 1  # such a block has one eigenvalue of each sign
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
    return positive


def _between(v: np.ndarray, low: float, high: float, wanted: int, width: float) -> tuple[float, float]:
    """An interval of at most ``width`` that holds the eigenvalue number ``wanted`` from above."""
    while high - low > width:
        middle = (low + high) / 2
        if not low < middle < high:
            break
        low, high = (middle, high) if count_above(v, middle) >= wanted else (low, middle)
    return low, high


def intervals(v: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """Ends and eigenvalue counts of intervals that hold the ``most`` largest eigenvalues, if not more.

    All ends lie in gaps of the spectrum.
    """
    top = float(np.trace(v)) * (1 + 1e-9)
    if not top > 0:
        return []
    largest = _between(v, 0.0, top, 1, GAP * top)[1]
    floor = SMALLEST * largest
    there = count_above(v, floor)
    found, ends = [], []  # eigenvalues to within a fraction of a gap, from above; cuts, with the room to either side
    wanted, high = min(most, there), largest * (1 + GAP)
    while len(found) < there:
        low, near = _between(v, floor, high, len(found) + 1, GAP * largest / 4)
        if found and found[-1] - near > GAP * largest:
            ends.append((len(found), (found[-1] + near) / 2, (found[-1] - near) / 2))
            if len(found) >= wanted:
                break
        found.append(low)
        high = min(high, near + GAP * largest)
    else:
        ends.append((len(found), floor, floor))
    upper, room = largest * 1.1, largest * 0.1
    out, before = [], 0
    for at, (count, cut, own_room) in enumerate(ends):
        if at + 1 < len(ends):
            further, below, its_room = ends[at + 1]
            if further - before <= PER_INTERVAL and (upper - below) / 2 <= ROOM * min(room, its_room):
                continue
        out.append((cut, upper, count - before))
        upper, room, before = cut, own_room, count
    return out


def contour_eigenpairs(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and their eigenvectors as columns.

    A block that does not get to rounding level, since many eigenvalues lie just outside, is doubled.
    """
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    middle, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(-0.5j * np.pi * (nodes - 1))
    inverses = [np.linalg.inv((middle + radius * t) * np.eye(d) - v) for t in turns]
    scale, random = np.abs(v).sum(axis=1).max(), np.random.default_rng(7)
    block = min(d, max(2 * count, count + 8))
    while True:
        y, before = random.standard_normal((d, block)), np.inf
        for _ in range(ROUNDS):
            filtered = sum(0.5 * w * radius * (t * (inverse @ y)).real for t, w, inverse in zip(turns, weights, inverses, strict=True))
            q = np.linalg.qr(filtered)[0]
            values, turned = np.linalg.eigh(q.T @ v @ q)  # Rayleigh-Ritz in the space of the block
            y = q @ turned
            inside = (values > low) & (values < high)
            residual = np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max(initial=0.0)
            if inside.sum() == count and residual < 1e-12 * scale and not residual < before / 2:
                return values[inside][::-1], y[:, inside][:, ::-1]
            before = residual if inside.sum() == count else np.inf
        if block == d:
            raise RuntimeError(f"{inside.sum()} eigenvalues between {low} and {high}, where the inertia counts {count}")
        block = min(d, 2 * block)


def eigenpairs(spark, v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit eigenvectors as rows; one Spark task per interval."""
    cuts = intervals(v, most)
    if not cuts:
        return np.zeros(0), np.zeros((0, len(v)))
    sent = spark.sparkContext.broadcast(v)  # at most MAX_WIDTH rows and columns

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                values, vectors = contour_eigenpairs(sent.value, r.low, r.high, r.count_)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    rows = spark.createDataFrame(cuts, "low double, high double, count_ long").repartition(len(cuts))
    pairs = rows.mapInPandas(solve, "value double, vector array<double>").orderBy(F.desc("value")).limit(most).collect()
    return np.array([p.value for p in pairs]), np.array([p.vector for p in pairs])


# --- whitening -----------------------------------------------------------------------


def project(rows: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """``id``, ``deviation`` and ``w``: the row on each component over the root of its eigenvalue.

    ``n`` and the sums, eigenvalues and eigenvectors go along: numbers of a few vectors.
    """
    sent = rows.sparkSession.sparkContext.broadcast((sums, vectors / np.sqrt(values)[:, None]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, directions = sent.value
        for batch in batches:
            apart = _apart(scaled(batch.column(1), len(total)), n, total)
            deviation = [d if d < 1 << 63 else None for d in _squares(apart)]
            w = (apart.astype(np.float64) / n) @ directions.T
            out = [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, ["id", "deviation", "w"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(task, f"id {kind}, deviation long, w array<double>")


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: in longs where they hold it."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    kind = np.int64 if reach < 1 << 62 else object
    return n * x.astype(np.int64).astype(kind) - np.array(sums, kind)


def _squares(apart: np.ndarray) -> list[int]:
    reach = max(int(apart.max(initial=0)), -int(apart.min(initial=0)))
    exact = apart if reach * reach * max(1, apart.shape[1]) < 1 << 63 else apart.astype(object)
    return [int(s) for s in (exact * exact).sum(axis=1)]


def whiten(rows: DataFrame, most: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` of each row and component."""
    spark = rows.sparkSession
    ship(spark)
    clean = rows.filter(usable(F.col(vec_col))).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    partials = store(partial_moments(clean), "moments")
    n, sums = _total(partials)
    v = _covariance(partials, n, sums) if n else np.zeros((0, 0))
    remove(partials)
    values, vectors = eigenpairs(spark, v, most)
    k = len(values)
    names = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], f"id {clean.schema['id'].dataType.simpleString()}, {names}")
    done = store(project(clean, n, sums, values, vectors), "whitened")
    # Spark's covariances merge centred products, as ``Moments`` does.
    entries = [F.covar_pop(F.col("w")[i], F.col("w")[j]) - float(i == j) for i in range(k) for j in range(i, k)]
    error = done.agg(F.greatest(*[F.abs(e) for e in entries], F.lit(0.0)).alias("e")).first().e
    shares = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    return done.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
