"""Vector searches and whitening against brute force, with the cases their docstrings define."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import boxes, hard_negatives, kd_search, whitening
from feedlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, Score string, q int, rank int"


def rows_with_faults(rng, n=600, d=6):
    """Clusters, ties, copies, nulls, non-finite entries, shorter and empty vectors, names that the operators use too."""
    centres = rng.normal(size=(9, d))
    out = []
    for i in range(n):
        v = [float(np.float32(x)) for x in centres[i % 9] + rng.normal(size=d) * 0.3]
        out.append((i, v, int(rng.integers(0, 4)), "x", "y", 1, 2))
    for i in range(0, n, 37):
        out[i] = (i, [float(round(x)) for x in out[i][1]], *out[i][2:])  # many equal scores
    for i in range(5, n, 61):
        out[i] = (i, out[i][1][:3], *out[i][2:])
    bad = [None, [], [1.0, None, 2.0], [float("nan")] * d, [float("inf")] + [0.0] * (d - 1)]
    out += [(n + i, v, i % 3, "x", None, None, None) for i, v in enumerate(bad)]
    out += [(n + 9, [0.5] * d, None, None, None, None, None), (None, [2.0] * d, 1, None, None, None, None)]
    out += [out[3], out[100], out[100]]  # rows that occur again
    return out


def whole(v, scale, d):
    if v is None or any(x is None or not np.isfinite(x) for x in v):
        return None
    return [int(np.floor(scale * x)) for x in v] + [0] * (d - len(v))


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def test_top_k_equals_brute_force(spark):
    rows = rows_with_faults(np.random.default_rng(1))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {}
    for r in kd_search.top_k(df, F.col("vec_id") % 20 == 0, k=4, scale=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    vectors = [(i, whole(v, 16, 6)) for i, v, *_ in rows if i is not None and whole(v, 16, 6) is not None]
    asked = {}
    for i, v in vectors:
        if i % 20 == 0:
            asked[i] = min(v, asked.get(i, v))
    assert set(got) == set(asked)
    for i, q in asked.items():
        best = sorted((-dot(q, v), j) for j, v in vectors if j != i)[:4]
        assert sorted(got[i]) == [(n + 1, -s, j) for n, (s, j) in enumerate(best)]


def test_hard_negatives_equal_brute_force(spark):
    rows = rows_with_faults(np.random.default_rng(2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 15 == 0, F.col("label"), scale=16).collect())
    vectors = [(i, whole(v, 16, 6), label) for i, v, label, *_ in rows if None not in (i, label) and whole(v, 16, 6) is not None]
    expected = []
    for i, a, label in {(i, tuple(v), label) for i, v, label in vectors if i % 15 == 0}:
        scored = sorted((-dot(a, v), j, own == label) for j, v, own in vectors if j != i)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            fits = [(-t, j) for t, j, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s]
            expected += [(i, p, n + 1, j, -s, t) for n, (t, j) in enumerate(fits[:3])]
    assert got == sorted(expected) and expected


@pytest.mark.parametrize("leaves, fan", [(kd_search.median_leaves, 2), (hard_negatives.str_leaves, 8)])
def test_trees_are_exact_and_prune(monkeypatch, leaves, fan):
    """One tree by hand: every row in one leaf, tight boxes, the right rows, and not all leaves read."""
    rng = np.random.default_rng(3)
    points = np.floor(100 * (rng.normal(size=(4_000, 3)) + 8 * rng.integers(0, 2, (4_000, 3))))
    parts = list(leaves(points))
    assert sorted(np.concatenate(parts)) == list(range(len(points))) and max(map(len, parts)) <= boxes.LEAF_ROWS
    rows = [
        {"leaf": i, "label": 0, "ids": p, "points": boxes._binary(points[p]), "low": boxes._binary(points[p].min(0)), "high": boxes._binary(points[p].max(0))}
        for i, p in enumerate(parts)
    ]
    tree = boxes.Tree(rows, fan, 3)
    assert (tree.low[-1] == points.min(0)).all() and (tree.high[-1] == points.max(0)).all()
    read = []
    plain = boxes._read_leaves
    monkeypatch.setattr(boxes, "_read_leaves", lambda t, q, v, b, active, leaf: (read.extend(leaf), plain(t, q, v, b, active, leaf)))
    queries = boxes.Queries(np.arange(50), points[:50], boxes.no_floor(50))
    best = boxes.Best(queries.floor, 5)
    boxes.best_first(tree, queries, best)
    scores = points[:50] @ points.T
    for i in range(50):
        order = [j for j in np.lexsort((np.arange(len(points)), -scores[i])) if j != i][:5]
        assert list(best.ids[best.q == i]) == order
    assert len(read) < 0.5 * 50 * len(parts)


def test_windows_prune_boxes():
    points = np.arange(4_000.0)[:, None]
    parts = list(hard_negatives.str_leaves(points))
    rows = [
        {"leaf": i, "label": 7, "ids": p, "points": boxes._binary(points[p]), "low": boxes._binary(points[p].min(0)), "high": boxes._binary(points[p].max(0))}
        for i, p in enumerate(parts)
    ]
    window = [np.array([x], np.longdouble) for x in (1_000, 1_001)]
    asks = boxes.Queries(np.array([-1]), np.ones((1, 1)), boxes.no_floor(1), np.array([3]), False, *window)
    best = boxes.Best(asks.floor, 5)
    boxes.best_first(boxes.Tree(rows, 8, 1), asks, best)
    assert list(best.ids) == [1_001, 1_000]
    none = boxes.Best(asks.floor, 5)
    boxes.best_first(boxes.Tree(rows, 8, 1), boxes.Queries(np.array([-1]), np.ones((1, 1)), boxes.no_floor(1), np.array([7]), False, *window), none)
    assert not len(none.ids)


def test_large_products_are_exact(spark):
    """Sums beyond 2^53 are taken exactly, sums beyond a long are refused."""
    rows = [(0, [float(2**28), 1.0]), (1, [float(2**28), 1.0]), (2, [float(2**28), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = kd_search.top_k(df, F.col("vec_id") == 0, k=2, scale=1).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 2**56 + 1), (2, 2**56)]
    with pytest.raises(Exception, match="may not fit a long"):
        kd_search.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_empty_tables_give_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nothing = spark.createDataFrame([(100, None, 1, None, None, None, None)], SCHEMA)
    one = spark.createDataFrame([(100, [1.0, 2.0], 1, None, None, None, None)], SCHEMA)
    for df in (empty, nothing, one):
        assert kd_search.top_k(df, F.col("vec_id") % 100 == 0).count() == 0
        assert hard_negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
        assert whitening.whiten(df).count() == 0


def test_several_blocks_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    one = sorted(map(tuple, kd_search.top_k(df, F.col("vec_id") % 5 == 0).collect()))
    mined = sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0, F.col("label")).collect()))
    monkeypatch.setattr(boxes.blocks, "__defaults__", (30,))
    monkeypatch.setattr(hard_negatives, "ANCHORS", 30)
    assert sorted(map(tuple, kd_search.top_k(df, F.col("vec_id") % 5 == 0).collect())) == one
    assert sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0, F.col("label")).collect())) == mined


# --- whitening -----------------------------------------------------------------------


def plain_components(vectors):
    x = np.floor(1024 * np.array(vectors)) + 100_000
    centred = x - x.sum(0) / len(x)
    values, columns = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], columns[:, ::-1]


def test_whitening_equals_a_plain_one(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x, centred, values, columns = plain_components([r.embedding for r in rows])
    got = QUERIES["op13_whitening"](spark, sf).toPandas()
    assert len(got) == 8 * len(rows) and set(got.n) == {len(rows)} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    ids = [r.vec_id for r in rows]
    whole_x, sums = x.astype(int).astype(object), x.astype(int).astype(object).sum(axis=0)
    deviations = ((len(rows) * whole_x - sums) ** 2).sum(axis=1)
    assert list(got[got.component == 1].set_index("vec_id").deviation.loc[ids]) == list(deviations)
    for c in range(8):
        own = got[got.component == c + 1].set_index("vec_id")
        expected = centred @ columns[:, c] / np.sqrt(values[c])
        w = own.whitened.loc[ids].to_numpy()
        assert min(np.abs(w - expected).max(), np.abs(w + expected).max()) < 1e-9
        assert np.abs(own.explained - values[c] / values.sum()).max() < 1e-12


def test_whitening_of_faulty_rows(spark):
    rows = rows_with_faults(np.random.default_rng(4))
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = whitening.whiten(df, most=4).toPandas()
    kept = [(i, [*v, *[0.0] * (6 - len(v))]) for i, v, *_ in rows if v is not None and whole(v, 16, 6) is not None]
    _, centred, values, columns = plain_components([v for _, v in kept])
    assert set(got.n) == {len(kept)} and len(got) == 4 * len(kept)
    for c in range(4):
        expected = np.sort(centred @ columns[:, c] / np.sqrt(values[c]))
        w = np.sort(got[got.component == c + 1].whitened.to_numpy())
        assert min(np.abs(w - expected).max(), np.abs(w + expected[::-1]).max()) < 1e-9


def test_components_without_variance_do_not_exist(spark):
    rng = np.random.default_rng(6)
    flat = rng.integers(-50, 50, (40, 3)) @ rng.integers(-5, 5, (3, 7)) / 1024.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3] and got.identity_error[0] < 1e-9


def spectra():
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    yield "even", turn @ np.diag(np.arange(30, 0, -1.0)) @ turn.T
    yield "equal at the cut", turn @ np.diag([9.0, 8, 7, 6, 5, 5, 5, 5, 5, 5, *[1.0] * 20]) @ turn.T
    yield "all equal", np.eye(30) * 3.5
    yield "wide", turn @ np.diag(10.0 ** -np.arange(30)) @ turn.T
    yield "close pairs", turn @ np.diag(np.repeat(np.arange(15, 0, -1.0), 2) + np.tile([1e-6, 0], 15)) @ turn.T
    yield "two", np.array([[0.0, 1.0], [1.0, 0.0]]) + 2 * np.eye(2)


@pytest.mark.parametrize("name, v", list(spectra()), ids=lambda x: x if isinstance(x, str) else "")
def test_contours_miss_no_component(spark, name, v):
    expected = np.linalg.eigvalsh(v)[::-1]
    for shift in (expected[0] * 1.01, expected.mean() * 1.0001, expected[-1] - 1):
        assert whitening.count_above(v, shift) == (expected > shift).sum()
    cuts = whitening.intervals(v, 8)
    found = [whitening.contour_eigenpairs(v, *cut) for cut in cuts]
    values = np.concatenate([f[0] for f in found])
    vectors = np.hstack([f[1] for f in found])
    there = int((expected > 1e-12 * expected[0]).sum())
    assert min(8, there) <= len(values) and np.abs(values - expected[: len(values)]).max() <= 1e-12 * expected[0]
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-8
