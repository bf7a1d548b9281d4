"""The vector join against a comparison of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cobasket.llm import vector_join as vj

SCHEMA = "vec_id long, embedding array<float>, node int, v string"


def family(rng, dim, n, spread):
    centre = rng.normal(size=dim)
    return [centre / np.linalg.norm(centre) + spread * rng.normal(size=dim) / dim ** 0.5 for _ in range(n)]


def vectors(seed, dim):
    """Lone vectors, tight and loose families, a chain, copies, and vectors that link with nothing."""
    rng = np.random.default_rng(seed)
    out = list(rng.normal(size=(60, dim)))
    for n, spread in ((90, 0.1), (70, 0.3), (60, 0.45), (40, 0.7)):
        out += family(rng, dim, n, spread)
    at, step = rng.normal(size=dim), rng.normal(size=dim)
    out += [at + i * 0.3 * step for i in range(30)]
    out = [[float(np.float32(x)) for x in v] for v in out]
    out += [out[3]] * 12 + [out[70]] * 25 + [[4 * x for x in out[80]]]
    out += [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [None] + [1.0] * (dim - 1)]
    return [out[i] for i in rng.permutation(len(out))]


def brute(rows, threshold):
    """rows: (id, vector) -> sorted (id, n_links, component_id)."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max((len(rows[i][1]) for i in ok), default=1)
    x = np.array([list(rows[i][1]) + [0.0] * (dim - len(rows[i][1])) for i in ok]).reshape(len(ok), dim)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(ok))
    while True:
        now = np.where(near, label, len(ok)).min(axis=1, initial=len(ok))
        now = np.minimum(label, now)
        if (now == label).all():
            break
        label = now
    n, low = {}, {}
    for i, own, links in zip(ok, label.tolist(), near.sum(axis=1).tolist()):
        n[i] = links
        key = rows[i][0]
        low[own] = key if low.get(own) is None else low[own] if key is None else min(low[own], key)
    where = dict(zip(ok, label.tolist()))
    out = [(key, n.get(i, 0), low[where[i]] if i in where else key) for i, (key, _) in enumerate(rows)]
    return sorted(out, key=str)


def found(frame, **settings):
    rows = vj.near_duplicates(frame, **settings).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("dim, threshold, settings", [
    (8, 0.9, {}), (8, 0.9, {"cores": 40, "cell": 50, "left": 16, "right": 24}),
    (3, 0.97, {"cores": 200, "cell": 20, "left": 9, "right": 7}), (70, 0.6, {"cores": 3, "cell": 64, "left": 40, "right": 40})])
def test_same_links_as_all_pairs(spark, dim, threshold, settings):
    rows = [(i, v) for i, v in enumerate(vectors(dim, dim))]
    frame = spark.createDataFrame([(i, v, -1, "x") for i, v in rows], SCHEMA)
    assert found(frame, threshold=threshold, **settings) == brute(rows, threshold)


def test_odd_rows(spark):
    """Repeated ids with other vectors, rows without an id, shorter vectors, repeated rows, ties at the threshold."""
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (None, [1.0, 0.01]), (None, [-1.0, 0.0]), (7, [0.0, 2.0]), (7, [0.0, 2.0]),
            (2, [3.0]), (9, [0.6, 0.8]), (1, [0.8, 0.6]), (None, None), (3, None), (3, [-1.0, 0.001])]
    frame = spark.createDataFrame([(i, v, 0, None) for i, v in rows], SCHEMA)
    for threshold in (0.9, 0.6):
        assert found(frame, threshold=threshold, cores=1, cell=2, left=2, right=2) == brute(rows, threshold)
    double = frame.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert found(double) == brute(rows, 0.9)
    empty = frame.limit(0)
    assert found(empty) == [] and vj.keep_one(empty).columns == frame.columns


def test_values_near_the_limits_of_their_type(spark):
    rows = [(1, [1e308, 1e308]), (2, [1e-308, 1e-308]), (3, [1e308, -1e308]), (4, [5e-324, 0.0])]
    frame = spark.createDataFrame([r for r in rows], "vec_id long, embedding array<double>")
    assert [(i, n) for i, n, _ in found(frame)] == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_keep_one_removes_rows_not_ids(spark):
    rows = [(3, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, None), (6, None), (None, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 0, str(k)) for k, (i, v) in enumerate(rows)], SCHEMA)
    kept = vj.keep_one(frame)
    assert kept.columns == frame.columns and sorted(r.v for r in kept.collect()) == ["0", "2", "3", "4"]


def test_a_third_of_all_rows_alike_is_never_compared_pair_by_pair(spark):
    """Members of cores are linked as a whole: no group holds them, however many they are."""
    rng = np.random.default_rng(1)
    rows = [v / np.linalg.norm(v) for v in rng.normal(size=(600, 16))] + family(rng, 16, 300, 0.05)
    classes = spark.createDataFrame([(i, 1, [float(x) for x in v]) for i, v in enumerate(rows)],
                                    "node long, copies long, v array<double>")
    seen = []
    whole = vj._dealt

    def watched(members, sizes):
        out = whole(members, sizes)
        seen.append(out.filter(F.col("node") >= 600).count())
        return out

    vj._dealt = watched
    try:
        linked = vj.linked_classes(classes, 0.9, 64, 200, 100, 100).collect()
    finally:
        vj._dealt = whole
    assert {r.n for r in linked if r.node >= 600} == {299} and seen == [0]
