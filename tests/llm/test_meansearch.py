"""Centroid clustering against a plain version, and odd inputs."""

import hashlib

import numpy as np
import pytest

from leadloom.llm import meansearch
from leadloom.llm.meansearch import MeanSearch


def plain(rows, k=16, rounds=3, width=64):
    kept = [(i, [int(np.floor(64.0 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            members = [v for (_, v), (_, m) in zip(kept, own) if m == n]
            if members:
                centroids[n] = [sum(c) // len(members) for c in zip(*members)]
    own = assign()
    inertia = {n: sum(d for d, m in own if m == n) for _, n in own}
    return sorted((repr(i), n, d, inertia[n], sum(inertia.values()),
                   hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                  for (i, _), (d, n) in zip(kept, own))


def ours(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = meansearch.cluster(df, **more).collect()
    return sorted((repr(r["vec_id"]), *list(r)[1:]) for r in out)


def vectors(n, width=64, seed=0, spread=8):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(spread, width))
    return [(i, [float(np.float32(x)) for x in middle[i % spread] + 0.2 * rng.normal(size=width)], i % 3) for i in range(n)]


def test_equals_plain_version(spark):
    rows = vectors(300)
    assert ours(spark, rows) == plain([r[:2] for r in rows])


def test_ties_copies_and_odd_rows(spark):
    rows = vectors(20, spread=3)
    rows += [(100, rows[0][1], None), (100, rows[0][1], None), (None, rows[1][1], 1), (101, [0.0] * 64, 1), (102, [-0.001] * 64, 1)]
    odd = [(200, None, 1), (201, [], 1), (202, [1.0] * 63, 1), (203, [1.0] * 65, 1), (204, [float("nan")] + [0.0] * 63, 1),
           (205, [float("inf")] + [0.0] * 63, 1), (206, [None] + [0.0] * 63, 1)]
    assert ours(spark, rows + odd) == plain([r[:2] for r in rows])


def test_few_and_no_vectors(spark):
    rows = vectors(5)
    assert ours(spark, rows) == plain([r[:2] for r in rows])
    assert ours(spark, []) == []
    assert ours(spark, [(1, None, 1)]) == []


def test_column_names(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x", 3)], "`my.id` long, `v.x` array<double>, cluster string, distance int")
    row = meansearch.cluster(df, k=2, width=2, id_col="my.id", vector="v.x").first()
    assert (row["my.id"], row["cluster"], row["distance"]) == (1, 0, 0)


def test_large_components_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        ours(spark, [(1, [1e20] + [0.0] * 63, 1)])


@pytest.mark.parametrize("low,high", [(-3, 4), (-2000, 2001), (-(1 << 26), 1 << 26)])
def test_search_is_exact_and_rejects(low, high):
    rng = np.random.default_rng(3)
    centroids = rng.integers(low, high, size=(40, 16))
    centroids[7] = centroids[2]  # a tie
    offset = rng.integers(low, high, size=400)
    x = (rng.integers(low, high, size=(400, 16)) + offset[:, None]) // 2
    x[:40] = centroids
    search = MeanSearch(centroids)
    number, distance = search.nearest(x)
    all_distances = ((x[:, None, :].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
    assert [int(d) for d in distance] == [min(row) for row in all_distances.tolist()]
    assert number.tolist() == [row.index(min(row)) for row in all_distances.tolist()]
    assert search.compared < 0.8 * all_distances.size
