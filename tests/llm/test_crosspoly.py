"""Near vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from leadloom.llm.crosspoly import Tables, hadamard, near_vectors


def brute(rows, cosine=0.98):
    unit = {}
    for i, label, v in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(np.float64)
        unit[i] = (label, x / np.linalg.norm(x))
    links, root = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(unit)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= cosine:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (links[i], find(i), find(i) == i) for i in links}


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_tables_meet_pairs_at_the_threshold(depth):
    tables, draw = Tables(64, depth, 0.98), np.random.default_rng(5)
    x = draw.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.standard_normal((3000, 64))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = tables.buckets(x), tables.buckets(y)
    met = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert met >= 0.999


def made():
    draw, rows = np.random.default_rng(2), []
    centers = draw.standard_normal((40, 64))
    for i in range(600):
        x = centers[draw.integers(40)] + draw.standard_normal(64) * draw.choice([0.05, 0.12, 0.2, 1.0])
        rows.append((i * 2, int(draw.integers(3)), [float(np.float32(v)) for v in x]))
    for i in range(80):
        rows.append((3000 + i, 1, rows[0][2]))
    rows += [(5000, None, rows[0][2]), (5001, 1, None), (5002, 1, []), (5003, 1, [0.0] * 64), (5004, 1, [None] + [1.0] * 63),
             (5005, 1, [float("nan")] * 64), (5006, 1, [float("inf")] * 64), (5007, 1, [1.0, 2.0]), (5008, 1, [2.0, 4.0])]
    return rows


SCHEMA = "vec_id long, label int, embedding array<float>"


def test_equals_all_pairs(spark):
    rows = made()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_blocks_of_a_bucket(spark, monkeypatch):
    import leadloom.llm.crosspoly as module
    monkeypatch.setattr(module, "BLOCK", 16)
    rows = made()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, 1, [1.0, 0.0]), (7, 1, [1.0, 0.0]), (7, 1, [1.0, 0.0]), (None, None, None)], SCHEMA)
    got = sorted(map(tuple, near_vectors(df).collect()), key=repr)
    assert got == sorted([(None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (None, 0, None, True)], key=repr)
    assert near_vectors(df.limit(0)).count() == 0
