"""Neighbours against all distances."""

import numpy as np
import pytest
from odd_rows import sf
from pyspark.sql import functions as F

from enrichlake.llm import neighbours

KIND = "vec_id long, embedding array<double>, query_id string, row int, `a.b` string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "q", 1, "x") for r in rows], KIND)


def all_distances(rows, k, is_query):
    """(query_id, rank, vec_id, score) over all valid rows."""
    valid = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, (i, x) in enumerate(valid):
        if i is None or not is_query(i):
            continue
        near = sorted((float(np.sqrt(np.sum((y - x) ** 2))), j is None, j or 0) for p, (j, y) in enumerate(valid) if p != q and len(y) == len(x))
        out += [(i, r, None if no else j, d) for r, (d, no, j) in enumerate(near[:k], 1)]
    return out


def found(spark, rows, k=10, modulus=100):
    return [tuple(r) for r in neighbours.nearest(table(spark, rows), F.col("id") % modulus == 0, k=k).collect()]


def recall(got, expected):
    """Share of the expected distances that were found, place by place or closer."""
    by_query = {}
    for i, _, _, d in got:
        by_query.setdefault(i, []).append(d)
    hits = sum(any(abs(d - x) < 1e-12 for x in by_query.get(i, [])) for i, _, _, d in expected)
    return hits / max(1, len(expected))


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in sf(spark, "embeddings", "/root/testdata/sf0.1").collect()]
    expected = all_distances(rows, 10, lambda i: i % 100 == 0)
    got = [tuple(r) for r in neighbours.op13_neighbours(spark, "/root/testdata/sf0.1").collect()]
    assert len(got) == len(expected)
    assert recall(got, expected) >= 0.95
    truth = dict(rows)
    for i, _, j, d in got:
        assert d == pytest.approx(np.linalg.norm(np.array(truth[i], float) - np.array(truth[j], float)), rel=1e-12)


@pytest.mark.parametrize("dim", [1, 2, 5, 64, 200])
def test_clusters_and_ties(spark, dim):
    draw = np.random.default_rng(dim)
    centres = draw.standard_normal((6, dim)) * 5
    rows = [(i, (centres[i % 6] + draw.standard_normal(dim) * 0.01 * (i % 4)).tolist()) for i in range(400)]
    expected = all_distances(rows, 10, lambda i: i % 20 == 0)
    got = found(spark, rows, modulus=20)
    assert len(got) == len(expected) and recall(got, expected) >= 0.95


def test_small_blocks(spark, monkeypatch):
    draw = np.random.default_rng(0)
    rows = [(i, draw.standard_normal(16).tolist()) for i in range(500)]
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(neighbours, "LEAST_QUERIES", 2)
    assert recall(found(spark, rows), all_distances(rows, 10, lambda i: i % 100 == 0)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [1.0, 2.5]), (1, None), (2, []), (3, [0.0, 0.0]), (200, [None, 1.0]), (300, [nan, 1.0]),
        (400, [inf, 1.0]), (None, [1.0, 2.0]), (5, [1.0, 2.0, 3.0]), (500, [1e6, -1e6]), (7, [1.0, 2.0]), (600, [3.0, 3.0, 3.0]), (700, [1.0]),
    ]
    expected = sorted(all_distances(rows, 4, lambda i: i % 100 == 0), key=str)
    got = sorted(found(spark, rows, k=4), key=str)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


def test_one_vector_many_times(spark):
    rows = [(i, [0.25, 0.5, -1.0] if i % 3 else [float(i), 1.0, 2.0]) for i in range(600)]
    got = sorted(found(spark, rows))
    assert got == sorted(all_distances(rows, 10, lambda i: i % 100 == 0))


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [0.0])]) == []
    assert found(spark, [(100, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_blocks_are_copied_only_as_often_as_needed():
    assert neighbours._parts(150_000, 720, 600) == 10 and neighbours._parts(1_000, 720, 600) == 1
    assert neighbours._parts(0, 1, 12) == 1 and neighbours._parts(500, 3, 12) == 4 and neighbours._parts(10_000, 1, 12) == 12
