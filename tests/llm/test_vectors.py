from __future__ import annotations

import numpy as np
import pytest

from sievewell.llm import cross_polytope
from sievewell.llm.cross_polytope import buckets, near_vectors


def brute(rows, least):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    n, out = len(rows), []
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if k else None for (_, v), k in zip(rows, ok)]
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(n)]
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(links[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.mark.parametrize("block", [1024, 8])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_equal_brute_force(spark, monkeypatch, block, kind):
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    rng = np.random.default_rng(4)
    center = rng.normal(size=(6, 24))
    near = [c + rng.normal(size=24) * s for c in center for s in (0.02, 0.1, 0.2, 0.25) for _ in range(8)]
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(near + [center[0]] * 30)]
    top = len(rows)
    rows += [(top + i, v) for i, v in enumerate([None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1.0] * 5, [2.0] * 5, [1e-30] * 24, [1.0]])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, kept string")
    got = near_vectors(frame).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(2, 2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    x, y = buckets(a), buckets(near)
    assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() > 0.99
    assert (x[:, :, None] == np.roll(x, 1, axis=0)[:, None, :]).any(axis=(1, 2)).mean() < 0.01


def test_buckets_that_agree_in_half_their_bits_are_different_buckets():
    """The pair's first common bucket is the second of both, though the first ones share 32 bits."""
    low = 0x1234_5678
    vectors = [np.array([1.0, 0.0], dtype="<f8").tobytes(), np.array([1.0, 0.01], dtype="<f8").tobytes()]
    group = {
        "bucket": np.array([99, 99]), "low": np.array([0, 0]), "high": np.array([0, 0]), "own": np.array([0, 0]), "node": np.array([5, 6]),
        "copies": np.array([1, 1]), "vector": np.array(vectors, dtype=object), "tags": np.array([[(1 << 40) + low, 99], [(2 << 40) + low, 99]]),
    }
    links, _, _ = cross_polytope._compare(group, 0.95, "<f8")
    assert links.tolist() == [1, 1]
