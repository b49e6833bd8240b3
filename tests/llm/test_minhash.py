from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from sievewell.llm.graph import components
from sievewell.llm.minhash import Likeness, keep_one_each, near_duplicates, signature


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = d if least.get(r) is None else min(d, least[r])
    return sorted(((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows)), key=str)


def family(prose, size, changed, first_id, seed):
    base, rng, out = prose(120, seed), random.Random(seed), []
    for i in range(size):
        words = list(base)
        for _ in range(changed):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append((first_id + i, " ".join(words)))
    return out


def test_components_equal_brute_force(spark, docs, prose, odd):
    rows = family(prose, 60, 2, 100, 1) + family(prose, 40, 4, 300, 2) + family(prose, 15, 1, 500, 3) + [(600 + i, rows[1]) for i, rows in enumerate(family(prose, 1, 0, 0, 1) * 20)] + odd
    rows += [(900 + i, " ".join(prose(30 + i, 50 + i))) for i in range(40)]
    for like in (Likeness(3, 85), Likeness()):
        got = near_duplicates(docs(rows).withColumn("component_id", F.lit("mine")), like).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, like.words, like.percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_of_a_large_bucket_miss_nothing(spark, docs, prose, monkeypatch):
    from sievewell.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = family(prose, 80, 3, 1, 9)
    got = near_duplicates(docs(rows), Likeness(3, 85)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 85)


def test_pairs_whose_signatures_look_unlike_are_compared(spark, docs):
    # Each pair shares a band and 8 of 10 shingles, but only 64 to 67 % of its coordinates.
    texts = (
        ("2d57 843c 76d0 19e3 3b94 ad7f 642f 7ae3 323b 9eaa e09 8a88", "83a2", "5dde"),
        ("7462 21ef 9d27 274e 9d7c 788d a227 9312 df 8b63 55b1 a507", "99b0", "5933"),
        ("e68 20b7 3afe 96cb 37d4 1023 9b72 3fa0 1f08 8184 2cd1 1603", "25d6", "81a"),
    )
    rows = [(10 * i + j, f"{t[0]} {t[j]}") for i, t in enumerate(texts) for j in (1, 2)]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 11: 11, 12: 11, 21: 21, 22: 21}


def test_bitmaps_never_bound_too_low():
    from sievewell.llm.minhash import _marks, most_shared

    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 9000).astype(np.uint64)
    sets = [rng.choice(pool[: rng.integers(n, 9000)], n, replace=False) for n in (1, 2, 9, 100, 300, 301, 1500, 1600, 6000) for _ in range(4)]
    n = np.array([len(s) for s in sets])
    marks = np.stack([np.frombuffer(_marks(s), dtype=np.uint64) for s in sets])
    every = np.arange(len(sets))
    shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    bound = most_shared(n, marks, every, every)
    assert (bound >= shared).all() and (bound <= np.minimum(n[:, None], n)).all() and (bound.diagonal() == n).all()


def test_one_of_each_group_stays(spark, docs, prose, odd):
    rows = family(prose, 30, 1, 100, 1) + [(100, family(prose, 1, 1, 100, 1)[0][1])] + odd
    kept = keep_one_each(docs(rows).withColumn("__extra", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "__extra"]
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([100, 1, 2, 3, 4, 5, 6, 7, None, None], key=str)


def test_empty_tables(spark, docs):
    assert near_duplicates(docs([])).count() == 0 and keep_one_each(docs([])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 100).astype(np.uint64)])
    assert abs((signature(a) == signature(b)).mean() - 0.8) < 0.12


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
