from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from sievewell.llm.wu_manber import drop_contaminated, find_contamination


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def brute(text, items, window=13, share=20):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        m = min(window, len(v))
        for i in range(len(v) - m + 1 if m else 0):
            for j in range(len(w) - m + 1):
                if w[j : j + m] == v[i : i + m]:
                    hit.update(range(j, j + m))
                    found.add("" if name is None else str(name))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and share * len(hit) >= len(w)


def test_search_equals_brute_force(spark, docs, prose, odd):
    rng = random.Random(2)
    items = [(i, " ".join(prose(20 + i, 70 + i))) for i in range(6)] + [(6, "short One"), (7, "single"), (8, None), (9, ""), (None, " ".join(prose(13, 90))), (2, "a b c d"), (10, "the the the the the the the the the the the the the the the the"), (11, "the " * 20)]
    rows = list(odd)
    for i in range(60):
        w = prose(rng.randint(5, 700), 300 + i)
        item = words(rng.choice(items)[1])
        a = rng.randint(0, max(len(item) - 14, 0))
        at = rng.randint(0, len(w))
        w[at:at] = [x.decode().upper() for x in item[a : a + rng.choice([12, 13, 14, 30])]]
        rows.append((1000 + i, rng.choice([" ", ", ", "\n"]).join(w)))
    rows += [(2000, "the " * 900), (2001, "one SHORT one, single")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = find_contamination(docs(rows).withColumn("n_hit", F.lit("mine")), benchmark).collect()
    want = sorted(((d, *brute(t, items)) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    left = drop_contaminated(docs(rows), benchmark).count()
    assert left == sum(not w[-1] for w in want)


def test_without_items_or_documents(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.n_hit for r in find_contamination(docs([(1, "some words")]), none).collect()] == [0]
    assert find_contamination(docs([]), none).count() == 0


def test_a_benchmark_too_large_for_one_search(spark, docs, prose, odd, monkeypatch):
    from sievewell.llm import wu_manber

    monkeypatch.setattr(wu_manber, "MOST_BENCHMARK_BYTES", 500)
    items = [(i, " ".join(prose(40, 70 + i))) for i in range(9)] + [(6, "short One"), (None, " ".join(prose(13, 90))), (2, "a b c d"), (8, None)]
    items += [(20, " ".join(prose(40, 70)[10:30])), (21, " ".join(prose(300, 95)))]
    rows = list(odd) + [(1000 + i, " ".join(prose(20 * i, 300 + i) + prose(40, 70 + i)[:30] + prose(40, 71 + i)[5:25] + prose(20 * i, 400 + i))) for i in range(8)]
    rows += [(1001, rows[-1][1]), (2000, "one SHORT one"), (2001, " ".join(prose(300, 95)[50:90] + ["x"] * 800)), (2002, " ".join(prose(40, 70)[:31]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(wu_manber._parts(wu_manber._items(benchmark, "item_id", "text"))) > 4
    want = sorted(((d, *brute(t, items)) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in find_contamination(docs(rows), benchmark).collect()), key=str) == want
    left = drop_contaminated(docs(rows).withColumn("n_hit", F.lit("mine")), benchmark)
    assert left.columns[-1] == "n_hit"
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(str(w[0]) for w in want if not w[-1])


def test_repeated_words_in_both_tables_take_no_more_than_their_places(spark, docs):
    """Every window of the items is the same one, and occurs at every place of the texts."""
    from sievewell.llm.words import ALPHANUMERIC, cut
    from sievewell.llm.wu_manber import Patterns

    items = [(str(i), b"the " * 5000) for i in range(3)] + [("short", b"the the")]
    patterns = Patterns(items)
    assert patterns.count == 2
    at, _, window = patterns.occurrences(cut([b"the " * 20_000], ALPHANUMERIC))
    assert len(at) == 20_000 - 12 + 20_000 - 1 and {tuple(patterns.items_of(w)) for w in set(window.tolist())} == {(0, 1, 2), (3,)}
    benchmark = spark.createDataFrame([(n, t.decode()) for n, t in items], "item_id string, text string")
    (got,) = find_contamination(docs([(1, "x " + "the " * 20_000)]), benchmark).collect()
    assert (got.n_words, got.n_hit, got.n_items) == (20_001, 20_000, 4)
    assert got.items_sha256 == hashlib.sha256(b"0,1,2,short").hexdigest()
