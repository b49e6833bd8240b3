from __future__ import annotations

import re
from itertools import permutations

import pytest

from sievewell.llm.filter_audit import SCHEMA, audit_filters

DOCS = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, quality int, toxic int"


def plain_audit(docs, labels):
    """Every order applied to the documents one filter after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def fails(doc):
        i, text, _ = doc
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = "A" if len(words) < 200 else ""
        out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else ""
        out += "D" if re.search(r"[#$%&*|]", t) else ""
        return out + ("E" if i is not None and any(j is not None and j < i and (s or "") == t for j, s, _ in docs) else "")

    rows = {}
    failed = [fails(d) for d in docs]
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], f) for d, f in zip(docs, failed) if (d[2] or "") == part]
        removals = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                here = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                removals[letter] += len(here)
                rows[part, "".join(order), step] = [
                    len(left), len(here), sum(letter in f for _, f in own) - len(here), sum(f == letter for _, f in own),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here),
                ]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                rows[part, "".join(order), step].append(removals[letter])
    return rows


def audit(spark, docs, labels):
    out = audit_filters(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in out}
    assert len(got) == len(out)
    return got


@pytest.fixture
def mixed():
    long = " ".join(f"w{i}" for i in range(220))
    texts = [
        long, long.upper(), long + " #", "a " * 300, "A " * 300, "same\x0bold\x0cwords\x1cjoined", "", None, " \n ", "É" * 500, "| " * 250,
        " ".join(f"W{i}" for i in range(199)), " ".join(f"u{i % 100}" for i in range(200)), " ".join(f"u{i % 99}" for i in range(200)),
        "x" * 97 + "ABC", "x" * 96 + "ABCD", "\U0001f600" * 97 + "ABC",
    ]
    docs = [(i, texts[(i * 7) % len(texts)], ["en", "fr", None, ""][i % 4]) for i in range(90)]
    # Repeated rows and ids, NULL ids.
    docs += [(3, "new", "en"), (3, "new", "en"), (2, "new", "fr"), (None, "new", "en"), (None, "new", "fr"), (None, None, None), (95, "new", "de"), (5, "other", "en"), (5, "third", "en")]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 95, 3)] + [(3, 1, None), (3, 0, 1), (None, 1, 1), (5, 1, 0), (400, 1, 1)]
    return docs, [(i, q, None if x is None else int(x)) for i, q, x in labels]


def test_equal_to_applying_the_filters_one_by_one(spark, mixed):
    got, want = audit(spark, *mixed), plain_audit(*mixed)
    assert got == want
    assert len(want) == 4 * 600
    # Every filter fails someone, together with others and alone.
    assert all(any(v[1] and v[2] for (_, order, step), v in want.items() if order[step - 1] == f) for f in "ABCDE")


def test_one_group_of_copies(spark):
    docs = [(i, "copied", "en") for i in range(60)]
    got = audit(spark, docs, [(0, 1, 0), (7, 1, 1)])
    assert got == plain_audit(docs, [(0, 1, 0), (7, 1, 1)])
    assert got["en", "EABCD", 1][:2] == [1, 59]


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]) == {}
    docs = [(1, "a", "en")]
    assert audit(spark, docs, []) == plain_audit(docs, [])


def test_clashing_columns_and_other_parts(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 1, "s", 9)], DOCS + ", fails int, digest string, labelled int")
    labels = spark.createDataFrame([(1, 1, 0, "x")], LABELS + ", part string")
    out = audit_filters(docs.selectExpr("*", "digest AS place", "0 AS spread", "1 AS good"), labels, part="place")
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert {r.part for r in out.collect()} == {"s"}
