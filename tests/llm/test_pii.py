from __future__ import annotations

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from sievewell.llm.pii import FEATURES, Boosted, Counted, boost, find_private, fit_boosted, redact, report_private

# The plain forms.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
    return sum(worth) % 10 == 0


def brute(text):
    """What the plain forms find; long runs, over which they would go back and forth for ever, are given."""
    if text and len(text) > 100_000:
        if "@" in text:
            yield f"email:0:{text.rindex('.')}"
        return
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                yield f"{kind}:{m.start()}:{m.end()}"


NEVER = Boosted(0.0, (), None)


def test_base_spans_equal_the_plain_forms(spark, docs, odd):
    rng = random.Random(5)
    alphabet = "ab9@@..-_ +0123456789()%é𝄞\n"
    rows = list(odd) + [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    rows += [(1, "a@b.c_d@e.f @g.h x@y. z@-.-"), (2, "1.2.3.4.5.6.7.8 0000255.1.1.01 256.1.1.1 1.2.3"), (3, "4111 1111 1111 1111 and 4111-1111-1111-1111 4111 1111 1111 1112"), (4, "+1 (555) 123-4567 +1234567 +1--9 +(5"), (5, "𝄞é bob@mail.example.com"), (6, "a" * 200_000 + "@" + "b." * 2000), (7, "1" * 200_000)]
    got = find_private(docs(rows).withColumn("id", F.monotonically_increasing_id()), NEVER).select("text", "base", "spans").collect()
    assert len(got) == len(rows)
    for r in got:
        assert [f"{b.kind}:{b.start}:{b.end}" for b in r.base] == list(brute(r.text)) and r.spans == r.base


def text_with_secrets(i, rng):
    filler = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit-amet-consectetur", "2024-01-02", "12345678"]) for _ in range(12))
    secret = "".join(rng.choice("0123456789abcdef") for _ in range(24))
    return f"{filler} token = \"{secret}\" {filler} u{i}@mail{i % 7}.example.com {filler}"


def test_candidates_are_added_beside_the_base(spark, docs):
    rng = random.Random(6)
    rows = [(i, text_with_secrets(i, rng)) for i in range(200)] + [(1000 + i, "plain words-with-hyphens-and-2024-dates") for i in range(50)]
    frame = docs(rows)
    report = {r.doc_id: r for r in report_private(frame).collect()}
    assert len(report) == 250
    for i, t in rows[:200]:
        base = ",".join(brute(t))
        assert report[i].n_email == 1 and report[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert report[i].spans.startswith(base) and "secret:" in report[i].spans
    assert all(report[i].spans == "" for i, _ in rows[200:])
    clean = redact(frame, fit_boosted(frame)).collect()
    assert all("@mail" not in r.text and "[EMAIL]" in r.text and "[SECRET]" in r.text and r.n_chars == len(r.text) for r in clean if r.doc_id < 200)
    assert all(r.text == rows[200][1] for r in clean if r.doc_id >= 1000)


def test_redaction_merges_overlaps_and_keeps_the_rest(spark, docs, odd):
    rows = [(1, "call +1 555 123 4567 8901 now"), (2, "é𝄞 x@y.zz."), *odd]
    got = sorted(((r.doc_id, r.text) for r in redact(docs(rows), NEVER).collect()), key=str)
    assert (2, "é𝄞 [EMAIL].") in got and len(got) == len(rows)
    assert sorted(got, key=str)[-1] and [t for d, t in got if d is None].count(None) == 1


def test_redaction_leaves_columns_of_any_name_alone(spark, docs):
    rng = random.Random(9)
    rows = [(i, text_with_secrets(i, rng)) for i in range(200)]
    frame = docs(rows).selectExpr("*", "'b' || doc_id AS base", "doc_id AS spans", "'x' AS __base", "1 AS __SPANS", "'t' AS __text")
    for model in (NEVER, fit_boosted(docs(rows))):
        got = redact(frame, model)
        assert got.columns == frame.columns and got.schema["base"].dataType.simpleString() == "string"
        found = got.collect()
        assert len(found) == 200 and all((r.base, r.spans, r["__base"], r["__SPANS"], r["__text"]) == (f"b{r.doc_id}", r.doc_id, "x", 1, "t") for r in found)
        assert all("[EMAIL]" in r.text and "@mail" not in r.text for r in found)


def test_empty_table_and_no_candidates(spark, docs):
    assert report_private(docs([])).count() == 0
    assert [r.spans for r in report_private(docs([(1, "nothing here"), (2, None)])).collect()] == ["", ""]


def test_trees_give_back_what_separates():
    low = dict.fromkeys(["length", "digits", "letters", "separators", "luhn", "kind", "plus", "at", "mixed", "capital", "hex", "secret_word", "contact_word", "assigned", "octets"], 0)
    table = [(low, 100, 0, c) for c in (False, True)] + [(low | {"luhn": 1, "digits": 16}, 50, 50, c) for c in (False, True)] + [(low | {"luhn": 1, "digits": 5}, 60, 0, c) for c in (False, True)]
    model = boost(table)
    score = lambda f: model.base + sum(t.value_of(f) for t in model.trees)
    assert score(low | {"luhn": 1, "digits": 16}) >= model.threshold > score(low) and score(low | {"luhn": 1, "digits": 5}) < model.threshold


def many_with_secrets(spark):
    """More documents than any sample had, of one candidate each, and the log odds of those of the boosting half."""
    text = "CASE WHEN id % 5 = 0 THEN 'token = ' || translate(left(md5(string(id)), 20), '0123456789', 'ghijklmnop') || '9a' ELSE 'see part-number-' || id || '-of-2024' END"
    rows = spark.range(25_000).selectExpr("id AS doc_id", f"{text} AS text")
    total, private = rows.where("pmod(xxhash64('half', text), 2) = 0").selectExpr("count(*)", "count_if(doc_id % 5 = 0)").first()
    return rows, math.log(private / (total - private))


def test_boosting_learns_from_every_document(spark):
    rows, log_odds = many_with_secrets(spark)
    model = fit_boosted(rows)
    assert model.base == log_odds
    assert model.threshold is not None and find_private(rows, model).where("(size(spans) > 0) <> (doc_id % 5 = 0)").count() == 0


def test_the_pipeline_learns_from_every_document(spark, monkeypatch):
    rows, log_odds = many_with_secrets(spark)
    models = []
    monkeypatch.setattr(corpus_pipeline, "redact", lambda docs, model: (models.append(model), redact(docs, model))[1])
    got = corpus_pipeline.privacy(spark, rows, "")
    assert models[0].base == log_odds and got.where("(text = 'token = [SECRET]') <> (doc_id % 5 = 0)").count() == 0


def test_boosting_over_partitions_equals_boosting_of_a_list(spark):
    rng = random.Random(8)
    table = []
    for _ in range(400):
        f = {name: rng.randint(0, 3 if i > 3 else 30) for i, name in enumerate(FEATURES)}
        n = rng.randint(1, 50)
        table.append((f, n, n if f["luhn"] > 1 and f["digits"] > 9 else rng.randint(0, 2) % (n + 1) // 2, rng.random() < 0.5))
    schema = f"f struct<{', '.join(f'{x}: int' for x in FEATURES)}>, calibrates boolean, n bigint, y bigint"
    frame = spark.createDataFrame([(f, c, n, y) for f, n, y, c in table], schema)
    one, many = boost(table), boost(Counted(frame.repartition(5)))
    assert many == boost(Counted(frame.coalesce(1))) and many.base == one.base and one.threshold is not None
    for f, _, _, _ in table:
        assert abs(one.value_of(f) - many.value_of(f)) < 1e-6 and (one.value_of(f) >= one.threshold) == (many.value_of(f) >= many.threshold)
