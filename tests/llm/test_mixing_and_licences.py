from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewell.llm.licences import EQUIVALENT, KNOWN, built_in, canonical, first_word, match_licences, scan_licences
from sievewell.llm.mixing import mix, with_rates


def corpus(docs, n=300):
    kinds = (("red", "ruby scarlet crimson rose"), ("blue", "navy azure sky teal"), ("grey", "ash slate stone dust"))
    rows = [(i, " ".join([kinds[k := i % 10 if i % 10 < 2 else 2][1]] * (1 + i % 5))) for i in range(n)]
    return docs(rows), [(i, kinds[min(i % 10, 2)][0]) for i in range(n)]


def test_expected_tokens_meet_their_targets(spark, docs):
    frame, domains = corpus(docs)
    labelled = spark.createDataFrame(domains[:150], "doc_id bigint, domain string")
    targets = {"red": 0.2, "blue": 0.1, "grey": 0.7}
    rated, classifier = mix(frame, labelled, targets)
    assert classifier.domains == ("blue", "grey", "red")
    total = rated.agg(F.sum("tokens").alias("t")).first().t
    for k, d in enumerate(classifier.domains):
        x = rated.agg(F.sum(F.col("rate") * F.col("tokens") * F.get("p", k)).alias("x")).first().x
        assert x / total == pytest.approx(targets[d], abs=0.02)
    assert rated.where("rate < 0 or copies < floor(rate) or copies > ceil(rate)").count() == 0
    both = with_rates(frame.withColumn("rate", F.lit("mine")), rated)
    assert both.count() == 300 and set(both.columns) == {*frame.columns, "rate", "copies"}


def test_targets_of_absent_domains_are_shared_out(spark, docs):
    """As in the pipeline, whose toxicity stage leaves no toxic document."""
    frame, domains = corpus(docs)
    labelled = spark.createDataFrame(domains[:150], "doc_id bigint, domain string")
    rated, classifier = mix(frame, labelled, {"red": 0.18, "blue": 0.09, "grey": 0.63, "toxic": 0.1})
    sums = rated.agg(F.sum("tokens").alias("t"), *[F.sum(F.col("rate") * F.col("tokens") * F.get("p", k)).alias(d) for k, d in enumerate(classifier.domains)]).first()
    assert [sums[d] / sums.t for d in ("red", "blue", "grey")] == pytest.approx([0.2, 0.1, 0.7], abs=0.02)
    assert sum(sums[d] for d in classifier.domains) / sums.t == pytest.approx(1, abs=0.01)
    assert {r.rate for r in mix(frame, labelled, {"toxic": 1.0})[0].collect()} == {1.0}


def test_mixing_odd_rows(spark, docs, odd):
    rated, _ = mix(docs(odd), spark.createDataFrame([(4, "a"), (5, "b"), (None, "c"), (6, None)], "doc_id bigint, domain string"), {"a": 1})
    assert sorted((r.doc_id for r in rated.collect()), key=str) == [1, 2, 3, 4, 5, 6, 7, None]
    assert rated.where("rate is null or tokens is null").count() == 0
    none = spark.createDataFrame([], "doc_id bigint, domain string")
    assert {r.rate for r in mix(docs(odd), none, {"a": 1})[0].collect()} == {1.0}
    assert mix(docs([]), none, {"a": 1})[0].count() == 0 and mix(docs([]), spark.createDataFrame([(1, "a")], none.schema), {})[0].count() == 0


def test_licences_in_other_spellings(spark, docs, odd):
    mit = KNOWN[0][1]
    rows = [
        (10, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(" ", "  \n")), (11, mit.replace("sublicense", "sub-license")),
        (12, mit + " But not here."), (13, "Released under the MIT Licence"), (14, "Some prose.\nLicensed under CC BY-NC 4.0.\nMore.\nALL RIGHTS RESERVED\nall rights reserved."),
        (15, "© 2021 me\nLICENSED under the Apache Licence; v. 2.0"), *odd,
    ]
    got = {r.doc_id: r for r in scan_licences(docs(rows).withColumn("license", F.lit("mine")), built_in(spark)).collect()}
    assert got[10].license == got[13].license == "MIT" and got[15].license == "Apache-2.0"
    assert got[11].license is None and got[12].license is None and got[14].license is None
    assert got[14].notices == "CC-BY-NC-4.0,all-rights-reserved" and got[12].notices == ""
    assert all(got[i].license is None and got[i].notices == "" for i in (1, 2, 3, 4, 5, None))
    titled = [(20, "MIT License\n\nCopyright (c) 2024 Some One\n\n" + mit), (21, "The MIT License (MIT)\n\n" + mit), (22, "ISC License\n\n" + KNOWN[1][1])]
    assert {r.doc_id: r.license for r in scan_licences(docs(titled), built_in(spark)).collect()} == {20: "MIT", 21: "MIT", 22: "ISC"}
    # Notices are a text's own, whatever its id.
    shared = [(None, "Prose.\nReleased under the MIT License."), (None, "Prose alone."), (7, "All rights reserved.\nx"), (7, "y"), (7, "All rights reserved.\nx")]
    assert sorted((str(r.doc_id), r.notices) for r in scan_licences(docs(shared), built_in(spark)).collect()) == [
        ("7", ""), ("7", "all-rights-reserved"), ("7", "all-rights-reserved"), ("None", ""), ("None", "MIT"),
    ]
    assert match_licences(docs(rows), built_in(spark)).count() == len(rows) and scan_licences(docs([]), built_in(spark)).count() == 0


def test_first_words_are_those_of_canonical_lines(spark):
    lines = [f"{a}{w}{b}" for w, _ in EQUIVALENT for a, b in (("", " x"), ("** ", ""), ("\t", ", y"), ("", "z q"))]
    lines += ["", "  ", "--", "\u00a9 2020 me", "\u00a9me", "(c) 2020 x", "(C) someone", "copyright 2020", "Copyright holders", "\u00c9cole A", "a\u0301b c", "\r", "\U0001f600 x"]
    got = spark.createDataFrame([(x,) for x in lines], "t string").select(canonical(F.col("t")).alias("c"), first_word(F.col("t")).alias("f")).collect()
    assert all(r.c == "" or r.c.split(" ")[0] == r.f for r in got)
