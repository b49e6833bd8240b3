from __future__ import annotations

import hashlib
import re

import pytest
import regex
from pyspark.sql import functions as F

from sievewell.llm.fill_middle import FillMiddle, Units, fill_in_middle, restored

SPEC = FillMiddle()


def by_hand(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of a text of code points."""
    t = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if t == "" or re.search("<[PSM]>", t) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    p, m, s = t[:low], t[low:high], t[high:]
    if h4 % 100 < 20:
        return len(t), "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", "x", " \n\t", "é" * 40, "a\U0001f600b\U0001f469‍\U0001f4bb\r\n" * 9, "keeps <P> as it is", "<S>", "a <M", "<P", "P><S", "$1 \\2 <<P <M><",
    "nul \0 and line  and\x85", "word " * 3000,
]


def test_equal_to_cutting_by_hand(docs, odd):
    rows = odd + [(100 + i, t) for i, t in enumerate(TEXTS * 12)]
    out = fill_in_middle(docs(rows)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out), key=repr)
    assert got == sorted(((i, *by_hand(i, t), t or "") for i, t in rows), key=repr)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("span", [1, 2, 3, 7, 64])
@pytest.mark.parametrize("unit", ["(?s:.)", r"\s*\S+\s*", r"(?:ab)+|.", "[a-c]{2}"])
def test_long_texts_in_spans_are_as_one_match(unit, span):
    units, whole_units = Units(unit, span), regex.compile(f"(?>({unit}))*")
    for text in ("", "a", "abab c ababab", "one  two three\tfour ", "abcabc", "  ", "abca", "x" * 50 + " y"):
        whole = whole_units.fullmatch(text)
        ends = units.ends(text)
        assert (None if whole is None else whole.ends(1)) == (None if ends is None else ends.tolist())


def test_units_of_words(docs):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 9))) for i in range(60)] + [(99, " ")]
    spec = FillMiddle(unit=r"\S+\s*")
    out = fill_in_middle(docs(rows), spec).withColumn("back", restored(F.col("output"), F.col("form"), spec)).collect()
    texts = dict(rows)
    assert all(r.back == texts[r.doc_id] and r.n == len(texts[r.doc_id].split()) for r in out)
    cut = [r for r in out if r.form != "plain"]
    assert len(cut) > 30
    for r in cut:
        starts = {0, len(texts[r.doc_id]), *(m.start() for m in re.finditer(r"\S+", texts[r.doc_id]))}
        assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= starts
    # Not a sequence of such units.
    assert [(r.n, r.form) for r in out if r.doc_id == 99] == [(0, "plain")]


def test_empty_table_and_clashing_columns(spark, docs):
    assert fill_in_middle(docs([])).collect() == []
    wide = docs([(1, "some text")]).selectExpr("*", "1 AS n", "'a' AS form", "'b' AS cut", "'c' AS output", "2 AS h1")
    assert fill_in_middle(wide).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_in_middle(wide).first().n == 9


def test_specs_that_make_no_sense():
    with pytest.raises(ValueError):
        FillMiddle(unit=".*")
    with pytest.raises(ValueError):
        FillMiddle(suffix_mark="<P>")
