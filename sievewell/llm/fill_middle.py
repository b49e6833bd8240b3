"""Fill-in-the-middle texts by repeated-capture matching.

A text is a sequence of units (code points unless another pattern is given).
One full match of ``(unit)*`` by the regex library, whose groups keep every
repetition, gives the ends of all units: their number is n, and the ends of
unit i and unit j are the two cuts.  All else is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most units of one match of a long text. A match takes some 120 bytes for each unit, so that texts of more code points
#: than this take several matches, one from where the other ended; no unit is left out.
SPAN = 1 << 18


@dataclass(frozen=True)
class FillMiddle:
    """How texts are cut, marked and chosen.

    ``unit`` is the pattern of one unit and must not match an empty text.
    ``percent`` of the documents are cut, and of these ``suffix_first_percent``
    give the suffix before the prefix (form ``spm``, else ``psm``).
    """

    unit: str = "(?s:.)"
    prefix_mark: str = "<P>"
    suffix_mark: str = "<S>"
    middle_mark: str = "<M>"
    percent: int = 90
    suffix_first_percent: int = 20

    def __post_init__(self) -> None:
        if regex.fullmatch(self.unit, ""):
            raise ValueError(f"unit {self.unit!r} matches an empty text")
        if len({*self.marks}) < 3 or not all(self.marks):
            raise ValueError("three different marks are needed")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix_mark, self.suffix_mark, self.middle_mark


class Units:
    """Texts as sequences of units; a unit is what its pattern matches first, and is not given back."""

    def __init__(self, unit: str, span: int = SPAN):
        self._all = regex.compile(f"(?>({unit}))*")
        self._some = regex.compile(f"(?>({unit})){{1,{span}}}")
        self._span = span

    def ends(self, text: str) -> np.ndarray | None:
        """Ends of the units that make up ``text``: one match of ``(unit)*`` retains them all. None if units do not make it up.

        A text of more than ``span`` code points is matched by so many units at a time.
        """
        if len(text) <= self._span:
            found = self._all.fullmatch(text)
            return None if found is None else np.array(found.ends(1), dtype=np.int64)
        parts, at = [], 0
        while at < len(text):
            found = self._some.match(text, at)
            if found is None:
                return None
            parts.append(np.array(found.ends(1), dtype=np.int64))
            at = found.end()
        return np.concatenate(parts)


def cuts(text: Column, first: Column, second: Column, unit: str) -> Column:
    """Struct of n and the code points before the lower and the higher of units first % (n + 1) and second % (n + 1).

    NULL where the text is not made up of units.
    """
    made = pa.struct([("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    @F.arrow_udf("struct<n: bigint, low: bigint, high: bigint>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        units = Units(unit)
        for texts, firsts, seconds in batches:
            rows = []
            for t, i, j in zip(texts, firsts.to_pylist(), seconds.to_pylist()):
                ends = units.ends(t.as_py())
                if ends is None:
                    rows.append(None)
                    continue
                n = len(ends)
                low, high = sorted((i % (n + 1), j % (n + 1)))
                rows.append({"n": n, "low": int(ends[low - 1]) if low else 0, "high": int(ends[high - 1]) if high else 0})
            yield pa.array(rows, made)

    return cut(text, first, second)


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that depend on the id alone: the first groups of eight hexadecimal digits of a digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(documents: DataFrame, spec: FillMiddle = FillMiddle(), doc_id: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each document.

    ``output`` is the text itself (form ``plain``) or its three parts, each
    behind its mark.  Plain are texts that are empty, hold a mark, are not
    made up of units (n is 0 then) or are not chosen.  A NULL text is an empty
    one; a NULL id draws as an id without digits; repeated rows come out
    alike; other columns are not looked at.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    whole = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    cut = whole.select("doc_id", "text", cuts(F.col("text"), h1, h2, spec.unit).alias("cut"))
    t, low, high = F.col("text"), F.col("cut.low").cast("int"), F.col("cut.high").cast("int")
    marked = F.contains(t, F.lit(spec.marks[0])) | F.contains(t, F.lit(spec.marks[1])) | F.contains(t, F.lit(spec.marks[2]))
    plain = (t == "") | marked | F.col("cut").isNull() | (h3 % 100 >= spec.percent)
    form = F.when(plain, "plain").when(h4 % 100 < spec.suffix_first_percent, "spm").otherwise("psm")
    p, s, m = (F.lit(x) for x in spec.marks)
    prefix, middle = F.substring(t, F.lit(1), low), F.substring(t, low + 1, high - low)
    # As long as can be: up to the end.
    suffix = F.substring(t, high + 1, F.lit(2**31 - 1))
    shaped = cut.withColumn("form", form)
    return shaped.select(
        "doc_id",
        F.coalesce("cut.n", F.lit(0).cast("bigint")).alias("n"),
        "form",
        F.when(F.col("form") != "plain", F.col("cut.low")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("cut.high") - F.col("cut.low")).alias("middle_chars"),
        F.when(F.col("form") == "plain", t)
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
        .alias("output"),
    )


def restored(output: Column, form: Column, spec: FillMiddle = FillMiddle()) -> Column:
    """The text that ``fill_in_middle`` was given, from what it gave out."""
    p, s, m = (regex.escape(x) for x in spec.marks)
    return (
        F.when(form == "psm", F.regexp_replace(output, f"(?s)^{p}(.*){s}(.*){m}(.*)$", "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, f"(?s)^{s}(.*){p}(.*){m}(.*)$", "$2$3$1"))
        .otherwise(output)
    )
