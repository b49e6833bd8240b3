"""License scans: digests of canonical whole texts, hash-joined to those of known licences.

A text is made canonical by lower-casing A-Z, dropping copyright lines, turning
everything but letters and digits into single spaces and writing equivalent
spellings alike.  Two texts with one digest are the same licence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewell.plans.skew import salted_lookup

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most known licences to broadcast; more are joined by a shuffle.
MOST_BROADCAST = 50_000

# A line is one of copyright if a sign, a year or a placeholder follows: a wrapped text may begin a line with the word.
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright[ \t]*(\(c\)|©|[ \t][0-9<])[^\n]*|\(c\)[ \t]*[0-9][^\n]*|©[^\n]*)"
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"

# Spellings that count as the same, each with the one kept.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("favour", "favor"), ("organisation", "organization"),
    ("noncommercial", "non commercial"),
    ("https", "http"), ("c", "copyright"), ("v", "version"), ("programme", "program"), ("whilst", "while"), ("wilful", "willful"),
)

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

# Known licences and notices, and titles that whole texts may carry.
TITLES = (
    ("MIT", "MIT License"), ("MIT", "The MIT License"), ("MIT", "The MIT License (MIT)"), ("MIT", "MIT License (MIT)"),
    ("ISC", "ISC License"), ("ISC", "The ISC License"), ("ISC", "ISC License (ISC)"), ("ISC", "ISC License (ISCL)"),
)
_TEXTS = (
    ("MIT", f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
{_WARRANTY}"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("all-rights-reserved", "All rights reserved."),
)
KNOWN = _TEXTS + tuple((name, f"{title}\n\n{dict(_TEXTS[:2])[name]}") for name, title in TITLES)


def canonical(text: Column) -> Column:
    """The canonical form; NULL is taken as empty."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    out = F.regexp_replace(lower, COPYRIGHT_LINE, "\n")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, NOT_WORD, " ")), F.lit(" "))
    for spelling, kept in EQUIVALENT:
        # Twice, as two neighbours share the space between them.
        for _ in range(2):
            out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {kept} "))
    return F.trim(out)


def first_word(line: Column) -> Column:
    """First word of the canonical form of a text of one line, unless that form is empty; no more of the line is looked at."""
    word = F.translate(F.regexp_extract(line, r"[A-Za-z0-9\x{80}-\x{10FFFF}]+", 0), _UPPER, _LOWER)
    spellings = F.create_map(*[F.lit(x) for pair in EQUIVALENT for x in pair])
    return F.substring_index(F.coalesce(F.element_at(spellings, word), word), " ", 1)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(known: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """(digest, license): one row per digest, the first name in order where several share one. Empty texts are no licences."""
    rows = known.select(F.col(name).alias("license"), canonical(F.col(text)).alias("c")).where("c != ''")
    return rows.groupBy(F.sha2(F.col("c").cast("binary"), 256).alias("digest")).agg(F.min("license").alias("license"))


def built_in(spark) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in KNOWN])
    return spark.range(1).select(F.inline(rows))


def match_licences(texts: DataFrame, known: DataFrame, text: str = "text", how: str = "left") -> DataFrame:
    """``texts`` with columns digest and license (NULL if unknown); columns of these names are replaced.

    Every row is looked up by its whole text.  NULL and empty texts match
    nothing; repeated rows match alike.
    """
    lookup = known_digests(known)
    if lookup.count() <= MOST_BROADCAST:
        lookup = F.broadcast(lookup)
    return texts.drop("license").withColumn("digest", digest(F.col(text))).join(lookup, "digest", how)


def scan_licences(documents: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, license and notices per document.

    ``license`` is that of the whole text; ``notices`` names, sorted and joined
    by commas, the licences that lines of the text state, each line taken as a
    whole text ('' if there are none).  Notices belong to a text, so that
    copies share them and rows that only share an id (or have none) do not.
    """
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    exact = texts.select("*", F.sha2(F.col("text"), 256).alias("exact"))
    whole = match_licences(exact, known).select("doc_id", "exact", "digest", "license")
    lines = exact.select("exact", F.explode(F.split("text", "\n", -1)).alias("text"))
    # Only lines that begin as some known text does are made canonical.
    beginnings = known.select(F.substring_index(canonical(F.col("text")), " ", 1).alias("begins")).where("begins != ''").distinct()
    if beginnings.count() <= MOST_BROADCAST:
        beginnings = F.broadcast(beginnings)
    lines = lines.withColumn("begins", first_word(F.col("text"))).join(beginnings, "begins", "left_semi").drop("begins")
    stated = match_licences(lines, known, how="inner").select("exact", "license").distinct()
    notices = stated.groupBy("exact").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
    joined = salted_lookup(whole, notices, ["exact"], ["doc_id"], salts=8, how="left")
    return joined.select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def sql_canonical(text: str) -> str:
    """The canonical form as SQL."""
    lower = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    out = f"regexp_replace({lower}, '{COPYRIGHT_LINE}', chr(10), 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{NOT_WORD}', ' ', 'g')) || ' '"
    for spelling, kept in EQUIVALENT:
        for _ in range(2):
            out = f"replace({out}, ' {spelling} ', ' {kept} ')"
    return f"trim({out})"
