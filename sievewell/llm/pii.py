"""Personal data: exact formats, and candidates judged by boosted trees, in column expressions only.

Four formats (e-mail, IP address, card, phone) are found exactly.  Beside them
high-recall generators propose overlapping spans: anything around an @, runs
of digits with separators, long tokens.  Each candidate becomes a few small
numbers about its format and its context, and a sum of regression trees over
these says how likely it is private.  Spark counts the candidates of all
documents per combination of features.  The trees are boosted on those of one
half of the texts (by hash): for each level of a tree, sums per node, feature
and value, a fixed number, come to the driver.  The threshold is the lowest
that keeps the stated precision on the other half.  Trees are applied as CASE
expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewell.llm.store import stored

# The formats, written so that a search never goes back within a run (the matches are those of the plain forms
# given in the README), and the kinds in the order in which spans are written.
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a format to be looked for.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

GENERATORS = {
    "address": r"(?<![^\s@])[^\s@]++@\S++",
    "number": r"[0-9+(](?:[ ().+-]{0,2}[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{12,}+",
}
CONTEXT = 24

#: Trees, their depth, step, splits and the precision asked of the candidates added.
TREES = 12
DEPTH = 3
STEP = 0.5
LEAST_IN_LEAF = 5
PRECISION = 0.98
#: Gradients and curvatures are summed as whole numbers of this part, so that the trees do not depend on how rows are dealt.
UNITS = 1 << 20
#: Scores are summed by bands, so many to one of log odds, and the last band is open.
BANDS = 64
MOST_BANDS = 4096

FEATURES = ("length", "digits", "letters", "separators", "luhn", "kind", "plus", "at", "mixed", "capital", "hex", "secret_word", "contact_word", "assigned", "octets")
# Words of the context.
SECRET_WORDS = r"(?i)(?:passw|passwd|pwd|token|secret|api|key|credential|auth)[A-Za-z_]*\W*$"
CONTACT_WORDS = r"(?i)(?:mail|phone|tel|call|fax|mobile|contact|card|visa|account|ip|addr)[A-Za-z_]*\W*$"
KEY_FORM = r"^(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{20,})$"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right counts double, less 9 above 9."""
    each = F.split(F.reverse(digits), "")
    worth = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise((d.try_cast("int") * 2) % 10 + F.floor(d.try_cast("int") / 5).cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(13, 19) & passes_luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match, before, after>> in code points, from the pieces between the matches."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.struct(found.alias("found"), between.alias("between"))

    def place(b: Column) -> Column:
        steps = F.zip_with(F.slice(b["between"], F.lit(1), F.size(b["found"])), b["found"], lambda s, m: F.struct(F.length(s).alias("gap"), F.length(m).alias("size")))
        ends = F.aggregate(
            steps, F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
            lambda a, s: F.struct(
                (a["end"] + s["gap"] + s["size"]).alias("end"),
                F.concat(a["spans"], F.array(F.struct((a["end"] + s["gap"]).alias("start"), (a["end"] + s["gap"] + s["size"]).alias("end")))).alias("spans"),
            ),
        )["spans"]
        return F.transform(
            F.arrays_zip(ends.alias("at"), b["found"].alias("match"), F.sequence(F.lit(0), F.size(b["found"]) - 1).alias("i")),
            lambda x: F.struct(
                x["at"]["start"].alias("start"), x["at"]["end"].alias("end"), x["match"].alias("match"),
                F.right(F.get(b["between"], x["i"]), F.lit(CONTEXT)).alias("before"), F.left(F.get(b["between"], x["i"] + 1), F.lit(CONTEXT)).alias("after"),
            ),
        )

    # One evaluation of both searches, then everything from their results.
    return F.get(F.transform(F.filter(F.array(both), lambda b: F.size(b["found"]) > 0), place), F.lit(0))


def _spans(kind: str, text: Column) -> Column:
    found = F.filter(_matches(text, FORMATS[kind]), lambda m: _valid(kind, m["match"]))
    spans = F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    has = F.contains(text, F.lit(NEEDS[kind])) & text.rlike("[0-9]") if kind != "email" else F.contains(text, F.lit("@"))
    return F.coalesce(F.when(has, spans), F.array().cast("array<struct<kind:string,start:int,end:int>>"))


def _candidates(text: Column) -> Column:
    """All proposals of the generators, with what is needed to judge them."""
    lists = []
    for kind, pattern in GENERATORS.items():
        has = F.contains(text, F.lit("@")) if kind == "address" else text.rlike("[0-9]")
        found = F.transform(_matches(text, pattern), lambda m: F.struct(F.lit(kind).alias("kind"), *[m[c].alias(c) for c in ("start", "end", "match", "before", "after")]))
        if kind == "secret":
            found = F.filter(found, lambda m: m["match"].rlike("[0-9]") & m["match"].rlike("[A-Za-z]"))
        lists.append(F.when(has, found))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,match:string,before:string,after:string>>")
    return F.concat(*[F.coalesce(x, empty) for x in lists])


def _features(c: Column) -> Column:
    match, digits = c["match"], _digits(c["match"])
    small = lambda x, most: F.least(x, F.lit(most)).cast("int")
    flag = lambda x: x.cast("int")
    values = {
        "length": small(F.length(match), 60),
        "digits": small(F.length(digits), 24),
        "letters": small(F.length(F.regexp_replace(match, "[^A-Za-z]", "")), 40),
        "separators": small(F.length(F.regexp_replace(match, "[^ ().-]", "")), 8),
        "luhn": flag(passes_luhn(digits)),
        "kind": F.when(c["kind"] == "address", 0).when(c["kind"] == "number", 1).otherwise(2),
        "plus": flag(match.startswith("+")),
        "at": flag(match.rlike(r"^[^@]+@[^@.]+\.[^@]*[A-Za-z]")),
        "mixed": flag(match.rlike("[0-9]") & match.rlike("[A-Za-z]")),
        "capital": flag(match.rlike("^[A-Z0-9]+$")),
        "hex": flag(match.rlike("^[0-9a-f]+$")),
        "secret_word": flag(c["before"].rlike(SECRET_WORDS) | match.rlike(r"(?i)^(?:password|passwd|pwd|token|secret|key)=")),
        "contact_word": flag(c["before"].rlike(CONTACT_WORDS)),
        "assigned": flag(c["before"].rlike(r"[=:]\s*[\"']?$") | match.contains("=")),
        "octets": flag(match.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")),
    }
    return F.struct(*[values[f].alias(f) for f in FEATURES])


def _weak_label(c: Column) -> Column:
    """1 for a proposal that is a valid format as a whole, a token assigned to a secret's name, or a key of a known form."""
    match = c["match"]
    whole = F.lit(False)
    for kind, pattern in FORMATS.items():
        whole = whole | (match.rlike(f"^(?:{pattern})$") & _valid(kind, match))
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    named = (c["before"].rlike(SECRET_WORDS) & mixed) | match.rlike(r"(?i)^(?:password|passwd|pwd|token|secret|key)=.*[0-9]")
    return (whole | named | match.rlike(KEY_FORM)).cast("int")


@dataclass(frozen=True)
class Leaf:
    value: float

    def expression(self, features: Column) -> Column:
        return F.lit(self.value)

    def sql(self, features: str) -> str:
        return f"{float(self.value)!r}D"

    def value_of(self, row: dict[str, int]) -> float:
        return self.value


@dataclass(frozen=True)
class Split:
    feature: str
    most: int
    low: Leaf | Split
    high: Leaf | Split

    def expression(self, features: Column) -> Column:
        return F.when(features[self.feature] <= self.most, self.low.expression(features)).otherwise(self.high.expression(features))

    def sql(self, features: str) -> str:
        return f"if({features}.{self.feature} <= {self.most}, {self.low.sql(features)}, {self.high.sql(features)})"

    def value_of(self, row: dict[str, int]) -> float:
        return (self.low if row[self.feature] <= self.most else self.high).value_of(row)


@dataclass(frozen=True)
class Boosted:
    """Sum of trees as log odds, and the log odds from which a candidate is private (None: never)."""

    base: float
    trees: tuple[Leaf | Split, ...]
    threshold: float | None

    def log_odds(self, features: Column) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + tree.expression(features)
        return total

    def sql(self, features: str) -> str:
        """The same over a column of that name, in one expression."""
        return " + ".join([Leaf(self.base).sql(features), *[t.sql(features) for t in self.trees]])

    def value_of(self, row: dict[str, int]) -> float:
        return self.base + sum(t.value_of(row) for t in self.trees)


#: Of a tree whose open leaves are numbered from 1: (leaf, feature, value) to the sums of gradients and curvatures there.
Sums = Callable[["Leaf | Split"], dict[tuple[int, str, int], tuple[int, int]]]


def _best_split(cells: dict[str, dict[int, tuple[float, float]]], g: float, h: float) -> tuple[str, int, float, float] | None:
    """Feature, most of the lower side and its two sums, where a split gains most."""
    best = None
    for feature in FEATURES:
        lg = lh = 0.0
        for value in sorted(cells[feature])[:-1]:
            lg += cells[feature][value][0]
            lh += cells[feature][value][1]
            gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, feature, value, lg, lh)
    return best[1:] if best and best[0] > 1e-3 else None


def _grow(sums: Sums) -> Leaf | Split:
    """A tree grown level by level; node k has the nodes 2 k and 2 k + 1 below it."""
    splits: dict[int, tuple[str, int]] = {}
    totals: dict[int, tuple[float, float]] = {}

    def tree(k: int, leaf: Callable[[int], Leaf]) -> Leaf | Split:
        return Split(*splits[k], tree(2 * k, leaf), tree(2 * k + 1, leaf)) if k in splits else leaf(k)

    opened = [1]
    for _ in range(DEPTH):
        cells: dict[int, dict[str, dict[int, tuple[float, float]]]] = {k: {f: {} for f in FEATURES} for k in opened}
        for (k, feature, value), (g, h) in sums(tree(1, lambda k: Leaf(k if k in opened else 0))).items():
            cells[k][feature][value] = (g / UNITS, h / UNITS)
        below = []
        for k in opened:
            g, h = totals.setdefault(k, tuple(map(sum, zip((0.0, 0.0), *cells[k][FEATURES[0]].values()))))
            if best := _best_split(cells[k], g, h):
                feature, value, lg, lh = best
                splits[k], totals[2 * k], totals[2 * k + 1] = (feature, value), (lg, lh), (g - lg, h - lh)
                below += [2 * k, 2 * k + 1]
        opened = below
        if not opened:
            break
    return tree(1, lambda k: Leaf(STEP * totals[k][0] / (totals[k][1] + 1)))


@dataclass(frozen=True)
class Listed:
    """Counts in memory: (features, candidates, private ones, whether the row calibrates) per combination of features."""

    rows: list[tuple[dict, int, int, bool]]

    def totals(self) -> tuple[int, int]:
        train = [(n, y) for _, n, y, calibrates in self.rows if not calibrates]
        return sum(n for n, _ in train), sum(y for _, y in train)

    def sums(self, model: Boosted, numbered: Leaf | Split) -> dict[tuple[int, str, int], tuple[int, int]]:
        out: dict[tuple[int, str, int], tuple[int, int]] = {}
        for f, n, y, calibrates in self.rows:
            node = numbered.value_of(f)
            if calibrates or not node:
                continue
            p = 1 / (1 + math.exp(min(-model.value_of(f), 700.0)))
            g, h = round((y - n * p) * UNITS), round(n * p * (1 - p) * UNITS)
            for feature in FEATURES:
                was = out.get((node, feature, f[feature]), (0, 0))
                out[node, feature, f[feature]] = (was[0] + g, was[1] + h)
        return out

    def threshold(self, model: Boosted) -> float | None:
        held = sorted(((model.value_of(f), n, y) for f, n, y, calibrates in self.rows if calibrates), key=lambda r: -r[0])
        lowest, seen, right = None, 0, 0
        for i, (s, n, y) in enumerate(held):
            seen, right = seen + n, right + y
            if right >= PRECISION * seen and s > 0 and (i + 1 == len(held) or held[i + 1][0] < s):
                lowest = s
        return lowest


@dataclass(frozen=True)
class Counted:
    """The same as written rows (f, calibrates, n, y), which stay where they are; what comes to the driver does not grow with them."""

    rows: DataFrame

    def totals(self) -> tuple[int, int]:
        found = self.rows.where("NOT calibrates").agg(F.sum("n"), F.sum("y")).first()
        return found[0] or 0, found[1] or 0

    def sums(self, model: Boosted, numbered: Leaf | Split) -> dict[tuple[int, str, int], tuple[int, int]]:
        train = self.rows.where("NOT calibrates").selectExpr("f", "n", "y", f"int({numbered.sql('f')}) AS node", f"1 / (1 + exp(-({model.sql('f')}))) AS p")
        cells = ", ".join(f"struct({i} AS feature, f.{name} AS value)" for i, name in enumerate(FEATURES))
        each = train.where("node > 0").selectExpr(
            "node", f"bigint(rint((y - n * p) * {UNITS})) AS g", f"bigint(rint(n * p * (1 - p) * {UNITS})) AS h", f"explode(array({cells})) AS cell"
        )
        found = each.groupBy("node", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        return {(r.node, FEATURES[r.cell.feature], r.cell.value): (r.g, r.h) for r in found}

    def threshold(self, model: Boosted) -> float | None:
        """Bands of scores are summed first, so that a task orders the scores of one band, knowing what is above it."""
        band = F.least(F.floor(F.col("score") * BANDS), F.lit(MOST_BANDS)).cast("int")
        held = self.rows.where("calibrates").selectExpr(f"{model.sql('f')} AS score", "n", "y").where("score > 0")
        scores = held.groupBy("score").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).select(band.alias("band"), "score", "n", "y")
        above, seen, right = [], 0, 0
        for r in sorted(scores.groupBy("band").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect(), key=lambda r: -r.band):
            above.append((r.band, seen, right))
            seen, right = seen + r.n, right + r.y
        if not above:
            return None
        higher = self.rows.sparkSession.createDataFrame(pa.table(dict(zip(("band", "n_above", "y_above"), map(list, zip(*above))))))
        down = Window.partitionBy("band").orderBy(F.desc("score"))
        so_far = scores.join(F.broadcast(higher), "band").select(
            "score", (F.col("n_above") + F.sum("n").over(down)).alias("seen"), (F.col("y_above") + F.sum("y").over(down)).alias("right")
        )
        return so_far.where(F.col("right") >= F.lit(PRECISION) * F.col("seen")).agg(F.min("score")).first()[0]


def boost(table: list[tuple[dict, int, int, bool]] | Counted) -> Boosted:
    """From (features, candidates, private ones, whether the row calibrates) per combination of features, listed or as counted rows."""
    counts = table if isinstance(table, Counted) else Listed(table)
    total, private = counts.totals()
    if not private or private == total:
        return Boosted(0.0, (), None)
    model = Boosted(math.log(private / (total - private)), (), None)
    for _ in range(TREES):
        model = replace(model, trees=(*model.trees, _grow(lambda numbered: counts.sums(model, numbered))))
    lowest = counts.threshold(model)
    return model if lowest is None else replace(model, threshold=lowest - 1e-9)


def fit_boosted(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Boosted:
    """Boost on the candidates of all documents, counted per combination of features and written once."""
    rows = documents.select(F.col(text).cast("string").alias("text")).where("text is not null")
    exploded = rows.select((F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)) == 1).alias("calibrates"), F.explode(_candidates(F.col("text"))).alias("c"))
    judged = exploded.select("calibrates", _features(F.col("c")).alias("f"), _weak_label(F.col("c")).alias("y"))
    counted = judged.groupBy("f", "calibrates").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    return boost(Counted(stored(counted, "pii-candidates")))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(documents: DataFrame, model: Boosted, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``documents`` with ``base`` and ``spans``, arrays of (kind, start, end) in code points, end exclusive.

    ``base`` holds the exact formats by kind as listed, then start; ``spans``
    adds, by kind and start, candidates judged private that overlap no base
    span and no candidate added before.  NULL is an empty text and has none.
    The arguments ``base`` and ``spans`` rename the two columns; a column of
    the documents with such a name is replaced.
    """
    whole = _unused(documents, "__text")
    out = documents.withColumn(whole, F.coalesce(F.col(text).cast("string"), F.lit("")))
    out = out.withColumn(base, F.concat(*[_spans(kind, F.col(whole)) for kind in FORMATS]))
    if model.threshold is None:
        return out.withColumn(spans, F.col(base)).drop(whole)
    likely = F.filter(_candidates(F.col(whole)), lambda c: model.log_odds(_features(c)) >= model.threshold)
    free = F.filter(likely, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    plain = F.transform(free, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    apart = F.aggregate(
        plain, F.array().cast("array<struct<kind:string,start:int,end:int>>"),
        lambda kept, c: F.when(F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(c))),
    )
    return out.withColumn(spans, F.concat(base, apart)).drop(whole)


def _unused(documents: DataFrame, name: str) -> str:
    """``name``, made longer until no column is called that, upper or lower case."""
    taken = {c.lower() for c in documents.columns}
    while name in taken:
        name += "_"
    return name


def redact(documents: DataFrame, model: Boosted, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one.

    NULL stays NULL, texts without spans stay as they are.  A column
    ``n_chars``, if there is one, has the new length of the texts changed;
    all other columns, whatever their names, stay as they are.
    """
    base, spans = _unused(documents, "__base"), _unused(documents, "__spans")
    found = find_private(documents, model, text, base, spans)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    parts = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["parts"])
            .otherwise(F.concat(a["parts"], F.array(F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))))
            .alias("parts"),
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(F.col(text), a["at"] + 1, F.length(F.col(text)))),
    )
    out = found.withColumn(text, F.when(F.size(spans) > 0, parts).otherwise(F.col(text)))
    if n_chars in documents.columns:
        size = F.length(text).cast(documents.schema[n_chars].dataType)
        out = out.withColumn(n_chars, F.when(F.size(spans) > 0, size).otherwise(F.col(n_chars)))
    return out.select(*documents.columns)


def report_private(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, per document."""
    found = find_private(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), fit_boosted(documents, doc_id, text))
    counts = [F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in FORMATS]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
