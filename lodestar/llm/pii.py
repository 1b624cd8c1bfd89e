"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans come from fixed patterns and their checks (``BASE``). Beside them, high-recall generators (``GENERATORS``)
propose further spans, which may overlap the base ones and each other: long mixed tokens, numbers in groups, values after a
word for a credential. Each candidate is described by a few small features of its format and its context. Boosted trees are
fitted to the contingency table of all candidates of the corpus (features by weak label: the candidate stands after a credential
word, has a published key prefix, or covers a base span); the table has at most the product of the features' sizes, whatever
the corpus. One candidate in ``HOLD_OUT``, by hash of its value, is kept from the trees: the threshold is the lowest score at or above which the weak
labels of those reach ``PRECISION``. Spans that the model adds never remove a base span. The patterns run once: their spans are written beside the rows, the model is fitted to that
table and selects from it.

The patterns are written without backtracking (possessive), so that long runs of digits or letters take linear time and no
recursion; each finds what the plain pattern finds.

Defined results: a null text is the empty one and has no spans. Without candidates of both labels the model selects none. Ids
may be null or repeat; other columns are kept by ``redact``.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common

#: kind, pattern; in the order in which kinds are listed. The plain forms are in the comments.
BASE = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    ("card", r"[0-9](?:[\x20-]?[0-9]){11,}+"),  # [0-9]([\x20-]?[0-9])+ of 12 digits at least
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CREDENTIAL = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
KEY_PREFIXES = "AKIA|ASIA|ghp_|gho_|sk-|xox[bap]-"
#: kind, guard (texts without it have none), pattern.
GENERATORS = (
    ("secret", r"[A-Za-z0-9+/_-]{12}", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|(?:" + KEY_PREFIXES + r"))[A-Za-z0-9+/_-]{12,}+={0,2}+"),
    ("number", r"[0-9](?:[^0-9]{0,2}[0-9]){6}", r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+"),
    ("credential", CREDENTIAL + r"[\"']?[\x20]{0,2}[:=]", r"(?i)(?<=(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[\x20]{0,2}[:=][\x20]{0,2}[\"']?)(?<=[\"':=\x20])[^\s\"',;:=]{6,}+"),
)
KEY_PREFIX = f"^(?:{KEY_PREFIXES})"
SIZES = {"generator": 3, "length": 6, "digits": 4, "cases": 3, "hexadecimal": 2, "assigned": 2, "named": 2, "groups": 3, "luhn": 2}
#: PRIOR is the weight of one unlabelled case at every feature vector, so that formats never seen are not selected.
ROUNDS, RATE, PRECISION, PRIOR, HOLD_OUT = 24, 0.5, 0.95, 0.02, 5

SPAN = "array<struct<kind:string,start:int,end:int,value:string,before:string>>"


def matches(text: Column, pattern: str, guard: Column | None) -> tuple[Column, Column]:
    """(values, pieces around them) of the leftmost non-overlapping matches."""
    none = F.array().cast("array<string>")
    values, pieces = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.split(text, pattern, -1)
    return (values, pieces) if guard is None else (F.when(guard, values).otherwise(none), F.when(guard, pieces).otherwise(none))


def placed(kind: str, values: Column, pieces: Column) -> Column:
    """Spans from matches: starts are running sums of the pieces' and values' lengths."""
    lengths = F.zip_with(values, F.slice(pieces, F.lit(1), F.size(values)), lambda v, p: F.struct(F.length(p).alias("gap"), F.length(v).alias("size")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(lengths, empty, lambda a, x: F.struct((a["at"] + x["gap"] + x["size"]).alias("at"), F.concat(a["starts"], F.array(a["at"] + x["gap"])).alias("starts")))["starts"]
    found = F.zip_with(F.zip_with(starts, values, lambda s, v: F.struct(s.alias("s"), v.alias("v"))), F.slice(pieces, F.lit(1), F.size(values)), lambda a, p: F.struct(F.lit(kind).alias("kind"), a["s"].alias("start"), (a["s"] + F.length(a["v"])).alias("end"), a["v"].alias("value"), F.right(p, F.lit(24)).alias("before")))
    return found.cast(SPAN)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits_of(value)).between(12, 19), luhn(digits_of(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def passing(kind: str):
    return lambda x: valid(kind, x["value"])


def of_kind(kind: str):
    return lambda x: x["kind"] == kind


def with_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with ``_base`` and ``_more`` (candidates), arrays of spans in code points, end exclusive."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = df.withColumn("_text", text)
    rules = [(k, p, {"email": F.contains("_text", F.lit("@")), "phone": F.contains("_text", F.lit("+"))}.get(k)) for k, p in BASE]
    rules += [(k, p, F.col("_text").rlike(g)) for k, g, p in GENERATORS]
    columns = {}
    for kind, pattern, guard in rules:
        columns[f"_v_{kind}"], columns[f"_p_{kind}"] = matches(F.col("_text"), pattern, guard)
    df = df.withColumns(columns)
    spans = {k: F.when(F.size(f"_v_{k}") > 0, placed(k, F.col(f"_v_{k}"), F.col(f"_p_{k}"))).otherwise(F.array().cast(SPAN)) for k, _, _ in rules}
    df = df.withColumn("_base", F.concat(*[F.filter(spans[k], passing(k)) for k, _ in BASE]))
    df = df.withColumn("_more", F.concat(*[spans[k] for k, _, _ in GENERATORS]))
    return df.drop(*columns, "_text")


def features(x: Column) -> dict[str, Column]:
    """The small numbers that describe a candidate."""
    value, n = x["value"], F.length(x["value"])
    share = F.length(digits_of(value)) / n
    case = F.when(value.rlike("[A-Z]") & value.rlike("[a-z]"), 2).when(value.rlike("[A-Za-z]"), 1).otherwise(0)
    groups = F.least(F.lit(2), F.length(F.regexp_replace(value, "[^().\\x20/_+-]", "")))
    number = F.when(F.length(digits_of(value)).between(12, 19) & (x["kind"] == "number"), luhn(digits_of(value))).otherwise(False)
    return {
        "generator": F.when(x["kind"] == "secret", 0).when(x["kind"] == "number", 1).otherwise(2),
        "length": F.when(n < 12, 0).when(n < 16, 1).when(n < 20, 2).when(n < 32, 3).when(n < 48, 4).otherwise(5),
        "digits": F.when(share < 0.05, 0).when(share < 0.3, 1).when(share < 0.9, 2).otherwise(3),
        "cases": case,
        "hexadecimal": value.rlike("^[0-9a-f]+$").cast("int"),
        "assigned": x["before"].rlike("[:=][\\x20]?[\"']?$").cast("int"),
        "named": x["before"].rlike(CREDENTIAL).cast("int"),
        "groups": groups,
        "luhn": number.cast("int"),
    }


def weak_label(x: Column, base: Column) -> Column:
    over = F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    return (x["before"].rlike(CREDENTIAL + "[\"']?[\\x20]{0,2}[:=][\\x20]{0,2}[\"']?$") | x["value"].rlike(KEY_PREFIX) | over).cast("int")


class Boosted:
    """Boosted trees of depth two on small whole-number features, by weighted least squares on the logistic gradient."""

    def __init__(self, names: list[str]):
        self.names, self.trees, self.bias, self.threshold, self.precision, self.recall = names, [], 0.0, math.inf, math.nan, 0.0

    def fit(self, rows: list[tuple[tuple[int, ...], int, int]]) -> Boosted:
        """rows: (features, number of candidates, of them with label 1)."""
        total, good = sum(n for _, n, _ in rows), sum(y for _, _, y in rows)
        if not 0 < good < total:
            return self
        have = {x: (n, y) for x, n, y in rows}
        rows = [(x, n + PRIOR, y) for x in itertools.product(*(range(SIZES[k]) for k in self.names)) for n, y in [have.get(x, (0, 0))]]
        self.bias = math.log(good / (total - good))
        score = [self.bias] * len(rows)
        for _ in range(ROUNDS):
            p = [1 / (1 + math.exp(-s)) for s in score]
            stats = [(y - n * q, n * q * (1 - q)) for (_, n, y), q in zip(rows, p)]
            tree = self.grow(rows, stats, list(range(len(rows))), 2)
            self.trees.append(tree)
            score = [s + RATE * self.leaf(tree, x) for s, (x, _, _) in zip(score, rows)]
        return self

    def score(self, x: tuple[int, ...]) -> float:
        return self.bias + RATE * sum(self.leaf(t, x) for t in self.trees)

    def calibrate(self, rows: list[tuple[tuple[int, ...], int, int]]) -> Boosted:
        """Sets the lowest threshold at which those at or above it, among candidates the trees have not seen, reach PRECISION; none is selected if nothing does.

        precision and recall are those of the weak labels there.
        """
        seen = taken = 0
        good = sum(y for _, _, y in rows)
        self.threshold, self.precision, self.recall = math.inf, math.nan, 0.0
        ranked = sorted(((self.score(x), n, y) for x, n, y in rows), key=lambda r: -r[0]) if self.trees else []
        for k, (s, n, y) in enumerate(ranked):
            seen, taken = seen + n, taken + y
            if (k + 1 == len(ranked) or ranked[k + 1][0] < s - 1e-9) and taken and taken >= PRECISION * seen:
                self.threshold, self.precision, self.recall = s - 1e-9, taken / seen, taken / good
        return self

    def grow(self, rows, stats, at: list[int], depth: int):
        g, h = sum(stats[i][0] for i in at), sum(stats[i][1] for i in at)
        leaf = max(-4.0, min(4.0, g / (h + 1.0)))
        if not depth:
            return leaf
        best, choice = g * g / (h + 1.0) + 1e-9, None
        for f in range(len(self.names)):
            sums: dict[int, list[float]] = {}
            for i in at:
                cell = sums.setdefault(rows[i][0][f], [0.0, 0.0])
                cell[0] += stats[i][0]
                cell[1] += stats[i][1]
            a = b = 0.0
            for value in sorted(sums)[:-1]:
                a, b = a + sums[value][0], b + sums[value][1]
                gain = a * a / (b + 1.0) + (g - a) ** 2 / (h - b + 1.0)
                if gain > best:
                    best, choice = gain, (f, value)
        if not choice:
            return leaf
        f, value = choice
        return f, value, self.grow(rows, stats, [i for i in at if rows[i][0][f] <= value], depth - 1), self.grow(rows, stats, [i for i in at if rows[i][0][f] > value], depth - 1)

    def leaf(self, tree, x: tuple[int, ...]) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    def selected(self) -> list[tuple[int, ...]]:
        """Not for the hot path: every feature vector that the model selects."""
        return [x for x in itertools.product(*(range(SIZES[n]) for n in self.names)) if self.score(x) >= self.threshold]

    def column(self, x: dict[str, Column]) -> Column:
        """Whether a candidate with these features is selected."""

        def part(tree) -> Column:
            return F.when(x[self.names[tree[0]]] <= tree[1], part(tree[2])).otherwise(part(tree[3])) if isinstance(tree, tuple) else F.lit(float(tree))

        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + F.lit(RATE) * part(tree)
        return total >= self.threshold if self.trees and self.threshold < math.inf else F.lit(False)


def fit(df: DataFrame) -> Boosted:
    """The model of a corpus; df has ``_base`` and ``_more``. Trees are grown on four fifths of the candidates by hash of the value, the threshold is set on the others."""
    names = list(SIZES)
    rows = df.where(F.size("_more") > 0).select("_base", F.explode("_more").alias("x"))
    held = (F.pmod(F.xxhash64("x.value"), F.lit(HOLD_OUT)) == 0).alias("held")
    table = rows.select(*[c.alias(n) for n, c in features(F.col("x")).items()], weak_label(F.col("x"), F.col("_base")).alias("label"), held)
    counts = table.groupBy(*names, "held").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()
    cases = lambda held: [(tuple(r[n] for n in names), r.n, r.y) for r in counts if r.held == held]
    return Boosted(names).fit(cases(False)).calibrate(cases(True))


def rank(x: Column) -> Column:
    kinds = [*(k for k, _ in BASE), *(k for k, _, _ in GENERATORS)]
    return F.array_position(F.array(*map(F.lit, kinds)), x["kind"]).cast("int")


def by_start(spans: Column) -> Column:
    """Distinct spans by start, then kind as listed."""
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), rank(x).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_sort(F.array_distinct(keyed))


def _found(df: DataFrame) -> DataFrame:
    """df with base_spans and spans in place of its ``_base`` and ``_more``, by the model that fits them. df is written once, so that the patterns run once."""
    df = common.written(df, "candidates")
    model = fit(df)
    described = F.transform("_more", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), *[c.alias(f"f_{n}") for n, c in features(x).items()]))
    out = df.withColumn("_more", F.when(F.size("_more") > 0, F.filter(described, lambda x: model.column({n: x[f"f_{n}"] for n in SIZES}))))

    def bare(x: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))

    plain = F.transform("_base", bare)
    chosen = F.when(F.col("_more").isNotNull(), F.transform("_more", bare)).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    return out.withColumn("base_spans", by_start(plain)).withColumn("spans", by_start(F.concat(plain, chosen))).drop("_base", "_more")


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with base_spans and spans, each an array of structs (start, rank, end, kind) by start, then kind as listed; only columns of these very names are replaced."""
    aside = with_spans(common.set_aside(df, text_col), text_col).drop(text_col)
    return common.put_back(_found(aside), [c for c in df.columns if c not in ("base_spans", "spans")], "base_spans", "spans")


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with each span of its texts replaced by its kind in brackets; of overlapping spans the first names the gap, which covers them all. All other columns stay."""
    out = _found(with_spans(common.set_aside(df, text_col), text_col).drop(text_col))
    given = F.col("_row").getField(text_col)
    text = given.cast("string")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def add(a: Column, x: Column) -> Column:
        fresh = x["start"] >= a["at"]
        piece = F.concat(F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(fresh, F.concat(a["done"], piece)).otherwise(a["done"]).alias("done"))

    new = F.aggregate("spans", begin, add, lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.length(text))))
    out = out.withColumn("_text", F.when(F.size("spans") > 0, new).otherwise(text))
    return out.select(*[F.col("_text" if c == text_col else "_row." + f"`{c}`").alias(c) for c in df.columns])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = _found(with_spans(docs).drop("text"))
    counts = [F.size(F.filter("base_spans", of_kind(k))).cast("long").alias(f"n_{k}") for k, _ in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
