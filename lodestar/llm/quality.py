"""Quality rules, in DataFrame functions only: counts over each whole text, and a log-likelihood ratio.

Word unigrams and bigrams are hashed into ``BUCKETS`` buckets. One multinomial is counted over every document
(the raw corpus), another over documents labelled as good (the trusted target; at most ``TRUSTED`` of them, those whose
ids hash lowest). A document's score is the mean over its n-grams of ln p_target - ln p_raw; documents below
``THRESHOLD`` are rejected: 0 would be the raw corpus's own likelihood, the margin below it spares short texts.

Defined results: a null text has no words and fails the base rules; a text without words scores 0; without trusted documents every score is
0, so that the base rules decide alone. Ids may be null or repeat; other columns are kept.
Windows of three words are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common

BUCKETS, TRUSTED, SMOOTH, THRESHOLD = 1 << 15, 20_000, 60.0, -0.06
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BLANKS = "[ \\t\\n\\x0B\\f\\r]"


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but the six ASCII blanks."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(common.SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS + "+"))


def upto(first: int, last: Column) -> Column:
    """first..last, empty if last is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def bucket(*parts: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def base_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with ``_words`` and the rule counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(common.SPACES)) != "")
    df = df.withColumns({"_words": words_of(F.col(text_col).cast("string")), "_lines": lines})
    w, n = F.col("_words"), F.size("_words")
    windows = F.transform(upto(0, n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(text, common.SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": windows,
        }
    )
    h = F.col("_windows")
    ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn("_sorted", F.when(some, ordered).otherwise(F.slice(ordered_empty(), 1, 0)))
    s = F.col("_sorted")
    twins = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull())))))
    p = F.col("_at")
    gaps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return df.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x).cast("long")).drop("_lines", "_windows", "_sorted", "_at")


def ordered_empty() -> Column:
    return F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("i")))


def ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED) -> list[float]:
    """ln p_target - ln p_raw of each bucket; zeros if no labelled document is there. The result's length is ``buckets``, whatever the corpus."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_good")).distinct().orderBy(F.xxhash64("_good"), "_good").limit(trusted)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), words_of(F.col("text").cast("string")).alias("_words"))
    rows = rows.join(F.broadcast(good), F.col("_id") == F.col("_good"), "left")
    w, n = F.col("_words"), F.size("_words")
    grams = F.concat(F.transform(w, lambda x: bucket(x, buckets=buckets)), F.transform(upto(0, n - 2), lambda i: bucket(F.get(w, i), F.get(w, i + 1), buckets=buckets)))
    counts = rows.select(F.col("_good").isNotNull().cast("long").alias("target"), F.explode(grams).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for b, r, t in counts:
        raw[b], target[b] = r, t
    n, m = sum(raw), sum(target)
    if not m:
        return [0.0] * buckets
    # both multinomials over as many n-grams as the target has, with the same additive smoothing: little evidence leaves a ratio near 1
    return [math.log(t + SMOOTH) - math.log(m * r / n + SMOOTH) for r, t in zip(raw, target)]


def scored(df: DataFrame, table: list[float]) -> DataFrame:
    """df (with ``_words``) and the mean ratio of its n-grams as llr."""
    fixed = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")  # folded into one constant
    w, n, size = F.col("_words"), F.size("_words"), len(table)
    one = F.aggregate(w, F.lit(0.0), lambda acc, x: acc + F.get(fixed, bucket(x, buckets=size)))
    two = F.aggregate(upto(0, n - 2), F.lit(0.0), lambda acc, i: acc + F.get(fixed, bucket(F.get(w, i), F.get(w, i + 1), buckets=size)))
    return df.withColumn("llr", F.when(n > 0, (one + two) / (2 * n - 1)).otherwise(F.lit(0.0)))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept")


def _judged(docs: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(_row, text, then RESULTS): docs set aside as ``_row``."""
    df = scored(base_counts(common.set_aside(docs, "text")), ratios(docs, labels)).drop("_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed and kept; only columns of docs with these very names are replaced."""
    return common.put_back(_judged(docs, labels, threshold), [c for c in docs.columns if c not in RESULTS], *RESULTS)


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are kept, with all columns of docs as they were, whatever their names.

    The row number makes the verdict's projection one that the optimizer does not push the filter through: pushed, each count would
    be inlined into the condition, and computed again for each element.
    """
    judged = _judged(docs, labels, threshold).withColumn("_at", F.monotonically_increasing_id())
    return common.put_back(judged.where(F.col("kept") & (F.col("_at") >= 0)), docs.columns)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, common.table(spark, sf_dir, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
