"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words that keeps some positions and ignores the others. The hashes of the kept
words are taken at every position of every document and every benchmark item and joined; each hit names a diagonal
(document position less item position), on which the words are then compared one by one. An item leaks
into a document if on such a diagonal some window of min(``WINDOW``, length of the item) of its words agrees in at least
``SIMILAR`` of the positions; that is, words may be substituted, the ignored ones of the seed among them.

Words are cut at the six ASCII blanks, lower-cased and bared of what is no letter or digit; bare marks are no words.

The seeds of the benchmark go to every task in blocks of at most ``BLOCK_WORDS`` words, so that what is sent has a
bound; a larger benchmark takes more passes over the documents, each written. Nothing is dropped.

Items of ten words or fewer have seeds of their own length that together leave out every set of words which may differ, so that none is missed: below five words the
whole item must be there, of five to nine words one may differ, of ten two. Of longer ones at least 0.95 of all patterns of substitutions that count as a leak are found (``tests/llm`` takes the share by length).

Defined results: a null text is the empty one; items without a word leak nowhere; an item without id is named null, first in the list; repeated items are found under each of their ids; rows without doc_id are judged like any other.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common

MASKS = ("111111", "11101011", "110110101", "1010110011")
WINDOW, SIMILAR, BLOCK_WORDS, CACHE = 20, 0.8, 2_000_000, 250_000
FOLDS = 1 << 22


class Words:
    """64-bit hashes of normalised words; 0 is no word."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def ids(self, text: str) -> np.ndarray:
        import xxhash

        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            out = [known[w] for w in words]
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for w in set(words):
                if w not in known:
                    bare = w if w.isalnum() else "".join(filter(str.isalnum, w.decode("utf-8", "replace").lower())).encode()
                    known[w] = xxhash.xxh64_intdigest(bare, 7) | 1 if bare else 0
            out = [known[w] for w in words]
        ids = np.array(out, np.uint64)
        return ids[ids != 0] if len(ids) and not ids.all() else ids


def seed_hashes(ids: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of the kept words at each position where the whole mask fits."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, salt * 0x9E3779B97F4A7C15 & (2**64 - 1), np.uint64)
    for k in (k for k, c in enumerate(mask) if c == "1"):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += ids[k : k + n]
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def masks_for(length: int, masks=MASKS) -> tuple[str, ...]:
    """The seeds of items with so many words. Those too short for the general ones to be found whatever is substituted have masks of their own length that leave
    out every set of words that ``SIMILAR`` lets differ: none below five words, one below ten, two at ten."""
    if length >= 11:
        return masks
    if length < 5:
        return ("1" * length,)
    step = 1 if length < 7 else 2
    groups = [range(k, min(k + step, length)) for k in range(0, length, step)]
    out = [set(g) for g in groups] if length < 10 else [{*a, *b} for k, a in enumerate(groups) for b in groups[k + 1 :]]
    return tuple("".join("0" if k in gone else "1" for k in range(length)) for gone in out)


class Seeds:
    """The seeds of some benchmark items, to be looked up."""

    def __init__(self, items: list[tuple[int, np.ndarray]], masks=MASKS):
        self.items = items
        of = {n: masks_for(n, masks) for n in {len(ids) for _, ids in items}}
        self.masks = sorted({m for some in of.values() for m in some}, key=lambda m: (len(m), m))
        salt = {m: k for k, m in enumerate(self.masks)}
        rows = []
        for k, (_, ids) in enumerate(items):
            for mask in of[len(ids)]:
                h = seed_hashes(ids, mask, salt[mask])
                rows.append(np.stack([h, np.full(len(h), k, np.uint64), np.arange(len(h), dtype=np.uint64)], 1))
        rows = np.concatenate(rows) if rows else np.empty((0, 3), np.uint64)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        self.hash, self.item, self.at = rows[:, 0].copy(), rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64)
        self.seen = np.zeros(FOLDS, bool)
        self.seen[self.hash >> np.uint64(42)] = True

    def hits(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Distinct (item, diagonal) of the seeds that ids and an item share."""
        found = [np.empty((0, 2), np.int64)]
        for m, mask in enumerate(self.masks):
            h = seed_hashes(ids, mask, m)
            at = np.nonzero(self.seen[h >> np.uint64(42)])[0]
            if not len(at):
                continue
            low, high = np.searchsorted(self.hash, h[at]), np.searchsorted(self.hash, h[at], "right")
            n = high - low
            spot = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            if len(spot):
                found.append(np.unique(np.stack([self.item[spot], np.repeat(at, n) - self.at[spot]], 1), axis=0))
        return list(map(tuple, np.unique(np.concatenate(found), axis=0).tolist())) if len(found) > 1 else []

    def leaks(self, ids: np.ndarray, window: int = WINDOW, similar: float = SIMILAR) -> dict[int, int]:
        """item_id -> most agreeing words in a window, of the items that leak into ids."""
        found: dict[int, int] = {}
        for k, diagonal in self.hits(ids):
            name, item = self.items[k]
            best = agreeing(ids, item, diagonal, window)
            if best >= similar * min(window, len(item)):
                found[name] = max(best, found.get(name, 0))
        return found


def agreeing(ids: np.ndarray, item: np.ndarray, diagonal: int, window: int) -> int:
    """The most positions of one window of the item that agree with ids along a diagonal."""
    size = min(window, len(item))
    same = np.zeros(len(item) + 1, np.int64)
    a, b = max(0, -diagonal), min(len(item), len(ids) - diagonal)
    same[1:][a:b] = item[a:b] == ids[a + diagonal : b + diagonal]
    total = np.cumsum(same)
    return int((total[size:] - total[:-size]).max())


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similar: float = SIMILAR, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with leaked_items (array<struct<item_id, agreeing>>, sorted by item_id; empty if clean), its other columns unchanged."""
    others = [c for c in docs.columns if c != "leaked_items"]
    return common.put_back(_leaks(docs, benchmark, window, similar, block_words), others, "leaked_items")


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similar: float = SIMILAR, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_row, text, leaked_items). With several blocks of the benchmark each pass is written, so that a worker holds the seeds of one block."""
    spark = docs.sparkSession
    common.small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"))).alias("n")).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    out = common.set_aside(docs, "text").withColumn("text", F.col("text").cast("string"))
    for k in range(blocks):
        part = [(r.item_id, Words().ids(r.text)) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
        sent = spark.sparkContext.broadcast([(i, ids) for i, ids in part if len(ids)])

        def leaks(texts, sent=sent, version=uuid.uuid4().hex):
            import pandas as pd

            seeds = common.worker_cache("decontaminate", "seeds", lambda: Seeds(sent.value), version)
            ids = common.worker_cache("decontaminate", "words", Words)
            return pd.Series([[{"item_id": i, "agreeing": n} for i, n in sorted(seeds.leaks(ids.ids(t or ""), window, similar).items(), key=lambda x: (x[0] is not None, x))] for t in texts])

        found = F.pandas_udf(leaks, "array<struct<item_id:bigint,agreeing:bigint>>")("text")
        out = out.withColumn("leaked_items", found if not k else F.concat("leaked_items", found))
        if blocks > 1:
            out = common.written(out, "leaks")
    return out if blocks == 1 else out.withColumn("leaked_items", F.array_sort("leaked_items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs into which no item leaks, with all columns of docs as they were, whatever their names."""
    return common.put_back(_leaks(docs, benchmark).where(F.size("leaked_items") == 0), docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaked_items") > 0).alias("contaminated"), F.col("leaked_items.item_id").alias("item_ids"), F.coalesce(F.array_max("leaked_items.agreeing"), F.lit(0).cast("long")).alias("agreeing"))
