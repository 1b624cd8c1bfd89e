"""BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

Each leaf holds ``rank << 40 | position`` of the pair that starts there, or NONE; an inner node holds the
minimum of its children, so that the root is the leftmost pair of lowest rank. A merge rewrites three leaves
and their paths. Words of up to ``WIDE`` symbols are merged many at a time in numpy, one tree a row;
longer ones one by one.

Defined results: a null text is the empty one and has no tokens; repeated rows give repeated results; the
strings of the special tokens become their ids, as the tokenizers library does; other columns are kept by
``encode``, and are never looked at.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common

TOKENIZER = "word_bpe_49k.json"
NONE, PLACE = np.int64(1) << 62, (1 << 40) - 1
WIDE = 64
#: Words and characters of words kept in a worker's memory; beyond either the cache starts anew. Texts are cut into words in slices of about SLICE characters.
CACHE, CACHE_CHARS, SLICE = 125_000, 4 << 20, 1 << 20


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class SegmentTreeBPE:
    """The model and normaliser of a tokenizer file whose words are cut by a pattern and end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int64)
        self.new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pair = {int(k): int(r) for k, r in zip(self.key[::-1], self.rank[::-1])}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}
        self.held = 0

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens: NFC, lower case by the character, then the pattern."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge (or b is past the end: -1)."""
        want = a << 32 | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (b >= 0), self.rank[at], NONE)

    def merge_wide(self, rows: list[bytes], width: int) -> list[list[int]]:
        n = len(rows)
        size = np.array([len(r) for r in rows])
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(n, width)
        ids = np.full((n, width + 1), -1, np.int64)
        column = np.arange(width)
        ids[:, :width] = np.where(column < size[:, None] - 1, self.inner[flat], np.where(column == size[:, None] - 1, self.last[flat], -1))
        after = np.tile(np.arange(1, width + 2), (n, 1))
        after[:, :width][column >= size[:, None] - 1] = width
        before = np.tile(np.arange(-1, width), (n, 1))

        def leaf(r, p, q):
            rank = self.ranks(ids[r, p], ids[r, q])
            return np.where(rank == NONE, NONE, rank << 40 | p)

        tree = [np.full((n, width), NONE)]
        for p in range(width - 1):
            r = np.nonzero(size > p + 1)[0]
            tree[0][r, p] = leaf(r, p, np.full(len(r), p + 1))
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, ::2], tree[-1][:, 1::2]))
        r = np.arange(n)
        while len(r := r[tree[-1][r, 0] < NONE]):
            root = tree[-1][r, 0]
            p, rank = root & PLACE, root >> 40
            q = after[r, p]
            far = after[r, q]
            ids[r, p], ids[r, q] = self.new[rank], -2
            after[r, p] = far
            before[r, far] = p
            tree[0][r, q] = NONE
            tree[0][r, p] = np.where(far < width, leaf(r, p, far), NONE)
            left = before[r, p]
            has = left >= 0
            tree[0][r[has], left[has]] = leaf(r[has], left[has], p[has])
            spots = [(r, q), (r, p), (r[has], left[has])]
            for low, high in zip(tree, tree[1:]):
                spots = [(x, i >> 1) for x, i in spots]
                for x, i in spots:
                    high[x, i] = np.minimum(low[x, 2 * i], low[x, 2 * i + 1])
        live = ids[:, :width] >= 0
        out, ends = ids[:, :width][live].tolist(), np.cumsum(live.sum(1)).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, row: bytes) -> list[int]:
        n = len(row)
        width = 1 << (n - 1).bit_length()
        ids = array("q", self.inner[np.frombuffer(row, np.uint8)].tobytes())
        ids[-1] = int(self.last[row[-1]])
        after, before, none = array("q", range(1, n + 1)), array("q", range(-1, n)), int(NONE)
        tree = array("q", [none]) * (2 * width)

        def put(p: int, q: int) -> None:
            rank = self.pair.get(ids[p] << 32 | ids[q]) if q < n else None
            tree[width + p] = none if rank is None else rank << 40 | p

        def lift(p: int) -> None:
            i = (width + p) >> 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                tree[i] = a if a < b else b
                i >>= 1

        for p in range(n - 1):
            put(p, p + 1)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] < none:
            p, rank = tree[1] & PLACE, tree[1] >> 40
            q = after[p]
            ids[p], ids[q] = int(self.new[rank]), -2
            after[p] = after[q]
            if after[p] < n:
                before[after[p]] = p
            tree[width + q] = none
            put(p, after[p])
            lift(q)
            lift(p)
            if before[p] >= 0:
                put(before[p], p)
                lift(before[p])
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, given as its bytes, none of them empty."""
        out: list[list[int]] = [[]] * len(words)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > WIDE:
                out[i] = self.merge_long(w)
            else:
                groups.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            for k in range(0, len(members), 8192):
                part = members[k : k + 8192]
                for i, ids in zip(part, self.merge_wide([words[i] for i in part], width)):
                    out[i] = ids
        return out

    def learn(self, words: set[str]) -> None:
        """The ids and the decoded text of words that the cache lacks."""
        new = [w for w in words if w not in self.ids]
        for w, ids in zip(new, self.merge([w.encode("utf-8", "surrogatepass") for w in new])):
            self.held += len(w)
            self.ids[w] = " ".join(map(str, ids))
            self.text[w] = " ".join([self.names[i] for i in ids])

    def encode_batch(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by a space, decoded text) of each text."""
        return list(self.encode_each(texts))

    def encode_each(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """As encode_batch, one by one: only the words of one slice of texts are in memory."""
        first = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SLICE or k + 1 == len(texts):
                yield from self.encode_slice(texts[first : k + 1])
                first, size = k + 1, 0

    def encode_slice(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        parts = []
        for text in texts:
            pieces = self.specials.split(text) if "<|" in text else [text]
            parts.append([x for k, piece in enumerate(pieces) for x in ([piece] if k % 2 else self.split(piece))])
        if len(self.ids) > CACHE or self.held > CACHE_CHARS:
            self.ids, self.text, self.held = {}, {}, 0
        seen: set[str] = set()
        for words in parts:
            seen.update(words)
        self.learn({w for w in seen if w not in self.special})
        for name, i in self.special.items():
            self.ids[name], self.text[name] = str(i), name
        for words in parts:
            yield " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.text.__getitem__, words))


def model(path: str) -> SegmentTreeBPE:
    return common.worker_cache("bpe", path, lambda: SegmentTreeBPE(path))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """df with the token ids of text_col in ids_col (array<int>), its other columns unchanged; a column of that name is replaced."""
    common.small_batches(df.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(texts):
        import pandas as pd

        return pd.Series([np.fromstring(a, np.int32, sep=" ") if a else np.empty(0, np.int32) for a, _ in model(path).encode_batch(texts.fillna("").tolist())])

    return df.withColumn(ids_col, ids(F.col(text_col).cast("string")))


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """df with the text that the ids stand for: their tokens joined by a space. A null list gives a null."""
    common.small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def text(rows):
        names = model(path).names
        return rows.map(lambda ids: None if ids is None else " ".join([names[i] for i in ids]))

    return df.withColumn(text_col, text(F.col(ids_col)))


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of documents, both ways in one pass over the texts: the digests of the ids and of the decoded text."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            found = [(a.count(" ") + 1 if a else 0, sha(a), sha(t)) for a, t in model(path).encode_each(b.column(1).to_pylist())]
            yield common.batch(schema, b.column(0), *([x[k] for x in found] for k in range(3)))

    return common.map_arrow(common.documents(df), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", tidy=True)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(common.table(spark, sf_dir, "documents"), tokenizer_path())
