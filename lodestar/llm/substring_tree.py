"""Substring dedup over words by prefix-partitioned suffix trees.

All suffixes of a shard (some 3 MB of documents that mostly have something in common) are split by prefixes of growing length until a part is small; each part
gets its subtree, grown level by level: a node's suffixes are parted by their next word, single suffixes end in
a leaf, and a chain without a branch is one edge. A node that is left with several suffixes at depth ``WINDOW`` or
more is a repeat: of its windows all but the first go. Shards are merged by the anchors of their first windows rather than by the windows' own first words, which ships
some four words a window instead of twenty; a merging task grows the same subtrees over what several shards share.

Words are told apart by 64-bit hashes. See ``repeats`` for shards, order and the defined results for nulls and repeated rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import common, repeats

WINDOW, GRAM, PART = 20, 4, 1 << 16
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0..n-1, at least."""
    size = 1 << max(21, (n - 1).bit_length())

    def build():
        one = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
        for x in one:
            x[0] = 1
        return tuple(np.cumprod(x) for x in one)

    return common.worker_cache("substring", "powers", build, str(size))


def hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word between ASCII blanks: a polynomial modulo 2**64, mixed."""
    if not raw:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    byte = np.frombuffer(raw, np.uint8)
    word = np.zeros(len(byte) + 2, np.int8)
    word[1:-1] = (byte != 32) & ((byte < 9) | (byte > 13))
    edge = np.diff(word)
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    up, down = powers(len(byte))
    total = np.zeros(len(byte) + 1, np.uint64)
    np.cumsum((byte.astype(np.uint64) + np.uint64(1)) * up[: len(byte)], out=total[1:])
    return repeats.mixing((total[end] - total[start]) * down[start]), start


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of texts, one after the other, and how many each has."""
    h, start = hashed(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


def content(text: bytes):
    words = text.split()
    return lambda a, z: b" ".join(words[a:z])


def read(contents: list[bytes]) -> list[np.ndarray]:
    h, sizes = word_hashes(contents)
    return np.split(h, np.cumsum(sizes)[:-1])


def prefix_parts(words: np.ndarray, at: np.ndarray, limit: int = PART):
    """(suffixes, length of the prefix they share) of the parts; each prefix is as long as its part needs."""
    todo = [(at, 0)]
    while todo:
        part, depth = todo.pop()
        if len(part) <= limit or depth >= WINDOW:
            yield part, depth
            continue
        order = np.argsort(words[part + depth], kind="stable")
        part = part[order]
        cuts = np.nonzero(np.diff(words[part + depth]))[0] + 1
        small: list[np.ndarray] = []
        for piece in np.split(part, cuts):
            if len(piece) > limit:
                todo.append((piece, depth + 1))
            elif len(piece) > 1:
                small.append(piece)
        if small:  # several short prefixes together are one part
            yield np.concatenate(small), depth


def subtree(words: np.ndarray, part: np.ndarray, depth: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, node) under the internal nodes of a part's subtree that lie at ``window`` words or deeper."""
    node = np.zeros(len(part), np.int64)
    while depth < window and len(part):
        word = words[part + depth]
        order = np.lexsort((word, node))
        part, node, word = part[order], node[order], word[order]
        new = np.ones(len(part), bool)
        new[1:] = (node[1:] != node[:-1]) | (word[1:] != word[:-1])
        node = np.cumsum(new)
        alone = new & np.append(new[1:], True)  # leaves
        part, node = part[~alone], node[~alone]
        depth += 1
    return part, node


def shard_windows(words: np.ndarray, at: np.ndarray, ords: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of the windows at some positions of a shard's words start earlier in it: those under a deep node of a subtree that are not its first."""
    index = np.full(len(words), -1, np.int64)
    index[at] = np.arange(len(at))
    out = np.zeros(len(at), bool)
    for part, depth in prefix_parts(words, at):
        suffixes, node = subtree(words, part, depth, window)
        mine = index[suffixes]
        out[mine] = repeats.not_first(node, ords[mine], starts[mine])
    return out


def merged(a: set, b: set) -> set:
    return a | b


def earlier_windows(contents, sizes, ords, starts, carried, seen, open_, window: int = WINDOW):
    """(which windows of the contents start earlier: here, or among the windows seen if carried; windows of the open contents)."""
    words = np.concatenate(contents)
    lengths = sizes + window - 1
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = begin[owner] + offset
    index = np.full(len(words), -1, np.int64)
    index[at] = np.arange(len(at))
    out = np.zeros(len(at), bool)
    for part, depth in prefix_parts(words, at):
        suffixes, node = subtree(words, part, depth, window)
        mine = index[suffixes]
        out[mine] = repeats.not_first(node, ords[owner[mine]], starts[owner[mine]] + offset[mine])
    rows = np.lib.stride_tricks.sliding_window_view(words, window)
    if seen is not None:
        for k in np.nonzero(carried[owner])[0].tolist():
            out[k] |= rows[at[k]].tobytes() in seen
    return out, {rows[i].tobytes() for i in at[open_[owner]].tolist()}


WORDS = repeats.Windows(WINDOW, GRAM, word_hashes, content, read, shard_windows, earlier_windows, merged)


def dedup(df: DataFrame, kind: repeats.Windows = WORDS, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept string: the words left, joined by a space]) of documents."""
    schema = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]

    def finish(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple:
        words, removed = text.split(), 0
        left = words
        if len(first):
            gone = repeats.covered(len(words), first, last, kind.window)
            left, removed = [w for w, x in zip(words, gone.tolist()) if not x], int(gone.sum())
        kept = b" ".join(left)
        row = len(words), removed, hashlib.sha256(kept).hexdigest()
        return (*row, kept.decode("utf-8", "surrogatepass")) if texts else row

    fields, arrow = "doc_id long, n_words long, n_removed long, kept_sha256 string", schema
    if texts:
        fields, arrow = fields + ", kept string", [*schema, ("kept", pa.string())]
    return repeats.apply(df, kind, finish, fields, pa.schema(arrow))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"), texts=False)


ORACLE_SQL = f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS s FROM w),
k AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(ws[s:s + {WINDOW} - 1], ' ') ORDER BY doc_id, s) AS r FROM p),
g AS (SELECT doc_id, list(i) AS gone FROM (SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM k WHERE r > 1) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id)
"""
