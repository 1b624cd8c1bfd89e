"""Exact dedup of byte strings by suffix arrays.

A shard (some 3 MB of documents that mostly have something in common) gets a suffix array by Larsson-Sadakane refinement: suffixes are sorted by eight
bytes, then groups that are still tied by the ranks eight, sixteen, thirty-two ... bytes on, until the depth
passes the window. Kasai's recurrence gives the common prefixes of neighbours, run over many stretches of the text side by
side; neighbours that share ``WINDOW`` bytes are one class, of which all but the first occurrence go. Shards are merged by the anchors of their first windows; where one
anchor has more than a merging task holds, the sorted windows of its earlier groups are kept and later ones
search them by bisection.

Strings are judged on the input; every byte that a later occurrence covers goes. See ``repeats`` for how
shards are made and merged, the order of rows and the defined results for nulls and repeated rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import common, repeats

WINDOW, GRAM = 100, 32
LANE, SORTED = 128, 1 << 18


def octets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one after the other, and how many each has."""
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)


def content(text: bytes):
    return lambda a, z: text[a:z]


def read(contents: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint8) for c in contents]


def leading(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; zeros follow the end."""
    key = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        key = key[:-step] << np.uint64(8 * step) | key[step:]
    return key[: len(text)]


def heads(new: np.ndarray) -> np.ndarray:
    """For each place the last one up to it where ``new`` is set."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new), dtype=np.int32), np.int32(0)))


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first ``depth`` bytes or more, how each is tied to the one before it: 2 to the full depth, 1 as far as the last round but one, so that the depth lies between,
    0 less). Places have four bytes, and a round sorts whole groups of some SORTED suffixes at a time: two workers share an executor's memory with its JVM."""
    n, first = len(text), leading(text)
    order = np.argsort(first).astype(np.int32)
    first = first[order]
    new = np.ones(n, bool)
    new[1:] = first[1:] != first[:-1]
    del first
    place = heads(new)
    rank = np.empty(n, np.int32)
    rank[order] = place
    slots, done, before = np.arange(n, dtype=np.int32), 8, place
    while done < depth:
        if 2 * done >= depth:
            before = place.copy()
        group = place[slots]
        several = np.zeros(len(slots), bool)
        several[1:] = group[1:] == group[:-1]
        several[:-1] |= several[1:]
        slots = slots[several]  # a group of one is settled
        del group
        if not len(slots):
            break
        for part in whole_groups(slots, place):
            members, group = order[part], place[part]
            on = members + np.int32(done)
            key = group.astype(np.int64) * (n + 1)
            key += np.where(on < n, rank[np.minimum(on, n - 1)] + np.int32(1), np.int32(0))
            by = np.argsort(key)
            members, key = members[by], key[by]
            new = np.ones(len(part), bool)
            new[1:] = key[1:] != key[:-1]
            order[part], place[part] = members, part[heads(new)]
        rank[order[slots]] = place[slots]  # only now: a round goes by the ranks of the round before
        done *= 2
    tied = np.zeros(n, np.int8)
    tied[1:] = (before[1:] == before[:-1]).astype(np.int8) + (place[1:] == place[:-1])
    return order, tied


def whole_groups(slots: np.ndarray, place: np.ndarray):
    """slots in stretches of about SORTED, none of which ends within a group."""
    a = 0
    while a < len(slots):
        z = min(a + SORTED, len(slots))
        if z < len(slots):  # slots of a group follow each other, and places grow with them
            z = a + int(np.searchsorted(place[slots[a:z]], place[slots[z]]))
            if z == a:  # one group is longer
                z = a + int(np.searchsorted(place[slots[a:]], place[slots[a]], "right"))
        yield slots[a:z]
        a = z


def common_prefixes(text: np.ndarray, order: np.ndarray, tied: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each suffix in order shares with the one before it, up to ``cap``: Kasai's recurrence over the suffixes whose ties leave it open, LANE positions of many lanes. Those tied to the full depth
    share ``cap``; of the others 0 stands for too few."""
    n = len(text)
    out = np.where(tied == 2, np.int32(cap), np.int32(0))
    open_ = np.nonzero(tied == 1)[0].astype(np.int32)
    if not len(open_):
        return out
    before = np.full(n, -1, np.int32)
    before[order[open_]] = order[open_ - 1]
    where = np.nonzero(before >= 0)[0].astype(np.int32)
    got = np.zeros(len(where), np.int32)
    tail = np.concatenate([leading(text), np.zeros(cap + 16, np.uint64)])
    lanes = np.arange(0, len(where), LANE)
    h = np.zeros(len(lanes), np.int64)
    for step in range(LANE):
        j = lanes + step
        j = j[j < len(where)]
        at = where[j]
        h = h[: len(j)]
        follows = np.zeros(len(j), bool) if not step else at == where[j - 1] + 1
        h = np.where((h >= cap) | ~follows, 0, np.maximum(h - 1, 0))  # pairs tied to the full depth have no order that the recurrence could lean on
        other = before[at]
        go = np.arange(len(j))
        while len(go):  # eight bytes at a time
            go = go[h[go] < cap]
            go = go[tail[at[go] + h[go]] == tail[other[go] + h[go]]]
            h[go] += 8
        go = np.nonzero(h < cap)[0]
        if len(go):
            apart = tail[at[go] + h[go]] ^ tail[other[go] + h[go]]
            for k in range(8):
                same = apart >> np.uint64(8 * (7 - k)) == 0
                h[go[same]] += 1
                go, apart = go[same], apart[same]
        h = np.minimum(h, cap)
        got[j] = h
    del tail
    before[where] = got
    out[open_] = before[order[open_]]
    return out


def classes(text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, the class of each: suffixes of one class share ``window`` bytes)."""
    order, tied = suffix_array(text, window)
    return order, np.cumsum(common_prefixes(text, order, tied, window) < window, dtype=np.int32)


def shard_windows(text: np.ndarray, at: np.ndarray, ords: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of the windows at some positions of a shard's text start earlier in it, by its suffix array and common prefixes."""
    order, own = classes(text, window)
    label = np.empty(len(text), np.int32)
    label[order] = own
    del order, own
    return repeats.not_first(label[at], ords, starts)


def window_bytes(text: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The windows from some positions, as sortable byte strings (with a last byte of one, so that zeros at the end count)."""
    rows, windows = np.ones((len(at), window + 1), np.uint8), np.lib.stride_tricks.sliding_window_view(text, window)
    for a in range(0, len(at), SORTED):
        rows[a : a + SORTED, :window] = windows[at[a : a + SORTED]]
    return rows.view(f"S{window + 1}").ravel()


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([a, b]))


def earlier_windows(contents, sizes, ords, starts, carried, seen, open_, window: int = WINDOW):
    """(which windows of the contents start earlier: here, or among the sorted windows seen if carried; sorted windows of the open contents)."""
    text = np.concatenate(contents)
    lengths = sizes + window - 1
    begin = (np.cumsum(lengths) - lengths).astype(np.int32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    offset = np.arange(len(owner), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
    at = begin[owner] + offset
    index = np.full(len(text), -1, np.int32)
    index[at] = np.arange(len(at), dtype=np.int32)
    order, label = classes(text, window)
    mine = index[order]
    keep = mine >= 0
    mine, label = mine[keep], label[keep]  # the windows in order, and their classes
    del order, index
    labels = np.empty(len(at), np.int32)
    labels[mine] = label
    out = repeats.not_first(labels, repeats.dense(ords)[owner], starts.astype(np.int32)[owner] + offset)
    del labels
    if seen is not None:
        asked = np.nonzero(carried[owner])[0]
        for a in range(0, len(asked), SORTED):
            some = asked[a : a + SORTED]
            windows = window_bytes(text, at[some], window)
            spot = np.minimum(np.searchsorted(seen, windows), len(seen) - 1)
            out[some] |= seen[spot] == windows
    going = open_[owner[mine]]
    mine, label = mine[going], label[going]
    new = np.ones(len(mine), bool)
    new[1:] = label[1:] != label[:-1]
    return out, window_bytes(text, at[mine[new]], window)  # one of each class, in order already


BYTES = repeats.Windows(WINDOW, GRAM, octets, content, read, shard_windows, earlier_windows, merged)


def dedup(df: DataFrame, kind: repeats.Windows = BYTES, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]) of documents."""
    schema = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]

    def finish(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple:
        kept, removed, spans = text, 0, 0
        if len(first):
            gone = repeats.covered(len(text), first, last, kind.window)
            kept, removed, spans = np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), len(repeats.true_runs(gone))
        row = len(text), removed, spans, hashlib.sha256(kept).hexdigest()
        return (*row, kept) if texts else row

    fields, arrow = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", schema
    if texts:
        fields, arrow = fields + ", kept binary", [*schema, ("kept", pa.binary())]
    return repeats.apply(df, kind, finish, fields, pa.schema(arrow))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"), texts=False)


#: Windows are told apart by 128-bit digests; bytes are handled as hexadecimal digits.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, {2 * WINDOW})) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {WINDOW - 1})) AS s FROM d)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS i FROM p) WHERE i > 1),
i AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {WINDOW} THEN 0 ELSE 1 END AS new FROM r),
g AS (SELECT doc_id, min(s) AS a, max(s) + {WINDOW} AS z FROM (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM i) GROUP BY doc_id, run),
c AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM g),
t AS (SELECT c.doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept FROM c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
