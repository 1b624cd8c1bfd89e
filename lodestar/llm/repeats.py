"""What suffix-array dedup (bytes) and substring dedup (words) share: which windows of W symbols also start earlier.

1. ``scan`` reads every text once: its anchors (the k-gram of smallest hash in each window, the leftmost if several are; equal windows have equal anchors at equal places) and the least of
   them, which texts with much in common mostly share.
2. Documents are dealt to shards of about ``SHARD`` bytes by that least anchor, so that copies mostly meet in one shard; a value with more than a shard's text is spread over several.
3. Each shard gets the operator's own structure (``earlier``: suffix array or suffix tree) over the text of all windows whose anchor comes again in the shard (a pre-filter that misses nothing). It decides every window that
   also starts earlier in the shard.
4. What is left are first windows of a shard. Those whose anchor occurs in other shards too (a pre-filter that misses nothing; each shard sends an anchor once) are cut out as segments, the runs of windows with one anchor,
   and dealt by anchor: a task merges the shards' segments in bounded groups. Of equal segments the first counts; an anchor that is left with several segments goes to the structure again, and where it has more than a group
   holds, later groups search the windows of earlier ones.
5. The marks return to their documents.

Nothing depends on the number of copies: within a shard they are decided where they lie, and a passage is one segment a shard. Texts move in compressed packs, a shard's in one exchange.
``tally`` counts how many windows were decided where.

Order: smaller doc_id first (a null counts as the largest), then smaller start. Rows that share a doc_id are one document here: equal starts are
no earlier ones. Null texts are empty ones. A document is named by its place in its shard's order, so no hash decides which is which.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm import common

SHARD, PIECE, GROUP_BYTES, HASHED, PLACES = 3 << 20, 4 << 20, 2 << 20, 1 << 19, 24


@dataclass(frozen=True)
class Windows:
    """window, gram: their lengths in symbols (gram a power of two). symbols: those of some texts, one after the other, and how many each has.
    content: the bytes of some symbols of a text. read: the symbols of some contents. earlier: which windows of a shard start earlier in it. group: what settles a group of segments. merge: of
    the windows that two groups have shown."""

    window: int
    gram: int
    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    content: Callable[[bytes], Callable[[int, int], bytes]]
    read: Callable[[list[bytes]], list[np.ndarray]]
    earlier: Callable
    group: Callable
    merge: Callable


def mixing(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def leads(h: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest (leftmost) of each ``width`` neighbours in h lies. A position has PLACES bits: longer arrays are taken in overlapping stretches."""
    out = np.empty(len(h) - width + 1, np.int64)
    stretch = (1 << PLACES) - width + 1
    for a in range(0, len(out), stretch):
        part = h[a : a + stretch + width - 1]
        low = (part & np.uint64(2**64 - (1 << PLACES))) | np.arange(len(part), dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[: step - width], low[width - step :])
        out[a : a + stretch] = (low & np.uint64((1 << PLACES) - 1)).astype(np.int64) + a
    return out


def runs(symbols: np.ndarray, sizes: np.ndarray, window: int, gram: int):
    """(anchor, document, first, last) of each run of windows with one anchor; symbols holds documents of the given sizes one after the other. Some HASHED symbols are taken at a time, whole documents."""
    ends = np.cumsum(sizes)
    cuts = [0, *(np.nonzero(np.diff(ends // HASHED))[0] + 1).tolist(), len(sizes)]
    found = []
    for a, z in zip(cuts, cuts[1:]):
        anchor, doc, first, last = runs_of(symbols[ends[a] - sizes[a] : ends[z - 1]] if z > a else symbols[:0], sizes[a:z], window, gram)
        found.append((anchor, doc + a, first, last))
    return tuple(map(np.concatenate, zip(*found)))


def runs_of(symbols: np.ndarray, sizes: np.ndarray, window: int, gram: int):
    """``runs`` at one go."""
    n = len(symbols)
    if n < window:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    h, step = mixing(symbols.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while step < gram:
        h = h[:-step] * np.uint64(0x9FB21C651E98DF25 + 2 * step) + h[step:]
        step *= 2
    h = mixing(h)
    lead = leads(h, window - gram + 1)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.zeros(n + 1, np.int32)
    long = sizes >= window
    inside[starts[long]] += 1
    np.add.at(inside, ends[long] - window + 1, -1)
    at = np.nonzero(np.cumsum(inside[: n - window + 1]))[0]
    place = lead[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    begin = at[first]
    # two documents may meet without a gap in between: cut there (a run never spans one, as windows across are no windows)
    doc = np.searchsorted(ends, begin, "right")
    return h[place[first]], doc, begin - starts[doc], at[last] - starts[doc]


def blocks(sizes: list[int], limit: int = SHARD):
    """Slices of rows of about ``limit`` bytes."""
    at = total = 0
    for k, n in enumerate(sizes):
        total += n
        if total >= limit or k == len(sizes) - 1:
            yield at, k + 1
            at, total = k + 1, 0


def encoded(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def scanned(df: DataFrame, kind: Windows) -> DataFrame:
    """(doc_id, ord, text, size, lead, anchors), written: size in bytes, the least anchor (the text's own hash if it has none) and all distinct anchors as bytes."""
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("ord", pa.int64()), ("text", pa.string()), ("size", pa.int64()), ("lead", pa.int64()), ("anchors", pa.binary())])

    def run(batches):
        for b in batches:
            texts = encoded(b.column(2).to_pylist())
            for a, z in blocks([len(t) for t in texts]):
                anchor, doc, _, _ = runs(*kind.symbols(texts[a:z]), kind.window, kind.gram)
                cuts = np.searchsorted(doc, np.arange(z - a + 1))
                own = [np.unique(anchor[x:y]) for x, y in zip(cuts, cuts[1:])]
                lead = [int(x[0]) if len(x) else xxhash.xxh64_intdigest(t) for x, t in zip(own, texts[a:z])]
                rows = b.slice(a, z - a)
                yield common.batch(schema, rows.column(0), rows.column(1), rows.column(2), [len(t) for t in texts[a:z]], np.array(lead, np.uint64).view(np.int64), [x.tobytes() for x in own])

    docs = common.documents(df).select("doc_id", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("ord"), "text")
    return common.written(common.map_arrow(docs, run, "doc_id long, ord long, text string, size long, lead long, anchors binary"), "scanned")


def in_shards(docs: DataFrame) -> DataFrame:
    """docs with chunk: shards of about SHARD bytes by the least anchor, a value with too much text spread by the text's hash."""
    total, n = docs.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    shards = max(8, int(total) // SHARD)
    bucket = F.pmod("lead", F.lit(shards))
    sizes = docs.groupBy(bucket.alias("bucket")).agg(F.ceil(F.sum("size") / F.lit(2 * SHARD)).alias("parts")).where("parts > 1")
    # written: its size is then known, so that a short list is broadcast and a long one is not
    sizes = common.written(sizes.select("bucket", F.sum("parts").over(Window.orderBy("bucket")).alias("upto"), "parts"), "buckets")
    spread = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("doc_id", "text"), F.col("parts"))).otherwise(F.lit(0))
    # the first part of a bucket keeps its number; further ones are numbered behind all buckets
    chunk = F.when(spread > 0, F.lit(shards) + F.col("upto") - F.col("parts") + spread).otherwise(F.col("bucket"))
    return docs.withColumn("bucket", bucket).join(sizes, "bucket", "left").withColumn("chunk", chunk.cast("int")).drop("bucket", "parts", "upto")


def in_packs(docs: DataFrame) -> DataFrame:
    """(chunk, blob): the documents of a chunk within a batch, compressed together."""
    schema = pa.schema([("chunk", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for b in batches:
            chunk = b.column(0).to_numpy(zero_copy_only=False)
            rows = list(zip(*(b.column(k).to_pylist() for k in range(1, 4))))
            order = np.argsort(chunk, kind="stable")
            cuts = np.nonzero(np.diff(chunk[order]))[0] + 1
            parts = np.split(order, cuts) if len(order) else []
            yield common.batch(schema, [chunk[p[0]] for p in parts], [common.freeze([rows[i] for i in p.tolist()]) for p in parts])

    return common.map_arrow(docs.select("chunk", "doc_id", "ord", "text"), run, "chunk int, blob binary")


def unpacked(table: pa.Table) -> list[tuple]:
    """(doc_id, ord, text) of a chunk, in order; rows that are alike in both can't be told apart, and need not be."""
    return sorted((r for blob in table.column("blob") for r in common.thaw(blob.as_py())), key=lambda r: r[1:])


def between(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the stretches first..end (excluded)."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(end, n), -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def dense(ords: np.ndarray) -> np.ndarray:
    """Numbers in the order of ords, equal where these are."""
    return np.unique(ords, return_inverse=True)[1].astype(np.int32)


def shard_windows(kind: Windows, texts: list[bytes], ords: np.ndarray):
    """For each block of a shard's texts: (first text, where its texts start and end, which windows start earlier in the block's stretch, runs, stretch of each run)."""
    for a, z in blocks([len(t) for t in texts]):
        symbols, sizes = kind.symbols(texts[a:z])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        found = runs(symbols, sizes, kind.window, kind.gram)
        # only windows whose anchor comes again here can start earlier here: the structure is built over their symbols
        _, which, often = np.unique(found[0], return_inverse=True, return_counts=True)
        again = np.nonzero(often[which] > 1)[0]
        low, high = starts[found[1][again]] + found[2][again], starts[found[1][again]] + found[3][again]
        gone = np.zeros(len(symbols), bool)
        stretch = np.zeros(len(found[0]), np.int64)
        if len(again):
            at = np.nonzero(between(len(symbols), low, high + 1))[0].astype(np.int32)
            kept = np.nonzero(between(len(symbols), low, high + kind.window))[0].astype(np.int32)
            spot = np.searchsorted(kept, at).astype(np.int32)
            stretch = np.searchsorted(kept, starts[found[1]] + found[2]) // PIECE
            turn, begin = dense(ords[a:z]), starts.astype(np.int32)
            for s in range(0, len(kept), PIECE):  # more than a piece is taken in overlapping stretches
                x, y = np.searchsorted(spot, [s, s + PIECE])
                if y - x > 1:
                    doc = np.searchsorted(ends, at[x:y], "right").astype(np.int32)
                    gone[at[x:y]] = kind.earlier(symbols[kept[s : s + PIECE + kind.window - 1]], spot[x:y] - np.int32(s), turn[doc], at[x:y] - begin[doc])
        yield a, starts, ends, gone, found, stretch


def shared_anchors(batches):
    """(chunk, anchor) of the anchors of two chunks or more, each once, from (anchor, chunk) sorted by both. What is held is one anchor, its first chunk while that is alone, and the last chunk seen."""
    schema = pa.schema([("chunk", pa.int32()), ("anchor", pa.int64())])
    last = alone = seen = None
    for b in batches:
        anchor, chunk = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])
        if len(anchor) and anchor[0] == last and chunk[0] == seen:
            new[0] = False
        anchor, chunk = anchor[new], chunk[new]
        if not len(anchor):
            continue
        head = np.ones(len(anchor), bool)
        head[1:] = anchor[1:] != anchor[:-1]
        at = np.nonzero(head)[0]
        several = np.diff(np.append(at, len(anchor))) > 1
        first = np.empty(0, np.int32)
        if anchor[0] == last:  # it has been seen in another chunk
            several[0] = True
            if alone is not None:
                first, alone = np.array([alone], np.int32), None
        many = several[np.cumsum(head) - 1]
        yield common.batch(schema, np.concatenate([first, chunk[many]]), np.concatenate([np.full(len(first), last, np.int64), anchor[many]]))
        if anchor[-1] != last:
            alone = None if several[-1] else chunk[-1]
        last, seen = anchor[-1], chunk[-1]


def marks(docs: DataFrame, packs: DataFrame, kind: Windows) -> DataFrame:
    """(row, first, last, how) runs of windows that also start earlier; docs as from ``in_shards``. row is the chunk and the place in it; how is 1 in the shard, 2 by equal segments, 3 by the structure over segments."""

    def anchors(batches):
        schema = pa.schema([("anchor", pa.int64()), ("chunk", pa.int32())])
        for b in batches:
            own = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            chunk = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(x) for x in own])
            anchor = np.concatenate([np.empty(0, np.int64), *own])
            order = np.lexsort((chunk, anchor))
            anchor, chunk = anchor[order], chunk[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])
            yield common.batch(schema, anchor[new], chunk[new])

    segment_schema = pa.schema([("anchor", pa.int64()), ("ord", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("content", pa.binary())])

    def cut(left, right):
        """Marks of the windows that the shard's structure decides (content is null), and the segments of the others whose anchors occur in other shards."""
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        contents: list = []
        if left.num_rows:
            rows = unpacked(left)
            base = np.int64(left.column("chunk")[0].as_py()) << np.int64(32)
            texts, ords = encoded([r[2] for r in rows]), np.array([r[1] for r in rows], np.int64)
            found = list(shard_windows(kind, texts, ords))
            # anchors of several shards, and of several stretches of this one
            own = np.unique(np.concatenate([np.stack([x[4][0].view(np.int64), x[5] + (k << 32)], 1) for k, x in enumerate(found)] or [np.empty((0, 2), np.int64)]), axis=0)[:, 0] if sum(map(len, texts)) >= SHARD else np.empty(0, np.int64)
            want = np.unique(np.concatenate([right.column("anchor").to_numpy(), own[1:][own[1:] == own[:-1]]]))
            for a, starts, ends, gone, (anchor, d, first, last), _ in found:
                f, e = edges(gone)
                doc, doc_e = np.searchsorted(ends, f, "right"), np.searchsorted(ends, e, "right")
                for column, x in zip(out, (f - f, ords[a + doc], base + a + doc, f - starts[doc], e - starts[doc_e])):
                    column.append(x)
                contents += [None] * len(f)
                if not len(want) or not len(anchor):
                    continue
                anchor = anchor.view(np.int64)
                spot = np.minimum(np.searchsorted(want, anchor), len(want) - 1)
                low, high = starts[d] + first, starts[d] + last
                free = np.zeros(len(gone) + 1, np.int32)
                np.cumsum(~gone, out=free[1:])
                hit = np.nonzero((want[spot] == anchor) & (free[high + 1] > free[low]))[0]
                left_ = np.nonzero(~gone)[0].astype(np.int32)
                f = left_[free[low[hit]]] - starts[d[hit]]  # the first and the last window that is not decided
                e = left_[free[high[hit] + 1] - 1] - starts[d[hit]]
                for column, x in zip(out, (anchor[hit], ords[a + d[hit]], base + a + d[hit], f, e)):
                    column.append(x)
                now, content = -1, None
                for k, x, y in zip(d[hit].tolist(), f.tolist(), e.tolist()):
                    if k != now:
                        now, content = k, kind.content(texts[a + k])
                    contents.append(content(x, y + kind.window))
            del found, rows, texts
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        common.let_go()
        return pa.table([*(pa.array(c, t) for c, t in zip(columns, segment_schema.types)), pa.array(contents, pa.binary())], schema=segment_schema)

    def settle(batches):
        """Marks of the segments of each anchor, in groups of about GROUP_BYTES; the input is sorted by anchor, ord, first."""
        schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("how", pa.int8())])
        held, size, carry = [], 0, None

        def flush():
            nonlocal held, size, carry
            found, carry = group_marks(kind, held, carry)
            held, size = [], 0
            return common.batch(schema, *(list(zip(*found)) or [[]] * 4))

        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns)):
                if held and size >= GROUP_BYTES and (x[0] != held[-1][0] or size >= 4 * GROUP_BYTES):
                    yield flush()
                held.append(x)
                size += len(x[5])
        if held:
            yield flush()
            common.let_go()

    listed = common.map_arrow(docs.select("chunk", "anchors"), anchors, "anchor long, chunk int").repartition("anchor").sortWithinPartitions("anchor", "chunk")
    wanted = listed.mapInArrow(shared_anchors, "chunk int, anchor long")
    segments = common.written(packs.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(cut, "anchor long, ord long, row long, first int, last int, content binary"), "segments")
    dealt = segments.where("content is not null").repartition("anchor").sortWithinPartitions("anchor", "ord", "first")
    settled = dealt.mapInArrow(settle, "row long, first int, last int, how tinyint")
    return segments.where("content is null").select("row", "first", "last", F.lit(1).cast("tinyint").alias("how")).union(settled)


def group_marks(kind: Windows, rows: list[tuple], carry):
    """(marks, carry) of segments (anchor, ord, row, first, last, content) in order.

    Equal contents are one; those after the first are marked whole. carry holds what an anchor that a group's end
    cuts in two has shown so far.
    """
    carried, seen = carry if carry and carry[0] == rows[0][0] else (None, None)
    goes_on = rows[-1][0]
    owner, out, twins, at = [], [], [], 0
    while at < len(rows):  # an anchor at a time
        anchor, end, unique, own = rows[at][0], at, {}, []
        while end < len(rows) and rows[end][0] == anchor:
            _, ord_, row, first, last, content = rows[end]
            k = unique.setdefault(content, len(own))
            if k == len(own):
                own.append((ord_, first, last - first + 1, row, anchor == carried, content))
            elif (ord_, first) > own[k][:2]:
                out.append((row, first, last, 2))
            else:
                twins.append((len(owner) + k, row, first))
            end += 1
        if len(own) > 1 or anchor == carried or anchor == goes_on:
            owner += own
        else:
            while twins and twins[-1][0] >= len(owner):
                twins.pop()
        at = end
    if not owner:
        return out, None
    contents = kind.read([o[5] for o in owner])
    sizes, ords, starts = (np.array([o[k] for o in owner], np.int64) for k in (2, 0, 1))
    open_ = np.arange(len(owner)) >= len(owner) - len(own)  # segments of the last anchor, which may go on in the next group
    earlier, keys = kind.group(contents, sizes, ords, starts, np.array([o[4] for o in owner]), seen, open_)
    if seen is not None and carried == goes_on:
        keys = kind.merge(seen, keys)
    bounds = np.cumsum(sizes) - sizes
    for k, (_, first, n, row, _, _) in enumerate(owner):
        out += [(row, first + a, first + z, 3) for a, z in true_runs(earlier[bounds[k] : bounds[k] + n])]
    for k, row, first in twins:
        out += [(row, first + a, first + z, 3) for a, z in true_runs(earlier[bounds[k] : bounds[k] + owner[k][2]])]
    return out, (goes_on, keys)


def true_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of True."""
    first, last = edges(flags)
    return list(zip(first.tolist(), last.tolist()))


def edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of True."""
    edge = np.diff(np.concatenate([np.zeros(1, np.int8), flags.view(np.int8), np.zeros(1, np.int8)]))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0] - 1


def not_first(label: np.ndarray, ords: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of windows with a class label each: which have one of their class that is strictly earlier."""
    if (ords[1:] >= ords[:-1]).all() and ((ords[1:] != ords[:-1]) | (starts[1:] > starts[:-1])).all():  # in order as they come: the first of a class has its smallest index
        lead = np.full(int(label.max(initial=0)) + 1, len(label), np.int32)
        lead[label[::-1]] = np.arange(len(label) - 1, -1, -1, dtype=np.int32)
        return lead[label] != np.arange(len(label), dtype=np.int32)
    order = np.lexsort((starts, ords, label))
    head = np.ones(len(label), bool)
    head[1:] = label[order][1:] != label[order][:-1]
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(label)), 0))] if len(label) else order
    out = np.zeros(len(label), bool)
    out[order] = (ords[order] != ords[lead]) | (starts[order] != starts[lead])
    return out


def apply(df: DataFrame, kind: Windows, finish: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """finish(text as bytes, marks) -> a row after doc_id, for every document; marks: (first, last) window of each marked run."""
    docs = in_shards(scanned(df, kind))
    packs = in_packs(docs)
    gone = marks(docs, packs, kind).select(F.shiftright("row", 32).cast("int").alias("chunk"), F.col("row").bitwiseAND(F.lit((1 << 32) - 1)).alias("row"), "first", "last")

    def run(left, right):
        row, first, last = (right.column(k).to_numpy() for k in ("row", "first", "last"))
        order = np.argsort(row)
        row, first, last = row[order], first[order], last[order]
        rows = []
        for k, (doc_id, _, text) in enumerate(unpacked(left) if left.num_rows else ()):
            a, z = np.searchsorted(row, k), np.searchsorted(row, k, "right")
            rows.append((doc_id, *finish(text.encode("utf-8", "surrogatepass"), first[a:z], last[a:z])))
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(arrow), arrow.types)], schema=arrow)

    return packs.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(run, schema)


def tally(df: DataFrame, kind: Windows) -> dict[int, int]:
    """How many windows were marked in their shard (1), by equal segments (2) and by the structure over segments (3)."""
    docs = in_shards(scanned(df, kind))
    return {r.how: r.n for r in marks(docs, in_packs(docs), kind).groupBy("how").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n")).collect()}


def covered(n: int, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Which of n symbols lie in a marked window."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + window, -1)
    return np.cumsum(edge[:-1]) > 0
