"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint's 64 bits are cut into five blocks on a ring; segment i is block i with the block after it. Where
two fingerprints differ in at most four bits, some segment agrees on its first block and differs in at most one
bit of its second (with two blocks or more untouched, either two of them are neighbours or one precedes a block
with a single difference). So each fingerprint is entered under its five segments and looked up under the Hamming
ball of radius one in the second block of each. Of two fingerprints only the one with the unset bit needs to
probe. Every match is then checked over all 64 bits.

Equal fingerprints are one node. A task sorts its table by key and compares the rows of a key in numpy; it returns
one edge a fingerprint at most (a spanning forest of the links it found), never the pairs. A key with more than
``BLOCK`` / 4 entries, there or one bit away, is cut into blocks of about that many, and every pair of blocks is compared under a key of its own, so that what is held
and compared at once is bounded whatever the corpus.

Defined results: a null text is the empty one, with fingerprint zero; a null doc_id has a fingerprint and takes
part, and its component is the smallest doc_id reached (null if there is none). Rows repeat as the input's do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common
from lodestar.operators.graph import component_ids

WORDS, BITS, SEED = 4, 4, 42
CUTS = (0, 13, 26, 39, 52, 64)
BLOCK = 4096
#: For ``similar_documents``: segments, turned bits in each, and differing bits of 128 up to which a pair is checked.
SEGMENTS, FREE, FAR = 6, 4, 30
#: Bits of a segment, the same for every corpus, so that which pairs are found depends on their texts alone.
WIDTH = 16
#: Nodes and bytes of shingles of a component that one task compares at once, at most twice as many.
TOGETHER, SETS = 512, 4 << 20
#: Bits of the map that finds the documents of nodes again; more nodes than it has bits only mean that more sets are made than are needed.
BITMAP = 1 << 24


def fingerprint(text: str, words: int = WORDS) -> int:
    """The SimHash of a text, by hand: a bit is 1 if set in over half the shingles' hashes."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only the six ASCII blanks cut
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), (last - 1).tolist())], np.uint64, n)
    total = np.zeros(64, np.int64)
    for k in range(0, n, 4096):
        total += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of documents; fp is the unsigned fingerprint's bits as a long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            yield common.batch(schema, b.column(0), np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64))

    return common.map_arrow(common.documents(df), run, "doc_id long, fp long", tidy=True)


def segment_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fp, probe) of the table's entries and of the ball around each segment."""
    fp = fp.view(np.uint64)
    keys, owners, probes = [], [], []
    width = [b - a for a, b in zip(CUTS, CUTS[1:])]
    block = [(fp >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in zip(CUTS, width)]
    for i in range(5):
        j = (i + 1) % 5
        key = np.uint64(i << 26) | block[i] << np.uint64(13) | block[j]
        keys.append(key)
        owners.append(fp)
        probes.append(np.zeros(len(fp), bool))
        for bit in range(width[j]):
            free = (block[j] >> np.uint64(bit)) & np.uint64(1) == 0
            keys.append(key[free] | np.uint64(1 << bit))
            owners.append(fp[free])
            probes.append(np.ones(int(free.sum()), bool))
    return np.concatenate(keys).view(np.int64), np.concatenate(owners).view(np.int64), np.concatenate(probes)


def forest(a: np.ndarray, b: np.ndarray, n: int, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest index reachable from each of n over the links (a, b), starting from label."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = np.minimum(new[new], new)
        if (new == label).all() and (label[a] == label[b]).all():
            return label
        label = new


def local_links(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fp, root) of the links within each run of a sorted key."""
    order = np.lexsort((probe, key))
    key, fp, probe = key[order], fp[order], probe[order]
    nodes, at = np.unique(fp, return_inverse=True)
    label, near, pairs, held = None, np.arange(len(key)), [], 0
    raw = fp.view(np.uint64)
    for step in range(1, len(key)):
        near = near[near + step < len(key)]
        near = near[(key[near] == key[near + step]) & ~probe[near]]  # entries lead a run; probes are not compared with probes
        if not len(near):
            break
        hit = near[np.bitwise_count(raw[near] ^ raw[near + step]) <= bits]
        pairs.append((at[hit], at[hit + step]))
        held += len(hit)
        if held > 1 << 20:
            label, pairs, held = forest(*map(np.concatenate, zip(*pairs)), len(nodes), label), [], 0
    if pairs:
        label = forest(*map(np.concatenate, zip(*pairs)), len(nodes), label)
    if label is None:
        return nodes[:0], nodes[:0]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(src, dst) edges between distinct fingerprints (column fp) that connect all those at most ``bits`` (4 or fewer) apart."""
    if bits > BITS:
        raise ValueError("the segments find up to four differing bits")
    rows_schema = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("probe", pa.bool_())])

    def enter(batches):
        for b in batches:
            yield common.batch(rows_schema, *segment_rows(b.column(0).to_numpy(zero_copy_only=False)))

    def compare(batches):
        schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])
        held: list[np.ndarray] = []
        n = 0

        def flush(last: bool):
            key, fp, probe = (np.concatenate(x) for x in zip(*held))
            end = len(key) if last else int(np.searchsorted(key, key[-1]))
            return common.batch(schema, *local_links(key[:end], fp[:end], probe[:end], bits)), [(key[end:], fp[end:], probe[end:])]

        for b in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            n += len(b)
            if n > 1 << 18:
                out, held = flush(False)
                n = len(held[0][0])
                yield out
        if held:
            yield flush(True)[0]

    spark = fps.sparkSession
    distinct = fps.select("fp").distinct()
    rows = common.map_arrow(distinct, enter, "key long, fp long, probe boolean", tidy=True)
    # A key is hot if over BLOCK / 4 entries stand there or one bit away. How many keys are grows with the corpus, so the list is joined, not broadcast by order.
    owners = common.map_arrow(distinct, lambda it: (common.batch(pa.schema([("key", pa.int64())]), k[~p]) for k, _, p in (segment_rows(b.column(0).to_numpy(zero_copy_only=False)) for b in it)), "key long", tidy=True)
    hot = owners.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK // 4)
    flips = hot.select("n", F.explode(F.array(F.col("key"), *[F.col("key").bitwiseXOR(F.lit(1 << k)) for k in range(13)])).alias("key"))
    hot = common.written(flips.groupBy("key").agg(F.ceil(F.max("n") / F.lit(BLOCK // 4)).cast("int").alias("blocks")), "hot")
    rows = rows.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.least(i, mine).cast("long") * (1 << 31) + F.greatest(i, mine))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("blocks") > 1, both).otherwise(F.array(F.lit(0).cast("long")))))
    rows = rows.select(F.when(F.col("blocks") > 1, F.xxhash64("key", "pair")).otherwise(F.col("key")).alias("key"), "fp", "probe")
    small = rows.repartition("key").sortWithinPartitions("key")
    common.small_batches(spark)
    return small.mapInArrow(compare, "src long, dst long")


def near_duplicates(df: DataFrame, bits: int = BITS, words: int = WORDS) -> DataFrame:
    """(doc_id, fp, component_id) of documents: the smallest doc_id that links of at most ``bits`` differing bits reach."""
    spark = df.sparkSession
    fps = common.written(fingerprints(df, words), "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = common.written(links(fps, bits), "links")
    parts = component_ids(found, common.fresh_path(spark, "components")).select(F.col("node").alias("fp"), F.col("component"))
    named = first.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # written, so that both sides of the join below are plain exchanges, whose large partitions AQE splits
    roots = common.written(named.groupBy("component").agg(F.min("first").alias("component_id")), "roots")
    classes = common.written(named.join(roots, "component").select("fp", "component_id"), "classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles; of fewer words the whole sequence, of none nothing."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), (last - 1).tolist())], np.uint64, n))


def balance(shingles: np.ndarray) -> np.ndarray:
    """Set less unset bits over all shingles, for each of the 128 bits of the longer fingerprint."""
    total = np.zeros(128, np.int64)
    for k in range(0, len(shingles), 4096):
        h = shingles[k : k + 4096]
        more = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        more ^= more >> np.uint64(32)
        both = np.concatenate([h.view(np.uint8).reshape(-1, 8), (more * np.uint64(0x94D049BB133111EB)).view(np.uint8).reshape(-1, 8)], 1)
        total += 2 * np.unpackbits(both, axis=1, bitorder="little").sum(0, dtype=np.int64) - len(h)
    return total


def sketch(text: str, words: int, width: int) -> tuple[int, int, bytes]:
    """(low and high half of the 128-bit fingerprint, the FREE least certain bits of each segment)."""
    total = balance(shingle_set(text, words))
    low, high = np.packbits(total > 0, bitorder="little").view(np.int64).tolist()
    rows = np.abs(total[: SEGMENTS * width]).reshape(SEGMENTS, width)
    return low, high, np.argsort(rows, axis=1, kind="stable")[:, :FREE].astype(np.uint8).tobytes()


def ball_rows(low: np.ndarray, high: np.ndarray, free: np.ndarray, width: int) -> np.ndarray:
    """(rows, SEGMENTS, 2**FREE) keys: each segment's value, then those with some of its least certain bits turned."""
    bits = np.unpackbits(np.stack([low, high], 1).view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")[:, : SEGMENTS * width]
    value = (bits.reshape(-1, SEGMENTS, width).astype(np.int64) << np.arange(width)).sum(2) | (np.arange(SEGMENTS, dtype=np.int64) << 40)
    keys = value[:, :, None]
    for k in range(FREE):
        keys = np.concatenate([keys, keys ^ (np.int64(1) << free[:, :, k].astype(np.int64))[:, :, None]], 2)
    return keys


def near_groups(key: np.ndarray, node: np.ndarray, low: np.ndarray, high: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes that hang together by pairs which share a key and differ in at most FAR bits; root is the smallest of them, so tasks mostly name the same one."""
    order = np.lexsort((probe, key))
    key, node, low, high, probe = key[order], node[order], low[order].view(np.uint64), high[order].view(np.uint64), probe[order]
    names, at = np.unique(node, return_inverse=True)
    near, pairs, held, label = np.arange(len(key)), [], 0, np.arange(len(names))
    for step in range(1, len(key)):
        near = near[near + step < len(key)]
        near = near[(key[near] == key[near + step]) & ~probe[near]]
        if not len(near):
            break
        x, y = at[near], at[near + step]
        open_ = label[x] != label[y]
        gap = np.bitwise_count(low[near[open_]] ^ low[near[open_] + step]).astype(np.int64) + np.bitwise_count(high[near[open_]] ^ high[near[open_] + step])
        hit = gap <= FAR
        pairs.append((x[open_][hit], y[open_][hit]))
        held += int(hit.sum())
        if held > 1 << 18 or step % 64 == 0:
            label, pairs, held = forest(*map(np.concatenate, zip(*pairs)), len(names), label), [], 0
    if pairs:
        label = forest(*map(np.concatenate, zip(*pairs)), len(names), label)
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def linked(low: np.ndarray, high: np.ndarray, block: np.ndarray, sets: list[np.ndarray], similar: float) -> list[tuple[int, int]]:
    """A forest of the pairs whose sets' Jaccard share is ``similar`` or more, among those that differ in at most FAR bits; the nearest are checked first, and none that hang together already. Of two blocks only pairs across."""
    low, high = low.view(np.uint64), high.view(np.uint64)
    gap = np.bitwise_count(low[:, None] ^ low[None]).astype(np.int16) + np.bitwise_count(high[:, None] ^ high[None])
    near = np.triu(gap <= FAR, 1)
    if (block != block[0]).any():
        near &= block[:, None] != block[None]
    x, y = np.nonzero(near)
    order = np.argsort(gap[x, y], kind="stable")
    x, y = x[order], y[order]
    label, out, at = np.arange(len(low)), [], 0
    while at < len(x):
        some = np.nonzero(label[x[at : at + 4096]] != label[y[at : at + 4096]])[0] + at
        for k in some.tolist():
            i, j = int(x[k]), int(y[k])
            if label[i] != label[j]:
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared >= similar * (len(sets[i]) + len(sets[j]) - shared):
                    label[label == label[j]] = label[i]
                    out.append((i, j))
        at += 4096
    return out


def mark(c) -> Column:
    """The bit of a value in a bitmap."""
    return F.pmod(F.xxhash64(c), F.lit(BITMAP))


def bitmap_of(df: DataFrame, column: str):
    """A broadcast bitmap of a fixed size (words of 64 bits) with the marks of a column's values."""
    m = df.select(mark(F.col(column)).alias("m"))
    held = m.groupBy(F.shiftright("m", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(m & 63))")).alias("bits")).collect()  # BITMAP / 64 rows at most
    bitmap = np.zeros(BITMAP // 64, np.int64)
    for r in held:
        bitmap[r["at"]] = r["bits"]
    return df.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))


def without_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """df without the rows whose doc_id is in ids (doc_id, distinct). Rows that a bitmap of the ids clears stay where they are; only the others, texts and all, are dealt out for the join."""
    import pandas as pd

    sent = bitmap_of(ids, "doc_id")

    def marked(m):
        at = m.fillna(0).to_numpy(np.int64)
        return pd.Series((sent.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1) & m.notna()

    bit = F.when(F.col("doc_id").isNotNull(), mark(F.col("doc_id").cast("long")))
    asked = F.pandas_udf(marked, "boolean")(bit)
    return df.where(~asked).unionByName(df.where(asked).join(ids, "doc_id", "left_anti").select(*df.columns))


def similar_documents(df: DataFrame, words: int = 5, similar: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of documents linked where the Jaccard share of their sets of ``words``-word shingles is ``similar`` or more.

    Multi-index hashing over a 128-bit SimHash of the set: six segments, in each the Hamming ball over its ``FREE`` least certain bits (those that the
    fewest shingles decide, which are the ones that a change turns); table matches with ``FAR`` or fewer differing bits over all 128 go on to an exact check of the share, so
    no link is wrong. Of pairs at a share of 0.8, 0.85 and 0.9 some 0.99, 1.0 and 1.0 are found (measured over random sets of 60 to 400 shingles, see ``tests/llm``), however many documents there are: the
    segments have ``WIDTH`` bits for every corpus. What meets under a key by chance grows with the square of the documents, and costs a comparison of two fingerprints.

    Texts with one fingerprint are one node, named by its smallest doc_id. No group of copies gives a square of pairs: of the matches under a key a task keeps which nodes hang together; the components of all matches then
    bring their nodes' sets together, once each, and there the nearest pairs are checked first and only until they hang together. A key with over ``BLOCK`` / 4 entries, and a component with over ``TOGETHER`` nodes or
    ``SETS`` bytes, is split in blocks, every pair of which is compared by itself.

    Defined results: null texts are empty ones; those without words are one group; rows without doc_id belong to the group of their text, and are alone (null) if no id is there. Rows repeat as the input's do.
    """
    with common.scratch(df.sparkSession) as keep:
        path = common.fresh_path(df.sparkSession, "groups")
        keep.add(path)
        return common.written_at(_similar_documents(df, words, similar), path)


def _similar_documents(df: DataFrame, words: int, similar: float) -> DataFrame:
    spark = df.sparkSession
    docs = common.documents(df)
    width = WIDTH
    names = "doc_id long, low long, high long, free binary"

    def draw(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("free", pa.binary())])
        for b in batches:
            yield common.batch(schema, b.column(0), *(list(zip(*(sketch(t, words, width) for t in b.column(1).to_pylist()))) or [[]] * 3))

    row_names = "key long, node long, low long, high long, probe boolean"
    row_schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("probe", pa.bool_())])
    edge_schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def enter(batches):
        for b in batches:
            for k in range(0, len(b), 2000):
                rows = b.slice(k, 2000)
                node, low, high = (rows.column(c).to_numpy(zero_copy_only=False) for c in range(3))
                free = np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint8).reshape(-1, SEGMENTS, FREE)
                keys = ball_rows(low, high, free, width)
                shape = keys.shape
                spread = lambda x: np.broadcast_to(x[:, None, None], shape).ravel()
                probe = np.broadcast_to(np.arange(shape[2]) > 0, shape).ravel()
                yield common.batch(row_schema, keys.ravel(), spread(node), spread(low), spread(high), probe)

    def compare(batches):
        held, n = [], 0
        for b in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            n += len(b)
            if n > 1 << 18:
                rows = [np.concatenate(x) for x in zip(*held)]
                end = int(np.searchsorted(rows[0], rows[0][-1]))
                if end:
                    yield common.batch(edge_schema, *near_groups(*(x[:end] for x in rows)))
                held = [tuple(x[end:] for x in rows)]
                n = len(held[0][0])
        if held:
            yield common.batch(edge_schema, *near_groups(*(np.concatenate(x) for x in zip(*held))))

    def collect(batches):
        """The sets of documents whose id may be a node's, by a bitmap of a fixed size: no text is shuffled to find them."""
        schema = pa.schema([("node", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("shingles", pa.binary())])
        bitmap = sent.value
        for b in batches:
            marks = b.column(2).to_numpy(zero_copy_only=False)
            some = (bitmap[marks >> 6] >> (marks & 63).astype(np.uint64)) & np.uint64(1) == 1
            part = b.filter(pa.array(some))
            for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                low, high, _ = sketch(text, words, width)
                yield common.batch(schema, [node], [low], [high], [shingle_set(text, words).tobytes()])

    def connect(batches):
        """Checked links of each group; the input is sorted by group."""
        held: list[tuple] = []

        def links_():
            node, low, high, block = (np.array([r[k] for r in held], np.int64) for k in (1, 2, 3, 4))
            found = linked(low, high, block, [np.frombuffer(r[5], np.uint64) for r in held], similar)
            return common.batch(edge_schema, [node[i] for i, _ in found], [node[j] for _, j in found])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and r[0] != held[-1][0]:
                    yield links_()
                    held = []
                held.append(r)
        if held:
            yield links_()

    pairs_of = lambda mine: F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.least(i, mine).cast("long") * (1 << 31) + F.greatest(i, mine))
    drawn = common.written(common.map_arrow(docs, draw, names, tidy=True), "sketches")
    classes = common.written(drawn.groupBy("low", "high").agg(F.min("doc_id").alias("node"), F.min("free").alias("free")), "classes")
    # matches
    rows = common.map_arrow(classes.where("node is not null").select("node", "low", "high", "free"), enter, row_names, tidy=True)
    hot = rows.where("not probe").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK // 4)
    hot = common.written(hot.select("key", F.ceil(F.col("n") / F.lit(BLOCK // 4)).cast("int").alias("blocks")), "hot")
    rows = rows.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("blocks") > 1, pairs_of(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))).otherwise(F.array(F.lit(0).cast("long")))))
    rows = rows.select(F.when(F.col("blocks") > 1, F.xxhash64("key", "pair")).otherwise(F.col("key")).alias("key"), "node", "low", "high", "probe")
    found = common.written(rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "src long, dst long").distinct(), "matches")
    # checks, within the components of the matches
    whole = common.written(component_ids(found, common.fresh_path(spark, "components")).select("node", F.col("component").alias("whole")), "whole")
    sent = bitmap_of(whole, "node")
    sets = common.map_arrow(docs.where("doc_id is not null").select("doc_id", "text", mark(F.col("doc_id")).alias("mark")), collect, "node long, low long, high long, shingles binary")
    sets = common.written(sets, "shingles")  # some of them of no node; repeated rows are there each, and fall together in the links
    sizes = sets.select("node", F.octet_length("shingles").alias("size")).join(whole, "node").groupBy("whole").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(TOGETHER)), F.ceil(F.col("bytes") / F.lit(SETS))).cast("int")
    sizes = common.written(sizes.select("whole", blocks.alias("blocks")).where("blocks > 1"), "blocks")
    members = whole.join(sizes, "whole", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.join(classes.select("node", "low", "high"), "node").select("node", "low", "high", "block", F.explode(F.transform(pairs_of(F.col("block")), lambda p: F.xxhash64("whole", p))).alias("group"))
    dealt = members.join(sets, ["node", "low", "high"]).select("group", "node", "low", "high", "block", "shingles").repartition("group").sortWithinPartitions("group")
    checked = common.written(dealt.mapInArrow(connect, "src long, dst long"), "links")
    parts = component_ids(checked, common.fresh_path(spark, "components"))
    named = classes.select("low", "high", "node").join(parts, "node", "left").select("low", "high", F.coalesce("component", "node").alias("component_id"))
    return drawn.select("doc_id", "low", "high").join(common.written(named, "classes"), ["low", "high"]).select("doc_id", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
