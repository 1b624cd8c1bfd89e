"""Token ids in binary shards that a minimal perfect hash indexes by document key.

A shard is ``header | entries | fingerprints | hash levels | raw ids``. Documents lie in ascending key order; the
entries give each one's first id and number of ids. The hash is a cascade of bit sets: a key owns the bit of
the first level where no other key falls on it, and the number of set bits before that one is its slot. A slot
names an entry and keeps a 32-bit fingerprint of its key, so that absent keys are told (wrongly once in 2**32).

``index`` maps keys to shards (one row a shard: its file and its smallest and largest key, as shards hold ascending ranges). ``lookup``
opens only the shards that may hold a key; ``fetch`` reads one document by ranges: a shard's tables and the document's own ids.

Shards are written by Spark's own writer, one row a file, and so to any store that Spark reaches; the last
byte of a file is that writer's line end. A lost task writes its files anew; the commit keeps one copy.

Defined results: a null text is the empty one, which holds the end id alone. Rows that repeat a key are all
kept, in input order within the shard, and a lookup gives the first. A row without a key comes first and no
lookup finds it. Other columns are not looked at. An empty table gives no shard.
"""

from __future__ import annotations

import array
import struct
import zlib

import numpy as np
import pyarrow as pa
import re
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm import common
from lodestar.llm.bpe import byte_letters

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
MAGIC, HEAD = b"LSTOK1\0\0", "<8sqqqqqq"
SHARD_BYTES, CACHE, UNIT = 6 << 20, 600_000, 64
#: Scripts for which the word pattern here is known to agree with the library's; other texts go to it whole.
ODD = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa0-\\u017f\\u2010-\\u2027]|<\\|")


#: Units that can't be cut alone: with a blank next to a space, or with ODD characters. A text that has one takes another way.
UNFIT = re.compile(ODD.pattern + "|^$|^[\\n]|[\\n]$|[\\t\\r\\xa0]")


#: The library's cuts of texts without ODD characters: its letters, digits and blanks among the others are spelt out.
LETTER, DIGIT, BLANK = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u017f", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe", " \\t\\n\\r\\xa0"
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{BLANK}{LETTER}{DIGIT}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


class Pieces(dict):
    """Piece of text -> the bytes of its ids, found by the library's model when first asked for."""

    def __init__(self, model, code: str):
        self.model, self.code, self.letters = model, code, dict(enumerate(byte_letters()))

    def fresh(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode().decode("latin-1")  # a character a byte
        ids = [t.id for t in self.model.tokenize(raw.translate(self.letters))]
        return array.array(self.code, ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        found = self.fresh(piece)
        if len(piece) <= UNIT:
            self[piece] = found
        return found


class Unfit(Exception):
    pass


class Units(dict):
    """What follows a lone space -> the bytes of the ids of both."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, unit: str) -> bytes:
        if unit.isalpha() and unit.isascii():  # one piece, which need not be kept twice
            found = self.pieces.fresh(" " + unit)
        elif UNFIT.search(unit):
            raise Unfit
        else:
            found = b"".join(map(self.pieces.__getitem__, CUT.findall(" " + unit)))
        if len(unit) <= UNIT:  # longer ones are not kept, so that CACHE entries are a bound in bytes too
            self[unit] = found
        return found


class WordEncoder:
    """The tokenizers library, asked once for each distinct piece of text between its own cuts.

    Where single spaces stand alone, each starts a piece, so that texts fall into units (a space and what follows
    up to the next) that can be cut and remembered one by one.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.type = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.type).tobytes()
        self.forget()

    def forget(self) -> None:
        self.pieces = Pieces(self.tokenizer.model, "H" if self.type.itemsize == 2 else "I")
        self.units = Units(self.pieces)

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if not UNFIT.search(first):
                return b"".join(map(self.pieces.__getitem__, CUT.findall(first))) + b"".join(map(self.units.__getitem__, rest))
        except Unfit:
            pass
        if ODD.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()
        return b"".join(map(self.pieces.__getitem__, CUT.findall(text)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if len(self.units) > CACHE or len(self.pieces) > CACHE:
            self.forget()
        return [self.encode(t) + self.end for t in texts]


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of each key."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 of n distinct keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x, dtype=np.int64) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, 2 * len(keys))
            spot = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[spot]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for a key that was not built in."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            spot = (mixed(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[spot]
            out[left[hit]] = self.before[k] + self.ranks[k][spot[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        return struct.pack("<q", len(self.levels)) + b"".join(struct.pack("<q", len(x)) + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, raw: memoryview) -> PerfectHash:
        (n,), at, levels = struct.unpack_from("<q", raw), 8, []
        for _ in range(n):
            (bits,) = struct.unpack_from("<q", raw, at)
            size = (bits + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at + 8), count=bits).astype(bool))
            at += 8 + size
        return cls(levels)


def pack(part: int, number: int, keys: list, payloads: list[bytes], width: int) -> bytes:
    """The bytes of one shard; a None among keys is a row without one."""
    n_ids = np.array([len(p) // width for p in payloads], np.int64)
    starts = np.cumsum(n_ids) - n_ids
    has = np.array([k is not None for k in keys], bool)
    values = np.array([k or 0 for k in keys], np.int64)
    distinct, first = np.unique(values[has], return_index=True)
    index = PerfectHash.build(distinct)
    slots = index.slots(distinct)
    table = np.zeros((len(distinct), 2), np.int64)
    table[slots, 0] = np.nonzero(has)[0][first]
    table[slots, 1] = (mixed(distinct, 99) >> np.uint64(32)).astype(np.int64)
    levels = index.dump()
    entries = np.stack([values, has.astype(np.int64), starts, n_ids], 1).astype("<i8").tobytes()
    return struct.pack(HEAD, MAGIC, part, number, width, len(keys), len(distinct), len(levels)) + entries + table.astype("<i8").tobytes() + levels + b"".join(payloads)


class Shard:
    """A shard's bytes, opened: ``get(keys)`` takes constant time a key."""

    def __init__(self, raw: bytes, payload: bool = True):
        magic, self.part, self.number, self.width, n, slots, levels = struct.unpack_from(HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)
        self.entries = np.frombuffer(raw, "<i8", 4 * n, at).reshape(n, 4)
        at += 32 * n
        self.table = np.frombuffer(raw, "<i8", 2 * slots, at).reshape(slots, 2)
        at += 16 * slots
        self.index = PerfectHash.load(memoryview(raw)[at : at + levels])
        self.n_ids = int(self.entries[:, 3].sum())
        self.ids = np.frombuffer(raw, f"<u{self.width}", self.n_ids, at + levels) if payload else None

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where the shard has none."""
        slots = self.index.slots(keys)
        print_ = np.where(slots >= 0, self.table[slots, 1], -1) if len(self.table) else np.full(len(keys), -1)
        return np.where(print_ == (mixed(keys, 99) >> np.uint64(32)).astype(np.int64), self.table[slots, 0] if len(self.table) else -1, -1)

    def tokens(self, entry: int) -> np.ndarray:
        _, _, start, n = self.entries[entry]
        return self.ids[start : start + n]


def write(df: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the shards of documents (doc_id, text) under path, in ascending order of doc_id."""

    def run(batches):
        encoder = common.worker_cache("tokens", (tokenizer, end_id), lambda: WordEncoder(tokenizer, end_id))
        part, number, keys, payloads, size = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema([("content", pa.binary())])
        for b in batches:
            texts = b.column(1).to_pylist()
            for key, payload in zip(b.column(0).to_pylist(), encoder.encode_batch(texts)):
                keys.append(key)
                payloads.append(payload)
                size += len(payload)
                if size >= SHARD_BYTES:
                    yield common.batch(schema, [pack(part, number, keys, payloads, encoder.type.itemsize)])
                    number, keys, payloads, size = number + 1, [], [], 0
        if keys:
            yield common.batch(schema, [pack(part, number, keys, payloads, encoder.type.itemsize)])

    docs = common.documents(df).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    shards = common.map_arrow(docs, run, "content binary")
    shards.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a document of the shards under path: doc_id, shard, number, n_tokens, before (ids before it in its shard), ids_crc32, all fetched by key."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("number", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for raw in b.column(0):
                shard = Shard(raw.as_py())
                values, has = shard.entries[:, 0], shard.entries[:, 1] == 1
                at = np.arange(len(values))
                found = shard.find(values[has])
                if (found < 0).any() or (values[found] != values[has]).any():
                    raise ValueError("a key of the shard is not found by its index")
                at[has] = found + (np.arange(has.sum()) - np.searchsorted(values[has], values[has]))  # the repeats of a key follow its first
                crc = [zlib.crc32(shard.tokens(i).astype("<u4").tobytes()) for i in at.tolist()]
                keys = pa.array(values, pa.int64(), mask=~has)
                yield common.batch(schema, keys, np.full(len(at), shard.part), np.full(len(at), shard.number), shard.entries[at, 2], shard.entries[at, 3], crc)

    common.small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "doc_id long, part long, number long, before long, n_tokens long, ids_crc32 long")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(file, least, most): the keys that each shard under path spans; made when first asked for, beside the shards, and kept."""
    place = f"{path.rstrip('/')}/_index"
    p = spark._jvm.org.apache.hadoop.fs.Path(place + "/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        schema = pa.schema([("file", pa.string()), ("least", pa.int64()), ("most", pa.int64())])

        def run(batches):
            for b in batches:
                for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                    shard = Shard(raw.as_py())
                    keys = shard.entries[shard.entries[:, 1] == 1, 0]
                    if len(keys):
                        yield common.batch(schema, [name], [keys[0]], [keys[-1]])

        common.small_batches(spark)
        spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, least long, most long").sort("least").write.mode("overwrite").parquet(place)
    return spark.read.schema("file string, least long, most long").parquet(place)


def shards_of(spark: SparkSession, path: str, keys: list[int]) -> list[str]:
    """The files that may hold some of the keys: at most one a key, but where a key's repeats end one shard and begin the next."""
    wanted = spark.createDataFrame([(int(k),) for k in sorted(set(keys))], "key long")
    return sorted(r.file for r in index(spark, path).join(F.broadcast(wanted), F.expr("key between least and most")).select("file").distinct().collect())


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """(doc_id, ids) of a short list of keys, from those shards under path that may hold them."""
    want = np.array(sorted(set(keys)), np.int64)
    files = shards_of(spark, path, keys)
    if not files:
        return spark.createDataFrame([], "doc_id long, ids array<int>")

    def run(batches):
        for b in batches:
            for raw in b.column(0):
                shard = Shard(raw.as_py())
                entry = shard.find(want)
                hit = [(int(k), shard.tokens(e).tolist()) for k, e in zip(want, entry) if e >= 0 and shard.entries[e, 0] == k]
                yield common.batch(pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]), [k for k, _ in hit], [i for _, i in hit])

    common.small_batches(spark)
    found = spark.read.format("binaryFile").load(files).select("content").mapInArrow(run, "doc_id long, ids array<int>")
    return found.groupBy("doc_id").agg(F.first("ids").alias("ids"))


def fetch(spark: SparkSession, path: str, key: int) -> list[int] | None:
    """The ids of one document, by ranged reads of its shard: the header, the tables before the payload, then its ids. None if no shard has the key."""
    for file in shards_of(spark, path, [key]):
        head = common.ranged(spark, file, 0, struct.calcsize(HEAD))
        _, _, _, width, n, slots, levels = struct.unpack(HEAD, head)
        payload = len(head) + 32 * n + 16 * slots + levels
        tables = Shard(head + common.ranged(spark, file, len(head), payload - len(head)), payload=False)
        entry = int(tables.find(np.array([key], np.int64))[0])
        if entry >= 0 and tables.entries[entry, 0] == key:
            _, _, start, size = tables.entries[entry].tolist()
            return np.frombuffer(common.ranged(spark, file, payload + start * width, size * width), f"<u{width}").tolist()
    return None


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = common.fresh_path(spark, "tokens")
    write(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    rows = common.written(read(spark, path), "token-rows")
    shards = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    # prefix sums of whole parts first (a row for each range partition), then within each part
    parts = shards.groupBy("part").agg(F.sum("n").alias("all"))
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before_part"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n")
    bases = shards.join(parts, "part").select("part", "number", (F.col("before_part") + inside).alias("base"))
    return rows.join(bases, ["part", "number"]).select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
