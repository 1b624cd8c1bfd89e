"""What the operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import uuid
from contextlib import contextmanager
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that separate words in every contract: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set it is a temporary one, on a local master only, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = sys.__dict__.setdefault("_lodestar_shared", None) or "file://" + tempfile.mkdtemp(prefix="lodestar-")
        sys._lodestar_shared = path
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder; see ``scratch`` for what removes it."""
    path = f"{shared_dir(spark)}/lodestar/{name}-{uuid.uuid4().hex}"
    for made in sys.__dict__.setdefault("_lodestar_scratch", []):
        made.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """Removes the folders made inside, but for those whose path is put in the set that it gives: what later plans still read."""
    stack, made, keep = sys.__dict__.setdefault("_lodestar_scratch", []), [], set()
    stack.append(made)
    try:
        yield keep
    finally:
        stack.pop()
        for path in made:
            if path not in keep:
                remove(spark, path)


def ranged(spark: SparkSession, path: str, start: int, length: int) -> bytes:
    """Some bytes of a file in any store that Spark reaches, without the others."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        stream.seek(start)
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def set_aside(df: DataFrame, *names: str) -> DataFrame:
    """df's rows as one struct ``_row`` and some of its columns beside it, so that no name that an operator adds clashes with the caller's."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), *[quoted(n).alias(n) for n in names])


def put_back(df: DataFrame, columns: list[str], *more) -> DataFrame:
    """The caller's columns, then more."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns], *more)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and outlives any executor."""
    return written_at(df, fresh_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes, however long the texts are. Every operator sets these same two values, so that no plan made earlier is changed by a later one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, tidy: bool = False) -> DataFrame:
    """df through fn; with ``tidy``, a worker gives memory back after each task, at some CPU time for taking it again."""
    small_batches(df.sparkSession)
    if not tidy:
        return df.mapInArrow(fn, schema)

    def run(batches):
        yield from fn(batches)
        let_go()

    return df.mapInArrow(run, schema)


def let_go() -> None:
    """Gives freed memory back to the system: between tasks a worker waits beside the JVM, whose memory counts with its own."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def worker_cache(owner: str, key, build: Callable, version: str = ""):
    """build(), once per process and version (the last is kept): functions travel by value, so module globals would not last.

    A worker keeps what one owner (an operator) needs; the next owner's first call lets go of it.
    """
    kept = sys.__dict__.setdefault("_lodestar_cache", {})
    if owner not in kept:
        kept.clear()
        let_go()
        kept[owner] = {}
    own = kept[owner]
    if key not in own or own[key][0] != version:
        own[key] = version, build()
    return own[key][1]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a null text as the empty one, whatever else df has."""
    return df.select(F.col(id_col).cast(T.LongType()).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def freeze(rows) -> bytes:
    import pickle

    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(rows, 5))


def thaw(blob: bytes):
    import pickle

    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
