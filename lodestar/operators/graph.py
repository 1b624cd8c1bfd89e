"""Connected components of an edge table, by hooking to the smallest neighbour, pointer jumping and contraction."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _saved(df: DataFrame, root: str, made: list[str] | None = None) -> DataFrame:
    path = f"{root}/labels-{uuid.uuid4().hex}"
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def component_ids(edges: DataFrame, root: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node of an edge; component is the smallest node that can be reached.

    Null ends and loops are ignored. In each turn a node points to the smallest of itself and its neighbours; pointers are doubled until they end in
    roots (a round a doubling); then the edges are drawn between roots. A root is the smallest of its neighbourhood, so a turn leaves at most half of the nodes, and the rounds of a
    turn grow with the logarithm of its longest chain of pointers. Each round is written under root, a folder that all executors share, so neither the lineage nor a lost
    executor matters; what later rounds don't read is removed.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    made: list[str] = []
    both = _saved(pairs.union(pairs.select("b", "a")).toDF("a", "b").distinct(), root, made)
    labels = None
    while True:
        up = _saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up")), root, made)
        while True:
            far = up.select(F.col("node").alias("up"), F.col("up").alias("far"))
            after = _saved(up.join(far, "up").select("node", F.col("far").alias("up"), (F.col("far") < F.col("up")).alias("moved")), root, made)
            up = after.select("node", "up")
            if not after.where("moved").limit(1).count():
                break
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))
        else:
            on = up.select(F.col("node").alias("component"), "up")
            labels = labels.join(on, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        labels = _saved(labels, root, made)
        a, b = up.select(F.col("node").alias("a"), F.col("up").alias("ra")), up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        both = _saved(both.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), root, made)
        done = not both.limit(1).count()
        old, made = (made[:-2] + made[-1:], made[-2:-1]) if done else (made[:-2], made[-2:])
        for path in old:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        if done:
            return labels
