"""What the text operators share: reading, storing between steps, components of a graph."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.sources.scratch import scratch_path

#: Most bytes of a batch of rows on its way to Python.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Lower-cases A-Z only; all other characters stay.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: its lineage ends there.

    A lost executor then costs a re-read, not the steps before.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that what is made of the texts of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_batches(spark: SparkSession) -> None:
    """From now on rows of this session go to Python ``BATCH_BYTES`` at a time at most; a bound that was set stays.

    Else a batch may have 64 MB. The executor holds it twice while its vectors grow and the worker
    twice while it reads the next one, and each task does so.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return row[0], row[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of an undirected graph.

    ``edges`` has columns ``a`` and ``b`` (bigint). Returns ``node`` and ``component`` for
    every node that is not the smallest of its own component. Alternates two rewirings:
    each node points its larger neighbours to its smallest neighbour (large star), then its
    smaller neighbours and itself (small star), until only stars are left. Rounds grow with
    the logarithm of the graph's diameter, and no step adds edges. Nodes of many edges are
    only ever reduced to a minimum (merged before the shuffle) and joined, never collected.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(pairs.distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").where("b <> m")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        now = stored(moved.union(own).distinct(), "edges")
        if (new := _mark(now)) == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
