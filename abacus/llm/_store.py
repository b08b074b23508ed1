"""Intermediate tables in the shared checkpoint folder, and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacus.session import scratch_path


BATCH_ROWS = 1000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder that all executors share, and read it back.

    Cuts the lineage: a lost executor recomputes nothing before this point.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value of bounded size; the result gives it inside tasks, unpacked once each."""
    sent, kept = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get():
        if not kept:
            kept.append(pickle.loads(sent.value))
        return kept[0]

    return get


def release() -> None:
    """Hand freed memory back to the system: workers are used again and would keep a task's peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(work: Callable) -> Callable:
    """A mapInArrow function that ends with ``release``."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release()

    return run


def bounded_batches(spark: SparkSession) -> None:
    """Send at most BATCH_ROWS rows to Python at once: texts may be long. Holds for the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def by_run(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table], schema: str,
           least: int = 1) -> DataFrame:
    """``work`` on the rows of each key, which the caller keeps to a bounded number.

    Keys are hashed to partitions, sorted, and streamed: a task holds one key's rows at a time,
    or those of as many keys in a row as give ``least`` rows.
    """

    def run(batches):
        held = None

        def parts(table, last):
            table = table.combine_chunks()
            change = np.zeros(max(table.num_rows - 1, 0), bool)
            for k in keys:
                column = table[k].to_numpy()
                change |= column[1:] != column[:-1]
            start = 0
            for end in [*(np.flatnonzero(change) + 1).tolist(), *[table.num_rows] * last]:
                if end - start >= least or end == table.num_rows:
                    done = work(table.slice(start, end - start))
                    start = end
                    if done is not None and done.num_rows:
                        yield from done.to_batches()
            return None if last else table.slice(start)

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                held = yield from parts(table if held is None else pa.concat_tables([held, table]), False)
        if held is not None:
            yield from parts(held, True)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(released(run), schema)


def grouped(df: DataFrame, *keys: str):
    """Like groupBy, with one more key that the others give (drop ``__deal`` afterwards).

    The result is not dealt by ``keys``, so a join on them shuffles it on its own account, and
    the adaptive join can split a hot key of its other side.
    """
    return df.groupBy(*keys, F.xxhash64(*keys).alias("__deal"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for nodes with links.

    ``edges`` has long columns a and b. Alternates two steps until nothing changes: every
    node sends the smallest neighbour it knows to its larger neighbours, then to its smaller
    ones. Each round is a minimum per node (summed before it shuffles) and a join; a node
    with very many links is split by the adaptive join and never gathered.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = grouped(both, "a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = (both.join(low, both.a == low.node).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        lowest = grouped(large, "a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
        small = (large.join(lowest, large.a == lowest.node).select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        after = written(small, "edges")
        same = (edges.withColumn("side", F.lit(1)).unionByName(after.withColumn("side", F.lit(-1)))
                .groupBy("a", "b").agg(F.sum("side").alias("d")).where("d <> 0").isEmpty())
        edges = after
        if same:
            break
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(pairs.select(F.col("component").alias("node"), "component").distinct())
