"""Shards of near-equal bytes by Karmarkar-Karp differencing over indivisible groups.

A group is all rows of one text; it goes to one shard whole, so shards stay free of each
other's copies. A partial partition is a tuple of part sums. The two with the largest spread
are combined again and again, the largest part of one with the smallest of the other, until
one is left; walking back down the combinations gives each group its part.

Millions of groups are differenced in levels: groups are dealt to nodes of bounded size, each
node differences its groups into BUNDLES near-equal bundles, and the bundles are the groups
of the next level. A group that could tip the balance (a NODE-th of all bytes or more, so at
most NODE of them) skips the levels. The last combination holds at most 2 * NODE items at any
input size, and up to NODE groups it is plain Karmarkar-Karp over all of them.

Rows are written to ``rows/shard=N`` as Parquet. A slot is a row's place in its shard: the
manifest gives the first slot of every file, and the row's place in the file does the rest.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacus.llm._store import by_run, grouped, written

SHARDS = 16
# Groups that one task differences at once (hashed to nodes that are half full on average).
NODE = 4096
# Parts that a node's groups are differenced into.
BUNDLES = 128


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part, 0 to ``parts - 1``, of each size by the largest differencing method.

    Ties of spread go to the older partial partition, so the result depends on the order of
    ``sizes`` alone.
    """
    n = len(sizes)
    if parts == 1 or not n:
        return np.zeros(n, np.int64)
    sums = {}
    for i, size in enumerate(np.asarray(sizes, np.int64)):
        sums[i] = np.zeros(parts, np.int64)
        sums[i][0] = size
    heap = [(-int(s[0]), i) for i, s in sums.items()]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        node = n + len(made)
        made.append((a, b, order))
        sums[node] = both[order] - both[order[-1]]
        heapq.heappush(heap, (-int(sums[node][0]), node))
    # Where each part of a partial partition ends up, from the last one back to the sizes.
    out = np.zeros(n, np.int64)
    place = {heap[0][1]: np.arange(parts)}
    for node in range(n + len(made) - 1, n - 1, -1):
        a, b, order = made[node - n]
        own = np.empty(parts, np.int64)
        own[order] = place.pop(node)
        for child, at in ((a, own), (b, own[::-1])):
            if child < n:
                out[child] = at[0]
            else:
                place[child] = at
    if n == 1:
        out[0] = 0
    return out


def _parts(items: pa.Table, parts: int) -> np.ndarray:
    """The part of each item; larger items first and equal ones by key, whatever order they came in."""
    sizes = items["bytes"].to_numpy()
    keys = np.array(items["key"].to_pylist(), dtype=object)
    order = np.array(sorted(range(len(sizes)), key=lambda i: (-sizes[i], keys[i])), np.int64)
    out = np.empty(len(sizes), np.int64)
    out[order] = difference(sizes[order], parts)
    return out


def assign(groups: DataFrame, shards: int = SHARDS, node: int = NODE, bundles: int = BUNDLES) -> DataFrame:
    """(key, shard) of each row of ``groups`` (key binary, bytes long; keys of 32 bytes, all distinct)."""
    items, steps = groups, []
    while True:
        total = items.agg(F.sum("bytes")).first()[0] or 0
        heavy = F.col("bytes") >= total / node
        light = items.where(~heavy)
        count = light.count()
        if count <= node:
            break
        level, nodes = len(steps), -(-2 * count // node)

        def bundle(table: pa.Table, level: int = level) -> pa.Table:
            at, part = table["node"][0].as_py(), _parts(table, bundles)
            return pa.table({"key": table["key"], "bytes": table["bytes"],
                             "parent": pa.array([f"{level}.{at}.{p}".encode() for p in part.tolist()], pa.binary())})

        dealt = written(by_run(light.withColumn("node", F.pmod(F.xxhash64("key"), F.lit(nodes))), ["node"], bundle,
                               "key binary, bytes long, parent binary"), "shard-bundles")
        steps.append(dealt.select("key", "parent"))
        made = dealt.groupBy(F.col("parent").alias("key")).agg(F.sum("bytes").alias("bytes"))
        items = written(items.where(heavy).unionByName(made), "shard-items")

    def last(table: pa.Table) -> pa.Table:
        return pa.table({"key": table["key"], "shard": pa.array(_parts(table, shards), pa.int32())})

    placed = written(by_run(items.withColumn("node", F.lit(0)), ["node"], last, "key binary, shard int"), "shard-placed")
    for dealt in reversed(steps):
        below = dealt.join(placed.withColumnRenamed("key", "parent"), "parent").select("key", "shard")
        placed = written(below.unionByName(placed), "shard-placed")
    return placed


def size_of(text: F.Column) -> F.Column:
    """UTF-8 bytes of a text (a null has none) and one more for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text_col: str = "text", node: int = NODE,
                 bundles: int = BUNDLES) -> None:
    """Write every row of ``docs`` to ``{path}/rows/shard=N``, and the manifest of the files.

    Every row is kept with all its columns, as a struct ``row`` (so no column's name clashes).
    Nulls and empty texts are one group; repeated rows are rows of one group. An empty table
    gives an empty dataset. A group larger than a shard's share fills its shard alone, as far
    as the other groups allow. The texts are shuffled once; a hot group's rows are split
    between tasks by the adaptive join, as each is joined to one row. Each task writes a file
    a shard.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.struct("*").alias("row"), F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("key"),
                        size_of(text).alias("size"))
    groups = written(grouped(keyed.select("key", "size"), "key").agg(F.sum("size").alias("bytes")).drop("__deal"), "shard-groups")
    placed = assign(groups, shards, node, bundles)
    rows = keyed.join(placed.hint("shuffle_hash"), "key").select("row", "size", "shard")
    rows.write.partitionBy("shard").parquet(f"{path}/rows")
    spark.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    files = read_rows(spark, path).groupBy("shard", "file").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"))
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("first_slot", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).write.parquet(f"{path}/manifest")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row, size, shard, file, place): each row with its shard, its file and its place there."""
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{path}/rows").select(
        "row", "size", "shard", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))


def with_slots(rows: DataFrame, path: str) -> DataFrame:
    """Columns of ``read_rows`` (narrowed at will, with shard, file and place) and the row's ``slot`` in its shard."""
    manifest = rows.sparkSession.read.parquet(f"{path}/manifest").select("shard", "file", "first_slot")
    return rows.join(manifest, ["shard", "file"]).withColumn("slot", F.col("first_slot") + F.col("place")).drop(
        "first_slot", "place", "file")
