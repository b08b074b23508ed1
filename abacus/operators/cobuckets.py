"""Parents and children stored in the same buckets, hot parents dealt over several of them.

Both tables are bucketed by (parent key, salt) with one file a bucket, so they join without an
exchange. The salt of a child is 0 unless its parent is hot, that is has more children than a
quarter of a bucket's even share. There are at most four times as many of those as
buckets. A hot parent's children are dealt over as many salts as their number asks for, and
the parent's row is stored once for each, so a parent with a third of all children is spread over
many buckets and each child still meets its parent exactly once.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A parent is hot beyond this part of a bucket's even share of the children.
HOT_SHARE = 4


@dataclass(frozen=True)
class CoBuckets:
    """Two bucketed tables; ``salts`` of a parent's row is the number of its copies."""

    parents: DataFrame
    children: DataFrame
    salt: str = "__salt"
    salts: str = "__salts"


def write_cobucketed(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, buckets: int,
                     path: str) -> CoBuckets:
    """Store both tables under ``path`` as tables of the session catalog.

    One pass counts the children of each parent; only the hot parents' counts, at most
    ``HOT_SHARE * buckets`` rows, are broadcast. Each table is shuffled once, by the hash that also
    names the bucket, so each task writes one file.
    """
    spark = parents.sparkSession
    counts = children.groupBy(F.col(child_key).alias("__key")).count()
    counts.write.parquet(os.path.join(path, "counts"))
    counts = spark.read.parquet(os.path.join(path, "counts")).where("__key is not null")
    share = max((counts.agg(F.sum("count")).first()[0] or 0) / (HOT_SHARE * buckets), 1)
    hot = F.broadcast(counts.where(F.col("count") > share).select("__key", F.ceil(F.col("count") / share).cast("int").alias("__salts")))

    def known(df: DataFrame, key: str) -> DataFrame:
        return (df.join(hot, F.col(key) == F.col("__key"), "left").drop("__key")
                .withColumn("__salts", F.coalesce("__salts", F.lit(1))))

    # Which copy a child meets does not matter; equal children may share one.
    dealt = known(children, child_key).withColumn(
        "__salt", F.pmod(F.xxhash64(*children.columns), F.col("__salts")).cast("int")).drop("__salts")
    copied = known(parents, parent_key).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    name = "abacus_" + uuid.uuid4().hex[:12]

    def store(df: DataFrame, key: str, side: str) -> DataFrame:
        (df.repartition(buckets, F.col(key), F.col("__salt")).write.bucketBy(buckets, key, "__salt").sortBy(key, "__salt")
         .option("path", os.path.join(path, side)).saveAsTable(f"{name}_{side}"))
        return spark.table(f"{name}_{side}")

    return CoBuckets(store(copied, parent_key, "parents"), store(dealt, child_key, "children"))
