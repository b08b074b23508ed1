"""Row positions in a global order, computed without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(df: DataFrame, order: Sequence[Column], col: str = "position") -> DataFrame:
    """Add the 1-based position of each row in ``order`` (which should be total).

    ``row_number()`` over an unpartitioned window would pull every row into one
    task. Instead the rows are range-partitioned and sorted (``orderBy``), the sorted
    result is checkpointed to the shared checkpoint folder (so both uses below see
    the same partitions and a lost executor cannot reshuffle them), and each
    partition's first position is the running count of the partitions before it: a
    table with one row per partition, joined back.
    """
    from abacus.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    ranked = df.orderBy(*order).withColumns({
        "__part": F.spark_partition_id(), "__pos": F.monotonically_increasing_id()}).checkpoint(eager=True)
    parts = ranked.groupBy("__part").agg(F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    out = ranked.join(offsets.select("__part", "__first", "__offset"), "__part")
    pos = (F.col("__offset") + F.col("__pos") - F.col("__first") + F.lit(1)).cast("bigint")
    return out.withColumn(col, pos).drop("__part", "__pos", "__first", "__offset")
