"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                   method: str = "aggregate") -> DataFrame:
    """Keep the row with the greatest ``order_desc`` tuple for each key.

    ``method='aggregate'`` (default) is ``max_by(struct(row), struct(order))``: a
    partial aggregate, so every task first reduces its own rows and a key holding a
    third of all rows never has to be gathered or sorted in one task.
    ``method='window'`` is the textbook ``row_number() = 1`` form (sorts each key's
    whole group in one task). NULLs in the ordering sort lowest, as in
    ``ORDER BY ... DESC NULLS LAST``. Ties go to an arbitrary row in both forms.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_desc])
        return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    if not rest:
        return df.select(*keys).distinct()
    best = F.max_by(F.struct(*rest), F.struct(*order_desc)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])
