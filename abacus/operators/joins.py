"""Joins: dimension lookups, and the skew-safe split expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.operators.cobuckets import CoBuckets


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left",
           dim_key_as: str | None = None) -> DataFrame:
    """Left-join a dimension onto a fact table, keyed ``fact_key = dim_key``.

    ``dim`` columns other than the key keep their names; the key is dropped unless
    it shares the fact key's name, or ``dim_key_as`` names a copy to keep (NULL
    where the lookup missed). No hint: the planner broadcasts the dimension by its size in
    bytes, before the run or (AQE) once it is measured. If the fact side has a hot key and
    the dimension is too big to broadcast, AQE splits the hot partition of the (preserved)
    fact side.
    """
    if dim_key_as:
        dim = dim.withColumn(dim_key_as, F.col(dim_key))
    if fact_key == dim_key:
        return fact.join(dim, on=fact_key, how=how)
    joined = fact.join(dim, fact[fact_key] == dim[dim_key], how)
    return joined.drop(dim[dim_key])


def split_expand(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                 overrides: dict[str, str], carry: Sequence[str] = (),
                 child_id: tuple[str, str] | None = None) -> DataFrame:
    """Replace each parent that has children by one row per child.

    Same rows as ``parents LEFT JOIN children`` followed by
    ``coalesce(child.x, parent.x)`` for every ``overrides`` pair
    ``{output_name: child_column}`` (the parent column has the output name).
    ``carry`` lists parent-only columns kept as they are; ``child_id`` is
    ``(child_column, output_name)`` for the child's own id (NULL for a lone parent).

    Written as inner join UNION ALL anti join rather than a left join: a parent with a
    huge number of children (a hot key) sits on the *inner* side of the inner join,
    which adaptive skew handling can split, whereas a left outer join cannot split
    its right side. The anti join reads only distinct child keys, pre-aggregated
    before the shuffle, so a hot key costs one row per map task there.
    """
    expand = _Expansion(parent_key, child_key, overrides, carry, child_id)
    # Both arms read the same rows of the same columns, so the parents are scanned and exchanged once.
    p = expand.parents(parents.where(F.col(parent_key).isNotNull()))
    c = expand.children(children)
    matched = expand.matched(c.join(p, c["__parent"] == p[parent_key], "inner"), p)
    with_children = children.select(F.col(child_key).alias("__parent")).distinct()
    lone = p.join(with_children, p[parent_key] == with_children["__parent"], "left_anti")
    unnamed = expand.parents(parents.where(F.col(parent_key).isNull()))
    return matched.unionByName(expand.lone(lone, children)).unionByName(expand.lone(unnamed, children))


def expand_cobucketed(stored: CoBuckets, parent_key: str, child_key: str, overrides: dict[str, str],
                      carry: Sequence[str] = (), child_id: tuple[str, str] | None = None) -> DataFrame:
    """``split_expand`` over ``cobuckets.write_cobucketed`` tables: both joins run inside the buckets.

    A child meets the copy of its parent that has its salt. A parent with several copies has
    children for sure, so the lone parents are among those with one.
    """
    expand = _Expansion(parent_key, child_key, overrides, carry, child_id)
    p = expand.parents(stored.parents, stored.salt, stored.salts)
    c = expand.children(stored.children, stored.salt)
    matched = expand.matched(c.join(p, (c["__parent"] == p[parent_key]) & (c[stored.salt] == p[stored.salt]), "inner"), p)
    keys = stored.children.select(F.col(child_key).alias("__parent"), F.col(stored.salt).alias("__child_salt")).distinct()
    single = p.where(F.col(stored.salts) == 1)
    lone = single.join(keys, (single[parent_key] == keys["__parent"]) & (single[stored.salt] == keys["__child_salt"]), "left_anti")
    return matched.unionByName(expand.lone(lone, stored.children))


class _Expansion:
    """The columns of a split expansion's inputs and output."""

    def __init__(self, parent_key: str, child_key: str, overrides: dict[str, str], carry: Sequence[str],
                 child_id: tuple[str, str] | None):
        self.keep, self.child_key, self.overrides, self.child_id = [parent_key, *carry], child_key, overrides, child_id

    def parents(self, df: DataFrame, *more: str) -> DataFrame:
        # In the table's own order, in which the optimizer prunes both arms, so that they share an exchange.
        wanted = {*self.keep, *self.overrides, *more}
        return df.select(*[c for c in df.columns if c in wanted])

    def children(self, df: DataFrame, *more: str) -> DataFrame:
        return df.select(F.col(self.child_key).alias("__parent"),
                         *[F.col(src).alias(f"__child_{name}") for name, src in self.overrides.items()],
                         *([F.col(self.child_id[0]).alias("__child_id")] if self.child_id else []), *more)

    def matched(self, joined: DataFrame, p: DataFrame) -> DataFrame:
        return joined.select(*[p[k] for k in self.keep],
                             *[F.coalesce(F.col(f"__child_{name}"), p[name]).alias(name) for name in self.overrides],
                             *([F.col("__child_id").alias(self.child_id[1])] if self.child_id else []))

    def lone(self, df: DataFrame, children: DataFrame) -> DataFrame:
        return df.select(*self.keep, *self.overrides,
                         *([F.lit(None).cast(children.schema[self.child_id[0]].dataType).alias(self.child_id[1])]
                           if self.child_id else []))
