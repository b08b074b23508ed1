"""Near-duplicate embeddings: a forest of random-projection trees with spill overlap.

Equal vectors of one label are one class. Trees are fitted on a bounded sample of classes:
each node splits at the median of a random projection, and vectors near the split go to both
sides. Every class is then indexed in every tree, compared with the others of its leaf and
label, and each pair is counted in the first leaf the two share, so counts add up without
a list of pairs. The sample bounds the trees that are fitted on the driver, not the depth:
a leaf that holds too many rows is split on by Spark, level by level, at the median of all
its rows, so leaves stay bounded at any size of the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import by_run, components, grouped, share, written

THRESHOLD = 0.98
TREES = 6
# At most about so many classes train the trees, and a leaf holds about so many of them.
SAMPLE = 20_000
LEAF = 256
# A leaf beyond this many rows is compared block against block.
BLOCK = 1024
# Vectors within this many typical projected distances of a split go to both sides.
SPILL = 0.6
SEED = 5
# A leaf's code is its level below the sampled tree, then tree, sampled leaf and sides taken.
LEVEL_BITS, TREE_BITS, LEVELS = 48, 24, 20
# Marks a leaf that no split would make much smaller.
WHOLE = 1 << 60


@dataclass
class Tree:
    directions: np.ndarray  # a row per inner node
    cuts: np.ndarray
    children: np.ndarray  # of each inner node, left and right: an inner node, or -1 - leaf
    leaves: int


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def spill_width(dim: int, threshold: float) -> float:
    return SPILL * float(np.sqrt(2 * (1 - threshold) / dim))


def fit_tree(sample: np.ndarray, rng: np.random.Generator, width: float, leaf: int = LEAF) -> Tree:
    directions, cuts, children, leaves = [], [], [], 0

    def grow(rows: np.ndarray, depth: int) -> int:
        nonlocal leaves
        if len(rows) > leaf and depth < 32:
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.sqrt((direction ** 2).sum())
            place = sample[rows] @ direction
            cut = float(np.median(place))
            left, right = rows[place <= cut + width], rows[place > cut - width]
            if max(len(left), len(right)) <= 0.9 * len(rows):
                node = len(cuts)
                directions.append(direction)
                cuts.append(cut)
                children.append([0, 0])
                children[node] = [grow(left, depth + 1), grow(right, depth + 1)]
                return node
        leaves += 1
        return -leaves

    root = grow(np.arange(len(sample)), 0)
    if root < 0:
        return Tree(np.zeros((0, sample.shape[1])), np.zeros(0), np.zeros((0, 2), np.int64), 1)
    return Tree(np.array(directions), np.array(cuts), np.array(children), leaves)


def leaves_of(tree: Tree, vectors: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that every vector falls into."""
    if not len(tree.cuts):
        return np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    rows, leaves, todo = [], [], [(0, np.arange(len(vectors)))]
    while todo:
        node, own = todo.pop()
        if node < 0:
            rows.append(own)
            leaves.append(np.full(len(own), -1 - node))
        elif len(own):
            place = vectors[own] @ tree.directions[node]
            todo.append((int(tree.children[node][0]), own[place <= tree.cuts[node] + width]))
            todo.append((int(tree.children[node][1]), own[place > tree.cuts[node] - width]))
    return np.concatenate(rows), np.concatenate(leaves)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def fit(sample: dict[int, np.ndarray], threshold: float, trees: int = TREES, leaf: int = LEAF,
        seed: int = SEED) -> dict[int, list[Tree]]:
    """Trees for each dimension that the sample has."""
    out = {}
    for dim, vectors in sorted(sample.items()):
        rng = np.random.default_rng([seed, dim])
        out[dim] = [fit_tree(unit(vectors), rng, spill_width(dim, threshold), leaf) for _ in range(trees)]
    return out


def _split_further(indexed: DataFrame, threshold: float, trees: int, most: int) -> DataFrame:
    """``indexed`` with every leaf of more than ``most`` rows split again and again.

    Each level has one random direction a tree. A leaf is cut at the median that Spark aggregates
    over all its rows, with spill as in the sampled trees. A leaf whose larger side would keep
    nine tenths of the rows stays as it is and is compared block against block.
    """
    leaf_of, row_of = ["dim", "label", "code"], ["dim", "label", "rep", "vector"]
    for level in range(LEVELS):
        codes = indexed.select("dim", "label", F.explode("codes").alias("code")).where(
            F.shiftright("code", LEVEL_BITS) == level)
        large = written(grouped(codes, *leaf_of).count().where(F.col("count") > most).drop("count", "__deal"), "embedding-large")
        if large.isEmpty():
            return indexed

        def project(batches, level=level):
            directions = {}
            for batch in batches:
                dims, data = batch["dim"].to_numpy(), pa.Table.from_batches([batch])
                for dim in np.unique(dims).tolist():
                    if dim not in directions:
                        found = np.random.default_rng([SEED, dim, level]).standard_normal((dim, trees))
                        directions[dim] = found / np.sqrt((found ** 2).sum(axis=0))
                    part = data.take(pa.array(np.flatnonzero(dims == dim)))
                    places = unit(_matrix(part["embedding"], dim)) @ directions[dim]
                    lists = part["codes"].combine_chunks()
                    row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                    code = lists.flatten().to_numpy()
                    own = code >> LEVEL_BITS == level
                    row, code = row[own], code[own]
                    tree = (code & (1 << LEVEL_BITS) - 1) >> TREE_BITS + level
                    out = part.select(row_of).take(pa.array(row))
                    yield from (out.append_column("code", pa.array(code, pa.int64()))
                                .append_column("place", pa.array(places[row, tree], pa.float64())).to_batches())

        placed = written(indexed.select(*row_of, "embedding", "codes")
                         .mapInArrow(project, "dim int, label string, rep long, vector long, code long, place double")
                         .join(large, leaf_of), "embedding-places")
        cuts = (grouped(placed, *leaf_of).agg(F.percentile_approx("place", [0.1, 0.5, 0.9], 1000).alias("at")).drop("__deal"))
        width = F.lit(SPILL) * F.sqrt(F.lit(2 * (1 - threshold)) / F.col("dim"))
        cut, place = F.col("at")[1], F.col("place")
        path = F.lit((level + 1) << LEVEL_BITS) + F.col("code").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)) * 2
        sides = F.array_compact(F.array(F.when(place <= cut + width, path), F.when(place > cut - width, path + 1)))
        splits = (F.col("at")[2] > cut + width) & (F.col("at")[0] <= cut - width)
        moved = (placed.join(cuts, leaf_of)
                 .withColumn("to", F.when(splits, sides).otherwise(F.array(F.col("code") + F.lit(WHOLE))))
                 .groupBy(*row_of).agg(F.collect_set("code").alias("gone"), F.flatten(F.collect_set("to")).alias("more")))
        none = F.array().cast("array<bigint>")
        indexed = written(indexed.join(moved, row_of, "left").withColumn("codes", F.array_union(
            F.array_except("codes", F.coalesce("gone", none)), F.coalesce("more", none))).drop("gone", "more"), "embedding-leaves")
    return indexed


def _compare(group: pa.Table, threshold: float) -> pa.Table:
    """Links between the rows of one pair of blocks of one leaf, counted only in their first leaf."""
    dim = group["dim"][0].as_py()
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    code = group["code"][0].as_py()
    block, reps = group["block"].to_numpy(), group["rep"].to_numpy()
    copies, vectors = group["copies"].to_numpy(), unit(_matrix(group["embedding"], dim))
    linked = vectors @ vectors.T >= threshold
    np.fill_diagonal(linked, False)
    if low != high:  # pairs inside one block belong to another group
        linked &= block[:, None] != block[None, :]
    near = np.flatnonzero(linked.any(axis=1))
    if not len(near):
        return None
    linked, reps, copies = linked[np.ix_(near, near)], reps[near], copies[near]
    codes = group["codes"].take(pa.array(near)).combine_chunks()
    flat, owner = codes.flatten().to_numpy(), np.repeat(np.arange(len(near)), np.diff(codes.offsets.to_numpy()))
    earlier = flat < code
    for other in np.unique(flat[earlier]):
        inside = np.zeros(len(near), bool)
        inside[owner[earlier & (flat == other)]] = True
        linked[np.ix_(inside, inside)] = False
    # Links that span the group's connected rows: each to the smallest id reached.
    least = reps.copy()
    while True:
        lower = np.minimum(least, np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == least).all():
            break
        least = lower
    some = linked.any(axis=1)
    return pa.table({"rep": reps[some], "links": (linked * copies[None, :]).sum(axis=1)[some], "least": least[some]})


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, sample: int = SAMPLE,
                    leaf: int = LEAF, block: int = BLOCK, most: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept), a row per row of ``embeddings``.

    Rows link when their labels are equal and not null and their cosine is at least
    ``threshold`` in double precision; vectors of different lengths never link. Null or zero
    vectors, vectors with null or non-finite components and rows without an id have no links
    and are their own component. Every row counts: a repeated row is a linked copy. An empty
    table gives an empty one; other columns are ignored. Leaves of more than ``most`` rows (twice
    ``block``) are split further.
    """
    spark = embeddings.sparkSession
    element = embeddings.schema[vector_col].dataType.elementType.simpleString()
    # Floats stay as they are; any other numbers are compared as doubles.
    vector = "array<float>" if element == "float" else "array<double>"
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(vector).alias("embedding"),
                             F.col(label_col).cast("string").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite
                      & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = written(rows.where(good).groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
                      .withColumn("dim", F.size("embedding")), "embedding-classes")

    count = classes.count()
    share_of = min(1.0, sample / max(count, 1))
    picked = classes.where(F.pmod(F.xxhash64("rep", "label"), F.lit(1 << 30)) <= share_of * (1 << 30)).select("dim", "embedding")
    found: dict[int, list] = {}
    for row in picked.orderBy(F.hash("embedding")).limit(2 * sample).toLocalIterator():
        found.setdefault(row["dim"], []).append(row["embedding"])
    forest = share(spark, fit({d: np.array(v, np.float64) for d, v in found.items()}, threshold, trees, leaf))

    def index(batches):
        for batch in batches:
            dims, data = batch["dim"].to_numpy(), pa.Table.from_batches([batch])
            for dim in np.unique(dims):
                part = data.take(pa.array(np.flatnonzero(dims == dim)))
                vectors = unit(_matrix(part["embedding"], int(dim)))
                width, rows, codes = spill_width(int(dim), threshold), [], []
                for t, tree in enumerate(forest().get(int(dim), [])):
                    row, own = leaves_of(tree, vectors, width)
                    rows.append(row)
                    codes.append(own + (t << TREE_BITS))
                if not rows:  # a dimension that the sample lacks: trees of one leaf
                    rows = [np.arange(part.num_rows)] * trees
                    codes = [np.full(part.num_rows, t << TREE_BITS) for t in range(trees)]
                row, code = np.concatenate(rows), np.concatenate(codes)
                order = np.lexsort((code, row))
                offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=part.num_rows))))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(code[order], pa.int64()))
                yield from part.append_column("codes", lists).select(
                    ["label", "embedding", "rep", "copies", "dim", "vector", "codes"]).to_batches()

    indexed = written(classes.select("label", "embedding", "rep", "copies", "dim", F.xxhash64("embedding").alias("vector")).mapInArrow(
        index, f"label string, embedding {vector}, rep long, copies long, dim int, vector long, codes array<long>"), "embedding-leaves")
    indexed = _split_further(indexed, threshold, trees, most or 2 * block)
    leaf_of = ["dim", "label", "code"]
    sizes = (grouped(indexed.select("dim", "label", F.explode("codes").alias("code")), *leaf_of).count().where("count > 1")
             .withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count", "__deal"))
    placed = (indexed.drop("vector").withColumn("code", F.explode("codes")).join(sizes, leaf_of)
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other"))
    links = written(by_run(placed, [*leaf_of, "low", "high"], lambda g: _compare(g, threshold),
                           "rep long, links long, least long"), "embedding-links")

    own = links.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(spark, links.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    judged = (classes.select("label", "embedding", "rep", "copies").join(own, "rep", "left")
              .join(reached, F.col("rep") == F.col("node"), "left")
              .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    linked = rows.where(good).join(judged, ["label", "embedding"])
    alone = rows.where(~good).withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("id"))
    columns = [F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")]
    return linked.select(*columns).unionByName(alone.select(*columns))
