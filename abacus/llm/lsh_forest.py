"""Near-duplicate join on word n-grams: a MinHash LSH forest, then exact Jaccard.

Texts with the same set of shingles are one class. A class's signature is cut into one string
of minima per tree, and a tree is the trie of these strings. Classes first meet where they share
the whole string in some tree. Then the matched prefixes are shortened by one minimum at a time,
in all trees at once: a node is opened again only if it joins several of its children, and only
pairs of different children that have not met in any tree are compared. Shortening ends when the
least similar pairs met so far meet with the target probability, so the lengths follow the data.
Pairs that met and whose signatures agree enough tie families together; every pair of classes in
a family is then compared on whole shingle sets, block against block, and only counts and
spanning links leave the task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, by_run, components, grouped, released, written
from abacus.llm._text import SPACED, Words, gram_starts, grams, mix, text_slices

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
TREES = 10
DEEPEST = 6
# Signatures of a pair at the threshold agree in fewer places than this slack allows about once in 10,000 times.
SLACK_SIGMAS = 3.7
# Rows of a bucket or family that are compared at once with another block; bytes of sets in a block.
BLOCK = 512
BLOCK_BYTES = 8 << 20
# Minima of two rows that are compared at once.
COMPARED = 4 << 20
SEED = 11


def meeting(similarity: float, length: int, trees: int = TREES) -> float:
    """The probability that a pair of this similarity shares the first ``length`` minima of some tree."""
    return 1 - (1 - similarity ** length) ** trees


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's shingles and how many each row has. Fewer words than ``size``
    make one shingle; no words make none."""
    hashes = words.hashes()
    starts, counts = gram_starts(words.row_first, size)
    out = grams(hashes, size)[starts]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            more = words.count[short] > j
            at = np.where(more, words.row_first[short] + j, 0)
            value = np.where(more, mix(value * np.uint64(31) + hashes[at] + np.uint64(j + 1)), value)
        at = np.concatenate(([0], np.cumsum(counts)))[short]
        out = np.insert(out, at, value)
        counts = counts.copy()
        counts[short] = 1
    return out, counts


def _multipliers(places: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, places, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, places, dtype=np.uint64)


def signatures(values: np.ndarray, counts: np.ndarray, places: int, seed: int = SEED) -> np.ndarray:
    """Minima of ``places`` hash functions over each row's shingles, rows without any left out."""
    starts = np.cumsum(counts[counts > 0]) - counts[counts > 0]
    out = np.zeros((len(starts), places), np.uint32)
    if len(starts):
        for j, (a, b) in enumerate(zip(*_multipliers(places, seed), strict=True)):
            out[:, j] = np.minimum.reduceat(((values * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _sets(column: pa.Array, size: int):
    """For each slice: (first row, sorted distinct shingles of each row)."""
    for first, _, data, offsets in text_slices(column):
        values, counts = shingles(Words(data, offsets, SPACED), size)
        ends = np.cumsum(counts)
        yield first, values, counts, [np.unique(values[e - n:e]) for e, n in zip(ends, counts, strict=True)]


def sketch(docs: DataFrame, places: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, set_key, shingles, sig): key, size and signature of each text's shingle set, nulls without words."""

    def run(batches):
        for batch in batches:
            for first, values, counts, sets in _sets(batch["text"], size):
                sigs = iter(signatures(values, counts, places))
                keys = [hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(first, len(sets)), pa.array(keys, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([next(sigs).tobytes() if k else None for k in keys], pa.binary())],
                    names=["id", "set_key", "shingles", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        released(run), "id long, set_key binary, shingles int, sig binary")


def _spans(reps: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest id that links reach from each row."""
    least = reps.copy()
    while True:
        lower = np.minimum(least, np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == least).all():
            return least
        least = lower


def _across(group: pa.Table, linked: np.ndarray) -> np.ndarray:
    """Only pairs that this group of two blocks is there for."""
    np.fill_diagonal(linked, False)
    if group["low"][0].as_py() != group["high"][0].as_py():
        block = group["block"].to_numpy()
        linked &= block[:, None] != block[None, :]
    return linked


def _tie(group: pa.Table, trees: int, length: int, agree: float) -> pa.Table | None:
    """Ties among the rows of one node, by pairs whose longest common prefix of all trees is of
    this length; such a pair is taken in the first tree where it is."""
    reps, tree = group["rep"].to_numpy(), group["tree"][0].as_py()
    sigs = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(len(reps), trees, -1)
    same, met = np.zeros((len(reps), len(reps)), np.uint16), np.zeros((len(reps), len(reps)), bool)
    step = max(1, COMPARED // sigs.size)
    for i in range(0, len(reps), step):
        equal = sigs[i:i + step, None] == sigs[None]
        same[i:i + step] = equal.reshape(*equal.shape[:2], -1).sum(axis=2, dtype=np.uint16)
        common = np.logical_and.accumulate(equal, axis=3).sum(axis=3, dtype=np.uint8)
        met[i:i + step] = (common.max(axis=2) == length) & (common.argmax(axis=2) == tree)
    linked = _across(group, met & (same >= agree))
    least = _spans(reps, linked)
    tied = least != reps
    if not tied.any():
        return None
    return pa.table({"a": reps[tied], "b": least[tied], "agreed": np.full(int(tied.sum()), same[linked].min(), np.int32)})


def overlaps(sets: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many members each two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    column = np.where(common, np.cumsum(common) - 1, -1)[place]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    cuts = np.searchsorted(column, np.arange(0, int(common.sum()) + width, width))
    for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = np.zeros((len(sets), width), np.float32)
        part[owner[low:high], column[low:high] - i * width] = 1
        out += part @ part.T
    return out


def _verify(group: pa.Table, threshold: float) -> pa.Table | None:
    reps, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in group["members"].to_pylist()]
    sizes = np.array([len(s) for s in sets], np.float64)
    shared = overlaps(sets).astype(np.float64)
    linked = _across(group, shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9)
    some = linked.any(axis=1)
    return pa.table({"rep": reps[some], "links": (linked * copies[None, :]).sum(axis=1)[some],
                     "least": _spans(reps, linked)[some]})


def _pairs_of_blocks(rows: DataFrame, id_col: str) -> DataFrame:
    """Give each row a block of ``blocks`` by its id, and a copy for each pair of blocks it belongs to."""
    return (rows.withColumn("block", F.pmod(F.xxhash64(id_col), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other"))


def _level(classes: DataFrame, trees: int, deepest: int, length: int, agree: float, block: int) -> DataFrame:
    """(a, b, agreed): ties of pairs that meet at nodes ``length`` minima below the roots, and the
    least agreement of the pairs of that node."""

    def node(tree: int, minima: int):
        return F.xxhash64(F.lit(tree), F.substring("sig", 4 * deepest * tree + 1, 4 * minima))

    # Below the deepest nodes are the classes themselves.
    nodes = classes.select("rep", F.explode(F.array(*[
        F.struct(F.lit(t).alias("tree"), node(t, length).alias("node"),
                 (node(t, length + 1) if length < deepest else F.col("rep")).alias("child")) for t in range(trees)])).alias("at")).select("rep", "at.*")
    joining = (grouped(nodes, "node").agg(F.count("*").alias("rows"), F.min("child").alias("low"), F.max("child").alias("high"))
               .where("low <> high").select("node", F.ceil(F.col("rows") / (2 * block)).cast("int").alias("blocks")))
    placed = nodes.drop("child").join(joining, "node").join(classes.select("rep", "sig"), "rep")
    return by_run(_pairs_of_blocks(placed, "rep"), ["node", "low", "high"], lambda g: _tie(g, trees, length, agree),
                  "a long, b long, agreed int")


def forest(classes: DataFrame, threshold: float, recall: float, trees: int = TREES, deepest: int = DEEPEST,
           block: int = BLOCK) -> tuple[DataFrame, int]:
    """Ties (a, b) of the classes (rep, sig), and the prefix length at which shortening ended.

    Recall is judged at the least similarity, by agreeing minima, of the pairs met so far; a pair met
    with less than the threshold may still be a link, so it and a forest without any meeting are
    judged at the threshold. Above the threshold, one more step must meet no weaker pair.
    """
    places = trees * deepest
    agree = threshold * places - SLACK_SIGMAS * (threshold * (1 - threshold) * places) ** 0.5
    ties, weakest = None, None
    for length in range(deepest, 0, -1):
        level = written(_level(classes, trees, deepest, length, agree, block), "forest-ties")
        ties = level if ties is None else ties.unionByName(level)
        least, before = level.agg(F.min("agreed")).first()[0], weakest
        if least is not None:
            weakest = min(max(least / places, threshold), 1.0 if before is None else before)
        judged = threshold if weakest is None else weakest
        if (judged == threshold or judged == before) and meeting(judged, length, trees) >= recall:
            break
    return ties.select("a", "b"), length


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE,
                    trees: int = TREES, deepest: int = DEEPEST, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_links, class_id, kept), a row per row of ``docs``.

    Documents link when the Jaccard similarity of their sets of ``size`` consecutive words
    (between ASCII white space, unchanged) is at least ``threshold``; a text of fewer words has
    the one shingle of all its words. ``n_links`` counts the other documents linked directly,
    copies included; ``class_id`` is the smallest id that links reach. Null and empty texts and
    rows without an id have no links. Repeated rows are linked copies, and rows of one id fall
    in one class. An empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sketched = written(sketch(docs, trees * deepest, size, id_col, text_col), "shingle-sketch")
    classes = written(sketched.where("set_key is not null and id is not null").groupBy("set_key")
                      .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"),
                           F.first("sig").alias("sig")), "shingle-classes")

    ties, _ = forest(classes, threshold, recall, trees, deepest, block)
    families = written(components(spark, ties).withColumnRenamed("node", "rep").withColumnRenamed("component", "family")
                       .join(classes.select("rep", "copies", "shingles"), "rep"), "shingle-families")

    sizes = grouped(families, "family").agg(F.ceil(F.greatest(
        F.count("*") / block, F.sum("shingles") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")).drop("__deal")
    chosen = families.join(sizes, "family").select("rep", "family", "copies", "blocks")

    def members(batches):
        for batch in batches:
            for first, _, counts, sets in _sets(batch["text"], size):
                part = batch.slice(first, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in ("rep", "family", "copies", "blocks")] + [pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["rep", "family", "copies", "blocks", "members"])

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    # The texts are shuffled by id whatever the other side's size, so the work grows evenly.
    sets = texts.join(chosen.hint("merge"), "rep").mapInArrow(released(members), "rep long, family long, copies long, blocks int, members binary")
    links = written(by_run(_pairs_of_blocks(sets, "rep"), ["family", "low", "high"], lambda g: _verify(g, threshold),
                           "rep long, links long, least long"), "shingle-links")

    own = links.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(spark, links.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    judged = (classes.select("set_key", "rep", "copies").join(own, "rep", "left")
              .join(reached, F.col("rep") == F.col("node"), "left")
              .select("set_key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                      F.coalesce("component", "rep").alias("reached")))
    found = sketched.select("id", F.when(F.col("id").isNotNull(), F.col("set_key")).alias("set_key")).join(judged, "set_key", "left")
    return found.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                        F.coalesce("reached", "id").alias("class_id")).withColumn("kept", F.col(id_col).eqNullSafe(F.col("class_id")))
