"""Hard negatives by exact integer inner products, several candidates in one multiplication.

Kronecker packing: the components of FIELDS candidates, biased to be non-negative, become the
fields of one wide integer; one multiplication with an anchor's biased component
multiplies them all, and the sums over the components never overflow a field, as its width
is taken from the largest sum that the two blocks can give. The fields are then cut out and the bias taken off, which
leaves the exact scores. Where two fields or more fit 53 bits, the wide integers are carried by
doubles (every sum stays below 2^53, so it is exact, and the product is one matrix product);
larger components are carried by Python's integers of any width.

Anchors are the stated queries and meet every row: a chunk of at most CHUNK anchors is
broadcast, and the rows are scanned twice for it, once for the anchors' positives and
once for the negatives that their scores admit. A task keeps the first few rows of each query
and ends with them, so nothing is shuffled but those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacus.llm._store import released, share, written
from abacus.llm._vectors import lengths, matrix
from abacus.session import scratch_path

POSITIVES = 5
NEGATIVES = 5
# A negative's score is between these hundredths of the positive's.
LOW, HIGH = 80, 100
# Anchors that are broadcast at once, and those compared with one batch at once.
CHUNK = 4096
BLOCK = 512
# Doubles hold integers of so many bits exactly.
CARRIED = 53
# Candidates in one integer of any width.
WIDE_FIELDS = 16
NO_ID = np.iinfo(np.int64).max


def pack(rows: np.ndarray, width: int, fields: int, carrier: type) -> np.ndarray:
    """(dim, ceil(n / fields)) wide integers from (n, dim) non-negative ones of less than ``width`` bits."""
    n, dim = rows.shape
    padded = np.zeros((-(-n // fields) * fields, dim), np.int64)
    padded[:n] = rows
    wide = np.zeros((len(padded) // fields, dim), carrier)
    for f in range(fields):
        wide += padded[f::fields].astype(carrier) * (1 << (width * f))
    return wide.T


def unpack(wide: np.ndarray, width: int, fields: int, n: int) -> np.ndarray:
    """(m, n) fields, as int64, of (m, ceil(n / fields)) wide integers."""
    if wide.dtype != object:
        wide = wide.astype(np.int64)
    out = np.empty((wide.shape[0], wide.shape[1] * fields), np.int64)
    mask = (1 << width) - 1
    for f in range(fields):
        out[:, f::fields] = ((wide >> (width * f)) & mask).astype(np.int64)
    return out[:, :n]


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(m, n) exact inner products of (m, dim) and (n, dim) integers."""
    dim = rows.shape[1]
    if not dim or not len(rows) or not len(anchors):
        return np.zeros((len(anchors), len(rows)), np.int64)
    low_a, low_r = int(anchors.min()), int(rows.min())
    a, r = anchors - low_a, rows - low_r
    width = max(1, (dim * int(a.max()) * int(r.max())).bit_length())
    fields = CARRIED // width
    carrier = float
    if fields < 2:
        carrier, fields = object, WIDE_FIELDS
    wide = a.astype(carrier) @ pack(r, width, fields, carrier)
    # (a + low_a)(r + low_r), summed over the components
    return (unpack(wide, width, fields, len(rows)) + low_a * r.sum(1)[None, :] + low_r * a.sum(1)[:, None]
            + dim * low_a * low_r)


class Firsts:
    """The first ``keep`` rows of each query by score, then id, over all rows shown so far."""

    def __init__(self, queries: int, keep: int):
        self.keep = keep
        self.floor = np.full(queries, np.iinfo(np.int64).min)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0
        self.full = 4 * queries * keep + 100_000

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((query, score, ids))
        self.held += len(query)
        if self.held > self.full:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        query, score, ids = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.keep
        filled = rank == self.keep - 1
        self.floor[query[filled]] = score[filled]
        self.parts = [(query[keep], score[keep], ids[keep])]
        self.held = int(keep.sum())
        return self.parts[0]


def _blocks(batch: pa.RecordBatch, anchors: dict) -> Iterator[tuple]:
    """(anchors of the block, ids of the rows, same label, other id, scores) of rows and anchors of one length."""
    rows = pa.Table.from_batches([batch])
    sizes = lengths(rows["x"])
    for dim in np.unique(sizes):
        own = np.flatnonzero(anchors["dim"] == dim)
        if not len(own):
            continue
        part = rows.take(pa.array(np.flatnonzero(sizes == dim)))
        x, ids, labels = matrix(part["x"], int(dim)), part["id"].fill_null(NO_ID).to_numpy(), part["label"].to_numpy()
        for at in range(0, len(own), BLOCK):
            block = own[at:at + BLOCK]
            a = np.stack([anchors["x"][i] for i in block])
            yield (block, ids, anchors["label"][block][:, None] == labels[None, :],
                   anchors["id"][block][:, None] != ids[None, :], scores(a, x))


def _top(df: DataFrame, keys: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(points: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``points``
    (id long, label long, x array<int>), whose rows with ``is_anchor`` are the anchors.

    An anchor's positives are its first rows of the same label and another id, by score and
    then id. For each, its negatives are the first rows of another label whose score
    is between ``low`` and ``high`` hundredths of the positive's. Rows of other lengths than the
    anchor are not scored. Repeated rows count each as positives and negatives, repeated
    anchors once. Rows without an id come last among ties and are never equal to an anchor;
    rows without a label or vector must be left out before. An empty table gives an empty result.
    """
    spark = points.sparkSession
    points = written(points.select("id", "label", "x", F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "negatives-points")
    queries = written(points.where("anchor").select("id", "label", "x").distinct().orderBy("id", "label", "x"), "negatives-anchors")
    rows = points.select("id", "label", "x")
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    held, turn = [], 0

    def run() -> None:
        nonlocal turn
        told = share(spark, {"id": np.array([q["id"] for q in held], np.int64), "label": np.array([q["label"] for q in held], np.int64),
                             "x": [np.array(q["x"], np.int64) for q in held], "dim": np.array([len(q["x"]) for q in held])})

        def near(batches):
            anchors = told()
            best = Firsts(len(anchors["id"]), positives)
            for batch in batches:
                for block, ids, same, other, score in _blocks(batch, anchors):
                    a, r = np.nonzero(same & other & (score >= best.floor[block][:, None]))
                    best.add(block[a], score[a, r], ids[r])
                best.settle()
            query, score, ids = best.settle()
            yield pa.RecordBatch.from_pydict({"query": pa.array(query), "id": pa.array(ids, mask=ids == NO_ID), "score": pa.array(score)})

        found = _top(rows.mapInArrow(released(near), "query long, id long, score long"), ["query"], positives)
        found = found.select("query", "rank", "id", "score").collect()  # at most chunk * positives rows
        score_of = np.zeros((len(held), positives), np.int64)
        id_of = np.full((len(held), positives), NO_ID, np.int64)
        there = np.zeros((len(held), positives), bool)
        for f in found:
            at = f["query"], f["rank"] - 1
            score_of[at], there[at] = f["score"], True
            id_of[at] = NO_ID if f["id"] is None else f["id"]
        wanted = share(spark, (score_of, id_of, there))

        def hard(batches):
            anchors, (aim, _, real) = told(), wanted()
            best = Firsts(real.size, negatives)
            least = -(-low * aim // 100)  # the least whole score from low hundredths on
            most = high * aim // 100
            for batch in batches:
                for block, ids, same, _, score in _blocks(batch, anchors):
                    for p in range(positives):
                        query = block * positives + p
                        floor = np.maximum(least[block, p], best.floor[query])[:, None]
                        a, r = np.nonzero(~same & (score >= floor) & (score <= most[block, p][:, None]) & real[block, p][:, None])
                        best.add(query[a], score[a, r], ids[r])
                best.settle()
            query, score, ids = best.settle()
            a, p = query // positives, query % positives
            yield pa.RecordBatch.from_pydict({
                "query": pa.array(query), "id": pa.array(ids, mask=ids == NO_ID), "score": pa.array(score),
                "anchor_id": pa.array(anchors["id"][a]), "positive_id": pa.array(wanted()[1][a, p], mask=wanted()[1][a, p] == NO_ID),
                "positive_score": pa.array(aim[a, p])})

        found = _top(rows.mapInArrow(released(hard), "query long, id long, score long, anchor_id long, positive_id long, positive_score long"),
                     ["query"], negatives)
        found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                     F.col("score").alias("negative_score")).write.parquet(f"{path}/chunk={turn}")
        turn += 1
        held.clear()

    for query in queries.toLocalIterator():
        held.append(query)
        if len(held) == chunk:
            run()
    if held:
        run()
    if not turn:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/chunk={t}" for t in range(turn)])
