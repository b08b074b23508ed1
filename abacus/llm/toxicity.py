"""Toxicity scores: a linear classifier over character n-grams scaled by naive Bayes ratios.

A text's features are the hashed n-grams of its lower-cased UTF-8 bytes, each counted and
divided by the square root of the text's length. Training multiplies every feature by its
log-count ratio (the toxic texts that hold it, smoothed, for each toxic text, over the same of the
others) and fits a logistic regression on the scaled features. Scoring folds ratio and
coefficient into one weight per bucket, so a text costs one look-up per n-gram.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, release, share
from abacus.llm._text import LOWER, text_slices

ORDERS = (4, 5, 6)
BUCKET_BITS = 18
# Training uses about this many labelled texts of each class (all, if there are fewer), chosen
# by a hash of the id. Scoring reads every text.
TRAIN_PER_CLASS = 1500
SMOOTHING = 1.0
PENALTY = 2e-4
MIN_TEXTS = 5
MIN_RATIO = 0.25
STEPS = 100


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    orders: tuple[int, ...]
    bits: int


def _buckets(data: np.ndarray, offsets: np.ndarray, orders, bits: int):
    """For each order: (bucket of the n-gram at each byte, True where it stays in its text)."""
    data = LOWER[data].astype(np.uint32)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for n in orders:
        size = len(data) - n + 1
        if size <= 0:
            continue
        value = np.full(size, n, np.uint32)
        for j in range(n):
            value *= np.uint32(0x9E3779B1)
            value += data[j:j + size]
            value ^= value >> np.uint32(15)
        yield value >> np.uint32(32 - bits), room[:size] >= n


def raw_scores(column: pa.Array, model: Model) -> np.ndarray:
    """The margin of each text: positive where label 1 is likelier. Null and empty: the bias."""
    out = np.full(len(column), model.bias)
    for first, end, data, offsets in text_slices(column):
        sums = np.zeros(len(data) + 1)
        for bucket, inside in _buckets(data, offsets, model.orders, model.bits):
            sums[1:len(bucket) + 1] += np.where(inside, model.weights[bucket], 0)
        np.cumsum(sums, out=sums)
        length = np.maximum(np.diff(offsets), 1)
        out[first:end] += (sums[offsets[1:]] - sums[offsets[:-1]]) / np.sqrt(length)
    return out


def _features(texts: pa.Array, orders, bits: int):
    """For each slice: (first row, row of each feature, bucket, value), buckets once per row."""
    for first, _, data, offsets in text_slices(texts, 1 << 18):
        rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
        keys = [(rows[:len(b)][ok] << bits) | b[ok] for b, ok in _buckets(data, offsets, orders, bits)]
        key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
        row = key >> bits
        length = np.maximum(np.diff(offsets), 1)
        yield (row + first).astype(np.int32), (key & ((1 << bits) - 1)).astype(np.int32), (count / np.sqrt(length[row])).astype(np.float32)


def fit(texts: pa.Array, toxic: np.ndarray, orders=ORDERS, bits: int = BUCKET_BITS) -> Model:
    """Fit on a bounded sample. One class only (or no rows): a model that always says that class."""
    toxic = np.asarray(toxic, dtype=float)
    size = 1 << bits
    if not len(toxic) or toxic.min() == toxic.max():
        always = -4.0 if not len(toxic) or toxic[0] == 0 else 4.0
        return Model(np.zeros(size, np.float32), always, tuple(orders), bits)
    # Count first, then keep the features that say something: the sample's own are never all held.
    seen = np.zeros((2, size))
    for row, column, _ in _features(texts, orders, bits):
        for label in (0, 1):
            seen[label] += np.bincount(column[toxic[row] == label], minlength=size)
    total = [(toxic == label).sum() for label in (0, 1)]
    ratio = np.log((seen[1] + SMOOTHING) / total[1]) - np.log((seen[0] + SMOOTHING) / total[0])
    # A bucket seen in very few texts, or as often in both classes, says nothing about others.
    keep = (seen.sum(0) >= MIN_TEXTS) & (np.abs(ratio) >= MIN_RATIO)
    ratio = np.where(keep, ratio, 0)
    scale = ratio.astype(np.float32)
    parts = [(row[keep[column]], column[keep[column]], (value * scale[column])[keep[column]])
             for row, column, value in _features(texts, orders, bits)]
    weight, bias, n = np.zeros(size), 0.0, len(toxic)
    # Balanced classes; Adam steps on the whole sample.
    balance = np.where(toxic > 0, n / (2 * (toxic > 0).sum()), n / (2 * (toxic == 0).sum()))
    mean, square, covered = np.zeros(size + 1), np.zeros(size + 1), np.zeros(n, bool)
    for step in range(1, STEPS + 1):
        # Slice by slice, so that no array of all features is made beside the slices.
        slope = np.append(PENALTY * weight / n ** 0.5, 0.0)
        for rows, columns, values in parts:
            if not len(rows):
                continue
            low, high = rows[0], rows[-1] + 1
            margin = np.bincount(rows - low, weights=weight[columns] * values, minlength=high - low) + bias
            error = balance[low:high] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[low:high]) / n
            slope[:-1] += np.bincount(columns, weights=error[rows - low] * values, minlength=size)
            covered[low:high] = True
            slope[-1] += error.sum()
        # Texts without a kept feature have the bias alone.
        slope[-1] += (balance * (1 / (1 + np.exp(-bias)) - toxic) / n)[~covered].sum()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope ** 2
        move = 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
    return Model((weight * ratio).astype(np.float32), float(bias), tuple(orders), bits)


def held_out(id_column: Column) -> Column:
    """True for rows that training never sees: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled rows that are not held out.

    Rows without an id, a text or a label of 0 or 1 are not used; of several labels of one id
    the largest counts, and of several texts the least. The chosen ids, and so the rows, are bounded
    by ``per_class``; the ids are broadcast.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    found = known.groupBy("toxic").count()
    places = 1 << 30
    share = F.lit(float(per_class)) / F.col("count")
    chosen = (known.join(F.broadcast(found), "toxic")
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(places)) < share * places).select("doc_id", "toxic"))
    found = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Model:
    """Fit the classifier in one task on a bounded sample of labelled rows."""
    orders, bits = ORDERS, BUCKET_BITS

    def run(batches):
        table = pa.Table.from_batches(list(batches), schema=pa.schema(
            [("doc_id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())]))
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = fit(table["text"], table["toxic"].to_numpy(), orders, bits)
        release()
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])],
                                         names=["weights", "bias"])

    sample = training_rows(docs, labels, per_class).select(
        F.col("doc_id").cast("long"), "text", F.col("toxic").cast("int"))
    row = sample.repartition(1).mapInArrow(run, "weights binary, bias double").first()
    if row is None:
        return fit(pa.array([], pa.string()), np.zeros(0))
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], orders, bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, 0 to 1: how likely label 1 is for the whole text.

    Null and empty texts have no n-grams and get the model's base score. Row by row, so ties,
    repeated rows and other columns do not matter; an ``out`` column of the input is replaced.
    """
    bounded_batches(docs.sparkSession)
    shared = share(docs.sparkSession, model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(raw_scores(column, shared()), -500, 500))))

    return docs.withColumn(out, scored(F.col(text_col)))
