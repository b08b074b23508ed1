"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations.

A source's weight is its share of all tokens to a power between 0 and 1, normalised. The
power is bisected: the largest (closest to the natural shares) whose weights reach the target
entropy, raised again where a source would be repeated more often than the limit. A source
then owes weight x budget tokens: whole passes over its documents, and a part of one more.
Documents belong to blocks by a hash of their id. Every pass visits the blocks in an order of
its own; the partial pass takes blocks in that order while they fit, and from the next block
documents in an order of their own while they fit.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, written
from abacus.llm._text import SPACED, Words, text_slices

ENTROPY = 0.97
REPEAT_LIMIT = 4.0
BLOCK_TOKENS = 1_000_000
SEED = 17
MAX_BLOCKS = 65_536
DETAILS = ("n_tokens", "pass", "block", "block_order", "doc_order")
# Exponents judged in one pass over the sources' sizes, and passes: 8 ** 16 is 2 ** 48.
PLACES, ROUNDS = 7, 16


@dataclass
class Plan:
    exponent: float
    weights: list[float]
    passes: list[float]  # how often each source's documents are visited


def entropy(weights: list[float]) -> float:
    """Entropy as a part of the largest that so many sources can have; one source alone: 1."""
    if len(weights) < 2:
        return 1.0
    return -sum(w * math.log(w) for w in weights if w > 0) / math.log(len(weights))


def tempered(tokens: list[float], exponent: float) -> list[float]:
    total = sum(tokens)
    powers = [(t / total) ** exponent for t in tokens]
    return [p / sum(powers) for p in powers]


def _narrowed(good, low: float, high: float) -> float:
    """The end of [low, high] next to ``high`` where ``good`` still holds; it holds at low.
    ``good`` judges a list of places, as one pass over the sources can."""
    for _ in range(ROUNDS):
        places = [low + (high - low) * i / (PLACES + 1) for i in range(1, PLACES + 1)]
        first = next((i for i, holds in enumerate(good(places)) if not holds), PLACES)
        low, high = [low, *places][first], [*places, high][first]
    return low


@dataclass
class Sources:
    """What the plan needs to know of the sources, however many there are."""
    count: int
    total: float
    least: float  # tokens of the smallest source
    most: float
    sums: Callable[[list[float]], list[tuple[float, float]]]  # of share ** x and of share ** x * log(share)


def choose(of: Sources, target: float, limit: float, budget: float | None) -> tuple[float, float, float]:
    """(exponent, sum of the powers of the shares, budget). Weights grow and passes fall with a
    source's size, so the smallest and the largest source bound the passes of all."""
    def spread(places):
        return [1.0 if of.count < 2 else (math.log(s) - x * logs / s) / math.log(of.count)
                for x, (s, logs) in zip(places, of.sums(places), strict=True)]

    def size(x, s):
        return budget if budget is not None else of.total * s * (of.most / of.total) ** (1 - x)

    def most_passes(places):
        return [(of.least / of.total) ** (x - 1) / s * size(x, s) / of.total for x, (s, _) in zip(places, of.sums(places), strict=True)]

    exponent = 1.0 if spread([1.0])[0] >= target else _narrowed(lambda xs: [e >= target for e in spread(xs)], 0.0, 1.0)
    if most_passes([exponent])[0] > limit:
        # Repetition falls as the exponent rises: the smallest exponent within the limit.
        exponent = 1 - _narrowed(lambda xs: [m <= limit for m in most_passes([1 - x for x in xs])], 0.0, 1 - exponent)
    powers = of.sums([exponent])[0][0]
    return exponent, powers, size(exponent, powers)


def plan(tokens: list[float], target: float = ENTROPY, limit: float = REPEAT_LIMIT, budget: float | None = None) -> Plan:
    """Weights for sources of so many (positive) tokens. Without a budget it is the smallest
    that visits every document at least once."""
    if not tokens:
        return Plan(1.0, [], [])
    shares = np.array(tokens) / sum(tokens)
    exponent, _, size = choose(
        Sources(len(tokens), sum(tokens), min(tokens), max(tokens),
                lambda xs: [(float((shares ** x).sum()), float((shares ** x * np.log(shares)).sum())) for x in xs]),
        target, limit, budget)
    weights = tempered(tokens, exponent)
    return Plan(exponent, weights, [w * size / t for t, w in zip(tokens, weights, strict=True)])


def described(totals: DataFrame) -> Sources:
    """Of a table (__source, t). The sums are exact decimals, the same in whatever order they
    are added; a pass goes over the sizes that differ and returns one row a place."""
    sizes = written(totals.groupBy("t").agg(F.count("*").alias("n")), "mixing-equal")
    n, total, least, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum(F.col("t") * F.col("n")), F.min("t"), F.max("t")).first()
    share = F.col("t") / F.lit(float(total or 1))

    def sums(places):
        power = F.pow("share", "x")
        found = {r["x"]: (float(r["s"]), float(r["logs"])) for r in sizes.select(
            "n", share.alias("share"), F.explode(F.array(*map(F.lit, places))).alias("x")).groupBy("x").agg(
            F.sum((F.col("n") * power).cast("decimal(34,24)")).alias("s"),
            F.sum((F.col("n") * power * F.log("share")).cast("decimal(34,24)")).alias("logs")).collect()}
        return [found[x] for x in places]

    return Sources(n, float(total or 0), float(least or 0), float(most or 0), sums)


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space, and one for the document's end."""

    @F.arrow_udf("long")
    def counted(text: pa.Array) -> pa.Array:
        counts = [Words(data, offsets, SPACED).count + 1 for _, _, data, offsets in text_slices(text)]
        return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())

    return counted(text)


def mix(docs: DataFrame, target: float = ENTROPY, limit: float = REPEAT_LIMIT, budget_share: float | None = 1.0,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", details: bool = True) -> DataFrame:
    """Rows of ``docs`` as often as the mix visits them, with DETAILS: ``pass`` (0, 1, ...), the
    document's ``block``, and where both stand: a pass of a source visits its blocks by
    (block_order, block) and a block's documents by doc_order, hashed anew for every pass.

    ``budget_share`` is the budget as a part of the corpus's tokens; None is the smallest budget
    that visits every document at least once. Null sources form a source of their own. Empty
    and null texts count one token. Rows that share id and text are visited or left out of a
    partial pass together; the budget is met to within one such group per source. An empty
    table gives an empty one. Columns named like DETAILS are replaced; without ``details``
    the rows have the columns of ``docs`` and no others.

    What a partial pass takes is told by the block it ends in and, in that block, by the
    largest order value. So the plan is a table of one row a source, of any number of them,
    joined without a hint: while it is small, documents are not shuffled; beyond, they are
    shuffled once by source, and the adaptive join splits a hot one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = F.coalesce(F.col(source_col).cast("string"), F.lit("\0null"))
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("\0null")))
    sized = docs.withColumn("__tokens", n_tokens(F.col(text_col))).withColumn("__source", known).withColumn("__key", key)
    rows = written(sized.select("__source", "__key", "__tokens"), "mixing-sizes")
    totals = written(rows.groupBy("__source").agg(F.sum("__tokens").alias("t")), "mixing-totals")
    of = described(totals)
    exponent, powers, size = choose(of, target, limit, None if budget_share is None else budget_share * of.total) if of.count else (1.0, 1.0, 0.0)
    block_size = max(block_tokens, of.total / MAX_BLOCKS)
    passes = F.pow(F.col("t") / F.lit(of.total or 1.0), F.lit(exponent)) / F.lit(powers) * F.lit(size) / F.col("t")
    sources = totals.withColumn("__passes", passes).withColumn("__whole", F.floor(F.col("__passes") + 1e-9)).select(
        "__source", F.ceil(F.col("t") / F.lit(float(block_size))).alias("__blocks"), "__whole",
        (F.greatest(F.lit(0.0), F.col("__passes") - F.col("__whole")) * F.col("t")).alias("__owed"))

    block = F.pmod(F.xxhash64("__key", F.lit(seed)), F.col("__blocks"))

    def turn_of(visit):
        return F.struct(F.xxhash64("__source", visit, "__block", F.lit(seed)).alias("order"), F.col("__block").alias("block"))

    def order_of(visit):
        return F.struct(F.xxhash64("__key", visit, F.lit(seed + 1)).alias("order"), F.col("__key").alias("key"))

    # The partial pass comes after the whole ones, so its number is theirs.
    turn, order = turn_of("__whole"), order_of("__whole")
    placed = rows.join(sources, "__source").withColumn("__block", block)
    blocks = placed.groupBy("__source", "__block", "__whole", "__owed").agg(F.sum("__tokens").alias("size"))
    before = F.sum("size").over(Window.partitionBy("__source").orderBy(turn)
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    cuts = written(blocks.withColumn("room", F.col("__owed") - before).where("room > 0").withColumn("turn", turn)
                   .groupBy("__source").agg(F.max("turn").alias("__cut"), F.min("room").alias("room")), "mixing-cuts")

    groups = (placed.join(cuts, "__source").where("__block = __cut.block")
              .groupBy("__source", "__whole", "room", "__key").agg(F.sum("__tokens").alias("size")))
    upto = F.sum("size").over(Window.partitionBy("__source").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    last = (groups.withColumn("upto", upto).where("upto <= room").groupBy("__source").agg(F.max(order).alias("__last")))
    plans = written(sources.drop("__owed").join(cuts.drop("room"), "__source", "left").join(last, "__source", "left"), "mixing-plans")

    out = sized.join(plans, "__source").withColumn("__block", block)
    extra = F.coalesce((turn < F.col("__cut")) | ((turn == F.col("__cut")) & (order <= F.col("__last"))), F.lit(False))
    out = out.withColumn("__visits", F.col("__whole") + extra.cast("int")).where("__visits > 0").withColumn(
        "__pass", F.explode(F.sequence(F.lit(0), F.col("__visits") - 1)))
    if not details:
        return out.select(*docs.columns)
    names = [c for c in docs.columns if c not in DETAILS]
    return out.select(*names, F.col("__tokens").alias("n_tokens"), F.col("__pass").alias("pass"), F.col("__block").alias("block"),
                      turn_of("__pass")["order"].alias("block_order"), order_of("__pass")["order"].alias("doc_order"))
