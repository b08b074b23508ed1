"""Centroid clustering with ns-bounds, in exact integers.

Lloyd's rounds, where most distances are never computed: a vector keeps the distance to its
centroid and, for each group of centroids, a lower bound on the distance to the nearest other
member, each with the round in which it was evaluated. All centroids of all rounds are kept.
A stored value is loosened by the norm of the centroid's total displacement since that
round (for a group the largest of its members), which is at most the sum of the rounds'
drifts. Where a loosened bound cannot rule a group out, its members are scanned exactly.

Distances are integers, so ties are exact. Bounds are doubles rounded to the safe side, and
a group is only ruled out when its bound is strictly beyond the vector's own distance.
The centroids (clusters x dim, one set a round) are all that passes through the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import released, share, written
from abacus.llm._vectors import integers, matrix

CLUSTERS = 40
ROUNDS = 5
SCALE = 256
# Centroids that share one lower bound.
GROUP = 5
# Bounds give way by this share of the numbers they were computed from.
SLACK = 1e-9
# Products of integers up to this are exact in double precision for up to 256 components.
EXACT = 1 << 21


@dataclass
class State:
    """Per vector: its centroid, the squared distance at round ``seen``, and for each group of
    centroids a lower bound at round ``low_at`` on the distance to its members but the own one."""

    cluster: np.ndarray
    own: np.ndarray
    seen: np.ndarray
    lows: np.ndarray
    low_at: np.ndarray


def squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 rows."""
    if max(np.abs(x).max(initial=0), np.abs(centers).max(initial=0)) <= EXACT and x.shape[1] <= 256:
        inner = np.rint(x.astype(np.float64) @ centers.astype(np.float64).T).astype(np.int64)
    else:
        inner = x @ centers.T
    return (x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2 * inner


def drifts(history: np.ndarray) -> np.ndarray:
    """(round, centroid): how far each centroid of each round is from where it is now; rounded up."""
    moved = (history - history[-1]).astype(np.float64)
    return np.sqrt((moved * moved).sum(2)) * (1 + SLACK)


def assign(x: np.ndarray, history: np.ndarray, state: State | None, every: bool = False) -> tuple[State, int]:
    """The state under the last centroids of ``history`` (round, centroid, component), and how many
    distances were computed. ``every`` computes each vector's own distance even where bounds hold."""
    now, centers = len(history) - 1, history[-1]
    k, n = len(centers), len(x)
    starts = range(0, k, GROUP)
    if state is None:
        state = State(np.zeros(n, np.int64), squared(x, centers[:1])[:, 0], np.full(n, now),
                      np.full((n, len(starts)), -1.0, np.float64), np.full((n, len(starts)), now))
        computed = n
    else:
        state = State(state.cluster.copy(), state.own.copy(), state.seen.copy(), state.lows.astype(np.float64), state.low_at.copy())
        computed = 0
    moved = drifts(history)
    group_moved = np.stack([moved[:, s:s + GROUP].max(1) for s in starts], 1)
    lows = state.lows * (1 - SLACK) - group_moved[state.low_at, np.arange(len(starts))]
    reach = np.sqrt(state.own.astype(np.float64)) * (1 + SLACK) + moved[state.seen, state.cluster]
    open_ = (lows <= reach[:, None]).any(1)
    # The own distance, exactly, before any group is scanned.
    stale = np.flatnonzero((open_ | every) & (state.seen != now))
    if len(stale):
        apart = x[stale] - centers[state.cluster[stale]]
        state.own[stale] = (apart * apart).sum(1)
        state.seen[stale] = now
        computed += len(stale)
        reach[stale] = np.sqrt(state.own[stale].astype(np.float64)) * (1 + SLACK)
    scan = (lows <= reach[:, None]) & open_[:, None]
    first, first_own = state.cluster.copy(), state.own.copy()
    scanned = {}
    for g, s in enumerate(starts):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        far = squared(x[rows], centers[s:s + GROUP])
        computed += far.size
        scanned[g] = (rows, far)
        at = far.argmin(1)
        best = far[np.arange(len(rows)), at]
        at = at + s
        better = (best < state.own[rows]) | ((best == state.own[rows]) & (at < state.cluster[rows]))
        state.cluster[rows[better]] = at[better]
        state.own[rows[better]] = best[better]
    for g, (rows, far) in scanned.items():
        mine = state.cluster[rows] - g * GROUP
        inside = np.flatnonzero((mine >= 0) & (mine < far.shape[1]))
        rest = far.astype(np.float64)
        rest[inside, mine[inside]] = np.inf
        state.lows[rows, g] = np.sqrt(rest.min(1)) * (1 - SLACK)
        state.low_at[rows, g] = now
    # A left centroid counts among the others of its group from now on.
    left = np.flatnonzero(state.cluster != first)
    group = first[left] // GROUP
    unscanned = ~scan[left, group]
    left, group = left[unscanned], group[unscanned]
    state.lows[left, group] = np.minimum(lows[left, group], np.sqrt(first_own[left].astype(np.float64)) * (1 - SLACK))
    state.low_at[left, group] = now
    return state, computed


_STATE = "cluster int, own long, seen int, lows array<double>, low_at array<int>, computed long"


def _to_table(ids: pa.ChunkedArray, x: pa.ChunkedArray, s: State, computed: int) -> pa.Table:
    n, groups = s.lows.shape
    offsets = pa.array(np.arange(n + 1) * groups, pa.int32())
    counts = np.zeros(n, np.int64)
    counts[:1] = computed
    return pa.table({"id": ids, "x": x, "cluster": pa.array(s.cluster, pa.int32()), "own": s.own, "seen": pa.array(s.seen, pa.int32()),
                     "lows": pa.ListArray.from_arrays(offsets, pa.array(s.lows.ravel(), pa.float64())),
                     "low_at": pa.ListArray.from_arrays(offsets, pa.array(s.low_at.ravel(), pa.int32())), "computed": counts})


def _from_table(t: pa.Table) -> State:
    n = t.num_rows
    lows = t["lows"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    low_at = t["low_at"].combine_chunks().flatten().to_numpy().astype(np.int64).reshape(n, -1)
    return State(t["cluster"].to_numpy().astype(np.int64), t["own"].to_numpy().copy(), t["seen"].to_numpy().astype(np.int64), lows, low_at)


@dataclass
class Clustering:
    rows: DataFrame  # id, cluster, distance, computed (on one row of each batch: the distances computed for the batch, last round)
    centroids: list[list[int]]
    rounds: list[DataFrame]  # the stored state of every round


def cluster(points: DataFrame, dim: int, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 2) -> Clustering:
    """Cluster the rows of ``points`` (id, x: array<int> of ``dim`` components).

    Centroids start as the vectors of the least sha256 of ``seed:id`` (ties: by components; rows
    without an id come last), fewer where there are fewer rows. Each round assigns every row
    to the nearest centroid (ties: the smaller number) and replaces a centroid by the
    componentwise floor of its rows' mean; one without rows stays. Then rows are assigned
    once more. Each round's state is written, so a lost executor repeats one round at most.
    """
    spark = points.sparkSession
    points = points.select("id", "x")
    first = points.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(clusters)
    history = [[list(r["x"]) for r in first.collect()]]
    state, kept = points, []
    if not history[0]:
        return Clustering(points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                                        F.lit(0).cast("long").alias("computed")), [], [])
    for turn in range(rounds + 1):
        past, last = share(spark, np.array(history, np.int64)), turn == rounds

        def work(batches, past=past, last=last, start=turn == 0):
            for batch in batches:
                if batch.num_rows:
                    t = pa.Table.from_batches([batch])
                    x = matrix(t["x"], dim)
                    s, computed = assign(x, past(), None if start else _from_table(t), every=last)
                    yield from _to_table(t["id"], t["x"], s, computed).combine_chunks().to_batches()

        state = written(state.mapInArrow(released(work), f"id long, x array<int>, {_STATE}"), f"clusters-{turn}")
        kept.append(state)
        if not last:
            # Partial sums per task, then one row a centroid.
            sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[
                F.sum(F.get("x", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(dim)]).collect()
            centers = [list(c) for c in history[-1]]
            for r in sums:
                centers[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
            history.append(centers)
    return Clustering(state.select("id", "cluster", F.col("own").alias("distance"), "computed"), history[-1], kept)


def cluster_embeddings(embeddings: DataFrame, dim: int = 64, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that has
    exactly ``dim`` components, none null or non-finite, as integers floor(scale * component).

    Other vectors are left out; repeated rows count each; an empty table gives an empty
    result; other columns are ignored. A component beyond 2^27 / scale raises, as its
    distances would leave a long.
    """
    spark = embeddings.sparkSession
    named = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    found = cluster(written(integers(named, "v", scale, "x", F.size("v") == dim).select("id", "x"), "cluster-points"), dim, clusters, rounds)
    inertia = {r["cluster"]: r["d"] for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    # One row a centroid.
    table = spark.createDataFrame([(i, inertia.get(i, 0), sum(inertia.values()), n) for i, n in enumerate(names)],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
