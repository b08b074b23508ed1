"""Sharding, hard negatives and clustering against plain versions on small tables."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from abacus.llm import kk_shards, kronecker_negatives, ns_kmeans, queries
from abacus.llm._vectors import integers
from abacus.session import scratch_path

VECTORS = "vec_id long, embedding array<double>, label int"


# ------------------------------------------------------------------ sharding

def plain_differencing(sizes, parts):
    """Part sums by the largest differencing method, on lists of groups."""
    held = [(tuple([s] + [0] * (parts - 1)), i) for i, s in enumerate(sizes)]
    made = itertools.count(len(sizes))
    while len(held) > 1:
        held.sort(key=lambda t: (t[0][0] - t[0][-1], -t[1]), reverse=True)
        (a, _), (b, _) = held[:2]
        both = sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)
        held = held[2:] + [(tuple(both), next(made))]
    return sorted(held[0][0])


@pytest.mark.parametrize("parts", [1, 2, 3, 16])
def test_differencing_equals_a_plain_version(parts):
    rng = np.random.default_rng(parts)
    for n in (1, 2, 5, 40, 200):
        sizes = sorted((int(s) for s in rng.integers(1, 1000, n)), reverse=True)
        part = kk_shards.difference(np.array(sizes), parts)
        got = np.bincount(part, weights=sizes, minlength=parts)
        assert sorted(got.astype(int).tolist()) == plain_differencing(sizes, parts)


def test_differencing_known_case_and_balance():
    # 8, 7, 6, 5, 4 in two parts: the method gives 16 and 14.
    part = kk_shards.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(part, weights=[8, 7, 6, 5, 4]).tolist()) == [14, 16]
    sizes = np.random.default_rng(3).integers(1, 10_000, 3000)
    sums = np.bincount(kk_shards.difference(sizes, 16), weights=sizes, minlength=16)
    assert sums.max() - sums.min() <= 2
    assert kk_shards.difference(np.zeros(0, np.int64), 4).tolist() == []


def shard_rows(spark, docs, **options):
    path = scratch_path(spark, "test-shards")
    kk_shards.write_shards(docs, path, **options)
    return kk_shards.with_slots(kk_shards.read_rows(spark, path), path)


def check_shards(docs, rows, shards):
    assert len(rows) == len(docs)
    assert sorted(map(repr, ((r.row.doc_id, r.row.text) for r in rows))) == sorted(map(repr, docs))
    homes = {}
    for r in rows:
        assert r.size == len((r.row.text or "").encode()) + 1 and 0 <= r.shard < shards
        assert homes.setdefault(r.row.text or "", r.shard) == r.shard
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_keep_groups_whole_and_balance(spark):
    rng = np.random.default_rng(5)
    docs = [(i, "w" * int(n)) for i, n in enumerate(rng.integers(0, 4000, 300))]
    docs += [(1000 + i, "the same text é") for i in range(200)] + [(2000, None), (2001, ""), (None, "ü"), (3, docs[3][1]), (3, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("mine") for c in ("shard", "slot", "row", "key", "size", "file", "place", "bytes")}).repartition(7)
    rows = shard_rows(spark, frame).collect()
    check_shards(docs, rows, 16)
    assert {r.row.slot for r in rows} == {"mine"}
    sums = np.bincount([r.shard for r in rows], weights=[r.size for r in rows], minlength=16)
    assert sums.max() - sums.min() <= 60


def test_shards_in_levels(spark):
    """Nodes of 16 groups and 4 bundles: several levels, the same laws."""
    rng = np.random.default_rng(6)
    docs = [(i, f"{i} " + "w" * int(n)) for i, n in enumerate(rng.integers(0, 500, 700))] + [(9000 + i, "x" * 300) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = shard_rows(spark, frame, shards=4, node=16, bundles=4).collect()
    check_shards(docs, rows, 4)
    sums = np.bincount([r.shard for r in rows], weights=[r.size for r in rows], minlength=4)
    # The copies are a third of all bytes and cannot be divided: their shard holds little else.
    others = [s for i, s in enumerate(sums) if i != next(r.shard for r in rows if r.row.doc_id == 9000)]
    # The last level has at most 16 bundles besides, which bounds the balance of the other shards.
    assert sums.max() <= 301 * 300 + 600 and max(others) - min(others) <= sum(others) / 16


def test_shards_query_and_empty_table(spark, tmp_path):
    docs = [(i, f"text {i % 40} é", "en") for i in range(90)] + [(90, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_kk_shards(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(91))
    for r in rows:
        raw = (docs[r.doc_id][1] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shard_rows(spark, empty).count() == 0


# ------------------------------------------------------------------ hard negatives

@pytest.mark.parametrize("size", [0, 1, 150, 5000, 1 << 20, 1 << 27])
@pytest.mark.parametrize("dim", [1, 3, 64])
def test_packed_products_are_exact(size, dim):
    rng = np.random.default_rng(size + dim)
    for n, m in ((1, 1), (5, 33), (17, 2)):
        a, r = rng.integers(-size, size + 1, (n, dim)), rng.integers(-size, size + 1, (m, dim))
        assert (kronecker_negatives.scores(a, r) == a @ r.T).all()
        # one-sided blocks: the bias is not zero's
        assert (kronecker_negatives.scores(a + size, r - 2 * size) == (a + size) @ (r - 2 * size).T).all()


def test_pack_and_unpack_fields():
    rows = np.random.default_rng(1).integers(0, 1 << 20, (7, 5))
    for fields, carrier in ((2, float), (16, object)):
        wide = kronecker_negatives.pack(rows, 20, fields, carrier)
        assert (kronecker_negatives.unpack(wide, 20, fields, 7) == rows.T).all()


def plain_negatives(rows, positives=5, negatives=5):
    """(anchor, positive, rank, negative, scores) by sorting every row for every anchor."""
    last = lambda i: (i is None, i or 0)
    out = []
    for a_id, a_label, a in {r for r in rows if r[0] is not None and r[0] % 100 == 0}:
        ranked = sorted(((sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in rows if i != a_id and len(v) == len(a)),
                        key=lambda t: (-t[0], last(t[1])))
        for p_score, p_id, _ in [t for t in ranked if t[2] == a_label][:positives]:
            fit = [t for t in ranked if t[2] != a_label and 80 * p_score <= 100 * t[0] <= 100 * p_score]
            out += [(a_id, p_id, n + 1, t[1], p_score, t[0]) for n, t in enumerate(fit[:negatives])]
    return out


def table(rng, n, labels=4):
    centers = rng.integers(-40, 40, (labels * 2, 6))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, labels))
        v = centers[label * 2 + i % 2] // 2 + centers[0] + rng.integers(-12, 12, 6)
        rows.append((i, label, tuple(int(c) for c in v)))
    return rows


@pytest.mark.parametrize("chunk", [3, 1000])
def test_negatives_equal_brute_force(spark, chunk):
    rows = table(np.random.default_rng(7), 700)
    rows += rows[95:110] + [rows[100]] * 3 + [(None, 1, rows[5][2]), (None, 2, rows[100][2]), (800, 1, (1, 2)), (801, 1, (3, 4)), (802, 2, (3, 4)),
                                             (900, 3, ()), (901, 3, ()), (902, 2, ())]
    rows += [(1100, 2, tuple([100_000_000] * 6)), (1101, 2, tuple([90_000_000] * 6)), (1102, 3, tuple([80_000_000] * 6))]
    points = spark.createDataFrame([(i, label, list(v)) for i, label, v in rows], "id long, label long, x array<int>").repartition(5)
    points = points.withColumns({c: F.lit("mine") for c in ("query", "score", "rank", "anchor", "dim")})
    found = kronecker_negatives.mine(points, F.col("id") % 100 == 0, chunk=chunk)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain_negatives(rows)))


def test_negatives_of_no_rows_or_anchors(spark):
    points = spark.createDataFrame([(1, 1, [1]), (2, 2, [1])], "id long, label long, x array<int>")
    for frame in (points, points.where("id > 5")):
        assert kronecker_negatives.mine(frame, F.col("id") % 100 == 0).collect() == []


def test_integer_rows_leave_out_what_has_no_score(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 1), (2, None, 1), (3, [0.5, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, 1.0], None), (7, [], 1)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = {r.vec_id: list(r.x) for r in integers(frame, "embedding", 256, "x", F.col("label").isNotNull()).collect()}
    assert got == {1: [128, -1], 7: []}


# ------------------------------------------------------------------ clustering

def plain_clusters(rows, clusters, rounds):
    """Lloyd's rounds with every distance computed, in Python integers."""
    rank = lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()
    centers = [list(r[1]) for r in sorted(rows, key=rank)[:clusters]]
    for turn in range(rounds + 1):
        near = []
        for _, v in rows:
            near.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)))
        if turn < rounds:
            for j in range(len(centers)):
                own = [v for (_, v), (_, at) in zip(rows, near) if at == j]
                if own:
                    centers[j] = [sum(col) // len(own) for col in zip(*own)]
    return near, centers


def blobs(rng, n, dim=64, spread=6):
    middles = rng.integers(-120, 120, (12, dim))
    return [(i, [int(c) for c in middles[i % 12] + rng.integers(-spread, spread + 1, dim)]) for i in range(n)]


def test_clusters_equal_plain_lloyd(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = blobs(rng, 260) + [(1000 + i, [int(c) for c in rng.integers(-90, 90, 64)]) for i in range(120)]
    rows += [(5000 + i, rows[0][1]) for i in range(60)]  # copies, so that some centroids coincide and stay empty
    near, centers = plain_clusters(rows, 40, 5)
    junk = [(9001, None, 1), (9002, [1.0] * 63, 1), (9003, [1.0] * 63 + [float("nan")], 1), (9004, [None] + [1.0] * 63, 1)]
    # sixteenths of 1/16 less are floored back to the integer
    data = [(i, [(c + 0.5) / 256 for c in v], None) for i, v in rows] + junk
    frame = spark.createDataFrame(data, VECTORS).withColumns({c: F.lit("mine") for c in ("x", "cluster", "own", "id")}).repartition(4)
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r for r in queries.op13_ns_kmeans(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    total = sum(d for d, _ in near)
    for (i, _), (d, j) in zip(rows, near):
        r = got[i]
        assert (r.cluster, r.distance, r.inertia) == (j, d, total)
        assert r.cluster_inertia == sum(e for e, k in near if k == j)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest()


def test_bounds_save_distances_and_stay_exact():
    rng = np.random.default_rng(9)
    x = np.array([v for _, v in blobs(rng, 3000)], np.int64)
    centers = x[rng.choice(len(x), 40, replace=False)]
    history, state, spent = [centers], None, []
    for turn in range(8):
        state, computed = ns_kmeans.assign(x, np.array(history), state)
        spent.append(computed)
        far = ns_kmeans.squared(x, history[-1])
        assert (state.cluster == far.argmin(1)).all()
        near = [np.floor_divide(x[state.cluster == j].sum(0), max((state.cluster == j).sum(), 1)) for j in range(40)]
        history.append(np.array([n if (state.cluster == j).any() else history[-1][j] for j, n in enumerate(near)]))
    assert spent[-1] < spent[0] / 4


def test_bounds_use_total_displacement():
    """A centroid that comes back has moved nothing, however far the rounds took it."""
    history = np.array([[[0, 0], [50, 0]], [[30, 40], [50, 0]], [[0, 0], [50, 0]]])
    assert ns_kmeans.drifts(history)[0].tolist() == [0.0, 0.0] and ns_kmeans.drifts(history)[1][0] >= 50


def test_wide_components_are_exact():
    rng = np.random.default_rng(10)
    x, c = rng.integers(-(1 << 27), 1 << 27, (20, 64)), rng.integers(-(1 << 27), 1 << 27, (5, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
    assert ns_kmeans.squared(x, c).tolist() == want


def test_clusters_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(7, [0.5] * 64, 1), (7, [0.5] * 64, 1), (None, [0.25] * 64, 1)], VECTORS)
    got = sorted(map(repr, ((r.vec_id, r.distance) for r in ns_kmeans.cluster_embeddings(few).collect())))
    assert got == sorted(map(repr, [(7, 0), (7, 0), (None, 0)]))
    assert ns_kmeans.cluster_embeddings(few.where("vec_id > 9")).collect() == []
