"""Edge cases and brute-force comparisons of the training-data operators on small tables."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from abacus.llm import (decontaminate, html_blocks, lsh_forest, mixing, rp_forest, substring_dedup, token_blocks, toxicity, url_trees,
                        warc)
from abacus.session import scratch_path

WORDS = [f"w{i}" for i in range(300)]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed=1, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 90))) for _ in range(n)]
    base += base[:6]
    for t in base[6:16]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        base.append(" ".join(w))
    passage = " ".join(rng.choice(WORDS) for _ in range(30))
    base += [f"{rng.choice(WORDS)} {passage} {i}" for i in range(8)]
    return base + ["", "  \t ", "a", "x " * 40_000, "naïve café " * 3, "<|endoftext|> a  b\n \nc "]


def documents(spark):
    rows = [(i, t, "en", f"s{min(i % 7, 3)}", len(t)) for i, t in enumerate(texts())]
    rows += [(200, None, None, None, None), (None, texts()[0], "en", "s0", 1), (None, None, None, None, None), rows[3], rows[3]]
    # Columns whose names the operators use inside.
    return spark.createDataFrame(rows, DOC).withColumns(
        {c: F.lit("mine") for c in ("score", "rep", "name", "n_words", "pass", "n_tokens", "component", "row", "kept")})


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def words(t):
    return (t or "").encode().split()


def test_substring_dedup_equals_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    first = {}
    for r in rows:
        w = words(r.text)
        for s in range(len(w) - 12):
            if r.doc_id is not None:
                first[tuple(w[s:s + 13])] = min(r.doc_id, first.get(tuple(w[s:s + 13]), r.doc_id))
    want = []
    for r in rows:
        w, gone = words(r.text), set()
        for s in range(len(w) - 12):
            if r.doc_id is not None and first[tuple(w[s:s + 13])] < r.doc_id:
                gone.update(range(s, s + 13))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((r.doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    for common in (1000, 1):
        got = [tuple(r) for r in substring_dedup.remove_repeats(docs, common=common).drop("kept_text").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_automaton_matches_naive_search():
    rng = random.Random(4)
    a, seen = substring_dedup.Automaton(), []
    for _ in range(40):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 25))]
        subs = {tuple(t[i:j]) for t in seen for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(1, e + 2) if tuple(s[e + 1 - n:e + 1]) in subs), default=0) for e in range(len(s))]
        assert a.match(s) == want
        a.add(s)
        seen.append(s)


def test_decontamination_equals_brute_force(spark, docs):
    some = [t for t in texts() if len(t.split()) > 30]
    items = [(1, " ".join(some[0].split()[3:20]).upper()), (2, "W5-w7"), (10, "no such words here at all"), (3, ""), (4, None),
             (None, some[1]), (1, " ".join(some[0].split()[3:20]).upper()), (5, "x " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    fold = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split()
    pats = {(i, tuple(w[s:s + 10])) for i, t in items if i is not None for w in [fold(t)] for s in range(max(len(w) - 9, min(len(w), 1)))}
    want = []
    for r in docs.select("doc_id", "text").collect():
        w, hit, found = fold(r.text), set(), set()
        for i, p in pats:
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s:s + len(p)]) == p:
                    hit.update(range(s, s + len(p)))
                    found.add(str(i))
        want.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    for shard in (2_000_000, 3):
        got = decontaminate.find_hits(docs, bench, shard_words=shard).select(
            "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert decontaminate.find_hits(docs, bench.limit(0)).where("contaminated").count() == 0


def test_ngram_join_equals_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    def shingles(t):
        w = words(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    sets = [shingles(r.text) if r.doc_id is not None else set() for r in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), (r.doc_id is None, r.doc_id)), (r.doc_id is None, r.doc_id), key=lambda x: (x[0], x[1] or 0))
    want = [(r.doc_id, links[i], least[root(i)][1], r.doc_id == least[root(i)][1]) for i, r in enumerate(rows)]
    for block in (512, 2):
        got = [tuple(r) for r in lsh_forest.near_duplicates(docs, block=block).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def _classes_at(spark, shares, seed, size=400):
    """Classes in pairs whose sets overlap in about the given shares; (table, links of at least 0.8)."""
    rng = np.random.default_rng(seed)
    sets, links = [], 0
    for share in shares:
        common = round(size * share)
        alone = (size - common) // 2
        values = rng.integers(1, 1 << 63, common + 2 * alone, dtype=np.uint64)
        sets += [values[:common + alone], np.concatenate((values[:common], values[common + alone:]))]
        links += common / len(values) >= 0.8
    sigs = lsh_forest.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), lsh_forest.TREES * lsh_forest.DEEPEST)
    return spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sigs)], "rep long, sig binary"), links


def test_forest_shortens_prefixes_as_the_data_ask(spark):
    met = {}
    for name, shares in (("close", [0.99] * 150), ("at the threshold", [0.8] * 400), ("none", [0.0] * 50)):
        classes, links = _classes_at(spark, shares, 4)
        ties, length = lsh_forest.forest(classes, 0.8, 0.99)
        found = {(r.a, r.b) for r in ties.collect()}
        assert found <= {(2 * i + 1, 2 * i) for i in range(len(shares))}
        met[name] = length
        if links:
            assert len(found) >= 0.98 * links
    assert met["close"] > met["at the threshold"] == met["none"] == 4
    # With fewer trees, shorter prefixes are needed.
    assert lsh_forest.forest(_classes_at(spark, [0.8] * 20, 5)[0], 0.8, 0.99, trees=5, deepest=12)[1] < 4


def test_forest_meets_every_pair_once(spark):
    # Nodes in blocks of two rows and whole nodes give the same families as plain prefix comparison.
    rng = np.random.default_rng(6)
    sigs = rng.integers(0, 2, (40, 60), dtype=np.uint32)
    sigs[20:] = sigs[:20]
    sigs[20:][rng.random((20, 60)) < 0.1] = 7
    classes = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sigs)], "rep long, sig binary")
    for block in (1, 512):
        ties, length = lsh_forest.forest(classes, 0.8, 0.99, block=block)
        near = (sigs[:, None] == sigs[None]).sum(axis=2)
        agree = 48 - lsh_forest.SLACK_SIGMAS * (0.16 * 60) ** 0.5
        prefix = (sigs[:, None] == sigs[None]).reshape(40, 40, 10, 6)[..., :length].all(axis=3).any(axis=2)
        want = [set(np.flatnonzero(row)) for row in (prefix & (near >= agree))]
        parent = list(range(40))
        for r in ties.collect():
            a, b = sorted((parent[r.a], parent[r.b]))
            parent = [a if p == b else p for p in parent]
        plain = list(range(40))
        for i, row in enumerate(want):
            for j in row:
                a, b = sorted((plain[i], plain[j]))
                plain = [a if p == b else p for p in plain]
        assert parent == plain


def test_embedding_forest_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    vecs = [(base[i % 30] + rng.standard_normal(16) * 0.1 * (i % 4)).astype(np.float32).tolist() for i in range(240)]
    rows = [(i, v, i % 3) for i, v in enumerate(vecs)] + [(300, vecs[0], 0), (301, None, 1), (302, [0.0] * 16, 1), (303, vecs[5], None),
            (304, [float("nan")] * 16, 1), (305, [None] * 16, 1), (306, vecs[0][:8], 0), (307, [], 0), (None, vecs[0], 0), (308, [1e30] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("mine"))
    got = {r.vec_id: r for r in rp_forest.near_duplicates(df, leaf=16, block=8).collect()}
    ok = [(i, np.array(v, np.float64), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v
          and np.isfinite(v).all() and any(v)]
    links = {i: 0 for i, _, _ in rows}
    for i, v, a in ok:
        for j, w, b in ok:
            if i != j and a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
    assert sum(links.values()) > 50
    assert {i: r.n_links for i, r in got.items()} == links
    reached = {i: i for i, _, _ in rows}
    changed = True
    while changed:  # the smallest id that links reach
        changed = False
        for i, v, a in ok:
            for j, w, b in ok:
                if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98 and reached[j] < reached[i]:
                    reached[i], changed = reached[j], True
    assert {i: r.component_id for i, r in got.items()} == reached
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embedding_forest_splits_large_leaves(spark):
    """Leaves that the sampled trees leave too large, close and equal vectors among them."""
    rng = np.random.default_rng(4)
    dim, base = 32, np.random.default_rng(6).standard_normal((400, 32))
    vecs = [(base[i % 400] + rng.standard_normal(dim) * 0.06 * (i % 3)).tolist() for i in range(1200)]
    vecs += [(base[7] + rng.standard_normal(dim) * 0.01).tolist() for _ in range(150)]  # no cut parts these
    df = spark.createDataFrame([(i, v, 0 if i % 50 else 1) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>, label int")
    label = np.array([0 if i % 50 else 1 for i in range(len(vecs))])
    unit = rp_forest.unit(np.array(vecs))
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    want = near.sum(1) - 1
    got = rp_forest.near_duplicates(df, leaf=10_000, block=32, most=64)
    assert [r.n_links for r in got.orderBy("vec_id").collect()] == want.tolist() and want.sum() > 150 * 149

    rows = df.selectExpr("label", "embedding", "vec_id as rep", "32 as dim", "xxhash64(embedding) as vector",
                         f"array({', '.join(f'{t << rp_forest.TREE_BITS}L' for t in range(2))}) as codes")
    split = rp_forest._split_further(rows.withColumn("label", F.col("label").cast("string")), 0.98, 2, 64)
    sizes = split.select("rep", "label", F.explode("codes").alias("code")).groupBy("label", "code").count().collect()
    assert max(r["count"] for r in sizes if r.code < rp_forest.WHOLE) <= 64
    assert sum(r.code >= rp_forest.WHOLE for r in sizes) >= 1
    for row in split.collect():  # every row stays in every tree
        levels = [(c >> rp_forest.LEVEL_BITS) % 4096 for c in row.codes]
        assert {c % (1 << rp_forest.LEVEL_BITS) >> rp_forest.TREE_BITS + d for c, d in zip(row.codes, levels)} == {0, 1}


def test_embedding_forest_compares_doubles(spark):
    vecs = [[1e300, 0.0], [2e300, 0.0], [1.0, 0.0], [1e-60, 0.0], [0.0, 1e-60], [0.0, -1e300], [5e-324, 0.0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rp_forest.near_duplicates(df).collect()}
    assert got == {0: (4, 0, True), 1: (4, 0, False), 2: (4, 0, False), 3: (4, 0, False), 4: (0, 4, True), 5: (0, 5, True), 6: (4, 0, False)}


def test_embedding_forest_finds_pairs_outside_its_sample():
    """Recall of one forest at the threshold, over vectors that did not train it."""
    rng = np.random.default_rng(8)
    dim, n = 64, 3000
    fitted = rp_forest.fit({dim: rng.standard_normal((6000, dim))}, 0.98)[dim]
    a = rp_forest.unit(rng.standard_normal((n, dim)))
    side = rng.standard_normal((n, dim))
    side -= (side * a).sum(1, keepdims=True) * a
    b = 0.9801 * a + np.sqrt(1 - 0.9801 ** 2) * rp_forest.unit(side)
    width, met = rp_forest.spill_width(dim, 0.98), np.zeros(n, bool)
    for tree in fitted:
        leaves = [[set() for _ in range(n)] for _ in range(2)]
        for kept, vectors in zip(leaves, (a, b)):
            for row, leaf in zip(*(x.tolist() for x in rp_forest.leaves_of(tree, vectors, width))):
                kept[row].add(leaf)
        met |= np.array([bool(x & y) for x, y in zip(*leaves)])
    assert met.mean() >= 0.99


def test_tokens_round_trip_and_order(spark, docs):
    path = scratch_path(spark, "tokens")
    token_blocks.write_tokens(docs, path, chunk=500)
    got = token_blocks.digests(token_blocks.read_tokens(spark, path)).orderBy("start").collect()
    tokenizer = token_blocks.Encoder(token_blocks.tokenizer_path()).tokenizer
    start = 0
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    for g, r in zip(got, rows, strict=True):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert tuple(g) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("ids", [[], [7], [5] * 3000, list(range(1500)), [0, 2**32 - 1, 3], [1] * 1000 + [50_000] * 30])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert (token_blocks.unpack(*token_blocks.pack(ids)) == ids).all()


def test_warc_round_trip(spark):
    page = "<p>" + "ü" * 200
    rows = [(3, "http://a/", page), (1, "http://b/\n x", page), (2, None, page), (4, "u", None), (5, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (None, "u", page), (8, "u", "z" * 3_000_000), (8, "u", "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    path = scratch_path(spark, "warc")
    warc.write_archives(df, path, archive_bytes=300)
    got = warc.read_archives(spark, path).collect()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr)
    n = len(page.encode())
    assert kinds == sorted([(1, "response", None, n), (2, "revisit", 1, n), (3, "revisit", 1, n), (4, "response", None, 0),
                            (5, "response", None, 0), (6, "response", None, 5), (7, "response", None, 5), (None, "revisit", 1, n),
                            (8, "response", None, 3_000_000), (8, "response", None, 3_000_000)], key=repr)
    whole = {r[2] or "" for r in rows}
    assert {r.payload.decode() for r in got if r.payload is not None} == whole
    good = warc.record(1, "u", b"x" * 300)
    assert warc.parse(next(warc.members(pa.BufferReader(good))))["payload"] == b"x" * 300
    with pytest.raises(warc.ArchiveError):
        list(warc.members(pa.BufferReader(good[:-9])))
    text = next(warc.members(pa.BufferReader(good)))
    with pytest.raises(warc.ArchiveError):
        warc.parse(text.replace(b"xxx", b"xyx", 1))


def test_mixing_meets_weights_and_budget(spark):
    rows = [(i, "w " * (1 + i % 9), "big" if i % 10 < 7 else "small" if i % 10 < 9 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("pass", F.lit("mine"))
    sizes = {k: sum(2 + i % 9 for i, _, s in rows if s == k) for k in ("big", "small", None)}
    plan = mixing.plan([float(v) for v in sizes.values()], budget=float(sum(sizes.values())))
    got = mixing.mix(df, block_tokens=500).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()
    for r in got:
        want = dict(zip(sizes, plan.weights, strict=True))[r.source] * sum(sizes.values())
        assert want - 11 <= r.t <= want
    twice = [mixing.mix(df, block_tokens=500).select("doc_id", "pass").exceptAll(
        mixing.mix(df.repartition(7), block_tokens=500).select("doc_id", "pass")).count()]
    assert twice == [0]
    all_kept = mixing.mix(df, budget_share=None, limit=1.5, details=False)
    assert all_kept.columns == df.columns and all_kept.select("doc_id").distinct().count() == 3000
    assert mixing.entropy(plan.weights) >= mixing.ENTROPY - 1e-9 and max(plan.passes) <= mixing.REPEAT_LIMIT + 1e-9
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_orders_every_pass_anew(spark):
    rows = [(i, "w " * 9, "big" if i < 900 else "small") for i in range(1000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_tokens=50).collect()
    passes = {}
    for r in sorted(got, key=lambda r: (r.block_order, r.block, r.doc_order)):
        passes.setdefault((r.source, r["pass"]), []).append(r)
    whole = [p for (s, _), p in sorted(passes.items(), key=lambda kv: kv[0]) if s == "small" and len(p) == 100]
    assert len(whole) > 1
    for p in whole:
        assert len({(r.block, r.block_order) for r in p}) == len({r.block for r in p}) == len({r.block_order for r in p}) > 1
    first, second = ([list(dict.fromkeys(r.block for r in p)), [r.doc_id for r in p]] for p in whole[:2])
    assert first[0] != second[0] and sorted(first[0]) == sorted(second[0]) and sorted(first[1]) == sorted(second[1])
    # A partial pass takes whole blocks in its order and a part of the last.
    (part,) = [p for (s, n), p in passes.items() if s == "big"]
    blocks = list(dict.fromkeys(r.block for r in part))
    assert 1 < len(blocks) < 180 and len(part) < 900


def test_mixing_takes_any_number_of_sources(spark):
    df = spark.range(16_000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + int(id % 9))").alias("text"),
        F.expr("case when id < 4000 then 'hot' else concat('site', id % 10500) end").alias("source")).cache()
    sizes = df.groupBy("source").agg(F.sum(mixing.n_tokens(F.col("text"))).alias("t")).collect()
    assert len(sizes) > 10_000
    for share in (None, 1.0):
        size = None if share is None else float(sum(r.t for r in sizes))
        want = mixing.plan([float(r.t) for r in sizes], 0.99, budget=size)
        got = mixing.mix(df, 0.99, budget_share=share, block_tokens=500).cache()
        visits = {r.source: r.t for r in got.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
        assert want.exponent < 1
        for r, p in zip(sizes, want.passes, strict=True):
            assert p * r.t - 11 <= visits.get(r.source, 0) <= p * r.t + 1e-6
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = mixing.mix(df, 0.99, block_tokens=500).select("doc_id", "pass").collect()
        assert sorted(shuffled) == sorted(got.select("doc_id", "pass").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_toxicity_learns_and_ignores_held_out(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        w = [rng.choice(WORDS) for _ in range(60)]
        if bad:
            w[rng.randrange(60)] = w[rng.randrange(60)] = "horridword"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    df = spark.createDataFrame(rows + [(2000, None), (None, "x"), (2001, "")], "doc_id long, text string").withColumn("score", F.lit("mine"))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (7, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.score(df, toxicity.train(df, lab)).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in out if r.out and r.doc_id is not None and r.doc_id < 900]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 903
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert toxicity.score(df, toxicity.train(df, lab.limit(0))).where("score >= 0.5").count() == 0


def test_html_blocks_extract_the_article(spark):
    rng = np.random.default_rng(1)
    pool = [t for t in texts(3) if t.strip() and len(t) < 900]
    pages = [html_blocks.compose(rng, pool) for _ in range(200)]
    net = html_blocks.fit(pages, composed=400)
    test = [html_blocks.labelled(html_blocks.compose(rng, pool)) for _ in range(80)]
    test = [t for t in test if len(t[0])]
    right = np.concatenate([p == (y > 0) for p, (_, y) in zip(net.predict([x for x, _ in test]), test, strict=True)])
    assert right.mean() > 0.95
    rows = [(1, "u", "<nav><a>Home</a></nav><article><p>One &amp;  two\n three.</p><script>var a='<p>no</p>'</script><p>Four five six."),
            (2, "u", None), (3, "u", ""), (4, "u", "<<>< a <b"), (5, "u", "<article>" + "<p>long text here.</p>" * 5000)]
    rows += [(10 + i, "u", p.replace("", "")) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    got = {r.page_id: r for r in html_blocks.extract(df).collect()}
    assert got[1].text == "One & two three.\nFour five six."
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0 and got[5].text.count("\n") == 4999


def test_html_embedded_elements_lose_nothing():
    def read(page):
        return [(leaf.path.token, leaf.text) for leaf in html_blocks.leaves(page)]

    for name in ("svg", "math", "object", "select", "canvas", "template", "noscript"):
        assert [t for _, t in read(f"<article><p>One</p><{name}><p>Two</p><p>Three</p></article>")] == ["One", "Two", "Three"]
    assert read('<p>One <svg class="i"><path d="M0"/><title>Icon</title></svg> two <math><mi>x</mi></math> <noscript><img></noscript>three</p>') == [
        ("p", "One two x three"), ("svg", "Icon")]
    assert read("<p>Pick <select><option>A<option>B</select> now</p>") == [("p", "Pick now"), ("select", "A"), ("select", "B")]
    assert read("<div><canvas>x</div><p>y</p><p>a<script><p>no</p></script>b</p><style>gone <p>z</p>") == [
        ("div", "x"), ("p", "y"), ("p", "ab")]
    pool = [t for t in texts(3) if t.strip() and len(t) < 900]
    net = html_blocks.fit([f"<p>{t}</p>" for t in pool], composed=400)
    page = f"<nav><ul><li><a>Home</a></li></ul></nav><article><p>{pool[3]}.</p>{{}}<p>{pool[5]}.</p><p>{pool[6]}.</p></article>"
    whole, *others = html_blocks.main_text([page.format(e) for e in ("", "<svg>", "<canvas>", "<object>", "<noscript>")], net)
    assert whole.count("\n") == 2 and others == [whole] * 4
    rng = np.random.default_rng(5)
    test = [html_blocks.labelled(html_blocks.compose(rng, pool, embeds=0.4)) for _ in range(80)]
    test = [t for t in test if len(t[0])]
    right = np.concatenate([p == (y > 0) for p, (_, y) in zip(net.predict([x for x, _ in test]), test, strict=True)])
    assert right.mean() > 0.9


def test_url_rules_and_trees(spark):
    urls = ["https://A.example.NET/en/x?y=1", "http://b.net", "http://b.net/", "http://net/x", "http://xnet/x", "http://a.example.com/de/9", "http://c.org/fr/",
            "http://c.org/en/", "no scheme", None, "", "http://é.net/q#/en/"] + [f"http://s{i}.example.net/{'en' if i % 2 else 'de'}/{i}" for i in range(80)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("score", F.lit("mine"))
    got = {r.page_id: r for r in url_trees.judge(df).collect()}
    assert [got[i].rule for i in range(12)] == ["example.net/en/", None, "net/", "net/", None, "example.com/de/", "org/fr/", None, None, None, None, "net/"]
    assert (got[0].host, got[0].path) == ("a.example.net", "/en/x") and (got[1].host, got[1].path) == ("b.net", "")
    assert (got[8].host, got[9].host, got[11].path) == ("", "", "/q")
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_trees.judge(df.limit(0)).count() == 0


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert substring_dedup.remove_repeats(none).count() == lsh_forest.near_duplicates(none).count() == 0
    path = scratch_path(spark, "none")
    token_blocks.write_tokens(none, path)
    assert token_blocks.read_tokens(spark, path).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert rp_forest.near_duplicates(vectors).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, path + "w")
    assert warc.read_archives(spark, path + "w").count() == html_blocks.extract(pages).count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark, docs, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    hit = [t for t in texts() if len(t.split()) > 40][2]
    spark.createDataFrame([(1, hit)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns, name
        out = out.cache()
    judged = {r.doc_id: r for r in lsh_forest.near_duplicates(docs).collect()}
    left = {r.doc_id: r for r in out.collect()}
    for r in docs.collect():
        if r.doc_id is not None and judged[r.doc_id].kept and hit not in (r.text or ""):
            assert r.doc_id in left or judged[r.doc_id].n_links
            assert r.doc_id not in left or left[r.doc_id].name == "mine"
    assert not any(hit == r.text for r in left.values())
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
