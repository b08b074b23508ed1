"""URL filter: host and path rules, and boosted trees on lexical features for all other URLs.

The rules are a few fixed columns. URLs that a rule decides are the labelled ones: a bounded
sample of them trains gradient-boosted trees in one task, and the trees score every URL in
Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import share

# (verdict, host, path) of the rules in force.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Training uses about this many URLs of each class (all, if there are fewer), chosen by a hash.
TRAIN_PER_CLASS = 10_000
TREES = 40
DEPTH = 3
BINS = 32
RATE = 0.2
LEAF_WEIGHT = 1.0
PRIOR = 20.0


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host lower-cased in A-Z only; both empty for null or no ``://``."""
    known = url.isNotNull() & url.contains("://")
    rest = F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)
    rest = F.split(rest, "[?#]", 2)[0]
    host = F.split(rest, "/", 2)[0]
    path = F.substr(rest, F.length(host) + 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def with_rule(urls: DataFrame, rules=RULES, url_col: str = "url") -> DataFrame:
    """Add host, path, rule (host and path of the longest that fits, else null) and rule_verdict."""
    host, path = split_url(F.col(url_col))
    out = urls.withColumn("host", host).withColumn("path", path)
    name = verdict = F.lit(None).cast("string")
    # The longest rule wins, so longer ones are tried first; equal lengths in order of text.
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return out.withColumn("rule", name).withColumn("rule_verdict", verdict)


FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "dots", "hyphens",
            "labels", "upper_ratio", "longest_part", "suffix_rate", "suffix_count", "wide_suffix_rate")


def lexical(url: str | None) -> tuple[list[float], str, str]:
    """The features of one URL without its suffix statistics, and its last one and two host labels."""
    url = url or ""
    rest = url.partition("://")[2] or url
    body, _, query = rest.partition("?")
    host, _, path = body.partition("#")[0].partition("/")
    n = max(len(url), 1)
    raw = url.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=1) if raw else np.zeros(1)
    share_ = counts[counts > 0] / max(len(raw), 1)
    labels = host.lower().split(".")
    return ([len(url), len(host), len(path), path.count("/"), sum(c.isdigit() for c in url) / n,
             float(-(share_ * np.log2(share_)).sum()), query.count("=") + query.count("&"), host.count("."), host.count("-"),
             len(labels), sum(c.isupper() for c in url) / n, max(map(len, labels))],
            labels[-1], ".".join(labels[-2:]))


@dataclass
class Model:
    rates: dict[str, tuple[float, float]]
    base: float
    cuts: np.ndarray  # per feature, the bins' upper ends
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature, bin and value of each node, level by level


def _table(urls: list[str | None], rates: dict, prior: float) -> np.ndarray:
    out = np.zeros((len(urls), len(FEATURES)))
    for i, url in enumerate(urls):
        plain, last, wide = lexical(url)
        rate, count = rates.get(last, (prior, 0.0))
        out[i] = [*plain, rate, np.log1p(count), rates.get(wide, (prior, 0.0))[0]]
    return out


def _binned(table: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(cuts[f], table[:, f], "left") for f in range(table.shape[1])], axis=1)


def fit(urls: list[str], blocked: np.ndarray) -> Model:
    """Boost on the logistic loss. Without both classes the model always gives the one seen (none: allow)."""
    blocked = np.asarray(blocked, float)
    base = float(blocked.mean()) if len(blocked) else 0.0
    if base in (0.0, 1.0):
        return Model({}, -4.0 if base == 0 else 4.0, np.zeros((len(FEATURES), 0)), [])
    tally: dict[str, list[float]] = {}
    for url, y in zip(urls, blocked, strict=True):
        for suffix in set(lexical(url)[1:]):
            kept = tally.setdefault(suffix, [0.0, 0.0])
            kept[0] += y
            kept[1] += 1
    rates = {k: ((s + PRIOR * base) / (n + PRIOR), n) for k, (s, n) in tally.items() if n >= 5}
    table = _table(urls, rates, base)
    cuts = np.quantile(table, np.arange(1, BINS) / BINS, axis=0).T
    bins = _binned(table, cuts)
    margin = np.full(len(urls), np.log(base / (1 - base)))
    model = Model(rates, float(margin[0]), cuts, [])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - blocked, p * (1 - p)
        node = np.zeros(len(urls), np.int64)
        inner = (1 << DEPTH) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(DEPTH):
            first, size = (1 << level) - 1, 1 << level
            best = np.zeros(size)
            g_all, h_all = np.bincount(node, slope, size), np.bincount(node, curve, size)
            for f in range(len(FEATURES)):
                key = node * BINS + bins[:, f]
                g = np.cumsum(np.bincount(key, slope, size * BINS).reshape(size, BINS), axis=1)
                h = np.cumsum(np.bincount(key, curve, size * BINS).reshape(size, BINS), axis=1)
                gain = (g ** 2 / (h + LEAF_WEIGHT) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + LEAF_WEIGHT)
                        - (g_all ** 2 / (h_all + LEAF_WEIGHT))[:, None])
                at = gain.argmax(axis=1)
                top = gain[np.arange(size), at]
                better = top > best + 1e-9
                best = np.where(better, top, best)
                feature[first:first + size] = np.where(better, f, feature[first:first + size])
                cut[first:first + size] = np.where(better, at, cut[first:first + size])
            node = node * 2 + (bins[np.arange(len(urls)), feature[first + node]] > cut[first + node])
        g, h = np.bincount(node, slope, 1 << DEPTH), np.bincount(node, curve, 1 << DEPTH)
        value = -RATE * g / (h + LEAF_WEIGHT)
        margin += value[node]
        model.trees.append((feature, cut, value))
    return model


def raw_scores(urls: list[str | None], model: Model) -> np.ndarray:
    """Margins, positive where blocking is likelier."""
    out = np.full(len(urls), model.base)
    if not model.trees or not urls:
        return out
    prior = 1 / (1 + np.exp(-model.base))
    bins = _binned(_table(urls, model.rates, prior), model.cuts)
    rows = np.arange(len(urls))
    for feature, cut, value in model.trees:
        node = np.zeros(len(urls), np.int64)
        for level in range(DEPTH):
            at = (1 << level) - 1 + node
            node = node * 2 + (bins[rows, feature[at]] > cut[at])
        out += value[node]
    return out


def train(ruled: DataFrame, per_class: int = TRAIN_PER_CLASS, url_col: str = "url") -> Model:
    """Fit on a bounded sample, in one task, of the different URLs that a rule decides."""
    labelled = ruled.where(F.col("rule_verdict").isNotNull()).select(
        F.col(url_col).alias("url"), (F.col("rule_verdict") == "block").cast("int").alias("blocked")).distinct()
    found = labelled.groupBy("blocked").count()
    places = 1 << 30
    sample = labelled.join(F.broadcast(found), "blocked").where(
        F.pmod(F.xxhash64("url"), F.lit(places)) < F.lit(float(per_class * places)) / F.col("count"))

    def run(batches):
        from pyspark import cloudpickle

        rows = sorted(r for b in batches for r in zip(b["url"].to_pylist(), b["blocked"].to_pylist(), strict=True))
        model = fit([u for u, _ in rows], np.array([y for _, y in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)])], names=["model"])

    import pickle

    row = sample.select("url", "blocked").repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([], np.zeros(0))


def judge(urls: DataFrame, rules=RULES, per_class: int = TRAIN_PER_CLASS, url_col: str = "url") -> DataFrame:
    """Add host, path, rule, verdict and score (the trees' probability of blocking).

    The verdict is the rule's, or where none fits ``block`` from a score of one half. A null
    URL, or one without ``://``, has empty host and path and is scored on its text alone.
    Rows are judged one by one; repeated ones alike. Columns of these names, and one named
    rule_verdict, are replaced or dropped.
    """
    ruled = with_rule(urls, rules, url_col)
    shared = share(urls.sparkSession, train(ruled, per_class, url_col))

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-raw_scores(column.to_pylist(), shared()))))

    return (ruled.withColumn("score", scored(F.col(url_col)))
            .withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")))
            .drop("rule_verdict"))
