"""Benchmark decontamination: Wu-Manber search for benchmark windows in document words.

Symbols are words. All windows of one length form a matcher: a shift table says, for the two
words that end a text window, how far the window may move without missing a pattern; where it
may not move at all, the bucket of patterns with the same last words is compared word by word,
and what remains is confirmed on the bytes. Documents are cut into lanes that step together,
so the scan runs in numpy.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, share
from abacus.llm._text import ALNUM, LOWER, Words, covered, grams, ranges, text_slices

WINDOW = 10
# One matcher set holds at most this many words of benchmark text. A larger benchmark is cut
# into several sets and the documents are scanned once for each.
SHARD_WORDS = 2_000_000
SHIFT_BITS = 18
LANE = 256


class Matcher:
    """Patterns of one length in words."""

    def __init__(self, patterns: list[tuple[bytes, ...]], hashes: np.ndarray, items: list[list[str]]):
        self.length = m = hashes.shape[1]
        self.block = b = min(2, m)
        self.patterns, self.items, self.hashes = [b" ".join(p) for p in patterns], items, hashes
        self.shift = np.full(1 << SHIFT_BITS, m - b + 1, np.int16)
        for end in range(b, m + 1):
            slot = self._slot(self._blocks(hashes[:, end - b:end]))
            np.minimum.at(self.shift, slot, m - end)
        suffix = self._blocks(hashes[:, m - b:])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def _blocks(self, columns: np.ndarray) -> np.ndarray:
        return grams(columns.reshape(-1), self.block)[::self.block] if len(columns) else np.zeros(0, np.uint64)

    @staticmethod
    def _slot(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def find(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start word, pattern) of every occurrence inside one row."""
        m, b = self.length, self.block
        block = grams(hashes, b)  # block[i] covers words i .. i + b - 1
        shift = self.shift[self._slot(block)]
        windows = np.maximum(words.count - m + 1, 0)
        lanes = -(-windows // LANE)
        row = np.repeat(np.arange(len(windows)), lanes)
        nth = ranges(np.zeros(len(lanes), np.int64), lanes)
        first = words.row_first[row] + nth * LANE
        last = np.minimum(first + LANE, words.row_first[row] + windows[row]) - 1
        at, last, found = first + (m - b), last + (m - b), []  # place of the window's last block
        while len(at):
            move = shift[at]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            live = at <= last
            at, last = at[live], last[live]
        place = np.concatenate(found) if found else np.zeros(0, np.int64)
        low = np.searchsorted(self.suffix, block[place], "left")
        many = np.searchsorted(self.suffix, block[place], "right") - low
        start, pattern = np.repeat(place - (m - b), many), self.order[ranges(low, many)]
        for j in range(m):
            same = hashes[start + j] == self.hashes[pattern, j]
            start, pattern = start[same], pattern[same]
        kept = [i for i, (s, p) in enumerate(zip(start, pattern, strict=True))
                if b" ".join(words.text(w) for w in range(s, s + m)) == self.patterns[p]]
        return start[kept], pattern[kept]


def _items_words(texts: list[str]) -> tuple[Words, np.ndarray]:
    _, _, data, offsets = next(text_slices(pa.array(texts, pa.string()), 1 << 62))
    words = Words(data, offsets, ALNUM, LOWER)
    return words, words.hashes()


def matchers(items: list[tuple[str, str]], window: int = WINDOW) -> list[Matcher]:
    """One matcher per window length of (id, text) items; an item without words has none."""
    if not items:
        return []
    words, hashes = _items_words([text for _, text in items])
    lengths: dict[int, dict[tuple[bytes, ...], tuple[int, set[str]]]] = {}
    for i, (item, _) in enumerate(items):
        first, end = words.row_first[i], words.row_first[i + 1]
        size = min(window, int(end - first))
        texts = [words.text(w) for w in range(first, end)]
        for s in range(int(end - first) - size + 1 if size else 0):
            lengths.setdefault(size, {}).setdefault(tuple(texts[s:s + size]), (int(first) + s, set()))[1].add(item)
    out = []
    for size, found in sorted(lengths.items()):
        at = np.array([place for place, _ in found.values()])
        out.append(Matcher(list(found), hashes[at[:, None] + np.arange(size)], [sorted(i) for _, i in found.values()]))
    return out


def benchmark_shards(benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> list[list[tuple[str, str]]]:
    """(item_id, text) of the benchmark in lists of at most ``shard_words`` words (or one item)."""
    size = F.length("text") / 2 + 1
    rows = (benchmark.where("item_id is not null and text is not null")
            .select(F.col("item_id").cast("string").alias("item_id"), "text", size.alias("size")).distinct()
            .orderBy("item_id", "text"))
    shards: list[list[tuple[str, str]]] = []
    room = 0.0
    for row in rows.toLocalIterator():
        if not shards or row["size"] > room:
            shards.append([])
            room = float(shard_words)
        shards[-1].append((row["item_id"], row["text"]))
        room -= row["size"]
    return shards


def with_hits(docs: DataFrame, benchmark: DataFrame, out: str, text_col: str = "text", window: int = WINDOW,
              shard_words: int = SHARD_WORDS) -> DataFrame:
    """Add ``out``, a struct of n_words, n_hit, n_items, items_sha256 and contaminated, to each row.

    A null or empty text has no words and is clean. Benchmark rows without id or text are left
    out; repeated ones count once. Each row of ``docs`` is judged by itself. What is broadcast is
    one shard of the benchmark, whose size is bounded by parameter.
    """
    bounded_batches(docs.sparkSession)
    hits = []
    found = docs
    for n, shard in enumerate(benchmark_shards(benchmark, shard_words) or [[]]):
        hits.append(f"__hits_{n}")
        found = found.withColumn(hits[-1], _searcher(share(docs.sparkSession, matchers(shard, window)))(F.col(text_col)))
    spans, items = (F.concat(*[F.col(f"{h}.{k}") for h in hits]) for k in ("spans", "items"))
    summed = F.arrow_udf(_summed, "struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,contaminated:boolean>")
    return found.withColumn(out, summed(F.col(f"{hits[0]}.words"), spans, items)).drop(*hits)


def find_hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The fields of ``with_hits`` as columns; columns of these names are replaced."""
    found = with_hits(docs, benchmark, "__found", **options)
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return found.withColumns({c: F.col(f"__found.{c}") for c in names}).drop("__found")


def _summed(total: pa.Array, spans: pa.Array, items: pa.Array) -> pa.Array:
    words, many, names, digests = total.to_pylist(), [], [], []
    for n, s, i in zip(words, spans.to_pylist(), items.to_pylist(), strict=True):
        i = sorted(set(i))
        s = np.array(s, np.int64).reshape(-1, 2)
        many.append(int(covered(n, s[:, 0], s[:, 1]).sum()) if len(s) else 0)
        names.append(len(i))
        digests.append(hashlib.sha256(",".join(i).encode()).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(words, pa.int64()), pa.array(many, pa.int64()), pa.array(names, pa.int64()), pa.array(digests, pa.string()),
         pa.array([m > 0 for m in many], pa.bool_())], names=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _searcher(shared):
    @F.arrow_udf("struct<words:int,spans:array<int>,items:array<string>>")
    def search(column: pa.Array) -> pa.Array:
        return _search(column, shared())

    return search


def _search(column: pa.Array, found: list[Matcher]) -> pa.Array:
    total, spans, items = [], [], []
    for _, _, data, offsets in text_slices(column):
        words = Words(data, offsets, ALNUM, LOWER)
        hashes = words.hashes() if found else None
        own_spans: list[list[int]] = [[] for _ in words.count]
        own_items: list[set[str]] = [set() for _ in words.count]
        for matcher in found:
            start, pattern = matcher.find(words, hashes)
            row = np.searchsorted(words.row_first, start, "right") - 1
            for s, p, r in zip(start.tolist(), pattern.tolist(), row.tolist(), strict=True):
                s -= int(words.row_first[r])
                own_spans[r] += (s, s + matcher.length)
                own_items[r].update(matcher.items[p])
        total += words.count.tolist()
        spans += own_spans
        items += [sorted(i) for i in own_items]
    return pa.StructArray.from_arrays(
        [pa.array(total, pa.int32()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
        names=["words", "spans", "items"])
