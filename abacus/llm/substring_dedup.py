"""Substring deduplication with suffix automata of reference shards.

A word is removed if a window of WINDOW words around it also starts in a document with a
smaller id. In short: (1) a text that equals one of a smaller id loses all its windows at once
and is no reference. (2) Each window is named by its least word k-gram, so equal windows have
equal names; names that occur in two documents or more are kept, the rest can't repeat.
(3) The runs of windows under a kept name are passages; a passage that equals one of a smaller
id goes whole. (4) The first of equal passages are hashed by name into shards of bounded size.
A shard is a suffix automaton that grows in the order of ids: each passage streams through the
automaton of all smaller ids, and matching statistics of at least WINDOW words give the maximal
spans to remove. (5) Spans go back to the documents. The texts are shuffled once, by id; every
step that needs them reuses that exchange.

The automata are spread by a shuffle, not broadcast: together they grow with the repeated part
of the corpus, and a passage needs only the shard of its name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, by_run, grouped, released
from abacus.llm._text import SPACED, Words, covered, grams, mix, ranges, signed, text_slices

WINDOW = 13
GRAM = 5
# A name in more documents than this is split: each of its windows becomes a passage of its own.
COMMON = 1000
# Passages that a shard's automaton holds, about.
SHARD_PASSAGES = 12_000
# Names are shortened to shuffle less; unequal windows may share one.
NAME_BITS = 48
_RANGE = 0xA0761D6478BD642F | 1


class Automaton:
    """A suffix automaton of several sequences; a sequence never matches across two of them."""

    def __init__(self):
        self.next, self.link, self.size = [{}], [-1], [0]

    def match(self, word_ids: list[int]) -> list[int]:
        """For each place, the length of the longest match that ends there."""
        nexts, link, size = self.next, self.link, self.size
        state, length, out = 0, 0, []
        for c in word_ids:
            step = nexts[state].get(c)
            while step is None and state:
                state = link[state]
                length = size[state]
                step = nexts[state].get(c)
            if step is not None:
                state, length = step, length + 1
            out.append(length)
        return out

    def add(self, word_ids: list[int]) -> None:
        nexts, link, size = self.next, self.link, self.size
        last = 0
        for c in word_ids:
            step = nexts[last].get(c)
            if step is not None:
                # The sequence so far is known: go to its state, split off if that holds longer ones too.
                last = step if size[step] == size[last] + 1 else self._split(last, c, step)
                continue
            new = len(nexts)
            nexts.append({})
            size.append(size[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and c not in nexts[state]:
                nexts[state][c] = new
                state = link[state]
            if state >= 0:
                step = nexts[state][c]
                link[new] = step if size[step] == size[state] + 1 else self._split(state, c, step)
            last = new

    def _split(self, state: int, c: int, step: int) -> int:
        nexts, link, size = self.next, self.link, self.size
        new = len(nexts)
        nexts.append(dict(nexts[step]))
        size.append(size[state] + 1)
        link.append(link[step])
        link[step] = new
        while state >= 0 and nexts[state].get(c) == step:
            nexts[state][c] = new
            state = link[state]
        return new


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of every ``width`` consecutive values."""
    reach, out = 1, values
    while reach < width:
        step = min(reach, width - reach)
        out = pick(out[:-step], out[step:])
        reach += step
    return out


def names(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, name) of every window inside one row; the name is its least ``gram``-gram."""
    counts = np.maximum(words.count - window + 1, 0)
    starts = ranges(words.row_first[:-1], counts)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    least = sliding(grams(hashes, gram), window - gram + 1, np.minimum)[starts]
    return starts, least >> np.uint64(64 - NAME_BITS)


def runs(row: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end index of the runs of windows with one name in one row."""
    change = np.flatnonzero((row[1:] != row[:-1]) | (name[1:] != name[:-1])) + 1
    return np.concatenate(([0], change)), np.concatenate((change, [len(name)]))


def range_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words of each span [start, end)."""
    n = len(hashes)
    powers = np.full(n + 1, _RANGE, np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers[:n], out=sums[1:])
    value = sums[end] - sums[start]
    powers[:] = pow(_RANGE, -1, 1 << 64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    return mix(value * powers[start] + (end - start).astype(np.uint64))


def _slices(batch: pa.RecordBatch, window: int, gram: int):
    """For each slice: (first row, words, hashes, start and name of windows, their row)."""
    for first, _, data, offsets in text_slices(batch["text"]):
        words = Words(data, offsets, SPACED)
        hashes = words.hashes()
        starts, name = names(words, hashes, window, gram)
        yield first, words, hashes, starts, name, np.searchsorted(words.row_first, starts, "right") - 1


def _shard(group: pa.Table, window: int) -> pa.Table:
    """Spans of each passage whose windows occur under a smaller id, a row per passage."""
    group = group.sort_by([("doc_id", "ascending")])
    automaton, ids = Automaton(), group["doc_id"].to_pylist()
    words = [np.frombuffer(w, np.uint32).tolist() for w in group["words"].to_pylist()]
    spans, held = [], []
    for i, own in enumerate(words):
        if held and ids[i] != ids[held[0]]:
            for h in held:
                automaton.add(words[h])
            held = []
        found: list[int] = []
        for at, length in enumerate(automaton.match(own)):
            if length >= window:
                if found and at - length + 1 <= found[-1]:
                    found[-1] = at + 1
                else:
                    found += (at - length + 1, at + 1)
        # A passage that occurs whole adds nothing.
        if found[:2] != [0, len(own)]:
            held.append(i)
        spans.append(found)
    return group.select(["doc_id", "row", "start"]).append_column("spans", pa.array(spans, pa.list_(pa.int32())))


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """An order of the rows by the columns, without those that repeat the one before."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    return order[new]


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, common: int = COMMON,
                   shard_passages: int = SHARD_PASSAGES) -> DataFrame:
    """(doc_id, rows, starts, spans) of ``docs`` (doc_id, text, row): which words of a row repeat."""

    def named(batches):
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for first, _, _, _, name, row in _slices(batch, window, gram):
                if len(name):
                    start, _ = runs(row, name)
                    name, doc = name[start], ids[first + row[start]]
                    keep = _distinct(name, doc)
                    name, doc = name[keep], doc[keep]
                    at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
                    many, low = np.diff(np.concatenate((at, [len(name)]))), doc[at]
                    # In the order of ids, which packs better.
                    order = np.argsort(low, kind="stable")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v[order]) for v in (signed(name[at]), low, doc[at + many - 1] - low, many)],
                        names=["name", "low", "span", "docs"])

    def listed(batches):
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for first, _, _, _, name, row in _slices(batch, window, gram):
                if len(name):
                    start, _ = runs(row, name)
                    doc, name = ids[first + row[start]], name[start]
                    keep = _distinct(doc, name)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(name[keep])), pa.array(doc[keep])], names=["name", "doc_id"])

    texts = docs.where("not copy").select("doc_id", "text")
    shared = (texts.mapInArrow(released(named), "name long, low long, span long, docs long").groupBy("name")
              .agg(F.min("low").alias("low"), F.max(F.col("low") + F.col("span")).alias("high"), F.sum("docs").alias("docs"))
              .where("low < high").select("name", (F.col("docs") > common).alias("common")))
    wanted = (texts.mapInArrow(released(listed), "name long, doc_id long").join(shared.hint("merge"), "name")
              .groupBy("doc_id").agg(F.collect_list(F.struct("name", "common")).alias("names"))
              .select("doc_id", F.col("names.name").alias("names"), F.col("names.common").alias("common")))

    def passages(batches):
        for batch in batches:
            ids, rows = batch["doc_id"].to_numpy(), batch["row"].to_numpy()
            for first, words, hashes, starts, name, row in _slices(batch, window, gram):
                if not len(name):
                    continue
                begin, end = runs(row, name)
                kept, often = (batch[c].slice(first, len(words.count)).flatten().to_numpy(zero_copy_only=False)
                               for c in ("names", "common"))
                kept = kept.view(np.uint64)
                own = _member(name[begin], np.sort(kept))
                begin, end = begin[own], end[own]
                split = _member(name[begin], np.sort(kept[often]))
                # Windows of common names one by one, runs of the others.
                single = ranges(begin[split], (end - begin)[split])
                start = np.concatenate((starts[begin[~split]], starts[single]))
                stop = np.concatenate((starts[end[~split] - 1], starts[single])) + window
                ctx = range_hashes(hashes, start, stop)
                key = np.concatenate((name[begin[~split]], ctx[len(ctx) - len(single):]))
                row_of = np.concatenate((row[begin[~split]], row[single]))
                columns = (signed(key), signed(ctx), ids[first + row_of], rows[first + row_of],
                           (start - words.row_first[row_of]).astype(np.int32), (stop - start).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                 names=["key", "ctx", "doc_id", "row", "start", "size"])

    found = (docs.join(wanted.hint("merge"), "doc_id", "left").where("not copy and names is not null")
             .select("doc_id", "text", "row", "names", "common")
             .mapInArrow(released(passages), "key long, ctx long, doc_id long, row long, start int, size int"))
    least = found.groupBy("key", "ctx").agg(F.min("doc_id").alias("first"))
    placed = found.join(least.hint("merge"), ["key", "ctx"])
    later = placed.where("doc_id > first").select("doc_id", "row", "start", F.array(F.lit(0), F.col("size")).alias("spans"))

    def worded(batches):
        for batch in batches:
            ids, own_rows = batch["doc_id"].to_pylist(), batch["row"].to_pylist()
            lists = batch["firsts"].to_pylist()
            for first, _, data, offsets in text_slices(batch["text"]):
                words = Words(data, offsets, SPACED)
                short = (words.hashes() & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                out = []
                for i, base in enumerate(words.row_first[:-1].tolist()):
                    at = first + i
                    out += [(p["key"], ids[at], own_rows[at], p["start"], short[base + p["start"]:base + p["start"] + p["size"]].tobytes())
                            for p in lists[at] if p["row"] == own_rows[at]]
                if out:
                    key, doc, row, start, content = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(row, pa.int64()),
                         pa.array(start, pa.int32()), pa.array(content, pa.binary())], names=["key", "doc_id", "row", "start", "words"])

    # Not an equality, which would become a key of the join and shuffle the passages once more.
    firsts = (placed.where("doc_id <= first").groupBy("doc_id")
              .agg(F.collect_list(F.struct("key", "row", "start", "size")).alias("firsts")))
    contents = (docs.join(firsts.hint("merge"), "doc_id", "left").where("not copy and firsts is not null")
                .select("doc_id", "text", "row", "firsts")
                .mapInArrow(released(worded), "key long, doc_id long, row long, start int, words binary"))
    matched = by_run(contents, ["key"], lambda g: _shard(g, window),
                     "doc_id long, row long, start int, spans array<int>", shard_passages).where("size(spans) > 0")
    return (later.unionByName(matched).groupBy("doc_id").agg(F.collect_list(F.struct("row", "start", "spans")).alias("found"))
            .select("doc_id", F.col("found.row").alias("rows"), F.col("found.start").alias("starts"), F.col("found.spans").alias("spans")))


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), max(len(among) - 1, 0))
    return among[at] == values if len(among) else np.zeros(len(values), bool)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, common: int = COMMON,
                   shard_passages: int = SHARD_PASSAGES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text), a row per row of ``docs``.

    Words are runs of anything but ASCII white space; ``kept_text`` joins the kept ones by one
    space. A word goes if a window of ``window`` words that covers it also starts in a row with
    a smaller id, judged on the texts as given. Rows of one id do not remove from each other. Null
    and empty texts have no words; rows without an id keep theirs and remove none. An empty table
    gives an empty one; other columns are ignored.
    """
    # An alias that does nothing would keep the planner from seeing that the exchanges are equal.
    bounded_batches(docs.sparkSession)
    plain = id_col == "doc_id" and docs.schema[id_col].dataType.simpleString() == "bigint"
    texts = docs.select("doc_id" if plain else F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("row", F.xxhash64("text"))
    nameless = texts.where("doc_id is null")
    # Every use of the texts has this filter, so all share one exchange.
    texts = texts.where("doc_id is not null")
    # Texts that equal one of a smaller id.
    known = texts.select("doc_id", "row", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    copies = (known.join(grouped(known, "sha").agg(F.min("doc_id").alias("first")).drop("__deal").hint("merge"), "sha").where("doc_id > first")
              .groupBy("doc_id").agg(F.collect_set("row").alias("copies")))
    texts = texts.join(copies.hint("merge"), "doc_id", "left").select(
        "doc_id", "text", "row", F.coalesce(F.array_contains("copies", F.col("row")), F.lit(False)).alias("copy"))
    spans = repeated_spans(texts, window, gram, common, shard_passages)

    def cut(batches):
        for batch in batches:
            own_rows, copy = batch["row"].to_pylist(), batch["copy"].to_pylist()
            lists = [batch[c].to_pylist() for c in ("rows", "starts", "spans")]
            for first, _, data, offsets in text_slices(batch["text"]):
                words = Words(data, offsets, SPACED)
                out = []
                for i, total in enumerate(words.count.tolist()):
                    gone, at = np.zeros(total, bool), first + i
                    if copy[at]:
                        gone[:] = total >= window
                    elif lists[0][at] is not None:
                        marks = [(start + s, start + e) for row, start, found in zip(*(c[at] for c in lists), strict=True)
                                 if row == own_rows[at] for s, e in zip(found[::2], found[1::2], strict=True)]
                        if marks:
                            marks = np.array(marks)
                            gone = covered(total, marks[:, 0], marks[:, 1])
                    kept = np.flatnonzero(~gone) + words.row_first[i]
                    if len(kept) == total:
                        text = b" ".join(data[offsets[i]:offsets[i + 1]].tobytes().split())
                    else:
                        text = b" ".join(words.text(w) for w in kept)
                    out.append((total, int(gone.sum()), hashlib.sha256(text).hexdigest(), text.decode()))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(out)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    marked = texts.join(spans.hint("merge"), "doc_id", "left").select("doc_id", "text", "row", "copy", "rows", "starts", "spans")
    return (marked.unionByName(nameless.withColumn("copy", F.lit(False)), allowMissingColumns=True)
            .mapInArrow(released(cut), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
            .withColumnRenamed("doc_id", id_col))
