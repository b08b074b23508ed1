"""Token ids in patched frame-of-reference blocks.

Documents are range-partitioned and sorted by id, encoded, and written as chunks: whole
documents up to about CHUNK ids (or one longer document). A chunk's ids are cut into blocks
of BLOCK. Each block subtracts its minimum, is packed at the width that holds PERCENTILE of
its differences, and keeps the rest in an exception list; the chunk has an index of the
blocks' starts. A chunk is one row of a Parquet table, so Spark's writer commits the files
and a lost executor leaves none half-written, and every chunk is read by itself.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from itertools import chain, compress
from operator import not_
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abacus.llm._store import bounded_batches, released
from abacus.llm._text import ranges, text_slices

BLOCK = 1024
CHUNK = 1 << 16
PERCENTILE = 90
END_ID = 0
# Texts are encoded together up to about this many bytes.
SLICE_BYTES = 4 << 20
TOKENIZER = "byte_bpe_50k.json"
# The encoder forgets the pieces it knows beyond this many pieces or characters.
# Words that the library encodes as one text.
WORDS_AT_ONCE = 100
KNOWN_PIECES = 500_000
KNOWN_CHARS = 16_000_000
# Ahead of a block's bytes: ids, minimum, width, exceptions.
_HEAD = "<HIBH"


class _Slots(dict):
    """Numbers keys as they are first asked for."""

    def __init__(self, keys=()):
        super().__init__(zip(keys, range(len(keys)), strict=True))
        self.keys_in_order = list(keys)

    def __missing__(self, key):
        self[key] = number = len(self)
        self.keys_in_order.append(key)
        return number


class Encoder:
    """Encodes texts piece by piece with the tokenizers library and remembers the pieces.

    The byte-level split never crosses a space that is followed by something else than white
    space, so the parts of a text between such spaces are encoded once each; nor does it cross
    from a letter or digit to the punctuation that ends a part. A text that holds the string of a
    special token is encoded whole. When it knows too many pieces, the encoder forgets those
    that it has met only once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer
        self.by_piece = (isinstance(self.tokenizer.model, BPE) and self.tokenizer.normalizer is None and isinstance(split, ByteLevel)
                         and split.use_regex and not split.add_prefix_space)
        if self.by_piece:
            space = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]
            vocabulary = self.tokenizer.get_vocab()
            self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
            self.opens[[i for token, i in vocabulary.items() if token.startswith(space)]] = True
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.cut = re.compile(r"(?= \S)")
        # A space followed by any white space, or by nothing: such a text is cut with care.
        self.loose = r" ([\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)" + "".join("|" + re.escape(t) for t in special)
        self.slots = _Slots()
        self.flat, self.chars = np.zeros(1 << 16, np.uint32), 0
        self.first, self.size, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.used, self.known = 0, 0
        self.most = self.between_tasks = KNOWN_PIECES

    def encode(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array without nulls, each text's followed by ``end_id``, and how many each has."""
        if not self.by_piece:
            ids = [[*e.ids, end_id] for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array(list(chain.from_iterable(ids)), np.uint32), np.array(list(map(len, ids)), np.int64)
        if len(self.slots) > self.most or self.chars > KNOWN_CHARS:
            self._forget()
        careful = pc.match_substring_regex(texts, self.loose).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(careful), "", texts), " ")
        ends = split.offsets.to_numpy()[1:].astype(np.int64)
        many = np.diff(split.offsets.to_numpy()).astype(np.int64)
        parts = split.flatten().dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = self.slots
        number = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
        found = number[parts.indices.to_numpy(zero_copy_only=False)]
        # Heads have no space before them; an empty one is none.
        heads = ends - many
        text_heads = parts.take(pa.array(heads)).cast(pa.string()).to_numpy(zero_copy_only=False)
        found[heads] = [slots[(h,)] for h in text_heads]
        if careful.any():
            rest = [self._careful(t) if c else None for t, c in zip(texts.to_pylist(), careful.tolist(), strict=True)]
            pieces = [found[h:e] if r is None else np.array([slots[k] for k in r], np.int64)
                      for h, e, r in zip(heads, ends, rest, strict=True)]
            many = np.array([len(p) for p in pieces])
            found, ends = np.concatenate(pieces), np.cumsum(many)
        self._learn()
        self.uses += np.bincount(found, minlength=len(self.uses))
        sizes = self.size[found]
        before = np.concatenate(([0], np.cumsum(sizes)))
        lengths = before[ends] - before[ends - many] + 1
        # Places of the pieces' ids: each text leaves one more for its end.
        ids = np.full(int(lengths.sum()), end_id, np.uint32)
        ids[ranges(before[:-1] + np.repeat(np.arange(len(many)), many), sizes)] = self._gather(found)
        return ids, lengths

    def _careful(self, text: str) -> list:
        if self.special.search(text):
            return [("whole", text)]
        return [p[1:] if p[0] == " " else (p,) for p in self.cut.split(text) if p]

    def _grow(self, name: str, size: int) -> None:
        held = getattr(self, name)
        if size > len(held):
            more = np.zeros(max(size, 2 * len(held), 1024), held.dtype)
            more[:len(held)] = held
            setattr(self, name, more)

    def _keep(self, slots: list[int], sizes: np.ndarray, ids: np.ndarray) -> None:
        """The ids of several slots, one after another."""
        self._grow("flat", self.used + len(ids))
        self.flat[self.used:self.used + len(ids)] = ids
        self.first[slots], self.size[slots] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(ids)

    def _gather(self, slots: np.ndarray) -> np.ndarray:
        sizes = self.size[slots]
        return self.flat[ranges(self.first[slots], sizes)]

    def _learn(self) -> None:
        slots = self.slots
        keys, at = slots.keys_in_order, self.known
        letters, whole, joined, halves = [], [], [], []
        while at < len(keys):  # which grows
            new = keys[at:]
            plain = [type(k) is str and k.isalpha() and (k.isascii() or max(k) < "\u0250") for k in new]
            letters += compress(range(at, at + len(new)), plain)
            for i, key in compress(enumerate(new, at), map(not_, plain)):
                core = key.rstrip(punctuation) if type(key) is str else ""
                if core and len(core) < len(key) and core[-1].isalnum():
                    joined.append(i)
                    halves += (slots[core], slots[("tail", key[len(core):])])
                else:
                    whole.append(i)
            at += len(new)
        for name in ("first", "size", "uses"):
            self._grow(name, len(keys))
        # A word of plain letters is one piece of the split: many go through the library as one
        # text, and the ids whose token begins with the space tell where each word's begin.
        if letters:
            words = [keys[i] for i in letters]
            texts = [" " + " ".join(words[i:i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
            first = np.flatnonzero(self.opens[ids])
            self._keep(letters, np.diff(np.append(first, len(ids))), ids)
            self.chars += sum(map(len, words))
        for low in range(0, len(whole), 20_000):
            own = whole[low:low + 20_000]
            texts = [" " + keys[i] if isinstance(keys[i], str) else keys[i][-1] for i in own]
            self.chars += sum(map(len, texts))
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._keep(own, sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())))
        if joined:
            halves = np.array(halves)
            self._keep(joined, self.size[halves].reshape(-1, 2).sum(1), self._gather(halves))
        self.known = len(keys)

    def rest(self) -> None:
        """Between tasks, keep what has been met more than once."""
        if len(self.slots) > self.between_tasks:
            self._forget()

    def _forget(self) -> None:
        uses = self.uses[:len(self.slots)]
        kept = np.flatnonzero(uses > max(1, np.sort(uses)[-(self.most // 2)] if len(uses) > self.most // 2 else 1))
        keys = self.slots.keys_in_order
        kept = kept[[len(keys[k]) < 64 for k in kept]] if len(kept) else kept
        sizes, self.flat = self.size[kept], self._gather(kept)
        starts = np.cumsum(sizes) - sizes
        self.used = len(self.flat)
        self.first, self.size, self.uses = starts, sizes, np.zeros(len(kept), np.int64)
        self.slots = _Slots([keys[k] for k in kept])
        self.known, self.chars = len(kept), 0


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> tuple[bytes, bytes]:
    """(index of block starts as little-endian 32-bit integers, the blocks' bytes)."""
    count = -(-len(ids) // block)
    if not count:
        return b"", b""
    sizes = np.full(count, block)
    sizes[-1] = len(ids) - block * (count - 1)
    table = np.full(count * block, ids[-1], np.uint32)  # what fills the last block is one of its ids
    table[:len(ids)] = ids
    table = table.reshape(count, block)
    low = table.min(axis=1)
    table = table - low[:, None]
    rank = np.minimum(np.ceil(sizes * percentile / 100).astype(int), sizes) - 1
    typical = np.partition(table, rank[0], axis=1)[:, rank[0]]
    typical[-1] = np.sort(table[-1, :sizes[-1]])[rank[-1]]
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(int)
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        whole = "<u2" if w <= 16 else "<u4"
        bits = np.unpackbits(np.ascontiguousarray(table[rows].astype(whole)).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        bits = bits.reshape(len(rows), block, -1)[:, :, :w]
        for i, r in enumerate(rows):
            packed[r] = np.packbits(bits[i, :sizes[r]].reshape(-1), bitorder="little").tobytes()
    starts, out, place = [], [], 0
    for r in range(count):
        beyond = np.flatnonzero(table[r, :sizes[r]] >> np.uint64(width[r])).astype(np.uint16)
        record = b"".join((struct.pack(_HEAD, sizes[r], low[r], width[r], len(beyond)), packed[r], beyond.tobytes(),
                           table[r, beyond].tobytes()))
        starts.append(place)
        out.append(record)
        place += len(record)
    return np.array(starts, "<u4").tobytes(), b"".join(out)


def unpack(index: bytes, payload: bytes) -> np.ndarray:
    """The ids of all blocks of a chunk."""
    return np.concatenate([unpack_block(payload, int(s)) for s in np.frombuffer(index, "<u4")] or [np.zeros(0, np.uint32)])


def unpack_block(payload: bytes, start: int) -> np.ndarray:
    size, low, width, beyond = struct.unpack_from(_HEAD, payload, start)
    at = start + struct.calcsize(_HEAD)
    room = -(-size * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, room, at), count=size * width, bitorder="little")
    wide = np.zeros((size, 16 if width <= 16 else 32), np.uint8)
    wide[:, :width] = bits.reshape(size, width)
    ids = np.packbits(wide.reshape(-1), bitorder="little").view("<u2" if width <= 16 else "<u4").astype(np.uint32)
    at += room
    places = np.frombuffer(payload, "<u2", beyond, at)
    ids[places] = np.frombuffer(payload, "<u4", beyond, at + 2 * beyond)
    return ids + np.uint32(low)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept from task to task."""
    kept = sys.__dict__.setdefault("_token_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


_CHUNKS = "shard int, chunk int, start long, doc_ids array<long>, counts array<int>, index binary, payload binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, chunk: int = CHUNK,
                 between_tasks: int = KNOWN_PIECES, most: int = KNOWN_PIECES, slice_bytes: int = SLICE_BYTES) -> None:
    """Encode every whole text and write the ids at ``path`` in ascending id order.

    Null and empty texts hold the end id alone. Null ids come first; rows of one id are all
    kept, in the order of their texts. ``tokenizer`` is a file of the tokenizers library. A worker
    keeps its pieces from task to task, unless it knows more than ``between_tasks``, and knows
    about ``most`` of them within one; texts are encoded ``slice_bytes`` at a time. Less of these leaves more
    memory to other work on the same executors and gives the same ids.
    """
    tokenizer = tokenizer or tokenizer_path()
    bounded_batches(docs.sparkSession)

    def run(batches):
        encoder = _encoder(tokenizer)
        encoder.between_tasks, encoder.most = between_tasks, most
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, names = [], [], []

        def flush():
            nonlocal number, start
            index, payload = pack(np.concatenate(ids))
            row = [[shard], [number], [start], [names[:]], [counts[:]], [index], [payload]]
            number, start = number + 1, start + sum(counts)
            ids.clear(), counts.clear(), names.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=labels)

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        labels = ["shard", "chunk", "start", "doc_ids", "counts", "index", "payload"]
        for batch in batches:
            for low, high, _, _ in text_slices(batch["text"], slice_bytes):
                part = batch.slice(low, high - low)
                flat, lengths = encoder.encode(part["text"].fill_null(""), end_id)
                ends = np.cumsum(lengths)
                for name, end, n in zip(part["doc_id"].to_pylist(), ends.tolist(), lengths.tolist(), strict=True):
                    if counts and sum(counts) + n > chunk:
                        yield flush()
                    ids.append(flat[end - n:end])
                    counts.append(n)
                    names.append(name)
        if counts:
            yield flush()
        encoder.rest()

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(released(run), _CHUNKS).write.parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, read back from the files.

    ``start`` counts the ids of all documents before it. The window runs over one row per
    written shard, not over documents.
    """
    chunks = spark.read.schema(_CHUNKS).parquet(path)
    totals = chunks.groupBy("shard").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["index"], row["payload"])
                ends = np.cumsum(row["counts"])
                starts = ends - row["counts"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts + row["start"], pa.int64()),
                     pa.array([ids[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())],
                    names=["shard", "doc_id", "start", "ids"])

    found = chunks.drop("chunk").mapInArrow(released(run), "shard int, doc_id long, start long, ids binary")
    # One row per written file of the first step, whose number the shuffle partitions bound.
    return found.join(F.broadcast(before), "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of the ids as little-endian 32-bit integers."""
    return tokens.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))
