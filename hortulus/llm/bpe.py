"""Encoding of texts with a public byte-level BPE vocabulary, vectorised over whole batches.

A batch is cut into words by the vocabulary's split pattern; each distinct word becomes a row of a padded matrix of the
words of like length; every round, each row merges its minimum-rank pair, found by a hashed table of pairs, and the
matrix is compacted. All occurrences of that pair in a row merge in one round from the left, which equals merging the
leftmost again and again: a pair that holds the new token has a higher rank than the pair that made it.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the split pattern of the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space as the pattern means it, for the standard library's dialect.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CACHED_WORDS = 1_000_000
NONE = np.int32(2**31 - 1)


def byte_symbols() -> dict[str, int]:
    """The printable characters by which such vocabularies write bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges of a byte-level BPE as arrays: an open-addressing table from pair to (rank, merged id)."""

    def __init__(self, data: dict):
        symbols, ids = byte_symbols(), data["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in symbols.items():
            self.byte_id[byte] = ids[char]
        size = max(ids.values()) + 1
        self.leads, self.continues = np.zeros(size, np.int32), np.zeros(size, bool)
        for token, i in ids.items():
            raw = [symbols.get(c) for c in token]
            if None not in raw:
                self.leads[i] = sum((b & 0xC0) != 0x80 for b in raw)
                self.continues[i] = (raw[0] & 0xC0) == 0x80
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        merged = np.array([ids[a + b] for a, b in merges], np.int32)
        self.bits = max(4, int(len(merges) * 4).bit_length())
        self.keys, self.rank, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32), np.zeros(1 << self.bits, np.int32)
        self.probes, left, slot = 0, np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = pairs[free]  # where several want one slot, the last gets it
            done = self.keys[slot[left]] == pairs[left]
            self.rank[slot[left[done]]], self.merged[slot[left[done]]] = left[done], merged[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if there is no such pair) and merged id of each pair; padding is -1."""
        pairs = (left.astype(np.int64) << 32) | right.astype(np.int64)
        pairs[(left < 0) | (right < 0)] = -2
        slot = self._slot(pairs)
        seen = self.keys[slot]
        at = np.where(seen == pairs, slot, -1)
        open_ = np.flatnonzero((seen != pairs) & (seen != -1) & (pairs != -2))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot.flat[open_] = (slot.flat[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot.flat[open_]]
            hit = seen == pairs.flat[open_]
            at.flat[open_[hit]] = slot.flat[open_[hit]]
            open_ = open_[~hit & (seen != -1)]
        return np.where(at >= 0, self.rank[at], NONE), self.merged[at]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, by padded matrices of words of like length."""
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        # short words share a bucket by exact length up to 16, longer ones by the next power of two
        bucket = np.where(lengths <= 16, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for group in np.split(order, cuts) if len(words) else []:
            width = int(lengths[group].max())
            step = max(1, 4_000_000 // max(width, 1))
            for start in range(0, len(group), step):
                self._encode_matrix([words[i] for i in group[start : start + step]], group[start : start + step], width, out)
        return out

    def _encode_matrix(self, words: list[bytes], names: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        cells = np.full((len(words), max(width, 1)), -1, np.int32)
        cells[np.arange(cells.shape[1]) < lengths[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        while True:
            if cells.shape[1] > 1:
                rank, merged = self.find(cells[:, :-1], cells[:, 1:])
                least = rank.min(axis=1)
            else:
                least = np.full(len(cells), NONE)
            done = least == NONE
            if done.any():
                sizes = (cells[done] >= 0).sum(axis=1)
                for name, row, size in zip(names[done].tolist(), cells[done], sizes.tolist()):
                    out[name] = row[:size].copy()
                if done.all():
                    return
                cells, names, rank, merged, least = (x[~done] for x in (cells, names, rank, merged, least))
            hit = rank == least[:, None]
            if (hit[:, 1:] & hit[:, :-1]).any():  # in a run of overlapping pairs every second one merges
                at = np.arange(hit.shape[1])
                start = np.maximum.accumulate(np.where(hit & ~np.pad(hit, ((0, 0), (1, 0)))[:, :-1], at, -1), axis=1)
                hit &= ((at - start) & 1) == 0
            cells[:, :-1][hit] = merged[hit]
            keep = cells >= 0
            keep[:, 1:] &= ~hit
            sizes = keep.sum(axis=1)
            packed = np.full((len(cells), int(sizes.max())), -1, np.int32)
            packed[np.arange(packed.shape[1]) < sizes[:, None]] = cells[keep]
            cells = packed


@functools.cache
def splitters() -> tuple:
    """The split pattern for the standard library (texts without characters beyond U+FFFF) and for `regex`."""
    import regex

    def ranges(kind: str) -> str:
        points = [i for i in range(0x10000) if unicodedata.category(chr(i))[0] == kind]
        runs, start = [], None
        for i, p in enumerate(points):
            start = p if start is None else start
            if i + 1 == len(points) or points[i + 1] != p + 1:
                runs.append(f"\\u{start:04x}-\\u{p:04x}")
                start = None
        return "".join(runs)

    letter, number = ranges("L"), ranges("N")
    fast = SPLIT.replace("[^\\s\\p{L}\\p{N}]", f"[^{SPACE}{letter}{number}]").replace("\\p{L}", f"[{letter}]").replace("\\p{N}", f"[{number}]")
    fast = fast.replace("\\s+(?!\\S)", f"[{SPACE}]+(?![^{SPACE}])").replace("|\\s+", f"|[{SPACE}]+")
    return re.compile(fast).findall, regex.compile(SPLIT).findall


class Encoder:
    """Encodes lists of texts; words seen before are looked up, and the memory of words is emptied when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def learn(self, words: list[str]) -> None:
        coded = self.vocabulary.encode_words([w.encode("utf-8", "surrogatepass") for w in words])
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        first, need, many = len(self.seen), self.used + int(sizes.sum()), len(self.seen) + len(words)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need, len(self.flat)), np.int32)])
        if many > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros(max(many, len(x)), np.int64)]) for x in (self.start, self.size))
        self.flat[self.used : need] = np.concatenate(coded)
        self.size[first:many] = sizes
        self.start[first:many] = self.used + np.cumsum(sizes) - sizes
        self.used = need
        self.seen.update(zip(words, range(first, many)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]; null and '' have none."""
        fast, full = splitters()
        if len(self.seen) > CACHED_WORDS:
            self.forget()
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = (fast if text.isascii() or max(text) < "\U00010000" else full)(text)
                counts[i] = len(found)
                words += found
        new = [w for w in dict.fromkeys(words) if w not in self.seen]
        if new:
            self.learn(new)
        at = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[at] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edges = np.concatenate([[0], ends])
        return edges[np.concatenate([[0], np.cumsum(counts)])], ids


_encoders: dict[str, Encoder] = {}


def encoder_of(name: str, data: str) -> Encoder:
    """The encoder of this worker process for the vocabulary `data` (JSON), kept from batch to batch."""
    if name not in _encoders:
        _encoders[name] = Encoder(Vocabulary(json.loads(data)))
    return _encoders[name]


def read_vocabulary(path: str) -> str:
    """The vocabulary as JSON with its model only; the driver reads it, so the executors need no file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    return json.dumps({"model": {"vocab": model["vocab"], "merges": model["merges"]}}, ensure_ascii=False)


def text_chunks(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of about `most` characters each, a longer text alone: bounds the memory of a worker."""
    first, chunk, size = 0, [], 0
    for i, text in enumerate(column):
        chunk.append(text.as_py())
        size += len(chunk[-1] or "")
        if size >= most:
            yield first, chunk
            first, chunk, size = i + 1, [], 0
    if chunk:
        yield first, chunk


def map_tokens(df: DataFrame, text: str, outputs: list[T.StructField], build, vocabulary: str | None = None, name: str = "byte_bpe_50k") -> DataFrame:
    """`df` (without `text` unless it is wanted) with columns that build(texts, offsets, ids, vocabulary) makes of the tokens.

    One narrow pass: no shuffle, Arrow batches in and out.
    """
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(read_vocabulary(vocabulary or f"{TOKENIZERS}/{name}.json"))  # about 2 MB, whatever the data
    schema = T.StructType([*df.schema.fields, *outputs])
    where = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(name, data.value)
        for batch in batches:
            for first, texts in text_chunks(batch.column(where)):
                offsets, ids = encoder.encode(texts)
                part = batch.slice(first, len(texts))
                made = build(texts, offsets, ids, encoder.vocabulary)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def list_array(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode_texts(df: DataFrame, ident: str, text: str, ids: str = "ids", vocabulary: str | None = None, name: str = "byte_bpe_50k") -> DataFrame:
    """(ident, ids): the token ids of each text, without special tokens, whose strings are ordinary text.

    Empty and null texts have an empty list. Rows come out as they come in: repeated ones repeated, null idents kept;
    further columns are ignored. Texts of any length are encoded whole.
    """
    rows = df.select(F.col(ident), F.col(text).alias("__text"))
    out = map_tokens(rows, "__text", [T.StructField("__ids", T.ArrayType(T.IntegerType()))], lambda texts, offsets, tokens, _: [list_array(offsets, tokens)], vocabulary, name)
    return out.select(F.col(ident), F.col("__ids").alias(ids))


def count_tokens(df: DataFrame, text: str, n_tokens: str = "n_tokens", vocabulary: str | None = None, name: str = "byte_bpe_50k") -> DataFrame:
    """`df` with the number of tokens of `text`; 0 for an empty and for a null text."""
    field = T.StructField(n_tokens, T.IntegerType())
    return map_tokens(df, text, [field], lambda texts, offsets, tokens, _: [pa.array(np.diff(offsets).astype(np.int32))], vocabulary, name)
