"""Vectorised words and hashes over UTF-8 text, for use inside Arrow batches.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. These are ASCII, so cutting the
UTF-8 bytes gives the same words as cutting the characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Words:
    """Words of several texts: byte positions in ``data`` and, per text, its first word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buf, np.uint8)[offsets[0] : offsets[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def texts_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch made by :func:`common.source`: in the row struct if there is one."""
    return batch["row"].field(text_col) if "row" in batch.schema.names else batch["text"]


def slices(batch: pa.RecordBatch, text_col: str, limit: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with at most ``limit`` bytes of text each, or one row, and their texts."""
    texts = texts_of(batch, text_col)
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = done = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at, done = to, int(ends[to - 1])


def split_words(texts: pa.Array, space: np.ndarray = IS_SPACE) -> Words:
    """Words of each text; ``space`` marks the bytes that part words."""
    data, offsets = utf8(texts)
    word = ~space[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    full = offsets[1:] > offsets[:-1]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_numbers(w: Words, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, pa.Array]:
    """A number from 0 for each word, equal for words of equal bytes only, and the distinct
    words in the order of their numbers."""
    at = np.r_[0, np.cumsum(w.ends - w.starts)].astype(np.int64)
    data = w.data[~space[w.data]]  # words without what parts them
    words = pa.Array.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def covered(starts: np.ndarray, length, n: int) -> np.ndarray:
    """Which of n words lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:n]) > 0


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(w: Words, *seeds: int, space: np.ndarray = IS_SPACE) -> list[np.ndarray]:
    """For each seed, the XXH64 of each word's bytes; each distinct word is hashed once."""
    number, distinct = word_numbers(w, space)
    distinct = distinct.to_pylist()
    return [np.array([xxhash.xxh64_intdigest(x, seed) for x in distinct], np.uint64)[number] for seed in seeds]


def window_hashes(h: np.ndarray, first: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text: ``(first word, hash)``."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    step = np.uint64(int(np.random.default_rng(seed).integers(1, 2**62)) * 2 + 1)
    acc = h[:n].copy()
    for j in range(1, size):
        acc *= step
        acc += h[j : j + n]
    ok = np.ones(n, bool)  # a run may not reach over the end of its text
    for end in first[1:-1]:
        ok[max(0, end - size + 1) : end] = False
    at = np.flatnonzero(ok)
    return at, mix(acc[at])


def text_of_word(first: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
