"""Packed training state: blocks of sequences, and the kernels that run on them.

A block is one row: the symbol ids of many sequences one after another, the length of each
(int32) and its weight, as binary columns, so that a block crosses to Python as one copy. Ids and
weights are written as the smallest of 1, 2, 4 or 8 bytes that holds all of the block. Beside them stands what the block's last pass has changed in the pair counts, as
``keys`` (``left << 32 | right``) and signed ``deltas``. Two negative keys per bucket carry the
block's size: see :func:`size_keys`.

Blocks belong to one of ``BUCKETS`` buckets; a bucket is a folder of files, and the unit that
a training round reads and writes or leaves alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from . import kernels

BUCKETS = 256
#: Symbols of one block; a longer sequence is a block of its own.
BLOCK_SYMBOLS = 1 << 20
#: Blocks of a task that go to one bucket: each bucket of a task is a file in every round.
BUCKET_BLOCKS = 16
BLOCK_DDL = "bucket int, part int, ids binary, lengths binary, weights binary, keys array<bigint>, deltas array<bigint>"
COUNTS_DDL = "part int, keys array<bigint>, deltas array<bigint>"
_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("part", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("weights", pa.binary())]
    + [("keys", pa.list_(pa.int64())), ("deltas", pa.list_(pa.int64()))]
)


def size_keys(bucket: int) -> tuple[int, int]:
    """The keys under which a block reports its symbols and its weighted number of pairs."""
    return -1 - 2 * bucket, -2 - 2 * bucket


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers from 0 up, each in as many bytes as the largest takes."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(raw: pa.Scalar, n: int, kind: type) -> np.ndarray:
    """``n`` numbers that :func:`_narrow` has written."""
    data = raw.as_buffer()
    return np.frombuffer(data, f"<u{data.size // n}").astype(kind) if n else np.zeros(0, kind)


class Block:
    """The sequences of a block."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, weights: np.ndarray):
        self.ids, self.lengths, self.weights = ids, lengths, weights

    @classmethod
    def rows(cls, batches) -> Iterator[tuple[int, Block]]:
        for batch in batches:
            for bucket, *raw in zip(batch["part"].to_pylist(), batch["ids"], batch["lengths"], batch["weights"]):
                lengths = np.frombuffer(raw[1].as_buffer(), np.int32)
                yield bucket, cls(_wide(raw[0], int(lengths.sum()), np.int32), lengths, _wide(raw[2], lengths.size, np.int64))

    def row(self, bucket: int, keys: np.ndarray, deltas: np.ndarray) -> pa.RecordBatch:
        symbols, pairs = size_keys(bucket)
        keys = np.r_[keys, symbols, pairs]
        deltas = np.r_[deltas, self.ids.size, int((self.weights * (self.lengths - 1)).sum())]
        cols = [bucket, bucket, _narrow(self.ids), self.lengths.astype(np.int32).tobytes(), _narrow(self.weights), keys, deltas]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)

    def _last(self) -> np.ndarray:
        """Which symbols end a sequence."""
        last = np.zeros(self.ids.size, bool)
        last[np.cumsum(self.lengths)[self.lengths > 0] - 1] = True
        return last

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and weights of the adjacent pairs that begin at these symbols (sorted, distinct);
        a symbol that ends its sequence begins none."""
        at = at[~self._last()[at]]
        return (self.ids[at].astype(np.int64) << 32) | self.ids[at + 1], self.weights[self._row(at)]

    def _row(self, at: np.ndarray) -> np.ndarray:
        """Which sequence each of these symbols is in."""
        if at.size * 16 < self.ids.size:
            return np.searchsorted(np.cumsum(self.lengths), at, "right")
        return np.repeat(np.arange(self.lengths.size, dtype=np.int32), self.lengths)[at]

    def _near(self, *places: np.ndarray) -> np.ndarray:
        """The symbols at any of these places, ascending; a place before the first is none."""
        near = np.zeros(self.ids.size, bool)
        for at in places:
            near[at[at >= 0]] = True
        return np.flatnonzero(near)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Weighted counts of all pairs."""
        if self.ids.size < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = ~self._last()[:-1]
        keys = (self.ids[:-1].astype(np.int64) << 32) | self.ids[1:]
        return kernels.sum_by_key(keys[inside], np.repeat(self.weights, self.lengths)[:-1][inside])

    def positions(self, batch_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pairs of ``batch_keys`` (sorted) are merged, left to right without overlap,
        and which pair it is. Only symbols that are a left beside a right are looked up."""
        if self.ids.size < 2 or not batch_keys.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        left = np.zeros(max(int(self.ids.max()), int(batch_keys.max() >> 32), int((batch_keys & 0xFFFFFFFF).max())) + 1, bool)
        right = left.copy()
        left[batch_keys >> 32] = right[batch_keys & 0xFFFFFFFF] = True
        at = np.flatnonzero(left[self.ids[:-1]] & right[self.ids[1:]])
        keys = (self.ids[at].astype(np.int64) << 32) | self.ids[at + 1]
        which = np.minimum(np.searchsorted(batch_keys, keys), batch_keys.size - 1)
        hit = (batch_keys[which] == keys) & ~self._last()[at]
        at, which = at[hit], which[hit]
        if at.size > 1 and (near := np.diff(at) == 1).any():
            # Hits touch only in a run of one symbol merged with itself: take every other one.
            new = np.r_[True, ~near]
            start = np.maximum.accumulate(np.where(new, np.arange(at.size), 0))
            taken = (np.arange(at.size) - start) % 2 == 0
            at, which = at[taken], which[taken]
        return at, which

    def merge(self, batch_keys: np.ndarray, new_ids: np.ndarray) -> tuple[Block, np.ndarray, np.ndarray]:
        """The block after the merges, and the signed changes of its pair counts. Only pairs
        beside a merged place change, so only they are counted."""
        at, which = self.positions(batch_keys)
        if not at.size:
            return self, np.zeros(0, np.int64), np.zeros(0, np.int64)
        gone, lost = self.pairs(self._near(at - 1, at, at + 1))
        ids = self.ids.copy()
        ids[at] = new_ids[which]
        keep = np.ones(ids.size, bool)
        keep[at + 1] = False
        after = Block(ids[keep], self.lengths - np.bincount(self._row(at), minlength=self.lengths.size).astype(np.int32), self.weights)
        now = at - np.arange(at.size)
        come, won = after.pairs(after._near(now - 1, now))
        keys, deltas = kernels.sum_by_key(np.concatenate((gone, come)), np.concatenate((-lost, won)))
        return after.without_short(), keys, deltas

    def without_short(self) -> Block:
        """Without sequences of one symbol: they hold no pair any more."""
        live = self.lengths >= 2
        if live.all():
            return self
        return Block(self.ids[np.repeat(live, self.lengths)], self.lengths[live], self.weights[live])

    def cut(self, live: np.ndarray) -> Block:
        """Sequences cut between symbols whose pair is not in ``live`` (sorted keys)."""
        if not self.ids.size:
            return self
        keys = (self.ids[:-1].astype(np.int64) << 32) | self.ids[1:]
        found = np.minimum(np.searchsorted(live, keys), max(live.size - 1, 0))
        end = self._last()
        end[:-1] |= live[found] != keys if live.size else True
        ends = np.flatnonzero(end) + 1
        row = np.searchsorted(np.cumsum(self.lengths), ends - 1, "right")
        return Block(self.ids, np.diff(np.r_[0, ends]).astype(np.int32), self.weights[row]).without_short()


def _pack(slices: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Sequences, as they come, in blocks of ``BLOCK_SYMBOLS``; each with its pair counts."""
    context = TaskContext.get()
    part, n_blocks = context.partitionId() if context else 0, 0
    held: list[tuple] = []
    size = 0

    def block() -> pa.RecordBatch:
        nonlocal held, size, n_blocks
        ready = Block(*(np.concatenate(x) for x in zip(*held)))
        bucket = (part + 97 * (n_blocks // BUCKET_BLOCKS)) % BUCKETS
        held, size, n_blocks = [], 0, n_blocks + 1
        return ready.row(bucket, *ready.counts())

    for ids, lengths, weights in slices:
        if held and size + ids.size > BLOCK_SYMBOLS:
            yield block()
        held.append((ids.astype(np.int32), lengths.astype(np.int32), weights.astype(np.int64)))
        size += ids.size
    if held:
        yield block()


def pack_text(batches, code_points: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(seq string, weight)`` to blocks, symbols through the alphabet (code points sorted)."""

    def slices():
        for batch in kernels.slices(kernels.intern(batches, code_points, ids), max_symbols=BLOCK_SYMBOLS // 4):
            flat, lengths, weights = kernels.unpack(batch)
            if lengths.size:
                yield flat, lengths, weights

    return _pack(slices())


def pack_ids(batches) -> Iterator[pa.RecordBatch]:
    """``(seq binary, weight)``, sequences of int32 ids, to blocks."""

    def slices():
        for batch in batches:
            raw = batch["seq"].cast(pa.large_binary())
            _, off, data = raw.buffers()
            off = np.frombuffer(off, np.int64)[raw.offset : raw.offset + len(raw) + 1] // 4
            flat, weights = np.frombuffer(data, np.int32)[off[0] : off[-1]], batch["weight"].to_numpy()
            ends = off[1:] - off[0]
            start = 0
            while start < len(weights):
                base = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_SYMBOLS // 4, "right")))
                yield flat[base : ends[stop - 1]], np.diff(np.r_[base, ends[start:stop]]), weights[start:stop]
                start = stop

    return _pack(slices())


def step(batches, batch_keys: np.ndarray, new_ids: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One round: blocks after the merges, with the changes of the counts. A loss is only
    reported for the pairs in ``known`` (sorted): the others are below the driver's cut."""
    for bucket, block in Block.rows(batches):
        block, keys, deltas = block.merge(batch_keys, new_ids)
        if keys.size:
            found = np.minimum(np.searchsorted(known, keys), max(known.size - 1, 0))
            told = (deltas > 0) | (known[found] == keys if known.size else False)
            keys, deltas = keys[told], deltas[told]
        yield block.row(bucket, keys, deltas)


def count(batches) -> Iterator[pa.RecordBatch]:
    """The pair counts and sizes of blocks, without the blocks."""
    for bucket, block in Block.rows(batches):
        yield block.row(bucket, *block.counts()).select(["part", "keys", "deltas"])


def replay(batches, rounds: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Blocks after all merges of the rounds so far, with their pair counts."""
    for bucket, block in Block.rows(batches):
        for keys, new_ids in rounds:
            block = block.merge(keys, new_ids)[0]
        yield block.row(bucket, *block.counts())


def pieces(batches, live: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pieces of blocks cut at pairs outside ``live``, as ``(seq binary, weight)``."""
    for _, block in Block.rows(batches):
        block = block.cut(live)
        if block.lengths.size:
            offsets = np.r_[0, np.cumsum(block.lengths)].astype(np.int32) * 4
            seq = pa.Array.from_buffers(pa.binary(), block.lengths.size, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(block.ids))])
            for lo in range(0, len(seq), 10_000):
                yield pa.RecordBatch.from_pydict({"seq": seq.slice(lo, 10_000), "weight": pa.array(block.weights[lo : lo + 10_000])})
