"""Packing token sequences without waste: exact complements first, then best fit.

1. Documents become pieces of at most ``capacity`` tokens, as they are encoded; each piece
   notes how many pieces of its length came before it in its partition.
2. The pieces are counted by length. This histogram has ``capacity`` cells whatever the input,
   so the packing is planned on it (:func:`plan`): a plan is a list of patterns (lengths that
   share a sequence) with the number of sequences of each. From the longest length down, the
   gap it leaves is looked up in three indexes of the lengths that are still there: single
   lengths, sums of two, sums of three. A combination that fills the gap exactly is consumed
   as often as all its lengths are available. What is left goes by decreasing length into the
   sequence with the smallest gap that holds it, or into a new one.
3. The number of a piece among all pieces of its length (partition's offset and its own place)
   says which sequence of which pattern it gets, in which slot. No sequence is ever gathered.

Encoding is narrow; then one shuffle of counts and one of short rows without text. A length
that a third of all pieces share is dealt by partition like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, source, table
from .piece_ids import piece_ids
from .words import slices

Pattern = tuple[tuple[int, ...], int]


class Sums:
    """Lengths that are still there, by their sums of one, two and three."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.size = len(counts)

    def _has(self, lengths: tuple[int, ...]) -> int:
        """How often this combination is there."""
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two lengths that are there with this sum; the most different ones first, so that a
        long one takes the place of several short ones."""
        if total < 2:
            return None
        a = np.arange(1, total // 2 + 1)
        a = a[total - a < self.size]
        ok = (self.left[a] > 0) & (self.left[total - a] > 0) & ((2 * a != total) | (self.left[a] > 1))
        at = np.flatnonzero(ok)
        return (int(total - a[at[0]]), int(a[at[0]])) if len(at) else None

    def pair_sums(self) -> np.ndarray:
        """Which sums two lengths that are there can have (for one length twice: two of it)."""
        there = np.zeros(4 * self.size)
        there[: self.size] = self.left > 0
        ways = np.rint(np.fft.irfft(np.fft.rfft(there) ** 2, len(there))[: 2 * self.size])
        ways[2 * np.flatnonzero(self.left == 1)] -= 1
        return ways > 0

    def fill(self, gap: int, most: int, pair_sums: np.ndarray | None) -> tuple[int, ...] | None:
        """One, two or three lengths (``most``) that fill a gap exactly. ``pair_sums`` may be
        older than the counts: it names candidates, and the counts decide."""
        if gap < self.size and self.left[gap] > 0:
            return (gap,)
        two = self.pair(gap) if most > 1 else None
        if two or most < 3 or gap < 3:
            return two
        x = np.arange(min(gap - 2, self.size - 1), max(0, gap - len(pair_sums)), -1)
        for x in x[(self.left[x] > 0) & pair_sums[gap - x]].tolist():
            self.left[x] -= 1
            two = self.pair(gap - x)
            self.left[x] += 1
            if two:
                return (x, *two)
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        n = self._has(lengths)
        for x in lengths:
            self.left[x] -= n
        return n


def plan(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns and how many sequences have each. ``counts[x]``: pieces of x tokens.

    Exact stage: every consumption uses one length up, so there are at most ``capacity`` of
    them, plus one for each length that finds nothing. Best fit: pieces of one length go
    together into the group of sequences with the smallest gap, so groups are few as well.

    With few pieces, filling gaps with three short ones can leave too few of them for later
    gaps. So the plan is made with sums of up to three, two, one and no lengths, and the one
    with the fewest sequences counts (the one with the largest sums among equals).
    """
    counts = np.r_[counts, np.zeros(max(0, capacity + 1 - len(counts)), np.int64)]
    least = -(-int(counts @ np.arange(len(counts))) // capacity)
    best: list[Pattern] | None = None
    for most in (3, 2, 1, 0):
        found = _plan(counts, capacity, most)
        if best is None or sum(n for _, n in found) < sum(n for _, n in best):
            best = found
        if sum(n for _, n in best) <= least:
            break
    return best


def _plan(counts: np.ndarray, capacity: int, most: int) -> list[Pattern]:
    sums = Sums(counts)
    out: list[Pattern] = []
    for x in range(capacity, 0, -1):
        if not sums.left[x]:
            continue
        if x == capacity:
            out.append(((x,), sums.take((x,))))
            continue
        pair_sums = sums.pair_sums() if most > 2 else None
        while most and sums.left[x]:
            sums.left[x] -= 1
            more = sums.fill(capacity - x, most, pair_sums)
            sums.left[x] += 1
            if more is None:
                break
            out.append(((x, *more), sums.take((x, *more))))
    return out + best_fit(sums.left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit by decreasing length; sequences with equal contents are one group."""
    gaps: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for x in range(len(left) - 1, 0, -1):
        n = int(left[x])
        while n:
            gap = next((g for g in range(x, capacity) if gaps[g]), None)
            if gap is None:  # a new sequence takes as many of them as it holds
                each = min(capacity // x, n)
                groups = n // each
                gaps[capacity - each * x].append(((x,) * each, groups))
                n -= groups * each
                continue
            lengths, groups = gaps[gap].pop()
            used = min(groups, n)
            if used < groups:
                gaps[gap].append((lengths, groups - used))
            gaps[gap - x].append(((*lengths, x), used))
            n -= used
    return [p for g in gaps for p in g]


class Places:
    """Where the n-th piece of a length goes: ``(sequence, offset)``."""

    def __init__(self, patterns: list[Pattern], capacity: int):
        rows: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
        given = [0] * (capacity + 1)
        sequence = 0
        for lengths, n in patterns:
            at = 0
            for x in lengths:
                rows[x].append((given[x], sequence, at))
                given[x] += n
                at += x
            sequence += n
        self.n_sequences = sequence
        flat = [r for x in rows for r in x]
        self.first = np.cumsum([0, *[len(x) for x in rows]])
        self.given, self.sequence, self.offset = (np.array([r[i] for r in flat], np.int64) for i in range(3))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            lo, hi = self.first[length[rows[0]]], self.first[length[rows[0]] + 1]
            at[rows] = lo + np.searchsorted(self.given[lo:hi], number[rows], "right") - 1
        return self.sequence[at] + number - self.given[at], self.offset[at]


def pieces(ids: np.ndarray, counts: np.ndarray, capacity: int, end: int) -> tuple[np.ndarray, ...]:
    """Cut documents into pieces: ``(document, piece, start, length, crc32 of the ids)``."""
    size = counts + 1
    last = np.cumsum(size)
    whole = np.full(int(last[-1]) if len(last) else 0, end, np.uint32)
    is_id = np.ones(len(whole), bool)
    is_id[last - 1] = False
    whole[is_id] = ids
    n = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(capacity, size[doc] - start)
    raw, at = memoryview(whole.astype("<u4").tobytes()), 4 * ((last - size)[doc] + start)
    crc = [zlib.crc32(raw[a : a + b]) for a, b in zip(at.tolist(), (4 * length).tolist())]
    return doc, piece, start, length, np.array(crc, np.int64)


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end: int = 0, ids: bool = False
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as it can.

    A document is its token ids (``path`` names a tokenizers JSON file on the driver; no
    special tokens are added) and the id ``end``. Only documents over ``capacity`` are cut, into
    pieces of that many tokens and a last one that may be shorter.

    Returns one row per piece: ``id, piece`` (from 0), ``start`` (its document's ids before
    it), ``length, ids_crc32`` (of its little-endian unsigned 32-bit ids), ``sequence_id``
    (from 0, each number used), ``offset`` (its place there; places follow each other without
    gaps from 0), and with ``ids`` also ``ids`` (binary, the same numbers).

    Null and empty texts are a piece of one token. Rows are documents: ids may be null or
    repeat, and each row is packed. Empty table: no rows. Other input columns are never read
    by name. The longest single text bounds a task's memory.
    """
    if capacity < 1:
        raise ValueError("capacity has to be 1 or more")
    prepare(docs.sparkSession)
    with open(path, encoding="utf-8") as f:  # on the driver; the content goes to the workers
        spec = f.read()
    rows = source(docs, id_col, text_col, False)
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(spec)
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows, texts in slices(batch, text_col, 4 << 20):
                flat, counts = encoder.encode(texts)
                doc, piece, start, length, crc = pieces(flat, counts, capacity, end)
                order = np.argsort(length, kind="stable")
                sizes, heads = np.unique(length[order], return_index=True)
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - np.repeat(heads, np.diff(np.r_[heads, len(length)])) + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                out = {"id": rows["id"].take(pa.array(doc)), "piece": piece, "start": start, "length": length, "ids_crc32": crc, "number": number, "part": np.full(len(doc), part, np.int32)}
                if ids:
                    out["ids"] = pa.array(_raw(flat, counts, doc, start, length, end), pa.binary())
                yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in out.items()})

    fields = f"id {kind}, piece long, start long, length long, ids_crc32 long, number long, part int" + (", ids binary" if ids else "")
    made = table(rows.mapInArrow(cut, fields), "pieces")

    by_part = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table(by_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "offsets")
    counts = np.zeros(capacity + 1, np.int64)
    for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    places = Places(plan(counts, capacity), capacity)

    def place(batches):
        for batch in batches:
            number = batch["number"].to_numpy() + batch["before"].to_numpy()
            sequence, offset = places.find(batch["length"].to_numpy(), number)
            keep = [c for c in batch.schema.names if c not in ("number", "before")]
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    joined = made.join(offsets.select("length", "part", "before"), ["length", "part"])
    columns = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    placed = f"id {kind}, piece long, start long, length long, ids_crc32 long" + (", ids binary" if ids else "") + ", sequence_id long, offset long"
    return joined.select(*columns, "number", "before").mapInArrow(place, placed)


def _raw(flat: np.ndarray, counts: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, end: int) -> list[bytes]:
    """The ids of each piece; a document's last one ends with ``end``."""
    first = np.cumsum(np.r_[0, counts])
    tail = np.array([end], "<u4").tobytes()
    out = []
    for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist()):
        a, b = first[d] + s, min(first[d] + s + n, first[d + 1])
        out.append(flat[a:b].astype("<u4").tobytes() + (tail if b - a < n else b""))
    return out
