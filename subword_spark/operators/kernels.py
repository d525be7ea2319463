"""Vectorised per-batch kernels run inside ``mapInArrow`` tasks.

Each kernel takes one Arrow record batch of ``(seq list<int32>, weight int64)`` and works
on the flattened symbol array with numpy; no per-symbol Python loop.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PAIR_SCHEMA = pa.schema([("l", pa.int32()), ("r", pa.int32()), ("cnt", pa.int64())])
# Most symbols one numpy step holds (int64 keys, masks, sort): bounds Python worker memory
# whatever the Arrow batch size and line lengths are. A single longer row is its own slice.
MAX_SLICE_SYMBOLS = 1 << 22


def byte_offsets(strings: pa.Array) -> np.ndarray:
    """Where each string begins among the bytes of its array, and where the last ends."""
    if not len(strings):
        return np.zeros(1, np.int32)
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    return np.frombuffer(strings.buffers()[1], kind)[strings.offset : strings.offset + len(strings) + 1]


def points_of(strings: pa.Array) -> np.ndarray:
    """Code points of strings (none of them null), one after another."""
    at = byte_offsets(strings)
    if at[0] == at[-1]:
        return np.empty(0, np.uint32)
    data = strings.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])).to_pybytes()
    return np.frombuffer(data, np.uint8) if data.isascii() else np.frombuffer(data.decode().encode("utf-32-le"), "<u4")


def slices(batches, col: str = "seq", max_symbols: int = MAX_SLICE_SYMBOLS):
    """Cut record batches into row ranges of at most ``max_symbols`` list elements."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        arr = batch.column(col)
        if pa.types.is_list(arr.type):
            lengths = pc.list_value_length(arr).fill_null(0).to_numpy(zero_copy_only=False)
        else:
            lengths = pc.utf8_length(arr).fill_null(0).to_numpy(zero_copy_only=False)
        total = int(lengths.sum())
        if total <= max_symbols:
            yield batch
            continue
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + max_symbols, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def unpack(batch: pa.RecordBatch):
    seq = batch.column("seq")
    lengths = pc.list_value_length(seq).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = seq.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    weights = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.int64)
    return flat, lengths, weights


def _pair_keys(flat: np.ndarray, lengths: np.ndarray):
    """Keys ``l << 32 | r`` of adjacent pairs and a mask of pairs inside one sequence."""
    n = flat.size
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, bool)
    keys = (flat[:-1] << 32) | flat[1:]
    ends = np.cumsum(lengths)[lengths > 0] - 1  # index of each sequence's last symbol
    inside = np.ones(n, bool)
    inside[ends] = False
    return keys, inside[:-1]


# Largest dense (left, right) table summed with bincount (2^22 float64 cells = 32 MB), and
# the largest total for which its float64 sums are exact; the sort sums integers otherwise.
MAX_DENSE_PAIRS = 1 << 22
MAX_EXACT_TOTAL = 1 << 53


def sum_by_key(keys: np.ndarray, weights: np.ndarray):
    """Distinct pair keys (ascending) and their summed weights, without those that sum to 0."""
    if keys.size == 0:
        return keys, weights
    left, right = keys >> 32, keys & 0xFFFFFFFF
    width = int(right.max()) + 1
    cells = (int(left.max()) + 1) * width
    if cells <= MAX_DENSE_PAIRS and int(np.abs(weights).max()) * weights.size < MAX_EXACT_TOTAL:
        # O(n) while the vocabulary is small (early rounds carry most of the data).
        sums = np.bincount(left * width + right, weights=weights, minlength=cells)
        hit = np.flatnonzero(sums)
        return ((hit // width) << 32) | (hit % width), sums[hit].astype(np.int64)
    order = np.argsort(keys)  # any order within equal keys will do: weights are summed
    ks = keys[order]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(ks)) + 1))
    sums = np.add.reduceat(weights[order], starts)
    return ks[starts][sums != 0], sums[sums != 0]


def _pairs_batch(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array((keys >> 32).astype(np.int32)),
            pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
            pa.array(sums.astype(np.int64)),
        ],
        schema=PAIR_SCHEMA,
    )


def count_pairs(batches):
    """Partial weighted counts of adjacent pairs, one row per distinct pair and slice."""
    for batch in slices(batches):
        flat, lengths, weights = unpack(batch)
        keys, inside = _pair_keys(flat, lengths)
        if keys.size == 0:
            continue
        w = np.repeat(weights, lengths)[:-1]
        ks, sums = sum_by_key(keys[inside], w[inside])
        if ks.size:
            yield _pairs_batch(ks, sums)


def merge_positions(keys: np.ndarray, inside: np.ndarray, batch_keys: np.ndarray):
    """Left-to-right non-overlapping positions of pairs in ``batch_keys`` (sorted).

    Returns (positions, index into batch_keys). Two hits can touch only in a run of one
    symbol merged with itself; the run is then taken at every other position.
    """
    if keys.size == 0 or batch_keys.size == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    idx = np.searchsorted(batch_keys, keys)
    idx = np.minimum(idx, batch_keys.size - 1)
    hit = inside & (batch_keys[idx] == keys)
    pos = np.flatnonzero(hit)
    if pos.size > 1:
        step = np.diff(pos)
        if np.any(step == 1):
            brk = np.concatenate(([True], step != 1))
            run_id = np.cumsum(brk) - 1
            run_start = np.flatnonzero(brk)
            offset = np.arange(pos.size) - run_start[run_id]
            pos = pos[offset % 2 == 0]
    return pos, idx[pos]


def apply_merges(batches, batch_keys: np.ndarray, new_ids: np.ndarray, min_len: int = 2):
    """Replace every occurrence of the batch's pairs by their new ids, in one pass.

    The pairs of one training batch never overlap each other (the trainer only batches
    pairs without a shared inner symbol), so simultaneous replacement equals replacing
    them one after another. Rows left with fewer than ``min_len`` symbols are dropped:
    they hold no pair any more.
    """
    for batch in slices(batches):
        flat, lengths, weights = unpack(batch)
        keys, inside = _pair_keys(flat, lengths)
        pos, which = merge_positions(keys, inside, batch_keys)
        if pos.size:
            flat = flat.copy()
            flat[pos] = new_ids[which]
            keep = np.ones(flat.size, bool)
            keep[pos + 1] = False
            seq_of = np.repeat(np.arange(lengths.size), lengths)
            lengths = lengths - np.bincount(seq_of[pos], minlength=lengths.size)
            flat = flat[keep]
            batch = with_seq(batch, flat, lengths)
        if min_len > 0:
            batch = batch.filter(pa.array(lengths >= min_len))
        yield batch


def with_seq(batch: pa.RecordBatch, flat: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    """The batch with its ``seq`` column replaced (other columns pass through)."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    seq = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
    cols = [seq if name == "seq" else batch.column(name) for name in batch.schema.names]
    names = batch.schema.names
    if "seq" not in names:
        cols, names = [seq] + cols, ["seq"] + names
    return pa.RecordBatch.from_arrays(cols, names=names)


def intern(batches, code_points: np.ndarray, ids: np.ndarray, min_len: int = 2, keep_text: bool = False):
    """Sequence strings -> id arrays through the alphabet (code points sorted).

    Other columns pass through; ``keep_text`` also keeps the string as ``text``.
    """
    for batch in slices(batches):
        strings = batch.column("seq")
        lengths = pc.utf8_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
        cps = points_of(strings).astype(np.int64)
        at = np.minimum(np.searchsorted(code_points, cps), max(code_points.size - 1, 0))
        if cps.size and not np.all(code_points[at] == cps):
            raise ValueError("symbol outside the alphabet while interning")
        out = with_seq(batch, ids[at] if cps.size else cps, lengths)
        if keep_text:
            out = out.append_column("text", strings)
        if min_len > 0:
            out = out.filter(pa.array(lengths >= min_len))
        yield out


def seen_code_points(batches, col: str):
    """``cp int``: the code points of a task's strings, each once."""
    seen = np.zeros(0x110000, bool)
    for batch in slices(batches, col):
        seen[points_of(batch.column(col).drop_null())] = True
    yield pa.RecordBatch.from_pydict({"cp": pa.array(np.flatnonzero(seen).astype(np.int32))})


# Characters from here on (marks, compositions, many scripts) are left to the native path.
SIMPLE_BELOW = 0x300
_SPACE, _MARKER, _LETTER = 1, 2, 3


@lru_cache(maxsize=None)
def _character_kinds(marker: str) -> np.ndarray:
    """What each character below ``SIMPLE_BELOW`` is to the word split; 0 is punctuation."""
    kinds = np.zeros(SIMPLE_BELOW, np.uint8)
    kinds[[c for c in range(SIMPLE_BELOW) if unicodedata.category(chr(c))[0] in "LN" or c == ord("_")]] = _LETTER
    kinds[ord(marker)] = _MARKER
    kinds[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0]] = _SPACE
    return kinds


def split_words(texts: pa.Array, marker: str) -> tuple[pa.Array, np.ndarray]:
    """The word sequences of raw texts of characters below ``SIMPLE_BELOW``, one after another,
    and where each text's begin: what normalising (inner runs of white space as one marker) and
    ``functions.text.word_tokens`` give. Null texts have none."""
    strings = texts.drop_null()
    if not len(strings):
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    # A line feed before each text stands for the marker that its first segment has.
    points = np.frombuffer("\n".join(["", *strings.to_pylist()]).encode("utf-16-le"), "<u2")
    size = pc.utf8_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(size + 1) - (size + 1)
    last = first + size
    kind = _character_kinds(marker)[points]
    space = kind == _SPACE
    head = space.copy()  # of each run of white space one character stays,
    head[1:] &= ~space[:-1]
    run = np.flatnonzero(head)
    run = run[np.searchsorted(run, last, "right") - 1]
    head[run[space[last] & (run > first)]] = False  # none of a run at the end,
    head[first] = True  # and always the first of a text
    kept = head | ~space
    points, kind = np.where(space, np.uint16(ord(marker)), points)[kept], kind[kept]
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[1:] != _LETTER) | (kind[:-1] != _LETTER)
    begin = np.flatnonzero(begins)
    at = np.concatenate(([0], np.cumsum(size + 1 - np.add.reduceat(~kept, first, dtype=np.int64))))[:-1]
    rows = np.searchsorted(begin, at)
    wide = points >= 0x80
    offsets = np.concatenate((begin, [len(points)]))
    if wide.any():
        offsets += np.concatenate(([0], np.cumsum(wide, dtype=np.int32)))[offsets]
    data = points.tobytes().decode("utf-16-le").encode()
    seqs = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    n = np.zeros(len(texts), np.int64)
    n[texts.is_valid().to_numpy(zero_copy_only=False)] = np.diff(np.concatenate((rows, [len(begin)])))
    return seqs, np.concatenate(([0], np.cumsum(n)))


# Bytes of text, and distinct words, that one step of the word count holds.
COUNT_BYTES = 1 << 22
COUNT_WORDS = 1 << 18


def count_words(batches, marker: str):
    """``(text, words)`` of each row, one of them null, to ``seq string, weight bigint``: the
    word sequences with how often they occur, summed until they are too many to hold."""
    raw: list[pa.Array] = []
    held: list[tuple[pa.Array, np.ndarray]] = []
    size = n_held = 0

    def add() -> None:
        nonlocal raw, size, n_held
        coded = pa.chunked_array(raw, pa.string()).combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        held.append((coded.dictionary, np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))))
        raw, size, n_held = [], 0, n_held + len(coded.dictionary)

    def merged() -> tuple[pa.Array, np.ndarray]:
        coded = pa.concat_arrays([x for x, _ in held]).dictionary_encode()
        weights = np.concatenate([n for _, n in held]).astype(np.int64)
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, coded.indices.to_numpy(zero_copy_only=False), weights)
        return coded.dictionary, sums

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([held[0][0], pa.array(held[0][1])], names=["seq", "weight"])

    for batch in batches:
        texts, words = batch.column("text"), batch.column("words")
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + COUNT_BYTES, "right")))
            raw += [split_words(texts.slice(lo, hi - lo), marker)[0].cast(pa.string()), words.slice(lo, hi - lo).flatten().cast(pa.string())]
            size += int(ends[hi - 1] - (ends[lo - 1] if lo else 0)) + raw[-1].nbytes
            lo = hi
            if size >= COUNT_BYTES:
                add()
                if n_held > COUNT_WORDS:
                    held = [merged()]
                    n_held = len(held[0][0])
                    if n_held > COUNT_WORDS // 2:
                        yield out()
                        held, n_held = [], 0
    if raw:
        add()
    if held:
        held = [merged()]
        yield out()


def first_positions(batches, order_by: tuple[str, ...], schema: pa.Schema):
    """The first place of each symbol in a batch: ``sym, at`` (order columns and position).

    Each row contributes a symbol once, each batch again once, so that what leaves the task
    is bounded by the alphabet and not by the text."""
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in order_by)))
        best: dict[str, tuple] = {}
        for key, text in zip(rows, batch.column("seq").to_pylist()):
            for sym in dict.fromkeys(text or ""):
                at = (*key, text.index(sym))
                if sym not in best or at < best[sym]:
                    best[sym] = at
        cols = [list(best)] + [[v[i] for v in best.values()] for i in range(len(order_by) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


# Cells of the stacks, or symbols, that one step over many sequences holds.
MAX_CELLS = 1 << 22
# Fewer sequences side by side than this, or (by rank) longer ones, are not worth numpy's calls.
MIN_SIDE_BY_SIDE = 64
MAX_RANK_SYMBOLS = 128
NO_RANK = np.iinfo(np.int32).max


class PairTable:
    """What stands for a pair of ids, looked up for many pairs at once; -1 if nothing does.
    Ids are -1 (unknown, in no pair) and up. Small id ranges have a dense table."""

    MAX_DENSE = 1 << 22

    def __init__(self, pairs: dict[int, int], n_ids: int):
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.width = n_ids + 1
        self.dense = None
        if self.width * self.width <= self.MAX_DENSE:
            self.dense = np.full(self.width * self.width, -1, np.int32)
            self.dense[((keys >> 32) + 1) * self.width + (keys & 0xFFFFFFFF) + 1] = values

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[(left.astype(np.int64) + 1) * self.width + right + 1]
        if not self.keys.size:
            return np.full(left.size, -1, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.int32(-1))


def gather(flat: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The sequences numbered ``order``, one after another."""
    n = lengths[order]
    first = np.cumsum(lengths) - lengths
    return flat[np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def scan_merge(flat: np.ndarray, lengths: np.ndarray, merged: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Left-to-right shift-reduce of many sequences side by side, sorted by length, longest
    first: each step pushes the next symbol of those that have one, and reduces while the two
    on top merge."""
    n, longest = lengths.size, int(lengths[0])
    first, base = np.cumsum(lengths) - lengths, np.arange(n) * longest
    stack, top = np.empty(n * longest, np.int32), base.copy()  # top: where the next symbol goes
    having = np.searchsorted(-lengths, -np.arange(longest))
    for i in range(longest):
        k = int(having[i])
        stack[top[:k]] = flat[first[:k] + i]
        top[:k] += 1
        at = np.flatnonzero(top[:k] - base[:k] > 1)
        while at.size:
            end = top[at]
            new = merged(stack[end - 2], stack[end - 1])
            hit = np.flatnonzero(new >= 0)
            at = at[hit]
            stack[end[hit] - 2] = new[hit]
            top[at] -= 1
            at = at[top[at] - base[at] > 1]
    left = top - base
    return stack.reshape(n, longest)[np.arange(longest) < left[:, None]], left


def rank_merge(flat: np.ndarray, lengths: np.ndarray, ranks: PairTable, new_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges replayed by rank over many sequences (none empty): each step merges, in each
    sequence, all occurrences of the first pair after the one merged before. A pair has one rank."""
    n = lengths.size
    row_of, last = np.arange(n), np.full(n, -1, np.int32)
    done: list[tuple] = []
    while lengths.size:
        ends = np.cumsum(lengths)
        row = np.repeat(np.arange(lengths.size), lengths)
        rank = np.full(flat.size, NO_RANK, np.int32)
        found = ranks(flat[:-1], flat[1:])
        rank[:-1] = np.where(found > last[row[:-1]], found, NO_RANK)
        rank[ends - 1] = NO_RANK
        low = np.minimum.reduceat(rank, ends - lengths)
        live = low < NO_RANK
        if not live.all():
            over = ~live[row]
            done.append((row_of[~live], flat[over], lengths[~live]))
            flat, rank, lengths, low, row_of = flat[~over], rank[~over], lengths[live], low[live], row_of[live]
            row = np.repeat(np.arange(lengths.size), lengths)
        pos = np.flatnonzero(rank == low[row]) if lengths.size else np.zeros(0, np.int64)
        if pos.size > 1 and (near := np.diff(pos) == 1).any():
            # Hits touch only in a run of one symbol merged with itself: take every other one.
            start = np.maximum.accumulate(np.where(np.r_[True, ~near], np.arange(pos.size), 0))
            pos = pos[(np.arange(pos.size) - start) % 2 == 0]
        flat[pos] = new_ids[rank[pos]]
        keep = np.ones(flat.size, bool)
        keep[pos + 1] = False
        lengths = lengths - np.bincount(row[pos], minlength=lengths.size)
        flat, last = flat[keep], low
    row_of, flat, lengths = (np.concatenate(x) for x in zip(*done))
    back = np.argsort(row_of)
    return gather(flat, lengths, back), lengths[back]
