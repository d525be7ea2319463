"""Encode text columns to token ids.

Pretokenisation is a native column expression, or for words of simple texts a numpy split of
the batch; the merge step is sequential per row, so it runs in an Arrow UDF holding the model
(bounded by the vocabulary size). The operator is narrow: no shuffle, one pass. An Arrow batch is
worked on, and leaves, in slices of bounded text; each distinct word or line of a slice is encoded
once, and many of them side by side.

``order='scan'`` is the reference tokenizer's left-to-right scan (a shift-reduce stack, O(n));
``order='rank'`` replays merges by rank, each over all occurrences, left to right
(heap over positions, O(n log n)); on training text it reproduces the training result.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import ship_package
from . import kernels
from .model import BPEModel
from .symbols import computed_once, line_sequence, splits_in_batches, text_or_words, word_sequences

ENCODED_DDL = "ids array<int>, n_unknown int"
UNKNOWN = -1  # id of a symbol outside the vocabulary; never part of a merge
_ENCODED = pa.struct([("ids", pa.list_(pa.int32())), ("n_unknown", pa.int32())])
# Characters of sequence text that one numpy step holds; a longer row is its own slice.
MAX_SLICE_CHARS = 1 << 21


class Encoder:
    """Worker-side encoder built from the model's plain lists."""

    def __init__(self, tokens: list[str], table: list[tuple[int, int, int]], unknown_id: int, order: str):
        self.n_vocab = len(tokens)
        self.unknown_id = unknown_id
        self.order = order
        self.single: dict[str, int] = {}
        for i, t in enumerate(tokens):
            if len(t) == 1:
                self.single.setdefault(t, i)
        self.merge_new: dict[int, int] = {}
        self.ranks: dict[int, list[int]] = {}
        self.rank_new = [n for _, _, n in table]
        for rank, (l, r, n) in enumerate(table):
            key = (l << 32) | r
            self.merge_new.setdefault(key, n)
            self.ranks.setdefault(key, []).append(rank)
        # The same for many sequences at once.
        self.symbols = np.full(0x110000, UNKNOWN, np.int32)
        self.symbols[[ord(c) for c in self.single]] = list(self.single.values())
        n_ids = max([len(tokens), *(max(x) + 1 for x in table)])
        self.twice = any(len(r) > 1 for r in self.ranks.values())
        if order == "scan":
            self.merged = kernels.PairTable(self.merge_new, n_ids)
        else:
            self.pair_rank = kernels.PairTable({k: r[0] for k, r in self.ranks.items()}, n_ids)
            self.rank_ids = np.array(self.rank_new, np.int32)

    # -- merge orders ---------------------------------------------------------------
    def _scan(self, ids: list[int]) -> list[int]:
        mm = self.merge_new
        st: list[int] = []
        for t in ids:
            st.append(t)
            while len(st) > 1:
                n = mm.get((st[-2] << 32) | st[-1])
                if n is None:
                    break
                st.pop()
                st[-1] = n
        return st

    def _next_rank(self, a: int, b: int, after: int) -> int | None:
        rs = self.ranks.get((a << 32) | b)
        if not rs:
            return None
        k = bisect_right(rs, after)
        return rs[k] if k < len(rs) else None

    def _rank(self, ids: list[int]) -> list[int]:
        n = len(ids)
        if n < 2:
            return ids
        val = list(ids)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        alive = [True] * n
        heap = []
        for i in range(n - 1):
            rk = self._next_rank(val[i], val[i + 1], -1)
            if rk is not None:
                heap.append((rk, i, val[i], val[i + 1]))
        heapq.heapify(heap)
        while heap:
            rk, i, a, b = heapq.heappop(heap)
            if not alive[i] or val[i] != a:
                continue
            j = nxt[i]
            if j >= n or val[j] != b:
                continue
            val[i] = self.rank_new[rk]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            p = prv[i]
            if p >= 0:
                r2 = self._next_rank(val[p], val[i], rk)
                if r2 is not None:
                    heapq.heappush(heap, (r2, p, val[p], val[i]))
            q = nxt[i]
            if q < n:
                r2 = self._next_rank(val[i], val[q], rk)
                if r2 is not None:
                    heapq.heappush(heap, (r2, i, val[i], val[q]))
        out = []
        i = 0
        while i < n:
            out.append(val[i])
            i = nxt[i]
        return out

    # -- public ---------------------------------------------------------------------
    def encode_symbols(self, s: str) -> tuple[list[int], int]:
        """Ids of one sequence string (one character per symbol) and its unknown count."""
        single = self.single
        ids = [single.get(c, UNKNOWN) for c in s]
        merged = self._scan(ids) if self.order == "scan" else self._rank(ids)
        nv, unk = self.n_vocab, self.unknown_id
        out = [t if 0 <= t < nv else unk for t in merged]
        missing = sum(1 for t in merged if not 0 <= t < nv)
        return out, missing

    def encode_distinct(self, seqs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of sequence strings one after another, how many each has, and how many of those
        are unknown."""
        n = pc.utf8_length(seqs).to_numpy(zero_copy_only=False).astype(np.int64)
        points = kernels.points_of(seqs)
        order = np.argsort(-n, kind="stable")
        lengths, flat = n[order], kernels.gather(self.symbols[points], n, order)
        ends = np.cumsum(lengths)
        made: list[tuple[np.ndarray, np.ndarray]] = []
        lo, some = 0, int(np.count_nonzero(lengths))
        while lo < some:  # longest first
            longest = int(lengths[lo])
            hi = min(some, lo + max(1, kernels.MAX_CELLS // longest))
            part = flat[ends[lo] - longest : ends[hi - 1]]
            if hi - lo < kernels.MIN_SIDE_BY_SIDE or self.order == "rank" and (self.twice or longest > kernels.MAX_RANK_SYMBOLS):
                hi = hi if hi - lo < kernels.MIN_SIDE_BY_SIDE or self.twice else int(np.searchsorted(-lengths[:hi], -kernels.MAX_RANK_SYMBOLS))
                merge = self._scan if self.order == "scan" else self._rank
                each = [np.array(merge(flat[e - k : e].tolist()), np.int32) for e, k in zip(ends[lo:hi], lengths[lo:hi])]
                made.append((np.concatenate(each), np.array([len(x) for x in each], np.int64)))
            elif self.order == "scan":
                made.append(kernels.scan_merge(part, lengths[lo:hi], self.merged))
            else:
                made.append(kernels.rank_merge(part, lengths[lo:hi], self.pair_rank, self.rank_ids))
            lo = hi
        made.append((np.empty(0, np.int32), np.zeros(len(n) - some, np.int64)))
        flat, lengths = (np.concatenate(x) for x in zip(*made))
        back = np.argsort(order)
        flat, lengths = kernels.gather(flat, lengths, back), lengths[back]
        bad = (flat < 0) | (flat >= self.n_vocab)
        lost = np.diff(np.concatenate(([0], np.cumsum(bad)))[np.concatenate(([0], np.cumsum(lengths)))])
        return np.where(bad, np.int32(self.unknown_id), flat), lengths, lost

    def encode_rows(self, rows: pa.Array) -> pa.StructArray:
        """``struct<ids, n_unknown>`` of rows of sequence strings, or of lists of them."""
        return pa.concat_arrays([pa.array([], _ENCODED), *self.encode_parts(rows)])

    def encode_parts(self, rows: pa.Array) -> Iterator[pa.StructArray]:
        """:meth:`encode_rows` slice by slice. Nothing is held for each symbol or sequence of the
        rows but numbers, and those of one slice at a time."""
        if not pa.types.is_list(rows.type) and not pa.types.is_large_list(rows.type):
            at = np.arange(len(rows) + 1) - np.concatenate(([0], np.cumsum(rows.is_null().to_numpy(zero_copy_only=False))))
            seqs = rows.drop_null()
        else:
            at = np.concatenate(([0], np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))))
            seqs = rows.flatten()
        for lo, hi in _ranges(kernels.byte_offsets(seqs)[at].astype(np.int64) + at):
            yield self._encode_slice(seqs.slice(at[lo], at[hi] - at[lo]), at[lo : hi + 1] - at[lo], rows.slice(lo, hi - lo).is_null())

    def encode_texts(self, texts: pa.Array, words: pa.Array, marker: str) -> Iterator[pa.StructArray]:
        """:meth:`encode_parts` of raw texts, or of their words where the text is null."""
        size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in _ranges(np.concatenate(([0], np.cumsum(size)))):
            some, others = texts.slice(lo, hi - lo), words.slice(lo, hi - lo)
            if others.null_count == len(others):
                yield self._encode_slice(*kernels.split_words(some, marker), some.is_null())
                continue
            for raw, start, stop in _stretches(some.is_valid().to_numpy(zero_copy_only=False)):
                if raw:
                    part = some.slice(start, stop - start)
                    yield self._encode_slice(*kernels.split_words(part, marker), part.is_null())
                else:
                    yield from self.encode_parts(others.slice(start, stop - start))

    def encode_batch(self, values, words: bool) -> tuple[list, list]:
        """:meth:`encode_rows` of Python values: id arrays and unknown counts."""
        kind = pa.list_(pa.string()) if words else pa.string()
        ids, lost = self.encode_rows(pa.array(list(values), kind)).flatten()
        return [None if x is None else np.array(x, np.int32) for x in ids.to_pylist()], lost.to_pylist()

    def _encode_slice(self, seqs: pa.Array, at: np.ndarray, none: pa.Array) -> pa.StructArray:
        """Each distinct sequence is encoded once, and every row's ids are gathered with numpy.
        ``at``: where each row begins among the sequences; ``none``: which rows are null."""
        coded = seqs.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        flat, lengths, lost = self.encode_distinct(coded.dictionary)
        n, gone = (np.concatenate(([0], np.cumsum(x[codes])))[at] if x.any() else np.zeros(len(at), np.int64) for x in (lengths, lost))
        if n[-1] > np.iinfo(np.int32).max:
            raise ValueError("a row has more than 2^31 ids: encode it in pieces")
        lists = pa.ListArray.from_arrays(pa.array(n.astype(np.int32)), pa.array(kernels.gather(flat, lengths, codes)), mask=none)
        lost = pa.array(np.diff(gone).astype(np.int32), mask=none.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([lists, lost], names=["ids", "n_unknown"])


def _ranges(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows in stretches of at most ``MAX_SLICE_CHARS``, or one row; ``size``: that of all before."""
    lo = 0
    while lo < len(size) - 1:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + MAX_SLICE_CHARS, "right")) - 1)
        yield lo, hi
        lo = hi


def _stretches(flags: np.ndarray) -> Iterator[tuple[bool, int, int]]:
    """Runs of equal flags."""
    edges = [0, *(np.flatnonzero(np.diff(flags)) + 1).tolist(), len(flags)]
    for lo, hi in zip(edges, edges[1:]):
        yield bool(flags[lo]), lo, hi


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, payload: str, order: str) -> Encoder:
    enc = _ENCODERS.get(key)
    if enc is None:
        d = json.loads(payload)
        enc = Encoder(d["tokens"], [tuple(x) for x in d["table"]], d["unknown_id"], order)
        _ENCODERS.clear()
        _ENCODERS[key] = enc
    return enc


def model_payload(model: BPEModel) -> tuple[str, str]:
    payload = json.dumps(
        {"tokens": model.tokens, "table": model.merge_table(), "unknown_id": model.unknown_id},
        ensure_ascii=False,
    )
    import hashlib

    return hashlib.sha1(payload.encode("utf-8")).hexdigest(), payload


def _encode_udf(model: BPEModel, order: str, sep: str | None = None):
    key, payload = model_payload(model)
    key = f"{key}-{order}"

    @arrow_udf(ENCODED_DDL)
    def _encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            rows = pc.split_pattern(rows, sep) if sep else rows
            yield from _encoder(key, payload, order).encode_parts(rows)

    return _encode


def _encode_text_udf(model: BPEModel, order: str):
    key, payload = model_payload(model)
    key, marker = f"{key}-{order}", model.options.marker

    @arrow_udf(ENCODED_DDL)
    def _encode(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, words in batches:
            yield from _encoder(key, payload, order).encode_texts(texts, words, marker)

    return _encode


def encode_column(col: Column, model: BPEModel, order: str = "scan") -> Column:
    """``struct<ids array<int>, n_unknown int>`` of a text column."""
    if order not in ("scan", "rank"):
        raise ValueError("order must be 'scan' or 'rank'")
    opts = model.options
    if splits_in_batches(opts):
        return _encode_text_udf(model, order)(*text_or_words(col, opts))
    if opts.unit == "word":
        return _encode_udf(model, order)(word_sequences(col, opts))
    return _encode_udf(model, order)(line_sequence(col, opts))


def encode_sequences(seqs: Column, model: BPEModel, order: str = "scan", sep: str | None = None) -> Column:
    """``struct<ids, n_unknown>`` of an array of sequence strings, one after another; or of one
    string, which holds one sequence or, with ``sep`` between them, several."""
    return _encode_udf(model, order, sep)(seqs)


def encode(
    df: DataFrame,
    text_col: str,
    model: BPEModel,
    out_col: str = "ids",
    order: str = "scan",
    strict: bool = False,
    unknown_col: str | None = None,
) -> DataFrame:
    """Add ``out_col`` (array<int>). Unknown symbols become the unknown token's id, or,
    with ``strict``, fail the job; ``unknown_col`` keeps the per-row count of them."""
    ship_package(df.sparkSession)
    enc = f"__enc_{out_col}"
    # Through a one-row generator: a filter on the result never re-runs the UDF, while
    # filters on the other columns still reach the scan (see ``computed_once``).
    out = computed_once(df, enc, encode_column(F.col(text_col), model, order))
    ids = F.col(f"{enc}.ids")
    if strict:
        ids = F.when(
            F.col(f"{enc}.n_unknown") > 0, F.raise_error(F.lit("token not in vocabulary (strict encode)"))
        ).otherwise(ids)
    out = out.withColumn(out_col, ids)
    if unknown_col:
        out = out.withColumn(unknown_col, F.col(f"{enc}.n_unknown"))
    return out.drop(enc)
