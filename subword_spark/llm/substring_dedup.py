"""Removing passages that an earlier document holds: count-min prefilter, then exact grouping.

1. Documents are packed, as they are read, into blocks of bounded text, written once as a
   table in the shared folder. A block is the unit that later steps ask and answer.
2. Count-min sketch. Each block hashes its 13-word windows into ``depth`` rows of cells. A
   block's sketch is sparse (its sorted cells, as gaps), cut into segments by cell range. The
   sketches are merged by segment: a cell that two blocks hold, or one block holds twice,
   counts 2 or more. The answer to a block is one bit per cell. Counts are only ever too
   high, so a window that occurs twice is never lost. The sketch is never in one place: width
   and number of segments follow the number of windows.
3. Exact grouping of the windows whose least count is 2 or more: a block sends each such
   window once with its smallest document, and is told whether a smaller document elsewhere
   holds it. A window's key is 128 bits made of two XXH64 hashes of every one of its words, with
   seeds of their own; words are hashed as whole byte strings, so no pattern inside a word can
   make two words alike. (Comparing the words themselves would move seven times as much.)
4. Each block removes the words of the windows found and returns its documents.

Rows of a passage that thousands of documents share meet as one entry per block, so no group
grows with the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, prepare, returning, source, table
from .words import slices, split_words, text_of_word, texts_of, window_hashes, word_hashes

BLOCK_BYTES = 2 << 20
_ESC = 0xFFFF
_LAST = np.iinfo(np.int64).max


def to_gaps(cells: np.ndarray) -> bytes:
    """Sorted distinct numbers as 16-bit gaps; 0xFFFF adds 65,535 and goes on."""
    gaps = np.diff(cells, prepend=np.zeros(1, cells.dtype)).astype(np.int64)
    more = gaps // _ESC
    out = np.full(int(more.sum()) + len(gaps), _ESC, np.uint16)
    out[np.cumsum(more + 1) - 1] = gaps % _ESC
    return out.tobytes()


def from_gaps(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint16)
    return np.cumsum(gaps, dtype=np.int64)[gaps != _ESC]


def _pack(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of at most ``BLOCK_BYTES`` of text, or one document."""
    held: list[pa.RecordBatch] = []
    size = 0

    def block() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(whole)
        n = int(split_words(texts_of(whole, text_col)).counts.sum())
        return pa.RecordBatch.from_pydict({"block": pa.array([sink.getvalue().to_pybytes()], pa.binary()), "n": pa.array([n], pa.int64())})

    for batch in batches:
        for part, texts in slices(batch, text_col, BLOCK_BYTES // 4):
            more = int(pc.sum(pc.binary_length(texts)).as_py() or 0)
            if held and size + more > BLOCK_BYTES:
                yield block()
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield block()


class _Block:
    """A block's documents, words and window hashes."""

    def __init__(self, data: bytes, size: int, text_col: str, strong: bool = False):
        self.rows = pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0]
        self.texts = texts_of(self.rows, text_col)
        self.words = w = split_words(self.texts)
        ids = self.rows["id"]
        self.ids = ids.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        h = word_hashes(w, *((1, 3) if strong else (1,)))
        self.at, self.hash = window_hashes(h[0], w.first, size, 2)
        if strong:
            self.more = window_hashes(h[1], w.first, size, 4)[1]
        self.doc = self.ids[text_of_word(w.first)[self.at]]

    def cells(self, row: int, bits: int) -> np.ndarray:
        """The cell of each window in a row of the sketch: another multiply for each row."""
        m = np.uint64([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93][row])
        h = self.hash * m
        return ((h ^ (h >> np.uint64(29))) * m) >> np.uint64(64 - bits)

    def candidates(self, bits: int, depth: int, seg_bits: int, answers: list) -> np.ndarray:
        """Windows whose least count over all rows is 2 or more."""
        ok = np.ones(len(self.hash), bool)
        bit = {(a["row"], a["segment"]): a["bits"] for a in answers or []}
        for row in range(depth):
            cells, back, n = np.unique(self.cells(row, bits), return_inverse=True, return_counts=True)
            twice = n > 1
            seg = (cells >> np.uint64(seg_bits)).astype(np.int64)
            for s, lo, hi in _runs(seg):
                if (row, s) in bit:
                    twice[lo:hi] |= np.unpackbits(np.frombuffer(bit[row, s], np.uint8), count=hi - lo).view(bool)
            ok &= twice[back]
        return np.flatnonzero(ok)

    def entries(self, sel: np.ndarray, n_seg: int) -> tuple:
        """Distinct candidate windows, each with its smallest document, by segment and document."""
        k1, k2, doc = self.hash[sel], self.more[sel], self.doc[sel]
        order = np.lexsort((doc, k2, k1))
        a, b = k1[order], k2[order]
        head = np.ones(len(order), bool)
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        low = doc[order][head]
        seg = (a[head] % np.uint64(n_seg)).astype(np.int64)
        by = np.lexsort((a[head], low, seg))
        group = np.empty(len(order), np.int64)  # for each candidate, its entry
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        group[order] = rank[np.cumsum(head) - 1]
        return a[head][by], b[head][by], low[by], seg[by], group


def _runs(keys: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(keys):
        return []
    cut = np.flatnonzero(np.diff(keys)) + 1
    lo, hi = np.r_[0, cut], np.r_[cut, len(keys)]
    return [(int(keys[i]), int(i), int(j)) for i, j in zip(lo, hi)]


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row: bool = False,
    window: int = 13,
    depth: int = 2,
    cells_per_window: int = 8,
    layout: str = "words",
) -> DataFrame:
    """Remove each word covered by a window whose words also start in a smaller document.

    Returns ``id, n_words, n_removed, kept``, and with ``row`` also ``row``, a struct of all
    input columns. ``kept`` holds the kept words joined by one space (``layout="words"``), or
    the text without the removed words and the white space after each (``layout="text"``; a
    null text stays null).

    Windows are judged on the input. Null text: no words, kept is empty. Fewer words than a
    window, repeats inside one document, and rows with the same id: nothing is removed for
    them. A null id counts as larger than every other. Empty table: no rows. Other input
    columns are never read by name, so their names cannot clash. Text of any length stays
    whole; the longest text bounds the memory of a task.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = source(docs, id_col, text_col, row).withColumn("id", F.col("id").cast("long"))
    packed = rows.mapInArrow(returning(lambda batches: _pack(batches, text_col)), "block binary, n long").withColumn("block_id", F.monotonically_increasing_id())
    blocks = table(packed, "blocks")

    total = blocks.agg(F.sum("n")).first()[0] or 0
    bits = max(16, int(np.ceil(np.log2(max(total, 1) * cells_per_window))))
    # Segments hold about two million entries each.
    seg_bits = min(bits, 21 + int(np.log2(cells_per_window)))
    n_seg = max(1, total // 2_000_000)

    def sketch(batches):
        for batch in batches:
            for data, block_id in zip(batch["block"], batch["block_id"].to_pylist()):
                block = _Block(data.as_py(), window, text_col)
                for r in range(depth):
                    cells = np.unique(block.cells(r, bits))
                    seg = (cells >> np.uint64(seg_bits)).astype(np.int64)
                    runs = _runs(seg)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([r] * len(runs), pa.int32()),
                            "segment": pa.array([s for s, _, _ in runs], pa.int64()),
                            "block_id": pa.array([block_id] * len(runs), pa.int64()),
                            "cells": pa.array([to_gaps(cells[lo:hi] & np.uint64((1 << seg_bits) - 1)) for _, lo, hi in runs], pa.binary()),
                        }
                    )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [from_gaps(x) for x in pdf["cells"]]
        _, back, n = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        return _answer(pdf, each, n[back] > 1, ["row", "segment", "block_id"])

    answers = table(
        blocks.select("block", "block_id")
        .mapInArrow(returning(sketch), "row int, segment long, block_id long, cells binary")
        .groupBy("row", "segment")
        .applyInPandas(merge, "row int, segment long, block_id long, bits binary"),
        "sketch",
    )
    counted = answers.groupBy("block_id").agg(F.collect_list(F.struct("row", "segment", "bits")).alias("counted"))
    asked = blocks.select("block", "block_id").join(counted, "block_id", "left")

    def ask(batches):
        for batch in batches:
            for data, block_id, got in zip(batch["block"], batch["block_id"].to_pylist(), batch["counted"]):
                block = _Block(data.as_py(), window, text_col, strong=True)
                a, b, low, seg, _ = block.entries(block.candidates(bits, depth, seg_bits, got.as_py()), n_seg)
                out = {"segment": [], "block_id": [], "keys": [], "docs": [], "runs": []}
                for s, lo, hi in _runs(seg):
                    docs_of = _runs(low[lo:hi])
                    key = np.empty(hi - lo, [("a", "<u8"), ("b", "<u8")])
                    key["a"], key["b"] = a[lo:hi], b[lo:hi]
                    out["segment"].append(s)
                    out["block_id"].append(block_id)
                    out["keys"].append(key.tobytes())
                    out["docs"].append(np.array([d for d, _, _ in docs_of], np.int64).tobytes())
                    out["runs"].append(np.array([j - i for _, i, j in docs_of], np.uint32).tobytes())
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v, pa.int64() if k in ("segment", "block_id") else pa.binary()) for k, v in out.items()}
                )

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(x, [("a", "<u8"), ("b", "<u8")]) for x in pdf["keys"]]
        doc = np.concatenate([np.repeat(np.frombuffer(d, np.int64), np.frombuffer(r, np.uint32)) for d, r in zip(pdf["docs"], pdf["runs"])])
        a, b = np.concatenate([x["a"] for x in each]), np.concatenate([x["b"] for x in each])
        order = np.lexsort((doc, b, a))
        head = np.ones(len(order), bool)
        head[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        low = doc[order][head][np.cumsum(head) - 1]
        smaller = np.empty(len(order), bool)
        smaller[order] = doc[order] > low
        return _answer(pdf, each, smaller, ["segment", "block_id"])

    exact = table(
        asked.mapInArrow(returning(ask), "segment long, block_id long, keys binary, docs binary, runs binary")
        .groupBy("segment")
        .applyInPandas(group, "segment long, block_id long, bits binary"),
        "exact",
    )
    found = exact.groupBy("block_id").agg(F.collect_list(F.struct("segment", "bits")).alias("found"))

    def cut(batches):
        for batch in batches:
            for data, counted, found in zip(batch["block"], batch["counted"], batch["found"]):
                block = _Block(data.as_py(), window, text_col, strong=True)
                sel = block.candidates(bits, depth, seg_bits, counted.as_py())
                _, _, low, seg, group_of = block.entries(sel, n_seg)
                smaller = np.zeros(len(low), bool)
                bit = {x["segment"]: x["bits"] for x in found.as_py() or []}
                for s, lo, hi in _runs(seg):
                    if s in bit:
                        smaller[lo:hi] = np.unpackbits(np.frombuffer(bit[s], np.uint8), count=hi - lo).view(bool)
                gone = smaller[group_of] | (block.doc[sel] > low[group_of])
                yield from _without(block, block.at[sel[gone]], window, layout, row)

    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
        + ([rows.schema["row"]] if row else [])
    )
    return asked.join(found, "block_id", "left").select("block", "counted", "found").mapInArrow(returning(cut), schema)


def _answer(pdf: pd.DataFrame, each: list, yes: np.ndarray, keys: list[str]) -> pd.DataFrame:
    """A bit per entry back to each block that has asked; none to a block that has no yes."""
    ends = np.cumsum([len(x) for x in each])
    bits = [yes[e - len(x) : e] for e, x in zip(ends, each)]
    some = np.array([x.any() for x in bits], bool)
    out = pdf.loc[some, keys].copy()
    out["bits"] = [np.packbits(x).tobytes() for x in bits if x.any()]
    give_back()
    return out


def _without(block: _Block, starts: np.ndarray, window: int, layout: str, row: bool) -> Iterator[pa.RecordBatch]:
    w = block.words
    n = len(w.starts)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    gone = np.cumsum(edge[:n]) > 0
    removed = np.diff(np.r_[0, np.cumsum(gone)][w.first])
    kept = []
    for i in range(len(w.first) - 1):
        lo, hi = w.first[i], w.first[i + 1]
        text = w.text(i)
        if layout == "words":
            words = text.split()
            kept.append(b" ".join(words if not removed[i] else [x for x, g in zip(words, gone[lo:hi].tolist()) if not g]))
        elif removed[i]:
            out = np.ones(len(text), bool)
            at = w.starts[lo:hi] - w.offsets[i]
            for a, b in zip(at[gone[lo:hi]], np.r_[at[1:], len(text)][gone[lo:hi]]):
                out[a:b] = False
            kept.append(w.data[w.offsets[i] : w.offsets[i + 1]][out].tobytes())
        else:
            kept.append(text if block.texts[i].is_valid else None)
    cols = {
        "id": block.rows["id"],
        "n_words": pa.array(w.counts.astype(np.int64)),
        "n_removed": pa.array(removed.astype(np.int64)),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
    }
    if row:
        cols["row"] = block.rows["row"]
    yield pa.RecordBatch.from_pydict(cols)
