"""Periodic runs of words, found by multi-scale minimizers.

A run is a longest stretch of consecutive words with smallest period q that goes through it at
least ``exponent`` times. At the scale w (a power of 2) the periods from w to 2w - 1 are found:

1. Every w words at a place are a gram. Grams are numbered exactly, by doubling: a gram of 2w
   words is the pair of the numbers of its halves. Only grams that occur twice in the text go
   on, so most texts leave after a few doublings.
2. Minimizers: the grams with the least value (a fixed random order) of some w neighbouring
   places. Inside a run a window and the one a period later hold the same grams, so both have
   the same minima, one period apart.
3. Equal minimizers that are w to 2w - 1 words apart seed a candidate, and the gram numbers of
   all scales give how far the words agree on both sides, in log(n) steps.

A gram that lies in a run of a period up to w/4 is no minimizer. The others recur more than
w/4 words apart, so each has only a few partners at its scale, whatever the text; and a run of
period w or more has such a gram in every period, since otherwise all its grams, hence the run
itself, would have one period of at most w/4. Periods below the first scale are found by
comparing the words with those 1, 2, ... places on.

Works on numbers of whole words (equal numbers for equal bytes, no hashing), per text, in
slices of bounded bytes or one text; no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, row_field, source
from .words import covered, mix, slices, split_words, text_of_word, word_numbers

#: Periods up to this are found by direct lag scans; from here on by minimizers.
BASE = 8


def find_runs(word: np.ndarray, first: np.ndarray, exponent: int = 4, shortest: int = 6) -> np.ndarray:
    """All runs as rows ``(first word, end, period)``, by first word, then period.

    ``word``: equal numbers for equal words, from 0. ``first``: the first word of each text, and the end.
    A run has at least ``exponent`` times its period (4 or more) and ``shortest`` words.
    """
    if exponent < 4:
        raise ValueError("the scales need runs of 4 periods or more")
    text = text_of_word(first)
    found = [_lag_scan(word, text, q, exponent, shortest) for q in range(1, BASE)]
    names = _gram_names(word, text, first)
    for k in range(len(names)):
        if 1 << k >= BASE:
            found.append(_scale(names, k, text, np.concatenate(found), exponent, shortest))
    rows = np.concatenate(found)
    # A multiple of a run's period gives the same stretch again: the smallest period counts.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _rows(start: np.ndarray, end: np.ndarray, period, exponent: int, shortest: int) -> np.ndarray:
    rows = np.stack([start, end, np.broadcast_to(period, len(start))], 1).astype(np.int64)
    size = rows[:, 1] - rows[:, 0]
    return rows[(size >= shortest) & (size >= exponent * rows[:, 2])]


def _lag_scan(word: np.ndarray, text: np.ndarray, q: int, exponent: int, shortest: int) -> np.ndarray:
    same = np.zeros(max(len(word) - q, 0) + 2, np.int8)
    if len(word) > q:
        same[1:-1] = (word[q:] == word[:-q]) & (text[q:] == text[:-q])
    edge = np.diff(same)
    return _rows(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q, q, exponent, shortest)


def _gram_names(word: np.ndarray, text: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ... the number of the 2^k words at each place: equal for equal words of
    one text, -1 where they are the only ones in the text or reach over its end."""
    n = len(word)
    end = first[1:][text]
    out: list[np.ndarray] = []
    at, key = np.arange(n), text * (int(word.max(initial=0)) + 1) + word
    while len(at):
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        shared = np.r_[False, same] | np.r_[same, False]
        number = np.cumsum(np.r_[True, ~same]) - 1
        at, number = at[order][shared], number[shared]
        if not len(at):
            break
        name = np.full(n, -1, np.int32)
        name[at] = number
        out.append(name)
        half = 1 << (len(out) - 1)
        at = np.sort(at)
        at = at[at + 2 * half <= end[at]]
        at = at[name[at + half] >= 0]
        key = name[at].astype(np.int64) * (int(name.max()) + 1) + name[at + half]
    return out


def _scale(names: list[np.ndarray], k: int, text: np.ndarray, known: np.ndarray, exponent: int, shortest: int) -> np.ndarray:
    """Runs of a period from w = 2^k to 2w - 1; ``known``: all runs of smaller periods."""
    w, name = 1 << k, names[k]
    free = name >= 0
    short = known[(known[:, 2] <= w // 4) & (known[:, 1] - known[:, 0] >= w)]
    free &= ~covered(short[:, 0], short[:, 1] - short[:, 0] - w + 1, len(name))
    if not free.any():
        return np.zeros((0, 3), np.int64)
    # Only texts with such grams, side by side.
    some = np.zeros(int(text[-1]) + 1, bool)
    some[text[free]] = True
    place = np.flatnonzero(some[text])
    at = place[_minimizers(np.where(free[place], mix(name[place].astype(np.uint64) + np.uint64(1)) >> np.uint64(1), np.uint64(2**64 - 1)), w)]
    at = at[np.argsort(name[at], kind="stable")]
    a, b = [], []
    step = 1
    while step < len(at):
        gap = np.where(name[at[step:]] == name[at[:-step]], at[step:] - at[:-step], 2 * w)
        near = gap < 2 * w
        if not near.any():
            break
        seed = near & (gap >= w)
        a.append(at[:-step][seed])
        b.append(at[step:][seed])
        step += 1
    if not a:
        return np.zeros((0, 3), np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    left, right = _agree_left(names, a, b), _agree_right(names, a, b)
    return np.unique(_rows(a - left, b + right, b - a, exponent, shortest), axis=0)


def _minimizers(value: np.ndarray, w: int) -> np.ndarray:
    """Places whose value is the least of some w neighbours; the largest number is no value."""
    low = value.copy()
    step = 1
    while step < w:
        low[:-step] = np.minimum(low[:-step], low[step:])
        step *= 2
    step = 1
    while step < w:  # of all windows that hold a place, the one with the largest minimum
        low[step:] = np.maximum(low[step:], low[:-step])
        step *= 2
    return np.flatnonzero((low == value) & (value != np.uint64(2**64 - 1)))


def _agree_right(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a and from b on agree. A gram is named only where it recurs, so
    agreeing words are a sum of named grams, each size at most once below the largest."""
    size = np.zeros(len(a), np.int64)
    n = len(names[0])
    for k in range(len(names) - 1, -1, -1):
        x, y = names[k][np.minimum(a + size, n - 1)], names[k][np.minimum(b + size, n - 1)]
        size += ((x == y) & (x >= 0) & (b + size < n)).astype(np.int64) << k
    return size


def _agree_left(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a and before b agree."""
    size = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        i, j = a - size - (1 << k), b - size - (1 << k)
        x, y = names[k][np.maximum(i, 0)], names[k][np.maximum(j, 0)]
        size += ((i >= 0) & (x == y) & (x >= 0)).astype(np.int64) << k
    return size


def period_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: bool = False, exponent: int = 4, shortest: int = 6) -> DataFrame:
    """The periodic runs of every whole text, and the text with each run cut to one period.

    Returns ``id, n_words``, ``runs`` (array of start, length and period in words, by start,
    then period), ``n_dropped`` (words that some run holds after its first period) and
    ``collapsed`` (the other words joined by one space), and with ``row`` also ``row``, a
    struct of all input columns.

    Null and empty texts have no words and no runs; collapsed is empty. Equal texts get equal
    results; ids may be null or repeat and are only passed on. Empty table: no rows. Other
    input columns are never read by name. The longest single text bounds a task's memory.
    """
    prepare(docs.sparkSession)
    rows = source(docs, id_col, text_col, row)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col, 2 << 20):
                w = split_words(texts)
                n = len(w.starts)
                found = find_runs(word_numbers(w)[0], w.first, exponent, shortest)
                start, end, period = found.T
                of = np.searchsorted(w.first, start, "right") - 1
                # A text that is empty shares its first word with the next: take the one that holds it.
                inner = pa.StructArray.from_arrays([pa.array(x) for x in (start - w.first[of], end - start, period)], fields=list(run_type))
                offsets = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
                gone = covered(start + period, end - start - period, n)
                out = {
                    "id": part["id"],
                    "n_words": pa.array(w.counts.astype(np.int64)),
                    "runs": pa.ListArray.from_arrays(pa.array(offsets), inner),
                    "n_dropped": pa.array(np.diff(np.r_[0, np.cumsum(gone)][w.first]).astype(np.int64)),
                    "collapsed": pa.array([_kept(w.text(i), gone[w.first[i] : w.first[i + 1]]) for i in range(len(texts))], pa.binary()).cast(pa.string()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"row": part["row"]} if row else {}))

    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, n_dropped long, collapsed string"
    return rows.mapInArrow(run, ddl + row_field(rows))


def _kept(text: bytes, gone: np.ndarray) -> bytes:
    words = text.split()
    return b" ".join([x for x, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
