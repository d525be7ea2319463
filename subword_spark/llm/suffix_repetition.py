"""Quality rules with repetition found by a suffix array.

All texts of a slice are sorted together: suffixes are ranked by their text and first word,
then by 2, 4, 8, ... words, and only suffixes that still share a rank are sorted again. The
longest common prefix of neighbours in the suffix array follows from the kept ranks. The
deepest LCP interval that holds a suffix has the length of the longest substring that starts
there and occurs again in the same text; these spans are the maximal repeated substrings and
their tails. Their union gives the covered words, their largest length the longest repeat.

Works on numbers of whole words (equal numbers for equal bytes, no hashing), per text, in slices of bounded bytes or one
text; no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, row_field, source
from .words import Words, covered, slices, split_words, text_of_word, word_numbers

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """The rules. Base: fewest words, and the largest share of words in repeated 3-word
    windows. Method: repeats of at least ``min_repeat`` words may cover at most ``max_covered``
    of the words, and none may be longer than ``max_longest`` words."""

    min_words: int = 50
    max_window_share: float = 0.5
    min_repeat: int = 8
    max_covered: float = 0.3
    max_longest: int = 100


def longest_repeats(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run of words that starts there and starts
    again elsewhere in the same text; runs shorter than 2 words count 0.

    ``word``: equal numbers for equal words. ``first``: the first word of each text.
    """
    n = len(word)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    text = text_of_word(first)
    end = first[1:][text]
    order = np.lexsort((word, text))
    head = np.ones(n, bool)
    head[1:] = (word[order][1:] != word[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, reach = [], 1
    shared = _shared(rank[order])
    active = order[shared]
    while len(active):
        levels.append(rank.copy())
        # The rank of the words that follow; past the end of the text comes first of all.
        follow = active + reach
        inside = follow < end[active]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[active]))
        active = active[order]
        a, b, at = rank[active], second[order], np.arange(len(active))
        old = np.ones(len(active), bool)
        old[1:] = a[1:] != a[:-1]
        new = old.copy()
        new[1:] |= b[1:] != b[:-1]
        fresh = a + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old, at, 0))
        rank[active] = fresh
        active = active[_shared(fresh)]
        reach *= 2
    if len(levels) < 2:
        return out
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # Neighbours that share their first two words; the lengths come from the longest level down.
    pair = np.flatnonzero(levels[1][suffixes[1:]] == levels[1][suffixes[:-1]])
    a, b = suffixes[pair], suffixes[pair + 1]
    length = np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        same = (x < n) & (y < n)
        same &= levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]
        length += same.astype(np.int64) << k
    np.maximum.at(out, a, length)
    np.maximum.at(out, b, length)
    return out


def _shared(sorted_ranks: np.ndarray) -> np.ndarray:
    same = sorted_ranks[1:] == sorted_ranks[:-1]
    out = np.zeros(len(sorted_ranks), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(marks, dtype=np.int64)][bounds])


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def features(texts: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    w: Words = split_words(texts)
    n = len(w.starts)
    in_word = covered(w.starts, w.ends - w.starts, len(w.data))
    character = (w.data & 0xC0) != 0x80
    repeat = longest_repeats(word_numbers(w)[0], w.first)
    three = np.flatnonzero(repeat >= 3)
    long_ = np.flatnonzero(repeat >= limits.min_repeat)
    longest = np.zeros(len(w.first) - 1, np.int64)
    np.maximum.at(longest, text_of_word(w.first)[long_], repeat[long_])
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(in_word & character, w.offsets),
        "n_symbols": _per_text(_SYMBOL[w.data], w.offsets),
        "n_dup_lines": np.array([duplicate_lines(w.text(i)) for i in range(len(w.first) - 1)], np.int64),
        "n_repeat_words": _per_text(covered(three, 3, n), w.first),
        "n_covered_words": _per_text(covered(long_, repeat[long_], n), w.first),
        "longest_repeat": longest,
    }


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), row: bool = False) -> DataFrame:
    """Features and verdict of every whole text.

    Returns ``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_covered_words, longest_repeat, base_failed, kept``, and with ``row`` also ``row``, a
    struct of all input columns.

    Null and empty texts have no words: all counts 0, base_failed true. Equal texts get equal
    verdicts; ids may be null or repeat. Empty table: no rows. Other input columns are never
    read by name.
    """
    prepare(docs.sparkSession)
    rows = source(docs, id_col, text_col, row)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col, 2 << 20):
                f = features(texts, limits)
                failed = (f["n_words"] < limits.min_words) | (f["n_repeat_words"] > limits.max_window_share * f["n_words"])
                kept = ~failed & (f["n_covered_words"] <= limits.max_covered * f["n_words"]) & (f["longest_repeat"] <= limits.max_longest)
                out = {"id": part["id"]} | {k: pa.array(v) for k, v in f.items()} | {"base_failed": pa.array(failed), "kept": pa.array(kept)}
                yield pa.RecordBatch.from_pydict(out | ({"row": part["row"]} if row else {}))

    counts = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean" + row_field(rows))
