"""Property tests of the Arrow kernels against plain Python merges and counts."""

from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from bpe_reference import merge_left_to_right
from subword_spark.operators import kernels as K
from subword_spark.operators.blocks import Block
from subword_spark.operators.pairs import conflict_free_groups

seqs_st = st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=8)


def batch_of(seqs, weights=None):
    weights = weights or [1] * len(seqs)
    return pa.RecordBatch.from_pydict({"seq": pa.array(seqs, pa.list_(pa.int32())), "weight": pa.array(weights, pa.int64())})


def counts_of(batches):
    out = Counter()
    for b in batches:
        for l, r, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            out[(l, r)] += c
    return out


@settings(max_examples=150, deadline=None)
@given(seqs_st, st.lists(st.integers(1, 5), min_size=8, max_size=8))
def test_count_pairs(seqs, ws):
    ws = ws[: len(seqs)]
    expect = Counter()
    for s, w in zip(seqs, ws):
        for a, b in zip(s, s[1:]):
            expect[(a, b)] += w
    assert counts_of(K.count_pairs([batch_of(seqs, ws)])) == expect
    assert counts_of(K.count_pairs(K.slices([batch_of(seqs, ws)], max_symbols=3))) == expect


@settings(max_examples=200, deadline=None)
@given(seqs_st, st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=4))
def test_apply_groups_equal_sequential_merges(seqs, pairs):
    merges = [(l, r, 10 + i) for i, (l, r) in enumerate(pairs)]
    expect = [list(s) for s in seqs]
    for l, r, n in merges:
        expect = [merge_left_to_right(s, l, r, n) for s in expect]
    got = [list(s) for s in seqs]
    for group in conflict_free_groups(merges):
        keys = np.array([(l << 32) | r for l, r, _ in group], dtype=np.int64)
        new = np.array([n for _, _, n in group], dtype=np.int64)
        o = np.argsort(keys)
        out = list(K.apply_merges([batch_of(got)], keys[o], new[o], min_len=0))
        got = [list(x) for b in out for x in b.column(0).to_pylist()]
    assert got == expect


@settings(max_examples=150, deadline=None)
@given(seqs_st, st.lists(st.integers(1, 5), min_size=8, max_size=8), st.tuples(st.integers(0, 3), st.integers(0, 3)))
def test_step_applies_and_counts_changes(seqs, ws, pair):
    l, r = pair
    ws = ws[: len(seqs)]
    merged = [merge_left_to_right(list(s), l, r, 9) for s in seqs]
    expect_state = [(s, w) for s, w in zip(merged, ws) if len(s) >= 2]
    expect_counts = Counter()
    for before, after, w in zip(seqs, merged, ws):
        for a, b in zip(before, before[1:]):
            expect_counts[(a, b)] -= w
        for a, b in zip(after, after[1:]):
            expect_counts[(a, b)] += w
    rows = [(s, w) for s, w in zip(seqs, ws) if s]
    block = Block(*(np.array(x, t) for x, t in (([i for s, _ in rows for i in s], np.int32), ([len(s) for s, _ in rows], np.int32), ([w for _, w in rows], np.int64))))
    after, keys, deltas = block.merge(np.array([(l << 32) | r], np.int64), np.array([9], np.int32))
    counts = {(int(k >> 32), int(k & 0xFFFFFFFF)): int(d) for k, d in zip(keys, deltas)}
    assert counts == {k: v for k, v in expect_counts.items() if v}
    cuts = np.cumsum(after.lengths)[:-1]
    state = list(zip([x.tolist() for x in np.split(after.ids, cuts)], after.weights.tolist())) if after.lengths.size else []
    assert [x for x in state if len(x[0]) > 1] == expect_state


@settings(max_examples=60, deadline=None)
@given(seqs_st, st.sets(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=6))
def test_block_cut(seqs, live):
    """Cut between all symbols whose pair is not live; pieces of one symbol go."""
    rows = [s for s in seqs if s]
    block = Block(np.array([i for s in rows for i in s], np.int32), np.array([len(s) for s in rows], np.int32), np.arange(len(rows)))
    got = block.cut(np.array(sorted((l << 32) | r for l, r in live), np.int64))
    want = []
    for w, s in enumerate(rows):
        piece = [s[0]]
        for a, b in zip(s, s[1:]):
            if (a, b) in live:
                piece.append(b)
            else:
                want.append((piece, w))
                piece = [b]
        want.append((piece, w))
    pieces = np.split(got.ids, np.cumsum(got.lengths)[:-1]) if got.lengths.size else []
    assert list(zip([x.tolist() for x in pieces], got.weights.tolist())) == [x for x in want if len(x[0]) > 1]


def test_sums_beyond_float_precision_are_exact():
    big = (1 << 53) + 1
    keys, sums = K.sum_by_key(np.array([1 << 32 | 2, 1 << 32 | 2, 3 << 32 | 4]), np.array([big, 2, 5]))
    assert keys.tolist() == [1 << 32 | 2, 3 << 32 | 4] and sums.tolist() == [big + 2, 5]


@settings(max_examples=60, deadline=None)
@given(seqs_st)
def test_first_positions(seqs):
    schema = pa.schema([("sym", pa.string()), ("line", pa.int64()), ("pos", pa.int64())])
    texts = ["".join("abcd"[x] for x in s) for s in seqs]
    batch = pa.RecordBatch.from_pydict({"line": pa.array(range(len(texts)), pa.int64()), "seq": texts})
    got = {r["sym"]: (r["line"], r["pos"]) for b in K.first_positions([batch], ("line",), schema) for r in b.to_pylist()}
    want = {}
    for i, t in enumerate(texts):
        for j, c in enumerate(t):
            want.setdefault(c, (i, j))
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 5, 70_000, 3_000_000]), max_size=10), min_size=1, max_size=6))
def test_count_pairs_large_ids_sort_path(seqs):
    """Ids too far apart for the dense table take the sorting path; same counts."""
    expect = Counter()
    for s in seqs:
        for a, b in zip(s, s[1:]):
            expect[(a, b)] += 1
    assert counts_of(K.count_pairs([batch_of(seqs)])) == expect
