"""Packing: plans against brute force bounds, ids against the library, whole results."""

import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from subword_spark.llm import common
from subword_spark.llm.best_fit_packing import Places, Sums, pack, plan
from subword_spark.llm.piece_ids import PieceIds

PATH = public_tokenizers.path("word_bpe_49k.json")


def histogram(lengths, capacity):
    return np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for g in sorted(set(gaps)):
            if g >= lengths[i]:
                rest = list(gaps)
                rest.remove(g)
                go(i + 1, [*rest, g - lengths[i]])
        go(i + 1, [*gaps, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_plan_uses_each_piece_once_and_few_sequences():
    rng = np.random.default_rng(0)
    extra = 0
    for _ in range(150):
        capacity = int(rng.integers(4, 30))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 10))).tolist()
        found = plan(histogram(lengths, capacity), capacity)
        used = sorted(x for p, n in found for x in p * n)
        assert used == sorted(lengths) and all(0 < sum(p) <= capacity and n > 0 for p, n in found)
        extra += sum(n for _, n in found) - fewest(lengths, capacity)
    assert extra <= 3


def test_large_plans_are_near_the_lower_bound():
    rng = np.random.default_rng(1)
    for lengths in (np.minimum(rng.geometric(1 / 300, 50_000), 2048), rng.integers(1, 2049, 20_000), np.full(9999, 683), np.full(5000, 2048)):
        found = plan(histogram(lengths, 2048), 2048)
        least = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()), -(-int((lengths > 682).sum()) // 2))
        assert sum(n for _, n in found) <= least * 1.01 + 1
        assert len(found) < 6000


def test_fill_finds_a_combination_if_there_is_one():
    rng = np.random.default_rng(2)
    for _ in range(300):
        size = int(rng.integers(5, 14))
        counts = rng.integers(0, 3, size) * (rng.random(size) < 0.4)
        counts[0] = 0
        sums = Sums(counts)
        gap = int(rng.integers(1, 3 * size))
        ways = [c for k in (1, 2, 3) for c in combinations_with_replacement(range(1, size), k) if sum(c) == gap and all(counts[x] >= c.count(x) for x in c)]
        got = sums.fill(gap, 3, sums.pair_sums())
        assert (got is None) == (not ways) and (got is None or tuple(sorted(got)) in ways)
        assert (sums.left == counts).all()


def test_places_are_a_bijection():
    lengths = np.repeat([5, 3, 2, 8, 1], [7, 9, 4, 2, 6])
    places = Places(plan(histogram(lengths, 8), 8), 8)
    number = np.concatenate([np.arange(n) for n in (7, 9, 4, 2, 6)])
    sequence, offset = places.find(lengths, number)
    check_places(sequence, offset, lengths, 8)
    assert set(sequence) == set(range(places.n_sequences))


def check_places(sequence, offset, length, capacity):
    by = np.lexsort((offset, sequence))
    s, o, n = sequence[by], offset[by], length[by]
    new = np.r_[True, s[1:] != s[:-1]]
    assert (o[new] == 0).all() and (o[1:][~new[1:]] == (o + n)[:-1][~new[1:]]).all()
    assert (o + n <= capacity).all()


def test_ids_equal_the_library():
    rng = np.random.default_rng(3)
    atoms = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "\n", "a", "é", "1", "²", "-", "!", "<|endoftext|>", "<", " ", "\x85", "İ", "ß", "中", "́", "A", "\x1c", "ª", "½", "_", "Straße", "naïve", "😀"]
    texts = ["".join(rng.choice(atoms, int(rng.integers(0, 25)))) for _ in range(4000)] + ["", None, "x" * 5000, "' 's' 'll'd'' 've"]
    whole = Tokenizer.from_file(PATH)
    ids, counts = PieceIds(open(PATH).read()).encode(pa.array(texts))
    for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == whole.encode(t or "", add_special_tokens=False).ids, t


def test_pack(spark):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "Zeta's", "é", "42"]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 60, 300)] + [None, "", "word " * 500, "word " * 500]
    rows = [(i % 250 if i % 50 else None, t, i, 0, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, length int, part string").repartition(5)
    whole = Tokenizer.from_file(PATH)
    want = []
    for key, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            raw = np.array(ids[k : k + 64], "<u4").tobytes()
            want.append((key, k // 64, k, len(raw) // 4, zlib.crc32(raw), raw))
    got = pack(docs, PATH, capacity=64, ids=True).toPandas()
    have = [(None if r.id != r.id else int(r.id), r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got.itertuples()]
    assert sorted(have, key=str) == sorted(want, key=str)
    check_places(got.sequence_id.to_numpy(), got.offset.to_numpy(), got.length.to_numpy(), 64)
    n = int(got.sequence_id.nunique())
    assert got.sequence_id.max() == n - 1 and n <= -(-int(got.length.sum()) // 64) * 1.02 + 1
    assert pack(docs.limit(0), PATH).count() == 0
    assert pack(docs.limit(0), PATH, capacity=1, ids=True).count() == 0
    common.release()
