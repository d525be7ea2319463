"""Word kernels and shared helpers."""

import numpy as np
import pyarrow as pa

from subword_spark.llm import common
from subword_spark.llm.words import slices, split_words, window_hashes, word_hashes, word_numbers

TEXTS = ["a b  c", None, "", "  x\ty", "z", "a b c d", "é ü\x0bé", "x" * 3_000_000]


def test_words_are_those_of_bytes_split():
    w = split_words(pa.array(TEXTS))
    for i, t in enumerate(TEXTS):
        got = [w.data[a:b].tobytes() for a, b in zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]])]
        assert got == (t or "").encode().split()


def test_hashes_depend_on_the_words_alone():
    w = split_words(pa.array(TEXTS))
    h = word_hashes(w, 1)[0]
    by_word = {}
    for a, b, x in zip(w.starts, w.ends, h):
        by_word.setdefault(w.data[a:b].tobytes(), set()).add(int(x))
    assert all(len(x) == 1 for x in by_word.values())
    assert len({next(iter(x)) for x in by_word.values()}) == len(by_word)
    at, runs = window_hashes(h, w.first, 3, 2)
    assert at.tolist() == [0, 6, 7, 10] and runs[0] == runs[1] and len(set(runs.tolist())) == 3


def test_words_in_thue_morse_order_differ():
    """A word and its complement, on which polynomials modulo 2^64 agree."""
    a = b"".join(b"ab"[bin(i).count("1") % 2 :][:1] for i in range(1024)).decode()
    b = a.translate(str.maketrans("ab", "ba"))
    w = split_words(pa.array([f"{a} {b} {a}"]))
    assert word_numbers(w)[0].tolist() == [0, 1, 0]
    x, y, z = word_hashes(w, 1)[0].tolist()
    assert x == z != y


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["ab", None, "c" * 50, "", "d"])})
    parts = list(slices(batch, "text", 10))
    assert [t for p, texts in parts for t in texts.to_pylist()] == batch["text"].to_pylist() and len(parts) == 3
    assert all(p["text"] == texts for p, texts in parts)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
    common.release()
