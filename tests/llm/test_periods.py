"""Periodic runs against brute force."""

from itertools import product

import numpy as np
import pyarrow as pa

from subword_spark.llm.period_runs import find_runs, period_runs
from subword_spark.llm.words import split_words, word_numbers


def brute(words, exponent=4, shortest=6):
    """Runs of one text as (start, end, period), by the definition."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, exponent * q) and (i, j + q) not in seen:
                seen.add((i, j + q))  # a smaller period has been here before
                out.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(texts):
    w = split_words(pa.array(texts))
    got = find_runs(word_numbers(w)[0], w.first)
    of = np.searchsorted(w.first, got[:, 0], "right") - 1
    return [[(int(a - w.first[i]), int(b - w.first[i]), int(q)) for a, b, q in got[of == i]] for i in range(len(texts))]


def check(lists):
    texts = [" ".join(map(str, x)) for x in lists]
    for got, x in zip(runs_of(texts), lists):
        assert got == brute(x), x


def test_all_short_texts_of_two_words():
    check([list(x) for n in range(0, 13) for x in product("ab", repeat=n)])


def test_random_periodic_texts():
    rng = np.random.default_rng(1)
    lists = []
    for _ in range(1500):
        x = []
        for _ in range(int(rng.integers(1, 6))):
            root = rng.integers(0, int(rng.integers(1, 6)), int(rng.integers(1, 45))).tolist()
            x += (root * int(rng.integers(1, 9)))[: int(rng.integers(1, 260))]
        for _ in range(int(rng.integers(0, 3))):
            x[int(rng.integers(0, len(x)))] = 9
        lists.append(x)
    check(lists)


def test_nested_and_long_periods():
    rng = np.random.default_rng(2)
    inner = [1] * 40 + [2]
    fib, before = [1, 2], [1]
    while len(fib) < 800:
        fib, before = fib + before, fib
    check(
        [
            inner * 5,
            (inner * 4 + [3]) * 5,
            fib,
            fib[:300] * 5,
            [1] * 3000,
            [1, 2] * 1000 + [3] + [1, 2] * 1000,
            rng.integers(0, 50, 513).tolist() * 4,
            rng.integers(0, 50, 512).tolist() * 4,
            rng.integers(0, 50, 511).tolist() * 4 + [99],
            rng.integers(0, 2, 3000).tolist(),
        ]
    )


def test_large_run_is_quick():
    rng = np.random.default_rng(3)
    root = rng.integers(0, 1000, 12).tolist()
    texts = [" ".join(map(str, root * 40_000)), " ".join(["x"] * 500_000), " ".join(map(str, rng.integers(0, 9, 50_000).tolist() * 8))]
    assert [r[0] for r in runs_of(texts) if r][:2] == [(0, 480_000, 12), (0, 500_000, 1)]
    assert (0, 400_000, 50_000) in runs_of(texts[2:])[0]


def test_operator(spark):
    words = lambda n: [chr(97 + i) * 3 for i in range(n)]
    rows = [
        (1, "\t ".join(words(3) * 5), "x"),
        (2, None, "y"),
        (2, "", None),
        (None, " ".join(["z"] * 6), "a"),
        (3, " ".join(words(26)), "b"),
        (1, "\t ".join(words(3) * 5), "x"),
        (4, " ".join(["é"] * 5), "c"),
    ]
    docs = spark.createDataFrame([(a, b, c, 1, 2) for a, b, c in rows], "doc_id long, text string, id string, runs int, collapsed int")
    got = sorted((str(r.id), r.n_words, [tuple(x) for x in r.runs], r.n_dropped, r.collapsed, r.row.id or "") for r in period_runs(docs, row=True).collect())
    three = ("1", 15, [(0, 15, 3)], 12, "aaa bbb ccc", "x")
    assert got == sorted(
        [three, three, ("2", 0, [], 0, "", "y"), ("2", 0, [], 0, "", ""), ("None", 6, [(0, 6, 1)], 5, "z", "a"), ("3", 26, [], 0, " ".join(words(26)), "b"), ("4", 5, [], 0, "é é é é é", "c")]
    )
    assert period_runs(docs.limit(0)).count() == 0
