"""Words of raw texts in Arrow batches, their count, and what a slice or a block takes."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from subword_spark.functions import text as T
from subword_spark.operators import encode as E
from subword_spark.operators import kernels
from subword_spark.operators.blocks import Block
from subword_spark.operators.encode import Encoder
from subword_spark.options import BPEOptions
from test_text import py_word_tokens

WORD = BPEOptions(unit="word")


def random_texts(n: int, seed: int) -> list[str | None]:
    rng = random.Random(seed)
    some = "ab_1é²\u00bd\u02b0\u02ff.,$ \t\n\r\x0b\x1c\x1f\x85\xa0\x00\xad"
    return [None if rng.random() < 0.1 else "".join(rng.choices(some, k=rng.randrange(12))) for _ in range(n)]


def test_words_of_simple_texts_are_the_reference_ones():
    texts = [*random_texts(3_000, 1), "", " ", "\n\n", None, "a", "_", " _ ", "x" * 5_000]
    for marker in ("_", "a", "é", " "):
        opts = WORD.with_(marker=marker)
        for part in (pa.array(texts, pa.string()), pa.array(["zz", *texts], pa.string()).slice(1)):
            seqs, at = kernels.split_words(part, marker)
            words = seqs.to_pylist()
            for t, lo, hi in zip(texts, at, at[1:]):
                assert words[lo:hi] == ([] if t is None else py_word_tokens(t, opts) if marker == "_" else words[lo:hi]), (t, marker)
                assert t is None or hi > lo and words[lo] == marker


def test_split_in_batches_is_the_native_split(spark):
    """Also for markers that are letters, and for texts beyond the simple ones."""
    from subword_spark.operators.symbols import weighted_sequences, word_sequences

    texts = [*random_texts(400, 2), "e\u0301 x", "\u4f60 \u597d  a\u3000b", "a\u2003b_", "\u03b1\u03b2 \U0001f600", None]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    for marker in ("_", "a", "$", " "):
        opts = WORD.with_(marker=marker)
        native = Counter(w for r in df.select(word_sequences(df.line, opts).alias("w")).collect() for w in r.w or [])
        got = weighted_sequences(df, "line", opts)
        assert got.dtypes == [("seq", "string"), ("weight", "bigint")] and {r.seq: r.weight for r in got.collect()} == native
        simple = [t for t in texts if t is not None and max(t, default="") < "\u0300"]
        split = Counter(kernels.split_words(pa.array(simple), marker)[0].to_pylist())
        assert split == Counter(w for r in df.where(df.line.isin(simple)).select(word_sequences(df.line, opts).alias("w")).collect() for w in r.w)


def test_white_space_is_collapsed_natively_as_by_the_regex(spark):
    import re

    texts = [t for t in random_texts(500, 3) if t is not None] + ["a\u3000 b", " " * 9 + "a" + " " * 9 + "b", "a\r\n\tb", "\u2028"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", T.collapse_whitespace(df.t).alias("c"), T.char_sequence_string(T.normalize(df.t, WORD), WORD).alias("m")).collect():
        assert r.c == re.sub(r"\s+", " ", r.t).strip(" ")
        assert r.m == re.sub("_+", "_", r.c.replace(" ", "_")).strip("_")


def test_words_are_counted_in_the_batch(monkeypatch):
    """Before rows leave a task: one row per distinct word, and of bounded steps."""
    texts = [None, "a b a", "", "b c"] * 50
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "words": pa.array([["_", "z"], None, None, None] * 50, pa.list_(pa.string()))})] * 3
    want = Counter()
    for w in (["_", "z"], ["_", "a", "_", "b", "_", "a"], ["_"], ["_", "b", "_", "c"]):
        want.update(w * 150)
    for size, most in ((1 << 22, 1 << 18), (10, 3), (1, 1)):
        monkeypatch.setattr(kernels, "COUNT_BYTES", size)
        monkeypatch.setattr(kernels, "COUNT_WORDS", most)
        got = Counter()
        rows = list(kernels.count_words(iter(batches), "_"))
        for b in rows:
            got.update(dict(zip(b["seq"].to_pylist(), b["weight"].to_pylist())))
        assert got == want
        assert size < 100 or [b.num_rows for b in rows] == [5]
    assert list(kernels.count_words(iter([]), "_")) == []


def test_encoded_texts_leave_slice_by_slice(monkeypatch):
    """Raw texts and words give the same ids in the order of the rows, and a slice is all that
    is held at a time."""
    enc = Encoder(["<unknown>", "_", "a", "b", "1", "ab"], [(2, 3, 5)], 0, "scan")
    texts = random_texts(500, 4) + ["ab ab", None]
    words = [None if t is None else py_word_tokens(t, WORD) for t in texts]
    want = enc.encode_rows(pa.array(words, pa.list_(pa.string()))).to_pylist()
    hard = [t is not None and i % 5 == 0 for i, t in enumerate(texts)]
    for limit in (1 << 21, 64, 1):
        monkeypatch.setattr(E, "MAX_SLICE_CHARS", limit)
        for some in (hard, [False] * len(texts)):
            raw = pa.array([None if h else t for t, h in zip(texts, some)], pa.string())
            other = pa.array([w if h else None for w, h in zip(words, some)], pa.list_(pa.string()))
            parts = list(enc.encode_texts(raw, other, "_"))
            assert [x for p in parts for x in p.to_pylist()] == want
            assert limit > 64 or len(parts) > 20
        parts = list(enc.encode_parts(pa.array(words, pa.list_(pa.string()))))
        assert [x for p in parts for x in p.to_pylist()] == want and (limit > 64 or len(parts) > 20)


def test_a_block_is_written_in_as_few_bytes_as_its_numbers_take():
    for top, weight in ((250, 1), (60_000, 300), (70_000, 1 << 40)):
        block = Block(np.array([0, top, 3, 2], np.int32), np.array([3, 1], np.int32), np.array([1, weight]))
        row = block.row(7, np.zeros(0, np.int64), np.zeros(0, np.int64))
        assert len(row["ids"][0].as_py()) == 4 * (1 if top < 256 else 2 if top < 65536 else 4)
        [(bucket, back)] = Block.rows([row])
        assert bucket == 7 and all((a == b).all() and a.dtype == b.dtype for a, b in zip((back.ids, back.lengths), (block.ids, block.lengths)))
        assert back.weights.tolist() == [1, weight]
    empty = Block(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64))
    [(_, back)] = Block.rows([empty.row(1, np.zeros(0, np.int64), np.zeros(0, np.int64))])
    assert back.ids.size == back.lengths.size == back.weights.size == 0


def test_blocks_of_a_task_share_a_bucket(monkeypatch):
    """So that a round writes a file per task and not one per block; a large task has several."""
    from subword_spark.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK_SYMBOLS", 8)
    batch = pa.RecordBatch.from_pydict({"seq": pa.array([np.arange(6, dtype=np.int32).tobytes()] * 40, pa.binary()), "weight": pa.array([1] * 40)})
    rows = list(blocks.pack_ids(iter([batch])))
    assert len(rows) == 40 and len({r["bucket"][0].as_py() for r in rows}) == 3
    assert len({r["bucket"][0].as_py() for r in rows[:16]}) == 1
