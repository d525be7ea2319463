"""Encode and decode: reference round-trip cases, scan vs rank, unknowns, bad ids and bytes."""

import pytest
from pyspark.sql import functions as F

from bpe_reference import rank_encode, scan_encode
from subword_spark.operators.decode import decode, decode_column
from subword_spark.operators.encode import Encoder, encode
from subword_spark.operators.model import BPEModel
from subword_spark.options import BPEOptions

ROUNDTRIP = ["Hello world", "Hello, world!!! How are you?", "😀 😃 😄 😁 😂 🤣", "Привет мир", "こんにちは 世界", "", "a"]


def byte_model(merges=()):
    opts = BPEOptions(model_kind="byte_bpe", add_visible_space=False)
    tokens = list(opts.specials) + [chr(b) for b in range(256)]
    for l, r in merges:
        if l + r not in tokens:
            tokens.append(l + r)
    return BPEModel(options=opts, tokens=tokens, merges=list(merges), n_alphabet=256)


def test_byte_roundtrip_reference_cases(lines_df):
    m = byte_model()
    rows = decode(encode(lines_df(ROUNDTRIP), "line", m), "ids", m).collect()
    for r in rows:
        assert r.decoded == r.line
        assert len(r.ids) == len(r.line.encode("utf-8"))


def test_scan_and_rank_golden():
    """Merges (b,c) rank 0, (a,b) rank 1, text abc: scan gives ab c, rank gives a bc."""
    tokens = ["<unknown>", "a", "b", "c", "bc", "ab"]
    table = [(2, 3, 4), (1, 2, 5)]
    scan = Encoder(tokens, table, 0, "scan")
    rank = Encoder(tokens, table, 0, "rank")
    assert scan.encode_symbols("abc")[0] == [5, 3]
    assert rank.encode_symbols("abc")[0] == [1, 4]


def test_encoder_agrees_with_reference_algorithms():
    import random

    rng = random.Random(3)
    for _ in range(300):
        alpha = "abcd"
        merges = []
        toks = list(alpha)
        for _ in range(rng.randint(1, 8)):
            l, r = rng.choice(toks), rng.choice(toks)
            merges.append((l, r))
            if l + r not in toks:
                toks.append(l + r)
        tokens = ["<unknown>"] + toks
        m = BPEModel(options=BPEOptions(), tokens=tokens, merges=merges)
        text = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 12)))
        s = Encoder(tokens, m.merge_table(), 0, "scan").encode_symbols(text)[0]
        k = Encoder(tokens, m.merge_table(), 0, "rank").encode_symbols(text)[0]
        assert [tokens[i] for i in s] == scan_encode(list(text), set(merges))
        assert [tokens[i] for i in k] == rank_encode(list(text), merges)


def test_unknown_and_strict(spark, lines_df):
    opts = BPEOptions(model_kind="byte_bpe", add_visible_space=False)
    tokens = list(opts.specials) + [chr(b) for b in range(128)]
    m = BPEModel(options=opts, tokens=tokens, merges=[], n_alphabet=128)
    row = encode(lines_df(["é"]), "line", m, unknown_col="unk").first()
    assert row.ids == [0, 0] and row.unk == 2
    with pytest.raises(Exception):
        encode(lines_df(["é"]), "line", m, strict=True).collect()


def test_bad_ids_and_bad_utf8(spark):
    m = byte_model()
    for bad in ([-1], [len(m)]):
        df = spark.createDataFrame([(bad,)], "ids array<int>")
        with pytest.raises(Exception):
            df.select(decode_column(F.col("ids"), m)).collect()
    df = spark.createDataFrame([([m.token_to_id[chr(0xFF)]],)], "ids array<int>")
    with pytest.raises(Exception, match="INVALID_UTF8"):
        df.select(decode_column(F.col("ids"), m)).collect()
    assert df.select(decode_column(F.col("ids"), m, strict=False).alias("d")).first().d is None


def test_word_unit_roundtrip(spark, lines_df):
    from subword_spark.operators.metrics import roundtrip_report
    from subword_spark.operators.train import train

    df = lines_df(["the cat, the hat.", "a cat  sat", ", leading", "", "_mark _ed"])
    m = train(df, "line", BPEOptions(unit="word", minimum_pair_frequency=1, max_merges=10))
    rows = {r.line: r.decoded for r in decode(encode(df, "line", m), "ids", m).collect()}
    assert [rows[t] for t in ("the cat, the hat.", "a cat  sat", ", leading", "")] == ["the cat, the hat.", "a cat sat", ", leading", ""]
    report = roundtrip_report(df, "line", m).first()
    assert (report.n_lines, report.n_skipped, report.n_mismatched, report.accuracy) == (5, 0, 0, 1.0)


def test_word_unit_needs_markers():
    with pytest.raises(ValueError):
        BPEOptions(unit="word", add_visible_space=False)


def test_decode_behind_a_pruned_repartition(spark):
    """Every row gets its own text, with null, empty and bad ids, however rows are dealt."""
    m = byte_model()
    known = m.token_to_id
    rows = [(i, None if i % 7 == 0 else [] if i % 7 == 1 else [known[c] for c in f"text {i}"], "pad" * i) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, ids array<int>, pad string").repartition(8)
    got = {r.i: r.decoded for r in decode(df, "ids", m).select("i", "decoded").collect()}
    assert got == {i: None if ids is None else f"text {i}" if ids else "" for i, ids, _ in rows}
    bad = df.withColumn("ids", F.when(F.col("i") % 5 == 0, F.array(F.lit(-1))).when(F.col("i") % 5 == 1, F.array(F.lit(None).cast("int"))).otherwise(F.col("ids")))
    lenient = {r.i: r.decoded for r in decode(bad, "ids", m, strict=False).select("i", "decoded").collect()}
    assert lenient == {i: None if i % 5 < 2 else got[i] for i in got}
    with pytest.raises(Exception, match="no token has the id"):
        decode(bad, "ids", m).select("decoded").collect()


@pytest.mark.parametrize("words", [True, False])
def test_batch_encode_equals_per_row(words, monkeypatch):
    import random

    from subword_spark.operators import encode as E

    tokens = ["<unknown>", "_", "a", "b", "c", "ab", "abc"]
    table = [(2, 3, 5), (5, 4, 6)]
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcx_") for _ in range(rng.randint(1, 5)))
    rows = [None if rng.random() < 0.1 else [word() for _ in range(rng.randint(0, 6))] if words else word() for _ in range(200)]
    enc = Encoder(tokens, table, 0, "scan")
    for limit in (1 << 22, 10, 1):
        monkeypatch.setattr(E, "MAX_SLICE_CHARS", limit)
        ids, miss = enc.encode_batch(rows, words)
        for r, i, m in zip(rows, ids, miss, strict=True):
            if r is None:
                assert i is None and m is None
                continue
            parts = [enc.encode_symbols(w) for w in (r if words else [r])]
            assert list(i) == [t for p, _ in parts for t in p] and m == sum(n for _, n in parts)


@pytest.mark.parametrize("order", ["scan", "rank"])
def test_many_sequences_side_by_side_equal_one_by_one(order):
    """Random merge tables, with pairs that make a token again, private ids and self pairs."""
    import random

    rng = random.Random(3)
    for _ in range(60):
        tokens = ["<unknown>"] + [chr(97 + i) for i in range(rng.randint(3, 8))]
        table = []
        for _ in range(rng.randint(1, 12)):
            a = rng.randrange(1, len(tokens))
            b = a if rng.random() < 0.3 else rng.randrange(1, len(tokens))
            s = tokens[a] + tokens[b]
            if s not in tokens and rng.random() < 0.85:
                tokens.append(s)
            table.append((a, b, tokens.index(s) if s in tokens else 100))
        word = lambda: "".join(rng.choice("aaabcdefghz") for _ in range(rng.choice([0, 1, 2, 6, 9, 150 if rng.random() < 0.05 else 5])))
        rows = [None if rng.random() < 0.05 else [word() for _ in range(rng.randint(0, 5))] for _ in range(rng.choice([4, 90]))]
        enc = Encoder(tokens, table, 0, order)
        for r, i, m in zip(rows, *enc.encode_batch(rows, True), strict=True):
            parts = [enc.encode_symbols(w) for w in r or []]
            assert r is None and i is None and m is None or (list(i), m) == ([t for p, _ in parts for t in p], sum(n for _, n in parts))


def test_a_batch_of_words_is_encoded_without_an_object_for_each():
    """What Python holds beside the Arrow batch is bounded by its numbers, not by word objects."""
    import tracemalloc

    import pyarrow as pa

    rows = pa.array([["_", "ab", "abc"] * 100] * 10_000, pa.list_(pa.string()))
    enc = Encoder(["<unknown>", "_", "a", "b", "c", "ab"], [(2, 3, 5)], 0, "scan")
    tracemalloc.start()
    out = enc.encode_rows(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.field("ids")[9_999].as_py() == [1, 5, 5, 4] * 100 and peak < 40 * 3_000_000


def test_decode_by_slices_equals_whole_batches(monkeypatch):
    """Slices of any size give each row its text; a batch of many ids is not held in numbers."""
    import tracemalloc

    import pyarrow as pa

    from subword_spark.operators import decode as D

    rows = [None if i % 7 == 0 else [] if i % 7 == 1 else [-1] if i % 7 == 2 else [i % 3] * (i % 50) for i in range(300)]
    want = [None if r is None or -1 in r else b"".join([b"a", b"bc", b""][x] for x in r) for r in rows]
    for limit in (1 << 20, 60, 1):
        monkeypatch.setattr(D, "SLICE_IDS", limit)
        assert D._gather([b"a", b"bc", b""], False).func(pa.array(rows, pa.list_(pa.int32()))).to_pylist() == want
    monkeypatch.setattr(D, "SLICE_IDS", 1 << 20)
    many = pa.array([[0, 1, 0, 1] * 250] * 10_000, pa.list_(pa.int32()))
    tracemalloc.start()
    out = D._gather([b"a", b"bc"], True).func(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[9_999].as_py() == b"abc" * 500 and peak < 15 * 10_000_000
