"""Training: goldens, the reference's determinism and specials tests, batched == one at a time."""

import importlib
import random

import pytest
from pyspark.sql import functions as F

from bpe_reference import train_reference
from subword_spark.operators.symbols import sequence_rows
from subword_spark.operators import blocks
from subword_spark.operators.train import choose_batch, train
from subword_spark.options import BPEOptions

train_module = importlib.import_module("subword_spark.operators.train")

MERGE_CORPUS = ["hello world", "hello there general kenobi", "world peace now", "byte pair encoding demo"]


def reference_for(df, opts):
    seqs = [list(r.seq) for r in sequence_rows(df, "line", opts).collect()]
    return train_reference(seqs, opts.specials, opts.target_vocabulary_size, opts.minimum_pair_frequency, opts.max_merges)


def test_merge_order_is_deterministic(lines_df):
    opts = BPEOptions(target_vocabulary_size=200, max_merges=10, progress_every=1000)
    df = lines_df(MERGE_CORPUS)
    a, b = train(df, "line", opts), train(df, "line", opts)
    assert a.merges == b.merges and len(a.merges) == 10


def test_special_tokens_are_not_merged(lines_df):
    opts = BPEOptions(target_vocabulary_size=200, max_merges=15)
    m = train(lines_df(MERGE_CORPUS), "line", opts)
    for left, right in m.merges:
        assert left not in opts.specials and right not in opts.specials


def test_special_spelled_by_corpus_is_never_created(lines_df):
    opts = BPEOptions(add_visible_space=False, max_merges=40, minimum_pair_frequency=1)
    m = train(lines_df(["<begin> <begin> <begin>"] * 3), "line", opts)
    assert all(l + r not in opts.specials for l, r in m.merges)


def test_all_occurrences_golden(lines_df):
    """Two lines `abxy`: merges (a,b), (x,y), (ab,xy), no repeats."""
    m = train(lines_df(["abxy", "abxy"]), "line", BPEOptions(minimum_pair_frequency=2))
    assert m.merges == [("a", "b"), ("x", "y"), ("ab", "xy")]
    assert m.counts == [2, 2, 2]


def test_overlap_golden(lines_df):
    """`aaa`: pair (a,a) counts 2 and merges left to right to `aa a`."""
    m = train(lines_df(["aaa"]), "line", BPEOptions(minimum_pair_frequency=1, max_merges=1))
    assert m.merges == [("a", "a")] and m.counts == [2]
    m2 = train(lines_df(["aaa"]), "line", BPEOptions(minimum_pair_frequency=1, max_merges=2))
    assert m2.merges == [("a", "a"), ("aa", "a")]


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "line_no int, line string")
    m = train(df, "line", BPEOptions())
    assert m.tokens == list(BPEOptions().specials) and m.merges == []


def test_stop_rules(lines_df):
    df = lines_df(MERGE_CORPUS * 3)
    assert train(df, "line", BPEOptions(max_merges=0)).merges == []
    start = len(train(df, "line", BPEOptions(max_merges=0)))
    m = train(df, "line", BPEOptions(target_vocabulary_size=start + 9))
    assert len(m) == start + 9 and len(m.merges) >= 9
    m = train(df, "line", BPEOptions(minimum_pair_frequency=7))
    assert all(c >= 7 for c in m.counts)


def test_lowercase_nfc_normalised_once(lines_df):
    """H+U+0331 etc. are not NFC+lower idempotent; normalising once keeps them known."""
    from subword_spark.operators.encode import encode

    text = "H̱ T̈ W̊ Y̊ J̌"
    df = lines_df([text])
    m = train(df, "line", BPEOptions(lowercase=True, minimum_pair_frequency=1))
    row = encode(df, "line", m, unknown_col="unk").first()
    assert row.unk == 0


@pytest.mark.parametrize("unit", ["word", "line"])
def test_matches_brute_force_on_documents(spark, unit):
    from subword_spark.sources.corpus import corpus_lines, read_table

    docs = read_table(spark, "/root/testdata/sf0.001", "documents").where(F.col("doc_id") < 40)
    lines = corpus_lines(docs)
    opts = BPEOptions(unit=unit, max_merges=40)
    m = train(lines, "line", opts)
    tokens, merges, counts = reference_for(lines, opts)
    assert m.merges == merges and m.counts == counts and m.tokens == tokens


def test_batched_equals_one_at_a_time_random(lines_df):
    rng = random.Random(7)
    for trial in range(6):
        alphabet = "abcab d"[: rng.randint(3, 7)]
        lines = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(3, 12))]
        opts = BPEOptions(minimum_pair_frequency=1, max_merges=25, add_visible_space=bool(trial % 2))
        df = lines_df(lines)
        fast = train(df, "line", opts)
        slow = train(df, "line", opts, max_batch=1)
        tokens, merges, counts = reference_for(df, opts)
        assert fast.merges == slow.merges == merges, lines
        assert fast.counts == counts


def test_batched_equals_one_at_a_time_with_specials(lines_df):
    """Specials that the corpus spells: a pair that is never merged can still turn into one
    that comes next."""
    df = lines_df(["abc"] * 100 + ["ab"] * 10 + ["de"] * 90)
    opts = BPEOptions(specials=("<unknown>", "bc"), minimum_pair_frequency=1)
    fast, slow = train(df, "line", opts), train(df, "line", opts, max_batch=1)
    assert fast.merges == slow.merges == [("a", "b"), ("ab", "c"), ("d", "e")]
    rng = random.Random(13)
    for _ in range(6):
        lines = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 10))) for _ in range(10)]
        specials = ("<unknown>", *{"".join(rng.choice("abcd") for _ in range(rng.randint(2, 3))) for _ in range(4)})
        opts = BPEOptions(specials=specials, minimum_pair_frequency=1, max_merges=20)
        df = lines_df(lines)
        tokens, merges, counts = reference_for(df, opts)
        m = train(df, "line", opts)
        assert (m.tokens, m.merges, m.counts) == (tokens, merges, counts), (lines, specials)


def test_counts_stay_exact_over_many_rounds(lines_df):
    """Counts kept by changes alone equal full counts at every round, across checkpoints."""
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcde ") for _ in range(40)) for _ in range(20)]
    opts = BPEOptions(minimum_pair_frequency=2)
    df = lines_df(lines)
    tokens, merges, counts = reference_for(df, opts)
    m = train(df, "line", opts)
    assert (m.tokens, m.merges, m.counts) == (tokens, merges, counts) and m.rounds > 10


@pytest.mark.parametrize("cuts, held", [(True, 1 << 18), (False, 8), (True, 30)])
def test_cuts_and_held_pairs_do_not_change_results(lines_df, monkeypatch, cuts, held):
    """Sequences cut at rare pairs, and only a few pairs on the driver: same merges, counts."""
    monkeypatch.setattr(train_module, "CUT_SYMBOLS", 0 if cuts else 1 << 30)
    monkeypatch.setattr(train_module, "CUT_SHARE", 0.02)
    monkeypatch.setattr(train_module, "HOT", held)
    rng = random.Random(17)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(15)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 10))) for _ in range(12)] + ["aaaa baaab aaaaaaa"] * 3
    opts = BPEOptions(minimum_pair_frequency=3)
    df = lines_df(lines)
    tokens, merges, counts = reference_for(df, opts)
    m = train(df, "line", opts.with_(batch_candidates=2) if held == 8 else opts)
    assert (m.tokens, m.merges, m.counts) == (tokens, merges, counts)
    steps = [t["step"] for t in m.trace]
    assert "cut" in steps if held > 100 else "count" in steps


def test_second_way_to_a_token_replays(lines_df, monkeypatch):
    """A pick of a token that exists, after sequences were cut: the state is made anew from the
    first blocks. (Such picks are very rare; here one is made out of an ordinary pick.)"""
    monkeypatch.setattr(train_module, "CUT_SYMBOLS", 0)
    monkeypatch.setattr(train_module, "CUT_SHARE", 0.0)
    calls = []

    def again(top, tokens, index, *rest):
        picks = choose_batch(top, tokens, index, *rest)
        calls.append(1)
        if len(calls) == 3:
            picks = picks[:1]
            index[picks[0].token] = len(tokens)
            tokens.append(picks[0].token)
            picks[0].new = False
        return picks

    monkeypatch.setattr(train_module, "choose_batch", again)
    rng = random.Random(23)
    lines = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 14))) for _ in range(14)] + [f"x{i}y{i}" for i in "defghi"]
    opts = BPEOptions(minimum_pair_frequency=2)
    df = lines_df(lines)
    tokens, merges, counts = reference_for(df, opts)
    m = train(df, "line", opts)
    assert (m.tokens, m.merges, m.counts) == (tokens, merges, counts)
    steps = [t["step"] for t in m.trace]
    assert "cut" in steps[: steps.index("replay")] and "merge" in steps[steps.index("replay") :]


def test_rounds_read_the_blocks_of_their_pairs(spark, monkeypatch):
    """Frequent pairs are in all buckets; at the end a round reads few of them."""
    def small(batches, **k):
        from subword_spark.operators import blocks as here  # the worker's

        here.BLOCK_SYMBOLS = 300
        return here.pack_text(batches, **k)

    monkeypatch.setattr(blocks, "pack_text", small)
    rng = random.Random(3)
    words = ["th" + "".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(250)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words) for _ in range(2)], "line_no int, line string")
    m = train(df, "line", BPEOptions(minimum_pair_frequency=5, max_merges=40, batch_candidates=8))
    merges = [t for t in m.trace if t["step"] == "merge"]
    assert merges[0]["buckets_read"] == merges[0]["buckets"] > 4 and merges[0]["symbols_read"] == merges[0]["symbols"]
    assert min(t["symbols_read"] / t["symbols"] for t in merges) < 0.8
    tokens, want, counts = reference_for(df, m.options)
    assert (m.merges, m.counts) == (want, counts)


def test_choose_batch_conflicts():
    tokens = ["<u>", "a", "b", "c", "d"]
    index = {t: i for i, t in enumerate(tokens)}
    top = [(1, 2, 10), (3, 4, 9), (2, 3, 8), (1, 1, 7)]
    picks = choose_batch(top, tokens, index, 10, 10, set())
    assert [(p.l, p.r) for p in picks] == [(1, 2), (3, 4)]  # (b, c) touches both picks
    picks = choose_batch([(1, 1, 5), (2, 3, 4)], tokens, index, 10, 10, set())
    assert [(p.l, p.r) for p in picks] == [(1, 1)]  # self pair ends the batch


def test_first_seen_tie_break(lines_df):
    """The reference test corpus is full of ties: first-seen order decides them."""
    opts = BPEOptions(target_vocabulary_size=200, max_merges=15, tie_break="first_seen", minimum_pair_frequency=1)
    df = lines_df(MERGE_CORPUS)
    m = train(df, "line", opts, order_by=("line_no",))
    seqs = [list(r.seq) for r in sequence_rows(df.orderBy("line_no"), "line", opts).collect()]
    tokens, merges, counts = train_reference(seqs, opts.specials, 200, 1, 15, first_seen=True)
    assert m.merges == merges and m.counts == counts
    by_id = train(df, "line", opts.with_(tie_break="vocab"))
    assert by_id.merges != m.merges  # the two rules really differ here


def test_first_seen_batched_equals_one_at_a_time(lines_df):
    rng = random.Random(11)
    for _ in range(4):
        lines = ["".join(rng.choice("dcba ") for _ in range(rng.randint(2, 12))) for _ in range(8)]
        opts = BPEOptions(minimum_pair_frequency=1, max_merges=20, tie_break="first_seen")
        df = lines_df(lines)
        fast = train(df, "line", opts, order_by=("line_no",))
        slow = train(df, "line", opts, max_batch=1, order_by=("line_no",))
        seqs = [list(r.seq) for r in sequence_rows(df.orderBy("line_no"), "line", opts).collect()]
        _, merges, _ = train_reference(seqs, opts.specials, opts.target_vocabulary_size, 1, 20, first_seen=True)
        assert fast.merges == slow.merges == merges, lines


def test_first_places_are_packed(spark):
    """Order columns as one number: sorts as they do, and the least of it is a hash aggregate."""
    rows = [(2**63 - 1, 2**31 - 1, 5), (-(2**63), -(2**31), 2**30 - 1), (None, 7, 0), (3, None, 1), (3, -1, 4), (3, -1, 3), (2, 2**31 - 1, 9), (-1, 0, 0)]
    df = spark.createDataFrame(rows, "a bigint, b int, pos bigint")
    place = train_module.packed_place([("a", "bigint"), ("b", "int")])
    got = [tuple(r)[:3] for r in df.withColumn("p", place).orderBy("p").collect()]
    assert got == [tuple(r) for r in df.orderBy("a", "b", "pos").collect()]
    plan = df.groupBy("b").agg(F.min(place).alias("at"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert train_module.packed_place([("a", "bigint"), ("b", "bigint")]) is None and train_module.packed_place([("a", "string")]) is None
