"""Whole files and very long rows, encoded in pieces: the ids of the whole text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subword_spark.operators.encode import encode
from subword_spark.operators.encode_pieces import crossed_pairs, cut_sequence, encode_files, encode_long, token_positions
from subword_spark.operators.model import BPEModel
from subword_spark.options import BPEOptions
from subword_spark.sources.whole_text import read_text_parts

SPACES = [" ", "  ", "\n", "\t", " ", " _", "_ "]


def random_text(rng, n, letters="aabbé"):
    return "".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 7))) + rng.choice(SPACES) for _ in range(n))


def model_of(rng, opts, merges=25):
    """A model with random merges over few symbols, so that many merges cross words."""
    base = ["_", " ", "a", "b", "é", "\n", "\t"] if not opts.is_bytes else [chr(b) for b in range(256)]
    tokens, rules = [*opts.specials, *base], []
    usable = [t for t in base if len(t) == 1 and t in "_ab é\nÃ©"]
    while len(rules) < merges:
        l, r = rng.choice(usable), rng.choice(usable)
        if len(l + r) <= 6 and l + r not in tokens:
            rules.append((l, r))
            tokens.append(l + r)
            usable.append(l + r)
    return BPEModel(options=opts, tokens=tokens, merges=rules, n_alphabet=len(base))


OPTIONS = [BPEOptions(unit="word"), BPEOptions(unit="line"), BPEOptions(unit="line", add_visible_space=False), BPEOptions(model_kind="byte_bpe", add_visible_space=False)]


def test_cuts_are_where_no_merge_crosses():
    rng = random.Random(0)
    m = model_of(rng, OPTIONS[1])
    inner = {(l[-1], r[0]) for l, r in m.merges}
    for _ in range(50):
        seq = "".join(rng.choice("_abé") for _ in range(rng.randint(0, 80)))
        pieces = cut_sequence(seq, crossed_pairs(m), 7)
        assert "".join(pieces) == seq
        assert all((a[-1], b[0]) not in inner for a, b in zip(pieces, pieces[1:]))


@pytest.mark.parametrize("opts", OPTIONS, ids=["word", "line", "line-plain", "byte"])
def test_long_rows_are_stitched(spark, opts):
    rng = random.Random(1)
    m = model_of(rng, opts)
    rows = [(i % 5, random_text(rng, n)) for i, n in enumerate([0, 3, 60, 200, 90])] + [(9, None), (9, ""), (3, "ab" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit("x"))
    for order in ("scan", "rank"):
        want = sorted(((r.doc_id, r.text, r.uid, r.ids) for r in encode(df, "text", m, order=order).collect()), key=str)
        got = encode_long(df, "text", m, order=order, piece_chars=40)
        assert sorted(((r.doc_id, r.text, r.uid, r.ids) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("opts", OPTIONS, ids=["word", "line", "line-plain", "byte"])
def test_files_in_parts_equal_the_whole_text(spark, tmp_path, opts):
    rng = random.Random(2)
    m = model_of(rng, opts)
    texts = {f"f{i}.txt": random_text(rng, n) for i, n in enumerate([1, 30, 80])} | {"blank.txt": " \n\t " * 30, "late.txt": " " * 100 + "ab ba " * 9, "one.txt": "ab" * 100, "none.txt": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    parts = read_text_parts(spark, str(tmp_path), 37).collect()
    for name, text in texts.items():
        mine = sorted((r.start, r.text) for r in parts if r.file.endswith("/" + name))
        assert "".join(t for _, t in mine) == text and (len(mine) > 1 or len(text) < 80 or name == "one.txt")
    whole = spark.createDataFrame(list(texts.items()), "file string, text string")
    want = {r.file: r.ids for r in encode(whole, "text", m).collect() if r.ids}
    got = {}
    encoded = encode_files(spark, str(tmp_path), m, chunk_bytes=37).collect()
    for r in sorted(encoded, key=lambda r: (r.file, r.start, r.k)):
        got.setdefault(r.file.rpartition("/")[2], []).extend(r.ids)
    assert {k: v for k, v in got.items() if v} == want
    places = {}
    for ids in want.values():
        for i, t in enumerate(ids):
            n, total = places.get(t, (0, 0))
            places[t] = (n + 1, total + i)
    df = spark.createDataFrame(encoded, "file string, start long, k int, ids array<int>")
    assert {r.token_id: (r.n, r.sum_pos) for r in token_positions(df).collect()} == places


def test_large_single_row_is_many_pieces():
    text = "ab ba é " * 200_000
    m = model_of(random.Random(3), OPTIONS[1])
    pieces = cut_sequence(text.replace(" ", "_"), crossed_pairs(m), 100_000)
    assert len(pieces) >= 10 and max(map(len, pieces)) < 250_000 and np.sum([len(p) for p in pieces]) == len(text)


def test_pieces_travel_in_few_batches(monkeypatch):
    """Pieces of many rows share an Arrow batch, and hold the rows' words in their order."""
    import numpy as np
    import pyarrow as pa

    from subword_spark.operators import encode_pieces as P

    monkeypatch.setattr(P.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 1})())
    words = [[f"w{i}-{j}" for j in range(i % 7 + 1)] for i in range(1000)]
    lines = [["ab" * (i % 9 + 1)] for i in range(1000)]
    for seqs, crossed in ((words, None), (lines, np.zeros(0, np.int64))):
        batch = pa.RecordBatch.from_pydict({"row": pa.array([{"i": i} for i in range(1000)]), "seqs": pa.array(seqs, pa.list_(pa.string()))})
        out = list(P._cut_rows([batch], crossed, 8))
        got: dict = {}
        for r in pa.Table.from_batches(out).to_pylist():
            assert (r["row"] is not None) == (r["no"] == 0)
            got.setdefault(r["uid"], []).append((r["no"], r["seqs"]))
        join = (lambda s: s) if crossed is None else (lambda s: ["".join(s)])
        assert [join([x for _, p in sorted(got[u]) for x in p]) for u in sorted(got)] == seqs
        assert len(out) == 1 and any(len(p) > 1 for p in got.values())


def test_pieces_take_little_disk(spark, tmp_path, monkeypatch):
    """They are written once, without the texts of their rows and not through a shuffle, and
    take less than the texts; the rows are those of the query that does not cut."""
    from pathlib import Path

    from subword_spark.operators import encode_pieces as P
    from subword_spark.plans import catalog

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(300, 900))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, texts[0]), (301, None), (302, ""), (303, "ab ba")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "WORD", catalog.WORD.with_(max_merges=20))
    monkeypatch.setattr(catalog, "word_model", lambda s, d, m=catalog.word_model(spark, str(tmp_path), catalog.WORD): m)
    seen = []

    def note(df, name, **options):
        table, path = write(df, name, **options)
        seen.append((df._jdf.queryExecution().executedPlan().toString(), sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))))
        return table, path

    write = P.shared_table
    monkeypatch.setattr(P, "shared_table", note)
    got = sorted(map(tuple, catalog.q_encode_cut_docs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(map(tuple, catalog.q_encode_docs(spark, str(tmp_path)).collect()), key=str)
    ((plan, size),) = seen
    assert "Exchange" not in plan
    assert size < 0.8 * sum(map(len, texts))


def test_pieces_of_one_row_are_in_many_files(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from subword_spark.operators import encode_pieces as P

    paths = []

    def note(df, name, **options):
        table, path = write(df, name, **options)
        paths.append(path)
        return table, path

    write = P.shared_table
    monkeypatch.setattr(P, "shared_table", note)
    monkeypatch.setattr(P, "FILE_CHARS", 1000)
    m = model_of(random.Random(5), OPTIONS[0])
    df = spark.createDataFrame([(1, "ab ba é " * 2000)], "doc_id long, text string")
    assert encode_long(df, "text", m, piece_chars=100).first().ids == encode(df, "text", m).first().ids
    assert len(list(Path(paths[0].removeprefix("file:")).glob("*.parquet"))) >= 10


@pytest.mark.parametrize("marker", ["_", " ", "\n", "\u2581"])
def test_simple_and_other_texts_are_cut_alike(spark, marker):
    """Words of simple texts are split in batches, those of the others natively."""
    rng = random.Random(6)
    opts = BPEOptions(unit="word", marker=marker)
    base = [marker, *"abé\u4f60."]
    m = BPEModel(options=opts, tokens=[*opts.specials, *base, "ab", "ba"], merges=[("a", "b"), ("b", "a")], n_alphabet=len(base))
    texts = [random_text(rng, 40, letters) for letters in ("ab", "abé", "ab\u4f60", "ab.\u03b1", "e\u0301ab") for _ in range(4)]
    texts += ["a b\n\n " * 30, "\u3000 \n" * 30, " " * 60, "ab" * 50, None, "", "\u4f60"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    want = {r.doc_id: r.ids for r in encode(df, "text", m).collect()}
    got = encode_long(df, "text", m, piece_chars=20, keep=("doc_id",))
    assert got.columns == ["doc_id", "ids"] and {r.doc_id: r.ids for r in got.collect()} == want


def test_ids_travel_as_bytes(monkeypatch):
    """Whatever their size, and wherever a batch ends."""
    import pyarrow as pa

    from subword_spark.operators import encode as E
    from subword_spark.operators import encode_pieces as P

    monkeypatch.setattr(E, "MAX_SLICE_CHARS", 50)
    rng = random.Random(7)
    rows, want = [], []
    for u in range(60):
        want.append(({"i": u}, []))
        for no in range(rng.randint(1, 6)):
            most = rng.choice([200, 60_000, 2**24 - 1, 2**31 - 1])
            ids = [rng.choice([-1, rng.randrange(most)]) if most > 2**24 else rng.randrange(most) for _ in range(rng.randint(0, 20))]
            rows.append({"uid": u * 7, "no": no, "row": {"i": u} if no == 0 else None, "ids": ids})
            want[-1][1].extend(ids)
    schema = pa.schema([("uid", pa.int64()), ("no", pa.int32()), ("row", pa.struct([("i", pa.int64())])), ("ids", pa.list_(pa.int32()))])
    for step in (1, 3, 7, 1000):
        batches = [pa.RecordBatch.from_pylist(rows[i : i + step], schema) for i in range(0, len(rows), step)]
        planes = list(P._byte_planes([batches[0].slice(0, 0), *batches]))
        assert [(r["row"], r["ids"]) for b in P._stitch(planes) for r in b.to_pylist()] == want
    small = pa.RecordBatch.from_pylist([{"uid": 0, "no": 0, "row": None, "ids": [1, 255]}, {"uid": 0, "no": 1, "row": None, "ids": [256]}], schema)
    (planes,) = P._byte_planes([small])
    assert [planes[f"b{k}"].to_pylist() for k in range(4)] == [[b"\x01\xff", b"\x00"], [None, b"\x01"], [None, None], [None, None]]


def test_a_task_reads_several_of_very_many_parts(tmp_path, monkeypatch):
    from subword_spark.sources import whole_text as W

    path = tmp_path / "a.txt"
    path.write_text("word " * 1000)
    monkeypatch.setattr(W, "TASKS", 10)
    reader = W.WholeTextReader(str(path), 50)
    tasks = reader.partitions()
    assert len(tasks) == 10 and sum(len(t.parts) for t in tasks) == 100
    assert "".join(s for t in tasks for b in reader.read(t) for s in b["text"].to_pylist()) == "word " * 1000


def test_token_positions_encode_each_row_once(spark):
    """The encoded rows are read once, whatever is summed from them."""
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("f", 0, 1, [3, 4, 3]), ("f", 9, 1, [4]), ("g", 0, 1, [3]), ("g", 5, 1, [])]
    df = spark.createDataFrame(rows, "file string, start bigint, k int, ids array<int>")
    out = token_positions(df.mapInArrow(note, df.schema))
    assert sorted(map(tuple, out.collect())) == [(3, 3, 2), (4, 2, 4)] and seen.value == 4
