"""SimHash and substring dedup against brute force."""

import duckdb
import numpy as np
import xxhash

from subword_spark.llm import simhash_dedup as S
from subword_spark.llm import substring_dedup as D
from subword_spark.llm.queries import ORACLES, op3_simhash_dedup, op10_substring_dedup
from tools.check_oracles import digest

SF = "/root/testdata/sf0.001"


def _components(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def _fingerprint(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w.decode()) for w in (text or "").encode().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def test_simhash_query_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fp = {r.doc_id: _fingerprint(r.text) for r in rows}
    ids = sorted(fp)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fp[a] ^ fp[b]).bit_count() <= 4]
    comp = _components(ids, edges)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{fp[i]:016x}", comp[i]) for i in ids}


def test_links_join_what_all_pairs_join(spark, monkeypatch):
    rng = np.random.default_rng(0)
    values = set()
    for base in rng.integers(0, 2**63, 20, dtype=np.uint64):
        for _ in range(40):
            x = int(base)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            values.add(x)
    v = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long").cache()
    for bits, block in ((0, 2048), (1, 2048), (3, 2048), (4, 16)):
        monkeypatch.setattr(S, "BLOCK", block)
        got = [(r.a % 2**64, r.b % 2**64) for r in S.links(df, bits).collect()]
        assert all((a ^ b).bit_count() <= bits for a, b in got)
        want = [(int(v[i]), int(v[j])) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= bits)]
        assert _components(map(int, v), got) == _components(map(int, v), want)


def test_segments_and_balls_reach_every_pair():
    rng = np.random.default_rng(1)
    for bits in range(7):
        for m in range(1, bits + 2):
            if bits // m > 2:
                continue
            for _ in range(200):
                mask = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
                assert any((mask >> s & ((1 << w) - 1)).bit_count() <= r for s, w, r in S.segments(bits, m))


def test_gaps():
    for cells in ([], [0], [0, 1, 65534, 65535, 131070, 400_000, 400_001], [65535], [10**6]):
        c = np.array(cells, np.uint64)
        assert D.from_gaps(D.to_gaps(c)).tolist() == cells


def test_substring_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got, want = op10_substring_dedup(spark, SF).toPandas(), con.sql(ORACLES["op10_substring_dedup"]).df()
    assert digest(got) == digest(want)


def test_substring_blocks_and_sketch_width_do_not_change_the_result(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(4).cache()
    want = sorted(map(tuple, D.substring_dedup(df).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 3000)
    assert sorted(map(tuple, D.substring_dedup(df, cells_per_window=1, depth=1).collect())) == want


def test_text_layout_keeps_white_space(spark):
    p = " ".join(f"w{i}" for i in range(13))
    df = spark.createDataFrame([(1, p), (2, f"a\n{p}\n\nb  c"), (3, "x\n y")], "doc_id long, text string")
    got = {r.id: (r.kept, r.n_removed) for r in D.substring_dedup(df, layout="text").collect()}
    assert got == {1: (p, 0), 2: ("a\nb  c", 13), 3: ("x\n y", 0)}


def test_passage_blocks_hold_two_megabytes_of_text():
    """Two blocks are worked on by an executor's two tasks at once: each is bounded."""
    import pyarrow as pa

    from subword_spark.llm.substring_dedup import _pack, _Block

    texts = [f"word{i} " * 20_000 for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(40), pa.int64()), "text": pa.array(texts)})
    made = [_Block(b["block"][0].as_py(), 13, "text") for b in _pack(iter([batch]), "text")]
    assert [i for b in made for i in b.ids.tolist()] == list(range(40))
    assert all(sum(len(t) for t in b.texts.to_pylist()) <= 2 << 20 for b in made)
