"""M-tree search against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from subword_spark.llm import mtree_search as M
from subword_spark.llm.queries import ORACLES, op2_mtree_top_k
from tools.check_oracles import digest


def brute(rows, k, mod):
    known = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            known[i] = [math.floor(256 * float(x)) for x in e]
    dim = max(map(len, known.values()))
    ids = np.array(sorted(known))
    a = np.array([known[i] + [0] * (dim - len(known[i])) for i in ids], np.int64)
    out = []
    for j, i in enumerate(ids):
        if i % mod == 0:
            s = a @ a[j]
            best = [t for t in np.lexsort((ids, -s)) if ids[t] != i][:k]
            out += [(int(i), n + 1, int(ids[t]), int(s[t])) for n, t in enumerate(best)]
    return sorted(out)


def search(df, k, mod):
    v = M.quantize(df, "vec_id", "embedding")
    return sorted(map(tuple, M.top_k(v, v.where(F.col("id") % mod == 0), k).collect()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")
    assert search(df, 5, 50) == brute([tuple(r) for r in df.collect()], 5, 50)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got, want = op2_mtree_top_k(spark, sf).toPandas(), con.sql(ORACLES["op2_mtree_top_k"]).df()
    assert digest(got) == digest(want)


def test_small_pages_ties_and_odd_vectors(spark, monkeypatch):
    for name, value in (("PAGE", 8), ("FAN", 3), ("SHARD", 60), ("PIVOTS", 4), ("BLOCK", 16)):
        monkeypatch.setattr(M, name, value)
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(400)] + [(400 + i, [0.5] * 4) for i in range(200)]
    rows += [(900, None), (901, [float("nan")] * 4), (902, [None, 1.0, 1.0, 1.0]), (910, []), (904, [1.0, 2.0]), (950, [float("inf")] * 4), (None, [1.0] * 4), (401, [0.5] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert search(df, 5, 10) == brute(rows, 5, 10)
    assert search(df.limit(0), 5, 10) == []


def test_bounds_pass_over_distances(monkeypatch):
    """Entries that the stored distances rule out are not computed."""
    import pandas as pd

    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-20, 20, (500, 8)) + c for c in rng.integers(-400, 400, (20, 8))]).astype(np.int32)
    loader = M._Loader(v, r2 := float((v.astype(float) ** 2).sum(1).max()))
    loader.load(np.arange(len(v)), loader.v.mean(0))
    rows = pd.DataFrame(
        [
            {
                "page": n, "leaf": p["leaf"], "centre": p["centre"].tobytes(), "vectors": (v[p["index"]] if p["leaf"] else p["vectors"]).tobytes(),
                "parent_distance": p["parent"].tobytes(), "radius": p["radius"].tobytes(), "child": p["child"].tobytes(),
                "ids": (p["index"] if p["leaf"] else np.zeros(0)).astype(np.int64).tobytes(), "id_count": np.ones(len(p["index"]) if p["leaf"] else 0, np.int32).tobytes(),
            }
            for n, p in enumerate(loader.pages)
        ]
    )
    computed = 0
    real = M._dot

    def counted(a, b):
        nonlocal computed
        computed += len(a)
        return real(a, b)

    monkeypatch.setattr(M, "_dot", counted)
    tree = M._Tree(rows, 8)
    for i in range(0, len(v), 1000):
        got = sorted(tree.search(v[i].astype(np.int64), i, 5, r2, None), key=lambda x: (-x[0], x[1]))
        s = v.astype(np.int64) @ v[i].astype(np.int64)
        assert got == [(int(s[t]), int(t)) for t in np.lexsort((np.arange(len(v)), -s)) if t != i][:5]
    assert computed < 0.5 * 10 * len(v)


def test_groups_hold_one_block_of_queries(spark, monkeypatch):
    """No group gets more queries than a few times BLOCK, also where most have one vector and home."""
    import pickle

    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    for name, value in (("SHARD", 100), ("PIVOTS", 4), ("BLOCK", 16)):
        monkeypatch.setattr(M, name, value)
    real = PandasCogroupedOps.applyInPandas

    def bounded(self, answer, schema):
        def checked(tree, block):
            if len(pickle.dumps(block)) > 8_000:  # 16 queries: about 2,500
                raise AssertionError(f"a group of {len(pickle.dumps(block))} bytes")
            return answer(tree, block)

        return real(self, checked, schema)

    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", bounded)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(400)] + [(400 + i, [0.5] * 4) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert search(df, 5, 1) == brute(rows, 5, 1)


def test_large_components(spark, monkeypatch):
    """Components beyond 2^24 are kept and scores stay exact, also where bounds pass 2^53 and sums 2^63."""
    for name, value in (("SHARD", 60), ("PIVOTS", 4), ("BLOCK", 16)):
        monkeypatch.setattr(M, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * 10.0 ** (i % 7)]) for i in range(400)]
    rows += [(400 + i, [float(x) for x in rng.integers(1 << 21, 1 << 22, 4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert search(df, 5, 10) == brute(rows, 5, 10)
    # One far vector whose product with itself is beyond 64 bits, but no answer is.
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 4)]) for i in range(60)] + [(60, [2.0**40, 3.0, -1.0, 2.0]), (61, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    known = {i: [math.floor(256 * x) for x in v] + [0] * (4 - len(v)) for i, v in rows}
    want = []
    for i in range(0, 62, 10):
        best = sorted((-sum(a * b for a, b in zip(known[i], v)), d) for d, v in known.items() if d != i)[:5]
        want += [(i, n + 1, d, -s) for n, (s, d) in enumerate(best)]
    assert search(df, 5, 10) == sorted(want)


def test_products_beyond_64_bits():
    a, b = np.array([[(1 << 40) + 1, 5], [3, -7]], np.int64), np.array([[1 << 40, 11]], np.int64)
    assert M._dot(a, b)[:, 0].tolist() == [((1 << 40) + 1) * (1 << 40) + 55, 3 * (1 << 40) - 77]
