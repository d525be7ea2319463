"""Source mixing: targets, convergence and rounding."""

import math

import pytest
from pyspark.sql import functions as F

from subword_spark.llm import source_mixing as M
from subword_spark.llm.queries import op1_source_mixing
from subword_spark.llm.source_mixing import entropy_mix

SF = "/root/testdata/sf0.01"


def _targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        rest = sum(w[s] for s in sizes if s not in full)
        t = {s: cap * sizes[s] if s in full else w[s] * left / rest for s in sizes}
        over = {s for s in sizes if s not in full and t[s] >= cap * sizes[s]}
        if not over:
            return t
        full |= over


def _check(rows, near):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = _targets(sizes)
    for s, size in sizes.items():
        mine = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == size and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= near(mine)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first = op1_source_mixing(spark, SF).collect()
    rows = [r.asDict() | {"source": docs[r.doc_id].source} for r in first]
    assert all(r["size"] == len((docs[r["doc_id"]].text or "").encode().split()) for r in rows)
    _check(rows, lambda mine: 0.002 * mine[0]["target"])
    assert sorted(op1_source_mixing(spark, SF).collect()) == sorted(first)


def test_caps_are_shared_again(spark):
    text = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (2, "a"), (100, "b"), (30, "b"), (500, "c"), (7, None), (7, None), (0, "d")])]
    rows = [r.asDict() for r in entropy_mix(spark.createDataFrame(text, "doc_id long, text string, source string")).collect()]
    _check(rows, lambda mine: max(r["size"] for r in mine))


def test_rates_are_exponential_in_size(spark):
    text = [(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(400)]
    rows = entropy_mix(spark.createDataFrame(text, "doc_id long, text string, source string")).collect()
    for s in "ab":
        slope = {round(math.log(r["rate"]) / r["size"], 9) for r in rows if r["source"] == s and r["rate"] < 3}
        assert len(slope) == 1


def test_copies_do_not_depend_on_row_order(spark, monkeypatch):
    """Cells of many parts, ids that repeat and null ids: the same copies however the rows lie."""
    monkeypatch.setattr(M, "RANKED", 20)
    text = [(i, "w " * (3 + i % 4), "abc"[i % 3]) for i in range(1200)]
    text += [(5, "w " * 3, "a")] * 90 + [(None, "w " * 4, "b")] * 90 + [(2000 + i // 2, "w " * 5, "c") for i in range(60)]
    df = spark.createDataFrame(text, "doc_id long, text string, source string")
    got = [sorted(str(tuple(r)) for r in entropy_mix(x).select("id", "source", "size", "copies").collect()) for x in (df.coalesce(1), df.repartition(7, "text"), df.orderBy(F.col("doc_id").desc()).repartition(3))]
    assert got[0] == got[1] == got[2]
    rows = [r.asDict() for r in entropy_mix(df).collect()]
    _check(rows, lambda mine: max(r["size"] for r in mine))


def test_a_source_that_does_not_converge_raises(spark):
    counts = spark.createDataFrame([(0, s, 3) for s in (1, 7, 50)], "sid int, size long, n long")
    sources = spark.createDataFrame([(0, 174, 50, 400.0)], "sid int, source_size long, largest long, target double")
    assert M.solve(counts, sources, 3).first()["lam"] > 0
    with pytest.raises(RuntimeError):
        M.solve(counts, sources, 3, max_rounds=1)


def test_a_round_is_one_join_and_one_sum(spark, monkeypatch):
    """Each round leaves one broadcast at most on the driver, and meets the texts' targets."""
    plans = []
    real = M.table
    monkeypatch.setattr(M, "table", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    counts = spark.createDataFrame([(k, s, 3 + k) for k in (0, 1) for s in (1, 7, 50)] + [(2, 4, 1)], "sid int, size long, n long")
    sources = spark.createDataFrame([(0, 174, 50, 400.0), (1, 232, 50, 120.0), (2, 4, 4, 12.0), (3, 0, 0, 0.0)], "sid int, source_size long, largest long, target double")
    lams = {r.sid: r.lam for r in M.solve(counts, sources, 3).collect()}
    assert len(plans) > 2 and all(p.count("Join") == 1 and p.count("Aggregate") == 1 for p in plans)
    assert lams.keys() == {0, 1, 2} and lams[2] is None and lams[0] > 0 > lams[1]
    for k, target in ((0, 400), (1, 120)):
        got = sum((3 + k) * s * min(3, math.exp(lams[k] * s / 50)) for s in (1, 7, 50))
        assert math.isclose(got, target, rel_tol=1e-8)
