"""Plan shape of every registered query: no cartesian products or nested-loop joins, and
the aggregations that meet hot keys combine map-side before their shuffle."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from subword_spark.operators.symbols import weighted_sequences
from subword_spark.operators.train import pair_counts
from subword_spark.plans import catalog as C

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_no_cross_products(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _partial_before_exchange(plan: str) -> bool:
    return "partial_" in plan and "Exchange" in plan


def test_hot_key_aggregations_combine_map_side(spark):
    lines = C.doc_lines(spark, SF)
    assert _partial_before_exchange(plan_of(weighted_sequences(lines, "line", C.WORD)))
    state, _ = C._char_state(spark, SF)
    assert _partial_before_exchange(plan_of(pair_counts(state)))
    assert _partial_before_exchange(plan_of(C.q_token_frequency(spark, SF)))


@pytest.mark.parametrize("name", ["pair_counts_chars", "best_pair", "top_pairs", "frequent_pairs", "apply_merge", "pair_count_delta"])
def test_pair_queries_read_the_corpus_once(spark, name):
    """The result reads the written sequences: the documents are in no plan that runs later."""
    assert "documents.parquet" not in plan_of(C.QUERIES[name](spark, SF))


def test_scan_prunes_columns(spark):
    plan = plan_of(C.q_baseline_counts(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_filters_pass_the_udfs_and_udfs_run_once(spark):
    from pyspark.sql import functions as F

    from subword_spark.operators.encode import encode
    from subword_spark.operators.model import BPEModel

    m = BPEModel(options=C.WORD, tokens=list(C.WORD.specials) + list("abcdefghijklmnopqrstuvwxyz_"), merges=[])
    docs = C.documents(spark, SF)
    plan = plan_of(encode(docs, "text", m).where(F.col("doc_id") == 5))
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in plan
    plan = plan_of(encode(docs, "text", m, unknown_col="n_unknown").where(F.col("n_unknown") > 0))
    assert plan.count("_encode(") == 1 and plan.count("_unicode(") == 1
    plan = plan_of(weighted_sequences(C.doc_lines(spark, SF), "line", C.WORD))
    assert plan.count("_unicode(") == 1
