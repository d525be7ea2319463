"""Metrics: the reference's metric tests as column expressions, and the report operators."""

from pyspark.sql import functions as F

from subword_spark.operators.metrics import (
    compression_ratio,
    roundtrip_report,
    stats_report,
    throughput,
    tokens_per_word,
    vocab_coverage,
)
from subword_spark.operators.train import train
from subword_spark.options import BPEOptions


def test_tokens_per_word_and_ratio(spark):
    df = spark.createDataFrame([(10, 5, 50, 100), (10, 0, 50, 0)], "t long, w long, n long, b long")
    rows = df.select(tokens_per_word(F.col("t"), F.col("w")).alias("tpw"), compression_ratio(F.col("n"), F.col("b")).alias("cr")).collect()
    assert [(r.tpw, r.cr) for r in rows] == [(2.0, 0.5), (10.0, 50.0)]


def test_reports(spark, lines_df):
    df = lines_df(["hello world", "hello there general kenobi", "world peace now"], col="text")
    m = train(df, "text", BPEOptions(max_merges=10))
    rep = stats_report(df, "text", m).first()
    assert rep.n_chars == 11 + 26 + 15 and rep.n_words == 9 and rep.n_tokens > 0
    rt = roundtrip_report(df.withColumnRenamed("text", "line"), "line", m).first()
    assert (rt.n_lines, rt.n_skipped, rt.n_mismatched, rt.accuracy) == (3, 0, 0, 1.0)
    cov = vocab_coverage(spark.createDataFrame([("hello!",)], "text string"), "text", m).first()
    assert (cov.n_symbols, cov.n_covered) == (6, 5)


def test_throughput_has_a_row_per_trial(spark, lines_df):
    df = lines_df(["hello world"] * 20, col="text")
    m = train(df, "text", BPEOptions(max_merges=5))
    n = stats_report(df, "text", m).first().n_tokens
    rows = throughput(df, "text", m, trials=2, warmup=0).collect()
    assert sorted((r.kind, r.trial, r.n_tokens) for r in rows) == [(k, t, n) for k in ("decode", "encode") for t in (0, 1)]
    assert all(r.seconds > 0 and r.tokens_per_sec > 0 for r in rows)
