"""Structured Streaming encode equals the batch encode on the same files."""

from pyspark.sql import functions as F

from subword_spark.operators.encode import encode
from subword_spark.operators.train import train
from subword_spark.options import BPEOptions
from subword_spark.sources.corpus import corpus_lines, read_table
from subword_spark.streaming.encode_stream import encode_stream, encode_stream_table

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    docs = read_table(spark, SF, "documents")
    m = train(corpus_lines(docs), "line", BPEOptions(unit="word", max_merges=20))
    streamed = encode_stream_table(spark, SF, "text", m, ("doc_id",), glob="documents.parquet")
    batch = encode(docs, "text", m).select("doc_id", F.size("ids").cast("int").alias("n_tokens"), "ids")
    a = {r.doc_id: (r.n_tokens, list(r.ids)) for r in streamed.collect()}
    b = {r.doc_id: (r.n_tokens, list(r.ids)) for r in batch.collect()}
    assert a == b and len(a) == 200


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    """Stopped between batches and started again with the same folders: each row once."""
    import time

    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    docs.repartition(5).write.parquet(source)
    m = train(corpus_lines(docs), "line", BPEOptions(unit="word", max_merges=5))
    start = lambda **k: encode_stream(spark, source, docs.schema, "text", m, ("doc_id",), sink, checkpoint, max_files_per_trigger=1, **k)[0]
    query = start()
    while query.isActive and (query.lastProgress or {}).get("batchId", -1) < 1:
        time.sleep(0.01)
    query.stop()
    first = spark.read.parquet(sink).count()
    assert 0 < first <= 200
    docs.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000).coalesce(1).write.mode("append").parquet(source)
    query = start()
    query.awaitTermination()
    assert query.exception() is None
    got = sorted((r.doc_id, list(r.ids)) for r in spark.read.parquet(sink).collect())
    both = docs.union(docs.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000))
    assert got == sorted((r.doc_id, list(r.ids)) for r in encode(both, "text", m).collect()) and len(got) == 203


def test_stream_reads_a_table_that_is_a_folder(spark, tmp_path):
    """A table of several files is a folder with the table's name."""
    rows = [(i, f"some text {i} aab") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs.limit(1).write.parquet(str(tmp_path / "other.parquet"))
    m = train(corpus_lines(docs), "line", BPEOptions(unit="word", max_merges=3))
    got = encode_stream_table(spark, str(tmp_path), "text", m, ("doc_id",), glob="documents.parquet")
    want = {r.doc_id: list(r.ids) for r in encode(docs, "text", m).collect()}
    assert {r.doc_id: list(r.ids) for r in got.collect()} == want and got.count() == 20
