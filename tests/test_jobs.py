"""File-to-file jobs: train, encode, decode, stats."""

import os
import tempfile

from subword_spark.options import BPEOptions
from subword_spark.plans.jobs import decode_job, encode_job, stats_job, train_job


def test_jobs_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="subword-jobs-")
    corpus = os.path.join(d, "train.txt")
    with open(corpus, "w", encoding="utf-8") as fh:
        fh.write("hello world\nhello there general kenobi\n\nworld peace now\nbyte pair encoding demo\n")
    model, report = train_job(spark, corpus, os.path.join(d, "model"), BPEOptions(max_merges=10), valid_path=corpus)
    assert len(model.merges) == 10
    assert report["n_lines"] == 4 and report["n_mismatched"] == 0
    n = encode_job(spark, os.path.join(d, "model"), corpus, os.path.join(d, "ids"), out_fmt="text")
    assert n > 0
    decode_job(spark, os.path.join(d, "model"), os.path.join(d, "ids"), os.path.join(d, "back"), in_fmt="text")
    back = sorted(r.value for r in spark.read.text(os.path.join(d, "back")).collect())
    assert back == sorted(["hello world", "hello there general kenobi", "", "world peace now", "byte pair encoding demo"])
    st = stats_job(spark, os.path.join(d, "model"), corpus)
    assert st["vocab_size"] == len(model) and st["n_tokens"] == n


def test_whole_files_keep_name_and_newlines(spark):
    d = tempfile.mkdtemp(prefix="subword-whole-")
    texts = {"a.txt": "one two\r\nthree\n", "b.txt": "\n\nfour five  six", "c.txt": "one"}
    os.mkdir(os.path.join(d, "in"))
    for name, text in texts.items():
        with open(os.path.join(d, "in", name), "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    opts = BPEOptions(model_kind="byte_bpe", add_visible_space=False, alphabet="full256", minimum_pair_frequency=1, max_merges=5)
    model, _ = train_job(spark, os.path.join(d, "in"), os.path.join(d, "model"), opts)
    n = encode_job(spark, os.path.join(d, "model"), os.path.join(d, "in"), os.path.join(d, "ids"), fmt="wholetext")
    ids = spark.read.parquet(os.path.join(d, "ids"))
    assert n == sum(len(r.ids) for r in ids.collect()) and ids.count() == 3
    decode_job(spark, os.path.join(d, "model"), os.path.join(d, "ids"), os.path.join(d, "back"), out_fmt="parquet")
    back = {os.path.basename(r.file): r.text for r in spark.read.parquet(os.path.join(d, "back")).collect()}
    assert back == texts
    assert stats_job(spark, os.path.join(d, "model"), os.path.join(d, "in"), fmt="wholetext")["n_tokens"] == n
