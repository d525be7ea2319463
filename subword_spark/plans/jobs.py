"""End-to-end jobs: train, encode, decode and stats as Spark jobs over files or tables.

These replace the reference's command-line commands with functions; each reads its input
with a Spark source, runs the operators, and writes with a Spark sink. Counts come from
``observe`` on the write itself: no output is read back and no input encoded twice.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode
from ..operators.encode import encode
from ..operators.metrics import roundtrip_report, stats_report
from ..operators.model import BPEModel
from ..operators.train import train
from ..options import BPEOptions
from ..sources import model_io
from ..sources.corpus import corpus_lines, format_token_ids, parse_token_ids, read_whole_text


def read_texts(spark: SparkSession, path: str, fmt: str = "text", text_col: str = "text") -> DataFrame:
    """A text column from Parquet (``text_col``, with the other columns), from text files (one
    row per line), or from whole files (``wholetext``: ``file, text``)."""
    if fmt == "parquet":
        return spark.read.parquet(path).withColumnRenamed(text_col, "text")
    if fmt == "wholetext":
        return read_whole_text(spark, path)
    if fmt != "text":
        raise ValueError("fmt must be 'text', 'wholetext' or 'parquet'")
    return spark.read.text(path).withColumnRenamed("value", "text")


def train_job(
    spark: SparkSession,
    corpus_path: str,
    model_path: str,
    opts: BPEOptions,
    fmt: str = "text",
    text_col: str = "text",
    valid_path: str | None = None,
    export_json: bool = True,
) -> tuple[BPEModel, dict[str, Any] | None]:
    """Train from a corpus, save the model (tables, plus the JSON bundle, vocabulary JSON
    and merges text), and report round-trip validation when a validation set is given."""
    texts = read_texts(spark, corpus_path, fmt, text_col).withColumn("doc_id", F.monotonically_increasing_id())
    lines = corpus_lines(texts, "text", ("doc_id",))
    model = train(lines, "line", opts)
    model_io.save_model(model, spark, model_path)
    if export_json:
        model_io.save_bundle(model, spark, f"{model_path.rstrip('/')}/model.json")
        model_io.save_vocab_json(model, spark, f"{model_path.rstrip('/')}/vocab.json")
        model_io.save_merges_text(model, spark, f"{model_path.rstrip('/')}/merges.txt")
    report = None
    if valid_path:
        vt = read_texts(spark, valid_path, fmt, text_col).withColumn("doc_id", F.monotonically_increasing_id())
        report = roundtrip_report(corpus_lines(vt, "text", ("doc_id",)), "line", model).first().asDict()
    return model, report


def encode_job(
    spark: SparkSession,
    model_path: str,
    input_path: str,
    output_path: str,
    fmt: str = "text",
    text_col: str = "text",
    out_fmt: str = "parquet",
    order: str = "scan",
) -> int:
    """Encode every row and write the ids: Parquet ``array<int>`` with the other columns, or
    space-separated text. Returns the number of tokens written."""
    model = model_io.load_model(spark, model_path)
    enc = encode(read_texts(spark, input_path, fmt, text_col), "text", model, order=order).drop("text")
    seen = Observation()
    enc = enc.observe(seen, F.sum(F.size("ids")).alias("n"))
    if out_fmt == "text":
        enc.select(format_token_ids(F.col("ids")).alias("value")).write.mode("overwrite").text(output_path)
    else:
        enc.write.mode("overwrite").parquet(output_path)
    return seen.get["n"] or 0


def decode_job(
    spark: SparkSession, model_path: str, input_path: str, output_path: str, in_fmt: str = "parquet", out_fmt: str = "text"
) -> None:
    """Decode id rows (Parquet ``ids`` or space-separated text) back to text; Parquet output
    keeps the other columns."""
    model = model_io.load_model(spark, model_path)
    if in_fmt == "text":
        ids = spark.read.text(input_path).select(parse_token_ids(F.col("value")).alias("ids"))
    else:
        ids = spark.read.parquet(input_path)
    out = decode(ids, "ids", model, "text").drop("ids")
    if out_fmt == "text":
        out.select("text").write.mode("overwrite").text(output_path)
    else:
        out.write.mode("overwrite").parquet(output_path)


def stats_job(
    spark: SparkSession, model_path: str, input_path: str, fmt: str = "text", text_col: str = "text"
) -> dict[str, Any]:
    """Vocabulary size, merges, characters, words, tokens and ratios of a corpus, in one pass."""
    model = model_io.load_model(spark, model_path)
    rep = stats_report(read_texts(spark, input_path, fmt, text_col), "text", model).first().asDict()
    return rep | {"vocab_size": len(model), "n_merges": len(model.merges)}
