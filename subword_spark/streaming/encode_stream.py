"""Structured Streaming encode: the batch encode operator on ``readStream`` unchanged.

Encoding is stateless and row-local, so no watermark or state store is involved: each
micro-batch is encoded independently and appended to a Parquet sink. The checkpoint
location makes the query restartable (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import encode
from ..operators.model import BPEModel
from ..session import has_folder, scratch_path


def encode_stream(
    spark: SparkSession,
    source_path: str,
    schema,
    text_col: str,
    model: BPEModel,
    keep: tuple[str, ...],
    sink_path: str | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    glob: str | None = None,
):
    """Start ``readStream(parquet) -> encode -> writeStream(parquet)``; returns
    ``(query, sink_path)``. With ``available_now`` the query drains the source and stops."""
    sink_path = sink_path or scratch_path(spark, "encode-stream-out")
    checkpoint = checkpoint or scratch_path(spark, "encode-stream-ckpt")
    reader = spark.readStream.schema(schema).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_path)
    out = encode(src, text_col, model).select(*keep, F.size("ids").cast("int").alias("n_tokens"), "ids")
    writer = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start(sink_path)
    return query, sink_path


def encode_stream_table(
    spark: SparkSession, source_dir: str, text_col: str, model: BPEModel, keep: tuple[str, ...], glob: str | None = None
) -> DataFrame:
    """Run the stream over the files of ``source_dir`` to completion and read what it wrote.
    ``glob`` picks files of the folder, or folders of files (a table is one or the other)."""
    path = f"{source_dir.rstrip('/')}/{glob}" if glob else source_dir
    schema = spark.read.parquet(path).schema
    if glob and not has_folder(spark, path):  # a stream reads folders only
        query, sink = encode_stream(spark, source_dir, schema, text_col, model, keep, glob=glob)
    else:
        query, sink = encode_stream(spark, path, schema, text_col, model, keep)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(sink)
