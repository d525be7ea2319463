"""Model sinks and sources.

Primary format: a directory of three Parquet tables (``vocab``, ``merges``, ``config``).
Interchange formats of the reference are also read and written: a JSON bundle
``{config, vocab: {tokens}, merges: [[left, right], ...]}``, a vocabulary JSON
``{"tokens": [...]}`` and a merges text file (``left right`` per line, rank = line order).
A model is at most ``target_vocabulary_size`` rows, so loading collects it to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.model import BPEModel
from ..options import BPEOptions

BUNDLE_SCHEMA = T.StructType(
    [
        T.StructField("config", T.StringType()),
        T.StructField("vocab", T.StructType([T.StructField("tokens", T.ArrayType(T.StringType()))])),
        T.StructField("merges", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)


def _alphabet_size(opts: BPEOptions, tokens: list[str], merges: list[tuple[str, str]]) -> int:
    made = {l + r for l, r in merges}
    n_special = len(dict.fromkeys(opts.specials))
    return sum(1 for t in tokens[n_special:] if t not in made)


def save_model(model: BPEModel, spark: SparkSession, path: str) -> None:
    base = path.rstrip("/")
    model.vocab_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{base}/vocab")
    model.merges_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{base}/merges")
    spark.createDataFrame([(model.options.to_json(),)], "config string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{base}/config")


def load_model(spark: SparkSession, path: str) -> BPEModel:
    base = path.rstrip("/")
    opts = BPEOptions.from_json(spark.read.parquet(f"{base}/config").first().config)
    vocab = spark.read.parquet(f"{base}/vocab").orderBy("token_id").collect()
    merges = spark.read.parquet(f"{base}/merges").orderBy("rank").collect()
    tokens = [r.token for r in vocab]
    if [r.token_id for r in vocab] != list(range(len(vocab))):
        raise ValueError("vocabulary ids are not dense")
    pairs = [(r.left, r.right) for r in merges]
    return BPEModel(
        options=opts,
        tokens=tokens,
        merges=pairs,
        counts=[r.cnt for r in merges],
        vocab_sizes=[r.vocab_size for r in merges],
        n_alphabet=sum(1 for r in vocab if r.kind == "symbol"),
    )


def bundle_json(model: BPEModel) -> str:
    return json.dumps(
        {
            "config": json.loads(model.options.to_json()),
            "vocab": {"tokens": model.tokens},
            "merges": [list(m) for m in model.merges],
        },
        ensure_ascii=False,
        indent=2,
    )


def save_bundle(model: BPEModel, spark: SparkSession, path: str) -> None:
    """The JSON bundle as one text file (written by Spark, one partition)."""
    spark.createDataFrame([(bundle_json(model),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_bundle(spark: SparkSession, path: str) -> BPEModel:
    """Read a JSON bundle; the config object is kept as raw JSON text by the schema."""
    row = spark.read.json(path, multiLine=True, schema=BUNDLE_SCHEMA).first()
    if row is None:
        raise FileNotFoundError(path)
    opts = BPEOptions.from_json(row.config)
    tokens = list(dict.fromkeys(row.vocab.tokens))
    merges = [(m[0], m[1]) for m in row.merges]
    return BPEModel(options=opts, tokens=tokens, merges=merges, n_alphabet=_alphabet_size(opts, tokens, merges))


def save_vocab_json(model: BPEModel, spark: SparkSession, path: str) -> None:
    payload = json.dumps({"tokens": model.tokens}, ensure_ascii=False, indent=2)
    spark.createDataFrame([(payload,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """``(token_id, token)``: ids by first position, later duplicates dropped."""
    schema = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType()))])
    pos = spark.read.json(path, multiLine=True, schema=schema).select(F.posexplode("tokens").alias("pos", "token"))
    first = pos.groupBy("token").agg(F.min("pos").alias("pos"))
    w = Window.orderBy("pos")
    return first.select((F.row_number().over(w) - 1).cast("int").alias("token_id"), "token")


def _escape(symbol: str) -> str:
    """Backslash and all white space of ``str.split`` as backslash escapes: a symbol is one
    field of its line."""
    return "".join(f"\\u{ord(c):04x}" if c.isspace() or c == "\\" or c in "\x1c\x1d\x1e\x1f" else c for c in symbol)


def _unescape(col: Column) -> Column:
    """The inverse, native: the text between escapes stays, ``\\uXXXX`` becomes its character."""
    parts = F.regexp_extract_all(col, F.lit(r"(\\u[0-9a-f]{4}|[^\\]+)"), 1)
    return F.array_join(
        F.transform(parts, lambda p: F.when(p.startswith("\\u"), F.decode(F.unhex(F.substring(p, 3, 4)), "UTF-16BE")).otherwise(p)), ""
    )


def save_merges_text(model: BPEModel, spark: SparkSession, path: str) -> None:
    """``left right`` per line in rank order; white space and backslashes inside a symbol are
    written as ``\\uXXXX``."""
    rows = [(i, f"{_escape(l)} {_escape(r)}") for i, (l, r) in enumerate(model.merges)]
    df = spark.createDataFrame(rows, "rank int, value string").coalesce(1).orderBy("rank").select("value")
    df.write.mode("overwrite").text(path)


def load_merges_text(spark: SparkSession, path: str) -> DataFrame:
    """``(rank, left, right)``; rank is the line order of the (single) merges file. A line
    that is not two fields raises."""
    lines = spark.read.text(path).withColumn("_i", F.monotonically_increasing_id()).where(F.col("value") != "")
    parts = F.split("value", " ")
    bad = F.raise_error(F.concat(F.lit("not a merge of two symbols: "), F.col("value")))
    left = F.when((F.size(parts) == 2) & (F.get(parts, 0) != "") & (F.get(parts, 1) != ""), F.get(parts, 0)).otherwise(bad)
    return lines.select(
        (F.row_number().over(Window.orderBy("_i")) - 1).cast("int").alias("rank"),
        _unescape(left).alias("left"),
        _unescape(F.get(parts, 1)).alias("right"),
    )
