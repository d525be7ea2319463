"""Corpus sources: tables of texts -> tables of lines, token-id text parsing.

A corpus is any DataFrame with a text column. Lines follow Python's text mode: universal
newlines, the newline is dropped, empty lines are skipped, lines of blanks stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS, split_lines


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as Spark's scan splits it; ``spark.sql.files.maxPartitionBytes`` and the
    writer's files and row groups set the number of tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus_lines(df: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per non-empty line: ``keys..., line_no (1-based position in the text), line``."""
    exploded = df.select(*keys, F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    return exploded.where(F.col("line") != "").select(
        *keys, (F.col("pos") + 1).cast("int").alias("line_no"), "line"
    )


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file, text``, newlines as they are. The encode command's input;
    a file has to fit in one task, so corpora belong in tables or line files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def parse_token_ids(col: Column) -> Column:
    """Whitespace-separated integers -> ``array<int>``; blank text -> empty array."""
    parts = F.filter(F.split(F.regexp_replace(col, f"^{WS}+|{WS}+$", ""), f"{WS}+"), lambda x: x != F.lit(""))
    return F.transform(parts, lambda x: x.cast("int"))


def format_token_ids(col: Column) -> Column:
    """``array<int>`` -> ids joined by one space (the id file format)."""
    return F.array_join(F.transform(col, lambda x: x.cast("string")), " ")
