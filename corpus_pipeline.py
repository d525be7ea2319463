"""From documents to token ids in five stages, each an operator of ``subword_spark.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage before
it kept; all but the last return the columns of ``documents``. A stage's result has to be
written before the next stage is called, as ``run`` does: a lost executor then costs at most
one stage, and a stage begins by deleting the tables that the stage before left behind.
"""

from __future__ import annotations

import functools
import threading

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subword_spark.llm.bpe_codec import bpe_encode
from subword_spark.llm.common import collecting, prepare, read, release
from subword_spark.llm.queries import fold
from subword_spark.llm import simhash_dedup as near
from subword_spark.llm.source_mixing import entropy_mix
from subword_spark.llm.substring_dedup import substring_dedup
from subword_spark.llm.toxicity import Fit, learn, score_toxicity
from subword_spark.session import remove_path, shared_table

#: What the last stage of a pipeline has left in the shared folder, by application, tables
#: and thread: pipelines side by side keep to their own.
_LEFT: dict[tuple[str, str, int], set[str]] = {}


def stage(operate):
    """Delete what the stage before has left in the shared folder, and note what this leaves."""

    @functools.wraps(operate)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, threading.get_ident())
        release(_LEFT.pop(key, set()))
        with collecting() as mine:
            out = operate(spark, docs, sf_dir)
        _LEFT[key] = mine
        return out

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that the network calls toxic (0.5 or more) go.

    Null and empty texts have an empty window and its score; equal texts go or stay together;
    null and repeated ids are only passed on. Empty table: no rows."""
    fit = Fit()
    labels = read(spark, sf_dir, "labels").where(fold() != 0)
    model = learn(docs, labels, "doc_id", "text", "toxic", fit)
    return score_toxicity(docs, model, row=True).where("score < 0.5").select("row.*")


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked within 4 fingerprint bits, the document with the smallest id stays.

    Null and empty texts are linked with each other; a null id is larger than every other; of
    repeated rows one stays. Empty table: no rows."""
    return near.drop_near_copies(docs, shingle=4, max_bits=4)


@stage
def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """13-word passages that a smaller document holds are cut out of the text. ``n_chars``
    follows where a text has changed; a text may become empty. A null text stays null; rows with
    the same id keep what they share; a null id is larger than every other. Empty table: no rows."""
    out = substring_dedup(docs, layout="text", row=True)
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("row.text")), "n_chars": F.when(cut, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0 to 3 times.

    A null source is a source of its own; null and empty texts have size 0; repeated rows count
    each. Empty table: no rows."""
    out = entropy_mix(docs, weights=(5, 2, 1), cap=3, row=True).where("copies > 0")
    return out.select(F.explode(F.sequence(F.lit(1), "copies")), "row").select("row.*")


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit numbers), and the digest of
    what they decode to. Null and empty texts have no ids. Empty table: no rows."""
    out = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=True, row=True)
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("row.lang").alias("lang"),
        F.col("row.source").alias("source"),
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("source_mixing", mix_sources),
    ("bpe_codec", encode),
]

#: Toxicity, mixing and BPE are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the token ids of the mix."""
    prepare(spark)
    docs, last = read(spark, sf_dir, "documents"), None
    for name, operate in STAGES[:-1]:
        docs, path = shared_table(operate(spark, docs, sf_dir), name)
        if last is not None:
            remove_path(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
