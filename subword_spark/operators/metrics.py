"""Tokenizer metrics and validation as aggregates over encoded tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import n_chars, n_whitespace_words
from ..session import remove_path, shared_table
from .decode import decode, decode_column
from .encode import encode
from .model import BPEModel
from .symbols import normalized, symbols


def tokens_per_word(n_tokens: Column, n_words: Column) -> Column:
    """Average tokens per word, with at least one word in the denominator."""
    return n_tokens.cast("double") / F.greatest(n_words, F.lit(1)).cast("double")


def compression_ratio(n_tokens: Column, baseline: Column) -> Column:
    """Learned tokens over a baseline token count, with at least one in the denominator."""
    return n_tokens.cast("double") / F.greatest(baseline, F.lit(1)).cast("double")


def with_baselines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Character (code points) and whitespace-word counts of each text."""
    return df.withColumn("n_chars", n_chars(F.col(text_col))).withColumn(
        "n_words", n_whitespace_words(F.col(text_col))
    )


def stats_report(
    df: DataFrame,
    text_col: str,
    model: BPEModel,
    group_by: tuple[str, ...] = (),
    order: str = "scan",
    rollup: bool = False,
) -> DataFrame:
    """Characters, words, tokens and the ratios, overall or per group (one aggregate);
    ``rollup`` adds subtotals per prefix of ``group_by`` and a grand total."""
    enc = with_baselines(encode(df, text_col, model, order=order), text_col)
    agg = [
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_chars").cast("bigint").alias("n_chars"),
        F.sum("n_words").cast("bigint").alias("n_words"),
        F.sum(F.size("ids")).cast("bigint").alias("n_tokens"),
    ]
    grouped = enc.rollup(*group_by) if rollup else enc.groupBy(*group_by)
    out = grouped.agg(*agg)
    return (
        out.withColumn("tokens_per_word", tokens_per_word(F.col("n_tokens"), F.col("n_words")))
        .withColumn("ratio_chars", compression_ratio(F.col("n_tokens"), F.col("n_chars")))
        .withColumn("ratio_words", compression_ratio(F.col("n_tokens"), F.col("n_words")))
    )


def token_frequency(encoded: DataFrame, model: BPEModel, ids_col: str = "ids") -> DataFrame:
    """``(token_id, token, n)``: how often each id occurs (partial aggregation absorbs hot ids)."""
    counts = encoded.select(F.explode(ids_col).alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))
    vocab = model.vocab_df(encoded.sparkSession).select("token_id", "token")
    return counts.join(vocab, "token_id", "left").select("token_id", "token", "n")


def vocab_coverage(df: DataFrame, text_col: str, model: BPEModel, group_by: tuple[str, ...] = ()) -> DataFrame:
    """Share of the initial symbols of the texts that the vocabulary knows (native, narrow)."""
    sym = symbols(F.col(text_col), model.options)
    # Symbols are single characters: deleting the known ones by a hash lookup per character
    # leaves the unknown ones. The known set is bounded by Unicode.
    singles = "".join(t for t in model.tokens if len(t) == 1)
    missing = F.char_length(F.translate(F.array_join(sym, ""), singles, ""))
    per_row = df.select(*group_by, F.size(sym).alias("n_sym"), missing.alias("n_missing"))
    out = per_row.groupBy(*group_by).agg(
        F.sum("n_sym").cast("bigint").alias("n_symbols"),
        (F.sum("n_sym") - F.sum("n_missing")).cast("bigint").alias("n_covered"),
    )
    return out.withColumn("coverage", compression_ratio(F.col("n_covered"), F.col("n_symbols")))


def reference_text(line: Column, model: BPEModel) -> Column:
    """What a round trip must give back: the normalised line with spaces (character mode)
    or the line itself (byte mode)."""
    opts = model.options
    if opts.is_bytes:
        return line
    ref = normalized(line, opts)
    return F.replace(ref, F.lit(opts.marker), F.lit(" ")) if opts.add_visible_space else ref


def roundtrip_report(lines: DataFrame, line_col: str, model: BPEModel, order: str = "scan") -> DataFrame:
    """Strict-encode every line, skip lines with unknown symbols, decode, compare.

    One row: ``n_lines, n_skipped, n_checked, n_mismatched, accuracy``.
    """
    enc = encode(lines, line_col, model, order=order, unknown_col="n_unknown")
    skipped = F.col("n_unknown") > 0
    decoded = F.when(~skipped, decode_column(F.col("ids"), model))
    ok = decoded == reference_text(F.col(line_col), model)
    out = enc.select(skipped.alias("skipped"), ok.alias("ok")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("skipped")).alias("n_skipped"),
        F.count_if(~F.col("skipped")).alias("n_checked"),
        F.count_if(~F.col("skipped") & ~F.col("ok")).alias("n_mismatched"),
    )
    return out.withColumn(
        "accuracy",
        compression_ratio(F.col("n_checked") - F.col("n_mismatched"), F.col("n_checked")),
    )


def stability(spark, first: BPEModel, second: BPEModel) -> DataFrame:
    """``(n_merges, n_diff)``: merges present in one training and not in the other."""
    a = first.merges_df(spark).select("rank", "left", "right")
    b = second.merges_df(spark).select("rank", "left", "right")
    diff = a.exceptAll(b).unionByName(b.exceptAll(a))
    return diff.agg(F.count(F.lit(1)).alias("n_diff")).select(
        F.lit(len(first.merges)).cast("bigint").alias("n_merges"), "n_diff"
    )


def throughput(df: DataFrame, text_col: str, model: BPEModel, trials: int = 3, warmup: int = 1) -> DataFrame:
    """``(kind, trial, n_tokens, seconds, tokens_per_sec)``: each trial encodes the table, or
    decodes its ids, in a new query written in full to the ``noop`` sink. The ids are a table
    in the shared folder while decoding is timed, so that decoding alone counts."""
    spark = df.sparkSession
    ids, path = shared_table(encode(df, text_col, model).select("ids"), "throughput")
    jobs = {"encode": lambda: encode(df, text_col, model).select("ids"), "decode": lambda: decode(ids, "ids", model)}
    rows = []
    for kind, job in jobs.items():
        for trial in range(-warmup, trials):
            seen = Observation()
            out = job().observe(seen, F.sum(F.size("ids")).alias("n"))
            start = time.perf_counter()
            out.write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            n = int(seen.get["n"] or 0)
            if trial >= 0:
                rows.append((kind, trial, n, seconds, n / seconds))
    remove_path(spark, path)
    return spark.createDataFrame(rows, "kind string, trial int, n_tokens bigint, seconds double, tokens_per_sec double")


__all__ = [
    "compression_ratio",
    "reference_text",
    "roundtrip_report",
    "stability",
    "stats_report",
    "throughput",
    "token_frequency",
    "tokens_per_word",
    "vocab_coverage",
    "with_baselines",
]
