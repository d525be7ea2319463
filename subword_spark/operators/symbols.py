"""Pretokenisation: text -> symbol sequences, and the weighted distinct-sequence table.

A sequence is carried as a *sequence string*: one character per symbol (a code point in
character mode, a byte U+0000-U+00FF in byte mode). That keeps the grouping key a plain
string and makes interning a code-point lookup.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import BPEOptions
from ..session import ship_package
from . import kernels


def normalized(col: Column, opts: BPEOptions) -> Column:
    """The reference's normalisation; byte mode uses the raw text."""
    return col if opts.is_bytes else T.normalize(col, opts)


def line_sequence(col: Column, opts: BPEOptions) -> Column:
    """Sequence string of a whole line (``unit='line'``)."""
    if opts.is_bytes:
        return T.byte_string(col)
    return T.char_sequence_string(T.normalize(col, opts), opts)


def word_sequences(col: Column, opts: BPEOptions) -> Column:
    """Array of sequence strings, one per word or punctuation token (``unit='word'``)."""
    if opts.is_bytes:
        raise ValueError("byte_bpe reads whole lines; unit='word' is for character_bpe")
    return T.word_tokens(T.normalize(col, opts), opts)


def splits_in_batches(opts: BPEOptions) -> bool:
    """Whether ``kernels.split_words`` gives the words of simple texts under these options."""
    plain = opts.unicode_normalization in ("NFC", "none") and not opts.strip_accents and not opts.lowercase
    return opts.unit == "word" and plain and ord(opts.marker) < kernels.SIMPLE_BELOW


def text_or_words(col: Column, opts: BPEOptions) -> tuple[Column, Column]:
    """The raw text where the batch split takes it, and otherwise the word sequences; the other
    of the two is null, and for a null text both are."""
    hard = col.rlike(f"[\\x{{{kernels.SIMPLE_BELOW:x}}}-\\x{{10ffff}}]")
    return F.when(~hard, col), F.when(hard, word_sequences(col, opts))


def symbols(col: Column, opts: BPEOptions) -> Column:
    """The flat symbol list of a text, as the reference's pretokeniser returns it."""
    if opts.unit == "word":
        return F.flatten(F.transform(word_sequences(col, opts), T.chars))
    return T.chars(line_sequence(col, opts))


def computed_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add column ``name`` = ``expr`` through a one-row generator.

    When ``expr`` holds a Python UDF, a filter on a column derived from it (an explicit
    one, or the ``size > 0`` Spark infers for ``explode``) is otherwise rewritten to call
    the UDF a second time below the projection. A filter cannot move below a generator
    whose output it reads, while filters on the other columns still pass it on their
    way to the scan.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def sequence_rows(df: DataFrame, col: str, opts: BPEOptions) -> DataFrame:
    """One row per symbol sequence of the corpus: ``seq string``."""
    if opts.unit == "word":
        words = computed_once(df.select(col), "__words", word_sequences(F.col(col), opts))
        return words.select(F.explode("__words").alias("seq"))
    seqs = computed_once(df.select(col), "__seq", line_sequence(F.col(col), opts))
    return seqs.select(F.col("__seq").alias("seq"))


def weighted_sequences(lines: DataFrame, col: str, opts: BPEOptions) -> DataFrame:
    """Distinct sequences with their multiplicity: ``seq string, weight bigint``.

    One shuffle on the sequence string; partial aggregation collapses repeats (and hot
    words) inside each map task before anything moves. Words are split and counted in Arrow
    batches where their texts are simple.
    """
    if splits_in_batches(opts):
        ship_package(lines.sparkSession)
        text, words = text_or_words(F.col(col), opts)
        rows = computed_once(lines.select(col), "__in", F.struct(text.alias("text"), words.alias("words"))).select("__in.text", "__in.words")
        counted = rows.mapInArrow(partial(kernels.count_words, marker=opts.marker), "seq string, weight bigint")
        return counted.groupBy("seq").agg(F.sum("weight").alias("weight"))
    return (
        sequence_rows(lines, col, opts)
        .where(F.length("seq") > 0)
        .groupBy("seq")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
