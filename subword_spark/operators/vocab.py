"""Vocabulary operators: alphabet, vocabulary table, token <-> id lookups, interning."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import BPEOptions
from ..session import ship_package
from . import kernels

# Unicode has 1,114,112 code points: the observed alphabet can never be larger, which is
# the bound that makes collecting it to the driver safe.
MAX_ALPHABET = 0x110000


def alphabet_df(seqs: DataFrame, col: str = "seq") -> DataFrame:
    """Distinct symbols of a sequence-string column (``symbol string, cp int``): those of each
    task, then an aggregate by code point."""
    ship_package(seqs.sparkSession)
    cps = seqs.select(F.col(col).alias("seq")).mapInArrow(partial(kernels.seen_code_points, col="seq"), "cp int").distinct()
    return cps.select(F.expr("char(cp)").alias("symbol"), "cp")


def observed_alphabet(seqs: DataFrame, col: str = "seq") -> list[str]:
    """Sorted (code-point order) distinct symbols, collected: bounded by Unicode itself."""
    rows = alphabet_df(seqs, col).select("cp").collect()
    if len(rows) > MAX_ALPHABET:  # pragma: no cover - impossible by construction
        raise ValueError("alphabet larger than Unicode")
    return [chr(c) for c in sorted(r.cp for r in rows)]


def full_byte_alphabet() -> list[str]:
    """All 256 byte symbols."""
    return [chr(b) for b in range(256)]


def initial_tokens(opts: BPEOptions, alphabet: list[str]) -> list[str]:
    """Specials first (duplicates dropped), then the alphabet in code-point order."""
    tokens = list(dict.fromkeys(opts.specials))
    seen = set(tokens)
    tokens.extend(a for a in alphabet if a not in seen)
    return tokens


def alphabet_index(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the single-character tokens, ascending, and their first ids."""
    index: dict[int, int] = {}
    for cp, i in sorted((ord(t), i) for i, t in enumerate(tokens) if len(t) == 1):
        index.setdefault(cp, i)
    cps = sorted(index)
    return np.array(cps, dtype=np.int64), np.array([index[c] for c in cps], dtype=np.int64)


def intern_state(seqs: DataFrame, tokens: list[str], min_len: int = 2, keep_text: bool = False) -> DataFrame:
    """Weighted sequence strings -> ``(seq array<int>, weight bigint)`` of token ids.

    Only single-character tokens take part; rows shorter than ``min_len`` are dropped.
    ``keep_text`` keeps the sequence string as ``text``.
    """
    cps, ids = alphabet_index(tokens)
    fn = partial(kernels.intern, code_points=cps, ids=ids, min_len=min_len, keep_text=keep_text)
    schema = "seq array<int>, weight bigint" + (", text string" if keep_text else "")
    return seqs.select("seq", "weight").mapInArrow(fn, schema)


def token_literal(tokens: list[str]) -> Column:
    """The vocabulary as one constant ``array<string>`` (folded once by the optimizer)."""
    import json

    return F.from_json(F.lit(json.dumps(tokens, ensure_ascii=False)), "array<string>")


def with_token_ids(df: DataFrame, token_col: str, tokens: list[str], out_col: str = "token_id", unknown_id: int | None = None) -> DataFrame:
    """Token -> id by an equi-join with the vocabulary table, flat in the vocabulary's size;
    tokens outside it give ``unknown_id`` (or null). Join distinct tokens, not occurrences.
    A token listed twice has its first id."""
    first: dict[str, int] = {}
    for i, t in enumerate(tokens):
        first.setdefault(t, i)
    vocab = df.sparkSession.createDataFrame(list(first.items()), f"`{token_col}` string, `{out_col}` int")
    out = df.join(vocab, token_col, "left")
    return out if unknown_id is None else out.withColumn(out_col, F.coalesce(out_col, F.lit(unknown_id)))


def token_lookup(id_col: Column, tokens: list[str], strict: bool = True) -> Column:
    """Id -> token; an id outside ``[0, size)`` raises (strict) or gives null."""
    arr = token_literal(tokens)
    n = len(tokens)
    ok = (id_col >= 0) & (id_col < n)
    bad = F.raise_error(F.concat(F.lit("ID "), id_col.cast("string"), F.lit(" not in vocabulary")))
    return F.when(ok, F.get(arr, id_col)).otherwise(bad if strict else F.lit(None))
