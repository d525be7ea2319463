"""Decode token-id columns back to text.

One plan at every vocabulary size: an Arrow UDF gathers the tokens' bytes of bounded slices of
a batch through an offset table (numpy, no per-token Python), and the text steps after it are
native. The vocabulary travels once per Python worker inside the function and is bounded by the
model. Decoding is narrow: rows are never split, moved or joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import ship_package
from .model import BPEModel

#: Ids that one numpy step holds, whatever the Arrow batch; a longer row is its own slice.
SLICE_IDS = 1 << 20


def _gather(tokens: list[bytes], strict: bool):
    """``array<int>`` -> joined token bytes. A bad id raises, or (lenient) makes its row null."""
    at = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
    data = np.frombuffer(b"".join(tokens), np.uint8)

    @arrow_udf("binary")
    def _decode(ids: pa.Array) -> pa.Array:
        ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        made, lo = [pa.array([], pa.binary())], 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_IDS, "right")))
            made.append(_slice(ids.slice(lo, hi - lo)))
            lo = hi
        return pa.concat_arrays(made)

    def _slice(ids: pa.Array) -> pa.Array:
        size = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = ids.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        flat = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        known &= (flat >= 0) & (flat < len(tokens))
        bad = np.zeros(len(ids), bool)
        if not known.all():
            if strict:
                raise ValueError(f"no token has the id {flat[~known][0]}")
            np.logical_or.at(bad, np.repeat(np.arange(len(ids)), size)[~known], True)
            flat = np.where(known, flat, 0)
        start = at[flat]
        length = np.where(known, at[flat + 1] - start, 0)
        ends = np.concatenate(([0], np.cumsum(length)))
        out = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)]
        rows = ends[np.concatenate(([0], np.cumsum(size)))]
        valid = ids.is_valid().to_numpy(zero_copy_only=False) & ~bad
        made = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [pa.py_buffer(np.packbits(valid, bitorder="little").tobytes()), pa.py_buffer(rows.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]
        )
        return made.cast(pa.binary())

    return _decode


def decode_column(ids: Column, model: BPEModel, strict: bool = True) -> Column:
    """Text of an id column; null ids give null at every vocabulary size.

    Character mode: joined tokens, marker -> space; word mode drops the one marker that
    word splitting puts before the first word. Byte mode: the joined bytes must be valid
    UTF-8 (strict raises, otherwise invalid text gives null).
    """
    opts = model.options
    if opts.is_bytes:
        raw = _gather([t.encode("latin-1", "replace") for t in model.tokens], strict)(ids).cast("string")
        return F.validate_utf8(raw) if strict else F.try_validate_utf8(raw)
    text = _gather([t.encode("utf-8") for t in model.tokens], strict)(ids).cast("string")
    if opts.unit == "word":
        text = F.when(F.startswith(text, F.lit(opts.marker)), F.substring(text, 2, 2**31 - 1)).otherwise(text)
    if opts.add_visible_space:
        text = F.replace(text, F.lit(opts.marker), F.lit(" "))
    return text


def decode(df: DataFrame, ids_col: str, model: BPEModel, out_col: str = "decoded", strict: bool = True) -> DataFrame:
    """Add ``out_col``, the decoded text of ``ids_col``."""
    ship_package(df.sparkSession)
    return df.withColumn(out_col, decode_column(F.col(ids_col), model, strict))
