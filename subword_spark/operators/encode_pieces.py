"""Encoding texts that are too long for one task: whole files, and single very long rows.

A merge joins two tokens whose last and first symbols are side by side in the text. So where a
symbol pair (x, y) is the inner pair of no merge (no merge joins a token that ends in x with
one that begins with y), no token ever crosses, in either order of merges: the sequence can be
cut there, the pieces encoded by different tasks, and their ids put one after another.
Between words of ``unit='word'`` every place is such a place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import WS, collapse_markers, normalize
from ..session import shared_table, ship_package
from ..sources.whole_text import CHUNK_BYTES, read_text_parts
from . import kernels
from .encode import _ranges, encode_column, encode_sequences
from .model import BPEModel
from .symbols import line_sequence, splits_in_batches, text_or_words, word_sequences

PIECE_CHARS = 1 << 20
#: Sequences that one step of the cutting holds.
SLICE_BYTES = 1 << 22
#: Characters of pieces in one file; files are what the pieces are dealt out by.
FILE_CHARS = 1 << 24


def crossed_pairs(model: BPEModel) -> np.ndarray:
    """The inner pairs of all merges, as sorted numbers ``x << 21 | y`` of code points."""
    return np.unique(np.array([ord(l[-1]) << 21 | ord(r[0]) for l, r in model.merges], np.int64))


def cut_places(seq: str, crossed: np.ndarray) -> np.ndarray:
    """Places (symbols before them) at which a sequence can be cut."""
    cps = np.frombuffer(seq.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.flatnonzero(~np.isin(cps[:-1] << 21 | cps[1:], crossed)) + 1


def cut_sequence(seq: str, crossed: np.ndarray, size: int) -> list[str]:
    """Pieces that are cut at the first possible place from each ``size`` symbols on."""
    if len(seq) <= size:
        return [seq]
    places = cut_places(seq, crossed)
    at = [0]
    for k in np.searchsorted(places, np.arange(size, len(seq), size)):
        if k < len(places) and places[k] - at[-1] >= size:
            at.append(int(places[k]))
    return [seq[a:b] for a, b in zip(at, [*at[1:], len(seq)])]


def _cut_words(seqs: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pieces of rows of words: the row of each, its number in the row, and its words. A piece
    begins with the first word that begins at or after each multiple of ``size`` symbols."""
    at = np.concatenate(([0], np.cumsum(seqs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))
    words = seqs.flatten()
    ends = np.concatenate(([0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))))
    row = np.repeat(np.arange(len(seqs)), np.diff(at))
    no = (ends[:-1] - ends[at[row]]) // size
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (no[1:] != no[:-1])
    first = np.flatnonzero(new)
    return row[first], no[first], pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)].astype(np.int32)), words)


def _cut_lines(seqs: pa.Array, crossed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The same of rows of one sequence each, cut where no merge crosses."""
    pieces = [cut_sequence(s, crossed, size) for s in seqs.flatten().to_pylist()]
    n = np.array([len(p) for p in pieces], np.int64)
    made = pa.array([[s] for p in pieces for s in p], pa.list_(pa.string()))
    return np.repeat(np.arange(len(pieces)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), made


def _cut_rows(batches, crossed: np.ndarray | None, size: int) -> Iterator[pa.RecordBatch]:
    """``(row, seqs)`` to ``(uid, no, row, seqs)``: the pieces of each row; the first has its row."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for lo, hi in _bounded(batch["seqs"]):
            rows, seqs = batch["row"].slice(lo, hi - lo), batch["seqs"].slice(lo, hi - lo)
            row, no, pieces = _cut_words(seqs, size) if crossed is None else _cut_lines(seqs, crossed, size)
            yield pa.RecordBatch.from_pydict(
                {"uid": pa.array(number + row, pa.int64()), "no": pa.array(no, pa.int32()), "row": rows.take(pa.array(row, mask=no > 0)), "seqs": pieces}
            )
            number += hi - lo


def _bounded(seqs: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``SLICE_BYTES`` of sequences, or one row."""
    at = np.concatenate(([0], np.cumsum(seqs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))
    size = np.concatenate(([0], np.cumsum(pc.binary_length(seqs.flatten()).to_numpy(zero_copy_only=False).astype(np.int64))))[at]
    lo = 0
    while lo < len(seqs):
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, hi
        lo = hi


def _split_rows(batches, marker: str) -> Iterator[pa.RecordBatch]:
    """``(row, text, words)``, the text or the words null, to ``(row, seqs)``: the words of each."""
    for batch in batches:
        simple = batch.filter(batch["text"].is_valid())
        size = pc.binary_length(simple["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in _ranges(np.concatenate(([0], np.cumsum(size)))):
            words, at = kernels.split_words(simple["text"].slice(lo, hi - lo), marker)
            seqs = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), words)
            yield pa.RecordBatch.from_arrays([simple["row"].slice(lo, hi - lo), seqs], names=["row", "seqs"])
        others = batch.filter(batch["words"].is_valid())
        if len(others):
            yield pa.RecordBatch.from_arrays([others["row"], others["words"]], names=["row", "seqs"])


def _joined_pieces(batches, crossed: np.ndarray | None, size: int, marker: str | None, sep: str) -> Iterator[pa.RecordBatch]:
    """:func:`_cut_rows` with a piece's sequences in one string, ``sep`` between them; with a
    ``marker``, of the rows that :func:`_split_rows` takes."""
    for batch in _cut_rows(batches if marker is None else _split_rows(batches, marker), crossed, size):
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pc.binary_join(batch["seqs"], sep)], names=["uid", "no", "row", "seq"])


def _byte_planes(batches) -> Iterator[pa.RecordBatch]:
    """``(uid, no, row, ids)`` to ``(uid, no, row, b0, b1, b2, b3)``: the lowest bytes of a
    piece's ids, then the next ones, null where they are all 0."""
    for batch in batches:
        n = batch["ids"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = batch["ids"].flatten().to_numpy(zero_copy_only=False).view(np.uint32)
        at = np.concatenate(([0], np.cumsum(n)))
        planes = []
        for k in range(4):
            plane = (ids >> np.uint32(8 * k)).astype(np.uint8)
            has = np.diff(np.concatenate(([0], np.cumsum(plane != 0)))[at]) > 0 if k else np.ones(len(n), bool)
            size = np.where(has, n, 0)
            data = plane if has.all() else plane[np.repeat(has, n)]
            ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            planes.append(pa.Array.from_buffers(pa.binary(), len(n), [pa.array(has).buffers()[1], pa.py_buffer(ends), pa.py_buffer(data.tobytes())]))
        yield pa.RecordBatch.from_arrays([batch["uid"], batch["no"], batch["row"], *planes], names=["uid", "no", "row", "b0", "b1", "b2", "b3"])


def _stitch(batches) -> Iterator[pa.RecordBatch]:
    """The pieces of :func:`_byte_planes`, by ``uid`` and ``no``, to ``(row, ids)``. What a batch
    ends with waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        uid = batch["uid"].to_numpy()
        last = int(np.searchsorted(uid, uid[-1]))
        if last or held and held[0]["uid"][0].as_py() != uid[-1]:
            yield from _whole_rows([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield from _whole_rows(held)


def _whole_rows(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row, ids)`` from all pieces of some rows, in slices of bounded length, or one row."""
    pieces = pa.Table.from_batches(parts)
    uid = pieces["uid"].to_numpy()
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(pieces["b0"]).to_numpy().astype(np.int64))))
    first = np.append(np.flatnonzero(np.concatenate(([True], uid[1:] != uid[:-1]))), len(uid))
    for lo, hi in _ranges(ends[first]):
        at = ends[first[lo : hi + 1]] - ends[first[lo]]
        if at[-1] > np.iinfo(np.int32).max:
            raise ValueError("a row has more than 2^31 ids")
        mine = pieces.slice(first[lo], first[hi] - first[lo])
        rows = pa.concat_arrays(mine["row"].take(pa.array(first[lo:hi] - first[lo])).chunks)
        ids = np.concatenate([_ids(x) for x in mine.to_batches()])
        yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=["row", "ids"])


def _ids(pieces: pa.RecordBatch) -> np.ndarray:
    """The ids of pieces one after another."""
    n = pc.binary_length(pieces["b0"]).to_numpy(zero_copy_only=False)
    out = _bytes_of(pieces["b0"]).astype(np.uint32)
    for k in (1, 2, 3):
        has = pieces[f"b{k}"].is_valid().to_numpy(zero_copy_only=False)
        if has.any():
            out[np.repeat(has, n)] |= _bytes_of(pieces[f"b{k}"]).astype(np.uint32) << np.uint32(8 * k)
    return out.view(np.int32)


def _bytes_of(values: pa.Array) -> np.ndarray:
    """The bytes of binary values one after another."""
    values = values.drop_null()
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(values) else np.empty(0, np.uint8)


def encode_long(
    df: DataFrame,
    text_col: str,
    model: BPEModel,
    out_col: str = "ids",
    order: str = "scan",
    piece_chars: int = PIECE_CHARS,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """:func:`~subword_spark.operators.encode.encode`, where a text of more than ``piece_chars``
    characters is encoded by many tasks: its pieces are dealt out, encoded, and stitched by
    their place. Shorter texts take the narrow path. The same ids, whatever the size of pieces.

    ``keep``: the columns of the result beside ``out_col``, all by default. Others stay behind
    when the pieces are written and moved, which is most of the disk if the text is one of them.
    The pieces are in files of bounded text, which are dealt out as they are; only the bytes of
    their ids are shuffled.

    Null texts have null ids. A row's ids are one array again, so its longest row bounds a task.
    """
    spark = df.sparkSession
    ship_package(spark)
    kept = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep) if c != out_col]
    long = F.coalesce(F.length(text_col) > piece_chars, F.lit(False))
    short = df.where(~long).select(*kept, encode_column(F.col(text_col), model, order)["ids"].alias(out_col))
    opts = model.options
    by_word = opts.unit == "word"
    in_batches = splits_in_batches(opts)
    if in_batches:
        text, words = text_or_words(F.col(text_col), opts)
        seqs = [text.alias("text"), words.alias("words")]
    else:
        seqs = [(word_sequences(F.col(text_col), opts) if by_word else F.array(line_sequence(F.col(text_col), opts))).alias("seqs")]
    rows = df.where(long).select(F.struct(*kept).alias("row"), *seqs)
    # Words hold no white space but the marker.
    sep = None if not by_word else " " if opts.marker == "\n" else "\n"
    cut = partial(_joined_pieces, crossed=None if by_word else crossed_pairs(model), size=piece_chars, marker=opts.marker if in_batches else None, sep=sep or "")
    kind = rows.schema["row"].dataType.simpleString()
    per_file = max(1, FILE_CHARS // piece_chars)
    pieces, _ = shared_table(rows.mapInArrow(cut, f"uid long, no int, row {kind}, seq string"), "long-pieces", compression="zstd", maxRecordsPerFile=per_file)
    done = pieces.select("uid", "no", "row", encode_sequences(F.col("seq"), model, order, sep)["ids"].alias("ids"))
    planes = done.mapInArrow(_byte_planes, f"uid long, no int, row {kind}, b0 binary, b1 binary, b2 binary, b3 binary")
    whole = planes.repartition("uid").sortWithinPartitions("uid", "no").mapInArrow(_stitch, f"row {kind}, ids array<int>")
    return short.unionByName(whole.select("row.*", F.col("ids").alias(out_col)))


def _fragments(batches, crossed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(file, start, seq)`` to ``(file, start, k, opens, seq)``: what stands before the first
    possible cut (k 0), between the first and the last (1), and after the last (2)."""
    for batch in batches:
        for file, start, seq in zip(*(batch[c].to_pylist() for c in ("file", "start", "seq"))):
            places = cut_places(seq, crossed)
            a, b = (int(places[0]), int(places[-1])) if len(places) else (len(seq), len(seq))
            parts = [(k, s) for k, s in enumerate((seq[:a], seq[a:b], seq[b:])) if s]
            n = len(parts)
            yield pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([file] * n, pa.string()),
                    "start": pa.array([start] * n, pa.int64()),
                    "k": pa.array([k for k, _ in parts], pa.int32()),
                    "opens": pa.array([int(k > 0) for k, _ in parts], pa.int32()),
                    "seq": pa.array([s for _, s in parts], pa.string()),
                }
            )


def encode_files(spark: SparkSession, path: str, model: BPEModel, order: str = "scan", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Encode whole files, each as one text, with a task for each ``chunk_bytes``.

    Returns ``file, start, k, ids``: the ids of a file are its rows' by ``start``, then ``k``.
    They equal the ids of the whole text encoded as one row. Parts of a file meet where a
    marker stands for the white space between them; what lies around that place, up to the
    next possible cut on both sides, is put together and encoded as a piece of its own. Only
    these ends are moved between tasks.
    """
    ship_package(spark)
    parts = read_text_parts(spark, path, chunk_bytes)
    opts = model.options
    if opts.unit == "word":
        # A blank part has no words, unless the whole file is blank.
        blank = F.col("text").rlike(f"^{WS}*$")
        words = parts.where(~blank).select("file", "start", F.lit(1).alias("k"), word_sequences(F.col("text"), opts).alias("seqs"))
        empty = parts.groupBy("file").agg(F.min(blank).alias("blank")).where("blank").select("file", F.lit(0).cast("long").alias("start"), F.lit(1).alias("k"), word_sequences(F.lit(""), opts).alias("seqs"))
        return words.unionByName(empty).select("file", "start", "k", encode_sequences(F.col("seqs"), model, order)["ids"].alias("ids"))
    plain = not opts.is_bytes and not opts.add_visible_space
    space = "" if opts.is_bytes else " " if plain else opts.marker
    # Without visible spaces, literal markers beside the space between two parts stay.
    seq = collapse_markers(normalize(F.col("text"), opts), opts) if plain else line_sequence(F.col("text"), opts)
    seqs = parts.select("file", "start", seq.alias("seq")).where("seq <> ''")
    if space:
        seqs = seqs.withColumn("seq", F.when(F.col("start") > 0, F.concat(F.lit(space), "seq")).otherwise(F.col("seq")))
    made = seqs.mapInArrow(partial(_fragments, crossed=crossed_pairs(model)), "file string, start bigint, k int, opens int, seq string")
    made, _ = shared_table(made, "file-fragments")
    by_place = Window.partitionBy("file").orderBy("start", "k")
    ends = made.where("k <> 1").withColumn("piece", F.sum("opens").over(by_place))
    if space:  # the first part that is not blank has nothing before it
        ends = ends.withColumn("first", F.row_number().over(by_place) == 1)
        ends = ends.withColumn("seq", F.when(F.col("first") & (F.col("start") > 0), F.substring("seq", 2, 2**31 - 1)).otherwise(F.col("seq")))
    if plain:  # markers at the ends of the whole text go
        last = F.lead("file").over(by_place).isNull()
        for edge, trim in ((F.col("first"), F.ltrim), (last, F.rtrim)):
            ends = ends.withColumn("seq", F.when(edge, trim("seq", F.lit(opts.marker))).otherwise(F.col("seq")))
    joined = ends.groupBy("file", "piece").agg(F.array_sort(F.collect_list(F.struct("start", "k", "seq"))).alias("p"))
    joined = joined.select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["k"].alias("k"), F.array_join(F.transform("p", lambda x: x["seq"]), "").alias("seq"))
    pieces = made.where("k = 1").select("file", "start", "k", "seq").unionByName(joined.where("seq <> ''"))
    return pieces.select("file", "start", "k", encode_sequences(F.array("seq"), model, order)["ids"].alias("ids"))


def _sum_places(batches) -> Iterator[pa.RecordBatch]:
    """``(file, start, k, ids)`` to ``(file, start, k, token_id, n, places)``: for each row and
    token, how often it occurs and the sum of its places in the row."""
    for batch in batches:
        row, token, n, places = [], [], [], []
        for i, ids in enumerate(batch["ids"]):
            ids = ids.values.to_numpy(zero_copy_only=False)
            for at in range(0, len(ids), 1 << 20):  # sums of bincount are exact to 2^53
                part = ids[at : at + (1 << 20)]
                count = np.bincount(part)
                has = np.flatnonzero(count)
                row.append(np.full(len(has), i))
                token.append(has)
                n.append(count[has])
                places.append(np.bincount(part, np.arange(len(part)))[has].astype(np.int64) + at * count[has])
        if row:
            keys = batch.select(["file", "start", "k"]).take(pa.array(np.concatenate(row)))
            cols = [pa.array(np.concatenate(x), t) for x, t in ((token, pa.int32()), (n, pa.int64()), (places, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*keys.columns, *cols], names=["file", "start", "k", "token_id", "n", "places"])


def token_positions(encoded: DataFrame) -> DataFrame:
    """``token_id, n, sum_pos`` over the files of :func:`encode_files`: how often each token
    occurs, and the sum of its places (from 0) in its file. Each row is summed where it is
    encoded, once; places come from the lengths of the rows before. The ids are not moved."""
    sums = encoded.select("file", "start", "k", "ids").mapInArrow(_sum_places, "file string, start bigint, k int, token_id int, n bigint, places bigint")
    sums, _ = shared_table(sums, "token-sums")
    before = Window.partitionBy("file").orderBy("start", "k").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sums.groupBy("file", "start", "k").agg(F.sum("n").alias("size"))
    sizes = sizes.select("file", "start", "k", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    each = sums.join(sizes, ["file", "start", "k"])
    return each.groupBy("token_id").agg(F.sum("n").alias("n"), F.sum(F.col("first") * F.col("n") + F.col("places")).alias("sum_pos"))
