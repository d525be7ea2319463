"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has 64 bits: bit j is 1 if it is 1 in over half of the XXH64 hashes
of its word shingles. Fingerprints that differ in at most ``max_bits`` bits are linked.

The 64 bits are cut into m segments. Two fingerprints within r bits agree in some segment up
to a small radius (pigeonhole: with r = q*m + a, one of the first a+1 segments within q bits
or one of the others within q-1). Each distinct fingerprint is entered in a table per segment
and looks up every value of the small Hamming ball around its segment; what it finds is
compared over all 64 bits. A pair that differs in a segment is looked up from one side only,
the one whose lowest differing bit is 0.

Copies never meet as pairs: the search runs over distinct fingerprints, and from a bucket only
a spanning forest of its verified links leaves the task. Buckets are cut into blocks that meet
two at a time, so no bucket is gathered whole, however many fingerprints share a segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, drop, prepare, returning, row_field, source, table
from .words import slices, utf8

BLOCK = 2048
_HASHES = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of one text, as an unsigned 64-bit number; 0 for a text without words."""
    words = text.lower().split()  # bytes.lower() and split() know only the ASCII letters and spaces
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _HASHES):
        hi = min(n, lo + _HASHES)
        h = np.array([digest(joined[a : b - 1], 42) for a, b in zip(starts[lo:hi], starts[lo + k : hi + k])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def segments(max_bits: int, m: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` of the segments that have to be searched."""
    q, a = divmod(max_bits, m)
    out, at = [], 0
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        radius = q if i <= a else q - 1
        if radius >= 0:
            out.append((at, width, radius))
        at += width
    return out


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def choose_segments(max_bits: int, n: int) -> int:
    """The number of segments with the least look-ups and expected comparisons for n fingerprints."""

    def cost(m: int) -> float:
        return sum(len(ball(w, r)) / 2 * (1 + n / 2**w) for _, w, r in segments(max_bits, m))

    return min((m for m in range(1, max_bits + 2) if max_bits // m <= 2), key=cost)


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``max_bits`` among distinct fingerprints."""
    left, out = fps, []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                todo.extend(left[near])
                out.extend((int(x), int(y)) for y in left[near])
                left = left[~near]
    return out


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` (long) that join the same groups
    as all links within ``max_bits`` bits."""
    fps = fps.select("fp")
    cut = segments(max_bits, choose_segments(max_bits, fps.count()))
    keys = None
    for s, (shift, width, radius) in enumerate(cut):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        masks = F.lit([m - (1 << 64) if m >= 1 << 63 else m for m in ball(width, radius)]).cast("array<long>")
        own = fps.select("fp", value.alias("v")).select(
            "fp",
            "v",
            F.explode(F.filter(masks, lambda m: m.bitwiseAND(-m).bitwiseAND(F.col("v")) == 0)).alias("mask"),
        )
        own = own.select(F.lit(s).alias("s"), F.col("v").bitwiseXOR(F.col("mask")).alias("v"), "fp", (F.col("mask") == 0).alias("entered"))
        keys = own if keys is None else keys.union(own)
    size = keys.groupBy("s", "v").agg(F.count("*").alias("n"), F.max("entered").alias("e")).where("n > 1 and e")
    cells = keys.join(size.select("s", "v", F.ceil(F.col("n") / BLOCK).alias("blocks")), ["s", "v"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # Flat rows by group; two groups that share a hash are compared as one, which costs and loses nothing.
    group = F.xxhash64("s", "v", F.least("own", "other"), F.greatest("own", "other"))
    rows = cells.select(group.alias("g"), "fp").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(returning(partial(verify, max_bits=max_bits)), "a long, b long")


def verify(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links within each group of rows ``(g, fp)`` that come by group. A group that goes on in
    the next batch is held until it ends: it has two blocks at most."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def found(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = group_links(*(np.concatenate(x) for x in zip(*parts)), max_bits)
        return pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    for batch in batches:
        g, fp = batch["g"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        if not len(g):
            continue
        last = int(np.searchsorted(g, g[-1]))
        if held and (last or held[-1][0][-1] != g[0]):
            yield found([*held, (g[:last], fp[:last])])
            held = []
        elif last:
            yield found([(g[:last], fp[:last])])
        held.append((g[last:].copy(), fp[last:].copy()))
    if held:
        yield found(held)


def group_links(g: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Links of groups that stand one after another: all of small groups, a spanning forest of
    the others."""
    cut = np.flatnonzero(np.diff(g)) + 1
    size = np.diff(np.r_[0, cut, len(g)])
    in_small = np.repeat(size <= small, size)
    a, b = [], []
    for step in range(1, small):
        near = (g[step:] == g[:-step]) & in_small[step:]
        x, y = fp[:-step][near], fp[step:][near]
        bits = np.bitwise_count(x ^ y)
        near = (bits > 0) & (bits <= max_bits)
        a.append(x[near])
        b.append(y[near])
    starts = np.r_[0, cut]
    for at in np.flatnonzero(size > small):
        links_ = np.array(forest(np.unique(fp[starts[at] : starts[at] + size[at]]), max_bits), np.uint64).reshape(-1, 2)
        a.append(links_[:, 0])
        b.append(links_[:, 1])
    return np.concatenate(a), np.concatenate(b)


def _groups(docs: DataFrame, id_col: str, text_col: str, row: bool, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``marked(id, fp, uid)`` of all rows, with ``row`` also their columns, and ``group(fp,
    root, component)`` of the distinct fingerprints, both written."""
    prepare(docs.sparkSession)
    rows = source(docs, id_col, text_col, row).withColumn("id", F.col("id").cast("long"))

    def mark(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col, 4 << 20):
                data, at = utf8(texts)
                raw = data.tobytes()
                fp = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at[:-1], at[1:])], np.uint64).view(np.int64)
                out = {"id": part["id"], "fp": pa.array(fp)}
                yield pa.RecordBatch.from_pydict(out | ({"row": part["row"]} if row else {}))

    marked = table(rows.mapInArrow(returning(mark), "id long, fp long" + row_field(rows)).withColumn("uid", F.monotonically_increasing_id()), "fingerprints")
    distinct = table(marked.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    pairs = table(links(distinct, max_bits).distinct(), "links")
    comps = components(pairs)
    at = distinct.join(comps, distinct.fp == comps.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    low = at.groupBy("root").agg(F.min("low").alias("component"))
    group = table(at.join(low, "root").select("fp", "root", "component"), "groups")
    drop(pairs, distinct)
    return marked, group


def _first(keys: DataFrame) -> DataFrame:
    """``uid`` of the row that stays of each group: of the smallest id, the smallest uid."""
    return keys.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "uid")).alias("f")).select(F.col("f.uid").alias("uid"))


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: bool = False, shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """Fingerprint and group of every document.

    Returns ``id, fingerprint`` (long, the 64 bits), ``component`` (the smallest id that links
    reach, itself included), ``keep`` (true for one row of each group: the smallest id, and
    among rows of that id one of them), and with ``row`` also ``row``, a struct of all input
    columns.

    Words are lower-cased in A-Z; shingles of ``shingle`` words joined by a space, repeats
    included; fewer words make one shingle. Null and empty texts have fingerprint 0, linked
    like any other. A null id is larger than every other; a group of nulls only has a null
    component. Repeated rows are copies. Empty table: no rows. Other input columns are never
    read by name.
    """
    marked, group = _groups(docs, id_col, text_col, row, shingle, max_bits)
    keys = marked.select("id", "fp", "uid").join(group, "fp")
    out = keys.select("id", "fp", "component", "uid").join(_first(keys).withColumn("keep", F.lit(True)), "uid", "left")
    if row:
        out = out.join(marked.select("uid", "row"), "uid")
    return out.select("id", F.col("fp").alias("fingerprint"), "component", F.coalesce("keep", F.lit(False)).alias("keep"), *(["row"] if row else []))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that :func:`simhash_dedup` keeps, with all their columns.

    The numbers of the rows that go are written first. While they are few, Spark sends them to
    every task and the texts stay where they are; otherwise it joins by row number. Nulls,
    empty texts, ties, repeats and empty tables: as there.
    """
    marked, group = _groups(docs, id_col, text_col, True, shingle, max_bits)
    keys = marked.select("id", "fp", "uid").join(group, "fp").select("id", "uid", "root")
    gone = table(keys.select("uid").join(_first(keys), "uid", "left_anti"), "copies")
    return marked.join(gone, "uid", "left_anti").select("row.*")
