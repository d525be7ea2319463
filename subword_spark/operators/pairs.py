"""Pair statistics: native and Arrow pair counts, top-k, threshold, merge apply, delta counts."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chars
from . import kernels
from .train import PAIR_DDL


def adjacent_pairs(seq: Column) -> Column:
    """``array<struct<left, right>>`` of adjacent symbols of a sequence string (native)."""
    a = chars(seq)
    n = F.size(a)
    return F.when(
        n >= 2,
        F.zip_with(F.slice(a, 1, n - 1), F.slice(a, 2, n - 1), lambda x, y: F.struct(x.alias("left"), y.alias("right"))),
    ).otherwise(F.array().cast("array<struct<left:string,right:string>>"))


def pair_counts_native(seqs: DataFrame, seq_col: str = "seq", weight_col: str = "weight") -> DataFrame:
    """``(left, right, cnt)`` with explode + groupBy; partial aggregation per map task."""
    exploded = seqs.select(F.explode(adjacent_pairs(F.col(seq_col))).alias("p"), F.col(weight_col).alias("w"))
    return exploded.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(
        F.sum("w").alias("cnt")
    )


def frequent_pairs(counts: DataFrame, min_count: int) -> DataFrame:
    """Pairs at least ``min_count`` times (the minimum-frequency rule)."""
    return counts.where(F.col("cnt") >= int(min_count))


def conflict_free_groups(pairs: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Split merges (in order) into groups whose occurrences cannot touch: a pair joins the
    current group unless its left is a member's right, its right a member's left, it uses
    a member's new id, or it repeats a member; a self pair closes its group."""
    groups: list[list[tuple[int, int, int]]] = []
    cur: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    made: set[int] = set()
    for l, r, n in pairs:
        clash = l in rights or r in lefts or l in made or r in made or (l, r) in {(a, b) for a, b, _ in cur}
        if cur and clash:
            groups.append(cur)
            cur, lefts, rights, made = [], set(), set(), set()
        cur.append((l, r, n))
        lefts.add(l)
        rights.add(r)
        made.add(n)
        if l == r:
            groups.append(cur)
            cur, lefts, rights, made = [], set(), set(), set()
    if cur:
        groups.append(cur)
    return groups


def apply_pairs(state: DataFrame, pairs: list[tuple[int, int, int]], min_len: int = 0) -> DataFrame:
    """Merge every occurrence of ``(left id, right id, new id)`` pairs in the given order,
    each left to right, exactly as applying them one after another; other columns pass
    through. Pairs that cannot interact share one vectorised ``mapInArrow`` sweep."""
    out = state
    for group in conflict_free_groups(pairs):
        keys = np.array([(l << 32) | r for l, r, _ in group], dtype=np.int64)
        new_ids = np.array([n for _, _, n in group], dtype=np.int64)
        order = np.argsort(keys)
        fn = partial(kernels.apply_merges, batch_keys=keys[order], new_ids=new_ids[order], min_len=min_len)
        out = out.mapInArrow(fn, out.schema)
    return out


def partial_pair_counts(state: DataFrame, sign: int = 1) -> DataFrame:
    rows = state.select("seq", "weight").mapInArrow(kernels.count_pairs, PAIR_DDL)
    return rows if sign == 1 else rows.withColumn("cnt", -F.col("cnt"))


def update_pair_counts(counts: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts after a merge without recounting everything: old counts, minus the pairs of
    the rows that changed, plus their pairs after the merge (one ``groupBy`` of the union)."""
    delta = partial_pair_counts(before, -1).unionByName(partial_pair_counts(after))
    return (
        counts.select("l", "r", "cnt")
        .unionByName(delta)
        .groupBy("l", "r")
        .agg(F.sum("cnt").alias("cnt"))
        .where(F.col("cnt") > 0)
    )


def merge_with_delta(state: DataFrame, pair: tuple[int, int, int]):
    """Apply one merge and return ``(after, changed_before, changed_after)``; a row changed
    when it lost symbols. ``state`` needs ``seq`` and ``weight``."""
    tagged = state.withColumn("seq0", F.col("seq"))
    after = apply_pairs(tagged, [pair])
    changed = after.where(F.size("seq") < F.size("seq0"))
    before_rows = changed.select(F.col("seq0").alias("seq"), "weight")
    after_rows = changed.select("seq", "weight")
    return after.drop("seq0"), before_rows, after_rows
