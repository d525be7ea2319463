"""Distributed BPE training.

State: the distinct symbol sequences with their weights, packed in blocks (``blocks``). Blocks
are Parquet files in bucket folders under the shared folder; the driver knows for each bucket
where its present version is. Pair counts: the driver holds the ``HOT`` most frequent pairs
(a bound, whatever the corpus), each with the set of buckets it occurs in (:class:`HotPairs`).
All other pairs are known to come after a cut in the order of picks, and a pair's count never
grows after the round that made it; so the cut stays true until the held pairs are used up,
and only then all blocks are counted again.

Each round:

1. The driver picks a *safe batch* from the held pairs (see ``choose_batch``).
2. Only buckets that hold a picked pair are read; one Arrow pass merges the batch and counts
   what changes beside the merged places, and the new version of these buckets is written.
3. The changes are summed by pair (map-side combine, one small shuffle) and those of held pairs
   and of new pairs above the cut go to the driver. Old counts are never exchanged.

Adjacent symbols whose pair is rarer than the minimum frequency never merge, and neither does
what grows from them: each occurrence of a later pair across that place is one of the rare
pair. So once a tenth of all pairs are rare, sequences are cut there and equal pieces become
one row. The proof needs each token to be made in one way only: where a merge spells a token
that exists, the state is made anew from the first blocks by replaying the merges.

Every version is a written table: nothing is cached, no lineage grows, and a lost executor
costs the tasks that it ran. Paths are explicit and unique per training, so trainings can run
side by side. All files are deleted at the end, replaced versions as soon as they are.

Results equal canonical one-merge-at-a-time BPE with ties broken by the smallest
``(left id, right id)``, where ids are vocabulary ids (specials, alphabet in code-point
order, then merges in order).
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..options import BPEOptions
from ..session import remove_path, scratch_path, shared_table, ship_package
from . import blocks, kernels
from .model import BPEModel
from .symbols import symbols, weighted_sequences
from .vocab import alphabet_index, full_byte_alphabet, initial_tokens, observed_alphabet

log = logging.getLogger(__name__)

PAIR_DDL = "l int, r int, cnt bigint"

#: Pairs that the driver holds after a full count; twice as many at most before the rarest go.
HOT = 1 << 18
#: Rare pairs' share of all pairs at which sequences are cut at them, and the symbols from
#: which on the pass over all blocks is worth it (the results do not depend on either).
CUT_SHARE = 0.1
CUT_SYMBOLS = 1 << 20
_WORDS = blocks.BUCKETS // 64


def pair_counts(state: DataFrame) -> DataFrame:
    """Weighted adjacent-pair counts of a state table: ``l int, r int, cnt bigint``."""
    partial_counts = state.mapInArrow(kernels.count_pairs, PAIR_DDL)
    return partial_counts.groupBy("l", "r").agg(F.sum("cnt").alias("cnt"))


def top_pairs(counts: DataFrame, n: int, min_count: int = 1, rank_of: list[int] | None = None) -> DataFrame:
    """The ``n`` most frequent pairs, ties by smallest (l, r) (or by ``rank_of[id]``); a
    bounded top-k."""
    kept = counts.where(F.col("cnt") >= min_count)
    if rank_of is None:
        return kept.orderBy(F.desc("cnt"), "l", "r").limit(n)
    ranks = F.from_json(F.lit(json.dumps(rank_of)), "array<int>")
    return kept.orderBy(F.desc("cnt"), F.get(ranks, F.col("l")), F.get(ranks, F.col("r"))).limit(n)


def first_seen_symbols(lines: DataFrame, col: str, opts: BPEOptions, order_by: tuple[str, ...]) -> list[str]:
    """Symbols in order of first appearance, reading rows by ``order_by`` and symbols left to
    right. One pass: the first place of each symbol per row and Arrow batch, then the smallest
    per symbol; the result is bounded by Unicode."""
    if not order_by:
        raise ValueError("tie_break='first_seen' needs the corpus order columns (order_by)")
    text = F.array_join(symbols(F.col(col), opts), "")
    rows = lines.select(*order_by, text.alias("seq"))
    kinds = pa.schema([("sym", pa.string())] + [(c, to_arrow_type(rows.schema[c].dataType)) for c in order_by] + [("pos", pa.int64())])
    ddl = ", ".join(["sym string"] + [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in order_by] + ["pos bigint"])
    places = rows.mapInArrow(partial(kernels.first_positions, order_by=order_by, schema=kinds), ddl)
    packed = packed_place([(c, rows.schema[c].dataType.simpleString()) for c in order_by])
    first = places.groupBy("sym").agg(F.min(F.struct(*order_by, "pos") if packed is None else packed).alias("at"))
    return [r.sym for r in first.orderBy("at").collect()]


def packed_place(order_by: list[tuple[str, str]]) -> Column | None:
    """The order columns and ``pos`` (below 2^30) as one number that sorts as they do, so that
    its least value is a hash aggregate; None where they do not fit into 126 bits."""
    bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
    if any(kind not in bits for _, kind in order_by) or sum(bits[kind] for _, kind in order_by) > 96:
        return None
    number = lambda x: F.lit(Decimal(x)).cast("decimal(38,0)")
    out = number(0)
    for c, kind in order_by:  # null comes first, as in a struct
        value = F.coalesce(F.col(c).cast("decimal(38,0)") + number(2 ** (bits[kind] - 1) + 1), number(0))
        out = (out * number(2 ** bits[kind] + 1) + value).cast("decimal(38,0)")
    return (out * number(2**30) + F.col("pos")).cast("decimal(38,0)")


@dataclass
class Pick:
    l: int
    r: int
    cnt: int
    token: str
    new: bool


def forbidden_pairs(opts: BPEOptions, index: dict[str, int]) -> set[tuple[int, int]]:
    """Pairs whose concatenation would spell a special token: never merged."""
    out = set()
    for s in opts.specials:
        for k in range(1, len(s)):
            a, b = s[:k], s[k:]
            if a in index and b in index:
                out.add((index[a], index[b]))
    return out


def choose_batch(
    top: list[tuple[int, int, int]],
    tokens: list[str],
    index: dict[str, int],
    merge_budget: int,
    vocab_room: int,
    forbidden: set[tuple[int, int]],
) -> list[Pick]:
    """Longest prefix of the sorted candidates that one-at-a-time BPE would also pick next.

    Merging (x, y) changes only the counts of pairs (., x) and (y, .), and every pair it
    creates is at most as frequent as the one it replaces and, holding the largest id,
    loses ties. So while no candidate has its left equal to an earlier pick's right or its
    right equal to an earlier pick's left, the next candidate is still the maximum.
    A pair of one symbol with itself overlaps itself and ends the batch; a pair whose
    string already exists gets an old id (no tie guarantee), so it may only come first
    and also ends the batch.
    """
    picks: list[Pick] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    special_lefts: set[int] = set()
    special_rights: set[int] = set()
    new_strings: set[str] = set()
    for l, r, cnt in top:
        if len(picks) >= merge_budget:
            break
        # Before the test for special tokens: a pair that is never merged itself can still
        # turn into another one when an earlier pick merges one of its symbols.
        if l in rights or r in lefts:
            break
        if (l, r) in forbidden:
            special_lefts.add(l)
            special_rights.add(r)
            continue
        s = tokens[l] + tokens[r]
        if s in index or s in new_strings:
            if not picks:
                picks.append(Pick(l, r, cnt, s, False))
            break
        if len(new_strings) >= vocab_room:
            break
        picks.append(Pick(l, r, cnt, s, True))
        new_strings.add(s)
        lefts.add(l)
        rights.add(r)
        # A self pair, or a pick that turns a pair passed over above (one that would spell a
        # special, at least as frequent as all that follow) into one that may be merged.
        if l == r or r in special_lefts or l in special_rights:
            break
    return picks


def train(
    lines: DataFrame, col: str, opts: BPEOptions, max_batch: int | None = None, order_by: tuple[str, ...] = ()
) -> BPEModel:
    """Learn merges from a table of texts (one symbol sequence per row, or per word).

    ``max_batch`` caps merges per round (1 gives the one-at-a-time loop, for checks);
    ``order_by`` names the corpus order, needed by ``tie_break='first_seen'``.
    """
    spark = lines.sparkSession
    ship_package(spark)
    work = _Work(spark)
    try:
        return _train(lines, col, opts, max_batch, order_by, work)
    finally:
        work.close()


class _Work:
    """Parquet tables of one training, each under its own path in the shared folder."""

    def __init__(self, spark):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        out, path = shared_table(df, f"train-{name}")
        self.paths.append(path)
        return out

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, f"train-{name}"))
        return self.paths[-1]

    def folders(self, path: str, key: str) -> list[int]:
        """The values of a partition column that a written table has."""
        files = self.spark.read.schema(f"{key} int").parquet(path).inputFiles()
        return sorted({int(f.rpartition(f"/{key}=")[2].partition("/")[0]) for f in files if f"/{key}=" in f})

    def close(self, keep: set[str] = frozenset()) -> None:
        """Delete all tables but those in ``keep``."""
        gone, self.paths = [p for p in self.paths if p not in keep], [p for p in self.paths if p in keep]
        for path in gone:
            try:
                remove_path(self.spark, path)
            except Exception:  # noqa: BLE001 - cleanup is best effort
                log.warning("could not remove %s", path)


class HotPairs:
    """The pairs that come first in the order of picks, with counts and buckets.

    ``cut`` is None if all pairs of at least the minimum frequency are held; otherwise every
    pair that is not held comes after ``cut`` (count, left rank, right rank) in that order.
    """

    def __init__(self, table: pa.Table, rank_of: list[int] | None, most: int):
        self.rank_of, self.most = rank_of, most
        self.keys, self.counts, self.buckets = _pair_columns(table)
        self.cut: tuple[int, int, int] | None = None
        order = np.argsort(self.keys)
        self.keys, self.counts, self.buckets = self.keys[order], self.counts[order], self.buckets[order]
        if len(self.keys) > most:
            self._keep_first(most)

    def _order(self, at: np.ndarray) -> np.ndarray:
        """Places ``at`` in the order of picks."""
        left, right = self._ranks(self.keys[at])
        return at[np.lexsort((right, left, -self.counts[at]))]

    def _ranks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = keys >> 32, keys & 0xFFFFFFFF
        if self.rank_of is None:
            return left, right
        ranks = np.array(self.rank_of)
        return ranks[left], ranks[right]

    def _keep_first(self, n: int) -> None:
        order = self._order(np.arange(len(self.keys)))[:n]
        left, right = self._ranks(self.keys[order[-1:]])
        self.cut = (int(self.counts[order[-1]]), int(left[0]), int(right[0]))
        kept = np.sort(order)
        self.keys, self.counts, self.buckets = self.keys[kept], self.counts[kept], self.buckets[kept]

    def first(self, n: int, min_count: int) -> list[tuple[int, int, int]]:
        """The next ``n`` pairs ``(left, right, count)`` that surely come before all others."""
        at = np.flatnonzero(self.counts >= max(min_count, self.cut[0] if self.cut else 0))
        if len(at) > 4 * n:  # with all that are as frequent as the last
            least = np.partition(self.counts[at], len(at) - n)[len(at) - n]
            at = at[self.counts[at] >= least]
        order = self._order(at)[:n]
        out = [(int(k >> 32), int(k & 0xFFFFFFFF), int(c)) for k, c in zip(self.keys[order], self.counts[order])]
        if self.cut:
            ranks = zip(*(x.tolist() for x in self._ranks(self.keys[order])))
            out = [p for p, (left, right) in zip(out, ranks) if (-p[2], left, right) <= (-self.cut[0], *self.cut[1:])]
        return out

    def buckets_of(self, keys: np.ndarray) -> list[int]:
        """Buckets in which one of the pairs may occur."""
        words = np.bitwise_or.reduce(self.buckets[np.searchsorted(self.keys, keys)], axis=0)
        return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")).tolist()

    def change(self, table: pa.Table) -> None:
        """Add signed changes; pairs that are new come in."""
        keys, deltas, where = _pair_columns(table)
        order = np.argsort(keys)
        keys, deltas, where = keys[order], deltas[order], where[order]
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        held = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.counts[at[held]] += deltas[held]
        self.buckets[at[held]] |= where[held]
        new = ~held & (deltas > 0)
        self.keys = np.r_[self.keys, keys[new]]
        self.counts = np.r_[self.counts, deltas[new]]
        self.buckets = np.concatenate((self.buckets, where[new]))
        live = self.counts > 0
        order = np.flatnonzero(live)[np.argsort(self.keys[live])]
        self.keys, self.counts, self.buckets = self.keys[order], self.counts[order], self.buckets[order]
        if len(self.keys) > 2 * self.most:
            self._keep_first(self.most)


def _pair_columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, counts and bucket sets of pairs (the rows with keys that are not negative)."""
    keys, counts = table["k"].to_numpy(), table["d"].to_numpy()
    where = np.stack([table[f"m{i}"].to_numpy() for i in range(_WORDS)], 1).astype(np.int64).view(np.uint64)
    pair = keys >= 0
    return keys[pair].copy(), counts[pair].copy(), where[pair].copy()


class State:
    """The blocks of one training: where each bucket's present version is, and its size."""

    def __init__(self, work: _Work):
        self.work = work
        self.at: dict[int, str] = {}
        self.first: dict[int, str] = {}
        self.symbols: dict[int, int] = {}
        self.pairs: dict[int, int] = {}

    def read(self, at: dict[int, str], buckets: list[int] | None = None, columns: str = "part, ids, lengths, weights") -> DataFrame:
        paths = [f"{at[b]}/bucket={b}" for b in sorted(at if buckets is None else buckets)]
        rows = self.work.spark.read.schema(blocks.BLOCK_DDL.removeprefix("bucket int, "))
        return rows.parquet(*paths).select(*columns.split(", "))

    def write(self, made: DataFrame, replaced: list[int]) -> dict[int, str]:
        """Write new versions of the buckets ``replaced`` (which may become fewer); returns the
        buckets written."""
        path = self.work.path("blocks")
        made.write.partitionBy("bucket").parquet(path)
        new = dict.fromkeys(self.work.folders(path, "bucket"), path)
        for b in replaced:
            self.at.pop(b, None)
            self.symbols.pop(b, None)
            self.pairs.pop(b, None)
        self.at |= new
        self.first = self.first or dict(self.at)
        self.work.close(keep={*self.at.values(), *self.first.values()})
        return new

    def sizes(self, table: pa.Table) -> None:
        """Note the sizes that blocks have reported."""
        for k, d in zip(table["k"].to_pylist(), table["d"].to_pylist()):
            if k < 0:
                (self.symbols if k % 2 else self.pairs)[(-1 - k) // 2] = d


def sum_changes(rows: DataFrame) -> DataFrame:
    """Changes (or counts) by pair: ``k, d`` and the buckets they came from, ``m0`` to ``m3``."""
    words = [f"bit_or(if(part div 64 = {i}, shiftleft(1L, part % 64), 0L)) AS m{i}" for i in range(_WORDS)]
    return rows.selectExpr("part", "inline(arrays_zip(keys, deltas)) AS (k, d)").groupBy("k").agg(*map(F.expr, ["sum(d) AS d", *words]))


def _hot_pairs(summed: DataFrame, state: State, min_count: int, rank_of: list[int] | None) -> HotPairs:
    """The first ``HOT`` pairs in the order of picks, and the sizes; a bounded top-k."""
    order = ["k"]
    if rank_of is not None:
        ranks = F.from_json(F.lit(json.dumps(rank_of)), "array<int>")
        order = [F.get(ranks, F.expr("CAST(shiftright(k, 32) AS INT)")), F.get(ranks, F.expr("CAST(k & 4294967295L AS INT)"))]
    bound = HOT + 1 + 2 * blocks.BUCKETS  # the sizes come first
    top = summed.where(f"k < 0 OR d >= {min_count}").orderBy(F.expr("k >= 0"), F.desc("d"), *order).limit(bound).toArrow()
    state.sizes(top)
    return HotPairs(top, rank_of, HOT)


def _train(lines: DataFrame, col: str, opts: BPEOptions, max_batch: int | None, order_by: tuple[str, ...], work: _Work) -> BPEModel:
    # The distinct sequences are the output of the only pass over the corpus.
    seqs = work.write(weighted_sequences(lines, col, opts), "sequences")
    alphabet = full_byte_alphabet() if opts.is_bytes and opts.alphabet == "full256" else observed_alphabet(seqs)
    tokens = initial_tokens(opts, alphabet)
    index: dict[str, int] = {}
    for i, t in enumerate(tokens):
        index.setdefault(t, i)
    rank_of: list[int] | None = None
    if opts.tie_break == "first_seen":
        seen = {s: k for k, s in enumerate(first_seen_symbols(lines, col, opts, order_by))}
        rank_of = [seen.get(t, -1) for t in tokens]
        next_rank = len(seen)
    n_alphabet = len(tokens) - len(dict.fromkeys(opts.specials))
    vocab_size = len(index)
    model = BPEModel(options=opts, tokens=tokens, merges=[], n_alphabet=n_alphabet)
    if opts.max_merges == 0 or vocab_size >= opts.target_vocabulary_size:
        return model

    min_count, forbidden = opts.min_frequency, partial(forbidden_pairs, opts, index)
    n_top = max(opts.batch_candidates, 2 * sum(len(s) for s in opts.specials) + 2)
    state = State(work)
    code_points, ids = alphabet_index(tokens)
    packed = seqs.select("seq", "weight").mapInArrow(partial(blocks.pack_text, code_points=code_points, ids=ids), blocks.BLOCK_DDL)
    state.write(packed, [])
    if not state.at:
        return model
    hot = _hot_pairs(sum_changes(state.read(state.at, columns="part, keys, deltas")), state, min_count, rank_of)

    def anew(rows: DataFrame) -> HotPairs:
        """Replace all blocks and count them."""
        state.write(rows, list(state.at))
        return _hot_pairs(sum_changes(state.read(state.at, columns="part, keys, deltas")), state, min_count, rank_of) if state.at else hot

    rounds: list[tuple[np.ndarray, np.ndarray]] = []
    was_cut = False
    while state.at:
        budget = opts.max_merges - len(model.merges) if opts.max_merges is not None else 1 << 62
        vocab_room = opts.target_vocabulary_size - vocab_size
        if budget <= 0 or vocab_room <= 0:
            break
        # Pairs that can never merge any more, once they are enough to be worth a pass.
        rare = sum(state.pairs.values()) - int(hot.counts[hot.counts >= min_count].sum())
        if hot.cut is None and rare > CUT_SHARE * sum(state.pairs.values()) and sum(state.symbols.values()) >= CUT_SYMBOLS:
            live = hot.keys[hot.counts >= min_count]
            before = sum(state.symbols.values())
            pieces = state.read(state.at).mapInArrow(partial(blocks.pieces, live=live), "seq binary, weight bigint")
            hot = anew(pieces.groupBy("seq").agg(F.sum("weight").alias("weight")).mapInArrow(blocks.pack_ids, blocks.BLOCK_DDL))
            was_cut = True
            model.trace.append({"round": len(rounds), "step": "cut", "symbols_before": before, "symbols": sum(state.symbols.values())})
        picks = choose_batch(hot.first(n_top, min_count), tokens, index, min(budget, max_batch or budget), vocab_room, forbidden())
        if not picks and hot.cut is not None:
            hot = _hot_pairs(sum_changes(state.read(state.at).mapInArrow(blocks.count, blocks.COUNTS_DDL)), state, min_count, rank_of)
            model.trace.append({"round": len(rounds), "step": "count", "symbols": sum(state.symbols.values())})
            picks = choose_batch(hot.first(n_top, min_count), tokens, index, min(budget, max_batch or budget), vocab_room, forbidden())
        if not picks:
            break
        for p in picks:
            if p.new:
                index[p.token] = len(tokens)
                tokens.append(p.token)
                vocab_size += 1
                if rank_of is not None:
                    rank_of.append(next_rank)
                    next_rank += 1
            model.merges.append((tokens[p.l], tokens[p.r]))
            model.counts.append(int(p.cnt))
            model.vocab_sizes.append(vocab_size)
            if opts.progress_every and len(model.merges) % opts.progress_every == 0:
                log.info("%d merges after %d rounds, %d tokens", len(model.merges), len(rounds) + 1, vocab_size)
        keys = np.array([(p.l << 32) | p.r for p in picks], dtype=np.int64)
        new_ids = np.array([index[p.token] for p in picks], dtype=np.int32)
        order = np.argsort(keys)
        batch_keys, new_ids = keys[order], new_ids[order]
        rounds.append((batch_keys, new_ids))
        if not picks[0].new and was_cut:
            # A second way to a token: the cuts are no longer known to be right.
            first = state.read(state.first)
            hot, was_cut = anew(first.mapInArrow(partial(blocks.replay, rounds=rounds), blocks.BLOCK_DDL)), False
            model.trace.append({"round": len(rounds), "step": "replay", "symbols": sum(state.symbols.values())})
            continue
        touched = [b for b in hot.buckets_of(keys) if b in state.at]
        model.trace.append(
            {"round": len(rounds), "step": "merge", "merges": len(picks), "buckets_read": len(touched), "buckets": len(state.at)}
            | {"symbols_read": sum(state.symbols[b] for b in touched), "symbols": sum(state.symbols.values())}
        )
        fn = partial(blocks.step, batch_keys=batch_keys, new_ids=new_ids, known=hot.keys)
        written = state.write(state.read(state.at, touched).mapInArrow(fn, blocks.BLOCK_DDL), touched)
        if not picks[0].new:  # pairs of a token that exists may have become more frequent
            hot = _hot_pairs(sum_changes(state.read(state.at).mapInArrow(blocks.count, blocks.COUNTS_DDL)), state, min_count, rank_of)
            continue
        least = hot.cut[0] if hot.cut else min_count
        summed = sum_changes(state.read(written, columns="part, keys, deltas"))
        changed = summed.where(f"k < 0 OR d < 0 OR d >= {least}").toArrow()
        state.sizes(changed)
        hot.change(changed)
    model.rounds = len(rounds)
    return BPEModel(**{f: getattr(model, f) for f in model.__dataclass_fields__})
