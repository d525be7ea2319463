"""Brute-force canonical BPE for tests: one merge per step, full recount every step.

Deliberately naive (no batching, no Spark): the distributed trainer must agree with it.
"""

from __future__ import annotations

from collections import Counter


def merge_left_to_right(seq: list[int], l: int, r: int, new: int) -> list[int]:
    out: list[int] = []
    i = 0
    while i < len(seq):
        if i + 1 < len(seq) and seq[i] == l and seq[i + 1] == r:
            out.append(new)
            i += 2
        else:
            out.append(seq[i])
            i += 1
    return out


def train_reference(sequences: list[list[str]], specials, target: int, min_freq: int, max_merges, first_seen=False):
    """``sequences``: symbol lists in corpus order (repeats allowed). Returns (tokens,
    merges, counts). ``first_seen`` breaks ties by first appearance instead of id."""
    tokens = list(dict.fromkeys(specials))
    alphabet = sorted({s for seq in sequences for s in seq} - set(tokens))
    tokens += alphabet
    index = {t: i for i, t in enumerate(tokens)}
    order = {}
    for seq in sequences:
        for sym in seq:
            order.setdefault(sym, len(order))
    weighted = Counter(tuple(index[s] for s in seq) for seq in sequences if seq)
    seqs = [(list(k), w) for k, w in weighted.items()]
    merges: list[tuple[str, str]] = []
    counts: list[int] = []
    min_freq = max(1, min_freq)
    while True:
        if max_merges is not None and len(merges) >= max_merges:
            break
        if len(index) >= target:
            break
        pc: Counter = Counter()
        for seq, w in seqs:
            for a, b in zip(seq, seq[1:]):
                pc[(a, b)] += w
        forbidden = set()
        for s in specials:
            for k in range(1, len(s)):
                if s[:k] in index and s[k:] in index:
                    forbidden.add((index[s[:k]], index[s[k:]]))
        if first_seen:
            rank = lambda i: order[tokens[i]]
            cands = [(-c, rank(p[0]), rank(p[1]), p) for p, c in pc.items() if c >= min_freq and p not in forbidden]
        else:
            cands = [(-c, p[0], p[1], p) for p, c in pc.items() if c >= min_freq and p not in forbidden]
        if not cands:
            break
        negc, _, _, (l, r) = min(cands)
        s = tokens[l] + tokens[r]
        if s not in index:
            index[s] = len(tokens)
            tokens.append(s)
            order.setdefault(s, len(order))
        new = index[s]
        merges.append((tokens[l], tokens[r]))
        counts.append(-negc)
        seqs = [(merge_left_to_right(seq, l, r, new), w) for seq, w in seqs]
    return tokens, merges, counts


def scan_encode(symbols: list[str], merge_set: set[tuple[str, str]]) -> list[str]:
    """Scan order from its rule: the symbols read so far never end in a pair that merges.

    Written as a recursion on the prefix: append the next symbol, then shrink the end."""

    def shrink(done: tuple[str, ...]) -> tuple[str, ...]:
        return shrink((*done[:-2], done[-2] + done[-1])) if done[-2:] in merge_set else done

    done: tuple[str, ...] = ()
    for symbol in symbols:
        done = shrink((*done, symbol))
    return list(done)


def rank_encode(symbols: list[str], merges: list[tuple[str, str]]) -> list[str]:
    """Replay merges in rank order, each over all occurrences left to right."""
    seq = symbols[:]
    for l, r in merges:
        out = []
        i = 0
        while i < len(seq):
            if i + 1 < len(seq) and seq[i] == l and seq[i + 1] == r:
                out.append(l + r)
                i += 2
            else:
                out.append(seq[i])
                i += 1
        seq = out
    return seq
