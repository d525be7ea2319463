"""Prefix trie against brute force, and the tree's layouts."""

import hashlib
import random

from pyspark.sql import functions as F

from subword_spark.llm import common, prefix_trie, queries
from subword_spark.llm.prefix_trie import Direct, Indexed, RadixTree, Sparse, trie_nodes, turn_sequences, walk


def brute(convs):
    """Nodes of {id: list of (turn, size)} by the definition."""
    members, ends = {}, {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    kids = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    out = []
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        saved = sum((len(members[x]) - 1) * x[-1][1] for x in below if x)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), len(kids.get(k, [])), sum(x not in kids for x in below), saved, digest))
    return sorted(out, key=str)


def rows_of(nodes):
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def random_convs(seed, n=120, turns=5, longest=6):
    rng = random.Random(seed)
    sizes = [rng.randint(0, 9) for _ in range(turns)]
    ids = [t * 0x0101 if t % 2 else t << 40 for t in range(turns)]
    return {rng.randint(-50, 10**12): [(ids[t], sizes[t]) for t in (rng.randrange(turns) for _ in range(rng.randint(0, longest)))] for _ in range(n)}


def sequences(spark, convs):
    rows = [(c, [{"id": t, "chars": n} for t, n in s]) for c, s in convs.items()]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<id: long, chars: int>>")


def test_layouts_grow():
    rng = random.Random(0)
    order = rng.sample(range(256), 256)
    layout, kinds = Sparse(), {}
    for i, b in enumerate(order):
        layout = layout.add(b, b)
        kinds[i + 1] = (type(layout), getattr(layout, "limit", None))
        assert [k for k, _ in layout.items()] == sorted(order[: i + 1])
        assert all(layout.find(x) == x for x in order[: i + 1]) and (i == 255 or layout.find(order[i + 1]) is None)
    assert [kinds[n] for n in (4, 5, 16, 17, 48, 49, 256)] == [(Sparse, 4), (Sparse, 16), (Sparse, 16), (Indexed, None), (Indexed, None), (Direct, None), (Direct, None)]


def test_tree_counts_every_prefix():
    rng = random.Random(1)
    keys = {bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(0, 12))) for _ in range(400)}
    tree = RadixTree()
    for i, k in enumerate(sorted(keys, key=lambda _: rng.random())):
        tree.insert(k, 1, i)
    got = {}
    for key, _, depth, n, *_ in walk(tree, dict.fromkeys(range(256), 1), None, None, width=1):
        got[key] = (depth, n)
    want = {}
    for k in keys:
        for d in range(len(k) + 1):
            x = hashlib.sha256(k[:d]).digest()
            want[x] = (d, want.get(x, (d, 0))[1] + 1)
    assert got == want


def test_nodes_equal_brute_force(spark):
    convs = random_convs(2)
    assert rows_of(trie_nodes(sequences(spark, convs))) == brute(convs)
    long = {1: [(7, 2)] * 300, 2: [(7, 2)] * 200 + [(8, 1)], 3: []}
    assert rows_of(trie_nodes(sequences(spark, long))) == brute(long)
    assert trie_nodes(sequences(spark, {})).count() == 0
    common.release()


def test_parts_share_nodes(spark, monkeypatch):
    """Many small parts: shared nodes, keys that end at a part's border, a hot first turn."""
    monkeypatch.setattr(prefix_trie, "PART_BYTES", 900)
    for seed in (3, 4):
        convs = random_convs(seed, n=250, turns=3)
        convs = {c: [(t, t % 7) for t, _ in s] for c, s in convs.items()}
        convs |= {10**6 + i: [(0x0101, 0x0101 % 7), (1000 + i % 40, (1000 + i % 40) % 7)] for i in range(150)}
        assert rows_of(trie_nodes(sequences(spark, convs))) == brute(convs)
    common.release()


def test_turns_ties_nulls_and_clashing_columns(spark):
    rows = [
        (1, 0, "user", "a", 5),
        (1, None, None, None, 5),
        (1, 0, "user", "a", 5),
        (1, 0, "assistant", "b", 5),
        (2, 3, "", "", 6),
        (2, 4, "assistant", "b", 6),
        (None, 0, "user", "x", 7),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, id int").withColumn("turns", F.lit(1)).withColumn("key", F.lit("k"))
    got = {r.conv_id: [(t.id, t.chars) for t in r.turns] for r in turn_sequences(df).collect()}
    empty, b, a = got[1][0], got[1][1], got[1][2]
    assert got[1] == [empty, b, a, a] and got[2] == [empty, b] and len({empty, a, b}) == 3
    assert [x[1] for x in (empty, a, b)] == [0, 1, 1] and empty[0] < b[0] < a[0]
    assert prefix_trie.prefix_trie(df).count() == 5
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    common.release()


def test_rebuilt_shares_heads(spark):
    convs = {c: [(c * 10 + i, 1) for i in range(n)] for c, n in ((100, 3), (101, 6), (105, 1), (199, 0), (205, 4), (-5, 4))}
    import zlib

    want = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        want[c] = convs.get(base, [])[:h] + own[h:]
    got = {r.conv_id: [(t.id, t.chars) for t in r.turns] for r in queries.rebuilt(sequences(spark, convs)).collect()}
    assert got == want
