"""Prefix trie of conversations in adaptive radix trees.

A conversation is a sequence of turns, and a turn is a role and a text. Distinct turns are
numbered in their order; a conversation becomes a key: its turns' numbers as big-endian 8-byte
integers, one after another. Conversations with equal turns are one key (counted and reduced
to their smallest id before any shuffle of keys).

Keys are dealt by range into parts of bounded size. Each part is built into an adaptive radix
tree: inner nodes grow through layouts of 4, 16, 48 and 256 children, and bytes that only one
way leads through are kept as a node's prefix (path compression). A walk over the tree emits a
trie node at each turn-aligned byte depth, also inside a prefix, with the sums of its subtree.

Two parts share only the nodes on the path between the last key of one and the first of the
next. Each part knows these two neighbours, so that a shared node's row from each part is a
true share of its sums: the part that does not hold its first key counts it as no new node,
and a key that the next part goes on is no leaf. One small aggregation adds the shares up. So
a first turn that a third of all conversations have is split like any other range of keys.

The ids of conversations that end in a node are sorted by range, joined into strings and then
hashed one string after another, so no node's ids are ever in memory together.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, table

WIDTH = 8
PART_BYTES = 8 << 20
_BATCH = 20_000


class Sparse:
    """Layouts of up to 4 and up to 16 children: sorted bytes beside the children."""

    __slots__ = ("keys", "kids", "limit")

    def __init__(self, limit: int = 4):
        self.keys, self.kids, self.limit = bytearray(), [], limit

    def find(self, byte: int):
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def add(self, byte: int, child):
        """Add a child; returns the layout that holds all children now."""
        if len(self.keys) == self.limit:
            return self.grown().add(byte, child)
        at = bisect.bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, child)
        return self

    def grown(self):
        out = Sparse(16) if self.limit == 4 else Indexed()
        for byte, child in self.items():
            out.add(byte, child)
        return out

    def items(self):
        return zip(self.keys, self.kids)


class Indexed:
    """Layout of up to 48 children: an index of 256 bytes into a list of children."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def find(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def add(self, byte: int, child):
        if len(self.kids) == 48:
            out = Direct()
            for b, c in self.items():
                out.add(b, c)
            return out.add(byte, child)
        self.kids.append(child)
        self.index[byte] = len(self.kids)
        return self

    def items(self):
        return ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """Layout of 256 children."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def find(self, byte: int):
        return self.kids[byte]

    def add(self, byte: int, child):
        self.kids[byte] = child
        return self

    def items(self):
        return ((b, c) for b, c in enumerate(self.kids) if c is not None)


class Node:
    """``prefix``: the bytes below the parent's branch that all keys here share. ``n, low``:
    members and smallest member of all keys here. ``ends``: members of the key that ends here."""

    __slots__ = ("prefix", "children", "n", "low", "ends")

    def __init__(self, prefix: bytes, n: int, low: int, ends: int):
        self.prefix, self.n, self.low, self.ends = prefix, n, low, ends
        self.children = None

    def link(self, byte: int, child: Node) -> None:
        self.children = (self.children or Sparse()).add(byte, child)


class RadixTree:
    """An adaptive radix tree over byte strings of any length, each with a count and an id."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, n: int, low: int) -> None:
        if self.root is None:
            self.root = Node(key, n, low, n)
            return
        node, at = self.root, 0
        while True:
            prefix = node.prefix
            same = len(prefix) if key.startswith(prefix, at) else _common(prefix, key[at : at + len(prefix)])
            if same < len(prefix):  # split the compressed path
                below = Node(prefix[same + 1 :], node.n, node.low, node.ends)
                below.children = node.children
                node.prefix, node.ends, node.children = prefix[:same], 0, None
                node.link(prefix[same], below)
            node.n += n
            node.low = min(node.low, low)
            at += same
            if at == len(key):
                node.ends += n
                return
            child = node.children.find(key[at]) if node.children else None
            if child is None:
                node.link(key[at], Node(key[at + 1 :], n, low, n))
                return
            node, at = child, at + 1


def _common(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


class _Open:
    """A trie node while its subtree is walked."""

    __slots__ = ("hash", "n", "low", "ends", "chars", "old", "more", "children", "leaves", "saved", "digest")

    def __init__(self, hash_, node: Node, chars: int, old: bool, more: bool):
        self.hash, self.n, self.low, self.chars, self.old, self.more = hash_, node.n, node.low, chars, old, more
        self.ends = self.children = self.leaves = self.saved = 0
        self.digest = hash_.digest()


def walk(tree: RadixTree, chars: dict[int, int], before: bytes | None, after: bytes | None, width: int = WIDTH) -> Iterator[tuple]:
    """Trie nodes of a tree, children first: ``(key, parent, depth, n, low, ends, children,
    leaves, saved, shared, parent_low)``.

    ``chars``: code points of each turn's text. ``before, after``: the neighbouring parts' last
    and first key. A node that they share is marked, and its row is this part's share of it;
    ``parent_low`` is null where the parent is shared.
    """
    if tree.root is None:
        return
    path = bytearray()
    open_: list[_Open] = []

    def enter(node: Node, head: bytes) -> int:
        """Open the trie nodes that this tree node passes; returns how many."""
        span = head + node.prefix
        start = len(path)
        path.extend(span)
        count = 0
        at = 0 if not open_ else (start // width + 1) * width
        while at <= len(path):
            if not open_:
                hash_, size = hashlib.sha256(), 0
            else:
                hash_, turn = open_[-1].hash.copy(), bytes(path[at - width : at])
                hash_.update(turn)
                size = chars[int.from_bytes(turn, "big")]
            here = bytes(path[max(0, at - width) : at])
            old = before is not None and (not open_ or open_[-1].old and before[max(0, at - width) : at] == here)
            more = after is not None and (not open_ or open_[-1].more and after[max(0, at - width) : at] == here)
            open_.append(_Open(hash_, node, size, old, more))
            at += width
            count += 1
        if node.ends:
            open_[-1].ends = node.ends
        return count

    def leave(count: int) -> Iterator[tuple]:
        for _ in range(count):
            x = open_.pop()
            depth = len(open_)
            if not x.leaves and not x.more:  # no key goes on from here, in this part or the next
                x.leaves = 1
            x.saved += (x.n - (not x.old)) * x.chars
            up = open_[-1] if open_ else None
            if up:
                up.children += not x.old
                up.leaves += x.leaves
                up.saved += x.saved
            parent_low = None if up is None or up.old or up.more else up.low
            yield (x.digest, up.digest if up else None, depth, x.n, x.low, x.ends, x.children, x.leaves, x.saved, x.old or x.more, parent_low)

    def kids(node: Node):
        return iter(node.children.items()) if node.children else iter(())

    stack = [(kids(tree.root), enter(tree.root, b""), 0)]
    while stack:
        rest, count, size = stack[-1]
        found = next(rest, None)
        if found is None:
            yield from leave(count)
            del path[size:]
            stack.pop()
        else:
            byte, child = found
            size = len(path)
            stack.append((kids(child), enter(child, bytes([byte])), size))


NODE_DDL = "key binary, parent binary, depth long, n long, low long, ends long, children long, leaves long, saved long, shared boolean, parent_low long"
_NODE = pa.schema(
    [("key", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "n", "low", "ends", "children", "leaves", "saved")]
    + [("shared", pa.bool_()), ("parent_low", pa.int64())]
)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the parts of a task, one after another. Rows come by part; ``kind`` 1 is a key,
    0 and 2 are the neighbours."""
    tree, chars, beside, part = RadixTree(), {}, {}, None

    def close() -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in walk(tree, chars, beside.get(0), beside.get(2)):
            rows.append(row)
            if len(rows) == _BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    for batch in batches:
        for own, kind, key, sizes, n, low in zip(*(batch[c].to_pylist() for c in ("part", "kind", "key", "chars", "n", "low"))):
            if own != part:
                yield from close()
                tree, chars, beside, part = RadixTree(), {}, {}, own
            if kind != 1:
                beside[kind] = key
                continue
            tree.insert(key, n, low)
            for at, size in enumerate(sizes):
                chars[int.from_bytes(key[at * WIDTH : (at + 1) * WIDTH], "big")] = size
    yield from close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE)], schema=_NODE)


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) rows to strings: one for each key in a batch."""
    for batch in batches:
        out: list[tuple[bytes, int, list[str]]] = []
        for key, conv in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if not out or out[-1][0] != key:
                out.append((key, conv, []))
            out[-1][2].append(str(conv))
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array([k for k, _, _ in out], pa.binary()), "first": pa.array([i for _, i, _ in out], pa.int64()), "ids": pa.array([",".join(x) for _, _, x in out], pa.string())}
        )


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings by (key, first) to one digest for each key; the open key goes on over batches."""
    key, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for own, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if own != key:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(done)
    if state:
        yield _digests([(key, state.hexdigest())])


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in done], pa.binary()), "ends_sha256": pa.array([d for _, d in done], pa.string())})


def turn_sequences(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations as numbered turns: ``conv_id`` (long), ``turns`` (array of a turn's number
    and ``chars``, the code points of its text).

    Equal numbers are equal turns, and numbers go by role, then text. Turns go by their turn
    value, null first; rows with the same value by role, then text; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without a conversation id belong to no
    conversation and are left out.
    """
    prepare(rows.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    turns = rows.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), text.alias("text")
    )
    ordered = turns.select("role", "text").distinct().repartitionByRange("role", "text").sortWithinPartitions("role", "text")
    numbers = table(ordered.select("role", "text", F.monotonically_increasing_id().alias("id"), F.length("text").alias("chars")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), "id", "chars")
    known = turns.join(numbers, ["role", "text"]).groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("turns"))
    return known.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """The prefix trie of ``sequences(conv_id, turns)``, one row per conversation, as made by
    :func:`turn_sequences`.

    Returns for each distinct sequence of first turns, the empty one included: ``conv_id`` (the
    smallest member), ``depth, parent_conv_id`` (the parent's smallest member; null for the
    root), ``n_convs`` (members), ``n_children, n_leaves`` (childless nodes of its subtree),
    ``saved_tokens`` (summed over its subtree: members beyond the first times the code points
    of the last text), ``ends_sha256`` (hex digest of the ids of members that end here,
    ascending, comma-joined). Without conversations there are no nodes.
    """
    spark = sequences.sparkSession
    prepare(spark)
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t["id"]), 2 * WIDTH, "0")), ""))
    keyed = table(sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars")), "keys")
    distinct = table(keyed.groupBy("key").agg(F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("low")), "distinct")
    size = distinct.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    parts = table(distinct.repartitionByRange(max(1, -(-size // PART_BYTES)), "key").withColumn("part", F.spark_partition_id()), "parts")

    # One row per part: its neighbours' nearest keys.
    order = Window.orderBy("part")
    ranges = parts.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).select("part", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after"))

    def beside(kind: int, col: str) -> DataFrame:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("chars", "array<int>"), ("n", "long"), ("low", "long"))]
        return ranges.where(F.col(col).isNotNull()).select("part", F.lit(kind).alias("kind"), F.col(col).alias("key"), *nothing)

    rows = parts.select("part", F.lit(1).alias("kind"), "key", "chars", "n", "low").union(beside(0, "before")).union(beside(2, "after"))
    nodes = table(rows.repartition("part").sortWithinPartitions("part").mapInArrow(_build, NODE_DDL), "nodes")

    sums = [F.sum(c).alias(c) for c in ("n", "ends", "children", "leaves", "saved")]
    shared = table(nodes.where("shared").groupBy("key", "parent", "depth").agg(F.min("low").alias("low"), *sums), "shared")
    columns = ["key", "parent", "depth", "n", "low", "ends", "children", "leaves", "saved", "parent_low"]
    whole = nodes.where("NOT shared").select(columns).unionByName(shared.withColumn("parent_low", F.lit(None).cast("long")).select(columns))
    # Parents that parts share are few; their other children know their parent already.
    lows = shared.select(F.col("key").alias("parent"), F.col("low").alias("shared_low"))
    here = whole.where("parent_low IS NULL AND parent IS NOT NULL").join(lows, "parent", "left").withColumn("parent_low", F.col("shared_low")).select(columns)
    whole = here.unionByName(whole.where("parent_low IS NOT NULL OR parent IS NULL").select(columns))

    members = keyed.select(F.unhex(F.sha2("key", 256)).alias("key"), "conv_id")
    joined = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_join_ids, "key binary, first long, ids string")
    digests = joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_ids, "key binary, ends_sha256 string")
    nobody = hashlib.sha256(b"").hexdigest()
    out = whole.where("ends > 0").join(digests, "key").select(*columns, "ends_sha256").unionByName(whole.where("ends = 0").withColumn("ends_sha256", F.lit(nobody)))
    return out.select(
        F.col("low").alias("conv_id"),
        "depth",
        F.col("parent_low").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of a table of turns: :func:`trie_nodes` of :func:`turn_sequences`.

    Empty table: no nodes. Other input columns are never read by name. A conversation is one
    key, so the longest one bounds a task's memory.
    """
    return trie_nodes(turn_sequences(rows, conv_col, turn_col, role_col, text_col))
