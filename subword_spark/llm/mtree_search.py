"""Exact top-k by inner product with an M-tree of paged metric nodes.

Inner product to metric: with R the largest norm, each candidate v gets one more component
sqrt(R^2 - |v|^2) and each query a 0; then |q - v|^2 = |q|^2 + R^2 - 2 <q, v>, so the highest
products are the nearest points and the triangle inequality holds.

Build. Points are distinct vectors with their smallest k+1 ids (no further copy of a vector
can be among the k best). A bounded set of pivots cuts them into regions and a hash cuts large
regions into shards of bounded size. Each shard is bulk-loaded into an M-tree: a page holds at
most ``page`` entries; a routing entry has a centre, its covering radius, its distance to the
centre of its own page (the parent distance) and a child page; a leaf entry has a vector and
its parent distance. Pages are rows of a table in the shared folder.

Search. Each pair of a shard and a block of queries is a group of its own, so a group holds
one shard's pages and about ``BLOCK`` queries, however many queries there are. First each query
searches a shard of its own region, which gives it a k-th best score; then it searches all
other shards with that bound. Queries go to every shard and pages to every block, so the rows
moved are queries times shards and pages times blocks; blocks are half as large as shards to
keep the two alike.
Within a shard pages are taken best first, by the least distance a page can hold. An entry is
passed over without computing its distance if the stored parent distance and the query's
distance to the parent already put it beyond the bound.

Scores are integers and are computed exactly, with Python integers where a sum may pass 64
bits; distances only decide what is passed over, with a margin for rounding that follows the
norms. An answer whose score is beyond 64 bits is an error, as it is in SQL.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, table

PIVOTS = 16
SHARD = 32_768
PAGE = 256
FAN = 16
#: Queries that meet a shard in one group.
BLOCK = 16_384
_MARGIN = 1e-6
_WORD = 1 << 63

_PAGES = "shard long, page int, leaf boolean, centre binary, vectors binary, parent_distance binary, radius binary, child binary, ids binary, id_count binary"


def _lifted(v: np.ndarray, r2: float) -> np.ndarray:
    v = v.astype(np.float64)
    return np.hstack([v, np.sqrt(np.maximum(r2 - (v * v).sum(1), 0))[:, None]])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a to one point b."""
    return np.sqrt(((a - b) ** 2).sum(1))


class _Loader:
    """Bulk loading of one shard. Pages come out as rows, the root as page 0."""

    def __init__(self, vectors: np.ndarray, r2: float):
        self.v = _lifted(vectors, r2)
        self.pages: list[dict] = []

    def load(self, index: np.ndarray, centre: np.ndarray) -> tuple[int, float]:
        """Put the points in pages below one page: ``(page, covering radius around centre)``."""
        number = len(self.pages)
        self.pages.append({})
        far = _distance(self.v[index], centre)
        if len(index) <= PAGE:
            self.pages[number] = {"leaf": True, "centre": centre, "index": index, "parent": far, "radius": np.zeros(0), "child": np.zeros(0, np.int32)}
            return number, float(far.max(initial=0))
        m = min(FAN, -(-len(index) // PAGE))
        pivots = self.v[index[np.linspace(0, len(index) - 1, m).astype(int)]]
        near = np.argmin(((self.v[index] ** 2).sum(1)[:, None] - 2 * self.v[index] @ pivots.T + (pivots**2).sum(1)[None]), 1)
        parts = [index[near == j] for j in range(m)]
        if max(map(len, parts)) > 0.9 * len(index):  # pivots that do not part the points
            parts = np.array_split(index, m)
        parts = [p for p in parts if len(p)]
        centres = np.array([self.v[p[0]] for p in parts])
        below = [self.load(p, c) for p, c in zip(parts, centres)]
        self.pages[number] = {
            "leaf": False,
            "centre": centre,
            "vectors": centres,
            "parent": _distance(centres, centre),
            "radius": np.array([r for _, r in below]),
            "child": np.array([n for n, _ in below], np.int32),
        }
        return number, float(far.max(initial=0))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles or int64 where these hold every sum, else as Python integers."""
    most = _largest(a) * _largest(b) * a.shape[-1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if most < _WORD else a.astype(object) @ b.T.astype(object)


def _largest(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


class _Tree:
    def __init__(self, rows: pd.DataFrame, dim: int, kind: type = np.int32):
        self.pages = {}
        for r in rows.itertuples():
            width = dim if r.leaf else dim + 1
            v = np.frombuffer(r.vectors, kind if r.leaf else np.float64).reshape(-1, width)
            count = np.frombuffer(r.id_count, np.int32)
            self.pages[r.page] = (
                r.leaf,
                np.frombuffer(r.centre, np.float64),
                v.astype(np.int64) if r.leaf else v,
                np.frombuffer(r.parent_distance, np.float64),
                np.frombuffer(r.radius, np.float64),
                np.frombuffer(r.child, np.int32),
                np.frombuffer(r.ids, np.int64),
                np.r_[0, np.cumsum(count)],
            )

    def search(self, query: np.ndarray, own: int, k: int, r2: float, bound: int | None) -> list[tuple[int, int]]:
        """The best ``(score, id)`` of this shard that can be among the k best overall."""
        q = query.astype(np.float64)
        q2 = float(q @ q)
        margin = _MARGIN * (1 + np.sqrt(q2 + r2))
        lifted = np.append(q, 0.0)
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first

        def reach() -> float:
            """The distance beyond which nothing counts."""
            s = best[0][0] if len(best) == k else None
            s = bound if s is None else s if bound is None else max(s, bound)
            return np.inf if s is None else np.sqrt(max(q2 + r2 - 2.0 * s, 0)) + margin

        root = self.pages[0]
        heap = [(0.0, 0, float(np.sqrt(((lifted - root[1]) ** 2).sum())))]
        while heap:
            least, page, to_centre = heapq.heappop(heap)
            if least > reach():
                break
            leaf, _, v, parent, radius, child, ids, at = self.pages[page]
            limit = reach()
            open_ = np.flatnonzero(np.abs(to_centre - parent) - (0 if leaf else radius) <= limit)
            if not len(open_):
                continue
            if not leaf:
                far = _distance(v[open_], lifted)
                low = np.maximum(far - radius[open_], 0)
                for i in np.flatnonzero(low <= limit):
                    heapq.heappush(heap, (float(low[i]), int(child[open_[i]]), float(far[i])))
                continue
            score = _dot(v[open_], query[None, :])[:, 0]
            for i in np.argsort(-score, kind="stable"):
                s = int(score[i])
                if (bound is not None and s < bound) or (len(best) == k and s < best[0][0]):
                    break
                for d in ids[at[open_[i]] : at[open_[i] + 1]].tolist():
                    if d == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -d))
                    elif (s, -d) > best[0]:
                        heapq.heapreplace(best, (s, -d))
        return [(s, -d) for s, d in best]


def quantize(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256) -> DataFrame:
    """``id, v``: each component x as floor(scale * x), of x as a double.

    Null ids and vectors, and vectors with a null or non-finite component, are left out; no
    other. A scaled component beyond 64 bits is an error, as it is in SQL.
    """

    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(_WORD), F.floor(y)).otherwise(F.raise_error(F.lit("a scaled component is beyond 64 bits")))

    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    known = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return known.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), whole).cast("array<bigint>").alias("v"))


def top_k(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k highest integer inner products of each query: ``query_id, rank, id, score``.

    ``points`` and ``queries``: ``id`` (long), ``v`` (array<bigint>). A query's own id is no
    candidate; ties go to the smaller id. Vectors of other lengths than the longest count as
    filled up with zeros. Rows with the same id and vector count once; an id with several
    vectors counts with each. No rows: no result.
    """
    prepare(points.sparkSession)
    most = F.greatest(F.max(F.array_max("v")), -F.min(F.array_min("v")).cast("decimal(20,0)"))
    dim, r2, largest = points.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), most).first()
    if dim is None:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    kind = np.int32 if (largest or 0) < 1 << 31 else np.int64  # of the vectors in pages

    def filled(df: DataFrame) -> DataFrame:
        return df.select("id", F.concat(F.col("v").cast("array<bigint>"), F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(dim) - F.size("v"), F.lit(0)))).alias("v")).distinct()

    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = filled(points).withColumn("n", nth).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = table(distinct, "points")
    pivots = np.array([r["v"] for r in distinct.orderBy(F.xxhash64("v"), "v").limit(PIVOTS).collect()], np.int64).reshape(-1, dim)  # PIVOTS rows at most
    lifted = _lifted(pivots, r2)

    @F.pandas_udf("long")
    def region(v: pd.Series) -> pd.Series:
        x = _lifted(np.stack(v.to_numpy()).reshape(len(v), dim) if len(v) else np.zeros((0, dim)), r2)
        return pd.Series(np.argmin((x * x).sum(1)[:, None] - 2 * x @ lifted.T + (lifted * lifted).sum(1)[None], 1).astype(np.int64))

    placed = table(distinct.withColumn("region", region("v")), "placed")
    sizes = {r["region"]: r["n"] for r in placed.groupBy("region").agg(F.count("*").alias("n")).collect()}  # PIVOTS rows at most
    parts = [-(-sizes.get(i, 0) // SHARD) for i in range(len(pivots))]
    n_of, first = F.lit(parts).cast("array<long>"), F.lit([sum(parts[:i]) for i in range(len(parts))]).cast("array<long>")
    at = (F.col("region") + 1).cast("int")
    shard = F.element_at(first, at) + F.pmod(F.xxhash64("v"), F.greatest(F.element_at(n_of, at), F.lit(1).cast("long")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("low", kind="stable")
        v = np.stack(pdf["v"].to_numpy()).reshape(len(pdf), dim).astype(kind)
        ids = pdf["ids"].to_numpy()
        loader = _Loader(v, r2)
        loader.load(np.arange(len(v)), loader.v.mean(0))
        out = []
        for number, p in enumerate(loader.pages):
            index = p.get("index", np.zeros(0, int))
            out.append(
                {
                    "shard": int(pdf["shard"].iloc[0]),
                    "page": number,
                    "leaf": p["leaf"],
                    "centre": p["centre"].tobytes(),
                    "vectors": v[index].tobytes() if p["leaf"] else p["vectors"].tobytes(),
                    "parent_distance": p["parent"].tobytes(),
                    "radius": p["radius"].tobytes(),
                    "child": p["child"].tobytes(),
                    "ids": np.concatenate([ids[i] for i in index]).astype(np.int64).tobytes() if len(index) else b"",
                    "id_count": np.array([len(ids[i]) for i in index], np.int32).tobytes(),
                }
            )
        return pd.DataFrame(out)

    pages = placed.select(shard.alias("shard"), "v", "ids", F.col("ids")[0].alias("low")).groupBy("shard").applyInPandas(build, _PAGES)
    pages = table(pages, "pages")

    # A query's home is a shard of its region, or the first shard if its region has none.
    home = F.when(F.element_at(n_of, at) > 0, F.element_at(first, at) + F.pmod(F.xxhash64("id"), F.element_at(n_of, at))).otherwise(F.lit(0).cast("long"))
    asked = table(filled(queries).withColumn("region", region("v")).select("id", "v", home.alias("home")), "queries")
    n_shards = sum(parts)

    def answer(tree: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(tree) and len(block):
            t = _Tree(tree, dim, kind)
            for r in block.itertuples():
                bound = None if r.bound == -_WORD else int(r.bound)
                out += [(r.id, i, s) for s, i in t.search(np.asarray(r.v, np.int64), r.id, k, r2, bound)]
            if any(not -_WORD <= s < _WORD for _, _, s in out):
                raise OverflowError("a score is beyond 64 bits")
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "int64"})

    def meet(pages: DataFrame, block: DataFrame) -> DataFrame:
        """Answers of each block from its shard; ``pages`` have the blocks they go to."""
        return pages.groupBy("shard", "block").cogroup(block.groupBy("shard", "block")).applyInPandas(answer, "query_id long, id long, score long")

    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    n_blocks = max(1, -(-asked.count() // BLOCK))
    number, none = F.xxhash64("id", "v"), F.lit(-_WORD).cast("long")  # a null would turn bounds to doubles in pandas
    # A home has as many blocks as its queries need, and its pages go to these only.
    per_home = asked.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    at_home = asked.join(per_home, "home").select(F.col("home").alias("shard"), F.pmod(number, F.col("n")).alias("block"), "id", "v", none.alias("bound"))
    asking = at_home.select(F.col("shard").alias("to"), F.col("block").alias("part")).distinct()
    found = table(meet(pages.join(asking, F.col("shard") == F.col("to")).drop("to").withColumnRenamed("part", "block"), at_home), "found")
    bounds = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") >= k)
    every = F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))
    elsewhere = asked.join(bounds, asked.id == bounds.query_id, "left").select("home", F.pmod(number, F.lit(n_blocks)).alias("block"), "id", "v", F.coalesce("bound", none).alias("bound"))
    elsewhere = elsewhere.withColumn("shard", F.explode(every)).where("shard <> home").drop("home")
    all_blocks = F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))
    rest = meet(pages.withColumn("block", F.explode(all_blocks)), elsewhere)
    ranked = found.union(rest).distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
