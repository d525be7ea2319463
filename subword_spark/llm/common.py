"""Helpers shared by the operators: durable intermediate tables and connected components."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

_TABLES: dict[str, SparkSession] = {}
_MADE: contextvars.ContextVar[set[str] | None] = contextvars.ContextVar("made", default=None)


def prepare(spark: SparkSession) -> None:
    """What every operator needs of the session: the shared folder, the package on the workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    This cuts the lineage durably: a lost executor never makes an earlier step run again.
    The table lives until :func:`drop` or the end of the driver process.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _TABLES[path] = spark
    if (mine := _MADE.get()) is not None:
        mine.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables made by :func:`table`; only when no DataFrame still reads them."""
    for t in tables:
        _delete(getattr(t, "_scratch_path", None))


def made() -> set[str]:
    """Paths of the tables made by :func:`table` that are still there."""
    return set(_TABLES)


@contextlib.contextmanager
def collecting() -> Iterator[set[str]]:
    """The paths of the tables that this thread makes inside the block, whatever others make."""
    paths: set[str] = set()
    token = _MADE.set(paths)
    try:
        yield paths
    finally:
        _MADE.reset(token)


def release(paths: set[str] | None = None) -> None:
    """Delete these tables, or every one that is still there."""
    for path in made() if paths is None else paths:
        _delete(path)


def _delete(path: str | None) -> None:
    spark = _TABLES.pop(path, None)
    if spark is None:
        return
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _release_at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        release()


def give_back() -> None:
    """Return the memory that this Python worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def returning(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, after which the worker gives its freed memory back. Workers
    outlive a task, and what they keep counts as their executor's in the stages that follow."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def source(docs: DataFrame, id_col: str, text_col: str, row: bool) -> DataFrame:
    """``id, text``, or with ``row`` ``id, row`` with the text inside the struct of all
    columns, so that a text crosses to Python once."""
    key = F.col(f"`{id_col}`").alias("id")
    return docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if row else F.col(f"`{text_col}`").alias("text"))


def row_field(df: DataFrame) -> str:
    """The DDL of the ``row`` column, empty where there is none."""
    return f", row {df.schema['row'].dataType.simpleString()}" if "row" in df.columns else ""


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long): ``(node, component)``, the smallest node.

    Alternating large-star and small-star rounds: each is one partial aggregation (the
    smallest neighbour of each node) and one equi-join, so a hub's edges are split by the
    skew-join rule and never meet in one group. The rounds halve the depth of the trees, and
    each round's edges are a table in the shared folder. Ends when a round changes nothing.
    """
    state = table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        sym = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        new = table(small.where("u <> v").distinct(), "cc")
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(state)
        state = new
        if before == mark:
            break
        before = mark
    else:
        raise RuntimeError("connected components did not settle")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
