"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Rates: of all document rates that give each source its target of words, take those closest in
entropy to one copy of each document, none above ``cap``. The convex dual has one number per
source, lambda; a document of size s then has the rate min(cap, exp(lambda * s / largest s)).
Documents of one source and size have the same rate, so the dual needs only the counts by
(source, size), which are summed once with partial aggregation. Each Newton iteration is one
join of these counts with the sources' lambdas and one aggregation; steps that leave the
bracket around the root are replaced by bisection.

Copies: rates become whole copies by systematic rounding along the sizes of a source, so the
words taken differ from the target by at most the source's longest document; then a copy more
or less of up to three documents per source takes most of that difference away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import WORD, drop, prepare, table

#: Documents of one source and size that are ranked together.
RANKED = 65_536


def targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``source, source_size`` to ``source, sid, source_size, largest, target``: one row per source.

    All sizes are shared by weight; a source stops at ``cap`` times its size and the excess is
    shared again. In the order of cap / weight the sources that stop come first, so each
    source's level follows from sums over the sources before and after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.lit([float(x) for x in weights]).cast(T.ArrayType(T.DoubleType())), (F.col("sid") % len(weights) + 1).cast("int"))
    out = sizes.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long")).withColumn("w", w)
    out = out.withColumn("most", F.col("source_size") * float(cap))
    order = Window.orderBy(F.col("most") / F.col("w"), "sid")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = out.withColumn("level", (total - before) / rest).withColumn("stops", F.col("most") <= F.col("w") * F.col("level"))
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return out.select("source", "sid", "source_size", "largest", F.when(F.col("stops"), F.col("most")).otherwise(F.col("w") * level).alias("target"))


def solve(counts: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-9, max_rounds: int = 100) -> DataFrame:
    """Newton iterations on the dual: ``sid, lam`` for every source with words.

    ``counts``: sid, size, n. ``sources``: sid, source_size, largest, target. A null ``lam``
    stands for an infinite one: every document at the cap.
    """
    none = F.lit(None).cast("double")
    open_ = (F.col("target") < F.col("source_size") * cap * (1 - 1e-12)) & (F.col("target") > 0)
    held = ["sid", "largest", "target", "lam", "lo", "hi"]
    sources = sources.where("source_size > 0")
    state = sources.where(open_).select("sid", "largest", "target", F.lit(0.0).alias("lam"), none.alias("lo"), none.alias("hi"))
    x = F.col("size") / F.col("largest")
    free = F.exp(F.col("lam") * x)
    words = F.col("n") * F.col("size")
    lo = F.when(F.col("f") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
    hi = F.when(F.col("f") >= F.col("target"), F.col("lam")).otherwise(F.col("hi"))
    # Newton on ln f = ln target: f grows about as an exponential of lambda.
    step = F.when(F.col("g") > 0, F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("g"))
    inside = step.isNotNull() & ((step > F.col("lo")) | F.col("lo").isNull()) & ((step < F.col("hi")) | F.col("hi").isNull())
    halved = (
        F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2)
        .when(F.col("lo").isNotNull(), F.col("lo") + F.greatest(F.lit(1.0), F.abs("lo")))
        .otherwise(F.col("hi") - F.greatest(F.lit(1.0), F.abs("hi")))
    )
    for _ in range(max_rounds):
        # The state goes through the sums as keys: a second join, to bring it back, would leave
        # another broadcast in the driver's memory each round.
        sums = (
            counts.join(state.select(*held), "sid")
            .groupBy(*held)
            .agg(F.sum(words * F.least(free, F.lit(float(cap)))).alias("f"), F.sum(F.when(free < cap, words * x * free).otherwise(0.0)).alias("g"))
        )
        new = (
            sums.withColumn("lo", lo)
            .withColumn("hi", hi)
            .withColumn("off", F.abs(F.col("f") / F.col("target") - 1))
            .withColumn("lam", F.when(F.col("off") <= tolerance, F.col("lam")).when(inside, step).otherwise(halved))
        )
        new = table(new.select(*held, "off"), "dual")
        drop(state)
        state = new
        if state.where(F.col("off") > tolerance).isEmpty():
            break
    else:
        off = state.agg(F.max("off")).first()[0]
        if off > 1000 * tolerance:
            raise RuntimeError(f"a source is {off:.3g} of its target off after {max_rounds} rounds")
    lam = F.when(open_, F.coalesce("lam", F.lit(0.0)))
    return sources.join(state.select("sid", "lam"), "sid", "left").select("sid", lam.alias("lam"))


def corrections(copied: DataFrame, sources: DataFrame, cap: float, rounds: int = 3) -> DataFrame:
    """One copy more or less of up to ``rounds`` documents per source: ``uid, change``.

    Each round takes, of the sizes that some document can still give or take, the one nearest
    to what the source lacks or has too much; only if that brings it nearer to the target.
    """
    sizes = table(copied.groupBy("sid", "size").agg(F.min("copies").alias("least"), F.max("copies").alias("most"), F.sum("copies").alias("n")), "sizes")
    taken = sizes.groupBy("sid").agg(F.sum(F.col("n") * F.col("size")).alias("taken"))
    state = sources.join(taken, "sid").select("sid", (F.col("target") - F.col("taken")).alias("lack"), F.lit(None).cast("long").alias("last"))
    picks = None
    for _ in range(rounds):
        able = F.when(F.col("lack") > 0, F.col("least") < cap).otherwise(F.col("most") > 0)
        off = F.abs(F.abs("lack") - F.col("size"))
        fit = sizes.join(state, "sid").where(able & (off < F.abs("lack")) & (F.col("size") < F.coalesce("last", F.col("size") + 1)))
        best = fit.groupBy("sid").agg(F.min(F.struct(off.alias("off"), F.col("size"), F.col("lack"))).alias("b"))
        change = F.signum("b.lack").cast("int")
        best = table(best.select("sid", F.col("b.size").alias("size"), change.alias("change"), (F.col("b.lack") - change * F.col("b.size")).alias("lack")), "picks")
        picks = best if picks is None else picks.union(best)
        state = best.select("sid", "lack", F.col("size").alias("last"))
    can = F.when(F.col("change") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
    one = copied.join(picks.select("sid", "size", "change"), ["sid", "size"]).where(can)
    return one.groupBy("sid", "size", "change").agg(F.min(F.struct("id", "copies", "uid")).alias("d")).select(F.col("d.uid").alias("uid"), "change")


def entropy_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3,
    row: bool = False,
) -> DataFrame:
    """Copies of every document that bring the sources to their target shares of words.

    Sources, by code point and null last, have the ``weights``, repeating. Returns ``id,
    source, size, source_size, target, rate, copies, taken`` (``copies * size``), and with
    ``row`` also ``row``, a struct of all input columns. ``copies`` is at most ``cap``.

    A null source is a source of its own. Null and empty texts have size 0, one copy and take
    nothing; a source of such texts has target 0. Copies depend on ids and sizes, not on row
    order; rows with equal id, source and size are interchangeable. Null ids are ids like any
    other. Empty table: no rows. Other input columns are never read by name.
    """
    prepare(docs.sparkSession)
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    cols = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")]
    if row:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sized = table(docs.select(*cols).withColumn("uid", F.monotonically_increasing_id()), "sized")

    counts = table(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    per_source = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.max("size").alias("largest"))
    sources = table(targets(per_source, weights, cap), "sources")
    c, s = counts.where("size > 0").alias("c"), sources.alias("s")
    cells = table(c.join(s, F.expr("c.source <=> s.source")).select("c.source", "sid", "size", "n", "largest"), "cells")
    lams = solve(cells.select("sid", "size", "n"), sources, cap)
    free = F.least(F.exp(F.col("lam") * F.col("size") / F.col("largest")), F.lit(float(cap)))
    rate = F.when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(F.when(F.abs(free - F.round(free)) < 1e-9, F.round(free)).otherwise(free))
    cells = cells.join(lams, "sid").withColumn("rate", rate).withColumn("parts", F.ceil(F.col("n") / RANKED))

    # Documents of a cell are ranked in parts of bounded size by the hash of the id; rows of one
    # id that are too many for a part are a part of their own, in lots by row. Such rows are
    # interchangeable and their lots follow each other, so the copies of an id do not depend on
    # row order. A row's place along its source is the sum of the fractions of the larger sizes
    # and of the rows before it, so the rounding goes on from part to part.
    d, c = sized.select("id", "source", "size", "uid").alias("d"), cells.alias("c")
    dealt = d.join(c, F.expr("d.source <=> c.source AND d.size = c.size")).select("d.id", "d.size", "d.uid", "sid", "rate", "parts")
    many = dealt.where("parts > 1").groupBy("sid", "size", "id").agg(F.count("*").alias("m")).where(F.col("m") > RANKED)
    # Few or none: written, so that Spark knows its size and sends it to the tasks only if it is small.
    many = table(many.select("sid", "size", "id", F.ceil(F.col("m") / RANKED).alias("lots")), "lots")
    big = F.col("lots").isNotNull()
    place = [
        F.when(F.col("parts") > 1, F.pmod(F.xxhash64("d.id"), F.col("parts"))).otherwise(F.lit(0).cast("long")).alias("part"),
        big.alias("big"),
        F.when(big, F.col("d.id")).alias("own"),
        F.when(big, F.pmod(F.xxhash64("uid"), F.col("lots"))).otherwise(F.lit(0).cast("long")).alias("lot"),
    ]
    placed = dealt.alias("d").join(many.alias("m"), F.expr("d.sid = m.sid AND d.size = m.size AND d.id <=> m.id"), "left")
    placed = placed.select("d.id", "d.size", "d.uid", "d.sid", "rate", *place)
    where = ["sid", "size", "part", "big", "own", "lot"]
    rest = F.col("rate") - F.floor("rate")
    larger = Window.partitionBy("sid").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("sid", "size", (F.coalesce(F.sum(F.col("n") * rest).over(larger), F.lit(0.0)) + 0.5).alias("start"))
    before = Window.partitionBy("sid", "size").orderBy("part", "big", "own", "lot").rowsBetween(Window.unboundedPreceding, -1)
    here = placed.groupBy(*where).agg(F.count("*").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).join(starts, ["sid", "size"])
    rank = F.row_number().over(Window.partitionBy(*where).orderBy(F.xxhash64("id"), "id", "uid"))
    at = F.col("before") + F.col("rank")
    extra = F.floor(F.col("start") + at * rest) - F.floor(F.col("start") + (at - 1) * rest)
    copied = table(
        placed.withColumn("rank", rank)
        .alias("p")
        .join(here.alias("h"), F.expr(" AND ".join(f"p.{x} <=> h.{x}" for x in where)))
        .select("uid", "id", "p.sid", "p.size", "rate", (F.floor("rate") + extra).cast("int").alias("copies")),
        "copied",
    )
    changed = corrections(copied, sources, cap)
    copied = copied.join(changed, "uid", "left").select("uid", "rate", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies"))
    everything = sized.join(copied, "uid", "left").alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source"))
    copies = F.coalesce("copies", F.lit(1))
    return everything.select(
        "id",
        "d.source",
        "size",
        "source_size",
        "target",
        F.coalesce("rate", F.lit(1.0)).alias("rate"),
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        *(["row"] if row else []),
    )
