"""URL filter: rules by host and path, and two character language models for the rest.

DataFrame operations only. Accepted and rejected URLs (host and path) each train a smoothed
variable-order Markov model: the next character's probability given the last ``order``
characters is interpolated with shorter contexts by Witten-Bell weights, so a context counts
as much as it has been seen. A URL's score is the mean log-likelihood difference of its
characters. The threshold is calibrated on known URLs that took no part in the training.

Counts cover all distinct known URLs, aggregated map-side. Each distinct run of order + 1
characters is scored once; URLs get the sums by one equi-join, which the skew-join rule splits
where a run is very common. Equal URLs are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, prepare, table

_START, _END = "\x02", "\x03"
#: Characters of texts whose runs one task makes, at most, where there are many.
PART_CHARS = 2_000_000


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased in A-Z."""
    return ascii_lower(F.regexp_extract(_after(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` for distinct ``host, path``; nulls where no rule fits.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the path starts
    with the rule's. The longest (host and path together) wins, then the smallest.
    """
    keys = urls.select("host", "path").distinct()
    # No more of a host's last labels than the longest rule has.
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    suffix = F.expr(f"explode(array_distinct(transform(sequence(1, {most}), i -> substring_index(host, '.', -i))))")
    rules = rules.select(
        F.col("host").alias("suffix"),
        F.col("path").alias("start"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    fit = keys.select("host", "path", suffix.alias("suffix")).join(rules, "suffix").where(F.col("path").startswith(F.col("start")))
    best = fit.groupBy("host", "path").agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict")).alias("b"))
    return keys.join(best, ["host", "path"], "left").select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict"))


def _runs(order: int) -> Column:
    """``(context, next)`` of each character of ``text`` and of its end, with ``order``
    characters of context."""
    chars = F.concat(F.array_repeat(F.lit(_START), order), F.regexp_extract_all("text", F.lit("(?s)(.)"), 1), F.array(F.lit(_END)))
    return F.transform(
        F.sequence(F.lit(order + 1), F.size(chars)),
        lambda i: F.struct(F.array_join(F.slice(chars, i - order, order), "").alias("context"), F.element_at(chars, i).alias("next")),
    )


def _spread(texts: DataFrame) -> DataFrame:
    """Texts dealt out evenly before their runs are made, which take many times their space."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    return texts.repartition(max(n, size // PART_CHARS), "text")


def train(known: DataFrame, order: int) -> DataFrame:
    """Counts of both models: ``context, next, a_n, b_n`` for runs and, where ``next`` is
    null, ``a_n, b_n`` (times seen) and ``a_t, b_t`` (distinct next characters) of contexts.

    ``known``: text, accepted (boolean).
    """
    seen = _spread(known).select("accepted", F.explode(_runs(order)).alias("r")).select("accepted", "r.context", "r.next")
    counted = seen.groupBy("context", "next").agg(F.count_if("accepted").alias("a_n"), F.count_if(~F.col("accepted")).alias("b_n"))
    shorter = counted.select(F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"), "context", "next", "a_n", "b_n")
    shorter = shorter.select(F.expr("right(context, k)").alias("context"), "next", "a_n", "b_n")
    counted = shorter.groupBy("context", "next").agg(F.sum("a_n").alias("a_n"), F.sum("b_n").alias("b_n"))
    counted = table(counted, "counts")
    contexts = counted.groupBy("context").agg(
        F.sum("a_n").alias("a_n"), F.sum("b_n").alias("b_n"), F.count_if(F.col("a_n") > 0).alias("a_t"), F.count_if(F.col("b_n") > 0).alias("b_t")
    )
    zero = F.lit(0).cast("long")
    return table(
        counted.select("context", "next", "a_n", "b_n", zero.alias("a_t"), zero.alias("b_t")).union(
            contexts.select("context", F.lit(None).cast("string").alias("next"), "a_n", "b_n", "a_t", "b_t")
        ),
        "model",
    )


def run_scores(runs: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``context, next, score``: log P(next | context) accepted minus rejected, for distinct runs."""
    alphabet = model.where("next IS NOT NULL AND context = ''").count() + 1
    each = runs.select("context", "next", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k")).withColumn("short", F.expr("right(context, k)"))
    hits = model.where("next IS NOT NULL").select(F.col("context").alias("short"), "next", F.col("a_n").alias("a"), F.col("b_n").alias("b"))
    wide = model.where("next IS NULL").select(F.col("context").alias("short"), F.col("a_n").alias("a_all"), F.col("b_n").alias("b_all"), "a_t", "b_t")
    each = each.join(hits, ["short", "next"], "left").join(wide, "short", "left")
    each = each.select("context", "next", F.struct("k", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("a", "b", "a_all", "b_all", "a_t", "b_t")]).alias("s"))
    levels = each.groupBy("context", "next").agg(F.array_sort(F.collect_list("s")).alias("levels"))

    def log_p(n: str, total: str, kinds: str) -> Column:
        step = lambda p, s: F.when(s[total] > 0, (s[n] + s[kinds] * p) / (s[total] + s[kinds])).otherwise(p)
        return F.log(F.aggregate("levels", F.lit(1.0 / alphabet), step))

    return levels.select("context", "next", (log_p("a", "a_all", "a_t") - log_p("b", "b_all", "b_t")).alias("score"))


def text_scores(texts: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``text, score``: the mean score of each distinct text's characters and its end.

    Sums are decimal, so that they do not depend on the order of rows.
    """
    at = table(_spread(texts.select("text").distinct()).select("text", F.explode(_runs(order)).alias("r")).select("text", "r.context", "r.next"), "runs")
    scores = table(run_scores(at.select("context", "next").distinct(), model, order), "scores")
    exact = F.sum(F.col("score").cast("decimal(18,9)")) / F.count("*")
    return at.join(scores, ["context", "next"]).groupBy("text").agg(exact.cast("double").alias("score"))


def threshold(scored: DataFrame, width: float = 0.01) -> float:
    """The score that parts ``scored(score, accepted)`` best: the middle of the bins with the
    highest mean of the shares of accepted above and rejected below; 0 without both kinds."""
    bins = scored.groupBy(F.floor(F.col("score") / width).alias("bin")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("b"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # scores are bounded, and so are bins
    cut = bins.withColumn("a_below", F.coalesce(F.sum("a").over(below), F.lit(0))).withColumn("b_below", F.coalesce(F.sum("b").over(below), F.lit(0)))
    total = bins.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return 0.0
    # Keeping what is at or above a bin: accepted below are lost, rejected below are caught.
    gain = cut.select("bin", (F.col("b_below") / total["b"] - F.col("a_below") / total["a"]).alias("gain"))
    before = F.lag("bin").over(Window.orderBy("bin"))
    best = gain.withColumn("edge", (F.coalesce(before + 1, F.col("bin")) + F.col("bin")) / 2 * width)
    return best.orderBy(F.col("gain").desc(), F.abs("edge")).first()["edge"]


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", order: int = 4) -> DataFrame:
    """Judge every URL: ``id, host, path, rule, verdict`` (allow or block), ``score`` (null
    where a rule decides).

    Rules decide first. URLs that a rule allows are the accepted ones, URLs that a rule blocks
    the rejected ones; four fifths of them (by hash) train the models, one fifth calibrates
    the threshold. All others are allowed if their score reaches the threshold.

    A null URL or one without ``://`` has an empty host and path and is judged like the empty
    text. Without known URLs of both kinds the threshold is 0. Ids may be null or repeat.
    Empty table: no rows. Other input columns are never read by name.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    text = F.concat("host", "path")
    judged = table(apply_rules(rows, rules).withColumn("text", text), "rules")
    known = table(judged.where("verdict IS NOT NULL").groupBy("text").agg(F.max(F.col("verdict") == "allow").alias("accepted")), "known")
    fold = F.pmod(F.xxhash64("text"), F.lit(5))
    held, fit = known.where(fold == 0), known.where(fold != 0)
    model = train(fit, order)
    unknown = judged.where("verdict IS NULL").select("text")
    scores = table(text_scores(unknown.union(held.select("text")), model, order), "scored")
    cut = threshold(held.join(scores, "text"))
    rest = judged.where("verdict IS NULL").join(scores, "text", "left")
    guess = F.when(F.coalesce("score", F.lit(0.0)) >= cut, "allow").otherwise("block")
    verdicts = table(
        judged.where("verdict IS NOT NULL").select("host", "path", "rule", "verdict", F.lit(None).cast("double").alias("score")).union(
            rest.select("host", "path", "rule", guess.alias("verdict"), "score")
        ),
        "verdicts",
    )
    return rows.join(verdicts, ["host", "path"]).select("id", "host", "path", "rule", "verdict", "score")
