"""The registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .best_fit_packing import pack
from .bpe_codec import bpe_encode
from .chat_format import CLOSE, CONTROL, OPEN, format_trees, read_turns, unescape
from .common import WORD, read, table
from .license_scan import license_scan
from .mtree_search import quantize, top_k
from .period_runs import period_runs
from .prefix_trie import trie_nodes, turn_sequences
from .simhash_dedup import simhash_dedup
from .source_mixing import entropy_mix
from .substring_dedup import substring_dedup
from .suffix_repetition import quality_rules
from .url_filter import filter_urls
from .toxicity import Fit, learn, score_toxicity


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 5, 2, 1, repeating; no source over 3 times its size."""
    out = entropy_mix(read(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "rate")


def op2_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every vector whose id is divisible by 50."""
    vectors = quantize(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    out = top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    out = simhash_dedup(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def _digest_turns(batches):
    """Read formatted conversations back: their turns, and the text under the loss mask."""
    for batch in batches:
        out = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for formatted, spans in zip(batch["formatted"].to_pylist(), batch["loss_spans"].to_pylist()):
            turns = read_turns(formatted)
            learnt = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
            out["n_turns"].append(len(turns))
            out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            out["loss_chars"].append(len(learnt))
            out["loss_sha256"].append(hashlib.sha256(learnt.encode()).hexdigest())
            out["formatted_chars"].append(len(formatted))
        yield pa.RecordBatch.from_pydict({"conv_id": batch["conv_id"]} | out)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -7 as a reply tree (each turn answers the one
    before), formatted, and read back from the formatted string."""
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    node = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    messages = rows.union(own).withColumn("node", node).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    out = format_trees(messages)
    return out.select("conv_id", "formatted", "loss_spans").mapInArrow(
        _digest_turns, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; repetition by suffix array."""
    out = quality_rules(read(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words", "longest_repeat"
    )


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and what they decode to."""
    out = bpe_encode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return out.select(
        F.col("id").alias("doc_id"),
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def fold(col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(5))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return license_scan(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: Host, path and verdict of the URL rules (fixed values).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules or, where none fits, by the language models."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = filter_urls(read(spark, sf_dir, "pages"), rules)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a network that learns from the folds not held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    fit = Fit()
    model = learn(docs, labels.where(fold() != 0), "doc_id", "text", "toxic", fit)
    out = score_toxicity(docs, model)
    return out.select(
        F.col("id").alias("doc_id"),
        F.coalesce(fold("id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word passages that a smaller document also holds, removed from every document."""
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, each document ended by id 0, packed into sequences of 2048."""
    out = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end=0)
    return out.withColumnRenamed("id", "doc_id")


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Conversations that share their first turns: the first h (crc32 of the id, modulo 6) are
    those of the conversation with the id's hundred, the others its own."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6)).cast("int")
    heads = sequences.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    each = sequences.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left").withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return each.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that they share first turns."""
    sequences = turn_sequences(read(spark, sf_dir, "conversations"))
    return trie_nodes(rebuilt(table(sequences, "sequences")))


def tiled(docs: DataFrame) -> DataFrame:
    """Documents, a tenth of them (by crc32 of the id) with a stretch of words that repeats up
    to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), 0)
    each = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    each = each.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    each = each.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))  # noqa: E731
    again = F.transform(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long")), lambda i: F.element_at("words", (at(i) + 1).cast("int")))
    return each.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with planted ones."""
    out = period_runs(tiled(read(spark, sf_dir, "documents")))
    # The run with the greatest length / period; the cross products are exact.
    top = F.expr("""array_sort(runs, (a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period THEN IF(a.length * b.period > b.length * a.period, -1, 1)
        WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
        ELSE CAST(sign(a.period - b.period) AS INT) END)""")
    out = out.withColumn("top", F.try_element_at(top, F.lit(1)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_mtree_top_k": op2_mtree_top_k,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_license_scan": op7_license_scan,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_period_runs": op13_period_runs,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _crc32(text: str) -> str:
    """crc32 of ASCII text, bit by bit."""
    byte = "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), lambda a, b: {byte}), 4294967295)"


def _escaped_length(text: str) -> str:
    """Length of a text with backslashes doubled and control strings broken up."""
    found = " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in CONTROL)
    return f"(length({text}) + length({text}) - length(replace({text}, chr(92), '')) + {found})"


def _windows(n: int) -> str:
    """Word windows of each document: ``doc_id, p, k``."""
    return f"SELECT doc_id, p, array_to_string(ws[p:p + {n - 1}], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS p FROM d)"


def _covered(n: int, what: str) -> str:
    """Words in windows that a document holds twice or more, by document."""
    return f"""SELECT doc_id, count(DISTINCT i)::BIGINT AS {what} FROM (SELECT doc_id, unnest(range(p, p + {n})) AS i FROM
      (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS c FROM w{n}) WHERE c > 1) GROUP BY doc_id"""


ORACLES = {
    "op4_chat_format": rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
a AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY i) AS turns,
             coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS learnt,
             sum({_escaped_length("role")} + length(role) - length(replace(role, chr(10), '')) + {_escaped_length("text")} + {len(OPEN) + 1 + len(CLOSE)})::BIGINT AS formatted_chars
      FROM n GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM a
""",
    "op5_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
w3 AS ({_windows(3)}), w8 AS ({_windows(8)}), c3 AS ({_covered(3, "n_repeat_words")}), c8 AS ({_covered(8, "n_covered_words")}),
same AS (SELECT a.doc_id, b.p - a.p AS lag, a.p FROM w8 a JOIN w8 b ON a.doc_id = b.doc_id AND a.k = b.k AND a.p < b.p),
longest AS (SELECT doc_id, max(n) + 7 AS longest_repeat FROM (SELECT doc_id, count(*) AS n FROM
            (SELECT *, p - row_number() OVER (PARTITION BY doc_id, lag ORDER BY p) AS island FROM same) GROUP BY doc_id, lag, island) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^ 	-]') GROUP BY doc_id),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_covered_words, 0)::BIGINT AS n_covered_words,
             coalesce(longest_repeat, 0)::BIGINT AS longest_repeat
      FROM d LEFT JOIN c3 USING (doc_id) LEFT JOIN c8 USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN lines USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND n_covered_words <= 0.3::DOUBLE * n_words AND longest_repeat <= 100 AS kept FROM g
""",
    "op2_mtree_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""",
    "op12_prefix_trie": rf"""
WITH t AS (SELECT conv_id, list({'{'}'role': coalesce(role, ''), 'text': coalesce(text, ''){'}'} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM t),
r AS (SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS s FROM h a LEFT JOIN t b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, s[1:d] AS k, d, d = len(s) AS last FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
n AS (SELECT k, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS ends,
             (count(*) - 1) * coalesce(length(k[d].text), 0) AS saved FROM p GROUP BY k, d),
c AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k)),
u AS (SELECT k[1:e] AS k, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth::BIGINT AS depth, x.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs, m.n_children::BIGINT AS n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN u USING (k) LEFT JOIN n x ON m.depth > 0 AND x.depth = m.depth - 1 AND x.k = m.k[1:m.depth - 1]
""",
    "op13_period_runs": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS o, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
e AS (SELECT doc_id, o, len(o) AS n, h % 10 = 0 AND len(o) > 0 AS tiled, (h // 10) % greatest(len(o), 1) AS a, h // 10 AS g FROM d),
w AS (SELECT doc_id, n, i, CASE WHEN tiled AND i >= a THEN o[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE o[i + 1] END AS x
      FROM (SELECT *, unnest(range(0, n)) AS i FROM e)),
eq AS (SELECT l.doc_id, r.i - l.i AS q, l.i AS i FROM w l JOIN w r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
s AS (SELECT doc_id, q, min(i) AS b, max(i) + 1 + q AS f FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM eq) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, b, f, min(q) AS q FROM s WHERE f - b >= greatest(6, 4 * q) GROUP BY doc_id, b, f),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (f - b)::DECIMAL(38, 0) * 1000000000000 // q DESC, b, q) AS k FROM runs) WHERE k = 1),
digest AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(b, ',', f - b, ',', q, chr(10)), '' ORDER BY b, q) AS lines FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(b + q, f)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT e.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.b::BIGINT AS start, (top.f - top.b)::BIGINT AS length, top.q::BIGINT AS period,
       (1000 * (top.f - top.b) // top.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM e LEFT JOIN top USING (doc_id) LEFT JOIN digest USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op10_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
low AS (SELECT k, min(doc_id) AS lo FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM win JOIN low USING (k) WHERE lo < doc_id),
word AS (SELECT doc_id, i, ws[i] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
}
