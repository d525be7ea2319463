"""Nulls, empty and long texts, ties, repeats, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from subword_spark.llm.bpe_codec import bpe_encode
from subword_spark.llm.license_scan import license_scan
from subword_spark.llm.simhash_dedup import simhash_dedup
from subword_spark.llm.source_mixing import entropy_mix
from subword_spark.llm.substring_dedup import substring_dedup
from subword_spark.llm.suffix_repetition import quality_rules
from subword_spark.llm.toxicity import Model, score_toxicity, train

public_tokenizers = pytest.importorskip("public_tokenizers")

LONG = " ".join(f"w{i % 700}" for i in range(60_000))
ROWS = [
    (1, "one two three", "en", "s"),
    (1, "one two three", "en", "s"),
    (2, None, None, None),
    (None, "", "en", "s"),
    (None, "  \n\t ", "en", None),
    (3, LONG, "en", "t"),
    (4, LONG + " tail", "en", "t"),
    (5, "x" * 200_000, "en", "t"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ["id", "row", "uid", "fp", "size", "kept", "score", "block", "component", "rate", "copies", "ids", "n_words", "sid"]
TOXIC = train(["bad awful day", "awful bad"] * 12 + ["nice good day", "good nice"] * 12, [1, 1] * 12 + [0, 0] * 12)

OPERATORS = {
    "entropy_mix": lambda d: entropy_mix(d, row=True),
    "simhash_dedup": lambda d: simhash_dedup(d, row=True),
    "quality_rules": lambda d: quality_rules(d, row=True),
    "bpe_encode": lambda d: bpe_encode(d, public_tokenizers.path("word_bpe_49k.json"), decoded=True, row=True),
    "score_toxicity": lambda d: score_toxicity(d, TOXIC, row=True),
    "substring_dedup": lambda d: substring_dedup(d, row=True),
}


def docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for i, name in enumerate(CLASH):
        df = df.withColumn(name, F.lit(i).cast("string"))
    return df.repartition(3)


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back_once(spark, name):
    df = docs(spark)
    out = OPERATORS[name](df)
    back = out.select("row.*")
    assert back.columns == df.columns
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.lang or "")
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](docs(spark).limit(0)).collect() == []


def test_defined_results(spark):
    df = docs(spark)
    simhash = {(r.id, r.row.text): r for r in simhash_dedup(df, row=True).collect()}
    empty = [r for (_, t), r in simhash.items() if not (t or "").strip()]
    assert all(r.fingerprint == 0 and r.component == 2 for r in empty) and sum(r.keep for r in empty) == 1
    assert sum(r.keep for r in simhash_dedup(df).where("id = 1").collect()) == 1

    cut = {(r.id, r.row.text): r for r in substring_dedup(df, row=True).collect()}
    assert cut[3, LONG].n_removed == 0 and cut[4, LONG + " tail"].kept == "tail"
    assert cut[2, None].n_words == 0 and cut[2, None].kept == ""

    mixed = entropy_mix(df).collect()
    assert all(r.taken == r["copies"] * r["size"] and r["copies"] <= 3 for r in mixed)
    assert all(r["copies"] == 1 for r in mixed if r["size"] == 0)

    quality = {r.id: r for r in quality_rules(df).where("id > 1").collect()}
    assert quality[2].base_failed and quality[2].n_words == 0
    assert quality[3].n_repeat_words == 60_000 and quality[3].longest_repeat == 60_000 - 700

    scores = score_toxicity(df, TOXIC, row=True).collect()
    assert all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if not (r.row.text or "").strip()}) == 1
    assert license_scan(df).collect() == []


def test_one_class_scores_its_share(spark):
    assert isinstance(train([], []), Model)
    df = docs(spark)
    assert {r.score for r in score_toxicity(df, train(["a"], [1])).collect()} == {1.0}
    assert {r.score for r in score_toxicity(df, train([], [])).collect()} == {0.0}


def test_long_labelled_texts_teach(spark):
    """A text beyond the sampled spans is cut into spans from all over it; shorter ones are whole."""
    from subword_spark.llm.toxicity import Fit, sample

    fit = Fit(max_per_class=3, span_chars=10, spans=4)
    long = "".join(f"{i:09d} " for i in range(50))
    docs = spark.createDataFrame([(1, long), (2, "a" * 40), (3, None), (4, "x"), (9, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, None), (5, 1), (6, 1), (7, 1), (8, 1)], "doc_id long, toxic int")
    texts, label = sample(docs, labels, "doc_id", "text", "toxic", fit)
    assert label.tolist() == [1, 1, 0] and texts[1:] == ["a" * 40, ""]
    spans = texts[0].split("\n")
    assert len(spans) == 4 and all(s in long and len(s) == 10 for s in spans) and spans == sorted(spans)
    assert int(spans[-1]) > 10


def test_url_of_very_many_labels(spark):
    """A host of 100,000 labels, and the rule of its last ones."""
    from subword_spark.llm.url_filter import apply_rules

    rules = spark.createDataFrame([("org", "/", "allow"), ("b.example.org", "/x", "block")], "host string, path string, verdict string")
    host = "a." * 100_000
    urls = spark.createDataFrame([(host + "b.example.org", "/xy"), (host + "org", "/"), (host + "net", "/"), ("org", "/"), ("", "")], "host string, path string")
    got = {(r.host[-5:], r.path): (r.rule, r.verdict) for r in apply_rules(urls, rules).collect()}
    assert got == {("e.org", "/xy"): ("b.example.org/x", "block"), ("a.org", "/"): ("org/", "allow"), ("a.net", "/"): (None, None), ("org", "/"): ("org/", "allow"), ("", ""): (None, None)}
