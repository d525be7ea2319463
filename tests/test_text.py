"""Normalisation, splitting and byte symbols (native columns) against Python semantics."""

import re
import unicodedata

from pyspark.sql import functions as F

from subword_spark.functions import text as T
from subword_spark.functions.unicode import normalize_one
from subword_spark.operators.symbols import symbols
from subword_spark.options import BPEOptions

EDGE = [
    "Hello world",
    "  lead and trail  ",
    "a b\u001cc",
    "tabs\tand\nnewlines\r\n",
    "_a__b_",
    "multi   space　ideographic",
    "",
    "Привет мир",
    "こんにちは 世界",
    "😀 😃",
]


def py_normalize(text, opts):
    if opts.unicode_normalization != "none":
        text = unicodedata.normalize(opts.unicode_normalization, text)
    if opts.strip_accents:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    if opts.lowercase:
        text = text.lower()
    text = re.sub(r"\s+", " ", text.strip())
    if opts.add_visible_space:
        text = text.replace(" ", opts.marker)
    return text


def py_char_symbols(text, opts):
    out, first = [], True
    for chunk in py_normalize(text, opts).split(opts.marker):
        if not chunk:
            continue
        if not first:
            out.append(opts.marker)
        first = False
        out.extend(chunk)
    return out


def py_word_tokens(text, opts):
    out = []
    for seg in py_normalize(text, opts).split(opts.marker):
        out.append(opts.marker)
        if seg:
            out.extend(re.findall(r"\w+|[^\w\s]", seg))
    return out


def test_normalize_matches_python(spark, lines_df):
    for opts in [BPEOptions(), BPEOptions(lowercase=True, strip_accents=True), BPEOptions(add_visible_space=False)]:
        rows = lines_df(EDGE).select("line", T.normalize(F.col("line"), opts).alias("n")).collect()
        for r in rows:
            assert r.n == py_normalize(r.line, opts), (r.line, opts)


def test_whitespace_class_equals_python(spark):
    chars = spark.createDataFrame([(cp, chr(cp)) for cp in range(0x3100)], "cp int, c string")
    assert {r.cp for r in chars.where(F.col("c").rlike(f"^{T.WS}$")).collect()} == {cp for cp in range(0x3100) if chr(cp).isspace()}


def test_char_and_word_symbols(spark, lines_df):
    line_opts, word_opts = BPEOptions(), BPEOptions(unit="word")
    df = lines_df(EDGE)
    rows = df.select("line", symbols(F.col("line"), line_opts).alias("c"), T.word_tokens(T.normalize(F.col("line"), word_opts), word_opts).alias("w")).collect()
    for r in rows:
        assert list(r.c) == py_char_symbols(r.line, line_opts)
        assert list(r.w) == py_word_tokens(r.line, word_opts)


def test_marker_golden(spark, lines_df):
    """`_a__b_` in character mode gives a _ b; whitespace edge characters collapse."""
    opts = BPEOptions()
    got = lines_df(["_a__b_", "a b\u001cc"]).select(symbols(F.col("line"), opts).alias("s")).collect()
    assert list(got[0].s) == ["a", "_", "b"]
    assert "".join(got[1].s) == "a_b_c"


def test_byte_symbols_roundtrip(spark, lines_df):
    df = lines_df(EDGE + ["nul\x00byte", "é"])
    rows = df.select("line", T.byte_string(F.col("line")).alias("b")).select(
        "line", "b", T.bytes_to_text(F.col("b")).alias("back"), T.hex_symbol(F.col("b")).alias("hex")
    ).collect()
    for r in rows:
        assert [ord(c) for c in r.b] == list(r.line.encode("utf-8"))
        assert r.back == r.line
        assert r.hex == r.line.encode("utf-8").hex()


def test_unicode_forms(spark, lines_df):
    texts = ["é", "ﬁ", "ẛ̣", "Häuser", "plain"]
    df = lines_df(texts)
    for form in ["NFC", "NFKC", "NFD", "NFKD"]:
        from subword_spark.functions.unicode import unicode_form

        rows = df.select("line", unicode_form(F.col("line"), form).alias("n")).collect()
        for r in rows:
            assert r.n == unicodedata.normalize(form, r.line)
    assert normalize_one("café", "none", True) == "cafe"


def test_baselines(spark):
    df = spark.createDataFrame([("hello world",)], "text string")
    r = df.select(T.n_chars(F.col("text")).alias("c"), T.n_whitespace_words(F.col("text")).alias("w")).first()
    assert (r.c, r.w) == (11, 2)
