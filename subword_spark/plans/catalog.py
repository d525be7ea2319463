"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (``documents``, ``conversations``, ``benchmark``),
runs whole tables and whole texts through the library's operators, and aliases its
columns exactly as the matching oracle SQL in ``plans.oracles`` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import byte_string, hex_symbol, n_chars, n_whitespace_words, normalize
from ..functions.unicode import unicode_form
from ..operators.decode import decode
from ..operators.encode import encode
from ..operators.encode_pieces import encode_files, encode_long, token_positions
from ..operators.metrics import roundtrip_report, stability, stats_report, throughput, token_frequency, vocab_coverage
from ..operators.model import BPEModel
from ..operators.pairs import apply_pairs, frequent_pairs, merge_with_delta, pair_counts_native, update_pair_counts
from ..operators.symbols import computed_once, line_sequence, weighted_sequences, word_sequences
from ..operators.train import pair_counts, top_pairs, train
from ..operators.vocab import alphabet_df, initial_tokens, intern_state, observed_alphabet, token_lookup, with_token_ids
from ..options import BPEOptions
from ..session import remove_path, scratch_path, shared_table
from ..sources import model_io
from ..sources.corpus import corpus_lines, format_token_ids, parse_token_ids, read_table
from ..streaming.encode_stream import encode_stream_table
from . import jobs

# Configurations of the registered queries (fixed parameters, never tuned to pass). Those with
# max_merges show the merge cap; TARGET and NATURAL train to the two other ends.
WORD = BPEOptions(unit="word", max_merges=100)
LINE = BPEOptions(unit="line", max_merges=40)
BYTE = BPEOptions(model_kind="byte_bpe", add_visible_space=False, max_merges=50)
HISTORY = WORD.with_(progress_every=10)
MINFREQ = BPEOptions(unit="word", minimum_pair_frequency=8)
COVER = BPEOptions(unit="word", max_merges=20)
FIRST_SEEN = MINFREQ.with_(tie_break="first_seen")
WS_ONLY = BPEOptions(unicode_normalization="none")
FULL_NORM = BPEOptions(strip_accents=True, lowercase=True)
# Specials that the corpus itself spells often: they are never made by a merge.
SPECIALS = BPEOptions(unit="word", max_merges=100, specials=("<unknown>", "th", "en", "er", "the"))
TARGET = BPEOptions(unit="word", target_vocabulary_size=320)
NATURAL = BPEOptions(unit="word", minimum_pair_frequency=3000)
BYTE_TEXT = BPEOptions(model_kind="byte_bpe", add_visible_space=False, max_merges=30)
FREQUENT_MIN = 1000
TOP_K = 5


# -- inputs ---------------------------------------------------------------------------
def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_lines(documents(spark, sf), "text", ("doc_id",))


def conv_lines(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_lines(read_table(spark, sf, "conversations"), "text", ("conv_id", "turn"))


def bench_lines(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_lines(read_table(spark, sf, "benchmark"), "text", ("item_id",))


def word_model(spark: SparkSession, sf: str, opts: BPEOptions = WORD) -> BPEModel:
    return train(doc_lines(spark, sf), "line", opts)


def _merges(model: BPEModel, spark: SparkSession, hex_out: bool = False) -> DataFrame:
    m = model.merges_df(spark)
    if hex_out:
        return m.select("rank", hex_symbol(F.col("left")).alias("left_hex"), hex_symbol(F.col("right")).alias("right_hex"), "cnt", "vocab_size")
    return m.select("rank", "left", "right", "cnt", "vocab_size")


def _encoded(spark, sf, key="doc_id", table="documents", order="scan") -> DataFrame:
    model = word_model(spark, sf)
    enc = encode(read_table(spark, sf, table), "text", model, order=order)
    return enc.select(key, F.size("ids").cast("int").alias("n_tokens"), format_token_ids(F.col("ids")).alias("ids"))


# -- sources and projections --------------------------------------------------------------
def q_corpus_lines(spark, sf):
    return doc_lines(spark, sf)


def _form(spark, sf, form: str):
    return doc_lines(spark, sf).select("doc_id", "line_no", unicode_form(F.col("line"), form).alias("normal"))


def q_normalize_nfd(spark, sf):
    return _form(spark, sf, "NFD")


def q_normalize_nfkc(spark, sf):
    return _form(spark, sf, "NFKC")


def q_normalize_nfkd(spark, sf):
    return _form(spark, sf, "NFKD")


def q_normalize_nfc(spark, sf):
    return doc_lines(spark, sf).select("doc_id", "line_no", unicode_form(F.col("line"), "NFC").alias("nfc"))


def q_strip_accents(spark, sf):
    return doc_lines(spark, sf).select("doc_id", "line_no", unicode_form(F.col("line"), "none", True).alias("stripped"))


def q_normalize_lower(spark, sf):
    return doc_lines(spark, sf).select("doc_id", "line_no", F.lower("line").alias("lowered"))


def q_normalize_ws(spark, sf):
    return doc_lines(spark, sf).select("doc_id", "line_no", normalize(F.col("line"), WS_ONLY).alias("ws"))


def q_normalize_full(spark, sf):
    return doc_lines(spark, sf).select("doc_id", "line_no", normalize(F.col("line"), FULL_NORM).alias("normalized"))


def q_char_symbols(spark, sf):
    seq = line_sequence(F.col("line"), LINE)
    return doc_lines(spark, sf).select("doc_id", "line_no", F.char_length(seq).cast("int").alias("n_symbols"), seq.alias("seq"))


def q_word_punct_tokens(spark, sf):
    toks = word_sequences(F.col("line"), WORD)
    return doc_lines(spark, sf).select(
        "doc_id", "line_no", F.size(toks).cast("int").alias("n_tokens"), F.array_join(toks, " ").alias("tokens")
    )


def q_byte_symbols(spark, sf):
    b = byte_string(F.col("line"))
    return doc_lines(spark, sf).select(
        "doc_id", "line_no", F.char_length(b).cast("int").alias("n_bytes"), hex_symbol(b).alias("hex")
    )


def q_baseline_counts(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        n_chars(F.col("text")).cast("int").alias("n_chars"),
        n_whitespace_words(F.col("text")).cast("int").alias("n_words"),
    )


# -- vocabulary ------------------------------------------------------------------------
def _alphabet_ids(seqs: DataFrame, opts: BPEOptions, hex_out: bool) -> DataFrame:
    n_special = len(dict.fromkeys(opts.specials))
    a = alphabet_df(seqs)
    tid = (F.row_number().over(Window.orderBy("cp")) + n_special - 1).cast("int").alias("token_id")
    sym = hex_symbol(F.col("symbol")).alias("symbol_hex") if hex_out else F.col("symbol")
    return a.select(tid, sym)


def q_alphabet_chars(spark, sf):
    return _alphabet_ids(weighted_sequences(doc_lines(spark, sf), "line", LINE), LINE, False)


def q_alphabet_bytes(spark, sf):
    return _alphabet_ids(weighted_sequences(doc_lines(spark, sf), "line", BYTE), BYTE, True)


def q_byte_alphabet(spark, sf):
    """Vocabulary of a byte model with the full 256-byte alphabet, trained on conversations."""
    m = train(conv_lines(spark, sf), "line", BYTE.with_(alphabet="full256"))
    v = m.vocab_df(spark)
    return v.select("token_id", hex_symbol(F.col("token")).alias("token_hex"), "kind")


def q_vocab_table(spark, sf):
    return word_model(spark, sf).vocab_df(spark)


def q_intern_sequences(spark, sf):
    seqs, _ = shared_table(weighted_sequences(doc_lines(spark, sf), "line", WORD), "sequences")
    tokens = initial_tokens(WORD, observed_alphabet(seqs))
    state = intern_state(seqs, tokens, min_len=0, keep_text=True)
    return state.select(
        F.col("text").alias("seq"), "weight", F.size("seq").cast("int").alias("n_symbols"), format_token_ids(F.col("seq")).alias("ids")
    )


def q_token_id_lookup(spark, sf):
    model = word_model(spark, sf)
    words = computed_once(doc_lines(spark, sf), "__w", word_sequences(F.col("line"), WORD))
    toks = words.select(F.explode("__w").alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return with_token_ids(counts, "token", model.tokens, unknown_id=-1).select("token", "n", "token_id")


# -- pair statistics -----------------------------------------------------------------------
def _char_state(spark, sf, min_len=2, keep_text=False):
    """The weighted sequences are written once: alphabet, best pair and result read the table
    and not the corpus."""
    seqs, _ = shared_table(weighted_sequences(doc_lines(spark, sf), "line", LINE), "sequences")
    tokens = initial_tokens(LINE, observed_alphabet(seqs))
    state = intern_state(seqs, tokens, min_len=min_len, keep_text=keep_text)
    return state, tokens


def _named(counts: DataFrame, tokens: list[str]) -> DataFrame:
    return counts.select(
        token_lookup(F.col("l"), tokens).alias("left"), token_lookup(F.col("r"), tokens).alias("right"), "cnt"
    )


def q_pair_counts_chars(spark, sf):
    state, tokens = _char_state(spark, sf)
    return _named(pair_counts(state), tokens)


def q_pair_counts_bytes(spark, sf):
    seqs = weighted_sequences(conv_lines(spark, sf), "line", BYTE)
    counts = pair_counts_native(seqs)
    return counts.select(hex_symbol(F.col("left")).alias("left_hex"), hex_symbol(F.col("right")).alias("right_hex"), "cnt")


def q_best_pair(spark, sf):
    state, tokens = _char_state(spark, sf)
    return _named(top_pairs(pair_counts(state), 1), tokens)


def q_top_pairs(spark, sf):
    state, tokens = _char_state(spark, sf)
    return _named(top_pairs(pair_counts(state), TOP_K), tokens)


def q_frequent_pairs(spark, sf):
    state, tokens = _char_state(spark, sf)
    return _named(frequent_pairs(pair_counts(state), FREQUENT_MIN), tokens)


def _best_merge(state: DataFrame, tokens: list[str]):
    best = top_pairs(pair_counts(state), 1).first()
    s = tokens[best.l] + tokens[best.r]
    ext = tokens if s in tokens else tokens + [s]
    return (best.l, best.r, ext.index(s)), ext


def q_apply_merge(spark, sf):
    state, tokens = _char_state(spark, sf, min_len=0, keep_text=True)
    pair, ext = _best_merge(state, tokens)
    after = apply_pairs(state.withColumn("n_before", F.size("seq")), [pair])
    merged = F.array_join(F.transform("seq", lambda i: token_lookup(i, ext)), " ")
    return after.select(
        F.col("text").alias("seq"),
        "weight",
        F.col("n_before").cast("int").alias("n_before"),
        F.size("seq").cast("int").alias("n_after"),
        merged.alias("merged"),
    )


def q_pair_count_delta(spark, sf):
    state, tokens = _char_state(spark, sf)
    counts = pair_counts(state)
    pair, ext = _best_merge(state, tokens)
    _, before_rows, after_rows = merge_with_delta(state, pair)
    return _named(update_pair_counts(counts, before_rows, after_rows), ext)


# -- training ------------------------------------------------------------------------------
def q_train_words(spark, sf):
    return _merges(word_model(spark, sf), spark)


def q_train_lines(spark, sf):
    return _merges(train(doc_lines(spark, sf), "line", LINE), spark)


def q_train_bytes(spark, sf):
    return _merges(train(conv_lines(spark, sf), "line", BYTE), spark, hex_out=True)


def q_train_history(spark, sf):
    m = train(doc_lines(spark, sf), "line", HISTORY)
    return _merges(m, spark).where((F.col("rank") + 1) % HISTORY.progress_every == 0)


def q_train_stop_minfreq(spark, sf):
    return _merges(train(bench_lines(spark, sf), "line", MINFREQ), spark)


def q_train_first_seen(spark, sf):
    """Ties broken by first appearance in the corpus order (item, line), as the reference does."""
    m = train(bench_lines(spark, sf), "line", FIRST_SEEN, order_by=("item_id", "line_no"))
    return _merges(m, spark)


def q_train_specials(spark, sf):
    """Specials that the corpus spells often: never made, and the other merges unchanged."""
    return _merges(train(doc_lines(spark, sf), "line", SPECIALS), spark)


def q_train_target_size(spark, sf):
    """Train to a vocabulary size, without a cap on merges."""
    return _merges(train(doc_lines(spark, sf), "line", TARGET), spark)


def q_train_minfreq_docs(spark, sf):
    """Train until no pair of the documents is frequent enough."""
    return _merges(train(doc_lines(spark, sf), "line", NATURAL), spark)


def q_top_pairs_history(spark, sf):
    """The most frequent pairs after each of the first five merges."""
    m = word_model(spark, sf, WORD.with_(max_merges=5))
    seqs, _ = shared_table(weighted_sequences(doc_lines(spark, sf), "line", WORD), "sequences")
    state = intern_state(seqs, initial_tokens(WORD, observed_alphabet(seqs)))
    out = None
    for n, merge in enumerate(m.merge_table(), 1):
        state = apply_pairs(state, [merge])
        step = _named(top_pairs(pair_counts(state), TOP_K), m.tokens).withColumn("merges", F.lit(n))
        out = step if out is None else out.unionByName(step)
    return out.select("merges", "left", "right", "cnt")


def q_model_stats(spark, sf):
    m = word_model(spark, sf)
    return m.vocab_df(spark).agg(
        F.count(F.lit(1)).cast("int").alias("vocab_size"),
        F.lit(len(m.merges)).cast("int").alias("n_merges"),
        F.count_if(F.col("kind") == "symbol").cast("int").alias("n_alphabet"),
        F.count_if(F.col("kind") == "special").cast("int").alias("n_specials"),
    )


def q_train_stability(spark, sf):
    return stability(spark, word_model(spark, sf), word_model(spark, sf))


def q_model_reload(spark, sf):
    m = word_model(spark, sf)
    base = scratch_path(spark, "model")
    model_io.save_model(m, spark, base)
    model_io.save_bundle(m, spark, base + "/bundle")
    back = model_io.load_model(spark, base)
    bundle = model_io.load_bundle(spark, base + "/bundle")
    if back.tokens != m.tokens or back.merges != m.merges or bundle.tokens != m.tokens or bundle.merges != m.merges:
        raise AssertionError("model changed in a save/load round trip")
    remove_path(spark, base)
    return back.merges_df(spark).select("rank", "left", "right")


def byte_model(spark, sf) -> BPEModel:
    return train(conv_lines(spark, sf), "line", BYTE_TEXT)


def q_vocab_reload(spark, sf):
    """A byte model's vocabulary, saved as JSON and read back."""
    path = scratch_path(spark, "vocab")
    model_io.save_vocab_json(byte_model(spark, sf), spark, path)
    return model_io.load_vocab_json(spark, path).select("token_id", hex_symbol(F.col("token")).alias("token_hex"))


def q_merges_reload(spark, sf):
    """A byte model's merges (white space among their symbols), saved as text and read back."""
    path = scratch_path(spark, "merges")
    model_io.save_merges_text(byte_model(spark, sf), spark, path)
    back = model_io.load_merges_text(spark, path)
    return back.select("rank", hex_symbol(F.col("left")).alias("left_hex"), hex_symbol(F.col("right")).alias("right_hex"))


# -- encode / decode -----------------------------------------------------------------------
def q_encode_docs(spark, sf):
    return _encoded(spark, sf)


def q_encode_scan(spark, sf):
    return _encoded(spark, sf, key="item_id", table="benchmark")


def q_encode_rank(spark, sf):
    return _encoded(spark, sf, order="rank")


def q_oov_docs(spark, sf):
    m = train(conv_lines(spark, sf), "line", COVER)
    enc = encode(documents(spark, sf), "text", m, unknown_col="n_unknown")
    return enc.where(F.col("n_unknown") > 0).select("doc_id", "n_unknown")


def q_encode_lines(spark, sf):
    """Line-unit encode of every conversation line, merges replayed by rank."""
    m = train(conv_lines(spark, sf), "line", LINE)
    enc = encode(conv_lines(spark, sf), "line", m, order="rank")
    return enc.select("conv_id", "turn", "line_no", F.size("ids").cast("int").alias("n_tokens"), format_token_ids(F.col("ids")).alias("ids"))


def q_encode_bytes(spark, sf):
    """Byte-unit encode of every conversation line, merges replayed by rank."""
    m = train(conv_lines(spark, sf), "line", BYTE_TEXT)
    enc = encode(conv_lines(spark, sf), "line", m, order="rank")
    return enc.select("conv_id", "turn", "line_no", F.size("ids").cast("int").alias("n_tokens"), format_token_ids(F.col("ids")).alias("ids"))


def q_encode_cut_docs(spark, sf):
    """The documents' ids, texts of more than 500 characters encoded in pieces and stitched."""
    enc = encode_long(documents(spark, sf), "text", word_model(spark, sf), piece_chars=500, keep=("doc_id",))
    return enc.select("doc_id", F.size("ids").cast("int").alias("n_tokens"), format_token_ids(F.col("ids")).alias("ids"))


def q_encode_cut_lines(spark, sf):
    """Line-unit ids of every conversation line, cut at 40 symbols where no merge crosses."""
    m = train(conv_lines(spark, sf), "line", LINE)
    enc = encode_long(conv_lines(spark, sf), "line", m, order="rank", piece_chars=40)
    return enc.select("conv_id", "turn", "line_no", F.size("ids").cast("int").alias("n_tokens"), format_token_ids(F.col("ids")).alias("ids"))


def q_encode_whole_file(spark, sf):
    """All documents written as one file and encoded as one text, a task for each part: how
    often each token occurs, and the sum of its places."""
    m = word_model(spark, sf)
    path = scratch_path(spark, "one-file")
    documents(spark, sf).where("text IS NOT NULL").orderBy("doc_id").select("text").coalesce(1).write.text(path)
    return token_positions(encode_files(spark, path, m, chunk_bytes=1 << 18))


def q_decode_docs(spark, sf):
    m = word_model(spark, sf)
    enc = encode(documents(spark, sf), "text", m)
    return decode(enc, "ids", m).select("doc_id", "decoded")


def q_decode_bytes(spark, sf):
    """Byte-unit round trip of every conversation text with all 256 bytes known."""
    m = train(conv_lines(spark, sf), "line", BYTE_TEXT.with_(alphabet="full256"))
    enc = encode(read_table(spark, sf, "conversations"), "text", m)
    return decode(enc, "ids", m).select("conv_id", "turn", "decoded")


def q_decode_ids_null(spark, sf):
    """Lenient decode of ids with nulls, empty rows and ids outside the vocabulary: the ids of
    every third document are null, of every third plus one empty, and of every third plus two
    have a bad id put in front."""
    m = word_model(spark, sf)
    enc = encode(documents(spark, sf), "text", m)
    kind = F.pmod("doc_id", F.lit(3))
    bad = F.when(kind == 0, F.lit(None)).when(kind == 1, F.array().cast("array<int>")).otherwise(F.concat(F.array(F.lit(len(m))), "ids"))
    return decode(enc.withColumn("bad", bad), "bad", m, strict=False).select("doc_id", "decoded")


def q_jobs(spark, sf):
    """The encode, decode and stats jobs end to end over the documents table."""
    m = word_model(spark, sf)
    base = scratch_path(spark, "jobs")
    model_io.save_model(m, spark, f"{base}/model")
    jobs.encode_job(spark, f"{base}/model", f"{sf.rstrip('/')}/documents.parquet", f"{base}/ids", fmt="parquet")
    jobs.decode_job(spark, f"{base}/model", f"{base}/ids", f"{base}/texts", out_fmt="parquet")
    rep = jobs.stats_job(spark, f"{base}/model", f"{sf.rstrip('/')}/documents.parquet", fmt="parquet")
    back = spark.read.parquet(f"{base}/texts").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.char_length("text")).cast("bigint").alias("n_decoded_chars")
    )
    return back.withColumn("n_tokens", F.lit(rep["n_tokens"]).cast("bigint")).withColumn("n_merges", F.lit(rep["n_merges"]).cast("int"))


def q_parse_token_ids(spark, sf):
    m = word_model(spark, sf)
    enc = encode(documents(spark, sf), "text", m)
    parsed = parse_token_ids(format_token_ids(F.col("ids")))
    return enc.select("doc_id", F.size(parsed).cast("int").alias("n_ids"), (parsed == F.col("ids")).alias("same"))


def q_format_token_ids(spark, sf):
    """Token-id sink: write ``doc_id<TAB>ids`` text lines, read them back."""
    enc = _encoded(spark, sf)
    path = scratch_path(spark, "ids-text")
    enc.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "ids").alias("value")).write.text(path)
    parts = F.split(F.col("value"), "\t")
    return spark.read.text(path).select(F.get(parts, 0).cast("bigint").alias("doc_id"), F.get(parts, 1).alias("ids"))


def q_encode_stream(spark, sf):
    m = word_model(spark, sf)
    out = encode_stream_table(spark, sf, "text", m, ("doc_id",), glob="documents.parquet")
    return out.select("doc_id", "n_tokens", format_token_ids(F.col("ids")).alias("ids"))


# -- validation and metrics ---------------------------------------------------------------
def q_roundtrip_report(spark, sf):
    m = train(doc_lines(spark, sf), "line", LINE)
    return roundtrip_report(conv_lines(spark, sf), "line", m)


def q_roundtrip_words(spark, sf):
    """Word-unit round trip of every line that trained the model."""
    return roundtrip_report(doc_lines(spark, sf), "line", word_model(spark, sf))


def q_byte_roundtrip(spark, sf):
    m = train(conv_lines(spark, sf), "line", BYTE)
    return roundtrip_report(doc_lines(spark, sf), "line", m)


def q_tokens_per_word(spark, sf):
    rep = stats_report(documents(spark, sf), "text", word_model(spark, sf))
    return rep.select("n_tokens", "n_words", "tokens_per_word")


def q_compression_by_lang(spark, sf):
    rep = stats_report(documents(spark, sf), "text", word_model(spark, sf), group_by=("lang",))
    return rep.select("lang", "n_docs", "n_chars", "n_words", "n_tokens", "ratio_chars", "ratio_words")


def q_stats_report(spark, sf):
    m = word_model(spark, sf)
    rep = stats_report(documents(spark, sf), "text", m)
    return rep.select(
        F.lit(len(m)).cast("int").alias("vocab_size"),
        F.lit(len(m.merges)).cast("int").alias("n_merges"),
        "n_docs",
        "n_chars",
        "n_words",
        "n_tokens",
        "tokens_per_word",
        "ratio_chars",
        "ratio_words",
    )


def q_stats_rollup(spark, sf):
    rep = stats_report(documents(spark, sf), "text", word_model(spark, sf), group_by=("lang", "source"), rollup=True)
    return rep.select("lang", "source", "n_docs", "n_chars", "n_words", "n_tokens", "ratio_chars", "ratio_words")


def q_token_frequency(spark, sf):
    m = word_model(spark, sf)
    return token_frequency(encode(documents(spark, sf), "text", m), m)


def q_vocab_coverage(spark, sf):
    m = train(conv_lines(spark, sf), "line", COVER)
    return vocab_coverage(documents(spark, sf), "text", m, group_by=("lang",))


def q_throughput(spark, sf):
    """Timed encode and decode jobs: each trial's tokens, and that it took time."""
    out = throughput(documents(spark, sf), "text", word_model(spark, sf), trials=2)
    return out.select("kind", "trial", "n_tokens", ((F.col("seconds") > 0) & (F.col("tokens_per_sec") > 0)).alias("timed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
