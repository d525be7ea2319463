"""DuckDB oracle SQL per registered query (same names and column aliases as ``catalog``)."""

from __future__ import annotations

import unicodedata

from . import catalog as C
from . import oracle_sql as O

DOC_LINES = O.lines_cte("documents", "doc_id")
CONV_LINES = O.lines_cte("conversations", "conv_id, turn")
BENCH_LINES = O.lines_cte("benchmark", "item_id")


def _line_select(expr: str, alias: str) -> str:
    return f"SELECT doc_id, line_no, {expr} AS {alias} FROM ({DOC_LINES})"


def _unicode_table(form: str) -> str:
    """What single characters turn into; texts without combining marks follow from these."""
    found = ((chr(c), unicodedata.normalize(form, chr(c))) for c in range(0x80, 0x3000))
    return ", ".join(f"('{c}', '{t}')" for c, t in found if c != t)


def _train(lines: str, opts) -> str:
    return "WITH RECURSIVE " + O.train_ctes(O.sequences_cte(lines, opts), opts)


def _merges_sql(lines: str, opts, hex_out: bool = False, where: str = "") -> str:
    sel = O.merges_select(opts, hex_out)
    return f"{_train(lines, opts)} SELECT * FROM ({sel}) {where}"


def _n_words(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array({text}, {O.q(O.WS + '+')}), lambda x: x <> ''))"


def _encode_ctes(table: str, key: str, order: str = "scan") -> str:
    """After the word-model training CTEs: ``dw`` (word occurrences), ``wtok`` (word ->
    final tokens), ``wids`` (word -> ids text) and ``enc`` (key, n_tokens, ids)."""
    opts = C.WORD
    norm = O.normalize("text", opts)
    parts = [
        f"fm AS ({O.final_merges()})",
        f"vocab AS ({O.final_vocab()})",
        f"docw AS (SELECT {key}, {O.word_tokens(norm, opts)} AS toks FROM {table})",
        f"dw AS (SELECT {key}, unnest(toks) AS w, generate_subscripts(toks, 1) AS pos FROM docw)",
    ]
    if order == "scan":
        parts.append("words AS (SELECT DISTINCT w, string_split(w, '') AS syms FROM dw)")
        parts.append(O.scan_ctes("SELECT w, syms FROM words").strip())
        parts.append("wtok AS (SELECT w, st FROM sc_done)")
    else:
        parts.append(
            "fin AS (SELECT unnest(st) AS x FROM (SELECT st FROM train ORDER BY step DESC LIMIT 1))"
        )
        parts.append(
            "wtok AS (SELECT replace(replace(x.s, chr(1), ''), chr(2), '') AS w, "
            "string_split(substr(x.s, 2, length(x.s) - 2), chr(2) || chr(1)) AS st FROM fin)"
        )
    parts.append(
        """wids AS (
      SELECT x.w, count(*) AS n, string_agg(CAST(coalesce(v.token_id, 0) AS VARCHAR), ' ' ORDER BY x.i) AS ids
      FROM (SELECT w, unnest(st) AS tok, generate_subscripts(st, 1) AS i FROM wtok) x
      LEFT JOIN vocab v ON v.token = x.tok GROUP BY x.w)"""
    )
    parts.append(
        f"""enc AS (
      SELECT {key}, CAST(sum(n) AS INTEGER) AS n_tokens, string_agg(ids, ' ' ORDER BY pos) AS ids
      FROM dw JOIN wids USING (w) GROUP BY {key})"""
    )
    return ",\n".join(parts)


def _word_encode(table: str = "documents", key: str = "doc_id", order: str = "scan") -> str:
    return _train(DOC_LINES, C.WORD) + ",\n" + _encode_ctes(table, key, order)


def _stats_base() -> str:
    """``base``: per document baselines and token counts, after the encode CTEs."""
    return f""",
    base AS (
      SELECT d.doc_id, d.lang, length(d.text) AS n_chars, {_n_words('d.text')} AS n_words, e.n_tokens
      FROM documents d JOIN enc e USING (doc_id))"""


def _line_encode_ctes(opts) -> str:
    """After training on the conversation lines: ids of every line, from the last state of the
    training (rank order gives just that on the training text)."""
    seq = O.byte_seq_hex("line") if opts.is_bytes else f"string_split({O.char_seq(O.normalize('line', opts), opts)}, '')"
    return f"""vocab AS ({O.final_vocab()}),
    fin AS (SELECT unnest(st) AS x FROM (SELECT st FROM train ORDER BY step DESC LIMIT 1)),
    ftok AS (SELECT replace(replace(x.s, chr(1), ''), chr(2), '') AS w, string_split(substr(x.s, 2, length(x.s) - 2), chr(2) || chr(1)) AS st FROM fin),
    wids AS (SELECT y.w, count(*) AS n, string_agg(CAST(v.token_id AS VARCHAR), ' ' ORDER BY y.i) AS ids
             FROM (SELECT w, unnest(st) AS tok, generate_subscripts(st, 1) AS i FROM ftok) y JOIN vocab v ON v.token = y.tok GROUP BY y.w),
    ln AS (SELECT conv_id, turn, line_no, array_to_string({seq}, '') AS w FROM ({CONV_LINES}))
    SELECT conv_id, turn, line_no, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, coalesce(ids, '') AS ids FROM ln LEFT JOIN wids USING (w)"""


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(greatest({den}, 1) AS DOUBLE)"


def _char_pairs(counts_where: str = "", order_limit: str = "") -> str:
    seqs = O.sequences_cte(DOC_LINES, C.LINE)
    return f"""
    WITH s AS ({seqs}),
    p AS (SELECT seq[i] AS "left", seq[i + 1] AS "right", weight
          FROM (SELECT seq, weight, unnest(generate_series(1, len(seq) - 1)) AS i FROM s WHERE len(seq) > 1))
    SELECT "left", "right", sum(weight)::BIGINT AS cnt FROM p GROUP BY "left", "right" {counts_where} {order_limit}"""


def _best_and_merged() -> str:
    """CTEs ``s`` (seq string, weight, syms), ``b`` (best pair), ``m`` (tokens after merging b)."""
    seqs = O.sequences_cte(DOC_LINES, C.LINE)
    return f"""
    WITH s0 AS ({seqs}),
    s AS (SELECT array_to_string(seq, '') AS seq, weight, seq AS syms FROM s0),
    p AS (SELECT syms[i] AS l, syms[i + 1] AS r, weight
          FROM (SELECT syms, weight, unnest(generate_series(1, len(syms) - 1)) AS i FROM s WHERE len(syms) > 1)),
    b AS (SELECT l, r FROM (SELECT l, r, sum(weight) AS cnt FROM p GROUP BY l, r) ORDER BY cnt DESC, l, r LIMIT 1),
    m AS (
      SELECT s.seq, s.weight, len(s.syms) AS n_before,
             string_split(substr(x, 2, length(x) - 2), chr(2) || chr(1)) AS toks
      FROM (SELECT s.*, replace(chr(1) || array_to_string(s.syms, chr(2) || chr(1)) || chr(2),
                                chr(1) || (SELECT l FROM b) || chr(2) || chr(1) || (SELECT r FROM b) || chr(2),
                                chr(1) || (SELECT l FROM b) || (SELECT r FROM b) || chr(2)) AS x
            FROM s) s
    )"""


def _conv_word_alphabet() -> str:
    norm = O.normalize("line", C.COVER)
    return f"SELECT DISTINCT unnest(string_split(array_to_string({O.word_tokens(norm, C.COVER)}, ''), '')) AS c FROM ({CONV_LINES})"


def _doc_word_symbols() -> str:
    norm = O.normalize("text", C.COVER)
    return f"SELECT doc_id, lang, unnest(string_split(array_to_string({O.word_tokens(norm, C.COVER)}, ''), '')) AS c FROM documents"


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    o["corpus_lines"] = DOC_LINES
    o["normalize_nfc"] = _line_select("nfc_normalize(line)", "nfc")
    o["strip_accents"] = _line_select("strip_accents(line)", "stripped")
    o["normalize_lower"] = _line_select("lower(line)", "lowered")
    o["normalize_ws"] = _line_select(O.normalize("line", C.WS_ONLY), "ws")
    o["normalize_full"] = _line_select(O.normalize("line", C.FULL_NORM), "normalized")
    seq = O.char_seq(O.normalize("line", C.LINE), C.LINE)
    o["char_symbols"] = f"SELECT doc_id, line_no, CAST(length({seq}) AS INTEGER) AS n_symbols, {seq} AS seq FROM ({DOC_LINES})"
    toks = O.word_tokens(O.normalize("line", C.WORD), C.WORD)
    o["word_punct_tokens"] = (
        f"SELECT doc_id, line_no, CAST(len({toks}) AS INTEGER) AS n_tokens, array_to_string({toks}, ' ') AS tokens FROM ({DOC_LINES})"
    )
    o["byte_symbols"] = (
        f"SELECT doc_id, line_no, CAST(octet_length(encode(line)) AS INTEGER) AS n_bytes, lower(hex(encode(line))) AS hex FROM ({DOC_LINES})"
    )
    o["baseline_counts"] = f"SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST({_n_words('text')} AS INTEGER) AS n_words FROM documents"

    # vocabulary
    o["alphabet_chars"] = (
        f"SELECT CAST(row_number() OVER (ORDER BY c) + 2 AS INTEGER) AS token_id, c AS symbol "
        f"FROM (SELECT DISTINCT unnest(string_split({seq}, '')) AS c FROM ({DOC_LINES}) WHERE {seq} <> '')"
    )
    o["alphabet_bytes"] = (
        f"SELECT CAST(row_number() OVER (ORDER BY c) + 2 AS INTEGER) AS token_id, c AS symbol_hex "
        f"FROM (SELECT DISTINCT unnest({O.byte_seq_hex('line')}) AS c FROM ({DOC_LINES}))"
    )
    o["byte_alphabet"] = (
        _train(CONV_LINES, C.BYTE)
        + """,
    bytes AS (SELECT CAST(b + 3 AS INTEGER) AS token_id, lower(printf('%02x', b)) AS token_hex, 'symbol' AS kind
              FROM generate_series(0, 255) t(b)),
    merged AS (SELECT DISTINCT l || r AS token_hex, min(step) AS first_step FROM train WHERE step > 0 GROUP BY l || r),
    newtok AS (SELECT token_hex, CAST(258 + row_number() OVER (ORDER BY first_step) AS INTEGER) AS token_id, 'merge' AS kind
               FROM merged WHERE token_hex NOT IN (SELECT token_hex FROM bytes))
    SELECT CAST(0 AS INTEGER) AS token_id, lower(hex(encode('<unknown>'))) AS token_hex, 'special' AS kind
    UNION ALL SELECT 1, lower(hex(encode('<begin>'))), 'special'
    UNION ALL SELECT 2, lower(hex(encode('<end>'))), 'special'
    UNION ALL SELECT token_id, token_hex, kind FROM bytes
    UNION ALL SELECT token_id, token_hex, kind FROM newtok"""
    )
    o["vocab_table"] = (
        _train(DOC_LINES, C.WORD)
        + f""", v AS ({O.final_vocab()})
        SELECT token_id, token,
               CASE WHEN token_id < 3 THEN 'special' WHEN token_id < (SELECT len(toks) FROM voc0) THEN 'symbol' ELSE 'merge' END AS kind
        FROM v"""
    )
    wseqs = O.sequences_cte(DOC_LINES, C.WORD)
    o["intern_sequences"] = f"""
    WITH s AS (SELECT array_to_string(seq, '') AS seq, weight, seq AS syms FROM ({wseqs})),
    a AS (SELECT c, CAST(row_number() OVER (ORDER BY c) + 2 AS INTEGER) AS id FROM (SELECT DISTINCT unnest(syms) AS c FROM s)),
    x AS (SELECT seq, unnest(syms) AS c, generate_subscripts(syms, 1) AS i FROM s)
    SELECT s.seq, s.weight, CAST(len(s.syms) AS INTEGER) AS n_symbols, string_agg(CAST(a.id AS VARCHAR), ' ' ORDER BY x.i) AS ids
    FROM s JOIN x USING (seq) JOIN a USING (c) GROUP BY s.seq, s.weight, s.syms"""
    o["token_id_lookup"] = (
        _train(DOC_LINES, C.WORD)
        + f""", vocab AS ({O.final_vocab()}),
        t AS (SELECT w AS token, count(*)::BIGINT AS n FROM (SELECT unnest({toks}) AS w FROM ({DOC_LINES})) GROUP BY w)
        SELECT t.token, t.n, coalesce(v.token_id, -1) AS token_id FROM t LEFT JOIN vocab v ON v.token = t.token"""
    )

    # pairs
    o["pair_counts_chars"] = _char_pairs()
    o["best_pair"] = _char_pairs(order_limit='ORDER BY cnt DESC, "left", "right" LIMIT 1')
    o["top_pairs"] = _char_pairs(order_limit=f'ORDER BY cnt DESC, "left", "right" LIMIT {C.TOP_K}')
    o["frequent_pairs"] = _char_pairs(counts_where=f"HAVING sum(weight) >= {C.FREQUENT_MIN}")
    bseqs = O.sequences_cte(CONV_LINES, C.BYTE)
    o["pair_counts_bytes"] = f"""
    WITH s AS ({bseqs}),
    p AS (SELECT seq[i] AS left_hex, seq[i + 1] AS right_hex, weight
          FROM (SELECT seq, weight, unnest(generate_series(1, len(seq) - 1)) AS i FROM s WHERE len(seq) > 1))
    SELECT left_hex, right_hex, sum(weight)::BIGINT AS cnt FROM p GROUP BY left_hex, right_hex"""
    o["apply_merge"] = (
        _best_and_merged()
        + """
    SELECT seq, weight, CAST(n_before AS INTEGER) AS n_before, CAST(len(toks) AS INTEGER) AS n_after,
           array_to_string(toks, ' ') AS merged FROM m"""
    )
    o["pair_count_delta"] = (
        _best_and_merged()
        + """,
    q AS (SELECT toks[i] AS "left", toks[i + 1] AS "right", weight
          FROM (SELECT toks, weight, unnest(generate_series(1, len(toks) - 1)) AS i FROM m WHERE len(toks) > 1))
    SELECT "left", "right", sum(weight)::BIGINT AS cnt FROM q GROUP BY "left", "right\""""
    )

    # training
    o["train_words"] = _merges_sql(DOC_LINES, C.WORD)
    o["train_lines"] = _merges_sql(DOC_LINES, C.LINE)
    o["train_bytes"] = _merges_sql(CONV_LINES, C.BYTE, hex_out=True)
    o["train_history"] = _merges_sql(DOC_LINES, C.HISTORY, where=f"WHERE (rank + 1) % {C.HISTORY.progress_every} = 0")
    o["train_stop_minfreq"] = _merges_sql(BENCH_LINES, C.MINFREQ)
    o["train_first_seen"] = (
        "WITH RECURSIVE "
        + O.train_ctes(
            O.sequences_cte(BENCH_LINES, C.FIRST_SEEN),
            C.FIRST_SEEN,
            first_seen=O.first_seen_sql(BENCH_LINES, C.FIRST_SEEN, "item_id, line_no"),
        )
        + " SELECT * FROM ("
        + O.merges_select(C.FIRST_SEEN)
        + ")"
    )
    o["train_specials"] = _merges_sql(DOC_LINES, C.SPECIALS)
    o["train_target_size"] = _merges_sql(DOC_LINES, C.TARGET)
    o["train_minfreq_docs"] = _merges_sql(DOC_LINES, C.NATURAL)
    o["top_pairs_history"] = (
        _train(DOC_LINES, C.WORD.with_(max_merges=5))
        + f""",
    p AS (SELECT step, toks, tk[i] AS l, tk[i + 1] AS r, n FROM (
            SELECT step, toks, tk, n, unnest(generate_series(1, len(tk) - 1)) AS i FROM (
              SELECT step, toks, x.n AS n, string_split(substr(x.s, 2, length(x.s) - 2), chr(2) || chr(1)) AS tk
              FROM (SELECT step, toks, unnest(st) AS x FROM train WHERE step > 0)) WHERE len(tk) > 1)),
    c AS (SELECT step, toks, l, r, sum(n)::BIGINT AS cnt FROM p GROUP BY step, toks, l, r),
    k AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY cnt DESC, list_position(toks, l), list_position(toks, r)) AS n FROM c)
    SELECT step::INTEGER AS merges, l AS "left", r AS "right", cnt FROM k WHERE n <= {C.TOP_K}"""
    )
    byte_train = _train(CONV_LINES, C.BYTE_TEXT)
    o["vocab_reload"] = byte_train + f""", v AS ({O.final_vocab()})
        SELECT token_id, CASE WHEN token_id < 3 THEN lower(hex(encode(token))) ELSE token END AS token_hex FROM v"""
    o["merges_reload"] = byte_train + " SELECT CAST(step - 1 AS INTEGER) AS rank, l AS left_hex, r AS right_hex FROM train WHERE step > 0"
    o["model_stats"] = (
        _train(DOC_LINES, C.WORD)
        + """
    SELECT CAST((SELECT len(toks) FROM train ORDER BY step DESC LIMIT 1) AS INTEGER) AS vocab_size,
           CAST((SELECT count(*) FROM train WHERE step > 0) AS INTEGER) AS n_merges,
           CAST((SELECT len(toks) - 3 FROM voc0) AS INTEGER) AS n_alphabet,
           CAST(3 AS INTEGER) AS n_specials"""
    )
    o["train_stability"] = _train(DOC_LINES, C.WORD) + " SELECT count(*)::BIGINT AS n_merges, 0::BIGINT AS n_diff FROM train WHERE step > 0"
    o["model_reload"] = _train(DOC_LINES, C.WORD) + ' SELECT CAST(step - 1 AS INTEGER) AS rank, l AS "left", r AS "right" FROM train WHERE step > 0'

    # encode / decode
    o["encode_docs"] = _word_encode() + " SELECT doc_id, n_tokens, ids FROM enc"
    o["encode_scan"] = _word_encode("benchmark", "item_id") + " SELECT item_id, n_tokens, ids FROM enc"
    o["encode_rank"] = _word_encode(order="rank") + " SELECT doc_id, n_tokens, ids FROM enc"
    o["format_token_ids"] = _word_encode() + " SELECT doc_id, ids FROM enc"
    o["parse_token_ids"] = _word_encode() + " SELECT doc_id, n_tokens AS n_ids, true AS same FROM enc"
    o["encode_stream"] = _word_encode() + " SELECT doc_id, n_tokens, ids FROM enc"
    o["decode_docs"] = f"SELECT doc_id, replace({O.normalize('text', C.WORD)}, '_', ' ') AS decoded FROM documents"
    o["decode_bytes"] = "SELECT conv_id, turn, text AS decoded FROM conversations"
    o["decode_ids_null"] = "SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN '' END AS decoded FROM documents"
    for name, opts in (("encode_lines", C.LINE), ("encode_bytes", C.BYTE_TEXT)):
        o[name] = _train(CONV_LINES, opts) + ",\n" + _line_encode_ctes(opts)
    o["jobs"] = (
        _word_encode()
        + f""" SELECT count(*)::BIGINT AS n_docs, sum(length({O.normalize('text', C.WORD)}))::BIGINT AS n_decoded_chars,
        (SELECT sum(n_tokens)::BIGINT FROM enc) AS n_tokens, (SELECT count(*)::INTEGER FROM fm) AS n_merges FROM documents"""
    )
    o["oov_docs"] = f"""
    WITH ca AS ({_conv_word_alphabet()}), ds AS ({_doc_word_symbols()})
    SELECT doc_id, CAST(count(*) AS INTEGER) AS n_unknown FROM ds WHERE c NOT IN (SELECT c FROM ca) GROUP BY doc_id"""

    # validation and metrics
    lseq = O.char_seq(O.normalize("line", C.LINE), C.LINE)
    lnorm = O.normalize("line", C.LINE)
    o["roundtrip_report"] = f"""
    WITH da AS (SELECT DISTINCT unnest(string_split({lseq}, '')) AS c FROM ({DOC_LINES})),
    cv AS (SELECT row_number() OVER () AS rid, {lnorm} AS nl, {lseq} AS cs FROM ({CONV_LINES})),
    bad AS (SELECT DISTINCT rid FROM (SELECT rid, unnest(string_split(cs, '')) AS c FROM cv) WHERE c NOT IN (SELECT c FROM da)),
    f AS (SELECT nl, cs, rid IN (SELECT rid FROM bad) AS skipped FROM cv),
    r AS (SELECT count(*)::BIGINT AS n_lines, count_if(skipped)::BIGINT AS n_skipped, count_if(NOT skipped)::BIGINT AS n_checked,
                 count_if(NOT skipped AND replace(cs, '_', ' ') <> replace(nl, '_', ' '))::BIGINT AS n_mismatched FROM f)
    SELECT n_lines, n_skipped, n_checked, n_mismatched, {_ratio('n_checked - n_mismatched', 'n_checked')} AS accuracy FROM r"""
    o["roundtrip_words"] = f"""
    SELECT count(*)::BIGINT AS n_lines, 0::BIGINT AS n_skipped, count(*)::BIGINT AS n_checked, 0::BIGINT AS n_mismatched,
           1.0::DOUBLE AS accuracy FROM ({DOC_LINES})"""
    o["byte_roundtrip"] = f"""
    WITH ca AS (SELECT DISTINCT unnest({O.byte_seq_hex('line')}) AS c FROM ({CONV_LINES})),
    dl AS (SELECT row_number() OVER () AS rid, line FROM ({DOC_LINES})),
    bad AS (SELECT DISTINCT rid FROM (SELECT rid, unnest({O.byte_seq_hex('line')}) AS c FROM dl) WHERE c NOT IN (SELECT c FROM ca)),
    r AS (SELECT count(*)::BIGINT AS n_lines, count_if(rid IN (SELECT rid FROM bad))::BIGINT AS n_skipped,
                 count_if(rid NOT IN (SELECT rid FROM bad))::BIGINT AS n_checked, 0::BIGINT AS n_mismatched FROM dl)
    SELECT n_lines, n_skipped, n_checked, n_mismatched, {_ratio('n_checked - n_mismatched', 'n_checked')} AS accuracy FROM r"""
    stats = _word_encode() + _stats_base()
    o["tokens_per_word"] = (
        stats
        + f""", t AS (SELECT sum(n_tokens)::BIGINT AS n_tokens, sum(n_words)::BIGINT AS n_words FROM base)
        SELECT n_tokens, n_words, {_ratio('n_tokens', 'n_words')} AS tokens_per_word FROM t"""
    )
    o["compression_by_lang"] = (
        stats
        + f""", t AS (SELECT lang, count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS n_chars, sum(n_words)::BIGINT AS n_words,
                          sum(n_tokens)::BIGINT AS n_tokens FROM base GROUP BY lang)
        SELECT lang, n_docs, n_chars, n_words, n_tokens, {_ratio('n_tokens', 'n_chars')} AS ratio_chars,
               {_ratio('n_tokens', 'n_words')} AS ratio_words FROM t"""
    )
    o["stats_report"] = (
        stats
        + f""", t AS (SELECT count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS n_chars, sum(n_words)::BIGINT AS n_words,
                          sum(n_tokens)::BIGINT AS n_tokens FROM base)
        SELECT CAST((SELECT count(*) FROM vocab) AS INTEGER) AS vocab_size,
               CAST((SELECT count(*) FROM fm) AS INTEGER) AS n_merges,
               n_docs, n_chars, n_words, n_tokens, {_ratio('n_tokens', 'n_words')} AS tokens_per_word,
               {_ratio('n_tokens', 'n_chars')} AS ratio_chars, {_ratio('n_tokens', 'n_words')} AS ratio_words FROM t"""
    )
    o["stats_rollup"] = (
        _word_encode()
        + f""",
    base AS (
      SELECT d.doc_id, d.lang, d.source, length(d.text) AS n_chars, {_n_words('d.text')} AS n_words, e.n_tokens
      FROM documents d JOIN enc e USING (doc_id)),
    t AS (SELECT lang, source, count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS n_chars, sum(n_words)::BIGINT AS n_words,
                 sum(n_tokens)::BIGINT AS n_tokens FROM base GROUP BY ROLLUP (lang, source))
    SELECT lang, source, n_docs, n_chars, n_words, n_tokens, {_ratio('n_tokens', 'n_chars')} AS ratio_chars,
           {_ratio('n_tokens', 'n_words')} AS ratio_words FROM t"""
    )
    o["token_frequency"] = (
        _word_encode()
        + """,
    occ AS (SELECT v.token_id, v.token FROM dw JOIN (SELECT w, unnest(st) AS tok FROM wtok) x USING (w)
            LEFT JOIN vocab v ON v.token = x.tok)
    SELECT CAST(coalesce(token_id, 0) AS INTEGER) AS token_id, coalesce(token, '<unknown>') AS token, count(*)::BIGINT AS n
    FROM occ GROUP BY ALL"""
    )
    o["vocab_coverage"] = f"""
    WITH ca AS ({_conv_word_alphabet()}), ds AS ({_doc_word_symbols()}),
    t AS (SELECT lang, count(*)::BIGINT AS n_symbols, count_if(c IN (SELECT c FROM ca))::BIGINT AS n_covered FROM ds GROUP BY lang)
    SELECT lang, n_symbols, n_covered, {_ratio('n_covered', 'n_symbols')} AS coverage FROM t"""
    for form in ("NFD", "NFKC", "NFKD"):
        o[f"normalize_{form.lower()}"] = f"""
    WITH m(c, t) AS (VALUES {_unicode_table(form)}),
    s AS (SELECT doc_id, line_no, unnest(string_split(line, '')) AS c, generate_subscripts(string_split(line, ''), 1) AS i FROM ({DOC_LINES}))
    SELECT doc_id, line_no, string_agg(coalesce(t, c), '' ORDER BY i) AS normal FROM s LEFT JOIN m USING (c) GROUP BY doc_id, line_no"""
    o["encode_cut_docs"] = o["encode_docs"]
    o["encode_cut_lines"] = o["encode_lines"]
    o["encode_whole_file"] = (
        _word_encode()
        + f""",
    there AS (SELECT doc_id FROM documents WHERE text IS NOT NULL AND {O.normalize('text', C.WORD)} <> ''),
    occ AS (SELECT coalesce(v.token_id, 0) AS token_id, row_number() OVER (ORDER BY dw.doc_id, dw.pos, x.i) - 1 AS p
            FROM dw JOIN there USING (doc_id) JOIN (SELECT w, unnest(st) AS tok, generate_subscripts(st, 1) AS i FROM wtok) x USING (w)
            LEFT JOIN vocab v ON v.token = x.tok)
    SELECT CAST(token_id AS INTEGER) AS token_id, count(*)::BIGINT AS n, sum(p)::BIGINT AS sum_pos FROM occ GROUP BY token_id"""
    )
    o["throughput"] = (
        _word_encode()
        + """
    SELECT kind, CAST(trial AS INTEGER) AS trial, (SELECT sum(n_tokens) FROM enc)::BIGINT AS n_tokens, TRUE AS timed
    FROM (VALUES ('encode'), ('decode')) k(kind), range(2) t(trial)"""
    )
    return o


ORACLES = build()
