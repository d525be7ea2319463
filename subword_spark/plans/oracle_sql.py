"""DuckDB SQL for the independent oracle of each registered query.

These strings are the correctness gate's other side: the same semantics written as plain
SQL over the driver's parquet views, without any of the library's code. Training is a
recursive CTE that merges one pair per step (canonical BPE, ties by vocabulary id); the
reference tokenizer's scan encode is a shift-reduce recursive CTE.

Sequences are spelled with delimiters: every token as chr(1) || token || chr(2), so
``replace`` of a delimited pair is an exact, left-to-right, non-overlapping merge.
"""

from __future__ import annotations

from ..options import BPEOptions

# Written out here on their own, so that an error in the library's classes shows as a mismatch
# (fixed values): white space of Python's str.split, newlines of its text mode, and a word or a
# single other character.
WS = (
    r"[\x{0009}\x{000a}\x{000b}\x{000c}\x{000d}\x{001c}\x{001d}\x{001e}\x{001f}\x{0020}\x{0085}\x{00a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NEWLINES = r"\r\n|[\r\n]"
WORD_OR_PUNCT = r"([_\p{L}\p{N}]+|[^_\p{L}\p{N}" + WS[1:-1] + "])"

D1, D2 = "chr(1)", "chr(2)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def specials_list(opts: BPEOptions) -> str:
    return "[" + ", ".join(q(s) for s in dict.fromkeys(opts.specials)) + "]::VARCHAR[]"


def lines_cte(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """(key, line_no, line): non-empty lines, 1-based position in the text."""
    return f"""
    SELECT {key}, line_no, line FROM (
      SELECT {key}, CAST(generate_subscripts(a, 1) AS INTEGER) AS line_no, unnest(a) AS line
      FROM (SELECT {key}, regexp_split_to_array({text}, {q(NEWLINES)}) AS a FROM {table})
    ) WHERE line <> ''"""


def collapse_ws(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q(f'^{WS}+|{WS}+$')}, '', 'g'), {q(WS + '+')}, ' ', 'g')"


def normalize(x: str, opts: BPEOptions) -> str:
    if opts.unicode_normalization == "NFC":
        x = f"nfc_normalize({x})"
    elif opts.unicode_normalization != "none":
        raise ValueError("only NFC has a DuckDB oracle")
    if opts.strip_accents:
        x = f"strip_accents({x})"
    if opts.lowercase:
        x = f"lower({x})"
    x = collapse_ws(x)
    if opts.add_visible_space:
        x = f"replace({x}, ' ', {q(opts.marker)})"
    return x


def char_seq(norm: str, opts: BPEOptions) -> str:
    m = q(opts.marker)
    return f"array_to_string(list_filter(string_split({norm}, {m}), lambda c: c <> ''), {m})"


def word_tokens(norm: str, opts: BPEOptions) -> str:
    m = q(opts.marker)
    return (
        f"flatten(list_transform(string_split({norm}, {m}), "
        f"lambda s: list_concat([{m}], regexp_extract_all(s, {q(WORD_OR_PUNCT)}, 1))))"
    )


def byte_seq_hex(x: str) -> str:
    """Byte symbols as a list of two-digit hex strings."""
    return f"list_transform(generate_series(1, octet_length(encode({x})) * 2, 2), lambda i: substr(lower(hex(encode({x}))), i::INTEGER, 2))"


def sequences_cte(lines: str, opts: BPEOptions, line_col: str = "line") -> str:
    """(seq VARCHAR[] of symbols, weight BIGINT): distinct sequences of a line table."""
    if opts.is_bytes:
        seq = byte_seq_hex(line_col)
        return f"SELECT seq, count(*)::BIGINT AS weight FROM (SELECT {seq} AS seq FROM ({lines})) WHERE len(seq) > 0 GROUP BY seq"
    norm = normalize(line_col, opts)
    if opts.unit == "word":
        return (
            f"SELECT string_split(w, '') AS seq, count(*)::BIGINT AS weight FROM "
            f"(SELECT unnest({word_tokens(norm, opts)}) AS w FROM ({lines})) WHERE w <> '' GROUP BY w"
        )
    return (
        f"SELECT string_split(s, '') AS seq, count(*)::BIGINT AS weight FROM "
        f"(SELECT {char_seq(norm, opts)} AS s FROM ({lines})) WHERE s <> '' GROUP BY s"
    )


def first_seen_sql(lines: str, opts: BPEOptions, order_cols: str) -> str:
    """One row ``fs``: symbols in order of first appearance (rows by ``order_cols``, then
    left to right)."""
    if opts.is_bytes:
        syms = byte_seq_hex("line")
    elif opts.unit == "word":
        syms = f"string_split(array_to_string({word_tokens(normalize('line', opts), opts)}, ''), '')"
    else:
        syms = f"string_split({char_seq(normalize('line', opts), opts)}, '')"
    return f"""
      SELECT list(sym ORDER BY {order_cols}, pos) AS fs FROM (
        SELECT *, row_number() OVER (PARTITION BY sym ORDER BY {order_cols}, pos) AS k FROM (
          SELECT {order_cols}, unnest(s) AS sym, generate_subscripts(s, 1) AS pos
          FROM (SELECT {order_cols}, {syms} AS s FROM ({lines}))
        ) WHERE sym <> ''
      ) WHERE k = 1"""


def train_ctes(seqs: str, opts: BPEOptions, first_seen: str | None = None) -> str:
    """CTEs ``seqs``, ``alpha``, ``train``: one recursion step per merge.

    ``train(step, toks, st, l, r, cnt, vs, fs)``: ``toks`` is the vocabulary list (position - 1 =
    id), ``st`` the delimited sequences with weights, ``fs`` the tie-break order; row ``step``
    holds merge ``step - 1``. Ties go by ``toks`` unless ``first_seen`` SQL (one row ``fs``)
    gives the first-appearance order.
    """
    fs_init = f"(SELECT fs FROM ({first_seen}))" if first_seen else "toks"
    tie = "fs"
    cap = opts.max_merges if opts.max_merges is not None else 1 << 30
    target = opts.target_vocabulary_size
    minf = opts.min_frequency
    sp = specials_list(opts)
    pair = f"{D1} || b.l || {D2} || {D1} || b.r || {D2}"
    return f"""
    seqs AS ({seqs}),
    alpha AS (SELECT DISTINCT unnest(seq) AS sym FROM seqs),
    voc0 AS (
      SELECT list_concat({sp}, coalesce((SELECT list(sym ORDER BY sym) FROM alpha WHERE NOT list_contains({sp}, sym)), []::VARCHAR[])) AS toks
    ),
    st0 AS (
      SELECT coalesce(list({{'s': {D1} || array_to_string(seq, {D2} || {D1}) || {D2}, 'n': weight}}), []) AS st FROM seqs
    ),
    train(step, toks, st, l, r, cnt, vs, fs) AS (
      SELECT 0, toks, (SELECT st FROM st0), NULL::VARCHAR, NULL::VARCHAR, NULL::BIGINT, len(toks), {fs_init} FROM voc0
      UNION ALL
      SELECT t.step + 1,
             CASE WHEN list_contains(t.toks, b.l || b.r) THEN t.toks ELSE list_append(t.toks, b.l || b.r) END,
             list_transform(t.st, lambda x: {{'s': replace(x.s, {pair}, {D1} || b.l || b.r || {D2}), 'n': x.n}}),
             b.l, b.r, b.cnt,
             CASE WHEN list_contains(t.toks, b.l || b.r) THEN t.vs ELSE t.vs + 1 END,
             CASE WHEN list_contains(t.fs, b.l || b.r) THEN t.fs ELSE list_append(t.fs, b.l || b.r) END
      FROM train t, LATERAL (
        SELECT l, r, sum(n)::BIGINT AS cnt
        FROM (
          SELECT tk[i] AS l, tk[i + 1] AS r, n FROM (
            SELECT tk, n, unnest(generate_series(1, len(tk) - 1)) AS i
            FROM (
              SELECT string_split(substr(x.s, 2, length(x.s) - 2), {D2} || {D1}) AS tk, x.n AS n
              FROM (SELECT unnest(t.st) AS x)
            ) WHERE len(tk) > 1
          )
        )
        GROUP BY l, r
        HAVING sum(n) >= {minf} AND NOT list_contains({sp}, l || r)
        ORDER BY cnt DESC, list_position(t.{tie}, l), list_position(t.{tie}, r)
        LIMIT 1
      ) b
      WHERE t.step < {cap} AND t.vs < {target}
    )"""


def merges_select(opts: BPEOptions, hex_out: bool = False) -> str:
    if hex_out:
        return "SELECT CAST(step - 1 AS INTEGER) AS rank, l AS left_hex, r AS right_hex, cnt, CAST(vs AS INTEGER) AS vocab_size FROM train WHERE step > 0"
    return "SELECT CAST(step - 1 AS INTEGER) AS rank, l AS \"left\", r AS \"right\", cnt, CAST(vs AS INTEGER) AS vocab_size FROM train WHERE step > 0"


def final_vocab() -> str:
    """(token_id, token) of the trained vocabulary."""
    return """SELECT CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS token_id, unnest(toks) AS token
              FROM (SELECT toks FROM train ORDER BY step DESC LIMIT 1)"""


def final_merges() -> str:
    """(rank, l, r, new) of the trained merges."""
    return "SELECT CAST(step - 1 AS INTEGER) AS rank, l, r, l || r AS new FROM train WHERE step > 0"


def scan_ctes(words: str, prefix: str = "sc") -> str:
    """Shift-reduce encode of distinct ``words(w, syms VARCHAR[])`` with the ``fm`` merges.

    ``{prefix}(w, st, rest)``: push the next symbol, or, when the top two symbols form a
    merge, replace them by their concatenation; finished when ``rest`` is empty and the
    top pair does not merge. Needs CTEs ``fm(l, r, new)`` in scope.
    """
    return f"""
    {prefix}(w, st, rest) AS (
      SELECT w, []::VARCHAR[], syms FROM ({words})
      UNION ALL
      SELECT s.w,
             CASE WHEN m.new IS NOT NULL THEN list_append(s.st[1:len(s.st) - 2], m.new)
                  ELSE list_append(s.st, s.rest[1]) END,
             CASE WHEN m.new IS NOT NULL THEN s.rest ELSE s.rest[2:] END
      FROM {prefix} s
      LEFT JOIN (SELECT DISTINCT l, r, new FROM fm) m
        ON len(s.st) >= 2 AND m.l = s.st[len(s.st) - 1] AND m.r = s.st[len(s.st)]
      WHERE m.new IS NOT NULL OR len(s.rest) > 0
    ),
    {prefix}_done AS (
      SELECT s.w, s.st FROM {prefix} s
      WHERE len(s.rest) = 0 AND NOT EXISTS (
        SELECT 1 FROM fm WHERE len(s.st) >= 2 AND fm.l = s.st[len(s.st) - 1] AND fm.r = s.st[len(s.st)]
      )
    )"""
