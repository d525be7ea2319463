"""Native column expressions for normalisation, splitting and baselines.

Everything here is a JVM-side ``Column`` (whole-stage codegen, no Python), except the
Unicode forms, which Spark does not have; those live in ``functions.unicode``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import BPEOptions

# The whitespace class of Python's str.split()/str.strip()/re \s, written out,
# because Java's \s and (?U)\s differ from Python on U+001C-U+001F.
# Code points: 09-0D, 1C-20, 85, A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000.
WS_CHARS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_CHARS}]"
# The same without what ``collapse_whitespace`` replaces natively: 09, 0A, 0D and 20.
RARE_WS = WS.replace(r"\x{09}-\x{0d}\x{1c}-\x{20}", r"\x{0b}\x{0c}\x{1c}-\x{1f}")
# Python's \w on str patterns is exactly letters, numbers and the underscore.
WORD_CHARS = r"\p{L}\p{N}_"
# One word (run of word characters) or one punctuation character.
WORD_OR_PUNCT = f"([{WORD_CHARS}]+|[^{WORD_CHARS}{WS_CHARS}])"
# Universal newlines, as Python's text mode reads a file.
NEWLINES = r"\r\n|\r|\n"


def _lit_regex(s: str) -> str:
    """A Java regex matching the literal string ``s``."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def collapse_whitespace(col: Column) -> Column:
    """Strip WS at both ends and turn inner runs of WS into one space.

    Plain replacements first, which a regex pass would leave as it finds them; only texts that
    then still hold two spaces or rarer white space take the pass, where every run becomes one
    space. The (at most one) space left at either end is trimmed.
    """
    plain = col
    for found, put in (("\n", " "), ("\r", " "), ("\t", " "), ("  ", " "), ("  ", " ")):
        plain = F.replace(plain, F.lit(found), F.lit(put))
    runs = F.contains(plain, F.lit("  ")) | plain.rlike(RARE_WS)
    return F.btrim(F.when(runs, F.regexp_replace(plain, f"{WS}+", " ")).otherwise(plain), F.lit(" "))


def normalize(col: Column, opts: BPEOptions) -> Column:
    """Unicode form, accent stripping, lowercase, whitespace, visible-space marker (in that order)."""
    out = col
    if opts.unicode_normalization != "none" or opts.strip_accents:
        from .unicode import unicode_form

        out = unicode_form(out, opts.unicode_normalization, opts.strip_accents)
    if opts.lowercase:
        out = F.lower(out)
    out = collapse_whitespace(out)
    if opts.add_visible_space:
        out = F.replace(out, F.lit(" "), F.lit(opts.marker))
    return out


def char_sequence_string(normalized: Column, opts: BPEOptions) -> Column:
    """Canonical string of a character-mode line: one character per symbol.

    Chunks between markers are kept when non-empty and re-joined by exactly one marker,
    so leading, trailing and repeated markers vanish.
    """
    return F.btrim(collapse_markers(normalized, opts), F.lit(opts.marker))


def collapse_markers(normalized: Column, opts: BPEOptions) -> Column:
    """Runs of markers as one marker."""
    m = opts.marker
    one = F.regexp_replace(normalized, _lit_regex(m) + "+", m.replace("\\", "\\\\").replace("$", "\\$"))
    return F.when(F.contains(normalized, F.lit(m + m)), one).otherwise(normalized)


def chars(col: Column) -> Column:
    """Array of code points of a string (empty string -> empty array)."""
    return F.filter(F.split(col, ""), lambda x: x != F.lit(""))


def word_tokens(normalized: Column, opts: BPEOptions) -> Column:
    """Marker-segment split: per segment a marker, then words or single punctuation.

    Written as one ``regexp_extract_all`` over ``marker + text``: every marker is its own
    token and words and punctuation never contain it, which yields exactly one marker
    before each segment (empty segments included) followed by that segment's tokens.
    """
    m = _lit_regex(opts.marker)
    pattern = f"({m}|[{WORD_CHARS}&&[^{m}]]+|[^{WORD_CHARS}{WS_CHARS}{m}])"
    return F.regexp_extract_all(F.concat(F.lit(opts.marker), normalized), F.lit(pattern), F.lit(1))


def byte_string(col: Column) -> Column:
    """UTF-8 bytes of a string as one character per byte (U+0000-U+00FF)."""
    return F.decode(F.encode(col, "UTF-8"), "ISO-8859-1")


def bytes_to_text(col: Column) -> Column:
    """Inverse of ``byte_string``: strict, raises on a character above U+00FF or bad UTF-8."""
    return F.decode(F.encode(col, "ISO-8859-1"), "UTF-8")


def hex_symbol(col: Column) -> Column:
    """Hex spelling of a byte-mode symbol (two digits per byte), for printing and oracles."""
    return F.lower(F.hex(F.encode(col, "ISO-8859-1")))


def split_lines(col: Column) -> Column:
    """Universal-newline split of a text into lines (array<string>)."""
    return F.split(col, NEWLINES)


def whitespace_words(col: Column) -> Column:
    """Words of ``str.split()``: runs of non-WS characters."""
    return F.filter(F.split(col, f"{WS}+"), lambda x: x != F.lit(""))


def n_chars(col: Column) -> Column:
    """Number of code points."""
    return F.char_length(col)


def n_whitespace_words(col: Column) -> Column:
    return F.size(whitespace_words(col))
