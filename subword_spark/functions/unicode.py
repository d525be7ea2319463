"""Unicode normal forms and accent stripping.

Spark has no built-in Unicode normaliser. Texts of characters below U+0300 are mapped natively,
character by character; the others go through ``unicodedata`` in an Arrow-batched pandas UDF,
the one Python step of normalisation.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def normalize_one(text: str | None, form: str, strip_accents: bool) -> str | None:
    """Python reference of the per-string step (also used by tests)."""
    if text is None or text.isascii():
        return text
    if form != "none":
        text = unicodedata.normalize(form, text)
    if strip_accents:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return text


@lru_cache(maxsize=None)
def _udf(form: str, strip_accents: bool):
    @pandas_udf("string")
    def _unicode(s: pd.Series) -> pd.Series:
        return s.map(lambda t: normalize_one(t, form, strip_accents))

    return _unicode


def _ranges_class(cps: list[int]) -> str:
    """A Java regex character class of the given code points, as ranges."""
    parts, i = [], 0
    cps = sorted(set(cps))
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        a, b = cps[i], cps[j]
        parts.append(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}")
        i = j + 1
    return "[" + "".join(parts) + "]"


@lru_cache(maxsize=None)
def nfc_suspects() -> str:
    """Characters whose presence may make a string change under NFC.

    Built from the Unicode database by rule: characters that are not NFC on their own,
    characters that can be the second half of a canonical composition, and all
    characters with a non-zero combining class (reordering). A string without any of
    them is already NFC, so it needs no Python call.
    """
    out: list[int] = []
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
            out.append(cp)
            continue
        d = unicodedata.decomposition(c)
        if d and not d.startswith("<"):
            parts = d.split()
            if len(parts) == 2:
                out.append(int(parts[1], 16))
    out.extend(range(0x1161, 0x1176))  # Hangul vowel jamo compose with a leading consonant
    out.extend(range(0x11A8, 0x11C3))  # Hangul trailing consonants compose with an LV syllable
    return _ranges_class(out)


@lru_cache(maxsize=None)
def nfc_check() -> str:
    """A one-range regex matching any character at or above the first NFC suspect.

    Java tests a long character class range by range, so the full class is slower than
    calling Python; a single range costs one comparison per character. Text below the
    bound (ASCII, Latin-1, Latin Extended) never reaches Python.
    """
    import re

    first = min(int(h, 16) for h in re.findall(r"x\{([0-9a-f]+)\}", nfc_suspects()))
    return f"[\\x{{{first:x}}}-\\x{{10ffff}}]"


#: Below this every character is a starter, and so is the first character of what it turns
#: into; no two of them compose. So each character can be replaced on its own.
NATIVE_BELOW = 0x300


@lru_cache(maxsize=None)
def _replacements(form: str, strip_accents: bool) -> str:
    """What each character below ``NATIVE_BELOW`` turns into, as a JSON list."""
    return json.dumps([normalize_one(chr(c), form, strip_accents) for c in range(NATIVE_BELOW)])


def _native_form(col: Column, form: str, strip_accents: bool) -> Column:
    """The form of texts whose characters are all below ``NATIVE_BELOW``."""
    if form == "NFC" and not strip_accents:
        return col
    table = F.from_json(F.lit(_replacements(form, strip_accents)), "array<string>")
    each = F.transform(F.split(col, ""), lambda c: F.when(c == "", c).otherwise(F.get(table, F.ascii(c))))
    return F.when(col.rlike("[^\\x00-\\x7f]"), F.array_join(each, "")).otherwise(col)


def crosses_to_python(col: Column, form: str = "NFC", strip_accents: bool = False) -> Column:
    """Whether a text needs the UDF: it has a character from ``NATIVE_BELOW`` on."""
    check = nfc_check() if form == "NFC" and not strip_accents else f"[\\x{{{NATIVE_BELOW:x}}}-\\x{{10ffff}}]"
    return F.coalesce(col.rlike(check), F.lit(False))


def unicode_form(col: Column, form: str = "NFC", strip_accents: bool = False) -> Column:
    """``unicodedata.normalize(form)`` and optional removal of combining marks.

    Texts of ASCII, Latin and other characters below U+0300 are mapped character by character
    in the JVM (for NFC alone they stay as they are). Only rows with a character from there on,
    where marks are reordered and characters compose, go to Python; the others cross as nulls.
    """
    if form == "none" and not strip_accents:
        return col
    needs = crosses_to_python(col, form, strip_accents)
    return F.coalesce(_udf(form, strip_accents)(F.when(needs, col)), _native_form(col, form, strip_accents))
