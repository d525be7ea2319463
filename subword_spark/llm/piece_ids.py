"""Token ids of many texts by the tokenizers library, each distinct piece encoded once.

Lower-cased texts of a slice are cut into pieces together, by the kinds of their characters;
only pieces that the worker has not met yet go to the library. Texts with special tokens or
with characters from U+0300 on go to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

#: The pattern of pieces that is cut by kinds of characters (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN = 1_000_000
_BEYOND = re.compile("[\u0300-\U0010ffff]")
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _kinds() -> np.ndarray:
    """The kind of each character up to U+03FF."""
    kinds = np.full(0x400, _OTHER, np.uint8)
    for c in range(0x400):
        for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
            if regex.match(pattern, chr(c)):
                kinds[c] = kind
    return kinds


def cut(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lower-case UTF-8 text below U+0400: the first byte of each piece, and which bytes
    belong to pieces."""
    n = len(data)
    kind = np.zeros(n + 1, np.uint8)  # a space ends the last piece
    kind[:n] = kinds[data]
    lead = np.flatnonzero(data >= 0xC0)
    of = kinds[((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)]
    kind[lead] = kind[lead + 1] = of
    real = kind[:n] != _SPACE
    start = real.copy()
    start[1:] &= (kind[1:n] != kind[: n - 1]) | (kind[1:n] == _NUMBER)
    start[lead + 1] = False
    # An apostrophe that begins a piece takes one of these endings along.
    quote = np.flatnonzero(data == 39)
    quote = quote[start[quote] & (kind[quote + 1] == _LETTER)]
    if len(quote):
        after = np.r_[data, 0, 0]
        a, b = after[quote + 1], after[quote + 2]
        two = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        start[quote[two | three] + 1] = False
        for end in (quote[two] + 2, quote[three] + 3):
            end = end[end < n]
            start[end[kind[end] == _LETTER]] = True
    return np.flatnonzero(start), real


class PieceIds:
    """A tokenizers file of the kind above: lower case, byte-level pieces, word-end tokens."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_padding()
        self.whole.no_truncation()
        data = json.loads(spec)
        model = data["model"]
        suffix = model.get("end_of_word_suffix") or ""
        pre = (data.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [n["type"] for n in (data.get("normalizer") or {}).get("normalizers", [])]
        self.kinds = None
        if suffix and steps == ["NFC", "Replace", "Lowercase"] and (pre[0].get("pattern") or {}).get("Regex") == PIECES and {x + suffix for x in _byte_letters()} <= model["vocab"].keys():
            self.kinds = _kinds()
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in data["added_tokens"]) or r"(?!)")
        self.last = np.zeros(max([*model["vocab"].values(), 0]) + 1, bool)
        self.last[[i for t, i in model["vocab"].items() if suffix and t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Each piece ends in the only one of its tokens that ends a word."""
        for lo in range(0, len(pieces), 5000):
            part = pieces[lo : lo + 5000]
            ids = np.array(self.whole.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("a piece is not one word of the tokenizer")
            raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.update(zip(part, [raw[a:b] for a, b in zip(at, at[1:])]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (a null is empty), one after another, and each text's number of ids."""
        texts = [t or "" for t in texts.to_pylist()]
        fast = [self.kinds is not None and (t.isascii() or not _BEYOND.search(t)) and not self.special.search(t) for t in texts]
        lower = [t.lower().encode() if f else b"" for t, f in zip(texts, fast)]
        data = np.frombuffer(b"\n".join(lower), np.uint8)
        flat, size, head = self._by_piece(data) if len(data) else (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        first = np.searchsorted(head, np.cumsum([0, *[len(t) + 1 for t in lower]]))
        counts = np.diff(np.r_[0, np.cumsum(size)][first])
        if all(fast):
            return flat, counts
        out = np.split(flat, np.cumsum(counts)[:-1])
        slow = [i for i, f in enumerate(fast) if not f]
        for i in slow:
            out[i] = np.array(self.whole.encode_batch_fast([texts[i]], add_special_tokens=False)[0].ids, np.uint32)
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _by_piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        head, real = cut(data, self.kinds)
        if not len(head):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), head
        at = np.r_[0, np.cumsum(real)][np.r_[head, len(data)]]
        pieces = pa.Array.from_buffers(pa.large_string(), len(head), [None, pa.py_buffer(at), pa.py_buffer(data[real])])
        coded = pieces.dictionary_encode()
        code, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        known = self.known
        if len(known) + len(distinct) > _KNOWN:
            known.clear()
        self._learn([p for p in distinct if p not in known])
        ids = [known[p] for p in distinct]
        first = np.cumsum([0, *map(len, ids)]) // 4
        size = np.diff(first)[code]
        ends = np.cumsum(size)
        return np.frombuffer(b"".join(ids), np.uint32)[np.arange(ends[-1]) + np.repeat(first[code] - ends + size, size)], size, head


def _byte_letters() -> list[str]:
    """The characters that stand for the 256 bytes."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return [chr(b) for b in shown] + [chr(256 + i) for i in range(256 - len(shown))]


_MADE: dict[str, PieceIds] = {}


def piece_ids(spec: str) -> PieceIds:
    """The encoder of a tokenizers file's content, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _MADE:
        _MADE[key] = PieceIds(spec)
    return _MADE[key]
