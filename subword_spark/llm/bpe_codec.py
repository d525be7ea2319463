"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

Encoding. A pre-token's bytes are cut into tokens so that every neighbouring pair is
compatible: merging the two tokens' bytes on their own would give just these two. Such a
sequence is unique and is what applying the merges in rank order gives. The encoder takes the
longest token match at a place (all matches come from one Aho-Corasick pass), falls back to
the next shorter token where the pair is not compatible, and steps back where no token fits;
a place that was left is never tried again, so the time is linear. Compatibility undoes
merges on both sides of the boundary, latest first, looking for a merge across it that would
have come earlier; results are kept in a table.

Decoding gathers the tokens' bytes from one buffer through a table of offsets.

The tokenizer is read from a tokenizers JSON file. Normaliser and pre-tokeniser: texts without
characters from U+0300 on take a short path that gives the same pieces; other texts go
through the file's own normaliser and pre-tokeniser.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import give_back, prepare, returning, row_field, source
from .words import slices

#: Pieces that a worker remembers in each of two generations, and pairs of tokens.
_CACHE = 100_000
_PAIRS = 1 << 17
#: Bytes of text that are encoded before their ids leave the worker.
_SLICE = 1 << 19
_LONG = 64
_FINAL = 0x10000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable bytes stand for themselves, the
    others for U+0100 onwards in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """Tokens and merges with the tables of the backtracking encoder. Tokens are numbered by
    rank here: characters first, then the results of the merges in order."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        made: dict[str, int] = {}
        base = sorted({c for pair in merges for part in pair if part in vocab for c in part} | {t for t in vocab if len(t) == 1})
        self.text = [c for c in base if c in vocab]
        made = {t: i for i, t in enumerate(self.text)}
        self.left, self.right = list(range(len(made))), list(range(len(made)))
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a not in made or b not in made:
                continue  # a part that no text can give
            if a + b in made:
                raise ValueError(f"two merges give the token {a + b!r}")
            made[a + b] = self.pair[made[a], made[b]] = len(self.text)
            self.text.append(a + b)
            self.left.append(made[a])
            self.right.append(made[b])
        self.chars = made.keys() & set(base)
        self.fits: dict[tuple[int, int], bool] = {}
        # A token that its own bytes do not merge into is never a result.
        real = [False] * len(self.text)
        for t in range(len(self.text)):
            a, b = self.left[t], self.right[t]
            real[t] = a == t or (real[a] and real[b] and self._apart(a, b, t))
        self.id = [vocab[t] for t in self.text]
        self.size = [len(t) for t in self.text]
        self.shorter: list[int] = []
        self.find = ahocorasick.Automaton()
        for t, s in enumerate(self.text):
            if real[t]:
                self.find.add_word(s, t)
            cut = next((made[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in made and real[made[s[:n]]]), -1)
            self.shorter.append(cut)
        self.find.make_automaton()

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge across the boundary comes before ``limit``, as merges are undone."""
        while True:
            if self.pair.get((a, b), limit) < limit:
                return False
            if a > b:  # undo the later of the two tokens
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True

    def compatible(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > _PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = self._apart(a, b, 1 << 62)
        return known

    def encode(self, s: str) -> list[int]:
        """Vocabulary ids of a string; characters outside the vocabulary are left out, as the
        merges never cross them."""
        if not s:
            return []
        longest = [-1] * len(s)
        for end, t in self.find.iter(s):  # ends grow, so the last match at a start is the longest
            longest[end - self.size[t] + 1] = t
        if -1 in longest and any(c not in self.chars for c in s):
            return [t for part in re.split("([" + "".join(map(re.escape, set(s) - self.chars)) + "])", s) if not set(part) - self.chars for t in self.encode(part)]
        open_ = bytearray(b"\1") * (len(s) + 1)
        out: list[int] = []
        at, t = 0, longest[0]
        while at < len(s):
            last = out[-1] if out else -1
            while True:
                end = at + self.size[t]
                if open_[end] and (last < 0 or self.compatible(last, t)):
                    out.append(t)
                    at = end
                    t = longest[at] if at < len(s) else -1
                    break
                t = self.shorter[t]
                if t < 0:  # nothing fits here: give up this place and shorten the token before
                    open_[at] = 0
                    out.pop()
                    at -= self.size[last]
                    t = last
                    break
        return [self.id[t] for t in out]


class Codec(dict):
    """A tokenizer file; as a dict, the ids of known pieces as little-endian 32-bit numbers."""

    def __init__(self, spec: str):
        super().__init__()
        self.old: dict[str, bytes] = {}
        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "byte_fallback", "dropout", "ignore_merges")):
            raise ValueError("not a plain BPE model")
        if data.get("decoder") or data.get("post_processor"):
            raise ValueError("decoders and post-processors are not supported")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError("added tokens have to match the plain text")
        kinds = [n["type"] for n in data["normalizer"]["normalizers"]]
        split, level = data["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("another normaliser or pre-tokeniser")
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges({self._inner(t): i for t, i in model["vocab"].items()}, [(self._inner(a), self._inner(b)) for a, b in merges])
        self.alphabet = byte_alphabet()
        self.special = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in data["added_tokens"]}
        parts = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(parts) + ")") if parts else None
        self.pieces = regex.compile(split["pattern"]["Regex"])
        # Without vocabulary: only the file's normaliser and pre-tokeniser are used.
        whole = Tokenizer.from_str(json.dumps(data | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}))
        self.normalizer, self.pre = whole.normalizer, whole.pre_tokenizer

        tokens = {i: t for t, i in model["vocab"].items()} | {int(t["id"]): t["content"] for t in data["added_tokens"]}
        raw = [tokens.get(i, "").encode() + b" " for i in range(max(tokens) + 1)]
        self.at = np.r_[0, np.cumsum([len(x) for x in raw])]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def _inner(self, token: str) -> str:
        """A token with the end-of-word suffix: its last character moves up by ``_FINAL``."""
        if not self.suffix or not token.endswith(self.suffix) or token == self.suffix:
            return token
        token = token[: -len(self.suffix)]
        return token[:-1] + chr(ord(token[-1]) + _FINAL)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = self._ids("".join([self.alphabet[b] for b in piece.encode()]))
        if len(piece) <= _LONG:
            if len(self) >= _CACHE:  # pieces that are not met again while as many others are go
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _ids(self, mapped: str) -> bytes:
        if self.suffix:
            mapped = mapped[:-1] + chr(ord(mapped[-1]) + _FINAL)
        return np.array(self.merges.encode(mapped), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        if text.isascii() or max(text) < "̀":
            return b"".join([self[p] for p in self.pieces.findall(text.lower())])
        return b"".join([self._ids(p) for p, _ in self.pre.pre_tokenize_str(self.normalizer.normalize_str(text))])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.specials is None or "<" not in text and all("<" in s for s in self.special):
            return self._plain(text)
        return b"".join([self.special.get(p) or self._plain(p) for p in self.specials.split(text) if p])

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by a space, as UTF-8."""
        if not len(ids):
            return b""
        start = self.at[ids]
        size = self.at[ids + 1] - start
        ends = np.cumsum(size)
        return self.bytes[np.arange(ends[-1]) + np.repeat(start - ends + size, size)][:-1].tobytes()


_CODECS: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """The codec of a tokenizer file's content, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
        give_back()  # what parsing the file has left
    return _CODECS[key]


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:  # on the driver; the content goes to the workers
        return f.read()


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, row: bool = False) -> DataFrame:
    """Encode every whole text: ``id, ids`` (binary, little-endian unsigned 32-bit numbers).

    ``path`` names a tokenizers JSON file on the driver. With ``decoded`` also ``decoded``,
    the text that decoding ``ids`` gives; with ``row`` also ``row``, a struct of all input
    columns. Special tokens in a text are their ids.

    Null and empty texts have no ids and decode to the empty text. Rows are independent, so
    null ids, ties and repeats are passed on. Empty table: no rows. Other input columns are
    never read by name. A narrow map: no shuffle, and a text is whole however long.
    """
    prepare(docs.sparkSession)
    spec = _spec(path)
    rows = source(docs, id_col, text_col, row)

    def run(batches):
        c = codec(spec)
        for batch in batches:
            for part, texts in slices(batch, text_col, _SLICE):
                ids = [c.encode(t) for t in texts.to_pylist()]
                out = {"id": part["id"], "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["decoded"] = pa.array([c.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids], pa.binary()).cast(pa.string())
                if row:
                    out["row"] = part["row"]
                yield pa.RecordBatch.from_pydict(out)

    fields = f"id {rows.schema['id'].dataType.simpleString()}, ids binary" + (", decoded string" if decoded else "")
    return rows.mapInArrow(returning(run), fields + row_field(rows))


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The table with ``decoded``, the text of its packed ids; null ids give null."""
    prepare(encoded.sparkSession)
    spec = _spec(path)

    @F.pandas_udf("string")
    def text(ids):
        c = codec(spec)
        return ids.map(lambda x: None if x is None else c.decode(np.frombuffer(x, "<u4").astype(np.int64)).decode())

    return encoded.withColumn("decoded", text(F.col(ids_col)))
