"""Tokenizer options: one frozen dataclass, passed to every operator."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

# Fixed values that must equal the reference's defaults for equal results.
DEFAULT_SPECIALS = ("<unknown>", "<begin>", "<end>")
DEFAULT_MARKER = "_"

MODEL_KINDS = ("character_bpe", "byte_bpe")
UNITS = ("line", "word")
UNICODE_FORMS = ("NFC", "NFKC", "NFD", "NFKD", "none")
ALPHABETS = ("observed", "full256")
ORDERS = ("scan", "rank")
TIE_BREAKS = ("vocab", "first_seen")


@dataclass(frozen=True)
class BPEOptions:
    """Training and inference options.

    ``unit='line'`` treats a whole normalised line as one symbol sequence (merges may
    cross words); ``unit='word'`` splits into words and single punctuation first.
    ``max_merges=None`` means no cap besides the vocabulary target; ``0`` means none.
    """

    # These defaults equal the reference's for equal results.
    model_kind: str = "character_bpe"
    unit: str = "line"
    target_vocabulary_size: int = 16000
    minimum_pair_frequency: int = 2
    max_merges: int | None = None
    progress_every: int = 100
    unicode_normalization: str = "NFC"
    strip_accents: bool = False
    lowercase: bool = False
    add_visible_space: bool = True
    specials: tuple[str, ...] = field(default=DEFAULT_SPECIALS)
    marker: str = DEFAULT_MARKER
    alphabet: str = "observed"
    # Equal counts: smallest (left, right) by vocabulary id, or by first appearance of the
    # symbols in the corpus order (merged tokens rank after all symbols, in creation order).
    tie_break: str = "vocab"
    # Candidates of one training round (results do not depend on it).
    batch_candidates: int = 2048

    def __post_init__(self) -> None:
        if self.model_kind not in MODEL_KINDS:
            raise ValueError(f"model_kind must be one of {MODEL_KINDS}")
        if self.unit not in UNITS:
            raise ValueError(f"unit must be one of {UNITS}")
        if self.unicode_normalization not in UNICODE_FORMS:
            raise ValueError(f"unicode_normalization must be one of {UNICODE_FORMS}")
        if self.alphabet not in ALPHABETS:
            raise ValueError(f"alphabet must be one of {ALPHABETS}")
        if self.tie_break not in TIE_BREAKS:
            raise ValueError(f"tie_break must be one of {TIE_BREAKS}")
        if len(self.marker) != 1:
            raise ValueError("marker must be one character")
        if self.unit == "word" and not self.is_bytes and not self.add_visible_space:
            raise ValueError("unit='word' needs add_visible_space: without markers the spaces between words are lost")
        if not self.specials:
            raise ValueError("at least one special token (the unknown token) is required")
        object.__setattr__(self, "specials", tuple(self.specials))

    @property
    def is_bytes(self) -> bool:
        return self.model_kind == "byte_bpe"

    @property
    def min_frequency(self) -> int:
        # A threshold of 0 or less would admit pairs that do not occur.
        return max(1, int(self.minimum_pair_frequency))

    def with_(self, **changes) -> "BPEOptions":
        return replace(self, **changes)

    def to_json(self) -> str:
        d = asdict(self)
        d["specials"] = list(self.specials)
        return json.dumps(d, ensure_ascii=False, sort_keys=True)

    @classmethod
    def from_json(cls, payload: str | dict) -> "BPEOptions":
        d = json.loads(payload) if isinstance(payload, str) else dict(payload)
        known = {f for f in cls.__dataclass_fields__}
        d = {k: v for k, v in d.items() if k in known}
        if "specials" in d:
            d["specials"] = tuple(d["specials"])
        return cls(**d)
