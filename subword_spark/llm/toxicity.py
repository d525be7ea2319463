"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a token: the word's log odds of toxic text, the largest and mean log odds of its
character 4-grams and 6-grams, and a fixed random word vector. The log odds come from the
training sample; while the network is trained, each half of the sample uses the log odds of
the other half. Two gated recurrent passes read a window of tokens; attention weighs their
states and a logistic unit scores the window. A document's score is its highest window's.

Training sees documents, not windows: each round scores all windows of the sample and then
fits the network to each document's highest window.

The sample is bounded (:class:`Fit`); scoring reads every window of every whole text, in
Arrow batches, without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, prepare, returning, row_field, source
from .words import Words, slices, split_words, text_of_word, word_hashes

_BITS = 18
_GRAMS = (4, 6)
_WORD_DIMS = 3
DIMS = 1 + 2 * len(_GRAMS) + _WORD_DIMS
HIDDEN, ATTEND = 8, 8
WINDOW, STRIDE = 64, 32

#: Tokens are runs of ASCII letters and digits and of all bytes beyond ASCII.
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and of the fit. A sampled text counts as a whole up to
    ``spans`` times ``span_chars`` characters; of a longer one, ``spans`` spans are sampled from
    all over it."""

    max_per_class: int = 1500
    span_chars: int = 4_000
    spans: int = 8
    rounds: int = 6
    updates: int = 100  # of the weights in each round, in whole passes over the sample
    seed: int = 5


@dataclass
class Tokens:
    """Tokens of some texts as numbers of distinct tokens, and the distinct tokens' bytes."""

    first: np.ndarray
    token: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    at: np.ndarray  # of each distinct token, its first byte in data; one more at the end


def tokens(texts: pa.Array) -> Tokens:
    w: Words = split_words(texts, _BREAK)
    w.data = _LOWER[w.data]
    h, some, token = np.unique(word_hashes(w, 7, space=_BREAK)[0], return_index=True, return_inverse=True)
    length = w.ends[some] - w.starts[some]
    at = np.r_[0, np.cumsum(length)]
    byte = np.arange(at[-1]) - np.repeat(at[:-1], length) + np.repeat(w.starts[some], length)
    return Tokens(w.first, token, h, w.data[byte], at)


def grams(t: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of each distinct token, with an edge mark on both sides:
    ``(cell of each n-gram, first n-gram of each token)``. A short token is one n-gram."""
    size = np.diff(t.at) + 2
    at = np.r_[0, np.cumsum(size)]
    data = np.zeros(at[-1], np.uint64)
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    data[inner] = t.data
    data[~inner] = 10
    padded = np.r_[data, np.zeros(n, np.uint64)]
    h = np.zeros(at[-1], np.uint64)
    for j in range(n):
        h = h * np.uint64(0x100000001B3) + padded[j : j + at[-1]] + np.uint64(1)
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)
    count = np.maximum(size - n + 1, 1)
    first = np.r_[0, np.cumsum(count)]
    pick = np.arange(first[-1]) - np.repeat(first[:-1], count) + np.repeat(at[:-1], count)
    return h[pick].astype(np.int64), first[:-1]


def _log_odds(cells: np.ndarray, weight: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Shrunk log odds of toxic text by cell, 0 where nothing is known."""
    pos = np.bincount(cells, weight * toxic, 1 << _BITS)
    all_ = np.bincount(cells, weight, 1 << _BITS)
    p = (pos + 10 * prior) / (all_ + 10)
    return np.clip(np.log(p / (1 - p)) - np.log(prior / (1 - prior)), -4, 4).astype(np.float32)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - _BITS)).astype(np.int64)


def odds(t: Tokens, label: np.ndarray) -> list[np.ndarray]:
    """Tables of log odds: of words, then of character n-grams."""
    of_token = label[text_of_word(t.first)]
    n = np.bincount(t.token, minlength=len(t.hash)).astype(float)
    pos = np.bincount(t.token, of_token, len(t.hash))
    prior = float(np.clip(pos.sum() / max(n.sum(), 1), 1e-4, 1 - 1e-4))
    out = [_log_odds(_cell(t.hash), n, pos / np.maximum(n, 1), prior)]
    for g in _GRAMS:
        cells, first = grams(t, g)
        owner = np.repeat(np.arange(len(t.hash)), np.diff(np.r_[first, len(cells)]))
        out.append(_log_odds(cells, n[owner], (pos / np.maximum(n, 1))[owner], prior))
    return out


def inputs(t: Tokens, tables: list[np.ndarray]) -> np.ndarray:
    """The input vector of each distinct token."""
    x = np.zeros((len(t.hash), DIMS), np.float32)
    if not len(t.hash):
        return x
    x[:, 0] = tables[0][_cell(t.hash)]
    for i, g in enumerate(_GRAMS):
        cells, first = grams(t, g)
        v = tables[i + 1][cells]
        x[:, 1 + 2 * i] = np.maximum.reduceat(v, first)
        x[:, 2 + 2 * i] = np.add.reduceat(v, first) / np.diff(np.r_[first, len(v)])
    for k in range(_WORD_DIMS):
        bits = (t.hash >> np.uint64(10 * k)) & np.uint64(1023)
        x[:, DIMS - _WORD_DIMS + k] = (bits.astype(np.float32) / 1023 - 0.5) * 0.5
    return x


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, first token, length)`` of all overlapping windows; a text without tokens has
    one window of length 0."""
    n = np.diff(first)
    count = np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return text, first[text] + k * STRIDE, np.minimum(WINDOW, n[text] - k * STRIDE)


def init(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def w(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {"Wa": w(2 * HIDDEN, ATTEND), "ba": np.zeros(ATTEND, np.float32), "v": w(ATTEND), "u": w(2 * HIDDEN), "c": np.zeros(1, np.float32)}
    for d in "fb":
        p |= {f"W{d}": w(DIMS, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"U{d}": w(HIDDEN, 3 * HIDDEN)}
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def forward(p: dict, x: np.ndarray, token: np.ndarray, length: np.ndarray, keep: bool = False):
    """Logits of windows. x: inputs of the distinct tokens; token: (steps, windows)."""
    steps, n = token.shape
    real = np.arange(steps)[:, None] < length[None, :]
    full = real.all(1)
    hs = np.zeros((steps, n, 2 * HIDDEN), np.float32)
    saved = {}
    for d, order, at in (("f", range(steps), 0), ("b", range(steps - 1, -1, -1), HIDDEN)):
        xp = x @ p[f"W{d}"] + p[f"b{d}"]
        u_gates, u_new = p[f"U{d}"][:, : 2 * HIDDEN], p[f"U{d}"][:, 2 * HIDDEN :]
        h = np.zeros((n, HIDDEN), np.float32)
        for s in order:
            xs = xp[token[s]]
            zr = _sigmoid(xs[:, : 2 * HIDDEN] + h @ u_gates)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            hu = h @ u_new
            new = np.tanh(xs[:, 2 * HIDDEN :] + r * hu)
            before = h
            h = new + z * (h - new) if full[s] else np.where(real[s][:, None], new + z * (h - new), h)
            hs[s, :, at : at + HIDDEN] = h
            if keep:
                saved[d, s] = (before, z, r, hu, new)
    a = np.tanh(hs @ p["Wa"] + p["ba"])
    e = np.where(real, a @ p["v"], -np.inf)
    top = np.max(e, 0, initial=-1e30)
    weight = np.where(real, np.exp(e - top), 0)
    weight /= np.maximum(weight.sum(0), 1e-30)
    pooled = np.einsum("sn,snh->nh", weight, hs)
    logit = pooled @ p["u"] + p["c"][0]
    return (logit, (hs, a, weight, pooled, real, saved)) if keep else logit


def gradient(p: dict, x: np.ndarray, token: np.ndarray, length: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss, by back-propagation through time."""
    logit, (hs, a, weight, pooled, real, saved) = forward(p, x, token, length, keep=True)
    steps, n = token.shape
    g = {k: np.zeros_like(v) for k, v in p.items()}
    d_logit = ((_sigmoid(logit) - label) / n).astype(np.float32)
    g["u"], g["c"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
    d_pooled = d_logit[:, None] * p["u"]
    d_weight = np.einsum("nh,snh->sn", d_pooled, hs)
    d_e = weight * (d_weight - (weight * d_weight).sum(0))
    g["v"] = np.einsum("sn,sna->a", d_e, a)
    d_a = d_e[:, :, None] * p["v"] * (1 - a * a)
    g["Wa"], g["ba"] = np.einsum("snh,sna->ha", hs, d_a), d_a.sum((0, 1))
    d_hs = weight[:, :, None] * d_pooled + d_a @ p["Wa"].T
    for d, order, at in (("f", range(steps - 1, -1, -1), 0), ("b", range(steps), HIDDEN)):
        u_gates, u_new = p[f"U{d}"][:, : 2 * HIDDEN], p[f"U{d}"][:, 2 * HIDDEN :]
        d_h = np.zeros((n, HIDDEN), np.float32)
        for s in order:
            before, z, r, hu, new = saved[d, s]
            on = real[s][:, None]
            d_h = d_h + d_hs[s, :, at : at + HIDDEN]
            d_out = np.where(on, d_h, 0)
            d_new = d_out * (1 - z) * (1 - new * new)
            d_z = d_out * (before - new) * z * (1 - z)
            d_r = d_new * hu * r * (1 - r)
            d_gates = np.concatenate([d_z, d_r], 1)
            d_x = np.concatenate([d_gates, d_new], 1)
            g[f"W{d}"] += x[token[s]].T @ d_x
            g[f"b{d}"] += d_x.sum(0)
            g[f"U{d}"][:, : 2 * HIDDEN] += before.T @ d_gates
            g[f"U{d}"][:, 2 * HIDDEN :] += before.T @ (d_new * r)
            d_h = np.where(on, d_out * z + d_gates @ u_gates.T + (d_new * r) @ u_new.T, d_h)
    return g


def _spread(t: Tokens, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Tokens of windows, one column each; places beyond a window hold token 0."""
    steps = max(1, int(length.max(initial=0)))
    at = start[None, :] + np.arange(steps)[:, None]
    return np.where(np.arange(steps)[:, None] < length[None, :], np.r_[t.token, 0][np.minimum(at, len(t.token))], 0)


@dataclass
class Model:
    tables: list[np.ndarray]
    weights: dict[str, np.ndarray] | None
    prior: float

    def score(self, texts: pa.Array, block: int = 2048) -> np.ndarray:
        """The highest window's score of each text."""
        if self.weights is None:
            return np.full(len(texts), self.prior)
        t = tokens(texts)
        x = inputs(t, self.tables)
        return _sigmoid(top_windows(self.weights, t, x if len(x) else np.zeros((1, DIMS), np.float32), block)[0].astype(float))


def top_windows(p: dict, t: Tokens, x: np.ndarray, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The highest logit of each text, and which window has it."""
    text, start, length = windows(t.first)
    logit = np.empty(len(text), np.float32)
    order = np.argsort(length, kind="stable")  # blocks of like length take as few steps as they need
    for lo in range(0, len(text), block):
        w = order[lo : lo + block]
        logit[w] = forward(p, x, _spread(t, start[w], length[w]), length[w])
    best = np.lexsort((-logit, text))
    best = best[np.r_[True, np.diff(text[best]) > 0]] if len(best) else best
    return logit[best], best


def train(texts: list[str | None], labels: np.ndarray, fit: Fit = Fit()) -> Model:
    """Fit the network to labelled texts. With one class only, the score is that class's share."""
    label = np.asarray(labels, float)
    prior = float(label.mean()) if len(label) else 0.0
    if len(np.unique(label)) < 2:
        return Model([], None, prior)
    rng = np.random.default_rng(fit.seed)
    half = rng.permutation(len(label)) % 2
    t = tokens(pa.array(texts, pa.string()))
    tables = odds(t, label)
    # Each half reads the log odds of the other, so that the network learns what they are worth.
    parts = []
    for k in (0, 1):
        other = tokens(pa.array([x for x, h in zip(texts, half) if h != k], pa.string()))
        own = tokens(pa.array([x for x, h in zip(texts, half) if h == k], pa.string()))
        parts.append((own, inputs(own, odds(other, label[half != k])), label[half == k]))
    p = init(fit.seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    n = 0
    for round_ in range(fit.rounds):
        chosen = []
        for own, x, y in parts:
            text, start, length = windows(own.first)
            if round_ == 0:  # no network yet: the window with the highest sum of log odds
                total = np.r_[0, np.cumsum(x[own.token, :3].sum(1))]
                value = total[np.minimum(start + length, len(own.token))] - total[np.minimum(start, len(own.token))]
                best = np.lexsort((-value, text))
                best = best[np.r_[True, np.diff(text[best]) > 0]]
            else:
                best = top_windows(p, own, x)[1]
            chosen.append((own, x, y, start[best], length[best]))
        passes = -(-fit.updates // sum(-(-len(c[2]) // 128) for c in chosen))
        for _ in range(passes):
            for own, x, y, start, length in chosen:
                order = rng.permutation(len(y))
                for lo in range(0, len(y), 128):
                    w = order[lo : lo + 128]
                    g = gradient(p, x, _spread(own, start[w], length[w]), length[w], y[w])
                    n += 1
                    for k in p:
                        m[k] = 0.9 * m[k] + 0.1 * g[k]
                        s[k] = 0.999 * s[k] + 0.001 * g[k] * g[k]
                        p[k] = (p[k] - 0.01 * (m[k] / (1 - 0.9**n)) / (np.sqrt(s[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)
    return Model(tables, p, prior)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit: Fit) -> tuple[list, np.ndarray]:
    """A bounded sample of labelled texts: at most ``max_per_class`` ids of each label by hash
    order, out of those that ``docs`` holds. Texts of any length teach: a long one is cut into
    spans, and ``spans`` of them by hash order stand for it. Null labels and null ids teach
    nothing; of rows with one id the smallest text counts."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label")).distinct()
    known = known.join(docs.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    ids = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(fit.max_per_class)
        ids = part if ids is None else ids.union(part)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = texts.join(F.broadcast(ids), "id")  # 2 * max_per_class ids at most
    size = F.length("text")
    last = F.greatest(F.ceil(size / fit.span_chars) - 1, F.lit(0))
    numbers = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.struct(F.xxhash64("id", i).alias("h"), i.alias("i")))
    some = F.array_sort(F.transform(F.slice(F.array_sort(numbers), 1, fit.spans), lambda x: x["i"]))
    spans = F.transform(some, lambda i: F.substr("text", (i * fit.span_chars + 1).cast("int"), F.lit(fit.span_chars)))
    whole = F.when(last < fit.spans, F.col("text")).otherwise(F.array_join(spans, "\n"))
    rows = chosen.select("id", "label", whole.alias("text")).groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["id"], r["label"]))
    return [r["text"] for r in rows], np.array([r["label"] for r in rows], float)


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit: Fit = Fit()) -> Model:
    """:func:`train` on a :func:`sample`. The driver gives the memory of both back: it goes on
    with the stages that follow."""
    try:
        return train(*sample(docs, labels, id_col, text_col, label_col, fit), fit)
    finally:
        give_back()


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", row: bool = False) -> DataFrame:
    """Score every whole text: ``id, score`` (0 to 1), and with ``row`` also ``row``, a struct
    of all input columns.

    Null and empty texts, and texts without letters or digits, have one empty window and get
    the network's score for it. Equal texts get equal scores. Ids may be null or repeat; they
    are only passed on. Empty table: no rows. Other input columns are never read by name.
    """
    prepare(docs.sparkSession)
    rows = source(docs, id_col, text_col, row)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col, 1 << 20):
                out = {"id": part["id"], "score": pa.array(model.score(texts), pa.float64())}
                yield pa.RecordBatch.from_pydict(out | ({"row": part["row"]} if row else {}))

    return rows.mapInArrow(returning(run), f"id {rows.schema['id'].dataType.simpleString()}, score double" + row_field(rows))
