"""Chat formatting, quality rules, BPE, license scan, URL filter and toxicity."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from subword_spark.llm import chat_format as C
from subword_spark.llm import license_scan as L
from subword_spark.llm import suffix_repetition as Q
from subword_spark.llm import toxicity as X
from subword_spark.llm import url_filter as U
from subword_spark.llm import queries

SF = "/root/testdata/sf0.01"


# Chat formatting


def test_escapes_are_reversible():
    rng = random.Random(0)
    parts = ["<", "s", ">", "/", "\\", "[", "INST", "]", "</s>", "<s>", "[/INST]", "\n", "x", "<|im_end|>", "<<SYS>>"]
    for _ in range(5000):
        turns = [
            ("assistant" if rng.random() < 0.5 else "".join(rng.choices(parts, k=rng.randint(0, 3))), "".join(rng.choices(parts, k=rng.randint(0, 12))))
            for _ in range(rng.randint(0, 3))
        ]
        formatted, spans = C.format_turns(turns)
        assert C.read_turns(formatted) == turns
        assert [C.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        assert formatted.count("</s>") == len(turns) and "[INST]" not in formatted


def test_conversations_are_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv, turns in itertools.groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[0]):
        turns = list(turns)
        learnt = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3] or ''}\n" for t in turns)
        want[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert {r.conv_id: tuple(r)[1:5] for r in queries.op4_chat_format(spark, SF).collect()} == want


def test_trees(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(20):
        for i in range(rng.randint(1, 40)):
            parent = None if i == 0 or rng.random() < 0.05 else rng.randint(max(0, i - 3), i - 1)
            rows.append((conv, i, parent, "user" if i % 2 else "assistant", f"t{conv}.{i}", rng.choice([0.0, 1.0, None])))
    rows += [(99, 1, 2, "u", "circle", 1.0), (99, 2, 1, "u", "circle", 1.0), (99, 3, 1, "u", "below", 1.0), (98, 5, 77, "u", "orphan", None)] * 2
    rows += [(None, 1, None, None, None, None), (None, None, None, "u", "no id", None)]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    trees = collections.defaultdict(dict)
    for r in rows:
        if r[1] is not None:
            trees[r[0]][r[1]] = r
    want = {}
    for conv, nodes in trees.items():
        parents = {r[2] for r in nodes.values()}
        found = []
        for leaf in nodes.keys() - parents:
            path, x = [], leaf
            while x in nodes and x not in path:
                path.append(x)
                x = nodes[x][2]
            if x not in path:
                path.reverse()
                found.append((-sum(nodes[k][5] or 0 for k in path) / len(path), leaf, path))
        for n, (_, leaf, path) in enumerate(sorted(found), 1):
            want[conv, leaf] = (n, C.format_turns([(nodes[k][3] or "", nodes[k][4] or "") for k in path])[0])
    out = C.format_trees(df, score_col="score", branches=None)
    assert {(r.conv_id, r.leaf): (r.branch, r.formatted) for r in out.collect()} == want
    assert C.format_trees(df, score_col="score").count() == len({c for c, _ in want})
    assert C.format_trees(df.limit(0)).count() == 0


# Quality rules


def test_longest_repeats_are_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        texts = [[rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.choice([0, 1, 2, 3, 10, 40]))] for _ in range(rng.randint(1, 5))]
        want = []
        for t in texts:
            for p in range(len(t)):
                best = 0
                for q in range(len(t)):
                    n = 0
                    while p != q and p + n < len(t) and q + n < len(t) and t[p + n] == t[q + n]:
                        n += 1
                    best = max(best, n)
                want.append(best if best >= 2 else 0)
        word = np.array([x for t in texts for x in t], np.int64)
        assert Q.longest_repeats(word, np.r_[0, np.cumsum([len(t) for t in texts])]).tolist() == want


def test_quality_counts(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op5_quality_rules(spark, SF).collect():
        text = docs[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeated = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(lines) - len(set(lines)), len(repeated), failed)
        assert not (failed and r.kept)


def test_long_repeats_are_rejected():
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    clean, block = fresh(400), fresh(120)
    texts = [" ".join(clean), " ".join(fresh(300) + block + fresh(300) + block)]
    f = Q.features(pa.array(texts), Q.Limits())
    assert f["longest_repeat"].tolist() == [0, 120] and f["n_covered_words"].tolist() == [0, 240]


# BPE


def test_bpe_is_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from subword_spark.llm.bpe_codec import bpe_decode, bpe_encode, codec

    path = P.path("word_bpe_49k.json")
    spec = open(path, encoding="utf-8").read()
    mine, theirs = codec(spec), Tokenizer.from_str(spec)

    def same(text):
        want = theirs.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(mine.encode(text), "<u4")
        return got.tolist() == want and mine.decode(got.astype(np.int64)).decode() == theirs.decode(want, skip_special_tokens=False)

    rng = random.Random(1)
    parts = ["a", "the", "ing", "in", "th", "'s", "'ll", "É", "ß", "İ", "ǅ", "1", "２", "½", " ", "\n", "\x85", "\xa0", "\x1c", "é", "ΑΣ", "中", "!", "</w>"]
    parts += ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "😀", "́", "한", "\u200b", "\x00", "_", "er", "on"]
    for _ in range(4000):
        assert same("".join(rng.choices(parts, k=rng.randint(0, 14))))
        assert same("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 30))))
    assert same("a" * 3000) and same("th" * 3000 + "!" * 2000)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(200)
    out = bpe_decode(bpe_encode(rows, path), path)
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in out.collect():
        want = theirs.encode(texts[r.id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.decoded == theirs.decode(want, skip_special_tokens=False)


# License scan


def test_licenses_are_brute_force():
    rng = random.Random(0)
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 3)):
            words += rng.choices("abcdefg", k=rng.randint(0, 60))
            notice = rng.choice(list(L.TEMPLATES.values())).split()
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(notice))
                notice[i] = rng.choice(["x", notice[i].upper(), notice[i] + "!"])
            words += notice
        texts.append(" ".join(words))
    tokens = lambda s: [x.lower() for x in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", s)]
    want = set()
    for d, s in enumerate(texts):
        for name, t in L.TEMPLATES.items():
            t = tokens(t)
            size = min(5, len(t))
            cut = lambda x: [tuple(x[i : i + size]) for i in range(len(x) - size + 1)]
            template, mine = cut(t), cut(tokens(s))
            block = -(-len(template) // 2)
            width = block * -(-(len(template) + block - 1) // block)
            if any(len(set(mine[i : i + width]) & set(template)) >= 0.8 * len(set(template)) for i in range(0, max(1, len(mine)), block)):
                want.add((d, name))
    known = [L.Template(k, v) for k, v in L.TEMPLATES.items()]
    assert {(d, name) for d, name, *_ in L.scan(pa.array(texts + [None, ""]), known)} == want and want
    for t in known:
        need = math.ceil(L.LEAST * len(t.set))
        j = need / (t.block * t.blocks + len(t.set) - need)
        assert (1 - j * j) ** L.BANDS < 3e-5


def test_license_query(spark):
    rows = queries.op7_license_scan(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    marks = {"MIT-notice": "Released under the MIT License", "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0"}
    for name, mark in marks.items():
        assert {r.doc_id for r in rows if r.license == name} == {i for i, t in docs.items() if mark in (t or "")}


@pytest.mark.parametrize("numbered", [False, True])
def test_licenses_are_told_from_their_siblings(spark, numbered):
    """Each text or notice is reported under its own name and under no sibling's."""
    known = [L.Template(k, v) for k, v in L.TEMPLATES.items()]
    near = L.siblings(known)
    assert {"GPL-2.0-or-later", "LGPL-2.1-or-later", "AGPL-3.0-or-later"} <= near["GPL-3.0-or-later"] and "BSD-2-Clause" in near["BSD-3-Clause"]
    names = list(L.TEMPLATES)
    texts = [f"Some words before. {t} And some more words after it, as files have them." for t in L.TEMPLATES.values()]
    if numbered:  # as people write them: numbers, another holder
        texts = [t.replace("Redistributions of", "1. Redistributions of").replace("Redistributions in", "2. Redistributions in").replace("Neither", "3. Neither").replace("copyright holder nor", "Foo Project nor") for t in texts]
    rows = L.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = collections.defaultdict(set)
    for r in rows:
        found[r.id].add(r.license)
    for i, name in enumerate(names):
        own = name.partition("#")[0]
        assert own in found[i] and not found[i] & ({x.partition("#")[0] for x in near[name]} - {own}), (name, found[i])


def test_siblings_side_by_side():
    """Two notices in one text are both reported, at their places."""
    known = [L.Template(k, v) for k, v in L.TEMPLATES.items()]
    for a, b in [("GPL-2.0-or-later", "GPL-3.0-or-later"), ("BSD-3-Clause", "BSD-2-Clause"), ("LGPL-2.1-or-later", "GPL-2.0-or-later")]:
        for x, y in ((a, b), (b, a)):
            hits = L.scan(pa.array([f"{L.TEMPLATES[x]} {L.TEMPLATES[y]}"]), known)
            assert {name for _, name, *_ in L.settle(hits, known, L.siblings(known)) if not name.endswith("notice")} == {a, b}


# URL filter


def _parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def _rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_url_rules(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op8_url_filter(spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = _parse(urls[r.page_id])
        rule, verdict = _rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or (r.verdict == verdict and r.score is None)


def test_language_models_are_brute_force(spark):
    known, order = [("abc/1", True), ("abd/2", True), ("xx/😀", False), ("abx", False), ("", False)], 3
    counts, alphabet = [collections.defaultdict(collections.Counter) for _ in "ab"], set()
    for text, accepted in known:
        s = "\x02" * order + text + "\x03"
        for i in range(order, len(s)):
            alphabet.add(s[i])
            for k in range(order + 1):
                counts[accepted][s[i - k : i]][s[i]] += 1

    def score(text):
        s = "\x02" * order + text + "\x03"
        total = 0
        for i in range(order, len(s)):
            p = [1 / (len(alphabet) + 1)] * 2
            for c in (0, 1):
                for k in range(order + 1):
                    seen = counts[c].get(s[i - k : i])
                    if seen:
                        p[c] = (seen[s[i]] + len(seen) * p[c]) / (sum(seen.values()) + len(seen))
            total += math.log(p[1]) - math.log(p[0])
        return total / (len(s) - order)

    model = U.train(spark.createDataFrame(known, "text string, accepted boolean"), order)
    texts = ["abc", "", "zz😀", "xx/1", "abx/2"]
    got = {r.text: r.score for r in U.text_scores(spark.createDataFrame([(t,) for t in texts], "text string"), model, order).collect()}
    assert all(math.isclose(got[t], score(t), abs_tol=1e-6) for t in texts)


def test_url_edge_cases(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    rows = [(1, None), (None, ""), (2, "none"), (2, "http://A.org"), (3, "http://x.net/" + "a" * 20_000), (4, "x://b.org/"), (5, "x://b.org.net/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS text", "'z' AS rule")
    out = U.filter_urls(df, rules).collect()
    assert len(out) == len(rows) and {r.id: r.rule for r in out}[4] == "org/" and {r.id: r.rule for r in out}[5] is None
    assert {(r.host, r.path) for r in out if r.id in (1, None)} == {("", "")}
    assert U.filter_urls(df.limit(0), rules).count() == 0


# Toxicity


def test_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in X.init(1).items()}
    x, token, length, label = rng.standard_normal((20, X.DIMS)), rng.integers(0, 20, (7, 5)), np.array([7, 3, 0, 5, 1]), np.array([1, 0, 1, 0, 1.0])
    loss = lambda p: np.mean(np.logaddexp(0, np.where(label, -1, 1) * X.forward(p, x, token, length)))
    g = X.gradient(p, x, token, length, label)
    for k in p:
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        up, down = {a: b.copy() for a, b in p.items()}, {a: b.copy() for a, b in p.items()}
        up[k][at] += 1e-3
        down[k][at] -= 1e-3
        assert math.isclose((loss(up) - loss(down)) / 2e-3, g[k][at], rel_tol=1e-2, abs_tol=1e-5)


def test_windows_cover_every_token():
    first = np.r_[0, np.cumsum([0, 1, 63, 64, 65, 96, 97, 1000])]
    text, start, length = X.windows(first)
    for i in range(len(first) - 1):
        own = [range(a, a + n) for t, a, n in zip(text, start, length) if t == i]
        assert sorted({x for r in own for x in r}) == list(range(first[i], first[i + 1])) and own
    assert (length <= X.WINDOW).all()


def test_held_out_accuracy(spark):
    rows = queries.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    hit = [p == y for p, y in held]
    assert sum(hit) / len(hit) > 0.96
    assert np.mean([p for p, y in held if y]) > 0.85 and np.mean([p for p, y in held if not y]) < 0.03
