"""Operators' kernels against brute force, without Spark."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from provendar.llm import common as C
from provendar.llm import decontaminate as D
from provendar.llm import jaccard_join as J
from provendar.llm import language as G
from provendar.llm import neighbours as N
from provendar.llm import quality as Q
from provendar.llm import sentencepiece_codec as SP
from provendar.llm import suffix_sort as X
from provendar.llm import toxicity as T
from provendar.llm import url_filters as U


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB \n\té\x0b", max_size=12), max_size=6))
def test_words(texts):
    data, off = block(texts)
    s, e, first = C.words(data, off)
    for i, t in enumerate(texts):
        own = [data[a:b].tobytes() for a, b in zip(s[first[i] : first[i + 1]], e[first[i] : first[i + 1]], strict=True)]
        assert own == re.findall(rb"[^\x20\x09-\x0D]+", t.encode())
    h = C.span_hash(C.prefix_hash(data), s, e)
    words = [data[a:b].tobytes() for a, b in zip(s, e, strict=True)]
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(i))


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(97 + x % 3 for x in b)), st.sampled_from([5, 100]), st.sampled_from([64, 1 << 20]))
def test_suffix_sort(b, cap, limit):
    sorts(b, cap, limit)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.lists(st.binary(min_size=1, max_size=9).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=5, max_size=5))
def test_suffix_sort_in_small_ranges_and_steps(words, vocabulary):
    old = X.RANGE_TUPLES, X.FIRST_STEP, X.LAST_STEP, X.BLOCK, X.WAITING
    try:
        X.RANGE_TUPLES, X.FIRST_STEP, X.LAST_STEP, X.BLOCK, X.WAITING = 8, 4, 16, 32, 3
        sorts(b"".join(vocabulary[k] for k in words), 100, 64)
    finally:
        X.RANGE_TUPLES, X.FIRST_STEP, X.LAST_STEP, X.BLOCK, X.WAITING = old


def test_suffix_sort_beyond_memory_on_every_level():
    """A lot far over the limit: queues and arrays go to files on each level of the recursion, and the result is the same."""
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 123, int(n)).astype(np.uint8)) for n in rng.integers(2, 9, 2000)]
    data = np.frombuffer(b" ".join(words[int(k)] for k in rng.zipf(1.3, 40_000) % 2000), np.uint8)
    trace = []
    got = list(X.sort_suffixes(data, 100, 1 << 15, trace))
    whole = list(X.sort_suffixes(data, 100))
    for k in (0, 1):
        assert np.array_equal(np.concatenate([g[k] for g in got]), np.concatenate([g[k] for g in whole]))
    assert len(data) > 6 * (1 << 15) and len(trace) >= 3
    queued = [0] + [q for _, _, q, _ in trace]  # levels report from the deepest to the first
    filed = [0] + [f for _, _, _, f in trace]
    assert all(b > a for a, b in zip(queued, queued[1:], strict=False)) and filed[1] > 0
    pos, lcp = (np.concatenate([g[k] for g in got]) for k in (0, 1))
    raw = data.tobytes()
    for i in rng.integers(1, len(pos), 500):
        a, b = raw[pos[i - 1] : pos[i - 1] + 101], raw[pos[i] : pos[i] + 101]
        n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b), 100))
        assert raw[pos[i - 1] :] < raw[pos[i] :] and lcp[i] == min(n, 100)


def sorts(b, cap, limit):
    got = list(X.sort_suffixes(np.frombuffer(b, np.uint8), cap, limit))
    pos, lcp = (np.concatenate([g[k] for g in got]).tolist() for k in (0, 1))
    want = sorted(range(len(b)), key=lambda i: b[i:])
    assert pos == want

    def common(x, y):
        n = 0
        while n < min(len(x), len(y), cap) and x[n] == y[n]:
            n += 1
        return n

    assert lcp == [0] + [common(b[i:], b[j:]) for i, j in zip(want, want[1:], strict=False)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.data())
def test_similar_sets_share_a_signature(base, data):
    """Completeness: no pair at the threshold is lost, under every scheme."""
    x = np.sort(np.array(sorted(base), np.uint64))
    k = data.draw(st.integers(0, len(x)))
    extra = data.draw(st.integers(0, len(x) // 4 + 1))
    y = np.unique(np.concatenate([np.delete(x, np.arange(min(k, len(x) - 1)) % len(x)) if data.draw(st.booleans()) else x, C.mix(np.arange(1, extra + 1, dtype=np.uint64))]))
    both, at = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
    want = 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
    assert J.similar(x, y) == want
    if want:
        assert J.may_be_similar(len(x), len(y), *J.sketches(both, at))
        for scheme in J.SCHEMES:
            sig = {0: set(), 1: set()}
            for s, row in J.signatures(both, at, *scheme):
                for v, r in zip(s.tolist(), row.tolist(), strict=True):
                    sig[r].add(v)
            assert sig[0] & sig[1]


def test_shingles():
    data, off = block(["A b c d e f", "a B c d e F", "x y", "", " \n", "q q q q q q q"])
    x, at = J.shingle_sets(data, off)
    assert np.diff(at).tolist() == [2, 2, 1, 0, 0, 1]
    c = J.class_hash(x, at)
    assert c[0] == c[1] != c[2]


def slow_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH), h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return h.max()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=15), st.lists(st.integers(0, 4), min_size=1, max_size=25))
def test_alignment(a, b):
    assert D.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == slow_align(a, b)


def test_leaks_are_found_edited_and_clean_text_is_left():
    rng = np.random.default_rng(0)
    vocab = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(3000)]
    text = lambda n: [vocab[i] for i in rng.integers(0, 3000, n)]
    items = [text(int(rng.integers(15, 60))) for _ in range(30)]
    docs, want = [], set()
    for k in range(60):
        d = text(300)
        if k % 2 == 0:
            own = list(items[k // 2])
            for p in range(4, len(own), 7):  # an edit in every seventh word
                own[p] = "edited"
            d[100:100] = own
            want.add((k, k // 2))
        docs.append(" ".join(d).upper() if k % 4 == 0 else " ".join(d))
    got = found_by(items, docs)
    assert got == want


def found_by(items, docs):
    """{(row, item)} found with the seeds chosen from the documents' own counts."""
    it = D.Items(list(range(len(items))), [" ".join(x) for x in items])
    w, first = D.word_hashes(*block(docs))
    counts = [np.zeros(len(k), np.int64) for k in it.keys]
    for n in (1, 2):
        for k, _ in it.hits(w, first, n):
            np.add.at(counts[n - 1], k, 1)
    it.choose(counts)
    got = it.matches(w, first)
    assert all(0.5 <= s <= 1 for _, _, s, _ in got)
    return {(r, i) for r, i, *_ in got}


@pytest.mark.parametrize("seed", range(8))
def test_seeds_lose_no_alignment(seed, monkeypatch):
    """Edited, cut and stretched copies at all rates: the pairs found are those that Smith-Waterman on all pairs finds."""
    rng = np.random.default_rng(seed)
    v = [6, 30, 300, 3000][seed % 4]
    text = lambda n: [f"w{i}" for i in rng.integers(0, v, n)]
    items = [text(int(rng.integers(1, 45))) for _ in range(12)]
    docs = []
    for k in range(30):
        d = text(int(rng.integers(0, 120)))
        if k % 2 == 0:
            rate, own = rng.random() * 0.6, []
            for x in items[int(rng.integers(0, 12))]:
                u = rng.random() / max(rate, 1e-9)
                own += ["other"] if u < 0.33 else [] if u < 0.66 else [x, "more"] if u < 1 else [x]
            d[len(d) // 2 : len(d) // 2] = own
        docs.append(" ".join(d))
    docs += [" ".join("other" if p % 3 == 2 else x for p, x in enumerate(items[0])), " ".join(y for x in items[1] for y in (x, "more"))]
    it = D.Items(list(range(12)), [" ".join(x) for x in items])
    w, first = D.word_hashes(*block(docs))
    want = set()
    for r in range(len(docs)):
        for i in range(12):
            own, there = it.words[it.first[i] : it.first[i + 1]], w[first[r] : first[r + 1]]
            if len(there) and D.align(own, there)[0] >= it.score[i]:
                want.add((r, i))
    assert found_by(items, docs) == want
    monkeypatch.setattr(D, "LOOKED_UP", 17)
    assert found_by(items, docs) == want


@pytest.mark.parametrize("dim", [16, 2100])
def test_tiles_bound_and_keep_the_nearest(dim):
    rng = np.random.default_rng(3)
    c = rng.normal(size=(500, dim))
    c[50:90] = c[50]  # many ties
    ids = rng.permutation(500)
    true = c[:60] @ c.T
    low, high = N.bounds(tuple(x[:60] for x in N.quantise(c)), N.quantise(c))
    assert (low <= true + 1e-9).all() and (true <= high + 1e-9).all()
    got = {}
    strip = N.Strip(ids[:60], *(x[:60] for x in N.quantise(c)), 20)
    for block in np.array_split(np.arange(500), 4):
        for a, b, *_ in strip.meet(ids[block], N.quantise(c[block])):
            for x, y in zip(a.tolist(), block[b].tolist(), strict=True):
                got.setdefault(x, set()).add(y)
    for k in range(60):
        want = sorted((-true[k, j], int(ids[j]), j) for j in range(500) if j != k)[:20]
        assert {j for _, _, j in want} <= got[k] and k not in got[k]


def test_url_rules():
    rules = U.default_rules()
    index, rest = U.build_index(rules, {"net": 900, "en": 500, "example": 1000, "com": 10, "de": 5, "org": 7, "fr": 9})
    assert not rest and index["de"] == [2] and index["en"] == [1]
    m = U.Matcher(rules, index, rest)
    cases = {
        "http://a.Example.NET/en/1?x": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/1": ("example.net", "/de/1", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://x.example.com/de/1#f": ("x.example.com", "/de/1", "example.com/de/", "block"),
        "ftp://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://a.org/FR/": ("a.org", "/FR/", None, "allow"),
        "http://x.net?a": ("x.net", "", None, "allow"),
        "http://x.com/ads/1": ("x.com", "/ads/1", None, "block"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    for url, want in cases.items():
        assert m.judge(url)[:4] == want, url


def test_classifiers_learn_and_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 8, 5))
    good = [" ".join(word() for _ in range(40)) for _ in range(60)]
    bad = [" ".join(word() if rng.random() < 0.9 else "idiot" for _ in range(40)) for _ in range(60)]
    y = np.array([0] * 60 + [1] * 60)
    m = T.fit(good + bad, y, 0.5)
    s = m.scores(*block(good + bad))
    assert ((s >= 0.5) == y).mean() > 0.95
    one = np.array([m.scores(*block([t]))[0] for t in (good + bad)[::9]])
    assert np.array_equal(one, s[::9])
    assert m.scores(*block(["", "a", "ab"])).shape == (3,)
    junk = [" ".join(word() + "%%%" for _ in range(40)) for _ in range(60)]
    q = Q.fit(good + junk, 1 - y, 0.5)
    s = q.scores(*block([*good, *junk, ""]))
    assert ((s[:-1] >= 0.5) == 1 - y).mean() > 0.95
    assert [q.scores(*block([t]))[0] for t in good[:5]] == s[:5].tolist()
    assert T.fit(good, np.zeros(60, int), 0.0).scores(*block(["x"]))[0] < 0.01


def test_quality_gradient():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 110, int(n)).astype(np.uint8)).decode() for n in (10, 300, 700, 130)]
    net = Q.Net(rng.normal(0, 0.5, (256, Q.EMBED)), rng.normal(0, 0.2, (Q.TAPS, Q.STRIDE * Q.EMBED, Q.FILTERS)), rng.normal(0, 0.1, Q.FILTERS), rng.normal(0, 0.3, 2 * Q.FILTERS))
    data, off = block(texts)
    y = np.array([0.0, 1, 1, 0])

    def loss():
        z = net.forward(data, off)[0]
        return np.mean(np.logaddexp(0, z) - y * z)

    g = Q._gradient(net, data, off, y)
    for p, gp in zip((net.emb, net.conv, net.bias, net.out), g, strict=False):
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in p.shape) if p is not net.emb else (int(rng.integers(97, 110)), int(rng.integers(0, Q.EMBED)))
            old = p[at]
            p[at] = old + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - gp[at]) < 1e-4


def test_quality_of_a_text_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, int(n)).astype(np.uint8)).decode() for n in (0, 1, 3, 90, 0, 127, 128, 129, 2, 256, 257, 385, 0, 5, 640, 641)]
    net = Q.Net(rng.normal(0, 0.5, (256, Q.EMBED)), rng.normal(0, 0.2, (Q.TAPS, Q.STRIDE * Q.EMBED, Q.FILTERS)), rng.normal(0, 0.1, Q.FILTERS), rng.normal(0, 0.3, 2 * Q.FILTERS))
    alone = np.array([net.forward(*block([t]))[0][0] for t in texts])
    for _ in range(5):
        order = rng.permutation(len(texts))
        assert np.allclose(net.forward(*block([texts[k] for k in order]))[0], alone[order], rtol=0, atol=1e-9)
    # gradients meet the same padding
    y = rng.integers(0, 2, len(texts)).astype(float)
    whole = Q._gradient(net, *block(texts), y)
    parts = [Q._gradient(net, *block([t]), y[k : k + 1]) for k, t in enumerate(texts)]
    for k, g in enumerate(whole):
        assert np.allclose(g, sum(p[k] for p in parts) / len(texts), rtol=0, atol=1e-5)


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    m = G.Crf(["a", "b", "c"], np.zeros((2, 3)), np.zeros(3), rng.normal(size=(3, 3)))
    em = rng.normal(size=(9, 3))
    chains = np.array([0, 4, 5, 9])
    got, expected = m.marginals(em, chains, True)
    total = np.zeros((3, 3))
    for a, b in zip(chains[:-1], chains[1:], strict=True):
        p, z, pair = np.zeros((b - a, 3)), 0.0, np.zeros((3, 3))
        for path in product(range(3), repeat=int(b - a)):
            w = np.exp(sum(em[a + i, k] for i, k in enumerate(path)) + sum(m.trans[x, y] for x, y in zip(path, path[1:], strict=False)))
            z += w
            for i, k in enumerate(path):
                p[i, k] += w
            for x, y in zip(path, path[1:], strict=False):
                pair[x, y] += w
        assert np.allclose(got[a:b], p / z)
        total += pair / z
    assert np.allclose(expected, total)


def test_language_of_mixed_and_empty_text():
    en = ["the house and the dog were there with them"] * 30
    fr = ["la maison et le chien étaient là avec eux"] * 30
    m = G.fit(en + fr, ["en"] * 30 + ["fr"] * 30)
    best, score = m.label(*block(["the dog and the house", "le chien et la maison", "123 !!", ""]))
    assert [m.langs[k] if k >= 0 else "und" for k in best] == ["en", "fr", "und", "und"] and score[2] == score[3] == 0
    w = G.analyse(*block(["the dog et la maison"]))
    marg, _ = m.marginals(m.emissions(w), G.chain_starts(w.first))
    assert np.allclose(marg, m.smooth(m._weights(m.emissions(w)), w.first))
    assert [m.langs[k] for k in marg.argmax(1)] == ["en", "en", "fr", "fr", "fr"]
    assert G.fit([], []) is None


def _vocab(kind, pieces):
    scores = [-float(i) for i in range(len(pieces))] if kind == SP.BPE else [s for _, s in pieces]
    names = pieces if kind == SP.BPE else [p for p, _ in pieces]
    return SP.Codec(SP.Vocabulary(["<unk>", *names], [0.0, *scores], [SP.UNKNOWN] + [SP.NORMAL] * len(names), kind, True, False))


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", max_size=25))
def test_bpe_pass_equals_merging(text):
    c = _vocab(SP.BPE, ["ab", "bc", "abc", "ca", "▁a", "aa", "▁ab", "▁▁", "bcab", "a", "b", "c", "▁"])
    s = ("▁" + text.replace(" ", "▁")) if text else ""
    assert c.encode(text) == c.merge(s) if s else c.encode(text) == []
    assert c.decode(c.encode(text)) == text


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=9))
def test_unigram_pass_is_the_best_path(text):
    pieces = [("a", -2.0), ("b", -2.5), ("c", -3.0), ("ab", -3.1), ("bc", -4.0), ("abc", -5.5), ("▁", -1.0), ("▁a", -2.2)]
    c, score = _vocab(SP.UNIGRAM, pieces), dict(pieces)

    def best(s):
        return 0.0 if not s else max((score[s[:k]] + best(s[k:]) for k in range(1, 5) if s[:k] in score), default=-1e9)

    ids = c.encode(text)
    assert "".join(c.vocab.pieces[i] for i in ids) == "▁" + text
    assert abs(sum(c.vocab.scores[i] for i in ids) - best("▁" + text)) < 1e-9


def test_public_model_equals_its_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    c, lib = SP.Codec(SP.Vocabulary.load(SP.MODEL)), sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    for t in ["", " ", "  a  b ", "a\n\nb\tc", "日本語 텍스트 ñandú 🙂🙂", "\n", "Hello, World! isn't it?", "aaaaaaaaaaaaaaaa", "x" * 3000]:
        assert c.encode(t) == lib.encode(t)
        assert c.decode(c.encode(t)) == t


def test_scores_depend_on_the_text_alone(monkeypatch):
    """Random weights, exact equality: alone, first, last and amid others, and in windows."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, int(n)).astype(np.uint8)).decode() for n in (0, 1, 3, 90, 0, 127, 128, 129, 2, 256, 257, 385, 0, 5, 640, 641)]
    texts += ["".join(chr(c) for c in rng.choice([97, 98, 233, 0x4E2D, 0x1F600, 32], n)) for n in (1024, 1500, 5000)]
    net = Q.Net(rng.normal(0, 0.5, (256, Q.EMBED)), rng.normal(0, 0.2, (Q.TAPS, Q.STRIDE * Q.EMBED, Q.FILTERS)), rng.normal(0, 0.1, Q.FILTERS), rng.normal(0, 0.3, 2 * Q.FILTERS))
    tox = T.Model(rng.normal(size=1 << T.BITS).astype(np.float32), 0.1)
    for m in (net, tox):
        alone = np.array([m.scores(*block([t]))[0] for t in texts])
        for _ in range(10):
            order = rng.permutation(len(texts))
            assert np.array_equal(m.scores(*block([texts[k] for k in order])), alone[order])
        with monkeypatch.context() as p:
            p.setattr(C, "BLOCK_BYTES", 256)
            assert [m.scores(*block([t]))[0] for t in texts] == alone.tolist()
    whole = 1 / (1 + np.exp(-net.forward(*block(texts))[0]))
    assert np.abs(whole - [net.scores(*block([t]))[0] for t in texts]).max() < 0.02  # 8 bits


def test_quality_equals_a_plain_loop():
    rng = np.random.default_rng(4)
    net = Q.Net(rng.normal(0, 0.5, (256, Q.EMBED)), rng.normal(0, 0.2, (Q.TAPS, Q.STRIDE * Q.EMBED, Q.FILTERS)), rng.normal(0, 0.1, Q.FILTERS), rng.normal(0, 0.3, 2 * Q.FILTERS))
    r = net.rounded
    for n in (0, 5, 128, 129, 700):
        raw = bytes(rng.integers(0, 256, n).astype(np.uint8))
        halves = max(1, -(-n // 128))
        padded = raw + bytes(halves * 128 + 8 - n)
        h = []
        for k in range(halves):
            most = np.full(Q.FILTERS, -np.inf)
            for p in range(Q.HALF):
                at = (k * Q.HALF + p) * Q.STRIDE
                a = np.zeros(Q.FILTERS)
                for t in range(Q.TAPS):
                    for j in range(Q.STRIDE):
                        byte = padded[at + t * Q.STRIDE + j]
                        for e in range(Q.EMBED):
                            a += r.emb[byte, e] * r.conv[t, j * Q.EMBED + e]
                most = np.maximum(most, a)
            h.append(np.maximum(most + r.bias, 0))
        chunks = [np.maximum(x, y) for x, y in zip(h, h[1:], strict=False)] or h
        z = r.out_bias + sum((np.max(chunks, 0) * r.unit)[f] * r.out[f] + (np.mean(chunks, 0) * r.unit)[f] * r.out[Q.FILTERS + f] for f in range(Q.FILTERS))
        assert abs(net.scores(np.frombuffer(raw, np.uint8), np.array([0, n]))[0] - 1 / (1 + np.exp(-z))) < 1e-12


def test_toxicity_equals_a_plain_loop():
    rng = np.random.default_rng(5)
    m = T.Model(rng.normal(size=1 << T.BITS).astype(np.float32), -0.3)

    def slow(t):
        chars = [ord(c) + 32 if "A" <= c <= "Z" else ord(c) for c in t]
        total = 0.0
        for s in range(len(chars)):
            for n in T.ORDERS:
                if s + n <= len(chars):
                    h = 0
                    for c in chars[s : s + n]:
                        h = (h * 0x100000001B3 + c + 1) % 2**64
                    total += float(m.weights[h * 0x9E3779B97F4A7C15 % 2**64 >> 64 - T.BITS])
        return 1 / (1 + np.exp(-(m.bias + T.SCALE * total / max(len(chars) - 2, 1))))

    for t in ("", "ab", "abc", "Some TEXT, été 日本 🙂!", "x" * 50):
        assert abs(m.scores(*block([t]))[0] - slow(t)) < 1e-6


@pytest.mark.parametrize("step", [7, 64, 300])
def test_words_of_long_texts_in_windows(step):
    rng = np.random.default_rng(step)
    texts = ["".join(rng.choice(list("ab É\n"), 700)), "x" * 3000 + " y z" + "w" * 999, "", "É" * 500, "end "]
    for fold, space in ((C.LOWER.__getitem__, C.SPACE), (D._fold, C.NOT_ALNUM)):
        w, first = C.hash_words(*block(texts), fold, space)
        v, at = C.hash_words(*block(texts), fold, space, step)
        assert np.array_equal(w, v) and np.array_equal(first, at)


def test_language_of_long_texts_in_windows(monkeypatch):
    en, fr = ["the house and the dog were there with them"] * 30, ["la maison et le chien étaient là avec eux"] * 30
    m = G.fit(en + fr, ["en"] * 30 + ["fr"] * 30)
    for t in (" ".join(en[:9] + fr[:12] + en[:3]), "aé" * 700, "12 " * 300 + "the house", "maison" * 200 + ". the dog", " " * 900, "日本語" * 200 + "。the dog " + "été " * 200):
        whole = m.label(*block([t]), True)
        with monkeypatch.context() as p:
            p.setattr(C, "BLOCK_BYTES", 100)
            cut = m.label(*block([t]), True)
        assert whole[0] == cut[0] and abs(whole[1] - cut[1]) < 1e-9
        assert all(np.array_equal(a, b) for a, b in zip(whole[2:], cut[2:], strict=True))
    # a chain is never cut: segments give what one pass over the whole chain gives
    rng = np.random.default_rng(0)
    em, first = rng.normal(size=(500, 2)) * 2, np.array([0, 3, 3, 100, 131, 132, 500])
    assert np.allclose(m.smooth(m._weights(em), first), m.marginals(em, G.chain_starts(first))[0], atol=1e-12)
    *_, s, e, lang = m.label(*block(["the house and the dog la maison et le chien"]), True)
    assert [(m.langs[k], a, b) for k, a, b in zip(lang, s, e, strict=True)] == [("en", 0, 21), ("fr", 22, 43)]
    # switches are learnt, staying is likelier
    assert (np.diag(m.trans) > m.trans[~np.eye(2, dtype=bool)]).all()


def test_islands_of_long_texts_in_windows(monkeypatch):
    import pyarrow as pa

    from provendar.llm import repeats as R

    rng = np.random.default_rng(1)
    t = "".join(rng.choice(list("abcd "), 3000))
    batch = pa.RecordBatch.from_arrays([pa.array(["x", t])], ["_t"])
    cover = lambda: sorted((i, int(s) + k) for i, (_, _, _, row, start, count, *_) in R.island_blocks(batch, np.zeros(0, np.uint64)) for s, n in zip(start, count, strict=True) for k in range(n))
    anchors = lambda: {int(a) for _, f in R.island_blocks(batch, np.zeros(0, np.uint64)) for a in f[0]}
    whole, names = cover(), anchors()
    assert [p for _, p in whole] == list(range(3000 - R.WINDOW + 1))
    monkeypatch.setattr(C, "BLOCK_BYTES", 512)
    assert [p for _, p in cover()] == [p for _, p in whole] and anchors() == names


def test_url_rules_stand_at_the_start():
    rules = U.default_rules()
    m = U.Matcher(rules, *U.build_index(rules, {}))
    for url in ("http://foo.com/a\nx.net/", "http://x\nnet/", "http://foo.com/?q=\norg/fr/", "http://foo.com/net/", "http://xnet/"):
        assert m.judge(url)[2] is None, url
    assert m.judge("http://a\nb.net/")[2] == "net/"
