"""Texts to ids, alignment of two tokenizers and token files, against the tokenizers' libraries and plain loops."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from provendar.llm import alignment, queries, range_coder, token_files, vocab
from provendar.llm import common as C

SF = "/root/testdata/sf0.001"
A, B = vocab.ByteLevel(vocab.read(vocab.BYTE_LEVEL), True), vocab.Pieces(vocab.read(vocab.PIECES))
SPECIAL = vocab.ByteLevel(vocab.read(vocab.BYTE_LEVEL), False)
ODD = [None, "", " ", "a ", "  b", "a▁b", "<|endoftext|> x <s> </s>", "日本語" * 50 + " é ñ\n\n  x", "a\t b\xa0 c　 d", "é f  g", "x" * 3000 + " y", "ab " * 4000, "don't  stop ,now", "\n\n a \n b"]


def block(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def ids_of(memory, data, off):
    out = [[] for _ in off[1:]]
    for i, j, ids, at, _, _ in memory.parts(data, off):
        for k in range(i, j):
            out[k] += ids[at[k - i] : at[k - i + 1]].tolist()
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB .,'\n\té\x0b\xa0▁日<|endoftext|>1", max_size=40), max_size=6))
def test_ids_equal_the_libraries(texts):
    data, off = block(texts)
    led = vocab.led_by_space(data, off)
    assert ids_of(vocab.Memory(A), *led) == [A.tok.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    assert ids_of(vocab.Memory(SPECIAL), data, off) == [SPECIAL.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(vocab.Memory(B), *led) == [B.sp.encode(t) if t else [] for t in texts]


def test_ids_in_parts_and_with_a_short_memory():
    texts = [t for t in ODD if t] * 3 + ["word%d next " % k * 9 for k in range(300)]
    data, off = block(texts)
    part, vocab.PART = vocab.PART, 512
    try:
        small = vocab.Memory(SPECIAL, limit=50)
        assert ids_of(small, data, off) == [SPECIAL.tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(small.n) < 400 and len(small.hash) <= len(small.n)
    finally:
        vocab.PART = part


def test_equal_hashes_do_not_mix_words_up(monkeypatch):
    monkeypatch.setattr(C, "span_hash", lambda p, s, e: np.zeros(len(s), np.uint64))
    texts = ["one two three", "two four one"]
    assert ids_of(vocab.Memory(SPECIAL), *block(texts)) == [SPECIAL.tok.encode(t, add_special_tokens=False).ids for t in texts]


# ---- range coder


def coded(ids):
    ids = np.array(ids, np.uint32)
    raw = range_coder.encode(ids)
    got = list(range_coder.decode(raw))
    assert np.array_equal(np.concatenate(got) if got else ids[:0], ids)
    return raw


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300), st.integers(1, 40), st.integers(1, 5))
def test_coder_round_trip(ids, size, lanes):
    old = range_coder.BLOCK, range_coder.LANES
    try:
        range_coder.BLOCK, range_coder.LANES = size, lanes
        coded(ids)
    finally:
        range_coder.BLOCK, range_coder.LANES = old


def test_coder_on_hard_inputs():
    rng = np.random.default_rng(3)
    for ids in ([], [2**29], [7] * 50_000, rng.integers(0, 2**29, 5000), rng.integers(0, 50_000, 200_000), np.tile(np.arange(70_000), 2), np.minimum(rng.zipf(1.2, 100_000), 60_000)):
        coded(ids)
    assert len(coded([7] * 50_000)) < 1500
    zipf = np.minimum(rng.zipf(1.5, 200_000), 50_000)
    share = np.unique(zipf, return_counts=True)[1] / len(zipf)
    assert len(coded(zipf)) * 8 < len(zipf) * -(share * np.log2(share)).sum() * 1.2 + 8 * 8 * len(share) + 128 * (len(zipf) / range_coder.BLOCK + 1)  # near the entropy, beside the header


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(1).integers(0, 900, 3 * range_coder.BLOCK + 5).astype(np.uint32)
    raw = bytearray(range_coder.encode(ids))
    same = range_coder.encode(np.concatenate([ids[: range_coder.BLOCK], ids[: range_coder.BLOCK]]))
    head = range_coder._HEAD.size + 8 * range_coder._HEAD.unpack_from(same)[3]
    sizes = np.frombuffer(same[head : head + 16], "<u4")[::2]
    body = same[head + 16 :]
    assert sizes[0] == sizes[1] and body[: sizes[0]] == body[sizes[0] :]  # a block's code does not depend on what was before it
    for at in (range_coder._HEAD.size + 8 * 900 + 4, len(raw) - 30, len(raw) // 2):
        bad = bytearray(raw)
        bad[at] ^= 0x40
        with pytest.raises(range_coder.CorruptBlock):
            list(range_coder.decode(bytes(bad)))
    with pytest.raises(range_coder.CorruptBlock):
        list(range_coder.decode(b"XXXX" + bytes(raw[4:])))


# ---- token files


def frame(spark, rows, extra=True):
    schema = "doc_id long, text string" + (", `keys` string, part int, `_k` string, side int" if extra else "")
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows] if extra else rows, schema).repartition(3)


def slow_files(rows):
    at, out = 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*SPECIAL.tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def sample(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_token_files(spark):
    rows = [*sample(spark), *((1000 + k, t) for k, t in enumerate(ODD)), (1003, ODD[3]), (None, "null key")]
    old = token_files.STRETCH
    try:
        for token_files.STRETCH in (old, 500):
            assert sorted((tuple(r) for r in token_files.round_trip(frame(spark, rows)).collect()), key=str) == slow_files(rows)
    finally:
        token_files.STRETCH = old
    assert token_files.round_trip(frame(spark, [(1, "a")]).where("doc_id = 2")).collect() == []


def test_token_files_give_the_ids_back(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(ODD)]
    token_files.write_tokens(frame(spark, rows), f"file://{tmp_path}/ids")
    got = {r.doc_id: r.token_ids for r in token_files.read_tokens(spark, f"file://{tmp_path}/ids").collect()}
    assert got == {k: [*SPECIAL.tok.encode(t or "", add_special_tokens=False).ids, 2] for k, t in rows}


def test_one_key_with_most_rows_is_cut_into_ranges(spark, tmp_path):
    df = spark.range(4000).selectExpr("if(id % 3 = 0, id, 5L) as doc_id", "concat('text ', id % 50) as text")
    token_files.write_tokens(df, f"file://{tmp_path}/ids")
    files = spark.read.parquet(f"file://{tmp_path}/ids").selectExpr("part", "size(keys) as n").collect()
    assert len(files) >= 3 and max(f.n for f in files) < 2400


def test_registered_token_files(spark):
    got = sorted((tuple(r) for r in queries.op13_token_files(spark, SF).collect()), key=str)
    assert got == slow_files(sample(spark))


# ---- alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def walk(ia, ib):
    """(groups, links) of two segmentations of the same bytes, token by token."""
    i = j = 0
    ea, eb, links, groups, ga, gb = len(A.bytes[ia[0]]), len(B.bytes[ib[0]]), [], [], [ia[0]], [ib[0]]
    while i < len(ia):
        links.append((ia[i], ib[j]))
        na, nb = ea <= eb, eb <= ea
        if na and nb:
            groups.append((ga, gb))
            ga, gb = [], []
        if na and (i := i + 1) < len(ia):
            ea += len(A.bytes[ia[i]])
            ga.append(ia[i])
        if nb and (j := j + 1) < len(ib):
            eb += len(B.bytes[ib[j]])
            gb.append(ib[j])
    return groups, links


def slow_alignment(rows):
    docs, counts = [], Counter()
    for k, t in rows:
        ia, ib = (A.tok.encode(" " + t, add_special_tokens=False).ids, B.sp.encode(t)) if t else ([], [])
        if not t or any(b"".join(m.bytes[x] for x in ids) != (" " + t).encode() for m, ids in ((A, ia), (B, ib))):
            ia, ib, groups, links = [], [], [], []
        else:
            groups, links = walk(ia, ib)
        counts.update(links)
        docs.append((k, ia, ib, groups, links))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    spell = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    out = [(k, len(ia), len(ib), len(g), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p), hashlib.sha256(spell(g).encode()).hexdigest() if ia else "") for k, ia, ib, g, p in docs]
    return sorted(out, key=str), counts, top


def test_alignment(spark):
    rows = [*sample(spark), *((1000 + k, t) for k, t in enumerate(ODD)), (1003, ODD[3]), (1003, ODD[3]), (None, "null key")]
    want, counts, top = slow_alignment(rows)
    old = alignment.WINDOW, alignment.RUN, vocab.PART
    try:
        for alignment.WINDOW, alignment.RUN, vocab.PART in (old, (2000, 256, 1 << 12)):
            docs, links = alignment.align(frame(spark, rows))
            assert sorted((tuple(r[c] for c in COLUMNS) for r in docs.collect()), key=str) == want
            assert {(r.a, r.b): (r.n, r.best) for r in links.collect()} == {p: (n, n == top[p[1]]) for p, n in counts.items()}
    finally:
        alignment.WINDOW, alignment.RUN, vocab.PART = old
    assert alignment.align(frame(spark, rows).where("doc_id = -1"))[0].collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), max_size=25), st.data()), min_size=1, max_size=4), st.integers(1, 9))
def test_sweep_in_windows_of_any_size(parts, step):
    """The machine on tokens of any lengths, its windows cut anywhere, against the plain walk."""
    size = np.arange(5)
    table = alignment.Table(size)
    docs = []
    for left, draw in parts:
        total, right = sum(left), []
        while sum(right) < total:
            right.append(min(draw.draw(st.integers(1, 4)), total - sum(right)))
        docs.append((left, right))
    sweep = alignment.Sweep(table, table)
    kind = table.wide
    got, links = {}, defaultdict(list)

    def window(ids, rows, closed):
        found, owner, pairs = sweep.window(rows, ids, closed)
        for d, _, sums, _ in found:
            if sums:
                got[d] = sums
        for o, p in zip(owner.tolist(), pairs.tolist(), strict=True):
            links[rows[o][0]].append((p // 5, p % 5))

    for d, (left, right) in enumerate(docs):
        la, rb = np.array(left, kind), np.array(right, kind)
        n = max(1, -(-max(len(la), len(rb)) // step))
        for k in range(n):
            window(([la[k * step : (k + 1) * step]], [rb[k * step : (k + 1) * step]]), [(d, d)], k == n - 1)
    old = A.bytes, B.bytes
    try:
        A.bytes = B.bytes = [b"x" * k for k in range(5)]
        for d, (left, right) in enumerate(docs):
            groups, pairs = walk(left, right) if left else ([], [])
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            assert got[d] == (len(left), len(right), len(groups), len(pairs), hashlib.sha256(text.encode()).hexdigest() if left else "")
            assert links[d] == pairs
    finally:
        A.bytes, B.bytes = old


def test_registered_alignment(spark):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, SF).collect()), key=str)
    assert got == slow_alignment(sample(spark))[0]
