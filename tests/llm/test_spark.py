"""Operators on small tables with nulls, empty and repeated rows, ties, null and repeated ids, extra columns, against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from provendar.llm import common as C
from provendar.llm import components, decontaminate, jaccard_join, language, neighbours, quality, queries, repeats, sentencepiece_codec, sharding, toxicity, url_filters

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, anchor string, kind string, cls string"


def docs(spark, rows):
    """rows: (doc_id, text[, source]); further columns clash with names used inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def sample(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return [*rows, (1000, None), (1001, ""), (1002, " \n "), (1003, "two words"), (1004, "two  words"), (1005, "a " * 3000), (1006, rows[0][1])]


# ---- near duplicates


def slow_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    par = {i: i for i in sets}

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    by = defaultdict(list)
    for i in sorted(sets):
        n = defaultdict(int)
        for g in sets[i]:
            for j in by[g]:
                n[j] += 1
            by[g].append(i)
        for j, c in n.items():
            if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                par[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark):
    rows = sample(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs(spark, rows)).collect()}
    assert got == slow_components(rows)


def test_large_groups_of_near_copies_and_shared_passages(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    base, rows = [word() for _ in range(60)], []
    for i in range(30):  # a chain of copies: each differs from the one before in a word, far ones are not similar
        base[int(rng.integers(0, 60))] = word()
        rows.append((i, " ".join(base)))
    passage = " ".join(word() for _ in range(40))
    rows += [(100 + i, passage + " " + " ".join(word() for _ in range(12))) for i in range(24)]
    small = (jaccard_join.SMALL, jaccard_join.MIDDLE, jaccard_join.TILE, jaccard_join.SHARD_BYTES)
    try:
        for jaccard_join.SMALL, jaccard_join.MIDDLE, jaccard_join.TILE, jaccard_join.SHARD_BYTES in ((2, 10, 2048, 2000), (2, 1, 4, 1 << 24)):
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs(spark, rows)).collect()}
            assert got == slow_components(rows)
        pairs, members = jaccard_join.similar_pairs(docs(spark, rows + [(500, rows[3][1])]))
        own = {r.doc_id: r.cls for r in members.collect()}
        assert own[500] == own[rows[3][0]]
        sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
        want = {tuple(sorted((own[i], own[j]))) for i in sets for j in sets if i < j and own[i] != own[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(want) and len(want) > 20
    finally:
        jaccard_join.SMALL, jaccard_join.MIDDLE, jaccard_join.TILE, jaccard_join.SHARD_BYTES = small


def test_near_duplicates_with_odd_ids(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (5, "other words"), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 2, None), (5, 2, 2), (5, 2, 2), (2, 2, 2), (5, 1, 5), (None, 0, None)], key=repr)
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs(spark, rows[1:5])).collect())
    assert kept == [(2, "a b c d e f"), (5, "other words")]
    once = jaccard_join.keep_one(docs(spark, [(1, "x y"), (1, "x y"), (3, "z")])).collect()
    assert sorted(r.doc_id for r in once) == [1, 3]


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    kept = lambda rows: sorted((r.doc_id, r.text or "") for r in jaccard_join.keep_one(docs(spark, rows)).collect())
    assert kept([(5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (5, "other words")]) == [(2, "a b c d e f"), (5, "other words")]
    text = [f"w{i}" for i in range(60)]
    near = " ".join([*text[:-1], "x"])
    text = " ".join(text)
    # two texts of one id are no link between their groups
    assert kept([(2, text), (2, "own text"), (1, near), (7, "own text")]) == [(1, near), (2, "own text")]
    # of one id's own copies one stays; texts without words are no copies of others
    assert kept([(3, text), (3, near), (3, ""), (3, ""), (4, None), (4, "own text")]) == [(3, ""), (3, text), (4, ""), (4, "own text")]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# ---- repeated passages


def slow_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - repeats.WINDOW + 1):
            w = b[s : s + repeats.WINDOW]
            if w in seen:
                gone[s : s + repeats.WINDOW] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def digest(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("hot", [False, True])
def test_repeats(spark, hot, monkeypatch):
    line = "a line of boilerplate that is over one hundred bytes long and stands in very many documents of this small corpus. "
    rows = sample(spark) + [(2000 + i, f"début {i} é " + line * (1 + i % 3) + f"fin {i * i}") for i in range(40)]
    if hot:  # take all frequent anchors apart
        monkeypatch.setattr(repeats, "SAMPLE_LEAST", 2)
        full = repeats.hot_anchors
        monkeypatch.setattr(repeats, "hot_anchors", lambda rows, total, parts: full(rows, total, parts * 100))
        monkeypatch.setattr(repeats, "SORT_BYTES", 2000)
        monkeypatch.setattr(repeats, "SHARD_BYTES", 20_000)
        monkeypatch.setattr(C, "BROADCAST_ROWS", 1)
    assert digest(repeats.remove_repeats(docs(spark, rows))) == slow_repeats(rows)


def test_repeats_with_odd_ids(spark):
    t = "".join(chr(97 + c) for c in np.random.default_rng(1).integers(0, 26, 300))
    rows = [(5, t), (5, t), (None, t), (7, t), (7, "short")]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs(spark, rows)).collect()), key=repr)
    assert [g[1:] for g in got if g[0] == 5] == [(300, 300), (300, 300)] and (None, 300, 0) in got and (7, 300, 300) in got and (7, 5, 0) in got


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_cutting_documents(spark, monkeypatch, most):
    monkeypatch.setattr(C, "BROADCAST_ROWS", most)
    t = "é".join(chr(97 + c) for c in np.random.default_rng(2).integers(0, 26, 120))
    rows = [(1, t), (2, "start " + t + " end"), (3, None), (4, "")]
    df = docs(spark, rows)
    out = {r.doc_id: r for r in repeats.cut_documents(df).collect()}
    assert repeats.cut_documents(df).columns == df.columns
    assert out[1].text == t and out[2].text == "start  end" and out[2].n_chars == 10 and out[3].text is None and out[4].text == ""


# ---- the others


def test_sharding(spark):
    rows = [(i, f"t{i % 7}", "big" if i % 3 else f"s{i % 5}") for i in range(400)] + [(None, None, None), (1, "t1", "big"), (1, "t1", "big")]
    for shards in (24, 1):
        got = sharding.interleave(docs(spark, rows), shards).collect()
        assert len(got) == len(rows)
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r)
        sizes = [len(x) for x in by.values()]
        assert max(sizes) - min(sizes) <= 1 and set(by) == set(range(shards))
        assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
        assert all(r.law == "rows" and r.grown_shard is None for r in got)
        assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows}
        src = {i: s for i, _, s in rows}
        n = defaultdict(int)
        for r in got:
            n[r.shard, src[r.doc_id]] += 1
        for s in set(src.values()):
            own = [n[k, s] for k in range(shards)]
            assert max(own) - min(own) <= 2
    small = sharding.BUCKET_ROWS
    try:
        sharding.BUCKET_ROWS = 7
        a = {(r.doc_id, r.shard) for r in sharding.interleave(docs(spark, rows[:400])).collect()}
        assert a == {(r.doc_id, r.shard) for r in sharding.interleave(docs(spark, rows[:400]).repartition(5)).collect()}
    finally:
        sharding.BUCKET_ROWS = small


def test_sharding_equals_a_plain_sort(spark, monkeypatch):
    """Ranks inside each source by the seeded hash, fractional ranks, one sort, one cut - also with copies dealt out in chunks."""
    rows = [(i, f"t{i % 7}", "big" if i % 3 else f"s{i % 5}") for i in range(300)] + [(None, None, None)] * 3 + [(7, "copy", "big")] * 50
    df = docs(spark, rows)
    hashed = df.select("doc_id", "text", "source", F.xxhash64(F.lit(20240607), F.col("doc_id").cast("long"), F.crc32(F.coalesce("text", F.lit("")))).alias("h")).collect()
    by = defaultdict(list)
    for r in hashed:
        by["n" if r.source is None else "s" + r.source].append(r)
    for bucket, block, chunk in ((512, 4096, 10_000), (7, 3, 4)):
        parts, order = -(-len(rows) // bucket), []
        for s, own in by.items():  # the seeded shuffle: by hash bucket, then by the hash
            own.sort(key=lambda r: (r.h % parts, r.h, r.doc_id is not None, r.doc_id or 0))
            order += [((2 * k + 1) / (2 * len(own)), s, k, r) for k, r in enumerate(own)]
        order.sort(key=lambda x: x[:3])
        want = sorted((str(x[3].doc_id), zlib.crc32((x[3].text or "").encode()), p * 24 // len(order)) for p, x in enumerate(order))
        monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
        monkeypatch.setattr(sharding, "BLOCK_BUCKETS", block)
        monkeypatch.setattr(sharding, "CHUNK", chunk)
        got = sharding.interleave(df).collect()
        assert sorted((str(r.doc_id), r.text_crc32, r.shard) for r in got) == want


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[40:80] = v[40]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(400, None), (420, [0.0] * 8), (440, [1.0] * 7 + [float("nan")]), (460, [1.0] * 7 + [None]), (480, [1.0] * 3), (500, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, block string").repartition(3)
    got = defaultdict(list)
    for r in neighbours.nearest(df, block_rows=70).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = v.astype(np.float64)
    assert set(got) == set(range(0, 300, 20))
    for q in got:
        want = []
        for j in range(300):
            score = 0.0  # plain additions in order: sum() of Python compensates
            for a, b in zip(x[q].tolist(), x[j].tolist(), strict=True):
                score += a * b
            want.append((-score, j))
        want = sorted(w for w in want if w[1] != q)[:20]
        assert got[q] == [(j, -s) for s, j in want]
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)")).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, 1), (0, 2)]


def test_leaks(spark):
    words = [f"w{i}" for i in range(200)]
    items = [(1, " ".join(words[:20])), (2, " ".join(words[50:90])), (3, "one two"), (4, None), (5, ""), (1, " ".join(words[:20])), (1, " ".join(words[:24])), (None, " ".join(words[150:170]))]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, score string")
    rows = [(1, "before " + " ".join(words[:20]) + " after"), (2, " ".join(words[50:70] + ["x"] + words[71:90])), (3, " ".join(words[100:])), (4, None), (5, ""), (6, "say One, two!"), (7, " ".join(words[50:58]) + " other text"), (1, "clean row of the same id"), (None, " ".join(words[150:170])), (8, "one alone")]
    got = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs(spark, rows), bench).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1), (2, 2), (6, 3), (None, None), (3, None)], key=repr)  # one row per item id
    kept = sorted((r.doc_id, r.text or "") for r in decontaminate.drop_leaks(docs(spark, rows), bench).collect())
    assert kept == sorted((i, t or "") for i, t in [rows[3], rows[4], rows[6], rows[7], rows[9]])


def test_pieces(spark):
    rows = [(1, "Hello  world\n"), (2, ""), (3, None), (4, "日本 ▁"), (1, "Hello  world\n"), (None, "x")]
    out = sentencepiece_codec.encode_documents(docs(spark, rows))
    got = {(r.doc_id, r.n_tokens is None, r.round_trip) for r in out.collect()}
    assert got == {(1, False, True), (2, False, True), (3, True, None), (4, False, False), (None, False, True)}
    back = {(r.doc_id, r.text) for r in sentencepiece_codec.decode_documents(out).collect()}
    assert (1, "Hello  world\n") in back and (3, None) in back


def test_urls(spark):
    rows = [(1, "http://a.example.net/en/"), (1, "http://a.example.net/en/"), (None, "http://b.net/x"), (2, None)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, host string")
    got = sorted((tuple(r) for r in url_filters.filter_urls(df).drop("pattern").collect()), key=repr)
    assert got == sorted([(1, "a.example.net", "/en/", "example.net/en/", "allow")] * 2 + [(None, "b.net", "/x", "net/", "block"), (2, "", "", None, "allow")], key=repr)


def test_models_with_few_or_no_labels(spark):
    rows = docs(spark, [(1, "text"), (2, None), (3, ""), (None, "x"), (1, "text")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(rows, none).count() == 5 and quality.score_documents(rows, none).count() == 5
    one = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert {round(r.score, 3) for r in toxicity.score_documents(rows, one).collect()} <= {0.0, 0.5, 1.0}
    assert quality.keep_good(rows, one).count() == 5
    out = language.identify(rows, language.train(rows.withColumn("lang", F.lit(None).cast("string"))))
    assert {(r.lang_pred, r.score) for r in out.collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    for q, label, least in (("op2_toxicity", "toxic", 0.9), ("op3_quality", "quality", 0.88)):
        got = queries.QUERIES[q](spark, d).where("held_out").join(labels, "doc_id")
        assert got.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op5_language"](spark, d).where("held_out").join(truth, "doc_id")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] >= 0.97


@pytest.mark.parametrize("name", ["op1_url_filters", "op8_neighbours"])
def test_against_sql(spark, name):
    from oracle import connect, same

    same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name])


def test_empty_tables(spark):
    e = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (
        jaccard_join.link_components(e), jaccard_join.keep_one(e), repeats.remove_repeats(e), repeats.cut_documents(e), sharding.interleave(e), sentencepiece_codec.encode_documents(e),
        decontaminate.find_leaks(e, bench), decontaminate.drop_leaks(e, bench), toxicity.score_documents(e, labels), quality.score_documents(e, labels), language.identify(e, language.train(e)),
        neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")), url_filters.filter_urls(spark.createDataFrame([], "page_id long, url string")),
    ):
        assert df.count() == 0


CLASHING = ("_k", "_K2", "spans", "_spans", "_n", "_t", "_cls", "cls", "_g", "_r", "a.b", "kind", "blob", "part", "_id", "_text")


def test_stages_keep_columns_of_any_name(spark):
    """Nulls in every column, empty and repeated rows, and columns named like those that the operators use inside."""
    long = "".join(chr(97 + c) for c in np.random.default_rng(4).integers(0, 26, 300))
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "en", "s"), (2, words, None, None), (2, words, None, None), (3, None, "en", "s"), (4, "", None, "s"), (5, long, "en", None), (6, "x " + long, "en", "s"), (None, "own text " * 3, None, None), (7, "other words here", "en", "s")]
    cols = ", ".join(f"`{c}` string" for c in CLASHING)
    for odd in (rows[:1] + rows[3:7] + rows[8:], rows):
        df = spark.createDataFrame([(*r, len(r[1] or ""), *(f"{c}-{k}" if k % 3 else None for c in CLASHING)) for k, r in enumerate(odd)], f"doc_id long, text string, lang string, source string, n_chars long, {cols}").repartition(3)
        bench = spark.createDataFrame([(1, "w1 w2 nothing like it at all is here")], "item_id long, text string")
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        for got in (jaccard_join.keep_one(df), repeats.cut_documents(df), decontaminate.drop_leaks(df, bench), quality.keep_good(df, labels)):
            assert got.columns == df.columns
            same = {(r.doc_id, r["a.b"]) for r in got.collect()}
            assert same <= {(r[0], f"a.b-{k}" if k % 3 else None) for k, r in enumerate(odd)}
        assert {r.doc_id for r in jaccard_join.keep_one(df).collect()} == {1, 3, 4, 5, 6, 7, None} & {r[0] for r in odd}
        cut = {(r.doc_id, r.text) for r in repeats.cut_documents(df).collect()}
        assert (6, "x ") in cut and (5, long) in cut and (3, None) in cut and (4, "") in cut


def test_pipeline_on_empty_null_and_repeated_rows(spark, tmp_path):
    import corpus_pipeline as P

    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (2, None, None, None, None), (3, "", None, "s", 0), (None, "lonely " * 20, None, None, None), (4, text + " x", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, some in enumerate(([], rows)):
        d = str(tmp_path / str(k))
        spark.createDataFrame(some, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = sorted((str(r.doc_id), r.n_tokens is None) for r in P.run(spark, d).collect())
        assert got == ([] if not some else sorted([("1", False), ("2", True), ("3", False), ("None", False)]))


def test_held_out_rule(spark):
    ids = [*range(50), -3, None]
    got = {r.doc_id: (r.a, r.b) for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", C.held_out().alias("a"), C.trainable().alias("b")).collect()}
    assert got == {i: (i is not None and zlib.crc32(str(i).encode()) % 5 == 0, i is not None and zlib.crc32(str(i).encode()) % 5 != 0) for i in ids}


def test_pieces_equal_their_library_on_all_documents(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    got = sentencepiece_codec.encode_documents(d).collect()
    assert len(got) == len(text) and all(r.token_ids == (None if text[r.doc_id] is None else lib.encode(text[r.doc_id])) for r in got)


def test_leaks_equal_all_alignments(spark):
    """The query's rows over a whole small table are those of aligning every item with every document."""
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op10_decontaminate"](spark, SF).collect()}
    texts, items = d.select("doc_id", "text").collect(), b.select("item_id", "text").collect()
    it = decontaminate.Items([r.item_id for r in items], [r.text for r in items])
    want = set()
    for r in texts:
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        w, _ = decontaminate.word_hashes(raw, np.array([0, len(raw)]))
        for i in range(len(items)):
            own = it.words[it.first[i] : it.first[i + 1]]
            if len(w) and 2 * np.isin(own, w).sum() >= it.score[i] and decontaminate.align(own, w)[0] >= it.score[i]:
                want.add((r.doc_id, it.ids[i]))
    assert got == want and got


def test_pipeline(spark):
    import corpus_pipeline as P

    out = P.run(spark, SF).collect()
    d = spark.read.parquet(f"{SF}/documents.parquet")
    stage = d
    for name, f in P.STAGES[:-1]:
        before = stage
        stage = f(spark, before, SF).cache()
        assert stage.columns == d.columns and 0 < stage.count() <= before.count()
        if name == "near_duplicates":
            comp = slow_components([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in stage.collect()} == {c for _, c in comp.values()}
    assert {r.doc_id for r in out} == {r.doc_id for r in stage.collect()}
    assert all(r.round_trip for r in out)


def test_scratch_tables_leave_little_in_the_driver(spark):
    """The text of a scratch table's plan is cut, the session's own limit stays; an id list of over half a million rows is not broadcast."""
    key, before = "spark.sql.maxPlanStringLength", spark.conf.get("spark.sql.maxPlanStringLength")
    wide = spark.range(10).select(*[(F.col("id") + k).alias(f"a_rather_long_name_of_a_column_{k}") for k in range(400)])
    C.drop(C.save(wide.groupBy(*wide.columns).agg(F.count("*").alias("n")), "plan"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    held = spark._jsparkSession.sharedState().statusStore().executionsList()
    assert len(held.last().physicalPlanDescription()) < 2 * C.PLAN_TEXT and spark.conf.get(key) == before
    assert C.few(spark.range(500_000)) and not C.few(spark.range(500_001))
