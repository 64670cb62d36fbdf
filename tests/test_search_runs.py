"""The search index: every label is read once, and its tables are those of a plain loop."""

import random
import unicodedata
from collections import Counter

import pyspark.sql.functions as F
import pytest

from provendar.functions import scalar as S
from provendar.operators import runs, search


def test_labels_are_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = [(k, "concept", str(k), "en", f"milk {k} of cow") for k in range(500)]
    t = spark.createDataFrame(rows, "label_id long, ref_kind string, ref string, locale string, text string").repartition(4).localCheckpoint()
    t = t.withColumn("text_normalized", counted.asNondeterministic()("text"))
    search.write_index(t, f"file://{tmp_path}/index")
    assert seen.value == len(rows)


def test_index_of_odd_texts_is_that_of_a_loop(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    pool = [*"abcde   .,'\n\t\0", *"éŒæÆßǽᴭꟹİſΣς한½ﬁ²٣́­‍\u0085", "\U0001d400", "\U0001f600", "汉"]
    texts = [None if k % 37 == 0 else "".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 40]))) for k in range(400)]
    rows = [(rng.choice([k, k << 40, -k]) if k > 1 else k, "concept", str(k), rng.choice(["en", "fr", None]), t) for k, t in enumerate(texts)]
    t = spark.createDataFrame(rows, "label_id long, ref_kind string, ref string, locale string, text string").repartition(3)
    t = t.withColumn("text_normalized", S.fold(F.col("text"))).localCheckpoint()
    index = search.write_index(t, f"file://{tmp_path}/index")
    grams, words, sizes = [], [], {}
    for r in t.withColumn("lower", F.lower("text")).withColumn("words", S.words_of(F.col("text_normalized"))).where("text is not null").collect():
        grams += [(g, r.locale, r.label_id) for g in {x[i : i + 3] for x in (r.lower, r.text_normalized) for i in range(len(x) - 2)}]
        words += [(w, r.locale, r.label_id, n, len(r.words)) for w, n in Counter(r.words).items()]
        if r.words:
            sizes.setdefault(r.locale, []).append(len(r.words))
    assert Counter(map(tuple, index.grams.collect())) == Counter(grams)
    assert {(r.gram, r.locale): r.df for r in index.counts.collect()} == Counter(g[:2] for g in grams)
    assert Counter(map(tuple, index.words.collect())) == Counter(words)
    assert {r.locale: (r.n, r.avg_len) for r in index.totals.collect()} == {k: (len(v), sum(v) / len(v)) for k, v in sizes.items()}


def test_only_labels_of_the_postings_are_tested(spark, tmp_path):
    """The tests of texts stay above the join with the labels found."""
    rows = [(k, "concept", str(k), "en", f"milk {'eu ment' if k % 100 == 7 else 'rice'} {k}") for k in range(1000)]
    t = spark.createDataFrame(rows, "label_id long, ref_kind string, ref string, locale string, text string").withColumn("text_normalized", F.col("text"))
    index = search.write_index(t, f"file://{tmp_path}/index", grams=False)
    found = search.matches(t, "eu me", index)
    assert sorted(r.label_id for r in found.collect()) == list(range(7, 1000, 100))
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first = next(k for k, x in enumerate(lines) if "Join" in x)
    assert any("exists(" in x for x in lines[: first + 1]) and not any("exists(" in x for x in lines[first + 1 :])
    with pytest.raises(search.SearchError):
        search.matches(t, "milk", index)


def test_grams_of_large_alphabets():
    """More characters than a cube of flags holds."""
    rng = random.Random(2)
    many = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    assert all(unicodedata.category(c) == "Lo" for c in many)
    texts = ["".join(rng.choice(many) for _ in range(50)) for _ in range(30)]
    import numpy as np

    grams, g, who = runs.grams_of(texts, np.arange(30) % 7, 7)
    assert sorted(zip((grams[k] for k in g), who.tolist(), strict=True)) == sorted({(t[i : i + 3], k % 7) for k, t in enumerate(texts) for i in range(48)})
