import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from provendar.functions import fixed as K
from provendar.functions import scalar as S
from provendar.functions import text as T


def values(spark, col, rows):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").select("i", col.alias("y")).orderBy("i").select("y").collect()]


def test_cells(spark):
    got = values(spark, S.parse_cell(F.col("x")), ["59,7", "traces", "-", "< 1,5", "0", "0,0009", "1e-3", None])
    assert [(g["value"], g["kind"]) for g in got] == [(59.7, "number"), (None, "trace"), (None, "missing"), (1.5, "below_loq"), (0.0, "number"), (0.0009, "number"), (0.001, "number"), (None, None)]
    with pytest.raises(Exception, match="unexpected cell"):
        values(spark, S.parse_cell(F.col("x")), ["abc"])


def test_keys_and_units(spark):
    assert values(spark, S.nutrient_key(F.col("x")), ["Energia\n[kcal] ", "α-tocoferol [mg]", "alfa-tocoferol [mg]", "Vitamina A [µg]"]) == ["energia_kcal", "a_tocoferol_mg", "a_tocoferol_mg", "vitamina_a_ug"]
    assert values(spark, S.unit_of(F.col("x")), ["Energy (kJ/100 g)", "Water (g/100 ml)", "none"]) == ["kJ".lower(), "g", None]
    with pytest.raises(Exception, match="no unit"):
        values(spark, S.nutrient_key(F.col("x")), ["Energia"])


def test_folding(spark):
    words = ["cœur", "açaí", "Água", "Straße", "ÉTÉ", None, ""]
    want = ["coeur", "acai", "agua", "strasse", "ete", None, ""]
    assert values(spark, S.fold(F.col("x")), words) == want
    assert values(spark, T.normalize_label(F.col("x")), words) == want


def slow_id(seed):
    n = int.from_bytes(hashlib.sha256(f"{K.ID_PREFIX}:{seed}".encode()).digest()[:16], "big")
    return "".join(K.ID_ALPHABET[(n >> (5 * k)) & 31] for k in range(25, -1, -1))


def test_stable_id(spark):
    seeds = [f"s{i}|é" for i in range(200)]
    assert values(spark, S.stable_id(F.col("x")), seeds) == [slow_id(s) for s in seeds]


def test_terms_and_similarity(spark):
    from provendar.operators import matching

    keys = spark.createDataFrame([("alho", "garlic"), ("alho frances", "leek"), ("cru", "raw"), ("nada", None)], "key string, term string")
    rows = spark.createDataFrame(list(enumerate(["Alho-francês cru", "alho cru", "nada", None])), "id int, x string").select("id", T.words_exact("x").alias("w"))
    assert {r.id: r.terms for r in matching.phrase_terms(rows, "w", keys).collect()} == {0: ["leek", "raw"], 1: ["garlic", "raw"]}
    got = spark.createDataFrame([("abcd", "bcde")], "a string, b string").select(T.name_similarity("a", "b")).first()[0]
    assert got == 0.75


def test_methods_and_ranks(spark):
    assert values(spark, S.classify_method(F.col("x")), ["Beef, stir fry", "boiled then fried", "raw"]) == ["fried", "boiled", None]
    assert values(spark, S.rank_in(F.split(F.lit("a>b"), ">"), F.col("x")), ["a", "b", "c"]) == [1, 2, 3]


@settings(max_examples=15, deadline=None)
@given(st.floats(0, 1e6), st.floats(0, 1e6))
def test_relative_difference(spark, a, b):
    got = spark.range(1).select(S.relative_difference(F.lit(a), F.lit(b))).first()[0]
    assert got == (abs(a - b) / max(a, b) if max(a, b) else 0.0)


def test_conversion_needs_a_positive_factor(spark):
    assert spark.range(1).select(S.convert(F.lit(2.0), F.lit(0.5))).first()[0] == 1.0
    with pytest.raises(Exception, match="positive"):
        spark.range(1).select(S.convert(F.lit(2.0), F.lit(0.0))).collect()
