from provendar.functions import fixed as K
from provendar.operators import vocabulary as V
from provendar.plans import factors
from provendar.plans.store import Scratch


def test_vocabulary(spark):
    n = spark.createDataFrame([("FAT", "m", "g"), ("FAT", "m", "g"), ("bad", "m", "g"), ("ASH", "x", "g"), ("NA", "m", "kg")], "tagname string, `group` string, unit string")
    g, u = spark.createDataFrame([("m",)], "`group` string"), spark.createDataFrame([("g",)], "unit string")
    r = spark.createDataFrame([("FAT", "ASH"), ("FAT", "ASH"), ("ASH", "FAT"), ("NA", "NA"), ("FAT", "NONE")], "parent string, child string")
    n = n.unionAll(spark.createDataFrame([(t, "m", "g") for t in K.ENERGY_TAGS[:1]], n.schema))
    v = spark.createDataFrame([(t, "true") for t in K.ABSENCE_TYPES[1:]] + [("odd", "maybe")], "id string, is_absence string")
    got = {tuple(x) for x in V.vocabulary(n, g, u, r, v, Scratch(spark).save).collect()}
    assert got == {("energy_tag", K.ENERGY_TAGS[1]), ("absence_type", K.ABSENCE_TYPES[0]), ("absence_flag", "odd"), ("tag_form", "bad"), ("tag_unique", "FAT"), ("group_known", "ASH"), ("unit_known", "NA"), ("relation_known", "NONE"), ("relation_self", "NA"), ("relation_twice", "FAT>ASH"), ("relation_cycle", "FAT"), ("relation_cycle", "ASH"), ("relation_cycle", "NA")}


def test_release_rules(spark):
    src = spark.createDataFrame([("a", "free"), ("b", "closed")], "source_id string, license_id string")
    ok = spark.createDataFrame([("full", "free"), ("lite", "closed")], "profile string, license_id string")
    assert [r.ref for r in V.licences(src, ok, "full").collect()] == ["b"]
    v = spark.createDataFrame([("r1", "declared"), ("r2", None), ("r3", "odd")], "source_record_id string, acquisition_type string")
    assert {r.ref for r in V.acquisition(v, spark.createDataFrame([("declared",)], "acquisition_type string")).collect()} == {"r2", "r3"}
    e = spark.createDataFrame([(0.99, 0.5)], "precision double, recall double")
    assert V.matcher(e).count() == 1 and V.matcher(e, recall=0.4).count() == 0


def test_retention(spark, tmp_path):
    (tmp_path / "r.txt").write_text("~1~^~Beef, roasted~^~401~^90\n~2~^~Pork, roasted~^~401~^80\n~3~^~Raw~^~401~^100\n~4~^~Peas, boiled~^~999~^50\n")
    codes = spark.createDataFrame([("401", "VITC")], "nutrient_code string, nutrient string")
    got = factors.retention(spark, str(tmp_path / "r.txt"), ["id", "description", "nutrient_code", "factor"], codes).collect()
    assert [tuple(r) for r in got] == [("VITC", "roasted", 0.85, 2, 0.8, 0.9)]
