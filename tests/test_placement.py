"""What moves: rows are placed before they become several."""

import re

import pytest
from pyspark.sql import functions as F

from provendar import queries
from provendar.operators import quality

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["energy_recalc", "divergence_max"])
def test_exploded_rows_are_not_shuffled(spark, name):
    """Every exchange of line items lies below the generator that makes several rows of each."""
    text = plan(queries.queries()[name](spark, SF))
    depth = lambda line: len(re.match(r"[\s:|+-]*", line)[0])
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if "Generate stack" in line:
            above = [x for j, x in enumerate(lines[:k]) if "Exchange hashpartitioning" in x and depth(x) < depth(line) and all(depth(y) > depth(x) for y in lines[j + 1 : k + 1])]
            assert not above, above


def test_profile_with_null_keys_and_differing_values(spark):
    rows = [("a", "s", "FAT", "r1", 1.0), ("a", "s", "FAT", "r2", 2.0), ("a", None, "FAT", "r1", 3.0), ("a", None, "FAT", "r0", 9.0), (None, "s", "FAT", "r1", 4.0), (None, None, "FAT", "r1", 5.0), (None, None, "FAT", "r3", 6.0), ("b", "s", "FAT", "r1", 7.0)]
    v = spark.createDataFrame(rows, "concept_id string, source_id string, nutrient_id string, source_record_id string, value double").withColumn("unit", F.lit("g"))
    got = {(r.concept_id, r.source_id): r.FAT for r in quality.profile(v, ["FAT"]).collect()}
    assert got == {("a", "s"): 2.0, ("a", None): 3.0, (None, "s"): 4.0, (None, None): 6.0, ("b", "s"): 7.0}
