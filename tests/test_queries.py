import pytest
from oracle import connect, same

from provendar import queries

SF = "/root/testdata/sf0.001"
Q, O = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, con, name):
    df = Q[name](spark, SF)
    if name in O:
        same(df, con, O[name])
    else:
        assert df.count() > 0


def test_entry_points_work_without_the_corpus_operators(tmp_path):
    """A copy without provendar/llm, corpus_pipeline.py and their tests still imports, lists its queries and answers one."""
    import subprocess
    import sys
    from pathlib import Path
    from shutil import copytree, ignore_patterns, rmtree

    root = Path(__file__).resolve().parents[1]
    copytree(root, tmp_path / "copy", ignore=ignore_patterns(".git", "__pycache__", "corpus_pipeline.py"))
    rmtree(tmp_path / "copy" / "provendar" / "llm", ignore_errors=True)  # they may be gone already
    code = f"""
import __spark_entry__ as e
from pyspark.sql import SparkSession
q = e.queries()
assert not [n for n in q if n.startswith("op") or n == "pipeline"], q
assert set(e.oracle_sql()) <= set(q)
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/scratch").getOrCreate()
print(len(q), q["unpivot_cells"](s, "{SF}").count())
"""
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-2:] == [str(len(Q)), "24000"]


def test_every_record_has_its_provenance(spark):
    import datetime

    import pyarrow.parquet as pq

    rows = lambda name: pq.read_table(f"{SF}/{name}.parquet").to_pylist()
    regions = {r["r_regionkey"]: r["r_name"] for r in rows("region")}
    nations = {n["n_nationkey"]: (n["n_name"], regions[n["n_regionkey"]]) for n in rows("nation")}
    suppliers = {s["s_suppkey"]: (s["s_name"], *nations[s["s_nationkey"]]) for s in rows("supplier")}
    day = lambda x: (x["l_shipdate"].date() - datetime.date(1970, 1, 1)).days
    want = [("-".join(str(v) for v in (*(x[c] for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), day(x), round(x["l_quantity"] * 100))), *suppliers[x["l_suppkey"]]) for x in rows("lineitem")]
    assert len({w[0] for w in want}) == len(want)
    assert sorted(tuple(r) for r in Q["provenance_walk"](spark, SF).collect()) == sorted(want)


def test_greedy_choice_equals_the_sequential_loop(spark):
    """On the registered input: edges in falling order, each taken if both its ends are free."""
    from provendar.queries import _scored

    edges = sorted(((-r.jaccard, r.left_id, r.right_id) for r in _scored(spark, SF).collect()))
    left, right, want = set(), set(), set()
    for _, a, b in edges:
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            want.add((a, b))
    assert {(r.left_id, r.right_id) for r in Q["greedy_one_to_one"](spark, SF).collect()} == want


def test_name_similarity_equals_the_plain_ratio(spark):
    from difflib import SequenceMatcher

    got = Q["name_similarity"](spark, SF).collect()
    assert got and all(abs(r.similarity - SequenceMatcher(None, r.p_name, r.other).ratio()) < 1e-12 for r in got)


def test_phrases_equal_a_plain_scan(spark):
    import pyarrow.parquet as pq

    parts = pq.read_table(f"{SF}/part.parquet").to_pylist()
    keys = {}
    for p in sorted(parts, key=lambda p: p["p_partkey"]):
        if p["p_partkey"] % 3:
            keys[p["p_name"]] = p["p_brand"]
    for p in parts:
        if p["p_size"] % 2 == 0:
            k = p["p_name"].split()[0]
            keys[k] = min(keys.get(k, p["p_type"]), p["p_type"])

    def scan(words):
        i, out = 0, set()
        while i < len(words):
            n = next((n for n in range(len(words) - i, 0, -1) if " ".join(words[i : i + n]) in keys), 0)
            out |= {keys[" ".join(words[i : i + n])]} if n else set()
            i += n or 1
        return "|".join(sorted(out))

    want = {p["p_partkey"]: scan((p["p_name"] + " " + p["p_name"]).split()) for p in parts}
    assert {r.p_partkey: r.terms for r in Q["phrase_join"](spark, SF).collect()} == {k: t for k, t in want.items() if t}
