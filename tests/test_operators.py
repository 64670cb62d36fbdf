import random

import pytest
from pyspark.sql import functions as F

from provendar.functions import fixed as K
from provendar.functions import text as T
from provendar.operators import components, digests, gates, labels, matching, quality, ranks, records, search, selection
from provendar.plans.store import Scratch

RULES = [("en", "*", "*", "a>b"), ("en", "veg", "*", "b>a"), ("en", "*", "FAT", "c>a"), ("en", "veg", "FAT", "a>c")]


def rules(spark, rows=RULES):
    return spark.createDataFrame(rows, "locale string, food_group string, nutrient string, source_order string")


def test_most_specific_rule(spark):
    cells = spark.createDataFrame([("en", "veg", "FAT"), ("en", "veg", "ASH"), ("en", "nut", "FAT"), ("en", "nut", "ASH")], "locale string, food_group string, nutrient_id string")
    got = {(r[0], r[1], r[2]): r[3] for r in selection.resolve_rules(cells, rules(spark)).collect()}
    assert got == {("en", "veg", "FAT"): ["a", "c"], ("en", "veg", "ASH"): ["b", "a"], ("en", "nut", "FAT"): ["c", "a"], ("en", "nut", "ASH"): ["a", "b"]}
    with pytest.raises(Exception, match="no source rule for fr veg FAT"):
        selection.resolve_rules(spark.createDataFrame([("fr", "veg", "FAT")], cells.schema), rules(spark)).collect()


def test_preferred_value_is_selected_not_averaged(spark):
    v = [("c1", "KJ", "b1", "A", 100.0, "measured"), ("c1", "KJ", "b2", "B", 60.0, "measured"), ("c1", "KJ", "b3", "A", 95.0, "trace"), ("c1", "FAT", "b4", "B", None, "below_loq")]
    values = spark.createDataFrame(v, "concept_id string, nutrient_id string, source_record_id string, source_id string, value double, value_type string")
    values = values.withColumn("basis", F.lit("x")).withColumn("unit", F.lit("u")).withColumn("derivation_id", F.lit(None).cast("string")).withColumn("acquisition_type", F.lit("declared"))
    concepts = spark.createDataFrame([("c1", "veg")], "concept_id string, food_group string")
    names = spark.createDataFrame([("concept", "c1", "en", "leek")], "ref_kind string, ref string, locale string, text string")
    over = spark.createDataFrame([("c1", "FAT", "x", 1.5, "g", "checked")], "concept_id string, nutrient_id string, basis string, value double, unit string, justification string")
    got = {r.nutrient_id: r for r in selection.read_model(values, concepts, names, rules(spark, [("en", "*", "*", "A>B")]), over).collect()}
    kj = got["KJ"]
    assert (kj.value, kj.source_record_id, [a.source_record_id for a in kj.alternatives]) == (100.0, "b1", ["b3", "b2"])
    assert kj.divergence_max == 0.4 and kj.divergence_flag and kj.override_justification is None
    assert (got["FAT"].value, got["FAT"].unit, got["FAT"].override_justification, got["FAT"].divergence_max) == (1.5, "g", "checked", 0.0)
    with pytest.raises(Exception, match="justification"):
        selection.read_model(values, concepts, names, rules(spark, [("en", "*", "*", "A>B")]), over.withColumn("justification", F.lit(" "))).collect()


def test_greedy_equals_sequential(spark):
    rng = random.Random(4)
    edges = sorted({(rng.randrange(25), rng.randrange(25)) for _ in range(150)})
    edges = [(a, b, float(rng.randrange(4)), float(rng.randrange(3))) for a, b in edges]
    left, right, want = set(), set(), set()
    for a, b, s, m in sorted(edges, key=lambda e: (-e[2], -e[3], e[0], e[1])):
        if a not in left and b not in right:
            left.add(a), right.add(b), want.add((a, b))
    df = spark.createDataFrame(edges, "left_id int, right_id int, score double, similarity double")
    assert {(r.left_id, r.right_id) for r in matching.one_to_one(df, Scratch(spark).save).collect()} == want


def test_greedy_by_component_equals_sequential(spark):
    """With a small limit, components are solved side by side and larger ones taken apart first."""
    rng = random.Random(9)
    edges = {(10 * g + rng.randrange(9), 10 * g + rng.randrange(9)) for g in range(12) for _ in range(20)} | {(500 + k, 500 + k + s) for k in range(80) for s in (0, 1)}
    edges = [(a, b, float(1000 - a - b) if a >= 500 else float(rng.randrange(4)), 0.0) for a, b in sorted(edges)]
    left, right, want = set(), set(), set()
    for a, b, s, m in sorted(edges, key=lambda e: (-e[2], -e[3], e[0], e[1])):
        if a not in left and b not in right:
            left.add(a), right.add(b), want.add((a, b))
    df = spark.createDataFrame(edges, "left_id int, right_id int, score double, similarity double")
    got = [(r.left_id, r.right_id) for r in matching.one_to_one(df, Scratch(spark).save, limit=60).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_long_falling_chain_takes_few_jobs(spark):
    n = 10_000
    df = spark.range(n).selectExpr("(id + 1) div 2 as left_id", "id div 2 as right_id", f"double({n} - id) as score", "0.0D as similarity")
    sc = spark.sparkContext
    sc.setJobGroup("chain", "chain")
    got = {(r.left_id, r.right_id) for r in matching.one_to_one(df, Scratch(spark).save).collect()}
    jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    sc.setJobGroup("other", "other")
    assert got == {(k, k) for k in range(n // 2)} and jobs < 15, jobs


def test_counters_come_with_the_write(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, id) as v").repartition(3)
    sc, jobs = spark.sparkContext, []
    for name, watched in (("plain", False), ("watched", True)):
        sc.setJobGroup(name, name)
        w = gates.Watch(df, {"empty": F.count_if(F.col("v").isNull())}, {"negative": F.col("id") >= 0})
        (w.df if watched else df).write.parquet(f"file://{tmp_path}/{name}")
        if watched:
            assert w.counts() == {"rows": 1000, "empty": 100}
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(name)))
    sc.setJobGroup("other", "other")
    assert jobs[0] == jobs[1]
    bad = gates.Watch(df, {}, {"a value is missing": F.col("v").isNotNull(), "fine": F.col("id") >= 0})
    bad.df.write.parquet(f"file://{tmp_path}/bad")
    with pytest.raises(gates.ContractError, match="a value is missing: 100 rows"):
        bad.counts()


def test_phrases_of_a_large_dictionary(spark):
    """A hundred thousand keys of up to four words against a scan."""
    rng = random.Random(15)
    word = lambda: f"w{rng.randrange(60)}"
    keys = {" ".join(word() for _ in range(rng.choice((1, 2, 3, 3, 4)))): f"t{k % 977}" for k in range(100_000)}
    rows = [(k, [word() for _ in range(rng.randrange(0, 14))]) for k in range(300)]

    def scan(words):
        i, out = 0, set()
        while i < len(words):
            n = next((n for n in range(min(4, len(words) - i), 0, -1) if " ".join(words[i : i + n]) in keys), 0)
            out |= {keys[" ".join(words[i : i + n])]} if n else set()
            i += n or 1
        return sorted(out)

    table = spark.createDataFrame(list(keys.items()), "key string, term string")
    got = {r.id: r.terms for r in matching.phrase_terms(spark.createDataFrame(rows, "id int, w array<string>"), "w", table).collect()}
    assert got == {k: scan(w) for k, w in rows if scan(w)}
    assert matching.phrase_terms(spark.createDataFrame(rows, "id int, w array<string>"), "w", table.limit(0)).count() == 0


def test_the_letter_bound_is_no_less_than_the_ratio(spark):
    from difflib import SequenceMatcher

    rng = random.Random(5)
    names = ["".join(rng.choice("abcé 1ß") for _ in range(rng.randrange(0, 12))) for _ in range(60)] + ["", "a", "leite magro", "leite gordo"]
    rows = [(x, y) for x in names for y in rng.sample(names, 12)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", matching.similarity_bound(matching.letter_counts(F.col("a")), matching.letter_counts(F.col("b"))).alias("bound")).collect()
    assert all(r.bound >= SequenceMatcher(None, r.a, r.b).ratio() - 1e-12 for r in got) and sum(r.bound < 0.5 for r in got) > 50


def test_cycles_against_a_walk(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(55)] + [(100 + k, 101 + k) for k in range(40)] + [(200, 200), (None, 3)]
    nxt = {}
    for a, b in edges:
        nxt.setdefault(a, set()).add(b)

    def reach(x):
        seen, todo = set(), [x]
        while todo:
            for y in nxt.get(todo.pop(), ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return seen

    got = {r.node for r in gates.cycles(spark.createDataFrame(edges, "parent int, child int"), Scratch(spark).save).collect()}
    assert got == {x for x in nxt if x is not None and x in reach(x)} and 200 in got
    assert gates.cycles(spark.createDataFrame([(k, k + 1) for k in range(30)], "parent int, child int"), Scratch(spark).save).count() == 0


def test_digests_tell_where_versions_differ(spark, tmp_path):
    rng = random.Random(11)
    rows = [(k, "abc"[k % 3], rng.choice([None, "x", "y"]), float(k % 7)) for k in range(900)]
    new = [(k, loc, t, v + (loc == "b" and k % 50 == 1)) for k, loc, t, v in rows if not (loc == "b" and k % 97 == 4)] + [(1000, "b", None, 1.0)]
    schema = "k int, locale string, t string, v double"
    for name, r in (("a", rows), ("b", new)):
        spark.createDataFrame(r, schema).repartition(3).write.partitionBy("locale").parquet(f"file://{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"file://{tmp_path}/{n}") for n in "ab")
    da, db = (digests.digests(x, ["k", "locale"], ["t", "v"], ["locale"]) for x in (a, b))
    cells = digests.differing(da, db, ["locale"])
    assert {r.locale for r in cells.collect()} == {"b"}
    got = digests.changes(a, b, cells, ["k", "locale"], ["t", "v"], ["locale"])
    want = records.diff(a, b, ["k", "locale"], ["t", "v"]).where("status <> 'same'")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() > 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "locale" in plan.split("PartitionFilters")[1][:80] and " b" in plan.split("PartitionFilters")[1][:120].replace("=", " ").replace("(", " ").replace(",", " ")
    assert digests.changes(a, a, digests.differing(da, da, ["locale"]), ["k", "locale"], ["t", "v"], ["locale"]).count() == 0


def test_medians_by_rank(spark):
    """Against a sort, in buckets of every size; the values of a group that one task orders stay within the limit."""
    import statistics

    rng = random.Random(12)
    draws = {"even": lambda: rng.uniform(-5, 5), "wide": lambda: rng.choice((-1, 1)) * 10 ** rng.uniform(-200, 200), "ties": lambda: float(rng.randrange(3)), None: lambda: rng.gauss(0, 1), "lone": lambda: 7.5}
    rows = [(g, None if rng.random() < 0.02 else f()) for g, f in draws.items() for _ in range(1 if g == "lone" else 400 + len(str(g)) % 2)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    want = {g: [x for h, x in rows if h == g and x is not None] for g in draws}
    for limit in (1 << 16, 32):
        got = {r.g: r for r in ranks.medians(df, ["g"], "v", Scratch(spark).save, limit).collect()}
        assert set(got) == {g for g in want if want[g]}
        for g, r in got.items():
            assert (r.n, r.low, r.high) == (len(want[g]), min(want[g]), max(want[g])) and r.median == pytest.approx(statistics.median(want[g]), rel=1e-12), g


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(200)] + [(2000, 2001 + k) for k in range(50)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a int, b int"), Scratch(spark).save).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in top} and len(got) == len(top)


GOLD, PROPOSED = "left_id string, right_id string, label boolean", "left_id string, right_id string, status string, score double, similarity double"


def evaluated(spark, gold, props):
    return matching.evaluate(spark.createDataFrame(gold, GOLD), spark.createDataFrame([(*p, 0.5) for p in props], PROPOSED), Scratch(spark).save).first().asDict()


def test_evaluation(spark):
    gold = [("1", "11", True), ("1", "12", False), ("2", "21", True), ("2", "22", True), ("3", "31", False), ("4", "41", True), ("5", "51", True)]
    props = [("1", "11", "automatic", 0.9), ("1", "12", "review", 0.7), ("2", "22", "review", 0.7), ("2", "23", "automatic", 0.95), ("3", "31", "automatic", 0.9), ("5", "51", "review", 0.6)]
    r = evaluated(spark, gold, props)
    assert (r["precision"], r["recall"], r["confirmed_recall"], r["food_recall"]) == (0.5, 0.6, 0.2, 0.75)
    assert (r["auto_finals"], r["review_golden_true"], r["golden_foods"], r["covered_foods"], r["golden_true"], r["golden_false"], r["false_negatives"]) == (3, 2, 4, 3, 5, 2, 2)


def test_evaluation_judges_final_links_only(spark):
    """A food with a wrong automatic pair is not covered; of two automatic pairs of one food only the better one is final; a pair without a status counts for nothing."""
    assert evaluated(spark, [("a", "x", True)], [("a", "y", "automatic", 0.9)])["food_recall"] == 0.0
    two = evaluated(spark, [("a", "x", True), ("a", "y", False)], [("a", "x", "automatic", 0.9), ("a", "y", "automatic", 0.8)])
    assert (two["precision"], two["auto_finals"]) == (1.0, 1)
    none = evaluated(spark, [("a", "x", True)], [("a", "x", None, 0.1)])
    assert (none["recall"], none["food_recall"], none["false_negatives"]) == (0.0, 0.0, 1)
    assert evaluated(spark, [("a", "x", False)], [])["precision"] == 0.0


def test_status_table(spark):
    rows = [(0.9, 0.9, True, False, False), (0.9, 0.9, False, True, False), (0.7, 0.70, False, False, True), (0.7, 0.55, False, False, True), (0.4, 0.9, False, False, False), (0.84, 0.1, False, False, False), (0.83, 0.9, False, False, False)]
    df = spark.createDataFrame(rows, "s double, m double, v boolean, c boolean, t boolean").coalesce(1)
    got = [r[0] for r in df.select(matching.status(F.col("s"), F.col("m"), F.col("v"), F.col("c"), F.col("t"))).collect()]
    assert got == [None, "review", "automatic", "review", None, "automatic", "review"]


LINKS = [("k", "left", "1", "review"), ("k", "right", "2", "review"), ("k", "right", "3", "review"), ("z", "left", "9", "automatic")]
DECISION = "left_code string, right_code string, decision string, justification string"


def test_a_review_row_stays_until_all_its_pairs_are_decided(spark):
    links = spark.createDataFrame(LINKS, "concept_id string, side string, code string, status string")
    once = matching.apply_decisions(links, spark.createDataFrame([("1", "3", "accepted", "same")], DECISION))
    assert {(r.side, r.code, r.status) for r in once.collect()} == {("left", "1", "review"), ("right", "2", "review"), ("left", "1", "adjudicated"), ("right", "3", "adjudicated"), ("left", "9", "automatic")}
    assert [tuple(r)[1:] for r in matching.review_pairs(once).collect()] == [("1", "2")]
    twice = matching.apply_decisions(once, spark.createDataFrame([("1", "2", "rejected", "")], DECISION))
    assert {(r.side, r.code, r.status) for r in twice.collect()} == {("left", "1", "adjudicated"), ("right", "3", "adjudicated"), ("left", "9", "automatic")}


@pytest.mark.parametrize("rows", [[("1", "8", "accepted", "x")], [("1", "2", "accepted", "x"), ("1", "2", "rejected", "")], [("1", "2", "perhaps", "")], [("1", "2", "accepted", " ")]])
def test_wrong_decisions_stop_the_review(spark, rows):
    links = spark.createDataFrame(LINKS, "concept_id string, side string, code string, status string")
    with pytest.raises(gates.ContractError):
        matching.apply_decisions(links, spark.createDataFrame(rows, DECISION))


def test_the_matcher_equals_plain_loops(spark):
    """Dictionary, blocking, signals, veto, status and one-to-one choice as a whole, on generated names."""
    import re
    from difflib import SequenceMatcher

    from provendar.functions.text import split_words

    rng = random.Random(4)
    words = ["ring", "cheese", "raw", "small", "green", "rare", "anneau", "blé", "x7", "de", "pain", "loaf"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    terms = [(1, "ring", "ring|cheese ring", "anneau", "ring"), (2, "cheese", "cheese", "fromage", "cheese"), (3, "raw", "raw", "raw", "raw"), (4, "green", "green", "green", "green"), (5, "bread", "pain|loaf", "pain", "loaf"), (6, "loop", "ring", "", "")]
    left = [(f"l{i}", f"g{i % 2}", name()) for i in range(14)]
    right = [(f"r{i}", f"g{i % 2}", rng.choice(["", name()]), name()) for i in range(14)]
    core = ("FAT", "WATER", "PROCNT")
    lv, rv = ([(f"{p}{i}", n, float(rng.choice([1, 1, 9]))) for i in range(14) for n in core] for p in "lr")
    index, explained = {x: {} for x in ("pt", "fr", "en")}, {x: set() for x in ("pt", "fr", "en")}
    for _, term, *cells in terms:
        for lang, cell in zip(("pt", "fr", "en"), cells, strict=True):
            for part in cell.split("|"):
                key = split_words(part)
                explained[lang] |= set(key)
                if len(key) > 1 or key and len(key[0]) > 1:
                    index[lang][" ".join(key)] = term

    def keys(text, lang):
        w, out, i = split_words(text), set(), 0
        while i < len(w):
            k = max((k for k in range(1, len(w) - i + 1) if " ".join(w[i : i + k]) in index[lang]), default=1)
            out |= {index[lang][" ".join(w[i : i + k])]} if " ".join(w[i : i + k]) in index[lang] else set()
            i += k
        return out

    df = {}
    for t in [n for *_, n in left] + [x for *_, fr, en in right for x in (fr, en)]:
        for w in split_words(t):
            df[w] = df.get(w, 0) + 1
    want = {}
    own = lambda text, lang: {w for w in split_words(text) if w not in explained[lang] and w not in K.STOP_WORDS and not re.search(r"\d", w)}
    for li, lg, lt in left:
        for ri, rg, fr, en in right:
            a, b = keys(lt, "pt"), keys(fr, "fr") | keys(en, "en")
            rare = {w for w in set(split_words(lt)) & set(split_words(fr) + split_words(en)) if df[w] <= K.RARE_TOKEN}
            if not (a & b - set(K.GENERIC_TERMS)) and not rare:
                continue
            sim = max(SequenceMatcher(None, " ".join(split_words(lt)), " ".join(split_words(x))).ratio() for x in (fr, en))
            score = 0.55 * (len(a & b) / len(a | b) if a | b else 0) + 0.25 * min(sim, 1) + 0.2 * (lg == rg)
            x, y = ({n: v for i, n, v in t if i == k} for t, k in ((lv, li), (rv, ri)))
            veto = sum(abs(x[n] - y[n]) / max(abs(x[n]), abs(y[n])) > 0.65 for n in core) >= 2
            p = (a - b - set(K.GENERIC_TERMS)) | own(lt, "pt")
            q = (b - a - (set(K.GENERIC_TERMS) - set(K.COLOR_TERMS))) | own(fr, "fr") | own(en, "en")
            n1, n2 = ({*re.findall(r"\d+(?:[.,]\d+)?", z)} for z in (lt, fr or en))
            conflict = bool(p and q) or bool(n1 and n2 and n1 != n2)
            single = len(a) == 1 and len(b) == 1 and bool(a & b)
            status = None if veto or score < 0.5 else "review" if conflict else ("automatic" if sim >= 0.65 else "review") if single else "automatic" if score >= 0.84 else "review"
            want[li, ri] = (round(score, 9), round(sim, 9), veto, conflict, status)
    dic = matching.dictionary(spark.createDataFrame(terms, "row int, term string, pt string, fr string, en string"), ("pt", "fr", "en"))
    v = "id string, nutrient_id string, value double"
    save = Scratch(spark).save
    got = save(matching.match_foods(spark.createDataFrame(left, "id string, food_group string, pt string"), spark.createDataFrame(right, "id string, food_group string, fr string, en string"), dic, spark.createDataFrame(lv, v), spark.createDataFrame(rv, v), {"pt": "pt"}, {"fr": "fr", "en": "en"}, save))
    assert {(r.left_id, r.right_id): (round(r.score, 9), round(r.similarity, 9), r.vetoed, r.conflict, r.status) for r in got.collect()} == want
    less = matching.match_foods(spark.createDataFrame(left, "id string, food_group string, pt string"), spark.createDataFrame(right, "id string, food_group string, fr string, en string"), dic, spark.createDataFrame(lv, v), spark.createDataFrame(rv, v), {"pt": "pt"}, {"fr": "fr", "en": "en"}, save, prune=True).collect()
    assert {(r.left_id, r.right_id): r.status for r in less} == {k: w[4] for k, w in want.items()}
    spared = sum(r.similarity is None for r in less)
    assert len(less) / 10 < spared < len(less) and all(want[r.left_id, r.right_id][0] < 0.5 for r in less if r.similarity is None), (spared, len(less))
    links: set = set()
    for (li, ri), w in sorted(want.items(), key=lambda x: (-x[1][0], -x[1][1], x[0])):
        if w[4] == "automatic" and not {li, ri} & {x for p in links for x in p}:
            links.add((li, ri))
    kept = spark.createDataFrame([("c", "left", "l99", "adjudicated"), ("c", "left", "l98", "review")], "concept_id string, side string, code string, status string")
    rows = matching.links(got, "a", "b", save, kept).collect()
    assert {r.code for r in rows if r.status == "automatic"} == {x for p in links for x in p}
    assert {r.code for r in rows if r.status == "review"} == {x for p, w in want.items() if w[4] == "review" for x in p}
    assert [(r.concept_id, r.code) for r in rows if r.status == "adjudicated"] == [("c", "l99")]
    for li, ri in links:
        assert len({r.concept_id for r in rows if r.status == "automatic" and r.code in (li, ri)}) == 1


def test_repeated_record_ids_have_one_winner(spark):
    """Ties on the record id go to a stated value, whatever the order of the rows."""
    rows = [("c", "FAT", "A", "r", v, "measured") for v in (3.0, 1.0, 2.0)]
    v = spark.createDataFrame(rows, "concept_id string, nutrient_id string, source_id string, source_record_id string, value double, value_type string").withColumn("basis", F.lit(K.PER_100G)).withColumn("unit", F.lit("g")).withColumn("derivation_id", F.lit(None).cast("string"))
    for n in (1, 3):
        df = v.repartition(n)
        assert quality.profile(df, ["FAT"]).first()["FAT"] == 3.0
        cells = df.withColumn("locale", F.lit("en")).withColumn("source_order", F.array(F.lit("A")))
        assert selection.preferred_values(cells).first()["value"] == 1.0
        assert [r.value for r in selection.alternatives(cells).orderBy("alternative").collect()] == [2.0, 3.0]
        dens = spark.createDataFrame([("g", 2.0)], "food_group string, density_g_per_ml double")
        got, _ = records.derive_volume(df, spark.createDataFrame([("c", "g")], "concept_id string, food_group string"), dens)
        assert [r.value for r in got.collect()] == [2.0]


def test_conflicts(spark):
    df = spark.createDataFrame([(["milk", "raw"], ["milk"], ["x"], [], "tipo 70", "T170"), (["milk", "goat"], ["milk", "cow"], [], [], "a 70", "b"), (["milk"], ["milk"], [], [], "1,5", "1,5")], "a array<string>, b array<string>, wa array<string>, wb array<string>, na string, nb string").coalesce(1)
    got = [tuple(r) for r in df.select(matching.distinctive_conflict(F.col("a"), F.col("b"), F.col("wa"), F.col("wb")), matching.numeric_conflict(F.col("na"), F.col("nb"))).collect()]
    assert got == [(False, True), (True, False), (False, False)]


def test_quality_checks(spark):
    rows = [("c1", n, v, "g") for n, v in (("WATER", 80.0), ("PROCNT", 10.0), ("FAT", 5.0), ("CHOAVL", 1.0), ("FIBTG", 0.0), ("ASH", 0.0), ("ALC", 0.0), ("FASAT", 6.0), ("SUGAR", 1.5), ("NACL", 1.0), ("NA", 0.3))]
    v = spark.createDataFrame([(*r, "A", "r", "measured", "per_100g_edible") for r in rows], "concept_id string, nutrient_id string, value double, unit string, source_id string, source_record_id string, value_type string, basis string")
    concepts = spark.createDataFrame([("c1", "veg")], "concept_id string, food_group string")
    units = v.select("nutrient_id", "unit").distinct()
    kcal = spark.createDataFrame([("c1", "A", 100.0)], "concept_id string, source_id string, kcal double")
    off = quality.suite(v, concepts, units, kcal)
    assert {r.check for r in off.collect()} == {"proximates", "fatty_acids", "sugars_total", "salt", "energy"}
    f = quality.findings(off).collect()
    assert [r.severity for r in f] == ["warning"] * 5 and all(r.n == 1 and r.examples == ["c1|A"] for r in f)


def test_search(spark, tmp_path):
    rows = [(1, "concept", "a", "en", "Skim milk"), (2, "concept", "b", "en", "Milk chocolate"), (3, "concept", "a", "pt", "Leite magro"), (4, "nutrient", "n", "en", "Milk fat"), (5, "concept", "c", "pt", "Polpa de açaí")]
    t = spark.createDataFrame(rows, "label_id long, ref_kind string, ref string, locale string, text string")
    from provendar.functions import scalar as S

    t = t.withColumn("text_normalized", S.fold(F.col("text")))
    index = search.write_index(t, f"file://{tmp_path}/index")
    ids = lambda *a, **k: [r.label_id for r in search.search(t, *a, **k, index=index).collect()]
    assert set(ids("milk", "en")) == {1, 2, 4} and set(ids("MIL choc", "en")) == {2}
    assert set(ids("milk", "pt-PT", kind="food")) == {1, 2}  # no Portuguese hit: English answers
    assert ids("acai", "pt") == [5] and ids("po aç", "pt-BR") == [5] and ids('"*', "en") == []
    assert ids("olpa", "pt") == [5] and ids("ol", "pt") == []
    with pytest.raises(search.SearchError):
        ids("x", "xx")
    with pytest.raises(search.SearchError):
        search.search(t, "milk", "en", limit=0)
    with pytest.raises(search.SearchError):
        search.chain_of("a", {"a": ["b"], "b": ["a"]})


def test_records(spark):
    mapping = spark.createDataFrame([("3", "x", "deep"), ("1", "p", "top")], "level string, code string, food_group string")
    df = spark.createDataFrame([("x", "q", "p"), ("n", "q", "p"), ("n", "q", "z")], "c3 string, c2 string, c1 string")
    assert {(r.c3, r.c1): r.food_group for r in records.level_fallback(df, mapping, ["c3", "c2", "c1"]).collect()} == {("x", "p"): "deep", ("n", "p"): "top", ("n", "z"): None}
    links = spark.createDataFrame([("b", "a", "automatic"), ("c", "a", "review")], "absorbed string, survivor string, status string")
    v = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "concept_id string, x int")
    assert sorted((r[0], r[1]) for r in records.reassign(v, links).collect()) == [("a", 1), ("a", 2), ("c", 3)]
    assert [tuple(r) for r in records.tombstones(links).collect()] == [("b", "a", "identity_link_f3")]


def test_diff_samples(spark):
    a = spark.createDataFrame([(i, 60.0) for i in range(30)], "k int, v double")
    b = spark.createDataFrame([(i, 62.0 if i < 25 else 60.0) for i in range(29)] + [(99, None)], "k int, v double")
    d = records.diff(a, b, ["k"], ["v"])
    n = {r.status: r["count"] for r in d.groupBy("status").count().collect()}
    assert n == {"changed": 25, "same": 4, "removed": 1, "added": 1}
    assert records.diff_samples(d, ["k"]).where("status = 'changed'").count() == 20


def test_label_gates(spark):
    rows = [("nutrient", "FAT", "en", "official", "Fat", 0), ("nutrient", "FAT", "pt", "mt_unreviewed", "Gordura", 0), ("nutrient", "ASH", "pt-PT", "curated", "Cinza", 0)]
    t = spark.createDataFrame(rows, "ref_kind string, ref string, locale string, status string, text string, branch int")
    tags = spark.createDataFrame([("FAT",), ("ASH",)], "tagname string")
    div = spark.createDataFrame([("ASH",)], "ref string")
    got = {tuple(r) for r in labels.gate_findings(t, tags, ["en", "pt"], div).collect()}
    assert got == {("unreviewed", "pt", "FAT"), ("missing", "en", "ASH"), ("share", "pt", None), ("divergent_variant", "pt-BR", "ASH")}


def test_energy_declared_as_zero_is_no_offender(spark):
    p = spark.createDataFrame([("a", "s", 10.0, 0.0, 0.0, 0.0, 0.0, None), ("b", "s", 10.0, 0.0, 0.0, 0.0, 0.0, None)], "concept_id string, source_id string, PROCNT double, FAT double, CHOAVL double, FIBTG double, ALC double, POLYL double")
    kcal = spark.createDataFrame([("a", "s", 0.0), ("b", "s", 20.0)], "concept_id string, source_id string, kcal double")
    assert [r.ref for r in quality.energy(p, kcal).collect()] == ["b|s"]
    assert quality.energy_skipped(p, kcal.where("concept_id = 'a'")).first()[0] == 1


def rows_scanned(df):
    """Rows that the scans of an executed plan gave out: what page statistics could not skip."""
    df._jdf.queryExecution().executedPlan()
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), {}
    todo = [plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total[node.relation().location().rootPaths().head().getName()] = node.metrics().apply("numOutputRows").value()
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return total


def test_a_lookup_reads_few_pages_of_the_postings(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = [(k, "concept", str(k), "en", " ".join(word() for _ in range(8))) for k in range(6000)]
    t = spark.createDataFrame(rows, "label_id long, ref_kind string, ref string, locale string, text string").withColumn("text_normalized", F.col("text")).repartition(4)
    index = search.write_index(t, f"file://{tmp_path}/index")
    some = rows[17][4].split()
    query = f"{some[0]} {some[3]}"
    want = sorted(r[0] for r in rows if some[0] in r[4] and some[3] in r[4])
    assert sorted(r.label_id for r in search.search(t, query, "en", index=index).collect()) == want
    read = rows_scanned(search.candidates(index, query.split(), ["en"]))
    assert 0 < read["label_trigram"] < index.grams.count() / 15, read
    scores = search.bm25(index, query.split())
    read = rows_scanned(scores)
    assert 0 < read["label_word"] < index.words.count() / 10, read
    starts = search.candidates(index, [some[0][:2], some[3][:2]], ["en"])
    assert {r.label_id for r in starts.collect()} == {r[0] for r in rows if all(any(w.startswith(p[:2]) for w in r[4].split()) for p in (some[0], some[3]))}


def test_search_finds_any_script(spark, tmp_path):
    texts = ["brânză și țuică", "Đà Nẵng", "ΆΛΦΑ ένα", "Ｆｕｌｌ width", "한국 빵"]
    rows = labels.union_branches([spark.createDataFrame([("concept", str(k), "en", "native", t) for k, t in enumerate(texts)], "ref_kind string, ref string, locale string, status string, text string")]).withColumn("label_id", F.col("ref").cast("long"))
    written = search.write_index(rows, f"file://{tmp_path}/index")
    for query, ref in (("țuică", "0"), ("tuica", "0"), ("branza", "0"), ("nang", "1"), ("αλφα", "2"), ("full", "3"), ("한국", "4")):
        for index in (None, written):
            assert [r.ref for r in search.matches(rows, query, index).collect()] == [ref], query


def test_gates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(gates.ContractError):
        gates.unique(df, ["k"], "t")
    with pytest.raises(gates.ContractError):
        gates.covered(df, df.where("k = 1"), ["k"], "t")
    gates.covered(df, df, ["k"], "t")
    assert {r.node for r in gates.cycles(spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "parent string, child string"), Scratch(spark).save).collect()} == {"a", "b"}


def test_ratio_is_that_of_the_library():
    from difflib import SequenceMatcher

    r = random.Random(5)
    for k in range(3000):
        letters = "ab" if k % 2 else "abcde 12"
        a, b = ("".join(r.choice(letters) for _ in range(r.randrange(230 if k % 50 == 0 else 20))) for _ in "ab")
        assert T.ratio(a, b) == SequenceMatcher(None, a, b).ratio(), (a, b)


def test_proposals_are_the_pairs_with_a_status(spark):
    """propose() against match_foods(): groups that are null, repeated core values, null names, pairs that only a rare word brings together."""
    r = random.Random(11)
    name = lambda: " ".join(r.choice(["maca", "pera", "crua", "verde", "sumo", f"n{r.randrange(9)}", "zzz"]) for _ in range(r.randrange(1, 4)))
    group = lambda: r.choice(["a", "b", None])
    left = [(f"l{k}", group(), name() if k % 9 else None) for k in range(60)]
    right = [(f"r{k}", group(), name(), name() if k % 2 else None) for k in range(60)]
    terms = [(k, w, w, w, w) for k, w in enumerate(("maca", "pera", "raw", "sumo"))] + [(9, "green", "verde", "verde", "verde"), (10, "raw", "crua", "crua", "crua")]
    values = lambda s: [(f"{s}{k}", n, r.choice([1.0, 5.0, None])) for k in range(60) for n in ("FAT", "WATER", "PROCNT", "FAT") if r.random() < 0.8]
    save = Scratch(spark).save
    dic = matching.dictionary(spark.createDataFrame(terms, "row int, term string, pt string, fr string, en string"), ("pt", "fr", "en"))
    v = "id string, nutrient_id string, value double"
    sides = spark.createDataFrame(left, "id string, food_group string, pt string"), spark.createDataFrame(right, "id string, food_group string, fr string, en string"), dic, spark.createDataFrame(values("l"), v), spark.createDataFrame(values("r"), v), {"pt": "pt"}, {"fr": "fr", "en": "en"}, save
    want = {tuple(x) for x in matching.match_foods(*sides).where("status is not null").select("left_id", "right_id", "similarity", "score", "conflict", "vetoed", "status").collect()}
    got = [tuple(x) for x in matching.propose(*sides).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_a_workbook_is_written_by_one_task_and_read_back(spark, tmp_path, monkeypatch):
    """Marks of XML in texts, absent cells, and rows that come to the driver neither at once nor one by one."""
    from provendar import queries
    from pyspark.sql import DataFrame

    names = ["a & b", "<x>", " two  spaces ", None, 'q"uote']
    rows = [(k, names[k % 5], k % 7) for k in range(400)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int").repartition(5).write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda *a, **b: pytest.fail("rows pass through the driver"))
    got = {tuple(r) for r in queries.queries()["workbook_source"](spark, str(tmp_path)).collect()}
    want = {("parts", k + 1, c, v) for k, n, s in rows for c, v in ((0, f"P{k}"), (1, n), (3, str(s) if s % 2 == 0 else None)) if v is not None}
    assert got == want


def test_findings_take_one_pass_and_sort_nothing(spark):
    """Counts and first refs against plain loops; a check may come with two severities, and refs may repeat."""
    r = random.Random(3)
    rows = [(r.choice("abc"), r.choice(["error", "warning"]), f"ö{r.randrange(300)}" if k % 3 else f"z{r.randrange(9)}", 1.0) for k in range(2000)]
    off = spark.createDataFrame(rows, "check string, severity string, ref string, metric double").repartition(7)
    found = quality.findings(off)
    first = {c: sorted((x[2] for x in rows if x[0] == c), key=str.encode)[: K.EXAMPLES] for c in "abc"}
    want = {(c, s, sum(x[:2] == (c, s) for x in rows), tuple(first[c])) for c in "abc" for s in ("error", "warning")}
    assert {(*x[:3], tuple(x[3])) for x in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1


def test_small_groups_are_left_out_before_their_values_move(spark):
    r = random.Random(8)
    rows = [(f"c{k}", n, 90.0 if k == 0 else r.choice([1.0, 1.1, 1.2]), "s", f"r{i}") for k in range(200) for n in ("FAT", "WATER") for i in range(1 + (k < 40))]
    values = spark.createDataFrame(rows, "concept_id string, nutrient_id string, value double, source_id string, source_record_id string")
    groups = spark.createDataFrame([(f"c{k}", "big" if k < 80 else f"g{k}") for k in range(200)], "concept_id string, food_group string")
    saved = []

    def save(df):
        saved.append(Scratch(spark).save(df))
        return saved[-1]

    get = lambda df: sorted((x.ref, round(x.metric, 9)) for x in df.collect())
    assert (got := get(quality.outliers(values, groups, save))) == get(quality.outliers(values, groups)) and got
    assert saved[0].count() == 1  # one group may reach the least size
