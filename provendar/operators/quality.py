"""The quality suite: every check is a DataFrame of offenders; findings count them and show the first few.

Checks over several nutrients start from one pivot of measured values per (concept, source) with the nutrient list
fixed in advance, so one shuffle serves them all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import scalar as S
from . import gates

OFFENDER = ["check", "severity", "ref", "metric"]


def measured(values: DataFrame) -> DataFrame:
    return values.where((F.col("value_type") == "measured") & F.col("value").isNotNull() & (F.col("basis") == K.PER_100G))


def profile(values: DataFrame, nutrients: list[str], keys: tuple[str, ...] = ("concept_id", "source_id"), in_grams: bool = True) -> DataFrame:
    """One row per key with a column per nutrient; of several values that with the greatest record id, then the greatest value.

    Where all values of a cell agree (nearly always there is one), the record ids need no look: the greatest and the least value
    of each nutrient are numbers, which one hash aggregation per key holds, summed up before the shuffle. Only keys with a cell whose
    values differ are gone through by record id. A value that is no number counts as none.
    """
    v = S.in_grams(F.col("value"), F.col("unit")) if in_grams else F.col("value")
    cells = values.where(F.col("nutrient_id").isin(*nutrients)).select(*keys, "nutrient_id", "source_record_id", F.coalesce(v.cast("double"), F.lit(float("nan"))).alias("_v"))
    each = lambda f, n: f(F.when(F.col("nutrient_id") == n, F.col("_v")))
    wide = cells.groupBy(*keys).agg(*[each(F.max, n).alias(f"_h{k}") for k, n in enumerate(nutrients)], *[each(F.min, n).alias(f"_l{k}") for k, n in enumerate(nutrients)])
    agree = reduce(lambda a, b: a & b, [F.col(f"_h{k}").eqNullSafe(F.col(f"_l{k}")) for k in range(len(nutrients))])
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    # joined by the first key alone, the others compared beside it: cells placed by that key stay where they are; a null there goes through by record id
    first, *others = keys
    plain = wide.where(agree & F.col(first).isNotNull()).select(*keys, *[number(f"_h{k}").alias(n) for k, n in enumerate(nutrients)])
    odd = wide.where(~agree).select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    beside = lambda a, b: F.coalesce(F.array_contains(F.array(b), a), a.isNull() & b.isNull())
    on = reduce(lambda a, b: a & b, [beside(F.col(c), F.col(f"_k_{c}")) for c in others], F.col(first) == F.col(f"_k_{first}"))
    some = cells.join(odd.hint("shuffle_hash"), on, "left_semi").unionAll(cells.where(F.col(first).isNull()))
    won = some.groupBy(*keys, "nutrient_id").agg(F.max(F.struct("source_record_id", F.when(~F.isnan("_v"), F.col("_v")).alias("v"))).alias("_w"))
    rest = won.groupBy(*keys).agg(*[F.max(F.when(F.col("nutrient_id") == n, F.col("_w.v"))).alias(n) for n in nutrients])
    return plain.unionAll(rest)


def _ref(keys=("concept_id", "source_id")) -> Column:
    return F.concat_ws("|", *keys)


def _offenders(df: DataFrame, check: str, severity: str, condition: Column, metric: Column, ref: Column | None = None) -> DataFrame:
    rows = df.withColumn("_m", metric).where(F.coalesce(condition, F.lit(False)))
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), (_ref() if ref is None else ref).alias("ref"), F.col("_m").cast("double").alias("metric"))


def _sum(names, all_needed: bool) -> Column:
    return reduce(lambda a, b: a + b, [F.col(n) if all_needed else F.coalesce(n, F.lit(0.0)) for n in names])


def _spec(check: str, severity: str, condition: Column, metric: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), metric.cast("double").alias("metric"), F.coalesce(condition, F.lit(False)).alias("hit"))


def offenders_of(p: DataFrame, specs: list[Column]) -> DataFrame:
    """Offenders of several checks over one profile, in one pass over it."""
    hits = F.filter(F.array(*specs), lambda x: x["hit"])
    return p.select(_ref().alias("ref"), F.explode(hits).alias("x")).select("x.check", "x.severity", "ref", "x.metric")


def proximates_spec() -> list[Column]:
    total = _sum(K.PROXIMATES, True)
    return [_spec("proximates", "warning", ~total.between(*K.PROXIMATES_RANGE), total)]


def proximates(p: DataFrame) -> DataFrame:
    return offenders_of(p, proximates_spec())


def energy(p: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """declared: concept_id, source_id, kcal for rows with the registered method; None: the profile holds kcal itself.

    Tables join by concept, and the source (there are few) is compared beside it: both stay where their concept has put them.
    """
    terms = [F.coalesce(F.col(n), F.lit(0.0)) * f if n in K.ENERGY_OPTIONAL else F.col(n) * f for n, f in K.ENERGY.items() if n in p.columns or n not in K.ENERGY_OPTIONAL]
    expected = reduce(lambda a, b: a + b, terms)
    if declared is not None:
        told = declared.select(F.col("concept_id").alias("_c"), F.array("source_id").alias("_s"), "kcal")
        p = p.join(told, (F.col("concept_id") == F.col("_c")) & F.array_contains("_s", F.col("source_id"))).drop("_c", "_s")
    both = p.withColumn("_e", expected)
    off = F.abs(F.col("kcal") - F.col("_e"))
    rel = F.coalesce(F.try_divide(off, F.abs("kcal")), F.lit(0.0))  # a declared zero is not held against anything
    return _offenders(both, "energy", "warning", (off > K.ENERGY_FLOOR) & (rel > K.ENERGY_TOLERANCE), off)


def energy_skipped(p: DataFrame, declared: DataFrame) -> DataFrame:
    """One row: how many profiles the energy check leaves out, for lack of a value by the registered method."""
    return p.join(declared, ["concept_id", "source_id"], "left_anti").agg(F.count("*").alias("n_skipped"))


def _present(p: DataFrame, names) -> list[str]:
    return [n for n in names if n in p.columns]


def fatty_acids_spec(p: DataFrame) -> list[Column]:
    total = _sum(_present(p, K.FATTY_ACIDS), False)
    return [_spec("fatty_acids", "warning", F.col("FAT").isNotNull() & (total > F.col("FAT") * K.SUM_TOLERANCE), total)]


def sugars_spec(p: DataFrame) -> list[Column]:
    total = _sum(_present(p, K.SUGARS), False)
    one = _spec("sugars_parts", "warning", F.col("SUGAR").isNotNull() & (total > F.col("SUGAR") * K.SUM_TOLERANCE), total)
    return [one, _spec("sugars_total", "warning", F.col("SUGAR") > F.col("CHOAVL") * K.SUM_TOLERANCE, F.col("SUGAR"))]


def amino_acids_spec() -> list[Column]:
    ratio = F.coalesce(F.try_divide(_sum(K.AMINO_ACIDS, True), F.col("PROCNT")), F.when(F.col("PROCNT") == 0, 0.0))
    return [_spec("amino_acids", "warning", ~ratio.between(*K.AMINO_RANGE), ratio)]


def salt_spec() -> list[Column]:
    expected = F.col("NA") * K.SALT_FACTOR
    rel = F.when(expected == 0, 0.0).otherwise(F.try_divide(F.abs(F.col("NACL") - expected), expected))
    return [_spec("salt", "warning", rel > K.SALT_TOLERANCE, rel)]


def retinol_spec() -> list[Column]:
    return [_spec("vitamin_a", "warning", F.col("VITA_RAE") < F.col("RETOL") * K.RETINOL_SHARE, F.col("VITA_RAE"))]


def ratio_specs(p: DataFrame) -> list[Column]:
    """The checks of sums and ratios; nutrients of a sum that the profile has no column for count as absent."""
    return [*fatty_acids_spec(p), *sugars_spec(p), *salt_spec(), *retinol_spec()]


def fatty_acids(p: DataFrame) -> DataFrame:
    return offenders_of(p, fatty_acids_spec(p))


def sugars(p: DataFrame) -> DataFrame:
    return offenders_of(p, sugars_spec(p))


def amino_acids(p: DataFrame) -> DataFrame:
    return offenders_of(p, amino_acids_spec())


def salt(p: DataFrame) -> DataFrame:
    return offenders_of(p, salt_spec())


def retinol(p: DataFrame) -> DataFrame:
    return offenders_of(p, retinol_spec())


def domain(values: DataFrame, units: DataFrame) -> DataFrame:
    """Negative values, over 100 g in 100 g, and units other than the vocabulary's (nutrient_id, unit)."""
    ref = _ref(("concept_id", "nutrient_id", "source_id"))
    neg = _offenders(values, "negative", "error", F.col("value") < 0, F.col("value"), ref)
    big = _offenders(values, "over_100g", "error", F.col("nutrient_id").isin(*K.GRAM_NUTRIENTS) & (F.col("unit") == "g") & (F.col("value") > 100), F.col("value"), ref)
    named = values.join(F.broadcast(units.select("nutrient_id", F.col("unit").alias("_u"))), "nutrient_id", "left")
    unit = _offenders(named, "unit", "error", F.col("unit") != F.coalesce("_u", F.lit("__unknown__")), F.col("value"), ref)
    return neg.unionAll(big).unionAll(unit)


def z_scores(values: DataFrame, keys: tuple[str, ...] = ("nutrient_id", "food_group"), save=None) -> DataFrame:
    """values with n, mean, sd and z within their group; groups under 10 values or without spread are left out.

    Group statistics are partial aggregates joined back, so a large group is never gathered in one task. save writes them first:
    then they are counted, and where they are few the values stay where they are.
    """
    stats = values.groupBy(*keys).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    stats = stats.where((F.col("n") >= K.Z_MIN_N) & (F.col("sd") > 0))
    if save:
        stats = gates.lookup(save(stats))
    return values.join(stats, list(keys)).withColumn("z", (F.col("value") - F.col("mean")) / F.col("sd"))


def outliers(values: DataFrame, concepts: DataFrame, save=None) -> DataFrame:
    """Offenders by z-score within (nutrient, food group) of the concepts (concept_id, food_group).

    A group has at most as many values of a nutrient as its concepts have of their most frequent one: where these sums, by a hash of the
    group, stay below the least size, no group counts and its values go nowhere. With save, this is looked at first.
    """
    named = values.join(concepts.select("concept_id", "food_group").hint("shuffle_hash"), "concept_id")
    if save:
        most = named.groupBy("concept_id", "food_group", "nutrient_id").agg(F.count("value").alias("_n")).groupBy("concept_id", "food_group").agg(F.max("_n").alias("_n"))
        large = most.select(F.xxhash64("food_group").alias("_h"), "_n").groupBy("_h").agg(F.sum("_n").alias("_n")).where(F.col("_n") >= K.Z_MIN_N).select("_h")
        named = named.withColumn("_h", F.xxhash64("food_group")).join(gates.lookup(save(large)), "_h", "left_semi").drop("_h")
    z = z_scores(named, save=save)
    return _offenders(z, "z_score", "warning", F.abs("z") > K.Z_LIMIT, F.col("z"), _ref(("concept_id", "nutrient_id", "source_id")))


def source_pairs(values: DataFrame) -> DataFrame:
    """Positive values of the same concept and nutrient in two sources (one value per source: that with the smallest record id, then the smallest value) with their relative difference."""
    # most concepts may have one source: they have no pairs, and a hash aggregation tells them by two hashes of the source
    h = F.struct(F.xxhash64("source_id").alias("x"), F.hash("source_id").alias("y"))
    several = values.groupBy("concept_id").agg(*[f(h[c]).alias(f"_{n}{c}") for n, f in (("l", F.min), ("h", F.max)) for c in "xy"]).where("_lx <> _hx or _ly <> _hy").select("concept_id")
    values = values.join(several.hint("shuffle_hash"), "concept_id", "left_semi")
    one = values.where("value > 0").groupBy("concept_id", "nutrient_id", "source_id").agg(F.min(F.struct("source_record_id", "value")).alias("_w")).withColumn("value", F.col("_w.value")).drop("_w")
    # a cell's sources are few: each meets those before it, in one pass in their order
    before = Window.partitionBy("concept_id", "nutrient_id").orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    met = one.withColumn("_b", F.collect_list(F.struct("source_id", "value")).over(before)).where(F.size("_b") > 0)
    met = met.select("concept_id", "nutrient_id", F.explode("_b").alias("_a"), F.col("source_id").alias("source_b"), F.col("value").alias("value_b"))
    both = met.select("concept_id", "nutrient_id", F.col("_a.source_id").alias("source_a"), F.col("_a.value").alias("value_a"), "source_b", "value_b").where("source_a is not null and concept_id is not null and nutrient_id is not null")
    return both.withColumn("divergence", S.relative_difference(F.col("value_a"), F.col("value_b")))


def cross_source(values: DataFrame) -> DataFrame:
    p = source_pairs(values)
    return _offenders(p, "cross_source", "info", F.col("divergence") >= K.DIVERGENCE, F.col("divergence"), _ref(("concept_id", "nutrient_id", "source_a", "source_b")))


def findings(offenders: DataFrame, examples: int = K.EXAMPLES) -> DataFrame:
    """check, severity, n, and the first examples by ref; errors first.

    One pass over the offenders, of which nothing is sorted or moved: each task counts its own and keeps the first refs of each check.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[tuple[str, str]] = Counter()
        first: dict[str, list[str]] = {}
        for b in batches:
            t = pa.Table.from_batches([b])
            for r in t.group_by(["check", "severity"]).aggregate([([], "count_all")]).to_pylist():
                n[r["check"], r["severity"]] += r["count_all"]
            for check in t["check"].unique().to_pylist():
                refs = t["ref"].filter(pc.equal(t["check"], check))
                if len(kept := first.setdefault(check, [])) == examples:
                    refs = refs.filter(pc.less(refs, kept[-1]))
                least = refs.take(pc.select_k_unstable(refs, examples, [("", "ascending")])) if len(refs) else refs
                first[check] = sorted(kept + least.to_pylist(), key=str.encode)[:examples]
        rows = [(check, severity, k, first.pop(check, [])) for (check, severity), k in n.items()]  # refs stand in one row of a check
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["check", "severity", "n", "refs"])

    part = offenders.select("check", "severity", "ref").mapInArrow(tally, "check string, severity string, n long, refs array<string>")
    done = part.groupBy("check").agg(F.slice(F.array_sort(F.flatten(F.collect_list("refs"))), 1, examples).alias("examples"), F.collect_list(F.struct("severity", "n")).alias("_n"))
    out = done.select("check", "examples", F.explode("_n").alias("_x")).groupBy("check", "_x.severity").agg(F.sum("_x.n").alias("n"), F.first("examples").alias("examples"))
    rank = S.lookup(K.SEVERITY_RANK, F.col("severity"), 9)
    return out.orderBy(rank, "check").select("check", "severity", "n", "examples")


def severity_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n"))


def suite(values: DataFrame, concepts: DataFrame, units: DataFrame, declared_energy: DataFrame, save=None) -> DataFrame:
    """Offenders of every check over measured values. save writes the groups' statistics."""
    m = measured(values)
    names = sorted({*K.PROXIMATES, *K.ENERGY, *K.FATTY_ACIDS, *K.SUGARS, *K.AMINO_ACIDS, "SUGAR", "CHOAVL", "NACL", "NA", "VITA_RAE", "RETOL", "FAT", "PROCNT"})
    p = profile(m, names)
    parts = [offenders_of(p, [*proximates_spec(), *ratio_specs(p), *amino_acids_spec()]), energy(p, declared_energy), domain(m, units), outliers(m, concepts, save), cross_source(m)]
    return reduce(lambda a, b: a.unionByName(b), parts)
