"""Search over labels: substring and prefix matching with locale fallback, ranked.

The index of a label table is written once: postings of trigrams and of words, range-sorted by (gram or word, locale, run of labels)
in small pages, so that a lookup reads the pages that hold its terms and skips all others by their least and greatest entry.
One pass over the labels gives the runs (see runs.py).
Beside them lie the number of labels per gram, the length of its label with each word posting, and a row of totals per
locale. A lookup reads the counts of its grams, then the postings of the rarest ones, and verifies the texts of
those labels; scores need the postings of the query's words alone. Without an index, all labels are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import scalar as S
from ..functions.text import fold_exact
from ..plans.store import drop, tidy
from .runs import GRAM, TOTAL, WORD, Runs, unpack, unpack_words

TRIGRAM = 3
BM25_K1, BM25_B = 1.2, 0.75
#: Rows of a page and bytes of a row group of the postings: what a lookup skips or reads whole.
PAGE_ROWS, GROUP_BYTES = 1000, 1 << 20
#: Of a query's grams, the postings of so many are read; the texts of their labels decide.
RAREST = 3


class SearchError(ValueError):
    pass


def terms_of(query: str) -> list[str]:
    """Folded terms without quotes and asterisks."""
    return [t for t in fold_exact(query.replace('"', " ").replace("*", " ")).split() if t]


def chain_of(locale: str, chains: dict[str, list[str]] | None = None) -> list[str]:
    """The locale and its fallbacks; unknown locales and hops, and direct cycles, are errors."""
    chains = K.CHAINS if chains is None else chains
    if locale not in chains:
        raise SearchError(f"unknown locale {locale!r}")
    for hop in chains[locale]:
        if hop not in chains:
            raise SearchError(f"unknown fallback {hop!r} of {locale!r}")
        if locale in chains[hop] or hop == locale:
            raise SearchError(f"{locale!r} and {hop!r} fall back on each other")
    return [locale, *chains[locale]]


def chain_table(spark, locales: list[str], chains: dict[str, list[str]] | None = None) -> DataFrame:
    rows = [(x, hop, k) for x in locales for k, hop in enumerate(chain_of(x, chains))]
    return spark.createDataFrame(rows, "locale string, hop string, pos int")


def trigram_index(labels: DataFrame) -> DataFrame:
    """(label_id, locale, gram) over both text columns; grams are compared in lower case."""
    grams = [F.regexp_extract_all(t, F.lit("(?s)(?=(.{3}))"), 1) for t in (F.lower("text"), F.col("text_normalized"))]
    return labels.select("label_id", "locale", F.explode(F.array_union(*grams)).alias("gram"))


def word_index(labels: DataFrame) -> DataFrame:
    """(label_id, locale, word, tf): folded words with their counts."""
    out = labels.select("label_id", "locale", F.explode(S.words_of(F.col("text_normalized"))).alias("word"))
    return out.groupBy("label_id", "locale", "word").agg(F.count("*").alias("tf"))


def postings(labels: DataFrame) -> DataFrame:
    """(word, locale, label_id, tf, len): folded words with their counts and their label's number of words."""
    ws = labels.select("label_id", "locale", S.words_of(F.col("text_normalized")).alias("_w"))
    out = ws.select("label_id", "locale", F.size("_w").cast("long").alias("len"), F.explode("_w").alias("word"))
    return out.groupBy("word", "locale", "label_id", "len").agg(F.count("*").alias("tf")).select("word", "locale", "label_id", "tf", "len")


@dataclass
class Index:
    """The written index: grams (gram, locale, label_id), counts (gram, locale, df), words (word, locale, label_id, tf, len), totals (locale, n, avg_len)."""

    grams: DataFrame | None
    counts: DataFrame | None
    words: DataFrame
    totals: DataFrame


INDEX_TABLES = {"label_trigram": "grams", "label_trigram_count": "counts", "label_word": "words", "label_totals": "totals"}


RUNS = "kind int, term string, locale string, first long, n long, total long, wide int, packed binary"


def _put_runs(labels: DataFrame, path: str, grams: bool) -> None:
    """Writes the runs of all labels, by kind: of each gram or word the labels of a locale in one stretch of the table, and the stretch's totals.

    Labels are read once, here. Grams are those of trigram_index, words those of postings.
    """
    if labels.schema["label_id"].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise SearchError("label_id must be a whole number")
    runs = Runs(S.separators(labels.sparkSession), grams)
    lower = F.lower("text") if grams else F.lit(None).cast("string")  # null where it says no more than the folded text; without a text there are no grams
    some = labels.select(F.col("label_id").cast("long"), "locale", F.when(~lower.eqNullSafe(F.col("text_normalized")), lower).alias("lower"), F.col("text_normalized").alias("norm"), F.col("text").isNotNull().alias("any"))
    some.mapInArrow(runs, RUNS).write.mode("overwrite").option("compression", "zstd").partitionBy("kind").parquet(path)


def write_index(labels: DataFrame, folder: str, grams: bool = True) -> Index:
    """Writes the four tables of an index under folder. What is sorted and moved is runs, not postings; they become rows as they are written.

    grams=False leaves out grams and their counts, which no search for starts of words (terms of one or two characters) reads.
    """
    spark = labels.sparkSession
    place, own = f"{folder}/_label_runs", labels.schema["label_id"].dataType
    _put_runs(labels, place, grams)
    runs = spark.read.schema(RUNS).parquet(place)
    kind = lambda k: runs.where(F.col("kind") == k)

    def placed(df: DataFrame, *order: str) -> DataFrame:
        return df.repartitionByRange(*order).sortWithinPartitions(*order)

    def postings_of(k: int, unpack, schema: str) -> DataFrame:
        some = placed(kind(k).select("term", "locale", "first", "n", "wide", "packed"), "term", "locale", "first")
        return some.mapInArrow(unpack, "term string, locale string, " + schema)

    def put(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.block.size", GROUP_BYTES).parquet(f"{folder}/{name}")

    with tidy(spark):
        if grams:
            lists = postings_of(GRAM, unpack, "ids array<long>").select(F.col("term").alias("gram"), "locale", F.explode("ids").alias("label_id"))
            put("label_trigram", lists.withColumn("label_id", F.col("label_id").cast(own)))
            counts = kind(GRAM).groupBy(F.col("term").alias("gram"), "locale").agg(F.sum("n").alias("df"))
            put("label_trigram_count", placed(counts, "gram", "locale"))
        words = postings_of(WORD, unpack_words, "id long, tf long, len long")
        put("label_word", words.select(F.col("term").alias("word"), "locale", F.col("id").cast(own).alias("label_id"), "tf", "len"))
        totals = kind(TOTAL).groupBy("locale").agg(F.sum("n").alias("n"), (F.sum("total").cast("double") / F.sum("n")).alias("avg_len"))
        put("label_totals", placed(totals, "locale"))
    drop(spark, place)
    return open_index(spark, folder, grams)


def open_index(spark: SparkSession, folder: str, grams: bool = True) -> Index:
    return Index(**{field: spark.read.parquet(f"{folder}/{name}") if grams or field in ("words", "totals") else None for name, field in INDEX_TABLES.items()})


def candidates(index: Index, terms: list[str], locales: list[str]) -> DataFrame | None:
    """(label_id, n): labels that may hold every term, n is above 0. None: a gram occurs nowhere. One small job asks for the counts of the query's grams."""
    here = F.col("locale").isin(*locales)
    if all(len(t) >= TRIGRAM for t in terms):
        if index.grams is None:
            raise SearchError("the index was written without grams")
        wanted = sorted({t[i : i + TRIGRAM] for t in terms for i in range(len(t) - TRIGRAM + 1)})
        df = {r["gram"]: r["df"] for r in index.counts.where(F.col("gram").isin(*wanted) & here).groupBy("gram").agg(F.sum("df").alias("df")).collect()}
        if len(df) < len(wanted):
            return None
        rare = sorted(wanted, key=lambda g: (df[g], g))[:RAREST]
        # a term may lie in either text column, but then each of its grams lies in one of them too
        hits = index.grams.where(F.col("gram").isin(*rare) & here).groupBy("label_id").agg(F.count("*").alias("n"))
        return hits.where(F.col("n") == len(rare))
    out = None
    for t in terms:
        part = index.words.where(F.col("word").startswith(t) & here).select("label_id")
        out = part.groupBy("label_id").agg(F.count("*").alias("n")) if out is None else out.join(part, "label_id", "left_semi")
    return out


def matches(labels: DataFrame, query: str, index: Index | None = None, locales: list[str] | None = None) -> DataFrame:
    """Labels that hold every term: as substrings if all terms have three characters or more, else each as the start of a word."""
    terms = terms_of(query)
    if not terms:
        return labels.where(F.lit(False))
    if index is not None:
        chain = locales or [r["locale"] for r in index.totals.select("locale").collect()]
        found = candidates(index, terms, chain)
        if found is None:
            return labels.where(F.lit(False))
        # The first join goes below what makes up the labels' texts. The second brings n, which keeps the tests of texts above it: they would be
        # pushed below a semi join and be made on all labels.
        found = found.withColumnRenamed("n", "_n")
        labels = labels.join(found, "label_id", "left_semi").join(found, "label_id")
    sure = (lambda c: c) if index is None else (lambda c: F.when(F.col("_n") > 0, c))
    if all(len(t) >= TRIGRAM for t in terms):
        for t in terms:
            labels = labels.where(sure(F.lower("text").contains(t) | F.col("text_normalized").contains(t)))
        return labels.drop("_n")
    for t in terms:
        labels = labels.where(sure(F.exists(S.words_of(F.col("text_normalized")), _starts(t))))
    return labels.drop("_n")


def _starts(term: str):
    return lambda word: word.startswith(term)


def bm25(index: Index, terms: list[str]) -> DataFrame:
    """(label_id, score) of whole-word matches, with per-locale statistics. Reads the postings of the terms alone."""
    hit = index.words.where(F.col("word").isin(*terms))
    df = hit.groupBy("locale", "word").agg(F.count("*").alias("df"))
    both = hit.join(F.broadcast(df), ["locale", "word"]).join(F.broadcast(index.totals), "locale")  # a row per locale and term, or per locale
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = idf * F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("len") / F.col("avg_len")))
    return both.groupBy("label_id").agg(F.sum(part).alias("score"))


def _first_locale(found: DataFrame, chain: list[str]) -> DataFrame:
    """The rows of the first locale that has any. A small job per locale before the last looks for its first row; rows of later locales are not looked at."""
    for locale in chain[:-1]:
        here = found.where(F.col("locale") == locale)
        if not here.isEmpty():
            return here
    return found.where(F.col("locale") == chain[-1])


def search(labels: DataFrame, query: str, locale: str, limit: int = 20, kind: str | None = None, groups: DataFrame | None = None, food_group: str | None = None, index: Index | None = None, chains: dict[str, list[str]] | None = None) -> DataFrame:
    """The best labels in the first locale of the chain that has any hit: label_id, kind, ref, locale, text, score.

    labels: label_id, ref_kind, ref, locale, text, text_normalized. food_group keeps concepts of that group (groups: concept_id, food_group).
    """
    if not 1 <= limit <= 100:
        raise SearchError("limit must be from 1 to 100")
    if kind not in (None, "food", "nutrient"):
        raise SearchError("kind must be food or nutrient")
    chain = chain_of(locale, chains)
    hop = F.array_position(F.array(*map(F.lit, chain)), F.col("locale")).cast("int")
    some = labels.where(F.col("locale").isin(*chain))
    if kind:
        some = some.where(F.col("ref_kind") == ("concept" if kind == "food" else "nutrient"))
    if food_group is not None and groups is not None:
        some = some.join(groups.where(F.col("food_group") == food_group).select(F.col("concept_id").alias("ref")), "ref", "left_semi")
    found = matches(some, query, index, chain)
    if index is not None:
        found = _first_locale(found, chain)
    else:
        found = found.withColumn("hop", hop)
        found = found.join(F.broadcast(found.agg(F.min("hop").alias("hop"))), "hop", "left_semi")
    if index is not None and terms_of(query):
        found = found.join(bm25(index, terms_of(query)), "label_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    else:
        found = found.withColumn("score", F.lit(0.0))
    best = found.withColumn("_r", F.row_number().over(Window.partitionBy("ref_kind", "ref").orderBy(F.desc("score"), "label_id"))).where("_r = 1")
    return best.orderBy(F.desc("score"), "label_id").limit(limit).select("label_id", "ref_kind", "ref", "locale", "text", "score")


def display_labels(refs: DataFrame, labels: DataFrame, locale: str, chains: dict[str, list[str]] | None = None) -> DataFrame:
    """refs with the label of the first locale of the chain that has one."""
    chain = chain_of(locale, chains)
    hop = F.array_position(F.array(*map(F.lit, chain)), F.col("locale"))
    named = labels.where(F.col("locale").isin(*chain)).groupBy("ref_kind", "ref").agg(F.min_by("text", F.struct(hop, F.col("text"))).alias("display"))
    return refs.join(named, ["ref_kind", "ref"], "left")
