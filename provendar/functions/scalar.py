"""Column functions that stay in the JVM: typed cells, keys, ids, units and comparisons."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import fixed as K

def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def lookup(pairs: dict, key: Column, default=None) -> Column:
    """pairs[key], or default."""
    return F.coalesce(F.try_element_at(literal_map(pairs), key), F.lit(default))


# ---- typed cells


def decimal(text: Column) -> Column:
    """A number written with a decimal comma or point."""
    return F.replace(text, F.lit(","), F.lit(".")).cast("double")


def parse_cell(raw: Column, where: Column | None = None) -> Column:
    """struct(value, kind): number, missing (-), trace (traces), below_loq (< n, value is the threshold); anything else fails the query."""
    fail = F.raise_error(F.concat_ws("", where if where is not None else F.lit("cell"), F.lit(": unexpected cell "), raw))
    kind = F.when(raw.rlike(K.NUMBER), "number").when(raw == "-", "missing").when(raw == "traces", "trace").when(raw.rlike(K.BELOW), "below_loq").when(raw.isNull(), F.lit(None)).otherwise(fail.cast("string"))
    value = F.when(raw.rlike(K.NUMBER), decimal(raw)).when(raw.rlike(K.BELOW), decimal(F.regexp_extract(raw, K.BELOW, 1)))
    return F.struct(value.alias("value"), kind.alias("kind"))


def parse_bound(raw: Column) -> Column:
    """A min or max cell: a number or null; anything else fails the query."""
    return F.when(raw.isNull() | (raw == ""), F.lit(None).cast("double")).when(raw.rlike(K.NUMBER), decimal(raw)).otherwise(F.raise_error(F.concat(F.lit("unexpected bound "), raw)).cast("double"))


def native_number(raw: Column) -> Column:
    """A workbook's own number or an empty cell; anything else fails the query."""
    return F.when(raw.isNull() | (F.trim(raw) == ""), F.lit(None).cast("double")).when(raw.rlike(K.NATIVE_NUMBER), raw.cast("double")).otherwise(F.raise_error(F.concat(F.lit("not a number: "), raw)).cast("double"))


def unit_of(name: Column, pattern: str = K.UNIT_IN_NAME) -> Column:
    """The canonical unit written in a name, or null."""
    got = F.regexp_extract(name, pattern, 1)
    return F.when(got != "", lookup(K.UNIT_KEYS, got))


# ---- text


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fold(text: Column) -> Column:
    """Ligatures spelt out, compatibility forms, accents and case folded, by a table of single characters.

    Exact for all texts but those with characters that become several (Hangul, fractions, ...): functions.text.normalize_label
    folds these too.
    """
    from .text import fold_table

    spelt = text
    for a, b in K.LIGATURES.items():
        spelt = F.replace(spelt, F.lit(a), F.lit(b))
    single, to, gone = fold_table()
    # most texts are ASCII, where folding is lower case, which is some times faster than the table
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(spelt, single + gone, to))


def ascii_key(text: Column) -> Column:
    """A stable key: folded, Greek alpha and beta spelt a and b, all else underscores."""
    folded = fold(F.translate(text, "αβ", "ab"))
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def nutrient_key(header: Column, strict: bool = True) -> Column:
    """Key of a measured column: name and canonical unit; the one known spelling variant is mapped. Without a unit the query fails, or the key is null if not strict."""
    unit = unit_of(header, K.UNIT_IN_HEADER)
    key = F.concat_ws("_", ascii_key(F.regexp_replace(header, K.UNIT_IN_HEADER + ".*$", "")), unit)
    key = lookup_or_self(K.KEY_ALIASES, key)
    missing = F.raise_error(F.concat(F.lit("no unit in "), header)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(unit.isNull(), missing).otherwise(key)


def lookup_or_self(pairs: dict, key: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(pairs), key), key)


def words_of(text: Column) -> Column:
    """Folded words: everything but letters and digits separates."""
    return F.filter(F.split(F.regexp_replace(fold(text), r"[^\p{L}\p{N}]+", " "), " "), lambda x: x != "")


def separators(spark: SparkSession) -> bytes:
    """A bit per character, as the JVM's classes have it: whether it separates words."""
    every = "".join(chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000)
    said = spark.createDataFrame([(every,)], "s string").select(F.regexp_replace("s", r"[^\p{L}\p{N}]", " ")).collect()[0][0]
    said = said[:0xD800] + " " * 0x800 + said[0xD800:]
    return np.packbits(np.frombuffer(said.encode("utf-32-le"), np.uint32) == 32).tobytes()


def numbers_of(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(fold(text), F.lit(r"(\d+(?:[.,]\d+)?)"), 1)))


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def classify_method(text: Column) -> Column:
    """The first keyword of the method list found in the text decides; null if none is."""
    up = F.upper(text)
    out = F.when(up.contains(K.METHODS[0][0]), K.METHODS[0][1])
    return reduce(lambda c, m: c.when(up.contains(m[0]), m[1]), K.METHODS[1:], out)


# ---- ids and json


def stable_id(seed: Column) -> Column:
    """26 base-32 digits of the first 128 bits of SHA-256 over the prefix and seed.

    The 130 digit bits are the 128 bits with two zeros in front: the first byte
    gives two digits, every following five hex digits give four.
    """
    h = F.substring(F.sha2(F.concat(F.lit(f"{K.ID_PREFIX}:"), seed), 256), 1, 32)
    alphabet = F.lit(K.ID_ALPHABET)

    def digit(value: Column, shift: int) -> Column:
        return F.substr(alphabet, F.shiftright(value, shift).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))

    head = F.conv(F.substring(h, 1, 2), 16, 10).cast("long")
    out = [digit(head, 5), digit(head, 0)]
    for k in range(6):
        part = F.conv(F.substring(h, 3 + 5 * k, 5), 16, 10).cast("long")
        out += [digit(part, s) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def entity_id(*parts: Column | str) -> Column:
    """Prefixed id of kind and parts."""
    return F.concat(F.lit(K.ID_PREFIX), stable_id(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts])))


def canonical_json(columns: list[str]) -> Column:
    """The columns by name order as compact JSON, nulls written out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def string_map(json: Column) -> Column:
    return F.from_json(json, "map<string,string>")


# ---- numbers


def convert(value: Column, factor: Column) -> Column:
    """value * factor; a factor that is not positive fails the query."""
    bad = factor.isNull() | F.isnan(factor) | (factor <= 0)
    return F.when(bad, F.raise_error(F.lit("a unit factor must be positive")).cast("double")).otherwise(value * factor)


def in_grams(value: Column, unit: Column) -> Column:
    return value * lookup(K.GRAMS, unit, 1.0)


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| over the larger magnitude; 0 where both are 0; null with a null."""
    top = F.greatest(F.abs(a), F.abs(b))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(top == 0, 0.0).otherwise(F.try_divide(F.abs(a - b), top))


def per_volume(value: Column, density: Column) -> Column:
    return value * density


def cooked(value: Column, retention: Column, yield_factor: Column) -> Column:
    return value * retention * yield_factor


def rank_in(order: Column, item: Column) -> Column:
    """1-based place in an array; items that are not listed come after all."""
    at = F.array_position(order, item)
    return F.when(at == 0, F.size(order) + 1).otherwise(at).cast("int")
