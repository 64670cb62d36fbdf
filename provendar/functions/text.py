"""Text functions that the JVM has no equal for: exact Unicode folding, name similarity, dictionary phrases. Arrow batches only."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from . import fixed as K
from . import scalar as S

_LIGATURES = str.maketrans(K.LIGATURES)


def fold_exact(text: str) -> str:
    """Ligatures spelt out, compatibility decomposition, combining marks dropped, case folded."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.translate(_LIGATURES)) if not unicodedata.combining(c)).casefold()


def split_words(text: str) -> list[str]:
    folded = unicodedata.normalize("NFKD", text).casefold()
    return "".join(c if c.isalnum() else " " for c in folded if not unicodedata.combining(c)).split()


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str, str]:
    """Folding goes character by character, so a table can say it: (characters that become one character, what they become, characters that vanish).

    Built from the rule of fold_exact, for the basic plane; what becomes several characters is in EXPANDING.
    """
    single, to, gone = [], [], []
    for cp in range(0x10000):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000 or c in K.LIGATURES:
            continue
        f = fold_exact(c)
        if f == "":
            gone.append(c)
        elif len(f) == 1 and f != c:
            single.append(c)
            to.append(f)
    return "".join(single), "".join(to), "".join(gone)


@lru_cache(maxsize=1)
def expanding() -> str:
    """A Java pattern for the characters whose folding is not in the table: those that become several, and all beyond the basic plane."""
    many = [cp for cp in range(0x10000) if not 0xD800 <= cp < 0xE000 and chr(cp) not in K.LIGATURES and len(fold_exact(chr(cp))) > 1]
    runs: list[list[int]] = []
    for cp in many:
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in runs) + r"\x{10000}-\x{10ffff}]"


@F.pandas_udf(StringType())
def _fold_rows(text: pd.Series) -> pd.Series:
    return text.map(fold_exact, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def words_exact(text: pd.Series) -> pd.Series:
    """Folded words of names (small, curated tables)."""
    return text.map(split_words, na_action="ignore")


def normalize_label(text: Column) -> Column:
    """Ligatures spelt out, compatibility decomposition, combining marks dropped, case folded, for any text.

    The JVM's table serves all texts without an expanding character; only those few go through Python.
    """
    return F.coalesce(_fold_rows(F.when(text.rlike(expanding()), text)), S.fold(text))


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of the normalized names; the argument order matters. Only for pairs that blocking left."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, " ".join(split_words(x)), " ".join(split_words(y))).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a: str, b: str) -> float:
    """SequenceMatcher(None, a, b).ratio(), some times faster for names: only how much matches is asked for, and the longest block is looked for by str.find."""
    if not a and not b:
        return 1.0
    if len(b) >= 200:  # there the library drops frequent characters
        return SequenceMatcher(None, a, b).ratio()
    found, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        size, at, i = 0, alo, alo
        while i + size < ahi:  # the longest block, of several the first in a, then the first in b
            while i + size < ahi and b.find(a[i : i + size + 1], blo, bhi) >= 0:
                size, at = size + 1, i
            i += 1
        if size:
            found += size
            to = b.find(a[at : at + size], blo, bhi)
            if alo < at and blo < to:
                todo.append((alo, at, blo, to))
            if at + size < ahi and to + size < bhi:
                todo.append((at + size, ahi, to + size, bhi))
    return 2.0 * found / (len(a) + len(b))
