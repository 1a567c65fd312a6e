"""String similarities as Column expressions, and two that have none as Arrow-batched UDFs."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def bigrams(c: Column) -> Column:
    """Pairs of neighbouring characters, repeats included."""
    return F.when(F.length(c) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2))))


def jaccard(a: Column, b: Column, empty: float = 1.0) -> Column:
    """Shared words over all words; ``empty`` if neither side has any."""
    both = F.size(F.array_union(words(a), words(b)))
    return F.when(both == 0, F.lit(empty)).otherwise(F.size(F.array_intersect(words(a), words(b))) / F.greatest(both, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Shared distinct bigrams over those of the shorter side."""
    x, y = F.array_distinct(bigrams(a)), F.array_distinct(bigrams(b))
    least = F.least(F.size(x), F.size(y))
    return F.when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(least, F.lit(1)))


def dice(a: Column, b: Column) -> Column:
    """Twice the shared bigrams, counted as often as both sides have them, over all; 0 if there are none."""
    x, y = bigrams(a), bigrams(b)
    count = lambda xs, g: F.size(F.filter(xs, lambda h: h == g))
    shared = F.aggregate(F.array_distinct(x), F.lit(0), lambda n, g: n + F.least(count(x, g), count(y, g)))
    every = F.size(x) + F.size(y)
    return F.when(every == 0, F.lit(0.0)).otherwise(F.lit(2.0) * shared / F.greatest(every, F.lit(1)))


def band_similarity(a: Column, b: Column) -> Column:
    """The better of ``jaccard`` and ``dice``, less where one side is much shorter."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b), F.lit(1))
    ratio = short / long
    return F.greatest(jaccard(a, b, 0.0), dice(a, b)) * F.when(ratio >= 0.6, F.lit(1.0)).otherwise(ratio / 0.6)


def initials_score(a: Column, b: Column) -> Column:
    """How well two strings of initials agree."""
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    x, y = chars(a), chars(b)
    overlap = F.size(F.array_intersect(x, y))
    first = F.substring(a, 1, 1) == F.substring(b, 1, 1)
    within = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    off = F.aggregate(F.zip_with(x, y, lambda p, q: F.when(p.eqNullSafe(q), 0).otherwise(1)), F.lit(0), lambda n, d: n + d)
    return (
        F.when((a == "") | (b == ""), F.lit(0.5))
        .when(a == b, F.lit(1.0))
        .when(F.startswith(a, b) | F.startswith(b, a), F.lit(0.95))
        .when(F.array_join(F.array_sort(x), "") == F.array_join(F.array_sort(y), ""), F.lit(0.9))
        .when(first & within, F.lit(0.85))
        .when(first & (F.length(a) == F.length(b)) & (off == 1), F.lit(0.75))
        .when(first, F.lit(0.6))
        .when(overlap > 0, F.lit(0.15))
        .otherwise(F.lit(0.0))
    )


def _jaro_winkler(a: str, b: str) -> float:
    """The published definition: prefix weight 0.1, at most four characters, only above a Jaro of 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    other = [c for c, t in zip(b, taken, strict=True) if t]
    moved = sum(x != y for x, y in zip(mine, other, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def ratcliff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp: twice the characters of matching blocks over all characters."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def surname_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """The best Jaro-Winkler between two lists of spellings; the first of each, its full form, gets 0.02 more, up to 1; 0 for an empty list."""
    best = lambda x, y: max((min(1.0, _jaro_winkler(s, t) + (0.02 if i == j == 0 else 0.0)) for i, s in enumerate(x) for j, t in enumerate(y)), default=0.0)
    return pd.Series([0.0 if x is None or y is None else best(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def given_conflict(a: Column, b: Column) -> Column:
    """What two lists of given names score if their first ones are both spelled out and differ: 0, or 0.1 with one initial; else null.

    A name that begins with the other is a shortening of it.
    """
    x, y = F.get(a, F.lit(0)), F.get(b, F.lit(0))
    told = (F.length(x) >= 3) & (F.length(y) >= 3) & ~F.startswith(x, y) & ~F.startswith(y, x)
    return F.when(told, F.when(F.substring(x, 1, 1) == F.substring(y, 1, 1), F.lit(0.1)).otherwise(F.lit(0.0)))


def person_score(a_surnames: Column, b_surnames: Column, a_initials: Column, b_initials: Column, a_given: Column, b_given: Column, floor: float = 0.87) -> Column:
    """How likely two parsed names are one person's: 0.65 of the surnames' likeness and 0.35 of the initials', 0 under ``floor`` of the first.

    Given names that are spelled out and differ go before initials; the same one spelled out adds 0.01, up to 1.
    """
    return person_score_of(surname_score(a_surnames, b_surnames), a_initials, b_initials, a_given, b_given, floor)


def person_score_of(surname: Column, a_initials: Column, b_initials: Column, a_given: Column, b_given: Column, floor: float = 0.87) -> Column:
    """``person_score`` where the likeness of the surnames is known, as it is for all people of two surnames."""
    return person_score_at(surname, initials_score(a_initials, b_initials), a_given, b_given, floor)


def person_score_at(surname: Column, initials: Column, a_given: Column, b_given: Column, floor: float = 0.87) -> Column:
    """``person_score`` where the likeness of the initials is known too."""
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    spelled = (first(a_given) == first(b_given)) & (F.length(first(a_given)) >= 3)
    score = 0.65 * surname + 0.35 * F.coalesce(given_conflict(a_given, b_given), initials) + F.when(spelled, 0.01).otherwise(0.0)
    return F.when(surname < floor, F.lit(0.0)).otherwise(F.least(score, F.lit(1.0)))


#: What ``initials_score`` may be, by its rules in turn; initials short and plain enough to be compared as numbers.
INITIALS = (0.5, 1.0, 0.95, 0.9, 0.85, 0.75, 0.6, 0.15, 0.0)
_PLACES = 6
PLAIN = rf"^[0-9a-z]{{0,{_PLACES}}}\z"


def initials_code(c: Column) -> list[Column]:
    """``at, upto, kinds, bag``: plain initials as numbers: letters by place, the places that they fill, which letters there are, and letters in order; for ``initials_rule``.  Others have nulls."""
    c = F.when(c.rlike(PLAIN), c)
    codes = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.when(F.ascii(x) < 58, F.ascii(x) - 47).otherwise(F.ascii(x) - 86))
    packed = lambda xs: F.aggregate(F.reverse(xs), F.lit(0).cast("long"), lambda n, x: n * 64 + x)
    power = lambda base, n: F.pow(F.lit(base), n).cast("long")
    kinds = F.aggregate(codes, F.lit(0).cast("long"), lambda n, x: n.bitwiseOR(power(2.0, x)))
    return [packed(codes).alias("at"), (power(64.0, F.length(c)) - 1).alias("upto"), kinds.alias("kinds"), packed(F.array_sort(codes)).alias("bag")]


def initials_rule(a: Column, b: Column) -> Column:
    """The place in ``INITIALS`` of the score of two ``initials_code``, by a few operations on numbers."""
    both, off = a["kinds"].bitwiseAND(b["kinds"]), a["at"].bitwiseXOR(b["at"])
    one = F.lit(False)
    for i in range(_PLACES):
        one = one | (off.bitwiseAND(F.lit(63 * 64**i).cast("long")) == off)
    first = off.bitwiseAND(F.lit(63).cast("long")) == 0
    return (
        F.when((a["at"] == 0) | (b["at"] == 0), 0)
        .when(off == 0, 1)
        .when((a["at"].bitwiseAND(b["upto"]) == b["at"]) | (b["at"].bitwiseAND(a["upto"]) == a["at"]), 2)
        .when(a["bag"] == b["bag"], 3)
        .when(first & ((both == a["kinds"]) | (both == b["kinds"])), 4)
        .when(first & (a["upto"] == b["upto"]) & one, 5)
        .when(first, 6)
        .when(both != 0, 7)
        .otherwise(8)
    )
