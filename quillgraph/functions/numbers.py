"""Numbers, money and years out of printed cells; absent is null, never zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells that print no value (fixed values).
NO_VALUE = ("", "...", "-", "*", "nil")
#: Number words (fixed values).
WORD_VALUES = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())} | {w: 10 * (i + 2) for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_value(c: Column | str) -> Column:
    """A cell's number: commas out, the numeric prefix of a cell with a mark; a whole cell with inner spaces is none."""
    x = F.trim(_c(c))
    whole = x.rlike(r"^[0-9][0-9, ]*(\.[0-9]+)?$")
    prefix = F.replace(F.replace(F.regexp_extract(x, r"^([0-9][0-9, ]*(\.[0-9]+)?)", 1), F.lit(","), F.lit("")), F.lit(" "), F.lit(""))
    plain = F.when(whole & F.contains(x, F.lit(" ")), F.lit(None)).otherwise(prefix)
    return F.when(x.isin(*NO_VALUE), F.lit(None)).otherwise(plain.try_cast("double"))


def parse_money(c: Column | str) -> Column:
    """Dollars with cents after a point or a space; an opening bracket means less than nothing; else null."""
    x = F.trim(_c(c))
    sign = F.when(F.startswith(x, F.lit("(")), F.lit(-1.0)).otherwise(F.lit(1.0))
    body = F.replace(F.regexp_replace(x, r"[()$]", ""), F.lit(","), F.lit(""))
    text = F.regexp_extract(F.regexp_replace(body, r"^([0-9]+) ([0-9]{2})$", "$1.$2"), r"^[0-9]+(\.[0-9]+)?$", 0)
    return sign * text.try_cast("double")


def word_number(c: Column | str) -> Column:
    """``fifty-four`` or ``1,612`` as a number: the sum of its number words; null if a part is neither."""
    x = F.lower(F.trim(_c(c)))
    digits = F.replace(x, F.lit(","), F.lit(""))
    known = F.create_map(*[F.lit(v) for pair in WORD_VALUES.items() for v in pair])
    values = F.transform(F.split(x, "[- ]+"), lambda w: F.try_element_at(known, w))
    total = F.aggregate(values, F.lit(0), lambda a, b: a + b)
    return F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int")).otherwise(total)


def year_of(c: Column | str) -> Column:
    """The year that a date begins with, however the rest is written."""
    return F.regexp_extract(F.trim(_c(c)), r"^([0-9]{4})", 1).try_cast("int")


def tag_year(c: Column | str) -> Column:
    """The first four digits in a row."""
    return F.regexp_extract(_c(c), r"([0-9]{4})", 1).try_cast("int")


def padded_id(c: Column | str, width: int = 5) -> Column:
    """An id that went through a float: its whole digits, padded with zeros."""
    return F.lpad(F.regexp_extract(_c(c).cast("string"), r"^([0-9]+)", 1), width, "0")


def close(a: Column, b: Column, within: float = 0.01) -> Column:
    return F.abs(a - b) < within


def year_ranges(years: Column) -> Column:
    """``1894–1896, 1899`` from an array of years: runs of consecutive years, in order."""
    distinct = F.array_sort(F.array_distinct(years))
    starts = F.filter(distinct, lambda y: ~F.array_contains(distinct, y - 1))
    ends = F.filter(distinct, lambda y: ~F.array_contains(distinct, y + 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("–"), b.cast("string"))))
    return F.array_join(runs, ", ")


def acres_of(c: Column | str) -> Column:
    """Acres as printed: commas out, and two digits after a space are hundredths (``57 42`` is 57.42)."""
    return F.regexp_replace(F.replace(_c(c).cast("string"), F.lit(","), F.lit("")), r"^([0-9]+) ([0-9]{2})$", "$1.$2").try_cast("double")


def acres_close_text(a: Column | str, b: Column | str) -> Column:
    """Whether two printed acreages are numbers that differ by less than 0.01."""
    return F.coalesce(close(acres_of(a), acres_of(b)), F.lit(False))


#: Bars of a sparkline, from the lowest (fixed values).
BARS = "▁▂▃▄▅▆▇█"


def sparkline(values: Column) -> Column:
    """A bar for each number of an array, by its place between the least and the greatest; the lowest if they are all equal, a space for null."""
    low, high = F.array_min(values), F.array_max(values)
    place = lambda v: F.when(high > low, F.floor((v - low) * (len(BARS) - 1) / (high - low)).cast("int")).otherwise(F.lit(0))
    return F.array_join(F.transform(values, lambda v: F.when(v.isNull(), " ").otherwise(F.substr(F.lit(BARS), place(v) + 1, F.lit(1)))), "")
