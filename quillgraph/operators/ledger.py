"""Printed ledgers: the shape of an account's rows, its two sides, its balances, and where accounts begin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.numbers import parse_money

#: The printed shapes (fixed values): columns, what their headers say, and where each side has its description, capital
#: and interest; ``label`` is the row's own, a dash none.  Shapes come in the order in which headers are tried.
SHAPES = (
    ("ledger_dr_cr_5", 5, "capital interest cr", "label 0 1", "2 3 4"),
    ("ledger_dr_cr_4", 4, "capital interest cr", "label 0 1", "- 2 3"),
    ("ledger_split_3", 2, "capital interest", "label 0 -", "1 2 -"),
    ("ledger_debit_2", 2, "debit credit trust", "label 0 -", "label 1 -"),
)
#: Shapes that rows of a width show, whatever their header says; three columns are a split ledger only if that was announced.
BY_WIDTH = {5: "ledger_dr_cr_5", 4: "ledger_dr_cr_4", 3: "ledger_dr_cr_4"}
TRUST = r"trust|return b|return c|^$|^none$"


def shape(columns: Column, title: Column) -> Column:
    """The shape of ``SHAPES`` that a table's headers announce, null for other tables.

    A table of debit and credit alone is a ledger only in a trust fund return, or without a title.
    """
    heads = F.transform(F.coalesce(columns, F.array().cast("array<string>")), lambda x: F.lower(F.coalesce(x, F.lit(""))))
    joined = F.lower(F.array_join(F.coalesce(columns, F.array().cast("array<string>")), "\n"))
    has = lambda word: F.contains(joined, F.lit(word))
    at = lambda i, word: F.coalesce(F.contains(F.get(heads, F.lit(i)), F.lit(word)), F.lit(False))
    says = {
        "capital": has("capital"), "interest": has("interest"), "cr": F.exists(heads, lambda x: F.startswith(x, F.lit("cr"))),
        "debit": has("debit") | at(0, "dr"), "credit": has("credit") | at(1, "cr"), "trust": F.lower(F.coalesce(title, F.lit(""))).rlike(TRUST),
    }
    out = F.lit(None).cast("string")
    for name, width, words, _, _ in reversed(SHAPES):
        fits = F.size(heads) == width
        for word in words.split():
            fits = fits & says[word]
        out = F.when(fits, name).otherwise(out)
    return out


def effective_shape(rows: DataFrame, account: str, values: str, declared: str) -> DataFrame:
    """Add ``shape``: what the account's widest row shows, its total row among them, where that is wider than its header says."""
    wide = F.max(F.size(F.coalesce(values, F.array().cast("array<string>")))).over(Window.partitionBy(account))
    split = next(name for name, *_, credit in SHAPES if credit.startswith("1"))
    shown = F.try_element_at(F.create_map(*[F.lit(x) for pair in BY_WIDTH.items() for x in pair]), F.least(F.col("_w"), F.lit(max(BY_WIDTH))))
    return rows.withColumn("_w", wide).withColumn("shape", F.when((F.col("_w") == 3) & (F.col(declared) == split), split).otherwise(F.coalesce(shown, declared))).drop("_w")


def entries(rows: DataFrame, account: str, label: str, values: str, shape: str, total: Column | None = None) -> DataFrame:
    """``account, side, description, capital, interest``: the debit and the credit of each printed row, by its shape.

    A side without a figure gives no entry, nor do rows of no shape and those that ``total`` holds for.
    """
    cell = lambda place: F.col(label) if place == "label" else F.lit(None).cast("string") if place == "-" else F.get(F.col(values), F.lit(int(place)))
    lines = rows if total is None else rows.where(~F.coalesce(total, F.lit(False)))
    both = {}
    for side, column in (("Dr", 3), ("Cr", 4)):
        parts = []
        for part in range(3):
            of = F.lit(None).cast("string")
            for row in SHAPES:
                of = F.when(F.col(shape) == row[0], cell(row[column].split()[part])).otherwise(of)
            parts.append(of)
        both[f"_{side}"] = F.struct(F.lit(side).alias("side"), F.trim(parts[0]).alias("description"), parse_money(parts[1]).alias("capital"), parse_money(parts[2]).alias("interest"))
    # figures are read before the sides are told apart: a condition on them can't sink below that, to be worked out twice
    sides = lines.select(account, *[x.alias(name) for name, x in both.items()])
    return sides.select(account, F.explode(F.array(*both)).alias("_e")).select(account, "_e.*").where("capital is not null or interest is not null")


def balances(entries: DataFrame, account: str) -> DataFrame:
    """``account, kind, stated_year, amount`` of the balance lines: the credit side's opens the year, the debit side's closes it."""
    amount, year = F.coalesce("capital", "interest"), F.regexp_extract("description", "(18[0-9]{2}|19[0-9]{2})", 1).try_cast("int")
    kind = F.when(F.col("side") == "Dr", "closing").otherwise("opening")
    return entries.where(F.col("description").rlike("(?i)balance") & amount.isNotNull()).select(account, kind.alias("kind"), year.alias("stated_year"), amount.alias("amount"))


def account_blocks(rows: DataFrame, file: str, line: str, kind: str, section: str) -> DataFrame:
    """Number the accounts of each file in line order: add ``block``, from 0.

    An account ends with a total row that isn't carried forward, with headers,
    and where a row states another section than the last one that stated any.
    ``kind``: row, total, carried or headers.
    """
    w = Window.partitionBy(file).orderBy(line)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    other = F.col(section).isNotNull() & F.last(section, True).over(before).isNotNull() & (F.col(section) != F.last(section, True).over(before))
    starts = (F.lag(kind).over(w) == "total") | (F.col(kind) == "headers") | other
    numbered = rows.withColumn("_new", F.when(F.coalesce(starts, F.lit(False)) & (F.row_number().over(w) > 1), 1).otherwise(0))
    return numbered.withColumn("block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
