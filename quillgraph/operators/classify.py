"""Ordered-rule classifiers and nearest-value decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.similarity import dice

Rule = tuple[str, str]


def first_rule(text: Column, rules: Sequence[Rule], other: str) -> Column:
    """The name of the first rule whose pattern the text holds."""
    out = F.lit(other)
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def every_rule(text: Column, rules: Sequence[Rule]) -> Column:
    """The names of all rules that the text holds, in rule order."""
    return F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in rules]), lambda x: x.isNotNull())


def unique_box(points: DataFrame, boxes: Sequence[tuple], x: str, y: str) -> DataFrame:
    """``points`` that lie in exactly one box (name, x0, x1, y0, y1), with its name as ``region``.

    The boxes are a fixed list, so each row is tested where it lies, without a join.
    """
    hit = F.filter(F.array(*[F.when(F.col(x).between(x0, x1) & F.col(y).between(y0, y1), F.lit(n)) for n, x0, x1, y0, y1 in boxes]), lambda r: r.isNotNull())
    return points.withColumn("hits", hit).where(F.size("hits") == 1).withColumn("region", F.col("hits")[0]).drop("hits")


def snapped(rows: DataFrame, value: str, canon: Sequence[str], least: float) -> DataFrame:
    """Add ``snapped``: the likest canonical value (ties to the first by name) if it is like enough, else empty."""
    scores = F.array(*[F.struct((-F.round(dice(F.col(value), F.lit(c)), 6)).alias("cost"), F.lit(c).alias("name")) for c in sorted(canon)])
    best = F.array_min(scores)
    return rows.withColumn("snapped", F.when(-best["cost"] >= least, best["name"]).otherwise(F.lit("")))


def dense_groups(rows: DataFrame, group: Sequence[str], present: Column, share: float) -> DataFrame:
    """Rows of groups in which ``present`` holds for at least ``share`` of the rows."""
    rate = F.avg(present.cast("int")).over(Window.partitionBy(*group))
    return rows.withColumn("rate", rate).where(F.col("rate") >= share).drop("rate")
