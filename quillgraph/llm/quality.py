"""Quality rules with risk-controlled thresholds.

A rule is a score of a text in thousandths; a text fails it above a threshold.
Thresholds of all rules are set together for each stratum, from labelled
holdouts, so that at most ``RISK`` of the good texts fail any of them:

1. A fifth of the labelled texts, by a hash of the id, and all bad ones, design a
   path: threshold vectors that only get stricter, rule after rule.
2. The other good texts test it.  Each step is tested by an exact binomial test of
   the texts that fail any rule there, at a level divided by the number of strata.
   Steps are nested, so they are tested in turn and the first that can't be shown
   safe ends the path; that needs no correction within it.  The last safe step
   gives the thresholds.

The good texts meant are those that the fixed base rules pass: what these reject
no threshold changes.  With chance ``1 - CONFIDENCE_LOSS`` the bound holds in all
strata at once.  Strata with too few good texts for any test to pass are pooled,
and the bound holds for the pool; a stratum without labels has no thresholds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_map, batched, stored, texts_of

#: Share of a stratum's good texts that may fail any rule, and the chance that any stratum breaks that.
RISK, CONFIDENCE_LOSS = 0.02, 0.05
#: One in so many labelled good texts designs the path, the others test it; steps of the path for each rule.
DESIGN, RULE_STEPS = 5, 8
#: What a good text that fails costs, in bad texts that fail.
COST_OF_GOOD = 20.0
STEPS = 1000
RULES = ("symbols", "capitals", "bangs", "bars", "same_lines", "same_words")
_SYMBOLS, _UPPER, _LOWER = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(97, 123))
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measured(text: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The base counts of a text, and its scores by rule in thousandths."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes: splits at exactly the six ASCII white-space characters
    n = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    same_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: dict[tuple, int] = {}
        covered = np.zeros(n, bool)
        for at, window in enumerate(windows):
            if (first := seen.setdefault(window, at)) != at:
                covered[at : at + 3] = True
                covered[first : first + 3] = True
        repeated = int(covered.sum())
    upper, lower = len(data) - len(data.translate(None, _UPPER)), len(data) - len(data.translate(None, _LOWER))
    shares = (symbols / max(1, word_chars), upper / max(1, upper + lower), text.count("!") / max(1, word_chars), words.count(b"|") / max(1, n), same_lines / max(1, len(lines)), repeated / max(1, n))
    return (n, word_chars, symbols, same_lines, repeated), tuple(min(STEPS, int(STEPS * x)) for x in shares)


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum``, the base counts and ``scores array<int>`` of every whole text (null: no words)."""
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, scores = zip(*map(measured, texts_of(batch)), strict=True)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            return pa.record_batch([batch.column("doc_id"), batch.column("stratum"), *columns, pa.array(scores, pa.list_(pa.int32()))], ["doc_id", "stratum", *names, "scores"])

        return one

    rows = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    return arrow_map(rows, make, f"doc_id long, stratum string, {COUNTS}, scores array<int>")


def at_most(failures: int, n: int, share: float) -> float:
    """P(no more than ``failures`` of ``n``) if each fails with chance ``share``: small if the true share is below."""
    if not n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share) for i in range(failures + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def wanted(good: np.ndarray, bad: np.ndarray) -> tuple[int, float]:
    """The threshold of one rule that parts bad from good best, and its gain, from counts by score; STEPS if none does."""
    n_good, n_bad = max(1, int(good.sum())), max(1, int(bad.sum()))
    failed_good, failed_bad = (np.cumsum(x[::-1])[::-1][1:] for x in (good, bad))  # above each threshold
    gain = failed_bad / n_bad - COST_OF_GOOD * failed_good / n_good
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))  # the highest of equals
    return (best, float(gain[best])) if gain[best] > 1e-12 else (STEPS, 0.0)


def path(good: np.ndarray, bad: np.ndarray) -> list[list[int]]:
    """Threshold vectors that only get stricter, from design counts ``[rule, score]``: the rule that gains most first.

    A rule comes down to its wanted threshold in ``RULE_STEPS`` steps of about as many bad texts.
    """
    aims = [wanted(g, b) for g, b in zip(good, bad, strict=True)]
    at, out = [STEPS] * len(aims), []
    for rule in sorted(range(len(aims)), key=lambda r: (-aims[r][1], r)):
        aim = aims[rule][0]
        if aim == STEPS:
            continue
        above = np.cumsum(bad[rule][::-1])[::-1][1:]
        for step in range(1, RULE_STEPS + 1):
            enough = np.flatnonzero(above[aim:] >= step / RULE_STEPS * above[aim])
            limit = aim + int(enough[-1]) if step < RULE_STEPS else aim
            if limit < at[rule]:
                at[rule] = limit
                out.append(list(at))
    return out


def least_tested(level: float, risk: float = RISK) -> int:
    """Good texts without a failure that a test at ``level`` needs."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def safe_steps(failures: list[int], n: int, level: float, risk: float = RISK) -> int:
    """Steps of a path that are shown safe: ``failures[k]`` of ``n`` good texts fail at step k."""
    for k, failed in enumerate(failures):
        if failed > risk * n or at_most(failed, n, risk) > level:
            return k
    return len(failures)


def thresholds(measures: DataFrame, labels: DataFrame, risk: float = RISK, loss: float = CONFIDENCE_LOSS) -> DataFrame:
    """``stratum, limits array<int>``: the thresholds by rule, from every labelled document.

    ``measures``: of ``features``.  ``labels``: ``doc_id, quality`` (1: good).  A
    document with several labels is good if all say so; null labels count for
    nothing; rows that repeat count once.  What is gathered is counts for each
    stratum, rule and score, and for each stratum and step, whatever the input's size.
    """
    batched(measures.sparkSession)
    said = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    role = F.when(F.col("quality") <= 0, "bad").when(F.pmod(F.xxhash64("doc_id"), F.lit(DESIGN)) == 0, "design").otherwise("test")
    rows = measures.where(~_base_failed()).join(said, "doc_id").select("doc_id", "stratum", role.alias("role"), "scores").distinct()
    rows = stored(rows, "quality-labelled")
    sizes = rows.groupBy("stratum").agg(F.count_if(F.col("role") == "test").alias("n"))
    most = max(1, sizes.count())
    pooled = F.when(F.col("n") >= least_tested(loss / most, risk), F.col("stratum"))
    groups = stored(sizes.select("stratum", F.struct(pooled.alias("own")).alias("group")), "quality-groups")  # a null name is the pool's
    level = loss / max(1, groups.select("group").distinct().count())
    rows = rows.join(groups, "stratum")
    counts = rows.where("role <> 'test'").select("group", "role", F.posexplode("scores").alias("rule", "score")).groupBy("group", "rule", "score").agg(F.count_if(F.col("role") == "design").alias("n_good"), F.count_if(F.col("role") == "bad").alias("n_bad"))

    def designed(part: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros((2, len(RULES), STEPS + 1), np.int64)
        np.add.at(good, (part.rule, part.score), part.n_good)
        np.add.at(bad, (part.rule, part.score), part.n_bad)
        return pd.DataFrame({"group": part.group.iloc[:1], "steps": [path(good, bad)]})

    steps = stored(counts.select(F.to_json("group").alias("group"), "rule", "score", "n_good", "n_bad").groupBy("group").applyInPandas(designed, "group string, steps array<array<int>>"), "quality-paths")
    over = lambda limits: F.exists(F.zip_with("scores", limits, lambda score, limit: score > limit), lambda x: x)
    tested = rows.where("role = 'test'").withColumn("group", F.to_json("group")).join(steps, "group")
    failing = tested.select("group", F.size(F.filter("steps", lambda limits: ~over(limits))).alias("step")).groupBy("group", "step").count()  # steps are nested: those it passes come first

    def shown(part: pd.DataFrame) -> pd.DataFrame:
        walk = [list(map(int, x)) for x in part.steps.iloc[0]]
        first = np.bincount(part.step, part["count"], len(walk) + 1).astype(np.int64)
        safe = safe_steps(np.cumsum(first)[: len(walk)].tolist(), int(first.sum()), level, risk)
        return pd.DataFrame({"group": part.group.iloc[:1], "limits": [walk[safe - 1] if safe else [STEPS] * len(RULES)]})

    limits = failing.join(steps, "group").groupBy("group").applyInPandas(shown, "group string, limits array<int>")
    return groups.withColumn("group", F.to_json("group")).join(limits, "group").select("stratum", "limits")


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The base counts, ``base_failed`` and ``kept`` of every row of ``docs``.

    Null and empty texts have no words and fail the base rules.  A stratum
    without labels is judged by the base rules alone, as is a pool with too few
    good texts to show any threshold safe.  Rows that repeat are judged alike; other columns are
    dropped; an empty table gives no rows.
    """
    measures = stored(features(docs, stratum), "quality-features")
    limits = stored(thresholds(measures, labels), "quality-limits")
    over = F.exists(F.zip_with("scores", "limits", lambda score, limit: score > limit), lambda x: x)
    rows = measures.join(limits, "stratum", "left").withColumn("base_failed", _base_failed())
    kept = ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))
    return rows.select("doc_id", *[c.split()[0] for c in COUNTS.split(", ")], "base_failed", kept.alias("kept"))


#: Strata whose thresholds are sent to the workers at once: what is sent is bounded.
STRATA_PER_PASS = 10_000


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns.

    Every text is measured where it lies, once for the thresholds and once
    to be judged, so no text is shuffled.
    Thresholds are sent out for a bounded number of strata at a time; strata
    beyond them are judged in further passes.
    """
    spark = docs.sparkSession
    limits = stored(thresholds(features(docs, stratum), labels), "quality-limits").where(f"exists(limits, x -> x < {STEPS})")
    columns = docs.columns
    passes = max(1, -(-limits.count() // STRATA_PER_PASS))
    rows = docs
    for number in range(passes):
        sent = spark.sparkContext.broadcast({r.stratum: r.limits for r in limits.where(F.pmod(F.xxhash64("stratum"), F.lit(passes)) == number).toLocalIterator()})

        def make(sent=sent):
            def one(batch: pa.RecordBatch) -> pa.RecordBatch:
                keep = []
                for name, text in zip(batch.column(stratum).to_pylist(), texts_of(batch), strict=True):
                    (n, _, _, _, repeated), scores = measured(text)
                    limit = sent.value.get("" if name is None else str(name))
                    keep.append(n >= 50 and 100 * repeated <= 50 * n and not (limit is not None and any(s > t for s, t in zip(scores, limit, strict=True))))
                return batch.filter(pa.array(keep, pa.bool_()))

            return one

        rows = arrow_map(rows.select(*columns), make, rows.schema)
    return rows
