"""Readers and writers: optional tables, JSON lines, front matter, glob scans, partition replacement."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.operators.lineage import cut


def delimited(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV table with a header, or by tabs where the name ends in .tsv; without a schema every column is text."""
    reader = spark.read.option("header", True).option("sep", "\t" if path.rstrip("/").endswith(".tsv") else ",")
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet, CSV or TSV table (by suffix), or an empty one of ``schema`` if there is none."""
    try:
        return delimited(spark, path, schema) if path.endswith((".csv", ".tsv")) else spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """``id``: the distinct words of text files."""
    return spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("id")).where("id <> ''").distinct()


def page_manifest(spark: SparkSession, glob: str) -> DataFrame:
    """``tag, page, file, n_chars`` of page manifests: three fields by tabs, without a header; the tag is the file's folder."""
    rows = spark.read.option("sep", "\t").schema("page int, file string, n_chars long").csv(glob)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("tag"), "page", "file", "n_chars")


def catalogue(spark: SparkSession, url: str, driver: str, table: str, columns: str = "*") -> DataFrame:
    """A table of a catalogue database, read through JDBC with its columns and filters pushed down."""
    return spark.read.format("jdbc").options(url=url, driver=driver, query=f"select {columns} from {table}").load()


def attributes(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The attribute table of a set of shapes, exported as CSV: the first row of each key, in the order of all columns."""
    rows = delimited(spark, path)
    order = Window.partitionBy(key).orderBy(*[c for c in rows.columns if c != key])
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def _scalar(raw: str, where: str):
    """A plain YAML value: quoted or bare text, a whole number, or a flat list of them; anything else is refused."""
    raw = raw.strip()
    if raw[:1] in ("'", '"'):
        quote = raw[0]
        if len(raw) < 2 or raw[-1] != quote:
            raise ValueError(f"{where}: text that goes on in another line")
        inner = raw[1:-1]
        if quote == "'":
            if re.search(r"(?<!')'(?:'')*(?!')", inner):
                raise ValueError(f"{where}: more after a quoted text")
            return inner.replace("''", "'")
        if "\\" in inner or '"' in inner:
            raise ValueError(f"{where}: escapes in double quotes")
        return inner
    if raw.startswith("["):
        if not raw.endswith("]") or raw.count("[") > 1:
            raise ValueError(f"{where}: a list that is nested or goes on in another line")
        return [_scalar(x, where) for x in raw[1:-1].split(",") if x.strip()]
    if raw[:1] in "|>&*!{%@`" and raw:
        raise ValueError(f"{where}: {raw[0]!r} begins a form that isn't read")
    raw = re.split(r"\s#", raw)[0].strip()
    if ": " in raw:
        raise ValueError(f"{where}: a mapping in a mapping")
    return int(raw) if re.fullmatch(r"-?\d+", raw) else raw


def rule_file(spark: SparkSession, path: str, keys: Sequence[str] = ("id", "label", "unit", "match", "years")) -> dict[str, object]:
    """A rule file: its plain values, and under each list's name its rules or texts, in order.

    The file is YAML of one depth: ``name: value``; ``name:`` with ``- key: value`` items of the ``keys``; or
    ``name:`` with ``- text`` items.  Comments and blank lines are passed over.  Whatever else YAML knows, unknown or repeated keys, and
    patterns that don't compile are refused with their line, so no rule is lost in silence.
    """
    (whole,) = spark.read.text(path, wholetext=True).collect()  # one file
    out: dict[str, object] = {}
    items: list | None = None
    for number, line in enumerate(whole.value.splitlines(), 1):
        where, text = f"{path}, line {number}", line.strip()
        if not text or text.startswith("#") or text == "---":
            continue
        if "\t" in line[: len(line) - len(line.lstrip())]:
            raise ValueError(f"{where}: a tab in the indent")
        deep, item = line[0] == " ", text.startswith("- ")
        pair = re.match(r"(?:- )?([A-Za-z_][A-Za-z_0-9]*):(?:\s+(.*))?$", text)
        if not deep and not item:
            if not pair or pair[1] in out:
                raise ValueError(f"{where}: neither a new name nor an item")
            items = None if pair[2] and not pair[2].startswith("#") else []
            out[pair[1]] = _scalar(pair[2], where) if items is None else items
            continue
        if items is None:
            raise ValueError(f"{where}: an indented line that belongs to no list")
        if item and not pair:
            items.append(_scalar(text[2:], where))
            continue
        if not pair or pair[1] not in keys or not pair[2]:
            raise ValueError(f"{where}: not one of {', '.join(keys)} with a value")
        if item:
            items.append({})
        if not items or not isinstance(items[-1], dict) or pair[1] in items[-1]:
            raise ValueError(f"{where}: a key of no rule, or a second one")
        items[-1][pair[1]] = _scalar(pair[2], where)
        if pair[1] == "match":
            try:
                re.compile(items[-1]["match"])
            except (re.error, TypeError) as error:
                raise ValueError(f"{where}: no pattern: {error}") from None
    return out


def rule_list(spark: SparkSession, path: str) -> list[tuple[str, str, int, int]]:
    """Ordered label rules of a rule file: (series, pattern, first year, last year).

    The rules are the file's list ``series``, with ``id`` and ``match``, and ``years`` (two numbers) where a rule holds for
    some years only.  Named groups are written as Spark's regular expressions take them; a rule without ``id`` or ``match`` is refused.
    """
    rules = rule_file(spark, path).get("series", [])
    for n, rule in enumerate(rules, 1):
        if not isinstance(rule, dict) or not {"id", "match"} <= set(rule) or len(rule.get("years", [0, 0])) != 2:
            raise ValueError(f"{path}: rule {n} of series lacks id or match, or its years aren't two")
    return [(str(r["id"]), r["match"].replace("(?P<", "(?<"), *r.get("years", [0, 9999])) for r in rules]


def json_lines(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """The objects of JSON lines; lines that are malformed, or no object, are left out."""
    parsed = F.from_json(column, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("_json", parsed).where(F.trim(column).startswith("{")).where("_json is not null and _json._bad is null")
    return rows.select(*lines.columns, "_json.*").drop("_bad")


def json_files(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """JSON lines of many files: the file's path, the year in its folder's name, else in its own, and the number of each line in its file, from 0.

    Files are read whole, each in one task, so that the number doesn't depend on how a file is split.
    """
    raw = spark.read.text(glob, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    lines = raw.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return json_lines(lines.withColumn("year", F.coalesce(*[F.regexp_extract("path", p, 1).try_cast("int") for p in ("([0-9]{4})[^/]*/[^/]*$", "([0-9]{4})[^/]*$")])), "value", schema)


def front_matter(spark: SparkSession, glob: str) -> DataFrame:
    """Whole text files: the keys between two lines of three hyphens, quotes taken off, and the body after them."""
    whole = spark.read.text(glob, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    head = F.regexp_extract("value", r"^---\n([\s\S]*?)\n---\n", 1)
    body = F.regexp_replace("value", r"^---\n[\s\S]*?\n---\n", "")
    pairs = F.filter(F.split(head, "\n"), lambda x: F.contains(x, F.lit(":")))
    keys = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(F.regexp_replace(x, r"^[^:]*:\s*", ""), '^"|"$', "")).alias("value"))))
    return whole.select("path", keys.alias("keys"), body.alias("body"))


def write_partition(rows: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions of ``column`` that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_parts(rows: DataFrame, path: str, longest: int = 400_000) -> None:
    """Gzipped JSON lines of texts, split at blank lines into parts of at most ``longest`` characters, in order.

    A block that is longer by itself is cut at ``longest`` characters.
    """
    cuts = lambda b: F.transform(F.sequence(F.lit(0), F.greatest(F.length(b) - 1, F.lit(0)), F.lit(longest)), lambda i: F.substr(b, i + 1, F.lit(longest)))
    blocks = rows.select("doc_id", F.posexplode(F.flatten(F.transform(F.split("text", r"\n\n"), cuts))).alias("n", "block"))
    folded = F.aggregate(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "block"))), lambda x: x["block"]),
        F.array().cast("array<string>"),
        lambda parts, b: F.when((F.size(parts) > 0) & (F.length(F.element_at(parts, -1)) + F.length(b) < longest), F.concat(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.concat(F.element_at(parts, -1), F.lit("\n\n"), b)))).otherwise(F.concat(parts, F.array(b))),
    )
    blocks.groupBy("doc_id").agg(folded.alias("parts")).select("doc_id", F.posexplode("parts").alias("part", "text")).write.mode("overwrite").option("compression", "gzip").json(path)


def write_review(rows: DataFrame, path: str) -> None:
    """A crosswalk or review sheet: CSV with a header, every column as text, lists joined by bars."""
    plain = [F.array_join(F.col(c).cast("array<string>"), "|").alias(c) if kind.startswith("array") else F.col(c).cast("string") for c, kind in rows.dtypes]
    rows.select(*plain).write.mode("overwrite").option("header", True).csv(path)


def append_decided(rows: DataFrame, path: str, key: str) -> int:
    """Append to JSON lines the rows whose key isn't there yet, so that a broken run can go on; how many were added."""
    spark = rows.sparkSession
    done = optional_json(spark, path, f"{key} {dict(rows.dtypes)[key]}")
    new = cut(rows.join(done.select(key).distinct(), key, "left_anti"))
    new.write.mode("append").json(path)
    return new.count()


def optional_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, or an empty table of ``schema`` if there are none."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
