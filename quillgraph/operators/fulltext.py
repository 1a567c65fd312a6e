"""Full-text search: postings, document lengths, BM25, phrases, prefixes, trigram lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.text import fold, norm
from quillgraph.operators.lineage import cut
from quillgraph.operators.relational import spread

K1, B = 1.2, 0.75


def postings(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, term, tf``: one row for each word of a document, counted before anything is shuffled."""
    words = F.regexp_extract_all(fold(text), F.lit("([a-z0-9]+)"), 1)
    return docs.select("doc_id", F.explode(words).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def doc_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, length`` in words."""
    return docs.select("doc_id", F.size(F.regexp_extract_all(fold(text), F.lit("([a-z0-9]+)"), 1)).alias("length"))


#: Distinct words of all queries up to which they are tested where the texts lie.
TERMS_IN_PLAN = 1000


def bm25(docs: DataFrame, queries: DataFrame, text: str = "text") -> DataFrame:
    """``query, doc_id, score``: BM25 of every document with a word of the query.

    ``queries``: ``query, term``.  Every text is cut into words once, to its
    length and the words that some query has; these narrow rows are kept in a
    table, from which corpus size, mean length, document counts and scores come.
    """
    words = F.regexp_extract_all(fold(text), F.lit("([a-z0-9]+)"), 1)
    terms = [r.term for r in queries.select("term").distinct().limit(TERMS_IN_PLAN + 1).collect()]
    if len(terms) <= TERMS_IN_PLAN:
        rows = docs.select("doc_id", words.alias("_w")).select("doc_id", F.size("_w").alias("length"), F.filter("_w", lambda w: w.isin(*terms)).alias("_w"))
        rows = cut(rows)
        found = rows.select("doc_id", "length", F.explode("_w").alias("term"))
    else:
        rows = docs.select("doc_id", words.alias("_w"), F.size(words).alias("length"))
        found = rows.select("doc_id", "length", F.explode("_w").alias("term")).join(queries.select("term").distinct(), "term", "left_semi")
    whole = rows.agg(F.count("*").alias("n_docs"), F.avg("length").alias("mean_length"))
    post = found.groupBy("doc_id", "length", "term").agg(F.count("*").alias("tf"))
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    scored = queries.join(df, "term").join(post, "term").crossJoin(F.broadcast(whole))  # one row
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean_length")))
    return scored.groupBy("query", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each query; ties to the smaller id."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def phrase(text: Column, words: str) -> Column:
    """Whether the folded words stand next to one another in the text."""
    return F.contains(F.concat(F.lit(" "), norm(text), F.lit(" ")), F.lit(f" {words} "))


def trigrams(c: Column) -> Column:
    """Distinct runs of three characters of the squashed text."""
    x = F.replace(norm(c), F.lit(" "), F.lit(""))
    return F.when(F.length(x) < 3, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda i: F.substr(x, i, F.lit(3)))))


def trigram_hits(aliases: DataFrame, queries: DataFrame, alias: str, least: float) -> DataFrame:
    """``query, alias, share``: aliases that hold at least this share of a query's trigrams, by a join on trigrams."""
    posted = aliases.select(alias, F.explode(trigrams(F.col(alias))).alias("gram"))
    asked = queries.select("query", F.size(trigrams(F.col("query"))).alias("n"), F.explode(trigrams(F.col("query"))).alias("gram"))
    hits = asked.join(posted, "gram").groupBy("query", "n", alias).agg(F.count("*").alias("shared"))
    return hits.select("query", alias, F.round(F.col("shared") / F.col("n"), 6).alias("share")).where(F.col("share") >= least)


def lookup(aliases: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Names to entities, best class first: 1 equal, 2 equal when squashed, 3 begins with it, 4 holds it, 5 trigrams.

    ``aliases``: ``alias, id, n``.  Classes 1 to 3 meet by equi-joins on the
    name, its squash and its first letters, three or as many as the query has; 4
    and 5 by trigrams.  A query without letters and digits begins no other name.
    """
    a = aliases.select("alias", "id", "n", norm("alias").alias("_norm")).withColumn("_sq", F.replace(F.col("_norm"), F.lit(" "), F.lit("")))
    q = queries.select("query", norm("query").alias("_q")).withColumn("_qs", F.replace(F.col("_q"), F.lit(" "), F.lit("")))
    heads = F.array_distinct(F.array(*[F.substring("_norm", 1, i) for i in (1, 2, 3)]))
    head = q.withColumn("_h", F.substring("_q", 1, 3)).join(a.withColumn("_h", F.explode(heads)), "_h")
    near = head.where("startswith(_norm, _q)").select("query", "alias", "id", "n", F.when(F.col("_norm") == F.col("_q"), 1).when(F.col("_sq") == F.col("_qs"), 2).otherwise(3).alias("match"))
    same = q.join(a, F.col("_qs") == F.col("_sq")).select("query", "alias", "id", "n", F.lit(2).alias("match"))
    grams = trigram_hits(a.select("alias").distinct(), q.select("query"), "alias", 0.6).join(a, "alias").join(q, "query")
    far = grams.select("query", "alias", "id", "n", F.when(F.contains("_sq", "_qs"), 4).otherwise(5).alias("match"))
    best = near.union(same).union(far).groupBy("query", "id").agg(F.min("match").alias("match"), F.max("n").alias("n"))
    w = Window.partitionBy("query").orderBy("match", F.desc("n"), "id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _grams(c: Column, sizes: Sequence[int]) -> Column:
    """The distinct runs of some numbers of characters."""

    def runs(n: int) -> Column:
        cut_ = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
        return F.when(F.length(c) >= n, cut_).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(n) for n in sizes]))


def staged_lookup(aliases: DataFrame, queries: DataFrame, entities: DataFrame, limit: int = 10, most: int = 200, most_pieces: int = 40) -> DataFrame:
    """``query, rank, type, id, score, matched``: the entities that each query may mean, best first.

    ``aliases``: alias, type, id, n; ``queries``: query; ``entities``: type, id, n_mentions, n_years.  Classes, by folded names:
    equal 3, begins with it 2, holds it 1.5; where these give fewer than ``limit``
    entities, holds each word of three letters or more 1; where there are still
    fewer, holds a piece of it without spaces, 0.5: all of it if it is shorter than six letters, else every second run of five.
    An entity's score is the best of its classes' plus its mentions under all names of that class, at most 50, by 100;
    a class takes the ``most`` best attested, the pieces the ``most_pieces`` names with most of them.  Scores count
    to one digit, then mentions, years, type and id decide.  Entities that aren't in ``entities``, null names and queries without
    letters give nothing.  Names and queries meet at the characters that they must share.
    """
    a = aliases.groupBy(norm("alias").alias("_a"), "type", "id").agg(F.sum("n").alias("n")).where("_a <> ''").join(entities.select("type", "id"), ["type", "id"], "left_semi")
    a = cut(a.withColumn("_sq", F.replace("_a", F.lit(" "), F.lit(""))))
    q = cut(queries.select("query").where("query is not null").distinct().withColumn("_q", norm("query")).where("_q <> ''").withColumn("_qs", F.replace("_q", F.lit(" "), F.lit(""))))
    posted = a.select("_a", "type", "id", "n", F.explode(_grams(F.col("_a"), (1, 2, 3))).alias("_g"))
    met = q.withColumn("_g", F.substring("_q", 1, 3)).join(posted, "_g").where("contains(_a, _q)")
    held = F.when(F.col("_a") == F.col("_q"), F.array(F.lit(3.0), F.lit(2.0), F.lit(1.5))).when(F.startswith("_a", F.col("_q")), F.array(F.lit(2.0), F.lit(1.5))).otherwise(F.array(F.lit(1.5)))
    first = met.select("query", "_a", "type", "id", "n", F.explode(held).alias("base"))

    def summed(rows: DataFrame) -> DataFrame:
        each = rows.groupBy("query", "base", "type", "id").agg(F.sum("n").alias("n"), F.array_sort(F.collect_set("_a")).alias("matched"))
        best = F.row_number().over(Window.partitionBy("query", "base").orderBy(F.desc("n"), "type", "id"))
        return each.withColumn("_r", best).where(F.col("_r") <= most).drop("_r")

    def wanting(found: DataFrame) -> DataFrame:
        enough = found.groupBy("query").agg(F.count_distinct("type", "id").alias("_n")).where(F.col("_n") >= limit)
        return q.join(enough, "query", "left_anti")

    found = cut(summed(first))
    words = wanting(found).withColumn("_w", F.explode(F.array_distinct(F.filter(F.split("_q", " "), lambda w: F.length(w) > 2)))).withColumn("_g", F.substring("_w", 1, 3))
    asked = words.groupBy("query").agg(F.count("*").alias("_words"))
    every = words.join(posted, "_g").where("contains(_a, _w)").groupBy("query", "_a", "type", "id", "n").agg(F.count("*").alias("_hit")).join(asked, "query").where("_hit = _words")
    found = cut(found.unionByName(summed(every.withColumn("base", F.lit(1.0)).select("query", "_a", "type", "id", "n", "base"))))
    cuts = F.when(F.length("_qs") < 6, F.array("_qs")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_qs") - 4, F.lit(1)), F.lit(2)), lambda i: F.substr("_qs", i, F.lit(5))))
    pieces = wanting(found).where(F.length("_qs") >= 3).select("query", F.explode(F.array_distinct(cuts)).alias("_g"))
    by_piece = pieces.join(a.select("_a", "type", "id", "n", F.explode(_grams(F.col("_sq"), (3, 4, 5))).alias("_g")), "_g").groupBy("query", "_a", "type", "id", "n").agg(F.count("*").alias("_hit"))
    top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("_hit"), F.desc("n"), "_a", "type", "id"))
    last = by_piece.withColumn("_r", top).where(F.col("_r") <= most_pieces).select("query", F.lit(0.5).alias("base"), "type", "id", "n", F.array("_a").alias("matched"))
    scored = found.unionByName(last).groupBy("query", "type", "id").agg(F.max(F.col("base") + F.least("n", F.lit(50)) / 100).alias("score"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("matched")))), 1, 5).alias("matched"))
    ranked = scored.join(entities.select("type", "id", "n_mentions", "n_years"), ["type", "id"])
    order = Window.partitionBy("query").orderBy(F.desc(F.round("score", 1)), F.desc(F.coalesce("n_mentions", F.lit(0))), F.desc(F.coalesce("n_years", F.lit(0))), "type", "id")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("query", "rank", "type", "id", F.round("score", 2).alias("score"), "matched")


def field_postings(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``term, doc_id, field, tf, positions``: where each word stands in each field, from 0, in order."""
    words = lambda f: F.regexp_extract_all(fold(F.coalesce(f, F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    # texts are moved, not their words one by one: a document's words are then grouped where it lies
    whole = spread(docs.select("doc_id", *fields), "doc_id", parts=192)
    each = whole.select("doc_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), words(F.col(f)).alias("words")) for f in fields])).alias("_f"))
    rows = each.select("doc_id", "_f.field", F.posexplode("_f.words").alias("pos", "term"))
    return rows.groupBy("term", "doc_id", "field").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def bm25_fields(docs: DataFrame, queries: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """``query, doc_id, score``: BM25 over several fields, a word in each counting by the field's weight.

    Lengths are of all fields together; a word in more than half of the
    documents counts next to nothing, not less (its idf is at least 1e-6).
    ``queries``: ``query, term``.  The words of the queries are found by a join.
    """
    words = lambda f: F.regexp_extract_all(fold(F.coalesce(f, F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    weighed = lambda f, w: F.transform(words(F.col(f)), lambda t: F.struct(t.alias("term"), F.lit(float(w)).alias("w")))
    cells = F.flatten(F.array(*[weighed(f, w) for f, w in weights.items()]))
    asked = queries.select("term").distinct()
    rows = docs.select("doc_id", cells.alias("_c")).withColumn("length", F.size("_c"))
    whole = rows.agg(F.count("*").alias("n_docs"), F.avg("length").alias("mean_length"))
    post = rows.select("doc_id", "length", F.explode("_c").alias("_c")).select("doc_id", "length", "_c.*").join(asked, "term", "left_semi").groupBy("doc_id", "length", "term").agg(F.sum("w").alias("f"))
    post = cut(post)
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    scored = queries.join(df, "term").join(post, "term").crossJoin(F.broadcast(whole))  # one row
    idf = F.greatest(F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    part = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / F.col("mean_length")))
    return scored.groupBy("query", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
