"""Evaluation of harvests: verdicts, precision and recall with intervals, pairing and comparison of two harvests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table

#: Two-sided 95 % quantile of the normal distribution.
Z = 1.959963984540054


def wilson(hits: Column, total: Column, z: float = Z) -> Column:
    """struct<low, high>, the Wilson score interval; null without trials, and exactly 0 and 1 at the extremes."""
    p, n = hits / total, total.cast("double")
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z / (1 + z * z / n) * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    low = F.when(hits == 0, 0.0).otherwise(F.greatest(F.lit(0.0), middle - half))
    high = F.when(hits == total, 1.0).otherwise(F.least(F.lit(1.0), middle + half))
    return F.when(total > 0, F.struct(low.alias("low"), high.alias("high")))


def row_verdict(verdict: str) -> Column:
    """Aggregate of field verdicts: one wrong makes the row wrong, all correct make it correct, else it is undecided."""
    v = F.col(verdict)
    return F.when(F.bool_or(v == "wrong"), "wrong").when(F.bool_and(F.coalesce(v == "correct", F.lit(False))), "correct")


def pair_rows(old: DataFrame, new: DataFrame, key: list[str], signature: str, order: str) -> DataFrame:
    """Full outer pairing of two harvests by key: (key, old, new, kind) with kind same, changed, gone or new.

    Rows of equal signature pair first, the n-th with the n-th; what is left of a key pairs in order; the rest is gone or
    new. Two passes of numbering and two outer joins, with no pair beyond those that come out.
    """

    def numbered(df: DataFrame, side: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy(*key, signature).orderBy(order))
        return df.select(*key, F.col(signature).alias("sig"), F.col(order).alias(side), n.alias("n"))

    twins = numbered(old, "old").join(numbered(new, "new"), [*key, "sig", "n"], "full")
    same = twins.where("old IS NOT NULL AND new IS NOT NULL").select(*key, "old", "new", F.lit("same").alias("kind"))
    left = twins.where("new IS NULL").withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy("old"))).select(*key, "old", "n")
    right = twins.where("old IS NULL").withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy("new"))).select(*key, "new", "n")
    kind = F.when(F.col("new").isNull(), "gone").when(F.col("old").isNull(), "new").otherwise("changed")
    rest = left.join(right, [*key, "n"], "full").select(*key, "old", "new", kind.alias("kind"))
    return same.unionByName(rest)


def settled(decisions: DataFrame, key: list[str], verdict: str, order: str) -> DataFrame:
    """The last decision about each key."""
    return decisions.groupBy(*key).agg(F.max_by(verdict, order).alias(verdict))


def review_queue(rows: DataFrame, decided: DataFrame, key: str, limit: int) -> DataFrame:
    """Undecided rows in the order of a hash of their name: a sample that is the same for everyone."""
    open_ = rows.join(decided.select(key), key, "left_anti")
    return open_.withColumn("__h", F.sha2(F.col(key).cast("string"), 256)).orderBy("__h", key).limit(limit).drop("__h")


def recall_at(hits: DataFrame, truth: DataFrame, keys: list[str], ks: list[int]) -> DataFrame:
    """Share of truths found within the first k hits, for each k."""
    found = truth.join(hits.groupBy(*keys).agg(F.min("rank").alias("rank")), keys, "left")
    r = found.agg(*[F.round(F.avg((F.coalesce("rank", F.lit(1 << 30)) <= k).cast("double")), 6).alias(f"r{k}") for k in ks])
    return r.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"r{k}").alias("recall")) for k in ks])).alias("x")).select("x.k", "x.recall")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    verdict = F.when(F.col("quality") == 1, "correct").when(F.col("quality") == 0, "wrong")
    return d.join(l, "doc_id", "left").withColumn("verdict", verdict)


@query(f"""
    WITH g AS (SELECT lang, CASE quality WHEN 1 THEN 'correct' WHEN 0 THEN 'wrong' END AS v FROM documents LEFT JOIN labels USING (doc_id)),
    c AS (SELECT lang, count(*) FILTER (v = 'correct') AS correct, count(*) FILTER (v = 'wrong') AS wrong, count(*) FILTER (v IS NULL) AS undecided FROM g GROUP BY 1),
    t AS (SELECT *, correct + wrong AS n, correct / nullif(correct + wrong, 0) AS p FROM c)
    SELECT lang, correct, wrong, undecided, round(p, 6) AS precision,
           round(CASE WHEN correct = 0 THEN 0 ELSE greatest(0, (p + {Z * Z} / (2 * n)) / (1 + {Z * Z} / n) - {Z} / (1 + {Z * Z} / n) * sqrt(p * (1 - p) / n + {Z * Z} / (4 * n * n))) END, 6) AS low,
           round(CASE WHEN correct = n THEN 1 ELSE least(1, (p + {Z * Z} / (2 * n)) / (1 + {Z * Z} / n) + {Z} / (1 + {Z * Z} / n) * sqrt(p * (1 - p) / n + {Z * Z} / (4 * n * n))) END, 6) AS high
    FROM t
""")
def evaluate_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision per language with its interval."""
    v = F.col("verdict")
    g = _gold(spark, sf_dir).groupBy("lang").agg(F.count_if(v == "correct").alias("correct"), F.count_if(v == "wrong").alias("wrong"), F.count_if(v.isNull()).alias("undecided"))
    n = F.col("correct") + F.col("wrong")
    w = wilson(F.col("correct"), n)
    return g.select("lang", "correct", "wrong", "undecided", F.round(F.try_divide(F.col("correct"), n), 6).alias("precision"), F.round(w["low"], 6).alias("low"), F.round(w["high"], 6).alias("high"))


@query("""
    SELECT source, CASE WHEN bool_or(v = 'wrong') THEN 'wrong' WHEN bool_and(coalesce(v = 'correct', false)) THEN 'correct' END AS verdict
    FROM (SELECT source, CASE quality WHEN 1 THEN 'correct' WHEN 0 THEN 'wrong' END AS v FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1
""")
def row_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict over all fields of a group."""
    return _gold(spark, sf_dir).groupBy("source").agg(row_verdict("verdict").alias("verdict"))


@query("""
    SELECT lang, grouping(lang) AS all_langs, source, grouping(source) AS all_sources, count(*) AS n, count(*) FILTER (quality = 1) AS correct
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (source), ())
""")
def precision_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict counts by several groupings in one pass."""
    g = _gold(spark, sf_dir)
    sets = g.groupingSets([[F.col("lang")], [F.col("source")], []], F.col("lang"), F.col("source"))
    out = sets.agg(F.grouping("lang").cast("long").alias("all_langs"), F.grouping("source").cast("long").alias("all_sources"), F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("correct"))
    return out.select("lang", "all_langs", "source", "all_sources", "n", "correct")


_PAIRS = HARVEST + """
    , o AS (SELECT document, parameter, pos, status || '/' || CAST(value AS BIGINT) AS sig FROM h WHERE pos % 5 <> 0),
    w AS (SELECT document, parameter, pos, status || '/' || CAST(CASE WHEN pos % 3 = 0 THEN value + 1 ELSE value END AS BIGINT) AS sig FROM h WHERE pos % 4 <> 0),
    o1 AS (SELECT *, row_number() OVER (PARTITION BY document, parameter, sig ORDER BY pos) AS n FROM o),
    w1 AS (SELECT *, row_number() OVER (PARTITION BY document, parameter, sig ORDER BY pos) AS n FROM w),
    t AS (SELECT coalesce(o1.document, w1.document) AS document, coalesce(o1.parameter, w1.parameter) AS parameter, o1.pos AS old, w1.pos AS new
          FROM o1 FULL JOIN w1 ON o1.document = w1.document AND o1.parameter = w1.parameter AND o1.sig = w1.sig AND o1.n = w1.n),
    a AS (SELECT *, row_number() OVER (PARTITION BY document, parameter ORDER BY old) AS n FROM t WHERE new IS NULL),
    b AS (SELECT *, row_number() OVER (PARTITION BY document, parameter ORDER BY new) AS n FROM t WHERE old IS NULL),
    r AS (SELECT coalesce(a.document, b.document) AS document, coalesce(a.parameter, b.parameter) AS parameter, a.old, b.new,
                 CASE WHEN b.new IS NULL THEN 'gone' WHEN a.old IS NULL THEN 'new' ELSE 'changed' END AS kind
          FROM a FULL JOIN b ON a.document = b.document AND a.parameter = b.parameter AND a.n = b.n),
    p AS (SELECT document, parameter, old, new, 'same' AS kind FROM t WHERE old IS NOT NULL AND new IS NOT NULL UNION ALL SELECT * FROM r)
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harvest(spark, sf_dir).select("document", "parameter", "pos", "status", "value")
    sig = lambda v: F.concat_ws("/", "status", v.cast("long").cast("string"))
    old = h.where("pos % 5 <> 0").withColumn("sig", sig(F.col("value")))
    new = h.where("pos % 4 <> 0").withColumn("sig", sig(F.when(F.col("pos") % 3 == 0, F.col("value") + 1).otherwise(F.col("value"))))
    return pair_rows(old, new, ["document", "parameter"], "sig", "pos")


@query(_PAIRS + "SELECT * FROM p")
def pair_harvests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of two harvests paired."""
    return _pairs(spark, sf_dir)


@query(_PAIRS + "SELECT parameter, kind, count(*) AS n, count(DISTINCT document) AS documents FROM p GROUP BY 1, 2")
def diff_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two harvests, by parameter."""
    return _pairs(spark, sf_dir).groupBy("parameter", "kind").agg(F.count("*").alias("n"), F.count_distinct("document").alias("documents"))


@query("""
    SELECT doc_id, source FROM (SELECT doc_id, source, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    ORDER BY h, doc_id LIMIT 25
""")
def open_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first undecided documents by hash."""
    return review_queue(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id", 25)


@query("""
    SELECT user_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY 1
""")
def settled_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later decision about the same content replaces the earlier."""
    return settled(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""
    WITH h AS (SELECT o_custkey AS q, o_orderkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders),
    t AS (SELECT o_custkey AS q, max(o_orderkey) AS doc FROM orders GROUP BY 1), f AS (SELECT rank FROM t LEFT JOIN h USING (q, doc))
    SELECT k, round(avg(CASE WHEN rank <= k THEN 1.0 ELSE 0.0 END), 6) AS recall FROM f, (VALUES (1), (5), (10)) AS x(k) GROUP BY 1
""")
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the true document is among the first k."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("q"), F.col("o_orderkey").alias("doc"), "o_totalprice")
    hits = o.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("o_totalprice"), "doc")))
    return recall_at(hits, o.groupBy("q").agg(F.max("doc").alias("doc")), ["q", "doc"], [1, 5, 10])


@query("""
    WITH f AS (SELECT lang, count(*) FILTER (quality = 1 AND toxic = 0) AS found, count(*) FILTER (quality = 0) AS missed FROM documents JOIN labels USING (doc_id) GROUP BY 1)
    SELECT lang, found, missed, round(found / nullif(found + missed, 0), 6) AS recall FROM f
""")
def recall_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall over checked documents only."""
    g = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").groupBy("lang").agg(
        F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("found"), F.count_if(F.col("quality") == 0).alias("missed"))
    return g.withColumn("recall", F.round(F.try_divide(F.col("found"), F.col("found") + F.col("missed")), 6))
