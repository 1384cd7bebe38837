"""Triples: building, basic graph patterns, closure of hierarchies, checks and Turtle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.values import harvest
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked, staged


def triples_of(rows: DataFrame, subject: Column, properties: dict[str, Column]) -> DataFrame:
    """(s, p, o): one triple per row and property that isn't null. The properties become rows by one explode."""
    made = F.array(*[F.struct(F.lit(p).alias("p"), o.cast("string").alias("o")) for p, o in properties.items()])
    return rows.select(subject.cast("string").alias("s"), F.explode(made).alias("t")).select("s", "t.p", "t.o").where("o IS NOT NULL")


def match(triples: DataFrame, patterns: list[tuple[str, str, str]], optional: list[tuple[str, str, str]] = ()) -> DataFrame:
    """Bindings of a basic graph pattern; names with ? are variables. Optional patterns are left joins.

    Each pattern is a filtered scan of the triples, so constants reach the source, and patterns join on shared variables.
    """

    def one(pattern: tuple[str, str, str]) -> DataFrame:
        df = triples
        for column, term in zip("spo", pattern, strict=True):
            if not term.startswith("?"):
                df = df.where(F.col(column) == term)
        return df.select(*[F.col(c).alias(t[1:]) for c, t in zip("spo", pattern, strict=True) if t.startswith("?")])

    out = None
    for kind, group in (("inner", patterns), ("left", optional)):
        for p in group:
            df = one(p)
            out = df if out is None else out.join(df, [c for c in df.columns if c in out.columns], kind)
    return out


def closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(child, ancestor) of edges (child, parent), to the fixpoint at any depth; cycles end it too, and no child is its own ancestor.

    Round k knows all ancestors up to 2 ** k steps away and adds those that a way of exactly 2 ** k steps leads on to, so
    the rounds grow with the logarithm of the depth.
    """
    known = staged(edges.select("child", F.col("parent").alias("ancestor")).where("child <> ancestor").distinct())
    far = known  # pairs that a way of exactly 2 ** k steps joins

    def onward(near: DataFrame) -> DataFrame:
        last = near.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("__next"))
        return far.join(last, "ancestor").where("child <> __next").select("child", F.col("__next").alias("ancestor")).distinct()

    while True:
        new = staged(onward(known).join(known, ["child", "ancestor"], "left_anti"))
        if new.isEmpty():
            return known
        far = staged(onward(far))
        known = staged(known.unionByName(new))


def term_index(triples: DataFrame) -> DataFrame:
    """Per subject: label, alternative labels and parents."""
    p = F.col("p")
    return triples.groupBy("s").agg(
        F.min(F.when(p == "label", F.col("o"))).alias("label"), F.sort_array(F.collect_set(F.when(p == "altLabel", F.col("o")))).alias("alternatives"),
        F.sort_array(F.collect_set(F.when(p == "subClassOf", F.col("o")))).alias("parents"))


def violations(triples: DataFrame, shapes: DataFrame) -> DataFrame:
    """(s, p, kind) for shapes (target, p, least, most, allowed): too few, too many, or a value not allowed.

    Shapes are a profile's few rules; subjects of a target class are those with a type triple.
    """
    typed = triples.where("p = 'type'").select("s", F.col("o").alias("target"))
    wanted = typed.join(checked(shapes), "target")
    n = triples.groupBy("s", "p").agg(F.count("*").alias("n"), F.collect_set("o").alias("found"))
    got = wanted.join(n, ["s", "p"], "left")
    count = F.coalesce("n", F.lit(0))
    bad = (F.size("allowed") > 0) & (F.size(F.array_except(F.coalesce("found", F.array().cast("array<string>")), "allowed")) > 0)
    kinds = F.array_compact(F.array(F.when(count < F.col("least"), "too_few"), F.when(count > F.col("most"), "too_many"), F.when(bad, "not_allowed")))
    return got.select("s", "p", F.explode(kinds).alias("kind"))


def readdress(triples: DataFrame, renamed: DataFrame) -> DataFrame:
    """Subjects and objects rewritten by (old, new)."""
    a = renamed.select(F.col("old").alias("s"), F.col("new").alias("ns"))
    b = renamed.select(F.col("old").alias("o"), F.col("new").alias("no"))
    return triples.join(a, "s", "left").join(b, "o", "left").select(F.coalesce("ns", "s").alias("s"), "p", F.coalesce("no", "o").alias("o"))


def turtle(triples: DataFrame) -> DataFrame:
    """(s, block): one Turtle block per subject, its lines in order of property and object."""
    quoted = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    line = F.concat(F.lit("  :"), F.col("p"), F.lit(" "), quoted)
    lines = F.array_sort(F.collect_list(line))
    return triples.groupBy("s").agg(F.concat(F.lit("<"), F.first("s"), F.lit(">\n"), F.array_join(lines, " ;\n"), F.lit(" .")).alias("block"))


def _triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harvest(spark, sf_dir)
    name = F.concat_ws("/", F.lit("v"), F.col("document").cast("string"), F.col("pos").cast("string"))
    return triples_of(h, name, {"document": F.col("document"), "parameter": F.col("parameter"), "value": F.col("value").cast("long"), "year": F.col("year"), "status": F.when(F.col("status") == "F", F.lit("F"))})


_TRIPLES = """
    WITH h AS (SELECT 'v/' || l_orderkey || '/' || (((l_linenumber * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)) AS s, CAST(l_orderkey AS VARCHAR) AS document, l_returnflag AS parameter, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value,
        CAST(year(l_shipdate) AS VARCHAR) AS year, CASE WHEN l_linestatus = 'F' THEN 'F' END AS status FROM lineitem)
"""


@query(_TRIPLES + "SELECT p, count(*) AS n, count(DISTINCT o) AS objects FROM (UNPIVOT h ON document, parameter, value, year, status INTO NAME p VALUE o) GROUP BY 1")
def triple_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of the harvest, by property."""
    return _triples(spark, sf_dir).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("o").alias("objects"))


@query(_TRIPLES + "SELECT s, document, year, status FROM h WHERE parameter = 'R'")
def bgp_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of one parameter with their documents and years, and the status where there is one."""
    t = _triples(spark, sf_dir)
    return match(t, [("?s", "parameter", "R"), ("?s", "document", "?document"), ("?s", "year", "?year")], [("?s", "status", "?status")]).select("s", "document", "year", "status")


@query(_TRIPLES + "SELECT document, string_agg(DISTINCT year, ', ' ORDER BY year) AS years, count(*) AS n FROM h WHERE parameter = 'R' GROUP BY 1")
def graph_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile's question: grouped, with the distinct years in one text."""
    t = _triples(spark, sf_dir)
    m = match(t, [("?s", "parameter", "R"), ("?s", "document", "?document"), ("?s", "year", "?year")])
    return m.groupBy("document").agg(F.array_join(F.sort_array(F.collect_set("year")), ", ").alias("years"), F.count("*").alias("n"))


@query("""
    WITH RECURSIVE e AS (SELECT p_partkey AS child, p_partkey // 3 AS parent FROM part WHERE p_partkey <= 1000),
    up AS (SELECT child, parent AS ancestor FROM e WHERE child <> parent UNION SELECT up.child, e.parent FROM up JOIN e ON up.ancestor = e.child WHERE e.parent <> up.child)
    SELECT child, ancestor FROM up
""")
def closure_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors in a hierarchy of terms."""
    e = table(spark, sf_dir, "part").where("p_partkey <= 1000").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 3).alias("parent"))
    return closure(spark, e)


@query(_TRIPLES + """SELECT s, 'status' AS p, 'too_few' AS kind FROM h WHERE parameter = 'R' AND status IS NULL""")
def shape_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a class that lack a property."""
    t = _triples(spark, sf_dir)
    typed = t.where("p = 'parameter'").select("s", F.lit("type").alias("p"), "o")
    shapes = spark.createDataFrame([("R", "status", 1, 1, ["F"])], "target string, p string, least int, most int, allowed array<string>")
    return violations(t.unionByName(typed), shapes)


@query(_TRIPLES + """SELECT s, '<' || s || '>' || chr(10) || '  :document "' || document || '"' || ' ;' || chr(10) || '  :parameter "' || parameter || '"'
    || CASE WHEN status IS NULL THEN '' ELSE ' ;' || chr(10) || '  :status "F"' END || ' ;' || chr(10) || '  :value "' || value || '"' || ' ;' || chr(10) || '  :year "' || year || '" .' AS block FROM h""")
def turtle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph as Turtle, a block per value."""
    return turtle(_triples(spark, sf_dir))


@query(_TRIPLES + """SELECT CASE WHEN parameter = 'N' THEN 'x/' || substr(s, 3) ELSE s END AS s, year AS o FROM h""")
def readdressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses rewritten by a rule of the class."""
    t = _triples(spark, sf_dir)
    renamed = t.where("p = 'parameter' AND o = 'N'").select(F.col("s").alias("old"), F.concat(F.lit("x/"), F.substring("s", 3, 100)).alias("new"))
    return readdress(t.where("p = 'year'"), renamed).select("s", "o")
