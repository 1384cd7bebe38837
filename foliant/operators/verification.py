"""Checks of claims against their sources, as ordered ladders of conditions; and filters given as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.functions.conditions import compile_condition
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked


def verify(claims: DataFrame, decimal: str = ".") -> DataFrame:
    """claims (…, value, quote, source, kind) with status, reason, tier and flags; the first failing check decides.

    A quote must be long enough and stand in its source, and the value must stand in the quote as a number of its own;
    values of figures need not, they are read off; computed ones need not if a column `expected` has what their inputs
    make. Flat texts and numbers are made once per row, each behind the checks that come before it.
    """
    computed = T.computed_from(F.col("value"), F.col("expected")) if "expected" in claims.columns else F.lit(False)
    out = claims.withColumn("__n", T.canonical_number(F.col("value").cast("string"), decimal)).withColumn("__q", T.flat(F.col("quote")))
    long = F.length("__q") >= T.QUOTE_MIN_CHARS
    out = out.withColumn("__s", F.col("__n").isNotNull() & long & F.contains(T.flat(F.col("source")), F.col("__q")))
    # A value whose digits are nowhere in the quote needs no look at the quote's numbers.
    out = out.withColumn("__v", F.when(F.col("__s"), F.array_contains(T.numbers_in(F.col("__q"), decimal), F.col("__n"))))
    inside, figure = F.coalesce("__v", F.lit(False)), F.coalesce(F.col("kind") == "figure", F.lit(False))
    reason = (
        F.when(F.col("__n").isNull(), "value is not a number").when(~long, "quote_too_short").when(~F.col("__s"), "quote_not_in_source")
        .when(~inside & ~figure & ~computed, "value_not_in_quote")
    )
    flags = F.array_compact(F.array(F.when(F.col("__s") & ~inside & figure, "read_off"), F.when(F.col("__s") & ~inside & ~figure & computed, "computed")))
    out = out.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("refused"))
    return out.withColumn("tier", F.when(F.col("kind") == "section", "text_located").otherwise("visual_source")).withColumn("flags", flags).drop("__n", "__q", "__s", "__v")


def settle(rows: DataFrame, address: list[str], value: str, tolerance: float) -> DataFrame:
    """One line per address: single, duplicate (all equal), rounding (within the tolerance) or contested."""
    spread = F.max(value) - F.min(value)
    state = F.when(F.count("*") == 1, "single").when(spread == 0, "duplicate").when(spread <= tolerance, "rounding").otherwise("contested")
    return rows.groupBy(*address).agg(state.alias("state"), F.count("*").alias("n"))


def merge_field(rows: DataFrame, answers: DataFrame, key: list[str], name: str) -> DataFrame:
    """rows with the answers to a field folded in: a field read before stays; else read, unstated, unbacked or unanswered."""
    a = answers.select(*key, F.col("answer"), F.col("backed"), F.col("unstated"))
    out = rows.join(a, key, "left")
    state = F.when(F.col(name).isNotNull(), "read").when(F.coalesce("unstated", F.lit(False)), "unstated").when(F.col("answer").isNull(), "unanswered").when(F.col("backed"), "read").otherwise("unbacked")
    return out.withColumn(f"{name}_state", state).withColumn(name, F.when(F.col(name).isNull() & (F.col(f"{name}_state") == "read"), F.col("answer")).otherwise(F.col(name))).drop("answer", "backed", "unstated")


def derive(rows: DataFrame, unit: str, candidates: DataFrame) -> DataFrame:
    """The parameter of a row by its unit, where only one has it; candidates (unit, parameter) are a spec's few rows."""
    only = candidates.groupBy(unit).agg(F.count_distinct("parameter").alias("n"), F.min("parameter").alias("derived")).where("n = 1").drop("n")
    return rows.join(checked(only), unit, "left")


def longest_standing(text: Column, options: list[str]) -> Column:
    """The longest option that stands in a text, the first by name of equals."""
    ordered = sorted(options, key=lambda o: (-len(o), o))
    return F.try_element_at(F.filter(F.array(*map(F.lit, ordered)), lambda o: F.contains(F.lower(text), F.lower(o))), F.lit(1)) if options else F.lit(None)


def nearest_head(rows: DataFrame, doc: str, pos: str, head: Column) -> DataFrame:
    """Each row's nearest head above it."""
    w = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("head", F.last(F.when(head, F.col(pos)), ignorenulls=True).over(w))


@query(HARVEST + """
    , c AS (SELECT document, pos, CAST(value AS BIGINT) AS value, CASE WHEN pos % 5 = 0 THEN 'v ' || CAST(value AS BIGINT) WHEN pos % 5 = 1 THEN 'a quote without it' ELSE 'a total of ' || CAST(value AS BIGINT) || ' tons' END AS quote,
            pos % 5 = 2 AS elsewhere, CASE WHEN pos % 2 = 0 THEN 'section' ELSE 'figure' END AS kind FROM h)
    SELECT document, pos, CASE WHEN length(quote) < 8 THEN 'quote_too_short' WHEN elsewhere THEN 'quote_not_in_source' WHEN pos % 5 = 1 AND kind <> 'figure' THEN 'value_not_in_quote' END AS reason,
           CASE WHEN kind = 'section' THEN 'text_located' ELSE 'visual_source' END AS tier FROM c
""")
def verify_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims checked against their quotes and sources."""
    v = F.col("value").cast("long").cast("string")
    quote = F.when(F.col("pos") % 5 == 0, F.concat(F.lit("v "), v)).when(F.col("pos") % 5 == 1, "a quote without it").otherwise(F.concat(F.lit("a total of "), v, F.lit(" tons")))
    h = harvest(spark, sf_dir).select("document", "pos", v.alias("value"), quote.alias("quote"), F.when(F.col("pos") % 2 == 0, "section").otherwise("figure").alias("kind"))
    claims = h.withColumn("source", F.when(F.col("pos") % 5 == 2, "something else").otherwise(F.concat(F.lit("It says “"), F.col("quote"), F.lit("”."))))
    return verify(claims).select("document", "pos", "reason", "tier")


@query(HARVEST + """
    SELECT document, parameter, status, CASE WHEN count(*) = 1 THEN 'single' WHEN max(value) = min(value) THEN 'duplicate' WHEN max(value) - min(value) <= 2 THEN 'rounding' ELSE 'contested' END AS state, count(*) AS n
    FROM h GROUP BY 1, 2, 3
""")
def settled_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per address of the value graph."""
    return settle(harvest(spark, sf_dir), ["document", "parameter", "status"], "value", 2.0)


@query(HARVEST + """
    SELECT document, pos, CASE WHEN pos % 2 = 0 THEN year WHEN pos % 3 = 0 AND discount >= 0.05 THEN 1990 + pos END AS year,
           CASE WHEN pos % 2 = 0 THEN 'read' WHEN pos % 3 <> 0 THEN 'unanswered' WHEN discount >= 0.05 THEN 'read' ELSE 'unbacked' END AS year_state FROM h
""")
def merged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers about a coordinate folded onto the rows that lack it."""
    h = harvest(spark, sf_dir)
    rows = h.select("document", "pos", F.when(F.col("pos") % 2 == 0, F.col("year")).alias("year"))
    answers = h.where("pos % 3 = 0").select("document", "pos", (F.lit(1990) + F.col("pos")).alias("answer"), (F.col("discount") >= 0.05).alias("backed"), F.lit(False).alias("unstated"))
    return merge_field(rows, answers, ["document", "pos"], "year")


@query(HARVEST + """SELECT document, pos FROM h WHERE (parameter IN ('A', 'R') AND NOT value < 10) AND (status = 'F' OR year >= 1997)""")
def condition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter given as data, compiled to one predicate that Spark may push down."""
    facts = {("line", "parameter"): ("choice", F.col("parameter")), ("value", "number"): ("number", F.col("value")), ("coordinate", "status"): ("text", F.col("status")), ("coordinate", "year"): ("var", F.col("year"))}
    tree = {"all": [
        {"of": "line", "is": "parameter", "op": "one_of", "value": ["a", "r"]}, {"of": "value", "is": "number", "op": "less", "value": 10, "not": True},
        {"any": [{"of": "coordinate", "is": "status", "op": "is", "value": "f"}, {"of": "coordinate", "is": "year", "op": "at_least", "value": 1997}]},
    ]}
    return harvest(spark, sf_dir).where(compile_condition(tree, facts)).select("document", "pos")


@query("""
    SELECT doc_id, CASE WHEN contains(lower(text), 'released under') THEN 'released under' WHEN contains(lower(text), 'rights') THEN 'rights' WHEN contains(lower(text), 'cc') THEN 'cc' END AS standing FROM documents
""")
def standing_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest entry of a list that stands in a text."""
    return table(spark, sf_dir, "documents").select("doc_id", longest_standing(F.col("text"), ["cc", "rights", "released under"]).alias("standing"))


@query(HARVEST + """
    SELECT document, pos, max(CASE WHEN status = 'F' THEN pos END) OVER (PARTITION BY document ORDER BY pos ROWS UNBOUNDED PRECEDING) AS head FROM h
""")
def nearest_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's nearest head above."""
    return nearest_head(harvest(spark, sf_dir), "document", "pos", F.col("status") == "F").select("document", "pos", "head")


@query(HARVEST + """
    , c AS (SELECT document, pos, CAST(value AS BIGINT) AS v, pos % 4 AS four FROM h)
    SELECT document, pos, CASE WHEN four = 1 THEN 'value_not_in_quote' END AS reason, CASE four WHEN 0 THEN 'computed' WHEN 3 THEN 'read_off' ELSE '' END AS flags FROM c
""")
def verified_computations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that were worked out: their inputs must make them."""
    four, v = F.col("pos") % 4, F.col("value").cast("long")
    quote = F.when(four == 2, F.concat(F.lit("in all it is "), v.cast("string"))).otherwise("the sum of the parts")
    h = harvest(spark, sf_dir).select("document", "pos", v.cast("string").alias("value"), quote.alias("quote"), quote.alias("source"), F.when(four == 3, "figure").otherwise("section").alias("kind"),
                                      F.when(four == 0, v + 0.4).when(four == 1, v + 3.0).cast("double").alias("expected"))
    return verify(h).select("document", "pos", "reason", F.array_join("flags", ",").alias("flags"))
