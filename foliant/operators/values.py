"""The store of values read from documents: identity, trust, search, states and coverage.

lineitem stands in for a harvest: a document's (l_orderkey) rows, in order of l_linenumber (made unique by part,
supplier and quantity), each a value (l_quantity) of
a parameter (l_returnflag) with coordinates (l_linestatus and the year of l_shipdate).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import table

# Levels of trust from best to worst, states from the strongest, and the level that each reason for doubt gives.
LEVELS = ("A", "B", "C", "D")
LADDER = ("read", "unbacked", "exhausted", "unanswered", "unstated")
REASON_LEVELS = {"image": "B", "transcribed": "B", "open": "C", "unbacked": "C", "conflict": "D", "review": "D"}


def harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The harvest's rows, with only the columns of lineitem they need."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.col("l_orderkey").alias("document"), (((F.col("l_linenumber") * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity")).cast("long").alias("pos"), F.col("l_returnflag").alias("parameter"),
        F.col("l_quantity").alias("value"), F.col("l_linestatus").alias("status"), F.year("l_shipdate").alias("year"), F.col("l_discount").alias("discount"),
    )


HARVEST = """
    WITH h AS (SELECT l_orderkey AS document, ((l_linenumber * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS pos, l_returnflag AS parameter, l_quantity AS value,
                      l_linestatus AS status, year(l_shipdate) AS year, l_discount AS discount FROM lineitem)
"""


def same(left: Column, right: Column) -> Column:
    """Equality of fields as stored texts: numbers as numbers, texts by their words; null equals null only."""
    squash = lambda c: F.trim(F.regexp_replace(c.cast("string"), r"\s+", " "))
    number = lambda c: c.cast("string").try_cast("double")
    return F.when(left.isNull() | right.isNull(), left.isNull() & right.isNull()).otherwise(F.coalesce(number(left) == number(right), squash(left) == squash(right)))


def tuple_id(document: Column, quote: Column, value: Column) -> Column:
    """24 hexadecimal digits of the JSON list of document, squashed quote and value."""
    text = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c.cast("string"), r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    joined = F.concat(F.lit("["), text(document), F.lit(", "), text(F.trim(F.regexp_replace(quote, r"\s+", " "))), F.lit(", "), text(value), F.lit("]"))
    return F.substring(F.sha2(joined, 256), 1, 24)


def numbered_ids(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Ids made unique: the second row of an id gets the suffix .2, the third .3."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    return rows.withColumn("__n", n).withColumn(name, F.when(F.col("__n") > 1, F.concat(F.col(name), F.lit("."), F.col("__n"))).otherwise(F.col(name))).drop("__n")


def drop_repeats(rows: DataFrame, document: str, order: str, ignoring: list[str]) -> DataFrame:
    """The first of a document's rows that are equal in all columns but those ignored."""
    keys = [c for c in rows.columns if c not in ignoring and c != order]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("__n", first).where("__n = 1").drop("__n")


def level_of(reason: Column) -> Column:
    """The level of a reason, by its whole name or else by what stands before the colon; unknown reasons give D."""
    table_ = F.create_map(*[F.lit(x) for kv in REASON_LEVELS.items() for x in kv])
    return F.coalesce(F.try_element_at(table_, reason), F.try_element_at(table_, F.split_part(reason, F.lit(":"), F.lit(1))), F.lit("D"))


def trust(reasons: Column, capped: Column) -> Column:
    """The worst level of the reasons; at best B if capped (read from an image or a transcribed page)."""
    base = F.when(capped, F.lit("B")).otherwise(F.lit("A"))
    return F.coalesce(F.array_max(F.concat(F.array(base), F.transform(reasons, level_of))), base)


def contested(rows: DataFrame, keys: list[str], value: str, unit: str | None = None, target: str | None = None) -> DataFrame:
    """rows with `contested`: another row of the same address says another number.

    Two rows that both have a converted value (target) are compared by it, any others by value and unit, so a number in
    two units isn't contested.
    """
    w = Window.partitionBy(*keys)
    said = F.struct(F.col(value).alias("v"), (F.col(unit) if unit else F.lit(None).cast("string")).alias("u"))
    if target is None:
        return rows.withColumn("contested", F.min(said).over(w) != F.max(said).over(w))
    t = F.col(target)
    bare = F.when(t.isNull(), said)
    among = F.coalesce(F.min(t).over(w) != F.max(t).over(w), F.lit(False))
    beside = F.coalesce((F.min(bare).over(w) != said) | (F.max(bare).over(w) != said), F.lit(False))
    return rows.withColumn("contested", F.when(t.isNotNull(), among | beside).otherwise(F.min(said).over(w) != F.max(said).over(w)))


def find(values: DataFrame, document=None, parameter=None, worst=None, text=None, coordinates: dict | None = None, limit: int | None = None, offset: int = 0, order: list[str] | None = None) -> DataFrame:
    """Conjunctive search; every condition that is given is a pushable filter. Pages need an order that breaks ties."""
    conditions = []
    if document is not None:
        conditions.append(F.col("document") == document)
    if parameter is not None:
        conditions.append(F.col("parameter") == parameter)
    if worst is not None:
        conditions.append(F.col("level") <= worst)
    if text is not None:
        conditions.append(F.contains(F.lower("line"), F.lit(text.lower())))
    for name, wanted in (coordinates or {}).items():
        conditions.append(same(F.col(name), F.lit(wanted)))
    out = values.where(reduce(lambda a, b: a & b, conditions)) if conditions else values
    if limit is not None:
        out = out.orderBy(*(order or values.columns)).offset(offset).limit(limit)
    return out


def histogram(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Per keys: array of (value, n) by falling n, then value."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), F.col(value).alias("v"))))
    return counts.groupBy(*keys).agg(F.transform(ordered, lambda x: F.concat(x["v"].cast("string"), F.lit("="), (-x["minus"]).cast("string"))).alias(name))


@query(HARVEST + """
    SELECT document, pos, CASE WHEN n > 1 THEN id || '.' || n ELSE id END AS id FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY document, pos) AS n FROM (
            SELECT document, pos, substr(sha256('["' || document || '", "' || parameter || ' ' || status || '", "' || CAST(value AS BIGINT) || '"]'), 1, 24) AS id FROM h))
""")
def tuple_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content ids of all values, numbered where they repeat."""
    h = harvest(spark, sf_dir)
    made = h.select("document", "pos", tuple_id(F.col("document"), F.concat_ws(" ", "parameter", "status"), F.col("value").cast("long")).alias("id"))
    return numbered_ids(made, "id", ["document", "pos"])


@query(HARVEST + """
    SELECT document, parameter, value, status, year, min(pos) AS pos FROM h GROUP BY 1, 2, 3, 4, 5
""")
def drop_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of a document's rows that say the same."""
    return drop_repeats(harvest(spark, sf_dir).drop("discount"), "document", "pos", [])


@query(HARVEST + """
    SELECT document, pos, min(value) OVER w <> max(value) OVER w AS contested FROM h WINDOW w AS (PARTITION BY document, parameter, status, year)
""")
def contested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which values another row of the same address contradicts."""
    return contested(harvest(spark, sf_dir), ["document", "parameter", "status", "year"], "value").select("document", "pos", "contested")


def _reasons() -> Column:
    return F.filter(F.array(F.when(F.col("discount") == 0.0, "open:year"), F.when(F.col("discount") >= 0.1, "conflict")), lambda x: x.isNotNull())


@query(HARVEST + """
    SELECT document, pos, CASE WHEN discount >= 0.1 THEN 'D' WHEN discount = 0.0 THEN 'C' WHEN status = 'F' THEN 'B' ELSE 'A' END AS level FROM h
""")
def trust_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trust level of each value by its reasons and its origin."""
    h = harvest(spark, sf_dir)
    return h.select("document", "pos", trust(_reasons(), F.col("status") == "F").alias("level"))


@query(HARVEST + """
    SELECT document, pos, value FROM h WHERE parameter = 'R' AND status = 'F' AND discount < 0.1 AND discount <> 0.0 ORDER BY document, pos LIMIT 50 OFFSET 10
""")
def find_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the values of one parameter and coordinate down to a level."""
    h = harvest(spark, sf_dir).withColumn("level", trust(_reasons(), F.col("status") == "F"))
    return find(h, parameter="R", worst="B", coordinates={"status": "F"}, limit=50, offset=10, order=["document", "pos"]).select("document", "pos", "value")


@query(HARVEST + """SELECT document, count(*) AS n_values, count(DISTINCT parameter) AS parameters FROM h GROUP BY 1""")
def documents_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and distinct parameters per document."""
    return harvest(spark, sf_dir).groupBy("document").agg(F.count("*").alias("n_values"), F.count_distinct("parameter").alias("parameters"))


@query(HARVEST + """
    , c AS (SELECT parameter, year, count(*) AS n FROM h GROUP BY 1, 2),
    g AS (SELECT parameter, list(year || '=' || n ORDER BY n DESC, year) AS years FROM c GROUP BY 1)
    SELECT h.parameter, count(*) AS n_values, count(DISTINCT document) AS documents, any_value(years) AS years FROM h JOIN g USING (parameter) GROUP BY 1
""")
def parameters_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per parameter: values, documents, and the years by frequency."""
    h = harvest(spark, sf_dir)
    base = h.groupBy("parameter").agg(F.count("*").alias("n_values"), F.count_distinct("document").alias("documents"))
    return base.join(histogram(h, ["parameter"], "year", "years"), "parameter")


@query(HARVEST + """
    , c AS (SELECT parameter, status, count(*) AS n FROM h GROUP BY 1, 2)
    SELECT parameter, list(status || '=' || n ORDER BY n DESC, status) AS units FROM c GROUP BY 1
""")
def unit_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of each parameter by frequency."""
    return histogram(harvest(spark, sf_dir), ["parameter"], "status", "units")


def states(rows: DataFrame, spec: DataFrame, documents: DataFrame) -> DataFrame:
    """(document, parameter, state) for every document and every parameter of the small spec.

    read: a value is there; refused: only values that were not accepted; silent: nothing. The spec is attached to each
    document as an array, so no cross join is planned.
    """
    cells = _cells(spec, documents)
    counted = rows.groupBy("document", "parameter").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("refused"))
    state = F.when(F.col("accepted") > 0, "read").when(F.col("refused") > 0, "refused").otherwise("silent")
    return cells.join(counted, ["document", "parameter"], "left").select("document", "parameter", state.alias("state"))


#: Parameters of a spec at most; they come to the driver as one array.
SPEC = 10_000


def _cells(spec: DataFrame, documents: DataFrame) -> DataFrame:
    """(document, parameter) of every document and every parameter."""
    names = sorted(r["parameter"] for r in spec.select("parameter").where(F.col("parameter").isNotNull()).distinct().limit(SPEC + 1).collect())
    if len(names) > SPEC:
        raise ValueError(f"a spec of more than {SPEC} parameters")
    listed = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    return documents.select("document").distinct().select("document", F.explode(listed).alias("parameter"))


def state_ladder(recorded: DataFrame, spec: DataFrame, documents: DataFrame) -> DataFrame:
    """(document, parameter, state): the strongest state recorded, in the order read, unbacked, exhausted, unanswered,
    unstated; never_asked where a document has records but none of the parameter; not_recorded where it has none.

    recorded is (document, parameter, state), documents (document, stamped).
    """
    order = F.array(*map(F.lit, LADDER))
    best = recorded.groupBy("document", "parameter").agg(F.min(F.when(F.array_position(order, F.col("state")) > 0, F.array_position(order, F.col("state")))).alias("at"))
    cells = _cells(spec, documents).join(documents.select("document", "stamped"), "document")
    state = F.when(F.col("at").isNotNull(), F.element_at(order, F.col("at").cast("int"))).when(F.col("stamped"), "never_asked").otherwise("not_recorded")
    return cells.join(best, ["document", "parameter"], "left").select("document", "parameter", state.alias("state"))


_STATES = HARVEST + """
    , d AS (SELECT DISTINCT document FROM h), p AS (SELECT DISTINCT parameter FROM h),
    c AS (SELECT document, parameter, count(*) FILTER (discount < 0.05) AS a, count(*) FILTER (NOT discount < 0.05) AS r FROM h GROUP BY 1, 2),
    s AS (SELECT d.document, p.parameter, CASE WHEN a > 0 THEN 'read' WHEN r > 0 THEN 'refused' ELSE 'silent' END AS state
          FROM d CROSS JOIN p LEFT JOIN c ON c.document = d.document AND c.parameter = p.parameter)
"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harvest(spark, sf_dir).withColumn("accepted", F.col("discount") < 0.05)
    return states(h, h.select("parameter"), h)


@query(_STATES + "SELECT * FROM s")
def parameter_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every cell of documents by parameters."""
    return _states(spark, sf_dir)


@query(_STATES + "SELECT parameter, state, count(*) AS n FROM s GROUP BY 1, 2")
def coverage_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per parameter and state."""
    return _states(spark, sf_dir).groupBy("parameter", "state").agg(F.count("*").alias("n"))


@query(_STATES + """
    SELECT document, max(state) FILTER (parameter = 'A') AS A, max(state) FILTER (parameter = 'N') AS N, max(state) FILTER (parameter = 'R') AS R FROM s GROUP BY 1
""")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, one column per parameter."""
    return _states(spark, sf_dir).groupBy("document").pivot("parameter", ["A", "N", "R"]).agg(F.max("state"))


@query(HARVEST + """
    SELECT document, count(*) FILTER (discount < 0.05) AS tuples, count(*) FILTER (NOT discount < 0.05) AS refusals,
           count(*) FILTER (discount < 0.05 AND status = 'F') AS image_origin, count(*) FILTER (discount >= 0.1) AS level_d FROM h GROUP BY 1
""")
def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a document's harvest holds, by conditional counts in one pass."""
    ok = F.col("discount") < 0.05
    return harvest(spark, sf_dir).groupBy("document").agg(
        F.count_if(ok).alias("tuples"), F.count_if(~ok).alias("refusals"), F.count_if(ok & (F.col("status") == "F")).alias("image_origin"), F.count_if(F.col("discount") >= 0.1).alias("level_d"))


def family(reason: Column, patterns: dict[str, str]) -> Column:
    """The first family whose pattern a reason matches, else `other`."""
    chain = None
    for name, pattern in patterns.items():
        chain = F.when(reason.rlike(pattern), name) if chain is None else chain.when(reason.rlike(pattern), name)
    return chain.otherwise("other")


@query("""
    SELECT CASE WHEN regexp_matches(event_type, '^(view|click)') THEN 'seen' WHEN regexp_matches(event_type, 'err') THEN 'broken' ELSE 'other' END AS family,
           count(*) AS n FROM events GROUP BY 1
""")
def refusal_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons grouped by an ordered list of patterns."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(family(F.col("event_type"), {"seen": "^(view|click)", "broken": "err"}).alias("family")).agg(F.count("*").alias("n"))


@query(HARVEST + """SELECT document, pos, status, discount FROM h WHERE NOT discount < 0.05 AND parameter = 'N' ORDER BY document, pos LIMIT 100""")
def refusal_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of refusals of one parameter."""
    h = harvest(spark, sf_dir).where("NOT discount < 0.05 AND parameter = 'N'")
    return h.orderBy("document", "pos").limit(100).select("document", "pos", "status", "discount")


@query(HARVEST + """
    SELECT parameter, status, count(*) AS tuples, count(DISTINCT document) AS plans, min_by(value, (document, pos)) AS example FROM h GROUP BY 1, 2
""")
def unit_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units as written per parameter, with the number of documents and a first example."""
    return harvest(spark, sf_dir).groupBy("parameter", "status").agg(F.count("*").alias("tuples"), F.count_distinct("document").alias("plans"), F.min_by("value", F.struct("document", "pos")).alias("example"))


@query(HARVEST + """
    SELECT document, pos, y AS year, y NOT IN (year, year + 2) AS derived FROM (SELECT document, pos, year, unnest(range(year, year + 3)) AS y FROM h)
""")
def span_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of years as one row per year; the inner ones are derived."""
    h = harvest(spark, sf_dir).select("document", "pos", "year", F.explode(F.sequence("year", F.col("year") + 2)).alias("y"))
    return h.select("document", "pos", F.col("y").alias("year"), (~F.col("y").isin(F.col("year"), F.col("year") + 2)).alias("derived"))


@query(HARVEST + """
    SELECT document, status, parameter, sum(value) AS total, max(value) AS largest, count(*) AS parts,
           count(*) >= 3 AND abs(max(value) - (sum(value) - max(value))) <= 0.5 AS holds_sum FROM h GROUP BY 1, 2, 3
""")
def open_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of values to be summed, and whether the largest is already the sum of the others."""
    g = harvest(spark, sf_dir).groupBy("document", "status", "parameter").agg(F.sum("value").alias("total"), F.max("value").alias("largest"), F.count("*").alias("parts"))
    return g.withColumn("holds_sum", (F.col("parts") >= 3) & (F.abs(F.col("largest") - (F.col("total") - F.col("largest"))) <= 0.5))


@query(HARVEST + """
    SELECT document, parameter, arg_max(pos, (value, -pos)) AS pos, max(value) AS value FROM h GROUP BY 1, 2
""")
def most_precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per statement: the one that stands first by a measure."""
    return harvest(spark, sf_dir).groupBy("document", "parameter").agg(F.max_by("pos", F.struct("value", -F.col("pos"))).alias("pos"), F.max("value").alias("value"))


@query(HARVEST + """
    SELECT document, parameter || ' ' || status || ' ' || year || ' = ' || CAST(value AS BIGINT) AS line, count(*) AS n FROM h GROUP BY 1, 2
""")
def value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct search lines of values."""
    h = harvest(spark, sf_dir)
    line = F.concat_ws(" ", "parameter", "status", F.col("year").cast("string"), F.lit("="), F.col("value").cast("long").cast("string"))
    return h.groupBy("document", line.alias("line")).agg(F.count("*").alias("n"))


@query(HARVEST + """
    , r AS (SELECT document, pos, parameter, CASE WHEN status = 'F' THEN value * 1000 ELSE value END AS value, CASE WHEN status = 'F' THEN 'kWh' ELSE 'MWh' END AS unit, CASE WHEN pos % 5 <> 0 THEN value END AS target FROM h)
    SELECT a.document, a.pos, bool_or(CASE WHEN a.target IS NOT NULL AND b.target IS NOT NULL THEN a.target <> b.target ELSE a.value <> b.value OR a.unit <> b.unit END) AS contested
    FROM r a JOIN r b ON b.document = a.document AND b.parameter = a.parameter GROUP BY 1, 2
""")
def contested_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in two units, contested by their converted values."""
    final = F.col("status") == "F"
    r = harvest(spark, sf_dir).withColumn("target", F.when(F.col("pos") % 5 != 0, F.col("value"))).withColumn("unit", F.when(final, "kWh").otherwise("MWh")).withColumn("value", F.when(final, F.col("value") * 1000).otherwise(F.col("value")))
    return contested(r, ["document", "parameter"], "value", "unit", "target").select("document", "pos", "contested")


@query(HARVEST + """
    , d AS (SELECT document, document % 7 <> 0 AS stamped FROM h GROUP BY 1), p AS (SELECT unnest(['A', 'N', 'R', 'X']) AS parameter),
    s AS (SELECT document, parameter, min(CASE pos % 6 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 END) AS k FROM h WHERE document % 7 <> 0 GROUP BY 1, 2)
    SELECT d.document, p.parameter, CASE k WHEN 1 THEN 'read' WHEN 2 THEN 'unbacked' WHEN 3 THEN 'exhausted' WHEN 4 THEN 'unanswered' WHEN 5 THEN 'unstated' ELSE CASE WHEN stamped THEN 'never_asked' ELSE 'not_recorded' END END AS state
    FROM d CROSS JOIN p LEFT JOIN s ON s.document = d.document AND s.parameter = p.parameter
""")
def parameter_state_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest state of every cell, with those never asked and never recorded told apart."""
    h = harvest(spark, sf_dir)
    names = F.array(*map(F.lit, ("unstated", "unanswered", "exhausted", "unbacked", "read", "other")))
    recorded = h.where("document % 7 <> 0").select("document", "parameter", F.element_at(names, (F.col("pos") % 6 + 1).cast("int")).alias("state"))
    spec = spark.createDataFrame([(p,) for p in "ANRX"], "parameter string")
    documents = h.select("document").distinct().withColumn("stamped", F.col("document") % 7 != 0)
    return state_ladder(recorded, spec, documents)
