"""Reports over harvests and traces: counts of states, what is open, work lists, gates, requests and their costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators.claims import OPEN
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked

#: States of a coordinate that was not asked for.
NOT_ASKED = ("derived", "out_of_slice")


def coordinates(rows: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """(keep..., axis, value, state, raw): one row per coordinate of a row; each axis has columns name, name_state, name_raw."""
    each = F.array(*[F.struct(F.lit(n).alias("axis"), F.col(n).cast("string").alias("value"), F.col(f"{n}_state").alias("state"), F.col(f"{n}_raw").cast("string").alias("raw")) for n in names])
    return rows.select(*keep, F.explode(each).alias("c")).select(*keep, "c.*")


def states_by_axis(cells: DataFrame) -> DataFrame:
    """(parameter, axis, state, n) of coordinates that have a state."""
    return cells.where(F.col("state").isNotNull()).groupBy("parameter", "axis", "state").agg(F.count("*").alias("n"))


def hardest(cells: DataFrame) -> DataFrame:
    """(document, open, asked, share): documents by their share of asked coordinates that are open."""
    asked = F.col("state").isNotNull() & ~F.col("state").isin(*NOT_ASKED)
    g = cells.groupBy("document").agg(F.count_if(asked & F.col("state").isin(*OPEN)).alias("open"), F.count_if(asked).alias("asked"))
    return g.where("asked > 0").withColumn("share", F.round(F.col("open") / F.col("asked"), 6))


def foreign_wordings(cells: DataFrame, listed: DataFrame) -> DataFrame:
    """(axis, value, wording, n): wordings of read coordinates that no list holds."""
    read = cells.where((F.col("state") == "read") & F.col("raw").isNotNull())
    return read.join(checked(listed.select("axis", F.col("wording").alias("raw"))), ["axis", "raw"], "left_anti").groupBy("axis", "value", F.col("raw").alias("wording")).agg(F.count("*").alias("n"))


def open_coordinates(cells: DataFrame) -> DataFrame:
    """(document, parameter, axis, rows): coordinates that some row left open."""
    return cells.where(F.col("state").isin(*OPEN)).groupBy("document", "parameter", "axis").agg(F.count("*").alias("rows"))


def missing_fields(cells: DataFrame, stated: DataFrame) -> DataFrame:
    """Cells (document, parameter) without a row whose last state is open or was never recorded.

    stated is (document, parameter, state, at); cells are all cells without those that have a row.
    """
    last = stated.groupBy("document", "parameter").agg(F.max_by("state", "at").alias("state"))
    return cells.join(last, ["document", "parameter"], "left").where(F.col("state").isNull() | F.col("state").isin(*OPEN)).select("document", "parameter", "state")


def rows_to_review(rows: DataFrame, levels: list[str], once: bool = True) -> DataFrame:
    """Rows at the levels that no second reading has seen."""
    out = rows.where(F.col("level").isin(*levels))
    return out.where(~F.exists("flags", lambda f: F.startswith(f, F.lit("review:")))) if once else out


def curator_list(rows: DataFrame, levels: list[str], reason: str = "") -> DataFrame:
    """Rows at the levels, or of them those with a reason that begins so, with their place: most reasons first, then the page."""
    out = rows.where(F.col("level").isin(*levels))
    if reason:
        out = out.where(F.exists("reasons", lambda r: F.startswith(r, F.lit(reason))))
    w = Window.partitionBy("document").orderBy(F.desc(F.size("reasons")), F.coalesce("page", F.lit(0)), "pos")
    return out.withColumn("place", F.row_number().over(w))


def shortfalls(report: DataFrame, floors: dict[str, float]) -> DataFrame:
    """(measure, got, floor): measures below their floor. A share that nobody can count falls short as well."""
    limits = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).cast("double").alias("got"), F.lit(float(v)).alias("floor")) for k, v in floors.items()])
    return report.select(F.explode(limits).alias("x")).select("x.*").where(F.col("got").isNull() | (F.col("got") < F.col("floor")))


def moved_too_far(kinds: DataFrame, held: Column, ceilings: dict[str, float]) -> DataFrame:
    """(kind, n, share, ceiling): kinds of change whose share of the baseline's rows exceeds the ceiling; without a baseline
    every ceiling is exceeded. kinds is one row of counts by kind."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n"), F.try_divide(F.col(k), held).alias("share"), F.lit(float(v)).alias("ceiling")) for k, v in ceilings.items()])
    return kinds.select(F.explode(each).alias("x")).select("x.*").where(F.col("share").isNull() | (F.col("share") > F.col("ceiling")))


def refusal_of(failed: DataFrame, key: str, reason: str, known: list[str]) -> DataFrame:
    """(key, refusal): the reason of most refusals of a question; checks of one's own by one name, unknown ones as other."""
    n = failed.groupBy(key, reason).agg(F.count("*").alias("n"))
    most = n.groupBy(key).agg(F.min_by(reason, F.struct(-F.col("n"), F.col(reason))).alias("r"))
    return most.select(key, F.when(F.startswith("r", F.lit("check:")), "own_check").when(F.col("r").isin(*known), F.col("r")).otherwise("other").alias("refusal"))


def new_kinds(report: DataFrame, against: DataFrame, kind: str) -> DataFrame:
    """Kinds of violation that the other report hasn't."""
    return report.select(kind).distinct().join(against.select(kind).distinct(), kind, "left_anti")


def agreement(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """(axis, hit, miss) of read coordinates (owner, axis, value) against a truth (owner, axis, wanted), on its owners only."""
    both = rows.join(checked(truth), ["owner", "axis"])
    right = F.col("value").eqNullSafe(F.col("wanted"))
    return both.groupBy("axis").agg(F.count_if(right).alias("hit"), F.count_if(~right).alias("miss"))


def trace_costs(events: DataFrame) -> DataFrame:
    """Requests, milliseconds and faults per document of trace events (document, t, ms, kind)."""
    t = F.col("t")
    return events.groupBy("document").agg(F.count_if(t == "rows").alias("rows"), F.count_if(t == "field").alias("field"), F.sum(F.when(t.isin("rows", "field"), F.coalesce("ms", F.lit(0))).otherwise(0)).alias("ms"),
                                          F.count_if(t == "drop").alias("drops"), F.count_if((t == "error") & (F.col("kind") == "unparsable")).alias("unparsable"))


def keep_requests(requests: DataFrame, kinds: list[str] | None = None, owners: list | None = None, contains: str | None = None) -> DataFrame:
    """Requests of some kinds and owners whose text contains a word; what isn't given lets all through."""
    out = requests
    if kinds:
        out = out.where(F.col("kind").isin(*kinds))
    if owners:
        out = out.where(F.col("owner").isin(*owners))
    if contains:
        out = out.where(F.contains(F.lower("text"), F.lit(contains.lower())))
    return out


def chains(requests: DataFrame) -> DataFrame:
    """requests with their chain: those of one parameter and passage, from each find up to the next."""
    w = Window.partitionBy("parameter", "owner").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return requests.withColumn("chain", F.sum((F.col("kind") == "find").cast("int")).over(w))


def facts_of(requests: DataFrame, by: list[str]) -> DataFrame:
    """(by..., n, longest, beyond): how many requests, the furthest position that an answer came at, and how many lie past
    the third; partial counts of traces are merged by summing them."""
    return requests.groupBy(*by).agg(F.count("*").alias("n"), F.max("position").alias("longest"), F.count_if(F.col("position") > 3).alias("beyond"))


def joined_facts(facts: DataFrame, by: list[str]) -> DataFrame:
    """Facts of several traces as one."""
    return facts.groupBy(*by).agg(F.sum("n").alias("n"), F.max("longest").alias("longest"), F.sum("beyond").alias("beyond"))


def stale_keys(stamp: Column, current: Column) -> Column:
    """Keys of two maps that differ, sorted; a key on one side only differs."""
    merged = F.map_zip_with(stamp, current, lambda k, a, b: ~a.eqNullSafe(b))
    return F.array_sort(F.map_keys(F.map_filter(merged, lambda k, differs: differs)))


def documents_to_harvest(documents: DataFrame, stamps: DataFrame, current: Column, force_stale: bool = True) -> DataFrame:
    """(document, why): documents without a harvest, without a stamp, or with a stale one."""
    both = documents.select("document").join(stamps, "document", "left")
    why = F.when(F.col("harvested").isNull(), "missing").when(F.col("stamp").isNull(), "unstamped").when(F.lit(force_stale) & (F.size(stale_keys(F.col("stamp"), current)) > 0), "stale")
    return both.withColumn("why", why).where(F.col("why").isNotNull()).select("document", "why")


def numbers_printed(cells: DataFrame, frames: DataFrame, by: str) -> DataFrame:
    """(by, tables, share): the mean share of a table's distinct numbers that its frame prints. cells and frames hold arrays
    of canonical numbers per table."""
    both = cells.join(frames, "table")
    share = F.try_divide(F.size(F.array_intersect("numbers", "printed")), F.size(F.array_distinct("numbers")))
    return both.withColumn("share", share).groupBy(by).agg(F.count("share").alias("tables"), F.round(F.avg("share"), 6).alias("share"))


def name_census(names: DataFrame, name: str) -> DataFrame:
    """(key, spellings, n): names by a key without case, legal form and marks."""
    key = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.col(name)), r"\b(gmbh|ag|kg|inc|ltd)\b", " "), r"[^\p{L}\p{N}]+", " "))
    return names.groupBy(key.alias("key")).agg(F.array_sort(F.collect_set(name)).alias("spellings"), F.count("*").alias("n"))


_CELLS = HARVEST + """
    , r AS (SELECT document, pos, parameter, CAST(year AS VARCHAR) AS year, CASE pos % 7 WHEN 0 THEN 'unanswered' WHEN 1 THEN 'unbacked' WHEN 2 THEN 'derived' ELSE 'read' END AS year_state, 'in ' || (year % 10) AS year_raw,
                   status, CASE WHEN discount = 0.03 THEN 'exhausted' WHEN discount < 0.03 THEN 'unstated' ELSE 'read' END AS status_state, CASE WHEN pos % 4 = 0 THEN lower(status) END AS status_raw FROM h),
    c AS (SELECT document, pos, parameter, 'year' AS axis, year AS value, year_state AS state, year_raw AS raw FROM r UNION ALL SELECT document, pos, parameter, 'status', status, status_state, status_raw FROM r)
"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos, d = F.col("pos"), F.col("discount")
    r = harvest(spark, sf_dir).select(
        "document", "pos", "parameter", "year", F.when(pos % 7 == 0, "unanswered").when(pos % 7 == 1, "unbacked").when(pos % 7 == 2, "derived").otherwise("read").alias("year_state"),
        F.concat(F.lit("in "), (F.col("year") % 10).cast("string")).alias("year_raw"), "status", F.when(d == 0.03, "exhausted").when(d < 0.03, "unstated").otherwise("read").alias("status_state"), F.when(pos % 4 == 0, F.lower("status")).alias("status_raw"))
    return coordinates(r, ["year", "status"], ["document", "pos", "parameter"])


@query(_CELLS + "SELECT parameter, axis, state, count(*) AS n FROM c GROUP BY 1, 2, 3")
def states_per_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all coordinates by parameter and axis."""
    return states_by_axis(_cells(spark, sf_dir))


@query(_CELLS + """SELECT document, count(*) FILTER (state IN ('exhausted', 'unanswered', 'unbacked')) AS open, count(*) FILTER (state <> 'derived') AS asked,
    round(count(*) FILTER (state IN ('exhausted', 'unanswered', 'unbacked')) / count(*) FILTER (state <> 'derived'), 6) AS share FROM c GROUP BY 1 HAVING count(*) FILTER (state <> 'derived') > 0""")
def hardest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their share of open coordinates."""
    return hardest(_cells(spark, sf_dir))


@query(_CELLS + "SELECT axis, value, raw AS wording, count(*) AS n FROM c WHERE state = 'read' AND raw IS NOT NULL AND NOT (axis = 'status' AND raw = 'f') AND NOT (axis = 'year' AND raw IN ('in 5', 'in 7')) GROUP BY 1, 2, 3")
def wordings_off_the_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wordings of read coordinates that no list holds."""
    listed = spark.createDataFrame([("status", "f"), ("year", "in 5"), ("year", "in 7")], "axis string, wording string")
    return foreign_wordings(_cells(spark, sf_dir), listed)


@query(_CELLS + "SELECT document, parameter, axis, count(*) AS rows FROM c WHERE state IN ('exhausted', 'unanswered', 'unbacked') GROUP BY 1, 2, 3")
def open_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates to ask again."""
    return open_coordinates(_cells(spark, sf_dir))


@query(HARVEST + """
    , d AS (SELECT DISTINCT document FROM h), p AS (SELECT unnest(['A', 'N', 'R', 'X']) AS parameter), s AS (SELECT document, parameter, max_by(CASE pos % 3 WHEN 0 THEN 'unstated' WHEN 1 THEN 'exhausted' ELSE 'unbacked' END, pos) AS state FROM h WHERE discount >= 0.05 GROUP BY 1, 2)
    SELECT d.document, p.parameter, s.state FROM d CROSS JOIN p LEFT JOIN s ON s.document = d.document AND s.parameter = p.parameter
    WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.document = d.document AND h.parameter = p.parameter AND h.discount < 0.05) AND (s.state IS NULL OR s.state <> 'unstated')
""")
def missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters that a document has no row of and did not deny."""
    from foliant.operators.values import _cells as all_cells

    h = harvest(spark, sf_dir)
    spec = spark.createDataFrame([(p,) for p in "ANRX"], "parameter string")
    cells = all_cells(spec, h).join(h.where("discount < 0.05").select("document", "parameter").distinct(), ["document", "parameter"], "left_anti")
    state = F.when(F.col("pos") % 3 == 0, "unstated").when(F.col("pos") % 3 == 1, "exhausted").otherwise("unbacked")
    return missing_fields(cells, h.where("discount >= 0.05").select("document", "parameter", state.alias("state"), F.col("pos").alias("at")))


_LEVELLED = HARVEST + """
    , l AS (SELECT document, pos, CASE WHEN discount >= 0.08 THEN 'D' WHEN discount >= 0.05 THEN 'C' ELSE 'A' END AS level, pos % 3 = 0 AS seen, 1 + pos % 2 AS reasons, pos % 9 AS page FROM h)
"""


def _levelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos, d = F.col("pos"), F.col("discount")
    return harvest(spark, sf_dir).select(
        "document", "pos", F.when(d >= 0.08, "D").when(d >= 0.05, "C").otherwise("A").alias("level"), F.when(pos % 3 == 0, F.array(F.lit("review:agrees"))).otherwise(F.array(F.lit("read_off"))).alias("flags"),
        F.when(pos % 2 == 0, F.array(F.lit("open:year"))).otherwise(F.array(F.lit("conflict"), F.lit("open:x"))).alias("reasons"), (pos % 9).alias("page"))


@query(_LEVELLED + "SELECT document, pos FROM l WHERE level IN ('C', 'D') AND NOT seen")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a second reading is worth."""
    return rows_to_review(_levelled(spark, sf_dir), ["C", "D"]).select("document", "pos")


@query(_LEVELLED + "SELECT document, pos, row_number() OVER (PARTITION BY document ORDER BY reasons DESC, page, pos) AS place FROM l WHERE level = 'D' AND reasons = 2")
def curation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a curator sees of each document, worst first."""
    return curator_list(_levelled(spark, sf_dir), ["D"], "conflict").select("document", "pos", "place")


@query("""
    WITH r AS (SELECT avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END) AS precision, avg(CASE WHEN toxic = 1 THEN 1.0::DOUBLE ELSE 0 END) AS recall, CAST(NULL AS DOUBLE) AS coverage FROM labels),
    u AS (SELECT 'precision' AS measure, precision AS got, 0.5::DOUBLE AS floor FROM r UNION ALL SELECT 'recall', recall, 0.9 FROM r UNION ALL SELECT 'coverage', coverage, 0.1 FROM r)
    SELECT measure, round(got, 6) AS got, floor FROM u WHERE got IS NULL OR got < floor
""")
def gates_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floors that a report falls short of."""
    r = table(spark, sf_dir, "labels").agg(F.avg((F.col("quality") == 1).cast("double")).alias("precision"), F.avg((F.col("toxic") == 1).cast("double")).alias("recall"), F.lit(None).cast("double").alias("coverage"))
    return shortfalls(r, {"precision": 0.5, "recall": 0.9, "coverage": 0.1}).withColumn("got", F.round("got", 6))


@query(HARVEST + """
    , k AS (SELECT count(*) AS held, count(*) FILTER (discount > 0.07) AS changed, count(*) FILTER (discount = 0.0) AS gone FROM h),
    u AS (SELECT 'changed' AS kind, changed AS n, changed / held AS share, 0.2::DOUBLE AS ceiling FROM k UNION ALL SELECT 'gone', gone, gone / held, 0.5 FROM k)
    SELECT kind, n, round(share, 6) AS share, ceiling FROM u WHERE share > ceiling
""")
def ceilings_exceeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of change beyond their ceiling."""
    k = harvest(spark, sf_dir).agg(F.count("*").alias("held"), F.count_if(F.col("discount") > 0.07).alias("changed"), F.count_if(F.col("discount") == 0.0).alias("gone"))
    return moved_too_far(k, F.col("held"), {"changed": 0.2, "gone": 0.5}).withColumn("share", F.round("share", 6))


@query(HARVEST + """
    , f AS (SELECT document, CASE pos % 4 WHEN 0 THEN 'check:sum' WHEN 1 THEN 'quote_too_short' WHEN 2 THEN 'odd' ELSE 'wrong_type' END AS reason FROM h),
    n AS (SELECT document, reason, count(*) AS n FROM f GROUP BY 1, 2), m AS (SELECT document, arg_min(reason, (-n, reason)) AS r FROM n GROUP BY 1)
    SELECT document, CASE WHEN starts_with(r, 'check:') THEN 'own_check' WHEN r IN ('quote_too_short', 'wrong_type') THEN r ELSE 'other' END AS refusal FROM m
""")
def main_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reason that most refusals of a document came to."""
    names = F.array(*map(F.lit, ("check:sum", "quote_too_short", "odd", "wrong_type")))
    f = harvest(spark, sf_dir).select("document", F.element_at(names, (F.col("pos") % 4 + 1).cast("int")).alias("reason"))
    return refusal_of(f, "document", "reason", ["quote_too_short", "wrong_type"])


@query("SELECT DISTINCT event_type AS kind FROM events WHERE user_id % 2 = 0 AND event_type NOT IN (SELECT event_type FROM events WHERE user_id = 7 AND value > 120)")
def kinds_not_seen_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds in one report that the other hasn't."""
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "kind")
    return new_kinds(e.where("user_id % 2 = 0"), e.where("user_id = 7 AND value > 120"), "kind")


@query(HARVEST + """
    , c AS (SELECT document AS owner, 'status' AS axis, status AS value FROM h UNION ALL SELECT document, 'year', CAST(year AS VARCHAR) FROM h),
    t AS (SELECT document AS owner, 'status' AS axis, min(status) AS wanted FROM h WHERE document % 5 = 0 GROUP BY 1 UNION ALL SELECT document, 'year', CAST(max(year) AS VARCHAR) FROM h WHERE document % 5 = 1 GROUP BY 1)
    SELECT axis, count(*) FILTER (value = wanted) AS hit, count(*) FILTER (value <> wanted) AS miss FROM c JOIN t USING (owner, axis) GROUP BY 1
""")
def truth_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates against a truth that names some owners."""
    h = harvest(spark, sf_dir).withColumnRenamed("document", "owner")
    year = F.col("year").cast("string")
    c = h.select("owner", F.lit("status").alias("axis"), F.col("status").alias("value")).unionByName(h.select("owner", F.lit("year").alias("axis"), year.alias("value")))
    t = h.where("owner % 5 = 0").groupBy("owner").agg(F.min("status").alias("wanted")).select("owner", F.lit("status").alias("axis"), "wanted")
    t = t.unionByName(h.where("owner % 5 = 1").groupBy("owner").agg(F.max("year").cast("string").alias("wanted")).select("owner", F.lit("year").alias("axis"), "wanted"))
    return agreement(c, t)


_EVENTS = """
    WITH e AS (SELECT user_id AS document, CASE event_type WHEN 'view' THEN 'rows' WHEN 'click' THEN 'field' WHEN 'error' THEN 'error' ELSE 'drop' END AS t, CAST(floor(value) AS BIGINT) AS ms, CASE WHEN event_id % 2 = 0 THEN 'unparsable' ELSE 'other' END AS kind, event_id FROM events)
"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("document"), F.when(t == "view", "rows").when(t == "click", "field").when(t == "error", "error").otherwise("drop").alias("t"), F.floor("value").alias("ms"),
                                                 F.when(F.col("event_id") % 2 == 0, "unparsable").otherwise("other").alias("kind"), "event_id")


@query(_EVENTS + """SELECT document, count(*) FILTER (t = 'rows') AS rows, count(*) FILTER (t = 'field') AS field, CAST(sum(CASE WHEN t IN ('rows', 'field') THEN ms ELSE 0 END) AS BIGINT) AS ms,
    count(*) FILTER (t = 'drop') AS drops, count(*) FILTER (t = 'error' AND kind = 'unparsable') AS unparsable FROM e GROUP BY 1""")
def document_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and milliseconds of each document's trace."""
    return trace_costs(_events(spark, sf_dir))


@query("""
    SELECT event_id, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id % 10, event_id % 3 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS chain FROM events WHERE event_type IN ('view', 'click', 'error')
""")
def request_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of one value, from its find on."""
    t = F.col("event_type")
    r = table(spark, sf_dir, "events").select(F.col("event_id").alias("at"), F.when(t == "view", "find").otherwise(t).alias("kind"), (F.col("user_id") % 10).alias("parameter"), (F.col("event_id") % 3).alias("owner"))
    return chains(keep_requests(r, ["find", "click", "error"])).select(F.col("at").alias("event_id"), "chain")


@query("""SELECT event_type AS kind, count(*) AS n, max(event_id % 11) AS longest, count(*) FILTER (event_id % 11 > 3) AS beyond FROM events GROUP BY 1""")
def measured_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all traces, merged from those of each."""
    r = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 8).alias("trace"), (F.col("event_id") % 11).alias("position"))
    return joined_facts(facts_of(r, ["trace", "kind"]), ["kind"])


@query("""
    SELECT o_orderkey AS document, CASE WHEN o_orderkey % 5 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'unstamped' ELSE 'stale' END AS why FROM orders
    WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderstatus <> 'F' OR o_orderkey % 3 = 0
""")
def harvest_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to read again, and why."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k.alias("document"), "o_orderstatus")
    d = F.col("document")
    stamp = F.when(d % 7 != 0, F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("spec"), F.when(d % 3 == 0, "old").otherwise("new")))
    stamps = o.where("document % 5 <> 0").select("document", F.lit(True).alias("harvested"), stamp.alias("stamp"))
    return documents_to_harvest(o, stamps, F.create_map(F.lit("status"), F.lit("F"), F.lit("spec"), F.lit("new")))


@query("""
    WITH c AS (SELECT l_orderkey AS t, list(CAST(l_quantity AS BIGINT)) AS numbers, list(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber <= 2) AS printed FROM lineitem GROUP BY 1)
    SELECT o_orderstatus AS class, count(*) AS tables, round(avg(len(list_intersect(list_distinct(numbers), coalesce(printed, []))) / len(list_distinct(numbers))), 6) AS share FROM c JOIN orders ON o_orderkey = t GROUP BY 1
""")
def numbers_in_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each table's numbers its frame prints, by class."""
    l = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long")
    c = l.groupBy(F.col("l_orderkey").alias("table")).agg(F.collect_list(q).alias("numbers"), F.collect_list(F.when(F.col("l_linenumber") <= 2, q)).alias("printed"))
    classes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table"), F.col("o_orderstatus").alias("class"))
    return numbers_printed(c.select("table", "numbers").join(classes, "table"), c.select("table", "printed"), "class")


@query(r"""
    WITH n AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN upper(s_name) || ' GmbH' WHEN 1 THEN replace(s_name, '#', ' - ') ELSE s_name END AS name FROM (SELECT s_suppkey, 'Works#' || (s_suppkey % 4) AS s_name FROM supplier))
    SELECT trim(regexp_replace(regexp_replace(lower(name), '\b(gmbh|ag|kg|inc|ltd)\b', ' ', 'g'), '[^\p{L}\p{N}]+', ' ', 'g')) AS key, list_sort(list_distinct(list(name))) AS spellings, count(*) AS n FROM n GROUP BY 1
""")
def organisation_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of organisations by a normalised key."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("Works#"), (k % 4).cast("string"))
    n = table(spark, sf_dir, "supplier").select(F.when(k % 3 == 0, F.concat(F.upper(name), F.lit(" GmbH"))).when(k % 3 == 1, F.replace(name, F.lit("#"), F.lit(" - "))).otherwise(name).alias("name"))
    return name_census(n, "name")
