"""Claims on their way to accepted values: routing, value checks, quotes and where they stand, coordinates, second readings.

lineitem stands in for the claims of a run, documents and their lines for the passages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.values import HARVEST, harvest, same
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked

# States of a coordinate, those that are open, and the state that each event ends in.
OPEN = ("exhausted", "unanswered", "unbacked")
STATE_OF = {"skipped": "unanswered", "answered_not_stated": "unstated", "refused": "unbacked", "parameter_refused": "unbacked", "parameter_cut": "exhausted", "parameter_silent": "unstated"}
#: Decimal places of a converted value.
PLACES = 6


def state_for(event: Column) -> Column:
    """The state that an event leaves a coordinate in; null for an event that no rule names."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in STATE_OF.items() for x in kv]), event)


def route(claims: DataFrame, items: DataFrame, batch: str, index: str) -> tuple[DataFrame, DataFrame]:
    """(claims with their item, claims whose index names none): items (batch, index, item) are joined by their place."""
    both = claims.join(items, [batch, index], "left")
    return both.where("item IS NOT NULL"), both.where("item IS NULL").drop("item")


def batches(items: DataFrame, keys: list[str], order: str, size: str, most: int, room: int) -> DataFrame:
    """items with their batch, from 1: consecutive items of one key share a request while their number and their size allow;
    one that is too long rides alone. A fold over each key's few items."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("batch"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        s = x[size].cast("long")
        joins = (a["batch"] > 0) & (a["n"] < most) & (a["sum"] + s <= room)
        batch = F.when(joins, a["batch"]).otherwise(a["batch"] + 1)
        return F.struct(F.when(joins, a["n"] + 1).otherwise(1).alias("n"), F.when(joins, a["sum"] + s).otherwise(s).alias("sum"), batch.alias("batch"), F.concat(a["out"], F.array(batch)).alias("out"))

    g = items.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, size))).alias("r"))
    g = g.withColumn("b", F.aggregate("r", start, step, lambda a: a["out"]))
    return g.select(*keys, F.inline(F.arrays_zip("r", "b"))).select(*keys, f"r.{order}", f"r.{size}", F.col("b").alias("batch"))


def check_value(claims: DataFrame, spec: DataFrame) -> DataFrame:
    """claims (parameter, value, value_raw, unit, unit_raw) with refusal, unit, unit_raw, value_target, value_uri and flags.

    spec (parameter, kind, units map<string,double>, converts, labels map<string,string>) has one row per parameter; kind is
    number, category or text. A number without an accepted unit keeps its wording and is flagged, never refused. A
    category outside the folded labels is refused; without a class but with a wording it is kept and flagged.
    """
    c = claims.join(checked(spec), "parameter", "left").withColumn("__n", T.canonical_number(F.col("value"))).withColumn("__f", F.try_element_at("units", F.col("unit"))).withColumn("__u", F.try_element_at("labels", T.fold_label(F.trim("value"))))
    wording = F.nullif(F.trim("value_raw"), F.lit(""))
    printed = F.nullif(F.trim("unit_raw"), F.lit(""))
    number, entry = F.col("kind") == "number", F.col("kind") == "category"
    blank = F.coalesce(F.trim("value"), F.lit("")) == ""
    refusal = (
        F.when(number & F.col("__n").isNull(), "value is not a number")
        .when(~number & blank & ~(entry & wording.isNotNull()), F.concat(F.lit("a "), "kind", F.lit(" parameter needs a non-empty string value")))
        .when(entry & ~blank & F.col("__u").isNull(), F.concat(F.lit("value '"), F.trim("value"), F.lit("' not in vocabulary")))
    )
    asked = number & (F.size("units") > 0)
    known, named = F.col("__f").isNotNull(), F.coalesce(printed, F.nullif(F.trim("unit"), F.lit("")))
    flags = F.array_compact(F.array(
        F.when(asked & ~known & named.isNotNull(), F.concat(F.lit("unmapped:unit:"), named)),
        F.when(entry & blank & wording.isNotNull(), F.concat(F.lit("unmapped:value:"), wording)),
        F.when(entry & F.col("__u").isNotNull() & wording.isNotNull() & F.try_element_at("labels", T.fold_label(wording)).isNull(), F.concat(F.lit("mapped:value:"), wording, F.lit("->"), F.col("__u"))),
    ))
    kept = F.col("refusal").isNull()
    out = c.withColumn("refusal", refusal).withColumn("flags", F.when(kept, flags).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("value_target", F.when(kept & asked & known & F.col("converts"), F.round(F.col("__n").cast("double") * F.col("__f"), PLACES)))
    out = out.withColumn("unit_raw", F.when(kept & asked, F.when(known, F.when(printed != F.col("unit"), printed)).otherwise(named)))
    out = out.withColumn("unit", F.when(kept & asked & known, F.col("unit"))).withColumn("value_uri", F.when(kept & entry, F.col("__u")))
    return out.drop("__n", "__f", "__u", "kind", "units", "converts", "labels")


def place_of(quotes: DataFrame, passages: DataFrame, document: str, order: str) -> DataFrame:
    """quotes (document, quote) with the order and the way of the first passage that holds them: shown ones come before the
    rest of the document. passages (document, order, text, shown); each quote meets the passages of its own document."""
    held = quotes.join(passages.select(document, order, "shown", T.flat(F.col("text")).alias("__body")), document).where(F.contains("__body", T.flat(F.col("quote"))) & (F.length(T.flat(F.col("quote"))) >= T.QUOTE_MIN_CHARS))
    first = held.groupBy(*quotes.columns).agg(F.min(F.struct((~F.col("shown")).alias("later"), F.col(order).alias("at"))).alias("__p"))
    joined = quotes.join(first, quotes.columns, "left")
    return joined.select(*quotes.columns, F.col("__p.at").alias("place"), F.when(F.col("__p.later"), "document").when(~F.col("__p.later"), "shown").alias("way"))


def find_again(rows: DataFrame, passages: DataFrame) -> DataFrame:
    """rows (row, document, kind, owner, quote) with `moved`, the owner that carries the quote now.

    Null while the row's own passage carries it, and where no passage of its kind in the document does or more than one.
    """
    near = rows.join(passages.select("document", "kind", F.col("owner").alias("__o"), T.flat(F.col("text")).alias("__body")), ["document", "kind"])
    hit = near.where(F.contains("__body", T.flat(F.col("quote"))))
    found = hit.groupBy("row").agg(F.bool_or(F.col("__o") == F.col("owner")).alias("__own"), F.count("*").alias("__n"), F.min("__o").alias("__to"))
    moved = F.when(~F.col("__own") & (F.col("__n") == 1), F.col("__to"))
    return rows.join(found, "row", "left").withColumn("moved", moved).drop("__own", "__n", "__to")


def reanchor(rows: DataFrame, passages: DataFrame) -> DataFrame:
    """rows with the owner that carries their quote now."""
    return find_again(rows, passages).withColumn("owner", F.coalesce("moved", "owner")).drop("moved")


def longest_run(quotes: DataFrame, segments: DataFrame, key: str, least: int = 3, most: int = 8) -> DataFrame:
    """(quote_id, segment, words, phrase): the segment of the quote's key that shares the longest run of words with it.

    Runs are found as equal words on one diagonal, so quotes and segments meet on (key, word) and never in pairs; ties go
    to the first segment, then to its first run. The phrase is the segment's own words, `most` of them at most.
    """
    spell = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    q = quotes.select("quote_id", key, F.posexplode(F.transform(spell(F.col("quote")), F.lower)).alias("i", "word"))
    s = segments.select(key, "segment", F.posexplode(spell(F.col("text"))).alias("j", "said")).withColumn("word", F.lower("said"))
    met = q.join(s, [key, "word"])
    w = Window.partitionBy("quote_id", "segment", F.col("j") - F.col("i")).orderBy("i")
    runs = met.withColumn("run", F.col("i") - F.row_number().over(w)).withColumn("off", F.col("j") - F.col("i")).groupBy("quote_id", "segment", "off", "run").agg(
        F.count("*").alias("words"), F.min("j").alias("at"), F.transform(F.slice(F.array_sort(F.collect_list(F.struct("j", "said"))), 1, most), lambda x: x["said"]).alias("phrase"))
    best = Window.partitionBy("quote_id").orderBy(F.desc("words"), "segment", "at")
    return runs.where(F.col("words") >= least).withColumn("rank", F.row_number().over(best)).where("rank = 1").select("quote_id", "segment", "words", F.array_join("phrase", " ").alias("phrase"))


def covered(facts: DataFrame, rows: DataFrame) -> DataFrame:
    """facts with `found`: a row of the document and parameter says the value, and all coordinates that the fact gives.

    Both have coordinates as map<string,string>; a fact's are a subset of the row's.
    """
    r = rows.select("document", "parameter", F.col("value").alias("__v"), F.col("coordinates").alias("__c"))
    met = facts.join(r, ["document", "parameter"]).where(same(F.col("value"), F.col("__v")) & F.forall(F.map_entries("coordinates"), lambda e: F.coalesce(F.try_element_at("__c", e["key"]) == e["value"], F.lit(False))))
    return facts.join(met.select("fact").distinct().withColumn("found", F.lit(True)), "fact", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def recheck(rows: DataFrame, name: str) -> DataFrame:
    """rows whose coordinate `name` is emptied where its quote doesn't carry it, with what happened in `outcome`.

    Derived ones stay; one without a quote has no evidence and goes. Years are looked for as a run of digits.
    """
    given, quote, state = F.col(name), F.col(f"{name}_quote"), F.col(f"{name}_state")
    digits = F.coalesce(F.contains(F.concat(F.lit(" "), F.regexp_replace(T.flat(quote), r"\D+", " "), F.lit(" ")), F.concat(F.lit(" "), given.cast("string"), F.lit(" "))), F.lit(False))
    outcome = F.when(given.isNull(), "empty").when(state == "derived", "derived").when(F.coalesce(quote, F.lit("")) == "", "no evidence").when(digits, "read").otherwise("not carried")
    out = rows.withColumn("outcome", outcome)
    gone = F.col("outcome").isin("no evidence", "not carried")
    return out.withColumn(name, F.when(~gone, given)).withColumn(f"{name}_quote", F.when(~gone, quote)).withColumn(f"{name}_state", F.when(gone, "unbacked").when(F.col("outcome") == "empty", F.coalesce(state, F.lit("unanswered"))).when(F.col("outcome") == "read", "read").otherwise(state))


def remap(rows: DataFrame, name: str, vocabulary: DataFrame, overwrite: bool = True) -> DataFrame:
    """rows whose class `name` is looked up again by its wording, with the outcome; vocabulary is (label, uri), folded here."""
    v = vocabulary.select(T.fold_label(F.col("label")).alias("__k"), F.col("uri").alias("__u")).dropDuplicates(["__k"])
    both = rows.withColumn("__k", T.fold_label(F.col(f"{name}_raw"))).join(checked(v), "__k", "left")
    now = F.col(name)
    outcome = (
        F.when(F.col(f"{name}_raw").isNull(), F.when(now.isNull(), "empty").otherwise("no wording")).when(F.col("__u").isNull(), "not listed")
        .when(F.col("__u").eqNullSafe(now), "unchanged").when(now.isNotNull() & F.lit(not overwrite), "not overwritten").otherwise("mapped")
    )
    return both.withColumn("outcome", outcome).withColumn(name, F.when(F.col("outcome") == "mapped", F.col("__u")).otherwise(now)).drop("__k", "__u")


def apply_derived(rows: DataFrame, name: str, derived: DataFrame, key: str) -> DataFrame:
    """Coordinates that the spec decides are written where none was read; derived is (key, name)."""
    d = derived.select(key, F.col(name).alias("__d"))
    both = rows.join(checked(d), key, "left")
    free = (F.coalesce(F.col(f"{name}_state"), F.lit("")) != "read") & F.col("__d").isNotNull()
    return both.withColumn(f"{name}_state", F.when(free, "derived").otherwise(F.col(f"{name}_state"))).withColumn(name, F.when(free, F.col("__d")).otherwise(F.col(name))).drop("__d")


def kept(state: Column, answer: Column, wanted: Column) -> Column:
    """Does a row belong to its parameter: true or false where the coordinate was read, null while it is open."""
    return F.when(wanted.isNotNull() & (state == "read"), answer == wanted)


def agrees(*verdicts: Column) -> Column:
    """A second reading: undecided if any of its checks is, else true if all agree."""
    undecided = F.exists(F.array(*verdicts), lambda v: v.isNull())
    return F.when(~undecided, F.forall(F.array(*verdicts), lambda v: v))


def front_pages(titles: DataFrame, document: str, page: str, extra: int = 1) -> DataFrame:
    """(document, page): page 1, the first page that a title was read on, and `extra` pages after each."""
    first = titles.groupBy(document).agg(F.min(page).alias("__t"))
    starts = F.array_compact(F.array(F.lit(1).cast("long"), F.col("__t").cast("long")))
    return first.select(document, F.explode(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + extra))))).alias(page))


def readings_that_count(rows: DataFrame, field: list[str], ways: dict[str, Column]) -> DataFrame:
    """Per field, the rows of the first way that has any, ways in order."""
    chain = None
    for i, held in enumerate(ways.values()):
        chain = F.when(held, i) if chain is None else chain.when(held, i)
    marked = rows.withColumn("__w", chain)
    return marked.where("__w IS NOT NULL").withColumn("__b", F.min("__w").over(Window.partitionBy(*field))).where("__w = __b").withColumn("way", F.element_at(F.array(*map(F.lit, ways)), F.col("__w") + 1)).drop("__w", "__b")


def pick_one(rows: DataFrame, field: list[str], value: str, located: str, order: str) -> DataFrame:
    """One reading per field: (field, value, others). A reading contained in another of the field never wins; then the most
    sources, one that could be located, the longer text, and the first. Readings of one field are few and are compared
    within an array."""
    per = rows.groupBy(*field, value).agg(F.count("*").alias("n"), F.bool_or(located).alias("l"), F.min(order).alias("o"))
    all_ = per.groupBy(*field).agg(F.collect_list(F.struct(F.col("n"), F.col("l"), F.length(value).alias("len"), (-F.col("o")).alias("o"), F.col(value).alias("v"))).alias("r"))
    free = F.filter("r", lambda x: ~F.exists("r", lambda y: (y["v"] != x["v"]) & F.contains(y["v"], x["v"])))
    ranked = all_.withColumn("r", F.sort_array(free, False))
    return ranked.select(*field, F.element_at("r", 1)["v"].alias(value), (F.size("r") - 1).alias("others"))


_CLAIMS = HARVEST + """
    , c AS (SELECT document, pos, parameter, year, CAST(CAST(value AS BIGINT) AS VARCHAR) AS v, pos % 5 AS five, status FROM h)
"""


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harvest(spark, sf_dir)
    return h.select("document", "pos", "parameter", "year", F.col("value").cast("long").cast("string").alias("v"), (F.col("pos") % 5).alias("five"), "status")


@query(_CLAIMS + """
    , k AS (SELECT document, pos, parameter, CASE WHEN parameter = 'R' THEN CASE five WHEN 0 THEN 'Gas' WHEN 1 THEN ' oil ' WHEN 2 THEN '' WHEN 3 THEN 'wood' END WHEN five = 4 THEN 'x' ELSE v END AS value,
              CASE WHEN parameter = 'R' AND five IN (0, 2) THEN 'Erdgas' END AS value_raw, CASE five WHEN 0 THEN 'kWh' WHEN 1 THEN 'MWh' WHEN 2 THEN 'GJ' END AS unit, CASE five WHEN 1 THEN 'Mwh' WHEN 3 THEN 't' END AS unit_raw, five FROM c)
    SELECT document, pos, CASE WHEN parameter IN ('A', 'N') AND five = 4 THEN 'value is not a number' WHEN parameter = 'R' AND five = 4 THEN 'a category parameter needs a non-empty string value'
             WHEN parameter = 'R' AND five = 3 THEN 'value ''wood'' not in vocabulary' END AS refusal,
           CASE WHEN parameter = 'A' AND five IN (0, 1) THEN unit END AS unit, CASE WHEN parameter = 'A' THEN CASE five WHEN 1 THEN 'Mwh' WHEN 2 THEN 'GJ' WHEN 3 THEN 't' END END AS unit_raw,
           CASE WHEN parameter = 'A' AND five IN (0, 1) THEN CAST(value AS DOUBLE) * CASE five WHEN 0 THEN 1 ELSE 1000 END END AS value_target,
           CASE WHEN parameter = 'R' AND five = 0 THEN 'u/gas' WHEN parameter = 'R' AND five = 1 THEN 'u/oil' END AS value_uri,
           CASE WHEN parameter = 'A' AND five = 2 THEN 'unmapped:unit:GJ' WHEN parameter = 'A' AND five = 3 THEN 'unmapped:unit:t' WHEN parameter = 'R' AND five = 0 THEN 'mapped:value:Erdgas->u/gas' WHEN parameter = 'R' AND five = 2 THEN 'unmapped:value:Erdgas' ELSE '' END AS flags FROM k
""")
def checked_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, unit and vocabulary of every claimed value."""
    c, five, entry = _claims(spark, sf_dir), F.col("five"), F.col("parameter") == "R"
    word = F.when(five == 0, "Gas").when(five == 1, " oil ").when(five == 2, "").when(five == 3, "wood")
    claims = c.select("document", "pos", "parameter", F.when(entry, word).when(five == 4, "x").otherwise(F.col("v")).alias("value"), F.when(entry & five.isin(0, 2), "Erdgas").alias("value_raw"),
                      F.when(five == 0, "kWh").when(five == 1, "MWh").when(five == 2, "GJ").alias("unit"), F.when(five == 1, "Mwh").when(five == 3, "t").alias("unit_raw"))
    spec = spark.createDataFrame([("A", "number", {"kWh": 1.0, "MWh": 1000.0}, True, {}), ("N", "number", {}, False, {}), ("R", "category", {}, False, {"gas": "u/gas", "oil": "u/oil"})], "parameter string, kind string, units map<string,double>, converts boolean, labels map<string,string>")
    return check_value(claims, spec).select("document", "pos", "refusal", "unit", "unit_raw", "value_target", "value_uri", F.array_join("flags", ",").alias("flags"))


@query(_CLAIMS + """SELECT document, pos, CASE WHEN five < 3 THEN 'item ' || parameter || ' ' || five END AS item FROM c""")
def routed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims met with the item that their index names; the others are split off."""
    c = _claims(spark, sf_dir).select("document", "pos", "parameter", F.col("five").alias("index"))
    items = spark.createDataFrame([(p, i, f"item {p} {i}") for p in "ANR" for i in range(3)], "parameter string, index long, item string")
    routed, lost = route(c, checked(items), "parameter", "index")
    return routed.select("document", "pos", "item").unionByName(lost.select("document", "pos", F.lit(None).cast("string").alias("item")))


@query(_CLAIMS + """, e AS (SELECT document, pos, CASE five WHEN 0 THEN 'skipped' WHEN 1 THEN 'answered_not_stated' WHEN 2 THEN 'refused' WHEN 3 THEN 'parameter_cut' ELSE 'other' END AS event FROM c)
    SELECT document, pos, CASE event WHEN 'skipped' THEN 'unanswered' WHEN 'answered_not_stated' THEN 'unstated' WHEN 'refused' THEN 'unbacked' WHEN 'parameter_cut' THEN 'exhausted' END AS state FROM e""")
def states_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that each event ends in."""
    names = F.array(*map(F.lit, ("skipped", "answered_not_stated", "refused", "parameter_cut", "other")))
    return _claims(spark, sf_dir).select("document", "pos", state_for(F.element_at(names, F.col("five").cast("int") + 1)).alias("state"))


@query("""
    WITH s AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
    f AS (SELECT doc_id, pos, trim(regexp_replace(line, '[ \\t\\r\\x0B\\f]+', ' ', 'g')) AS body FROM s),
    q AS (SELECT doc_id, body[1:24] AS quote FROM f WHERE pos = 2 AND regexp_matches(body, '^[a-zA-Z .,]{24}')),
    p AS (SELECT q.doc_id, q.quote, min((CASE WHEN pos % 2 = 0 THEN 0 ELSE 1 END) * 1000000 + pos) AS best FROM q JOIN f ON f.doc_id = q.doc_id AND contains(f.body, trim(q.quote)) GROUP BY 1, 2)
    SELECT doc_id, best % 1000000 AS place, CASE WHEN best < 1000000 THEN 'shown' ELSE 'document' END AS way FROM p
""")
def places_of_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first passage that holds a quote: the even lines are shown, the others are the rest of the document."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "text"))
    passages = d.select("doc_id", (F.col("p") + 1).cast("long").alias("pos"), "text", (F.col("p") % 2 == 1).alias("shown"))
    quotes = passages.where("pos = 2").select("doc_id", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("body")).where(F.col("body").rlike("^[a-zA-Z .,]{24}")).select("doc_id", F.substring("body", 1, 24).alias("quote"))
    return place_of(quotes, passages, "doc_id", "pos").select("doc_id", "place", "way")


_MOVED = """
    WITH s AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, trim(regexp_replace(unnest(string_split(text, chr(10))), '[ \\t\\r\\x0B\\f]+', ' ', 'g')) AS body FROM documents),
    r AS (SELECT doc_id, pos AS spot, pos + 1 AS owner, body AS quote FROM s WHERE pos % 3 = 1 AND regexp_matches(body, '^[a-zA-Z .,]{20,}$')),
    m AS (SELECT r.doc_id, spot, any_value(owner) AS owner, bool_or(s.pos = owner) AS own, count(*) AS n, min(s.pos) AS dest FROM r JOIN s ON s.doc_id = r.doc_id AND contains(s.body, r.quote) GROUP BY 1, 2)
    SELECT doc_id, spot, CASE WHEN NOT own AND n = 1 THEN dest ELSE owner END AS owner FROM m
"""


@query(_MOVED)
def reanchored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose owner moved take the one passage that carries their quote now."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "text")).withColumn("pos", (F.col("p") + 1).cast("long"))
    passages = d.select(F.col("doc_id").alias("document"), F.lit("section").alias("kind"), F.col("pos").alias("owner"), "text")
    quote = F.trim(F.regexp_replace("text", r"\s+", " "))
    rows = d.where("pos % 3 = 1").select(F.col("doc_id").alias("document"), F.lit("section").alias("kind"), (F.col("pos") + 1).alias("owner"), quote.alias("quote"), F.col("pos").alias("spot")).where(F.col("quote").rlike("^[a-zA-Z .,]{20,}$"))
    rows = rows.withColumn("row", F.struct("document", "spot"))
    return reanchor(rows, passages).select(F.col("document").alias("doc_id"), "spot", "owner")


@query(HARVEST + """
    , f AS (SELECT document, pos AS fact, parameter, CASE WHEN pos % 2 = 0 THEN value ELSE value + 1000 END AS value, status, CASE WHEN pos % 3 = 0 THEN year END AS year FROM h)
    SELECT f.document, f.fact, bool_or(coalesce(h.value = f.value AND h.status = f.status AND (f.year IS NULL OR h.year = f.year), false)) AS found
    FROM f LEFT JOIN h ON h.document = f.document AND h.parameter = f.parameter GROUP BY 1, 2
""")
def covered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a gold file and whether a row with all their coordinates says them."""
    h = harvest(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    rows = h.select("document", "parameter", text("value").alias("value"), F.create_map(F.lit("status"), F.col("status"), F.lit("year"), text("year")).alias("coordinates"))
    given = F.when(F.col("pos") % 3 == 0, F.create_map(F.lit("status"), F.col("status"), F.lit("year"), text("year"))).otherwise(F.create_map(F.lit("status"), F.col("status")))
    facts = h.select("document", F.col("pos").alias("fact"), "parameter", F.when(F.col("pos") % 2 == 0, F.col("value")).otherwise(F.col("value") + 1000).cast("string").alias("value"), given.alias("coordinates"))
    return covered(facts, rows).select("document", "fact", "found")


_COORDINATES = HARVEST + """
    , r AS (SELECT document, pos, CASE WHEN pos % 7 <> 0 THEN year END AS year, CASE WHEN pos % 11 = 0 THEN NULL WHEN pos % 5 = 0 THEN 'in ' || (year + 1) ELSE 'in ' || year || ', it says' END AS quote, CASE WHEN pos % 13 = 0 THEN 'derived' ELSE 'read' END AS state FROM h)
"""


@query(_COORDINATES + """
    , o AS (SELECT *, CASE WHEN year IS NULL THEN 'empty' WHEN state = 'derived' THEN 'derived' WHEN quote IS NULL THEN 'no evidence' WHEN pos % 5 = 0 THEN 'not carried' ELSE 'read' END AS outcome FROM r)
    SELECT document, pos, outcome, CASE WHEN outcome NOT IN ('no evidence', 'not carried') THEN year END AS year, CASE WHEN outcome IN ('no evidence', 'not carried') THEN 'unbacked' ELSE state END AS year_state FROM o
""")
def rechecked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years that their own quote must carry."""
    pos, year = F.col("pos"), F.col("year")
    h = harvest(spark, sf_dir).select(
        "document", "pos", F.when(pos % 7 != 0, year).alias("year"), F.when(pos % 11 == 0, None).when(pos % 5 == 0, F.concat(F.lit("in "), (year + 1).cast("string"))).otherwise(F.concat(F.lit("in "), year.cast("string"), F.lit(", it says"))).alias("year_quote"),
        F.when(pos % 13 == 0, "derived").otherwise("read").alias("year_state"))
    return recheck(h, "year").select("document", "pos", "outcome", "year", "year_state")


@query(HARVEST + """
    , r AS (SELECT document, pos, CASE WHEN pos % 4 <> 0 THEN 'u/' || lower(parameter) END AS class, CASE WHEN pos % 6 = 0 THEN NULL WHEN pos % 5 = 0 THEN 'Other' ELSE CASE status WHEN 'F' THEN 'FINAL' ELSE 'open' END END AS raw FROM h),
    m AS (SELECT *, CASE raw WHEN 'FINAL' THEN 'u/a' WHEN 'open' THEN 'u/n' END AS uri FROM r),
    o AS (SELECT *, CASE WHEN raw IS NULL THEN CASE WHEN class IS NULL THEN 'empty' ELSE 'no wording' END WHEN uri IS NULL THEN 'not listed' WHEN uri = class THEN 'unchanged' ELSE 'mapped' END AS outcome FROM m)
    SELECT document, pos, outcome, CASE WHEN outcome = 'mapped' THEN uri ELSE class END AS class FROM o
""")
def remapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes looked up again by the wording that was recorded."""
    pos = F.col("pos")
    raw = F.when(pos % 6 == 0, None).when(pos % 5 == 0, "Other").otherwise(F.when(F.col("status") == "F", "FINAL").otherwise("open"))
    rows = harvest(spark, sf_dir).select("document", "pos", F.when(pos % 4 != 0, F.concat(F.lit("u/"), F.lower("parameter"))).alias("class"), raw.alias("class_raw"))
    words = spark.createDataFrame([("Final", "u/a"), ("Open", "u/n")], "label string, uri string")
    return remap(rows, "class", words).select("document", "pos", "outcome", "class")


@query(HARVEST + """
    SELECT document, pos, CASE WHEN discount < 0.05 THEN year WHEN parameter = 'A' THEN 2030 WHEN parameter = 'N' THEN 2045 ELSE year END AS year,
           CASE WHEN discount < 0.05 THEN 'read' WHEN parameter IN ('A', 'N') THEN 'derived' ELSE 'unanswered' END AS year_state,
           CASE WHEN discount < 0.05 THEN year = 1997 END AS belongs FROM h
""")
def derived_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates that the spec decides, and which rows belong to a parameter by an entry that they must have."""
    h = harvest(spark, sf_dir).select("document", "pos", "parameter", "year", F.when(F.col("discount") < 0.05, "read").otherwise("unanswered").alias("year_state"))
    belongs = kept(F.col("year_state"), F.col("year"), F.lit(1997))
    derived = spark.createDataFrame([("A", 2030), ("N", 2045)], "parameter string, year int")
    return apply_derived(h.withColumn("belongs", belongs), "year", derived, "parameter").select("document", "pos", "year", "year_state", "belongs")


@query(HARVEST + """
    SELECT document, pos, CASE WHEN pos % 3 = 0 THEN NULL ELSE value > 20 AND status = 'F' END AS agrees FROM h
""")
def second_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a second reading agrees, disagrees or decides nothing."""
    value = F.when(F.col("pos") % 3 != 0, F.col("value") > 20)
    return harvest(spark, sf_dir).select("document", "pos", agrees(value, F.col("status") == "F").alias("agrees"))


@query(HARVEST + """
    , r AS (SELECT document, pos, parameter AS field, status AS reading, discount < 0.03 AS front, discount > 0.07 AS catalogue, 1 + pos % 4 AS page FROM h),
    w AS (SELECT *, CASE WHEN front THEN 0 WHEN catalogue THEN 1 ELSE 2 END AS w FROM r), b AS (SELECT *, min(w) OVER (PARTITION BY document, field) AS best FROM w)
    SELECT document, pos, CASE w WHEN 0 THEN 'front' WHEN 1 THEN 'catalogue' ELSE 'any' END AS way FROM b WHERE w = best
""")
def front_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a front field that count: those of the front pages, else of the catalogue, else all."""
    h = harvest(spark, sf_dir)
    return readings_that_count(h, ["document", "parameter"], {"front": F.col("discount") < 0.03, "catalogue": F.col("discount") > 0.07, "any": F.lit(True)}).select("document", "pos", "way")


@query(HARVEST + """
    , t AS (SELECT document, min(pos % 9 + 1) AS t FROM h WHERE status = 'F' GROUP BY 1), p AS (SELECT document, unnest([1, 2, t, t + 1]) AS page FROM t)
    SELECT DISTINCT document, page FROM p
""")
def front_page_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The front pages of each document."""
    titles = harvest(spark, sf_dir).where("status = 'F'").select("document", (F.col("pos") % 9 + 1).alias("page"))
    return front_pages(titles, "document", "page")


@query("""
    WITH r AS (SELECT conv_id, string_split(text, ' ')[1] || CASE WHEN turn % 2 = 0 THEN ' ' || string_split(text, ' ')[2] ELSE '' END AS title, turn, role = 'user' AS located FROM conversations),
    p AS (SELECT conv_id, title, count(*) AS n, bool_or(located) AS l, min(turn) AS o FROM r GROUP BY 1, 2),
    f AS (SELECT * FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.conv_id = a.conv_id AND b.title <> a.title AND contains(b.title, a.title))),
    k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, l DESC, length(title) DESC, o) AS rank, count(*) OVER (PARTITION BY conv_id) - 1 AS others FROM f)
    SELECT conv_id, title, others FROM k WHERE rank = 1
""")
def picked_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading of a field that may have one only."""
    w = F.split("text", " ")
    c = table(spark, sf_dir, "conversations").where(F.col("text").isNotNull())
    title = F.concat(F.get(w, 0), F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" "), F.coalesce(F.get(w, 1), F.lit("")))).otherwise(""))
    return pick_one(c.select("conv_id", "turn", title.alias("title"), (F.col("role") == "user").alias("located")), ["conv_id"], "title", "located", "turn")


@query(HARVEST + """
    , s AS (SELECT document, parameter, pos, 40 + pos % 90 AS size, row_number() OVER (PARTITION BY document, parameter ORDER BY pos) AS r FROM h),
    t AS (WITH RECURSIVE f AS (SELECT document, parameter, pos, size, r, 1 AS n, size AS total, 1 AS batch FROM s WHERE r = 1
          UNION ALL SELECT s.document, s.parameter, s.pos, s.size, s.r, CASE WHEN f.n < 3 AND f.total + s.size <= 200 THEN f.n + 1 ELSE 1 END, CASE WHEN f.n < 3 AND f.total + s.size <= 200 THEN f.total + s.size ELSE s.size END,
                 CASE WHEN f.n < 3 AND f.total + s.size <= 200 THEN f.batch ELSE f.batch + 1 END FROM f JOIN s ON s.document = f.document AND s.parameter = f.parameter AND s.r = f.r + 1) SELECT * FROM f)
    SELECT document, parameter, pos, size, batch FROM t
""")
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work items that share a request."""
    items = harvest(spark, sf_dir).select("document", "parameter", "pos", (F.lit(40) + F.col("pos") % 90).alias("size"))
    return batches(items, ["document", "parameter"], "pos", "size", 3, 200)


@query()
def located_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of the next document version that shares the longest run of words with a quote."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("segment", "text"))
    quotes = d.where("segment = 0").select(F.col("doc_id").alias("quote_id"), "doc_id", F.array_join(F.slice(T.words(F.col("text")), 2, 12), " ").alias("quote"))
    return longest_run(quotes, d, "doc_id")
