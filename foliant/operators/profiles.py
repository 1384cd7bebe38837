"""Kernels of profiles: groups of places, names of models and authors, amounts that add up, and graph bricks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked

# Legal forms left out of a firm's name.
LEGAL_FORMS = ("gmbh & co. kg", "gmbh", "ag", "kg", "inc", "ltd")


def merge_labels(rows: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """(key, labels): the labels of each row, its own before those kept by hand, each once."""
    a = aliases.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("__a"))
    own = rows.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("__o"))
    return own.join(a, key, "left").select(key, F.array_distinct(F.concat("__o", F.coalesce("__a", F.array().cast("array<string>")))).alias("labels"))


def aggregates(families: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups (group, members), unplaced (family, n)): families (family, group, member) merged by group; members that are no
    place are counted."""
    known = families.join(checked(places), F.col("member") == F.col("place"), "left")
    groups = known.where("place IS NOT NULL").groupBy("group").agg(F.array_sort(F.collect_set("member")).alias("members"))
    return groups, known.where("place IS NULL").groupBy("family").agg(F.count("*").alias("n"))


def group_members(rows: DataFrame, column: str, groups: DataFrame) -> DataFrame:
    """rows with one row per member where the answer names a group."""
    g = checked(groups.select(F.col("group").alias(column), "members"))
    return rows.join(g, column, "left").withColumn("member", F.explode(F.coalesce("members", F.array(column)))).drop("members")


def model_names(name: Column) -> Column:
    """A model's name with and without its version."""
    bare = F.trim(F.regexp_replace(name, r"(?i)[\s_-]*v?\d+(\.\d+)*$", ""))
    return F.array_distinct(F.filter(F.array(F.trim(name), bare), lambda x: x != ""))


def merge_studies(studies: DataFrame, bundle: str, lists: list[str]) -> DataFrame:
    """Studies of one bundle as one, each of their lists merged and every entry once."""
    return studies.groupBy(bundle).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists])


def authors_match(record: Column, read: Column, needed: int, fewer_suffice: bool = True) -> Column:
    """Is a catalogue record the document: enough of the family names of its authors stand among the words of the authors
    read; where a side names fewer, all of them."""
    families = F.array_remove(F.array_distinct(F.transform(record, T.family_name)), "")
    said = F.array_distinct(F.flatten(F.transform(read, T.name_words)))
    named = F.size(F.filter(read, lambda n: F.size(T.name_words(n)) > 0))
    least = F.least(F.lit(needed), F.size(families), named) if fewer_suffice else F.lit(needed)
    enough = F.size(F.array_intersect(families, said)) >= least
    return F.coalesce((least >= 1) & enough & (F.size(families) >= least) & (named >= least), F.lit(False))


def additive(unit: Column, target: Column, value: Column, state: Column, quantity: Column) -> Column:
    """May a row be summed: an amount in its parameter's unit, not zero, of a known quantity in the slice."""
    return F.coalesce((unit == target) & (value != 0) & state.isin("read", "derived") & ~F.startswith(F.coalesce(quantity, F.lit("")), F.lit("out:")), F.lit(False))


def open_shares(shares: DataFrame, amounts: DataFrame, frame: list[str], axes: list[str], total: str = "total") -> DataFrame:
    """(share, wholes): percentages whose absolute number isn't printed, with how many wholes they may be of.

    A whole has the share's frame and on every axis the share's part or its total; a share is left out if an amount has all
    its parts, or if there is no whole. Shares and amounts meet on the frame.
    """
    a = amounts.select(*frame, *[F.col(x).alias(f"__{x}") for x in axes])
    met = shares.join(a, frame)
    own, base = F.lit(True), F.lit(True)
    for x in axes:
        own &= F.col(f"__{x}") == F.col(x)
        base &= (F.col(f"__{x}") == F.col(x)) | (F.col(f"__{x}") == total)
    g = met.groupBy("share").agg(F.bool_or(own).alias("own"), F.count_distinct(F.when(base, F.struct(*[f"__{x}" for x in axes]))).alias("wholes"))
    return g.where(~F.col("own") & (F.col("wholes") > 0)).select("share", "wholes")


def regions_in(texts: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """(key, uri): vocabulary labels that stand in a text as words of their own.

    Texts are cut to runs of as many words as a label has, so labels are found by an equi-join and not one by one.
    """
    v = vocabulary.select("uri", F.array_join(T.name_words_kept(F.col("label")), " ").alias("run"), F.size(T.name_words_kept(F.col("label"))).alias("n")).where("n > 0")
    lengths = [r["n"] for r in v.select("n").distinct().collect()]
    w = texts.select(key, T.name_words_kept(F.col(text)).alias("w"))
    runs = F.concat(*[F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), _run_of(n))).otherwise(F.array().cast("array<string>")) for n in lengths]) if lengths else F.array().cast("array<string>")
    return w.select(key, F.explode(F.array_distinct(runs)).alias("run")).join(checked(v), "run").select(key, "uri").distinct()


def _run_of(n: int):
    return lambda i: F.array_join(F.slice("w", i, n), " ")


# Bricks: what a drawing makes an object of.

def without_legal_form(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, r"(?i)[\s,]+(" + "|".join(f.replace(".", r"\.") for f in LEGAL_FORMS) + r")\.?$", ""))


def year_to_datetime(year: Column) -> Column:
    return F.when(year.cast("string").rlike(r"^\d{4}$"), F.concat(year.cast("string"), F.lit("-01-01T00:00:00")))


def parts_name(parts: list[Column], missing: str = "refuse") -> Column:
    """An address made of parts; an absent part refuses the address, is left empty, or is left out."""
    texts = F.array(*[F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts])
    if missing == "omit":
        return F.nullif(F.array_join(F.array_compact(texts), "|"), F.lit(""))
    if missing == "empty":
        return F.array_join(F.transform(texts, lambda t: F.coalesce(t, F.lit(""))), "|")
    return F.when(~F.exists(texts, lambda t: t.isNull()), F.array_join(texts, "|"))


def fill_template(template: str, **values: Column) -> Column:
    """A template's {names} filled; null if one of them is."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def edge_problems(edges: DataFrame, rules: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(s_class, p, o_class, problem) of emitted triple shapes whose classes are neither a property's domain or range nor one of
    their descendants. ancestors is (child, ancestor)."""
    near = ancestors.select("child", "ancestor").unionByName(ancestors.select("child", F.col("child").alias("ancestor"))).distinct()
    shapes = edges.select("s_class", "p", "o_class").distinct().join(checked(rules), "p", "left")
    up = lambda side, name: near.select(F.col("child").alias(side), F.col("ancestor").alias(name), F.lit(True).alias(f"__{name}"))
    judged = shapes.join(up("s_class", "domain"), ["s_class", "domain"], "left").join(up("o_class", "range"), ["o_class", "range"], "left")
    same_s, same_o = F.col("s_class") == F.col("domain"), F.col("o_class") == F.col("range")
    wrong = lambda name, same: F.col(name).isNotNull() & F.col(f"__{name}").isNull() & ~same
    problem = F.array_compact(F.array(F.when(F.col("known").isNull(), "unknown"), F.when(wrong("domain", same_s), "domain"), F.when(wrong("range", same_o), "range")))
    return judged.select("s_class", "p", "o_class", F.explode(problem).alias("problem"))


def uncovered(names: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Identifiers that no file covers."""
    return names.select(key).distinct().join(covered.select(key), key, "left_anti")


@query("""
    WITH o AS (SELECT n_regionkey AS iri, list_sort(list_distinct(list(n_name))) AS o FROM nation GROUP BY 1), a AS (SELECT s_nationkey % 5 AS iri, list_sort(list_distinct(list(CASE WHEN s_suppkey % 3 = 0 THEN 'NATION_' || s_nationkey ELSE 'N' || s_suppkey % 7 END))) AS a FROM supplier GROUP BY 1)
    SELECT iri, array_to_string(list_concat(o, list_filter(coalesce(a, []), lambda x: NOT list_contains(o, x))), ',') AS labels FROM o LEFT JOIN a USING (iri)
""")
def region_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with their own and their hand-kept labels."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("iri"), F.col("n_name").alias("label"))
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    aliases = table(spark, sf_dir, "supplier").select((n % 5).alias("iri"), F.when(k % 3 == 0, F.concat(F.lit("NATION_"), n.cast("string"))).otherwise(F.concat(F.lit("N"), (k % 7).cast("string"))).alias("label"))
    return merge_labels(rows, aliases, "iri").select("iri", F.array_join("labels", ",").alias("labels"))


_GROUPS = """
    WITH f AS (SELECT c_mktsegment AS family, 'g' || (c_custkey % 4) AS g, 'NATION_' || (c_nationkey + CASE WHEN c_custkey % 9 = 0 THEN 100 ELSE 0 END) AS member FROM customer),
    m AS (SELECT g, list_sort(list_distinct(list(member))) AS members FROM f WHERE member IN (SELECT n_name FROM nation) GROUP BY 1)
"""


def _families(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    f = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("family"), F.concat(F.lit("g"), (k % 4).cast("string")).alias("group"), F.concat(F.lit("NATION_"), (F.col("c_nationkey") + F.when(k % 9 == 0, 100).otherwise(0)).cast("string")).alias("member"))
    return aggregates(f, table(spark, sf_dir, "nation").select(F.col("n_name").alias("place")))


@query(_GROUPS + 'SELECT g AS "group", array_to_string(members, \',\') AS members FROM m')
def place_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of places from several families."""
    return _families(spark, sf_dir)[0].select("group", F.array_join("members", ",").alias("members"))


@query(_GROUPS + "SELECT family, count(*) AS n FROM f WHERE member NOT IN (SELECT n_name FROM nation) GROUP BY 1")
def unplaced_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that are no place, by family."""
    return _families(spark, sf_dir)[1]


@query(_GROUPS + """, r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'g' || (o_orderkey % 4) ELSE 'NATION_' || (o_orderkey % 25) END AS area FROM orders WHERE o_orderkey % 11 = 0)
    SELECT o_orderkey, area, unnest(coalesce(members, [area])) AS member FROM r LEFT JOIN m ON m.g = r.area""")
def members_of_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that name a group as its members."""
    k = F.col("o_orderkey")
    r = table(spark, sf_dir, "orders").where("o_orderkey % 11 = 0").select("o_orderkey", F.when(k % 3 == 0, F.concat(F.lit("g"), (k % 4).cast("string"))).otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string"))).alias("area"))
    return group_members(r, "area", _families(spark, sf_dir)[0]).select("o_orderkey", "area", "member")


@query(r"""
    WITH m AS (SELECT p_partkey, p_type || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' v2.1' WHEN 2 THEN '-3' ELSE ' 2020' END AS name FROM part), n AS (SELECT *, trim(regexp_replace(name, '(?i)[\s_-]*v?\d+(\.\d+)*$', '')) AS bare FROM m)
    SELECT p_partkey, CASE WHEN trim(name) = bare THEN trim(name) ELSE trim(name) || '|' || bare END AS names FROM n
""")
def versionless_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of models with and without their versions."""
    k = F.col("p_partkey") % 4
    name = F.concat("p_type", F.when(k == 0, "").when(k == 1, " v2.1").when(k == 2, "-3").otherwise(" 2020"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(model_names(name), "|").alias("names"))


@query("""SELECT o_custkey AS bundle, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS statuses, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priorities FROM orders GROUP BY 1""")
def merged_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studies of one bundle merged."""
    s = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bundle"), F.array("o_orderstatus").alias("statuses"), F.array("o_orderpriority").alias("priorities"))
    m = merge_studies(s, "bundle", ["statuses", "priorities"])
    return m.select("bundle", F.array_join("statuses", ",").alias("statuses"), F.array_join("priorities", ",").alias("priorities"))


@query(HARVEST + """
    , s AS (SELECT document, pos AS share, year, status, parameter FROM h WHERE discount < 0.02), a AS (SELECT document, year, CASE WHEN pos % 3 = 0 THEN 'total' ELSE status END AS status, CASE WHEN pos % 2 = 0 THEN 'total' ELSE parameter END AS parameter FROM h WHERE discount > 0.04),
    m AS (SELECT s.document, share, bool_or(a.status = s.status AND a.parameter = s.parameter) AS own, count(DISTINCT CASE WHEN a.status IN (s.status, 'total') AND a.parameter IN (s.parameter, 'total') THEN a.status || '|' || a.parameter END) AS wholes
          FROM s JOIN a ON a.document = s.document AND a.year = s.year GROUP BY 1, 2)
    SELECT document, share, wholes FROM m WHERE NOT own AND wholes > 0
""")
def shares_without_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentages whose absolute number isn't printed, and the wholes that they may be of."""
    h = harvest(spark, sf_dir)
    shares = h.where("discount < 0.02").select(F.struct("document", "pos").alias("share"), "document", "year", "status", "parameter")
    amounts = h.where("discount > 0.04").select("document", "year", F.when(F.col("pos") % 3 == 0, "total").otherwise(F.col("status")).alias("status"), F.when(F.col("pos") % 2 == 0, "total").otherwise(F.col("parameter")).alias("parameter"))
    return open_shares(shares, amounts, ["document", "year"], ["status", "parameter"]).select("share.document", F.col("share.pos").alias("share"), "wholes")


@query(HARVEST + """SELECT document, pos, status = 'F' AND value > 5 AND discount >= 0.03 AND parameter <> 'R' AS additive FROM h""")
def additive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that may be summed."""
    h = harvest(spark, sf_dir)
    unit = F.when(F.col("status") == "F", "MWh").otherwise("t")
    value = F.when(F.col("value") > 5, F.col("value")).otherwise(0)
    state = F.when(F.col("discount") >= 0.03, "read").otherwise("unbacked")
    quantity = F.when(F.col("parameter") == "R", "out:saving").otherwise("use")
    return h.select("document", "pos", additive(unit, F.lit("MWh"), value, state, quantity).alias("additive"))


@query(r"""
    WITH w AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents), v AS (SELECT * FROM (VALUES ('u/the', 'the'), ('u/of-the', 'Of the'), ('u/und-die', 'und, die'), ('u/none', 'xyzzy')) AS v(uri, label)),
    k AS (SELECT uri, ' ' || array_to_string(regexp_extract_all(lower(label), '[\p{L}\p{N}]+'), ' ') || ' ' AS run FROM v)
    SELECT doc_id, uri FROM w, k WHERE contains(t, run)
""")
def vocabulary_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary names that stand in each text."""
    v = spark.createDataFrame([("u/the", "the"), ("u/of-the", "Of the"), ("u/und-die", "und, die"), ("u/none", "xyzzy")], "uri string, label string")
    return regions_in(table(spark, sf_dir, "documents"), "doc_id", "text", v)


@query(HARVEST + """
    SELECT document, pos, CASE WHEN pos % 3 <> 0 THEN document || '|' || status || '|' || year END AS refused, document || '|' || status || '|' || CASE WHEN pos % 3 <> 0 THEN CAST(year AS VARCHAR) ELSE '' END AS emptied,
           document || '|' || status || CASE WHEN pos % 3 <> 0 THEN '|' || year ELSE '' END AS omitted, year || '-01-01T00:00:00' AS moment, 'x/' || document || '/' || parameter AS filled FROM h
""")
def minted_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made of parts, in the three ways of treating an absent one; moments and templates."""
    h = harvest(spark, sf_dir)
    parts = [F.col("document"), F.col("status"), F.when(F.col("pos") % 3 != 0, F.col("year"))]
    return h.select("document", "pos", parts_name(parts).alias("refused"), parts_name(parts, "empty").alias("emptied"), parts_name(parts, "omit").alias("omitted"), year_to_datetime(F.col("year")).alias("moment"),
                    fill_template("x/{document}/{parameter}", document=F.col("document"), parameter=F.col("parameter")).alias("filled"))


@query("""
    WITH e AS (SELECT DISTINCT 'c' || (l_partkey % 6) AS s_class, 'p' || l_returnflag AS p, 'c' || (l_suppkey % 6) AS o_class FROM lineitem),
    a AS (SELECT * FROM (VALUES ('c1', 'c0'), ('c2', 'c0'), ('c3', 'c2'), ('c3', 'c0')) AS a(child, ancestor)), r AS (SELECT * FROM (VALUES ('pA', 'c0', 'c0'), ('pN', 'c2', NULL)) AS r(p, domain, rng)),
    j AS (SELECT e.*, r.p IS NOT NULL AS known, domain, rng FROM e LEFT JOIN r ON r.p = e.p)
    SELECT s_class, p, o_class, problem FROM (
        SELECT s_class, p, o_class, 'unknown' AS problem FROM j WHERE NOT known
        UNION ALL SELECT s_class, p, o_class, 'domain' FROM j WHERE domain IS NOT NULL AND s_class <> domain AND NOT EXISTS (SELECT 1 FROM a WHERE child = s_class AND ancestor = domain)
        UNION ALL SELECT s_class, p, o_class, 'range' FROM j WHERE rng IS NOT NULL AND o_class <> rng AND NOT EXISTS (SELECT 1 FROM a WHERE child = o_class AND ancestor = rng))
""")
def edges_off_the_ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triple shapes that a property's domain or range doesn't allow."""
    l = table(spark, sf_dir, "lineitem")
    c = lambda name: F.concat(F.lit("c"), (F.col(name) % 6).cast("string"))
    edges = l.select(c("l_partkey").alias("s_class"), F.concat(F.lit("p"), "l_returnflag").alias("p"), c("l_suppkey").alias("o_class"))
    rules = spark.createDataFrame([("pA", "c0", "c0", True), ("pN", "c2", None, True)], "p string, domain string, range string, known boolean")
    ancestors = spark.createDataFrame([("c1", "c0"), ("c2", "c0"), ("c3", "c2"), ("c3", "c0")], "child string, ancestor string")
    return edge_problems(edges, rules, ancestors)


@query("SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 47)")
def names_not_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that no file covers."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "name")
    return uncovered(p, p.where("p_size > 47"), "name")


@query()
def matched_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose authors are those read."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    record = F.array(F.lit("Jürgen Müller"), F.concat(F.lit("Ann Bo"), F.translate((k % 5).cast("string"), "01234", "abcde")))
    read = F.array(F.lit("J. Mueller, MÜLLER1,2*"), F.concat(F.lit("Bo"), F.translate((k % 3).cast("string"), "012", "abc"), F.lit(", A.")))
    return s.select("s_suppkey", authors_match(record, read, 2).alias("accepted"))
