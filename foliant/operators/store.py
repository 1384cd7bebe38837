"""The corpus store: document files to tables, upserts and deletes, work lists of embeddings, staleness and re-linking.

A document file holds nested sections with segments, tables and figures; here they are made from the lines of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.texts import LINES, sections
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked

ITEM = "array<struct<id:string,path:string,page_number:int,caption:string,body:string,bbox:array<double>>>"
#: The schema of a document file's sections.
SECTION = f"struct<title:string,content:string,page_number:int,pages:array<int>,segments:array<struct<page:int,kind:string,ref:string,text:string,bbox:array<double>>>,tables:{ITEM},figures:{ITEM}>"
SOURCE_DOC = "external_id string, filename string, url string, group_key string, published string, meta map<string,string>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(document, sections) of document files: one JSON object per file, its name the document's."""
    raw = spark.read.schema(f"sections array<{SECTION}>").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("document"), "sections")


def crawl_index(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a crawl's JSON index (SOURCE_DOC); entries without a local file are dropped."""
    raw = spark.read.schema("id string, title string, year int, doi string, url string, pdf string").option("multiLine", True).json(path)
    kept = raw.where(F.coalesce(F.trim("pdf"), F.lit("")) != "")
    return kept.select(F.col("id").alias("external_id"), F.lower(F.element_at(F.split("pdf", "/"), -1)).alias("filename"), "url", T.bare_doi(F.col("doi")).alias("group_key"), F.col("year").cast("string").alias("published"), F.create_map(F.lit("title"), F.col("title")).alias("meta"))


def content_text(content: Column) -> Column:
    """A content that is a text or a JSON list of texts, as one text."""
    listed = F.from_json(content, "array<string>")
    return F.when(F.startswith(F.trim(content), F.lit("[")) & listed.isNotNull(), F.array_join(listed, "\n")).otherwise(content)


def to_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """Documents (document, sections) as the store's tables: sections, section_pages, pages, segments, items.

    Keys are built of the parent's, so each table is one pass over the documents and no numbering crosses tasks.
    """
    s = documents.select("document", F.posexplode("sections").alias("section", "s"))
    keyed = s.select("document", "section", "s")
    out = {"sections": keyed.select("document", "section", "s.title", content_text(F.col("s.content")).alias("content"), "s.page_number")}
    pages = F.array_distinct(F.concat(F.coalesce("s.pages", F.array().cast("array<int>")), F.array("s.page_number")))
    out["section_pages"] = keyed.select("document", "section", F.explode(F.array_compact(pages)).alias("page"))
    out["pages"] = out["section_pages"].select("document", "page").distinct()
    out["segments"] = keyed.select("document", "section", F.posexplode("s.segments").alias("ordinal", "g")).select("document", "section", "ordinal", "g.page", "g.kind", "g.ref", "g.text", F.to_json("g.bbox").alias("bbox"))
    item = lambda kind, name: keyed.select("document", "section", F.lit(kind).alias("kind"), F.posexplode(f"s.{name}").alias("at", "i"))
    both = item("table", "tables").unionByName(item("figure", "figures"))
    out["items"] = both.select("document", "section", "kind", "at", F.col("i.id").alias("block_id"), "i.path", "i.page_number", "i.caption", "i.body", F.to_json("i.bbox").alias("bbox"))
    return out


def replace_documents(old: DataFrame, new: DataFrame, document: str) -> DataFrame:
    """A table with the rows of the new documents in place of theirs: a cascading delete and an insert."""
    return old.join(checked(new.select(document).distinct()), document, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key, the last by order; new rows come after old ones."""
    both = old.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    last = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("__n"), F.desc(order)))
    return both.withColumn("__r", last).where("__r = 1").drop("__n", "__r")


def update_known(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of rows already there take what the new rows say; rows that aren't there aren't added."""
    n = new.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__seen"))
    both = old.join(n, key, "left")
    return both.select(*[F.when(F.col("__seen"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


def pair_items(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """(key, old, new): each new item takes the next old row of its block id; what is left over stands alone."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    side = lambda df, name: df.select(*key, F.col(order).alias(name), n.alias("n"))
    return side(old, "old").join(side(new, "new"), [*key, "n"], "full").drop("n")


def captions_of(items: DataFrame, key: list[str]) -> DataFrame:
    """(key, captions): block ids to captions of a section's tables and figures."""
    named = items.where((F.coalesce(F.trim("caption"), F.lit("")) != "") & F.col("block_id").isNotNull())
    return named.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("block_id", F.trim("caption").alias("caption"))))).alias("captions"))


def owner_content(sections_: DataFrame, items: DataFrame) -> DataFrame:
    """(document, kind, section, at, title, text): one record shape for sections, tables and figures; an item has the title of
    its caption, else that of its section."""
    s = sections_.select("document", F.lit("section").alias("kind"), "section", F.lit(None).cast("int").alias("at"), "title", F.col("content").alias("text"))
    i = items.join(sections_.select("document", "section", F.col("title").alias("__t")), ["document", "section"])
    return s.unionByName(i.select("document", "kind", "section", "at", F.coalesce(F.nullif(F.trim("caption"), F.lit("")), F.col("__t")).alias("title"), F.col("body").alias("text")))


def embedding_inputs(sections_: DataFrame, items: DataFrame) -> DataFrame:
    """(document, section, at, embedding_type, text, image): what there is to embed.

    A section's text, with the captions in place of its placeholders, unless it is its title alone; its title; an item's
    caption and body; and an item's image where it has a path.
    """
    s = sections_.join(captions_of(items, ["document", "section"]), ["document", "section"], "left")
    title = F.coalesce(F.col("title"), F.lit(""))
    whole = F.trim(F.concat(title, F.lit("\n"), T.fill_placeholders(F.coalesce("content", F.lit("")), F.col("captions"))))
    none = F.lit(None).cast("string")
    entry = lambda name, text, image: F.struct(name.alias("embedding_type"), text.alias("text"), image.alias("image"))
    of_section = F.array_compact(F.array(F.when((whole != "") & (whole != F.trim(title)), entry(F.lit("section_text"), whole, none)), F.when(title != "", entry(F.lit("section_title"), title, none))))
    told = F.trim(F.concat(F.coalesce("caption", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit(""))))
    has = F.coalesce(F.trim("path"), F.lit("")) != ""
    of_item = F.array_compact(F.array(F.when(told != "", entry(F.concat("kind", F.lit("_text")), told, none)), F.when(has, entry(F.concat("kind", F.lit("_vl")), told, F.col("path")))))
    a = s.select("document", "section", F.lit(None).cast("int").alias("at"), F.explode(of_section).alias("e"))
    b = items.select("document", "section", "at", F.explode(of_item).alias("e"))
    return a.unionByName(b).select("document", "section", "at", "e.*")


def kinds_of(types: Column) -> Column:
    """Owner kinds of a list of embedding types, in order."""
    return F.array_distinct(F.filter(F.transform(types, lambda t: F.split_part(t, F.lit("_"), F.lit(1))), lambda k: k.isin("section", "table", "figure")))


def fingerprint(passages: DataFrame, *columns: str) -> DataFrame:
    """One row (passages, digest) over all passages, the same in any order: sums of their hashes, no list of them."""
    h = F.sha2(F.concat_ws("\u0000", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    half = lambda at: F.sum(F.conv(F.substring(h, at, 8), 16, 10).cast("decimal(20,0)"))
    return passages.agg(F.count("*").alias("passages"), F.concat_ws("-", *[half(at).cast("string") for at in (1, 9, 17, 25)]).alias("digest"))


def index_state(stored: str | None, current: DataFrame) -> DataFrame:
    """current, stale or missing, by the digest that an index was built from."""
    return current.select(F.when(F.lit(stored).isNull(), "missing").when(F.col("digest") == F.lit(stored), "current").otherwise("stale").alias("state"))


def backfill_boxes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows whose bbox is null take that of their block, else that of the same text on their page, where it is the only one."""
    blocks = known.where("block_id IS NOT NULL").groupBy("document", "block_id").agg(F.min("bbox").alias("__b"), F.count_distinct("bbox").alias("__n")).where("__n = 1").drop("__n")
    text = T.flat(F.lower(F.col("text")))
    texts = known.groupBy("document", "page", text.alias("__t")).agg(F.min("bbox").alias("__c"), F.count_distinct("bbox").alias("__n")).where("__n = 1").drop("__n")
    both = rows.withColumn("__t", text).join(blocks, ["document", "block_id"], "left").join(texts, ["document", "page", "__t"], "left")
    return both.withColumn("bbox", F.coalesce("bbox", "__b", "__c")).drop("__b", "__c", "__t")


def transcribed_pages(pages: DataFrame) -> DataFrame:
    """(document, n): pages that a model read, of documents that have any."""
    return pages.where("source = 'model'").groupBy("document").agg(F.count("*").alias("n"))


def select_documents(documents: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the wanted documents, the wanted names that there are none of)."""
    return documents.join(checked(wanted), key, "left_semi"), wanted.join(documents.select(key), key, "left_anti")


def ingest(found: DataFrame, known: DataFrame) -> DataFrame:
    """Found files (filename, readable, chars, scanned) with a status, the first that fits: known, unreachable, rejected, scan,
    new. Side outputs are filters on it."""
    had = known.select("filename", F.lit(True).alias("__k"))
    status = F.when(F.col("__k"), "known").when(F.col("readable").isNull(), "unreachable").when(~F.col("readable"), "rejected").when(F.col("scanned") | (F.col("chars") == 0), "scan").otherwise("new")
    return found.join(had, "filename", "left").withColumn("status", status).drop("__k")


def coerce(cell: Column, kind: str) -> Column:
    """A spreadsheet cell as integer, real or text; what is no number is null, and so is an empty cell."""
    clean = F.nullif(F.trim(cell.cast("string")), F.lit(""))
    number = F.when(~F.lower(clean).isin("nan", "none"), clean.try_cast("double"))
    return {"INTEGER": number.cast("long"), "REAL": number, "TEXT": F.when(~F.lower(clean).isin("nan", "none"), clean)}[kind]


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per text, a section per three lines: the first its title, the second its text, the third a table."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").withColumn("k", F.floor((F.col("pos") - 1) / 3).cast("int"))
    g = s.groupBy(F.col("doc_id").alias("document"), "k").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l"))
    line = lambda i: F.get("l", i)["line"]
    page = F.col("k") + 1
    box = F.array(*[F.lit(float(v)) for v in (0, 0, 10, 10)])
    item = F.struct(F.concat(F.lit("p"), page.cast("string"), F.lit("_tbl0")).alias("id"), F.when(F.col("k") % 2 == 0, "crops/t.png").otherwise("").alias("path"), page.alias("page_number"), F.substring(line(2), 1, 20).alias("caption"), line(2).alias("body"), box.alias("bbox"))
    tables = F.when(F.size("l") > 2, F.array(item)).otherwise(F.array().cast(ITEM))
    content = F.concat(F.coalesce(line(1), F.lit("")), F.when(F.size("l") > 2, F.concat(F.lit(" [p"), page.cast("string"), F.lit("_tbl0]"))).otherwise(""))
    segments = F.transform("l", lambda x: F.struct(page.alias("page"), F.lit("text").alias("kind"), F.lit(None).cast("string").alias("ref"), x["line"].alias("text"), box.alias("bbox")))
    sec = F.struct(line(0).alias("title"), content.alias("content"), page.alias("page_number"), F.array(page, page + 1).alias("pages"), segments.alias("segments"), tables.alias("tables"), F.array().cast(ITEM).alias("figures"))
    return g.groupBy("document").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", sec.alias("s")))), lambda x: x["s"]).alias("sections"))


_FILES = LINES + """
    , k AS (SELECT doc_id AS document, CAST((pos - 1) // 3 AS INT) AS section, (pos - 1) % 3 AS i, line FROM s),
    f AS (SELECT document, section, max(line) FILTER (i = 0) AS title, coalesce(max(line) FILTER (i = 1), '') AS body, max(line) FILTER (i = 2) AS tab, count(*) AS n FROM k GROUP BY 1, 2),
    c AS (SELECT *, body || CASE WHEN n > 2 THEN ' [p' || (section + 1) || '_tbl0]' ELSE '' END AS content FROM f)
"""


@query(_FILES + "SELECT document, section, md5(title) AS title, md5(content) AS content, section + 1 AS page_number FROM c")
def loaded_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of document files."""
    return to_tables(_files(spark, sf_dir))["sections"].withColumn("title", F.md5("title")).withColumn("content", F.md5("content"))


@query(_FILES + "SELECT document, section, unnest([section + 1, section + 2]) AS page FROM c")
def loaded_section_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages a section stands on."""
    return to_tables(_files(spark, sf_dir))["section_pages"]


@query(_FILES + "SELECT document, section, CAST(i AS INT) AS ordinal, section + 1 AS page, 'text' AS kind, md5(line) AS text, '[0.0,0.0,10.0,10.0]' AS bbox FROM k")
def loaded_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of sections, in order."""
    return to_tables(_files(spark, sf_dir))["segments"].select("document", "section", "ordinal", "page", "kind", F.md5("text").alias("text"), "bbox")


@query(_FILES + "SELECT document, section, 'p' || (section + 1) || '_tbl0' AS block_id, CASE WHEN section % 2 = 0 THEN 'crops/t.png' ELSE '' END AS path, tab[1:20] AS caption FROM c WHERE n > 2")
def loaded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of sections."""
    return to_tables(_files(spark, sf_dir))["items"].select("document", "section", "block_id", "path", "caption")


@query(_FILES + """
    , w AS (SELECT *, trim(title || chr(10) || CASE WHEN n > 2 AND trim(tab[1:20]) <> '' THEN body || ' ' || trim(tab[1:20]) ELSE content END) AS whole, trim(tab[1:20] || chr(10) || tab) AS told FROM c),
    e AS (SELECT document, section, 'section_text' AS embedding_type, whole AS text FROM w WHERE whole <> '' AND whole <> trim(title) UNION ALL SELECT document, section, 'section_title', title FROM w WHERE title <> ''
          UNION ALL SELECT document, section, 'table_text', told FROM w WHERE n > 2 AND told <> '' UNION ALL SELECT document, section, 'table_vl', told FROM w WHERE n > 2 AND section % 2 = 0)
    SELECT document, section, embedding_type, md5(trim(text, ' ' || chr(10))) AS text FROM e
""")
def embedding_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What there is to embed of each section and table."""
    t = to_tables(_files(spark, sf_dir))
    return embedding_inputs(t["sections"], t["items"]).select("document", "section", "embedding_type", F.md5(F.trim("text", F.lit(" \n"))).alias("text"))


@query(_FILES + """
    , o AS (SELECT document, 'section' AS kind, section, title AS t, content AS x FROM c UNION ALL SELECT document, 'table', section, coalesce(nullif(trim(tab[1:20]), ''), title), tab FROM c WHERE n > 2)
    SELECT document, kind, section, md5(t) AS title, md5(x) AS text FROM o
""")
def owner_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections and items as records of one shape."""
    t = to_tables(_files(spark, sf_dir))
    return owner_content(t["sections"], t["items"]).select("document", "kind", "section", F.md5("title").alias("title"), F.md5("text").alias("text"))


@query("""
    WITH o AS (SELECT l_orderkey AS document, l_linenumber AS section, 'old' AS v FROM lineitem GROUP BY 1, 2), n AS (SELECT document, section + 10 AS section, 'new' AS v FROM o WHERE document % 4 = 0)
    SELECT document, section, v FROM o WHERE document % 4 <> 0 UNION ALL SELECT * FROM n
""")
def replaced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of documents loaded again, in place of the old ones."""
    old = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("section")).distinct().withColumn("v", F.lit("old"))
    new = old.where("document % 4 = 0").withColumn("section", F.col("section") + 10).withColumn("v", F.lit("new"))
    return replace_documents(old, new, "document")


@query("""
    WITH o AS (SELECT label AS owner, vec_id % 6 AS type, max(vec_id) AS id FROM embeddings WHERE vec_id % 3 <> 0 GROUP BY 1, 2), n AS (SELECT label AS owner, vec_id % 6 AS type, max(vec_id) AS id FROM embeddings WHERE vec_id % 3 = 0 GROUP BY 1, 2)
    SELECT coalesce(n.owner, o.owner) AS owner, coalesce(n.type, o.type) AS type, coalesce(n.id, o.id) AS id FROM o FULL JOIN n ON n.owner = o.owner AND n.type = o.type
""")
def upserted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of each owner and type after a batch was written."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("owner"), (F.col("vec_id") % 6).alias("type"), F.col("vec_id").alias("id"))
    return upsert(e.where("id % 3 <> 0"), e.where("id % 3 = 0"), ["owner", "type"], "id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def backfilled_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of rows already there, brought up to date; others aren't added."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    new = c.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("NEW"))
    return update_known(c, new.unionByName(new.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)), "c_custkey", ["c_mktsegment"])


@query("""
    WITH o AS (SELECT l_orderkey AS d, l_returnflag AS b, l_partkey AS k, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey) AS n FROM (SELECT DISTINCT l_orderkey, l_returnflag, l_partkey FROM lineitem WHERE l_linestatus = 'F')),
    w AS (SELECT l_orderkey AS d, l_returnflag AS b, l_partkey AS k, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey) AS n FROM (SELECT DISTINCT l_orderkey, l_returnflag, l_partkey FROM lineitem WHERE l_linestatus = 'O'))
    SELECT coalesce(o.d, w.d) AS document, coalesce(o.b, w.b) AS block, o.k AS old, w.k AS new FROM o FULL JOIN w ON w.d = o.d AND w.b = o.b AND w.n = o.n
""")
def paired_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a new version and the old rows that they take."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_returnflag").alias("block"), F.col("l_partkey").alias("k"), "l_linestatus").distinct()
    return pair_items(l.where("l_linestatus = 'F'"), l.where("l_linestatus = 'O'"), ["document", "block"], "k")


@query("""
    WITH h AS (SELECT sha256(doc_id || chr(0) || coalesce(text, '')) AS h FROM documents),
    x AS (SELECT unnest([1, 2, 3, 4]) AS part, h FROM h),
    n AS (SELECT part, CAST(sum(CAST(('0x' || h[(part - 1) * 8 + 1 : part * 8]) AS BIGINT)) AS VARCHAR) AS n, count(*) AS c FROM x GROUP BY 1)
    SELECT any_value(c) AS passages, string_agg(n, '-' ORDER BY part) AS digest FROM n
""")
def corpus_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of all passages, to tell whether an index is stale."""
    return fingerprint(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""
    WITH r AS (SELECT l_orderkey AS document, l_partkey AS id, CASE WHEN l_linenumber % 2 = 0 THEN 'b' || l_linenumber END AS block, l_linenumber AS page, 'text ' || l_returnflag AS text, CAST(l_suppkey AS VARCHAR) AS bbox FROM lineitem),
    b AS (SELECT document, block, min(bbox) AS x FROM r WHERE block IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT bbox) = 1), t AS (SELECT document, page, text, min(bbox) AS y FROM r GROUP BY 1, 2, 3 HAVING count(DISTINCT bbox) = 1)
    SELECT r.document, id, coalesce(x, y) AS bbox FROM r LEFT JOIN b ON b.document = r.document AND b.block = r.block LEFT JOIN t ON t.document = r.document AND t.page = r.page AND t.text = r.text
""")
def backfilled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes found again by block id, else by text and page."""
    n = F.col("l_linenumber")
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_partkey").alias("id"), F.when(n % 2 == 0, F.concat(F.lit("b"), n.cast("string"))).alias("block_id"), n.alias("page"), F.concat(F.lit("Text "), "l_returnflag").alias("text"), F.col("l_suppkey").cast("string").alias("bbox"))
    return backfill_boxes(known.withColumn("bbox", F.lit(None).cast("string")), known).select("document", "id", "bbox")


@query("""
    SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'known' WHEN page_id % 7 = 0 THEN 'unreachable' WHEN page_id % 3 = 0 THEN 'rejected' WHEN length(html) % 2 = 0 THEN 'scan' ELSE 'new' END AS status FROM pages
""")
def ingested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each file of a source."""
    i = F.col("page_id")
    found = table(spark, sf_dir, "pages").select(i.alias("filename"), F.when(i % 7 != 0, i % 3 != 0).alias("readable"), F.length("html").alias("chars"), (F.length("html") % 2 == 0).alias("scanned"))
    return ingest(found, found.where("filename % 5 = 0")).select(F.col("filename").alias("page_id"), "status")


@query("SELECT n_nationkey, try_cast(CASE n_nationkey % 4 WHEN 0 THEN '12' WHEN 1 THEN '3.5' WHEN 2 THEN NULL END AS DOUBLE) AS real, CAST(trunc(try_cast(CASE n_nationkey % 4 WHEN 0 THEN '12' WHEN 1 THEN '3.5' WHEN 2 THEN NULL END AS DOUBLE)) AS BIGINT) AS whole, CASE n_nationkey % 4 WHEN 0 THEN '12' WHEN 1 THEN '3.5' WHEN 3 THEN 'x' END AS word FROM nation")
def coerced_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet cells as typed columns."""
    k = F.col("n_nationkey") % 4
    cell = F.when(k == 0, " 12 ").when(k == 1, "3.5").when(k == 2, "NaN").otherwise("x")
    return table(spark, sf_dir, "nation").select("n_nationkey", coerce(cell, "REAL").alias("real"), coerce(cell, "INTEGER").alias("whole"), coerce(cell, "TEXT").alias("word"))
