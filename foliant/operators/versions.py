"""Document registration, versions and catalogs. The orders table stands in for documents, customers for their groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import table


def link_versions(docs: DataFrame, group: str, published: str, key: str) -> DataFrame:
    """Within a group, in order of (published, key), each document supersedes the one before; the last is current.

    A null publication date sorts first, as an empty text; documents without a group are each their own group.
    """
    solo = F.when(F.col(group).isNull(), F.col(key))
    w = Window.partitionBy(F.col(group), solo).orderBy(F.coalesce(F.col(published).cast("string"), F.lit("")), key)
    return docs.withColumn("supersedes", F.lag(key).over(w)).withColumn("is_current", F.lead(key).over(w).isNull())


def register_missing(incoming: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Rows whose name isn't registered yet, one per name."""
    return incoming.join(known.select(name), name, "left_anti").dropDuplicates([name])


def upsert(stored: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """stored with the rows of changes in place of those of equal keys, as a merge would leave it."""
    return stored.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def note_content(stored: DataFrame, seen: DataFrame, name: str = "filename", sha: str = "sha256") -> DataFrame:
    """(name, state): new, same or changed content under a name."""
    old = stored.select(name, F.col(sha).alias("old_sha"))
    state = F.when(F.col("old_sha").isNull(), "new").when(F.col("old_sha") == F.col(sha), "same").otherwise("changed")
    return seen.join(old, name, "left").select(name, state.alias("state"))


def filename_for(url: Column) -> Column:
    """The last part of a url's path, lower-cased."""
    path = F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    return F.lower(F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"([^/]*)$", 1))


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www., query, fragment and closing slashes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(url), r"[?#].*$", ""), r"^[a-z]+://(www\.)?", ""), "/+$", "")


def drop_missing(stored: DataFrame, index_ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id the index still has; an empty index is refused, as it would delete everything."""
    if index_ids.isEmpty():
        raise ValueError("the index holds no ids")
    return stored.join(index_ids.select(key).distinct(), key, "left_semi")


def add_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Schema migration: missing columns are added as nulls of their type."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in wanted.items() if c not in df.columns})


@query("""
    SELECT o_orderkey, o_custkey, lag(o_orderkey) OVER w AS supersedes, lead(o_orderkey) OVER w IS NULL AS is_current
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def version_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's predecessor of its customer, and which is the current one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return link_versions(o, "o_custkey", "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("""
    SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS current_document, count(*) AS versions
    FROM orders GROUP BY 1
""")
def current_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current document of each group and the number of its versions."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("current_document"), F.count("*").alias("versions"))


@query("""
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def registered_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups without any document yet."""
    known = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return register_missing(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), known, "c_custkey")


@query(r"""
    WITH p AS (
        SELECT lower(regexp_extract(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1)) AS filename,
               regexp_replace(regexp_replace(regexp_replace(lower(url), '[?#].*$', ''), '^[a-z]+://(www\.)?', ''), '/+$', '') AS canonical
        FROM pages)
    SELECT filename, count(*) AS pages, count(DISTINCT canonical) AS urls, count(DISTINCT canonical) > 1 AS refused FROM p GROUP BY 1
""")
def filename_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names that different canonical urls end in."""
    p = table(spark, sf_dir, "pages").select(filename_for(F.col("url")).alias("filename"), canonical_url(F.col("url")).alias("canonical"))
    return p.groupBy("filename").agg(F.count("*").alias("pages"), F.count_distinct("canonical").alias("urls"), (F.count_distinct("canonical") > 1).alias("refused"))


@query("""
    WITH old AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 3 <> 0),
         new AS (SELECT c_custkey, -c_acctbal AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)
""")
def upsert_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert or update by key, as union and anti-join."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return upsert(c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0").withColumn("c_acctbal", -F.col("c_acctbal")), ["c_custkey"])


@query("""
    WITH old AS (SELECT doc_id, md5(text) AS sha FROM documents WHERE doc_id % 4 <> 0),
         seen AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN md5(text || '!') ELSE md5(text) END AS sha FROM documents)
    SELECT seen.doc_id, CASE WHEN old.sha IS NULL THEN 'new' WHEN old.sha = seen.sha THEN 'same' ELSE 'changed' END AS state
    FROM seen LEFT JOIN old USING (doc_id)
""")
def content_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the content under each name."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = d.where("doc_id % 4 <> 0").select("doc_id", F.md5("text").alias("sha"))
    seen = d.select("doc_id", F.md5(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("sha"))
    return note_content(old, seen, "doc_id", "sha")


@query("""
    SELECT c_custkey, c_name, n_name, r_name, count(o_orderkey) AS documents, max(o_orderdate) AS latest
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""")
def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The picker's rows: each group with its place and its documents. The documents are aggregated before the join."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("documents"), F.max("o_orderdate").alias("latest"))
    c = table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").join(o, "c_custkey", "left")
    return rows.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("documents", F.lit(0)).cast("long").alias("documents"), "latest")


@query("""
    SELECT o_orderkey, list_sort(list(DISTINCT n_name)) AS places
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1
""")
def coverage_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted names of the places that each document covers."""
    l, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    places = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    rows = l.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey")).join(places, "s_suppkey").join(o, "o_orderkey")
    return rows.groupBy("o_orderkey").agg(F.sort_array(F.collect_set("n_name")).alias("places"))


@query("""
    SELECT o_clerk AS filename, least_key AS group_key FROM (
        SELECT o_orderpriority AS o_clerk, min(o_custkey) AS least_key FROM orders GROUP BY 1)
""")
def group_key_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least key of each file's groups."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("filename")).agg(F.min("o_custkey").alias("group_key"))


@query("""
    SELECT vec_id FROM embeddings WHERE label IN (SELECT DISTINCT label FROM embeddings WHERE vec_id % 7 = 0)
""")
def embeddings_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows whose owner is still in the index."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return drop_missing(e, e.where("vec_id % 7 = 0").select("label"), "label").select("vec_id")


@query("""
    WITH i AS (SELECT vec_id FROM embeddings WHERE vec_id % 5 <> 0), s AS (SELECT vec_id, vec_id % 3 = 0 AS done FROM embeddings WHERE vec_id % 4 <> 0)
    SELECT coalesce(i.vec_id, s.vec_id) AS vec_id,
           CASE WHEN s.vec_id IS NULL THEN 'no_id' WHEN i.vec_id IS NULL THEN 'no_input' WHEN s.done THEN 'done' ELSE 'pending' END AS state
    FROM i FULL JOIN s USING (vec_id)
""")
def reembed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer join of inputs and stored ids: what is pending, and what lacks an id or an input."""
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    i = e.where("vec_id % 5 <> 0").withColumn("has_input", F.lit(True))
    s = e.where("vec_id % 4 <> 0").withColumn("done", F.col("vec_id") % 3 == 0)
    state = F.when(F.col("done").isNull(), "no_id").when(F.col("has_input").isNull(), "no_input").when(F.col("done"), "done").otherwise("pending")
    return i.join(s, "vec_id", "full").select("vec_id", state.alias("state"))
