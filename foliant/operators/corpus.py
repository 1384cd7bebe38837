"""Relational core of the corpus: vectors to their owners, enrichment, sections from blocks, pages filled from neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import table


def candidate_ids(vectors: DataFrame, owners: dict[str, DataFrame], documents: DataFrame) -> DataFrame:
    """(vec_id, kind, document): vectors of the owners of each kind in the given documents. owners maps a kind to
    (owner_id, document); kinds are branches of one union."""
    out = None
    for kind, own in owners.items():
        branch = vectors.where(F.col("owner_kind") == kind).join(own.join(documents, "document", "left_semi"), "owner_id").select("vec_id", F.lit(kind).alias("kind"), "document")
        out = branch if out is None else out.unionByName(branch)
    return out


def merge_enriched(items: DataFrame, enriched: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Items with their enriched columns where there are any; the old value stays where there are none."""
    new = enriched.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = items.join(new, keys, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in items.columns])


def build_sections(blocks: DataFrame, doc: str, order: str, is_title: Column, text: str) -> DataFrame:
    """(doc, section, title, content, blocks): a section starts at each title; what comes before the first is section 0."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = blocks.withColumn("__t", is_title).withColumn("section", F.sum(F.col("__t").cast("int")).over(w))
    parts = F.array_sort(F.collect_list(F.when(~F.col("__t"), F.struct(order, text))))
    return marked.groupBy(doc, "section").agg(F.max(F.when(F.col("__t"), F.col(text))).alias("title"), F.array_join(F.transform(parts, lambda x: x[text]), "\n").alias("content"), F.count("*").alias("blocks"))


def fold_bare_headings(sections: DataFrame, doc: str, order: str, empty: Column) -> DataFrame:
    """Each section's number of pending empty headings in front of it; empty ones at the end stay by themselves."""
    w = Window.partitionBy(doc).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = F.sum((~empty).cast("int")).over(w)
    return sections.withColumn("__g", group).groupBy(doc, "__g").agg(F.max(order).alias(order), F.count("*").alias("folded")).drop("__g")


def backfill_pages(rows: DataFrame, doc: str, order: str, page: str) -> DataFrame:
    """Rows without a page take that of the row before, else of the next."""
    w = Window.partitionBy(doc).orderBy(order)
    before = F.last(page, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first(page, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return rows.withColumn(page, F.coalesce(before, after))


def complete(rows: DataFrame, records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Open columns filled from a catalogue, with a flag on rows that took anything."""
    new = records.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = rows.join(new, key, "left")
    took = F.lit(False)
    for c in columns:
        took = took | (F.col(c).isNull() & F.col(f"__{c}").isNotNull())
    return out.withColumn("catalogue", took).select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in rows.columns], "catalogue")


@query("""
    SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN 'section' WHEN 1 THEN 'table' ELSE 'figure' END AS kind, s_suppkey % 50 AS document
    FROM embeddings JOIN supplier ON label = s_suppkey WHERE s_suppkey % 50 < 20
""")
def candidate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of some documents' sections, tables and figures."""
    kinds = F.element_at(F.array(F.lit("section"), F.lit("table"), F.lit("figure")), (F.col("vec_id") % 3 + 1).cast("int"))
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("owner_id"), kinds.alias("owner_kind"))
    own = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("owner_id"), (F.col("s_suppkey") % 50).alias("document"))
    return candidate_ids(v, {"section": own, "table": own, "figure": own}, own.where("document < 20").select("document"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'enriched ' || o_orderpriority ELSE o_orderpriority END AS caption FROM orders
""")
def merged_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the captions that enrichment gave them."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("caption"))
    new = o.where("o_orderkey % 3 = 0").withColumn("caption", F.concat(F.lit("enriched "), "caption"))
    return merge_enriched(o, new, ["o_orderkey"], ["caption"])


@query("""
    WITH b AS (SELECT conv_id, turn, text, role = 'user' AS t FROM conversations),
    s AS (SELECT *, sum(CASE WHEN t THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM b)
    SELECT conv_id, CAST(section AS BIGINT) AS section, max(CASE WHEN t THEN text END) AS title, coalesce(string_agg(CASE WHEN NOT t THEN text END, chr(10) ORDER BY turn), '') AS content, count(*) AS blocks
    FROM s GROUP BY 1, 2
""")
def sections_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of conversations: each user's turn is a title."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", "role")
    return build_sections(c, "conv_id", "turn", F.col("role") == "user", "text")


@query("""
    WITH g AS (SELECT user_id, event_id, sum(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS g FROM events)
    SELECT user_id, max(event_id) AS event_id, count(*) AS folded FROM g GROUP BY user_id, g
""")
def folded_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending headings folded into the next section with content."""
    return fold_bare_headings(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", F.col("event_type") == "view")


@query("""
    WITH p AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN event_id % 100 END AS page FROM events)
    SELECT user_id, event_id, coalesce(last_value(page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING),
        first_value(page IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS page FROM p
""")
def pages_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a page take that of a neighbour."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.col("event_id") % 100).alias("page"))
    return backfill_pages(e, "user_id", "event_id", "page")


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand WHEN p_partkey % 3 = 0 THEN p_type END AS brand, p_partkey % 2 <> 0 AND p_partkey % 3 = 0 AS catalogue FROM part
""")
def completed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open fields filled from a catalogue."""
    p = table(spark, sf_dir, "part")
    rows = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("brand"))
    return complete(rows, p.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_type").alias("brand")), "p_partkey", ["brand"])


@query("""SELECT event_type AS facet, user_id % 10 AS value, count(*) AS n, count(DISTINCT user_id) AS documents FROM events GROUP BY 1, 2""")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of each facet with their counts."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("facet"), (F.col("user_id") % 10).alias("value")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("documents"))
