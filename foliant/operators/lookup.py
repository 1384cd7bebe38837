"""Passages around a place, searches in them, pools and orders of hits, and answers put together from them.

Lines of documents stand in for passages, embeddings for value lines, conversations for the answers of a chat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators.retrieval import nearest, top
from foliant.operators.texts import LINES, sections
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked


def sections_up_to(passages: DataFrame, asked: DataFrame, document: str, pos: str, count: int) -> DataFrame:
    """(asked..., place): the last `count` sections of a document up to a position; passages (document, pos, kind).

    Each section is numbered within its document once, and an asked position meets the sections by a join on the document.
    """
    s = passages.where("kind = 'section'").select(document, F.col(pos).alias("place"))
    met = asked.join(s, document).where(F.col("place") <= F.col(pos))
    w = Window.partitionBy(document, pos).orderBy(F.desc("place"))
    return met.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= count).drop("__r")


def fetch_run(passages: DataFrame, document: str, pos: str, count: int, forward: bool = True) -> DataFrame:
    """(document, pos, fetched): the next (or previous) `count` sections from every section, fewer at the end, nearest first."""
    w = Window.partitionBy(document).orderBy(F.asc(pos) if forward else F.desc(pos)).rowsBetween(1, count)
    near = passages.where("kind = 'section'").select(document, pos, F.collect_list(pos).over(w).alias("fetched"))
    return near.where(F.size("fetched") > 0)


def item(passages: DataFrame, document: str, block: str) -> DataFrame:
    """Tables and figures by their block id, in any form a text prints it; an id that two passages carry names none."""
    clean = F.lower(F.regexp_extract(F.col(block), r"([A-Za-z0-9_]+)", 1))
    items = passages.where(F.col("kind").isin("table", "figure")).withColumn("block_id", clean)
    return items.withColumn("__n", F.count("*").over(Window.partitionBy(document, "block_id"))).where("__n = 1").drop("__n")


def page_span_chars(passages: DataFrame, document: str, pages: Column, span: float) -> DataFrame:
    """(document, chars): the text of `span` pages of a document, by its mean; figures aren't counted."""
    g = passages.groupBy(document).agg(F.sum(F.when(F.col("kind") != "figure", F.length("text")).otherwise(0)).alias("c"), F.greatest(F.max(pages), F.lit(1)).alias("p"))
    return g.select(document, F.greatest(F.lit(1), F.round(F.lit(span) * F.col("c") / F.col("p"))).cast("long").alias("chars"))


def matching(passages: DataFrame, document: str, pos: str, pattern: str, room: int) -> DataFrame:
    """(document, pos, line, total): passages that match a pattern, in order, while their hits fit in `room` characters.

    Once one doesn't fit, none after it is shown; total counts every match of the document.
    """
    hit = passages.where(F.col("text").rlike("(?im)" + pattern)).select(document, pos, F.trim(F.regexp_extract("text", "(?im)^.*(?:" + pattern + ").*$", 0)).alias("line"))
    w = Window.partitionBy(document)
    used = F.sum(F.length("line") + 40).over(w.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return hit.withColumn("used", used).withColumn("total", F.count("*").over(w)).where(F.col("used") <= room).drop("used")


def around(first: Column, last: Column, table_rows: int, lines: int, kind: Column) -> Column:
    """Numbers of the lines to show around a value."""
    more = F.when(kind == "table", table_rows).otherwise(lines)
    return F.sequence(F.greatest(F.lit(1), first - more), last + more)


def blocks_of(shown: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by..., first, last): runs of consecutive lines."""
    w = Window.partitionBy(*by).orderBy(number)
    return shown.withColumn("__g", F.col(number) - F.row_number().over(w)).groupBy(*by, "__g").agg(F.min(number).alias("first"), F.max(number).alias("last")).drop("__g")


def nearest_lines(probes: DataFrame, values: DataFrame, k: int, line: str, levels: list[str] | None = None) -> DataFrame:
    """(probe, line, vec_id, score, rank): the k nearest value lines of each probe in levels; values that read alike stand once.

    Scores come from blocks of vectors in the workers (retrieval.nearest), with the best of each line kept there.
    """
    chosen = values if levels is None else values.where(F.col("level").isin(*levels))
    best = nearest(probes, chosen, k, owner=line)
    return best.select("probe", line, "vec_id", "score", "rank")


def pool_of(ranked: DataFrame, query_: str, kind: str, rank: str, size: int, drawn: int = 0, upto: int = 0, seed: str = "") -> DataFrame:
    """ranked with `in_pool`: of each kind its first `size` and `drawn` of the places after them up to `upto`, by a hash."""
    place = F.row_number().over(Window.partitionBy(query_, kind).orderBy(rank))
    out = ranked.withColumn("__p", place)
    lot = F.sha2(F.concat_ws("|", F.lit(seed), F.col(query_).cast("string"), F.col(kind), F.col("__p").cast("string")), 256)
    beyond = (F.col("__p") > size) & (F.col("__p") <= max(upto, size))
    by_lot = F.row_number().over(Window.partitionBy(query_, kind, beyond).orderBy(lot))
    return out.withColumn("__d", F.when(beyond, by_lot)).withColumn("in_pool", (F.col("__p") <= size) | F.coalesce(F.col("__d") <= drawn, F.lit(False))).drop("__p", "__d")


def reordered(pooled: DataFrame, query_: str, rank: str, score: str) -> DataFrame:
    """The pool by falling score, equal ones in their old order, then the rest in theirs."""
    w = Window.partitionBy(query_).orderBy(F.desc("in_pool"), F.when(F.col("in_pool"), -F.col(score)), rank)
    return pooled.withColumn("place", F.row_number().over(w))


def corpus_top(scored: DataFrame, query_: str, owner: str, score: str, k: int, current: Column, excluded: DataFrame | None = None) -> DataFrame:
    """(query, owner, score, rank): the best passages of current documents, one per passage. Filters come before the cut,
    so nothing is fetched twice."""
    s = scored.where(current)
    if excluded is not None:
        s = s.join(checked(excluded), [query_, owner], "left_anti")
    return top(s.groupBy(query_, owner).agg(F.max(score).alias(score)), [query_], score, owner, k)


def merge_answers(parts: DataFrame, key: str, order: str, text: str, citations: str) -> DataFrame:
    """(key, text, citations): answers joined in order, their citation marks [n] moved past those of the answers before.

    parts of a key are the few batches of one turn; the texts are joined, and each keeps its own numbering within.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    moved = parts.withColumn("__o", F.coalesce(F.sum(citations).over(w), F.lit(0)))
    # Marks are moved from the highest down, so none is moved twice.
    marks = F.sequence(F.lit(0), F.col(citations) - 1)
    new = F.aggregate(F.when(F.col(citations) > 0, F.reverse(marks)).otherwise(F.array().cast("array<int>")), F.col(text), lambda t, i: F.replace(t, F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]")), F.concat(F.lit("["), (i + 1 + F.col("__o")).cast("string"), F.lit("]"))))
    g = moved.withColumn("__t", new).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "__t"))).alias("p"), F.sum(citations).alias("citations"))
    return g.select(key, F.array_join(F.transform("p", lambda x: x["__t"]), "\n\n").alias(text), "citations")


def markdown_table(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """(key, table): the few rows of each key as a Markdown table."""
    cell = lambda c: F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))).alias("p"))
    return g.select(key, F.concat(F.lit(head), F.array_join(F.transform("p", lambda x: x["l"]), "\n")).alias("table"))


def used_values(values: DataFrame, statements: DataFrame, key: str, value: str) -> DataFrame:
    """Values behind the shown statements, each once, with the number they are cited by, in the order of their first use."""
    first = statements.groupBy(key, value).agg(F.min("statement").alias("first"))
    n = F.row_number().over(Window.partitionBy(key).orderBy("first", value))
    return values.join(first.withColumn("citation", n), [key, value])


def rest_of(passages: DataFrame, shown: DataFrame, document: str, pos: str) -> DataFrame:
    """The passages of the asked documents that weren't shown."""
    return passages.join(shown.select(document).distinct(), document, "left_semi").join(shown, [document, pos], "left_anti")


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line a table, every seventh a figure, the others sections."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    kind = F.when(F.col("pos") % 3 == 0, "table").when(F.col("pos") % 7 == 0, "figure").otherwise("section")
    return s.select("doc_id", "pos", kind.alias("kind"), F.col("line").alias("text"))


_P = LINES + """, p AS (SELECT doc_id, pos, line, CASE WHEN pos % 3 = 0 THEN 'table' WHEN pos % 7 = 0 THEN 'figure' ELSE 'section' END AS kind FROM s)"""


@query(_P + """
    , a AS (SELECT doc_id, pos FROM p WHERE pos % 5 = 0), m AS (SELECT a.doc_id, a.pos, p.pos AS place, row_number() OVER (PARTITION BY a.doc_id, a.pos ORDER BY p.pos DESC) AS r FROM a JOIN p ON p.doc_id = a.doc_id AND p.kind = 'section' AND p.pos <= a.pos)
    SELECT doc_id, pos, place FROM m WHERE r <= 3
""")
def sections_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last three sections up to every fifth passage."""
    p = _passages(spark, sf_dir)
    return sections_up_to(p, p.where("pos % 5 = 0").select("doc_id", "pos"), "doc_id", "pos", 3)


@query(_P + """, f AS (SELECT doc_id, pos, list(pos) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS fetched FROM p WHERE kind = 'section')
    SELECT * FROM f WHERE len(fetched) > 0""")
def fetched_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next two sections of each."""
    return fetch_run(_passages(spark, sf_dir).select("doc_id", "pos", "kind"), "doc_id", "pos", 2)


@query(_P + """, b AS (SELECT doc_id, pos, 'p' || (pos % 8) || '_x' AS block_id FROM p WHERE kind IN ('table', 'figure'))
    SELECT doc_id, min(pos) AS pos, block_id FROM b GROUP BY doc_id, block_id HAVING count(*) = 1""")
def items_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that their block id names alone."""
    p = _passages(spark, sf_dir).withColumn("block", F.concat(F.lit("[P"), (F.col("pos") % 8).cast("string"), F.lit("_x]")))
    return item(p, "doc_id", "block").select("doc_id", "pos", "block_id")


@query(_P + """SELECT doc_id, CAST(greatest(1, round(2.0::DOUBLE * sum(CASE WHEN kind <> 'figure' THEN length(line) ELSE 0 END) / greatest(max((pos - 1) // 10 + 1), 1))) AS BIGINT) AS chars FROM p GROUP BY 1""")
def two_page_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of two pages of ten lines."""
    return page_span_chars(_passages(spark, sf_dir), "doc_id", F.floor((F.col("pos") - 1) / 10) + 1, 2.0)


@query(_P + r"""
    , h AS (SELECT doc_id, pos, trim(line) AS line FROM p WHERE regexp_matches(line, '(?i)(^| )(der|the|les)( |$)')),
    u AS (SELECT *, sum(length(line) + 40) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS used, count(*) OVER (PARTITION BY doc_id) AS total FROM h)
    SELECT doc_id, pos, md5(line) AS line, total FROM u WHERE used <= 900
""")
def matched_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that match a pattern, as many as fit."""
    return matching(_passages(spark, sf_dir), "doc_id", "pos", "(^| )(der|the|les)( |$)", 900).withColumn("line", F.md5("line"))


@query(_P + """, e AS (SELECT doc_id, pos, unnest(range(greatest(1, pos - CASE WHEN kind = 'table' THEN 1 ELSE 2 END), pos + CASE WHEN kind = 'table' THEN 1 ELSE 2 END + 1)) AS n FROM p WHERE pos % 9 IN (0, 4)),
    d AS (SELECT DISTINCT doc_id, n FROM e), g AS (SELECT *, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS g FROM d)
    SELECT doc_id, min(n) AS first, max(n) AS last FROM g GROUP BY doc_id, g""")
def shown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines around values, as runs."""
    p = _passages(spark, sf_dir).where("pos % 9 IN (0, 4)")
    lines = p.select("doc_id", F.explode(around(F.col("pos"), F.col("pos"), 1, 2, F.col("kind"))).alias("n")).distinct()
    return blocks_of(lines, ["doc_id"], "n")


_RANKED = """
    WITH r AS (SELECT lang, source, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
    p AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY rank) AS p FROM r),
    l AS (SELECT *, p > 3 AND p <= 12 AS beyond FROM p),
    d AS (SELECT *, CASE WHEN beyond THEN row_number() OVER (PARTITION BY lang, source, beyond ORDER BY sha256('s|' || lang || '|' || source || '|' || p)) END AS d FROM l),
    o AS (SELECT *, p <= 3 OR coalesce(d <= 2, false) AS in_pool FROM d)
"""


def _pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars")
    ranked = d.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id")))
    return pool_of(ranked, "lang", "source", "rank", 3, 2, 12, "s")


@query(_RANKED + "SELECT lang, source, doc_id, rank, in_pool FROM o")
def rerank_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which hits of each kind a reranker reads."""
    return _pooled(spark, sf_dir).select("lang", "source", "doc_id", "rank", "in_pool")


@query(_RANKED + "SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY in_pool DESC, CASE WHEN in_pool THEN -(doc_id * 7 % 101) END NULLS FIRST, rank) AS place FROM o")
def reranked_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in the order of a second score."""
    p = _pooled(spark, sf_dir).withColumn("score", F.col("doc_id") * 7 % 101)
    return reordered(p, "lang", "rank", "score").select("lang", "doc_id", "place")


@query("""
    WITH s AS (SELECT l_returnflag AS q, l_orderkey AS owner, max(l_extendedprice) AS score FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
        AND NOT (l_orderkey % 10 = 3 AND l_returnflag = 'A') GROUP BY 1, 2)
    SELECT q, owner, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, owner) AS rank FROM s) WHERE rank <= 25
""")
def corpus_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best passages of the whole corpus, of current documents and without excluded ones."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("q"), F.col("l_orderkey").alias("owner"), F.col("l_extendedprice").alias("score"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("owner"), (F.col("o_orderstatus") != "P").alias("current"))
    excluded = l.where("owner % 10 = 3 AND q = 'A'").select("q", "owner").distinct()
    return corpus_top(l.join(o, "owner"), "q", "owner", "score", 25, F.col("current"), excluded)


@query("""
    WITH b AS (SELECT conv_id, turn, turn % 3 AS n, 'part ' || turn || CASE turn % 3 WHEN 1 THEN ' [1]' WHEN 2 THEN ' [1] and [2]' ELSE '' END AS t FROM conversations),
    o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM b),
    m AS (SELECT conv_id, turn, n, replace(replace(t, '[2]', '[' || CAST(2 + o AS BIGINT) || '#'), '[1]', '[' || CAST(1 + o AS BIGINT) || '#') AS t FROM o)
    SELECT conv_id, replace(string_agg(t, chr(10) || chr(10) ORDER BY turn), '#', ']') AS answer, CAST(sum(n) AS BIGINT) AS citations FROM m GROUP BY 1
""")
def merged_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of several batches as one, citations numbered through."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") % 3).cast("int").alias("n"))
    marks = F.when(F.col("n") == 1, " [1]").when(F.col("n") == 2, " [1] and [2]").otherwise("")
    return merge_answers(c.withColumn("answer", F.concat(F.lit("part "), F.col("turn").cast("string"), marks)), "conv_id", "turn", "answer", "n")


@query("""
    SELECT o_custkey, '| o_orderkey | o_orderstatus |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || o_orderkey || ' | ' || o_orderstatus || ' |', chr(10) ORDER BY o_orderkey) AS "table" FROM orders GROUP BY 1
""")
def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a Markdown table."""
    return markdown_table(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"])


@query(HARVEST + """
    , s AS (SELECT document, pos % 6 AS value, pos AS statement FROM h WHERE discount < 0.06), f AS (SELECT document, value, min(statement) AS first FROM s GROUP BY 1, 2)
    SELECT document, value, 'v' || value AS label, first, row_number() OVER (PARTITION BY document ORDER BY first, value) AS citation FROM f
""")
def cited_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values behind an answer with their citation numbers."""
    h = harvest(spark, sf_dir)
    value = (F.col("pos") % 6).alias("value")
    values = h.select("document", value).distinct().withColumn("label", F.concat(F.lit("v"), F.col("value").cast("string")))
    statements = h.where("discount < 0.06").select("document", value, F.col("pos").alias("statement"))
    return used_values(values, statements, "document", "value")


@query(_P + "SELECT doc_id, pos FROM p WHERE kind <> 'section' AND doc_id IN (SELECT doc_id FROM p WHERE kind = 'section')")
def remaining_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each document wasn't shown, the sections being shown."""
    p = _passages(spark, sf_dir).select("doc_id", "pos", "kind")
    return rest_of(p, p.where("kind = 'section'").select("doc_id", "pos"), "doc_id", "pos").select("doc_id", "pos")


@query("""
    WITH v AS (SELECT vec_id, label % 3 AS level, 'line ' || (vec_id % 50) AS line, embedding FROM embeddings), pr AS (SELECT vec_id AS probe, embedding AS wanted FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT probe, vec_id, line, round(list_sum(list_transform(list_zip(embedding, wanted), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 5) AS score FROM v, pr WHERE level IN (0, 1)),
    b AS (SELECT *, row_number() OVER (PARTITION BY probe, line ORDER BY score DESC, vec_id) AS r FROM s),
    t AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, vec_id) AS rank FROM b WHERE r = 1)
    SELECT probe, line, vec_id, score, rank FROM t WHERE rank <= 10
""")
def nearest_value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest value lines of each probe in the better levels, each line once."""
    e = table(spark, sf_dir, "embeddings")
    v = e.select("vec_id", (F.col("label") % 3).cast("string").alias("level"), F.concat(F.lit("line "), (F.col("vec_id") % 50).cast("string")).alias("line"), "embedding")
    probes = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("probe"), F.col("embedding").alias("wanted"))
    return nearest_lines(probes, v, 10, "line", ["0", "1"])
