"""Refinement of sections: actions on them, edits to their text, tables that go on, captions and content checks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.texts import LINES, sections
from foliant.registry import query
from foliant.session import ship_package, table


def apply_actions(rows: DataFrame, doc: str, pos: str, text: str, action: str) -> DataFrame:
    """(doc, pos, text, parts): keep starts a section; merge_into_previous goes to the last kept one, or is kept if there is
    none; remove drops a section. Groups come from a running count, so no fold is needed."""
    live = rows.where(F.col(action) != "remove")
    starts = (F.col(action) == "keep").cast("int")
    w = Window.partitionBy(doc).orderBy(pos)
    group = F.greatest(F.lit(1), F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = F.array_sort(F.collect_list(F.struct(pos, text)))
    out = live.withColumn("__g", group).groupBy(doc, "__g").agg(F.min(pos).alias(pos), F.array_join(F.transform(parts, lambda x: x[text]), " ").alias(text), F.count("*").alias("parts"))
    return out.drop("__g")


def join_continued(tables: DataFrame, doc: str, pos: str, page: str, columns: str, rows: str) -> DataFrame:
    """(doc, pos, tables, rows): a table with as many columns as the one before, on its page or the next, goes on from it."""
    w = Window.partitionBy(doc).orderBy(pos)
    near = (F.col(page) - F.lag(page).over(w)).between(0, 1) & (F.col(columns) == F.lag(columns).over(w))
    run = tables.withColumn("__new", (~F.coalesce(near, F.lit(False))).cast("int")).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return run.groupBy(doc, "__run").agg(F.min(pos).alias(pos), F.count("*").alias("tables"), F.sum(rows).alias("rows")).drop("__run")


def correct(text: str, edits: list[tuple[str, str]], shrink: float = 0.3) -> tuple[str, int]:
    """(text, edits applied): each find must occur once, the longest wins where two overlap, and a result that lost more
    than `shrink` of the text is refused whole."""
    spans = []
    for find, put in sorted(edits, key=lambda e: (-len(e[0]), e[0])):
        at = text.find(find)
        if find and at >= 0 and text.find(find, at + 1) < 0 and all(at + len(find) <= a or at >= b for a, b, _ in spans):
            spans.append((at, at + len(find), put))
    out, done = [], 0
    for a, b, put in sorted(spans):
        out += [text[done:a], put]
        done = b
    made = "".join(out) + text[done:]
    return (made, len(spans)) if len(made) >= (1 - shrink) * len(text) else (text, 0)


def apply_corrections(docs: DataFrame, key: str, text: str, edits: DataFrame) -> DataFrame:
    """(key, text, applied) with edits (key, find, put) folded per document."""
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [correct(t or "", [(e["find"], e["put"]) for e in es or []]) for t, es in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], [key, text, "applied"])

    per = edits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("find", "put"))).alias("edits"))
    return docs.select(key, text).join(per, key, "left").mapInArrow(run, f"{key} {kind}, {text} string, applied long")


def dropped_text(before: DataFrame, after: DataFrame, key: str, text: str, k: int = 8) -> DataFrame:
    """(key, shingles, lost): runs of k words that did not survive, compared per document by arrays."""
    a = before.select(key, F.array_distinct(T.shingles(F.col(text), k)).alias("a"))
    b = after.select(key, F.array_distinct(T.shingles(F.col(text), k)).alias("b"))
    lost = F.size(F.array_except("a", F.coalesce("b", F.array().cast("array<long>"))))
    return a.join(b, key, "left").select(key, F.size("a").alias("shingles"), lost.alias("lost"))


_ACTIONS = LINES + """
    , a AS (SELECT doc_id, pos, line, CASE WHEN pos % 7 = 3 THEN 'remove' WHEN pos % 3 = 0 THEN 'merge_into_previous' ELSE 'keep' END AS action FROM s),
    g AS (SELECT *, greatest(1, sum(CASE WHEN action = 'keep' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS g FROM a WHERE action <> 'remove')
    SELECT doc_id, min(pos) AS pos, md5(string_agg(line, ' ' ORDER BY pos)) AS line, count(*) AS parts FROM g GROUP BY doc_id, g
"""


@query(_ACTIONS)
def refined_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections after their actions."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    action = F.when(F.col("pos") % 7 == 3, "remove").when(F.col("pos") % 3 == 0, "merge_into_previous").otherwise("keep")
    return apply_actions(s.withColumn("action", action), "doc_id", "pos", "line", "action").withColumn("line", F.md5("line"))


@query("""
    WITH t AS (SELECT l_orderkey AS doc, (l_linenumber * 100000 + l_partkey) * 10000 + l_suppkey AS pos, l_linenumber AS page, l_suppkey % 2 AS cols, CAST(l_quantity AS BIGINT) AS n FROM lineitem),
    m AS (SELECT *, CASE WHEN page - lag(page) OVER w BETWEEN 0 AND 1 AND cols = lag(cols) OVER w THEN 0 ELSE 1 END AS fresh FROM t WINDOW w AS (PARTITION BY doc ORDER BY pos)),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT doc, min(pos) AS pos, count(*) AS tables, CAST(sum(n) AS BIGINT) AS rows FROM r GROUP BY doc, run
""")
def continued_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables folded into the one they go on from."""
    l = table(spark, sf_dir, "lineitem")
    pos = ((F.col("l_linenumber") * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")).cast("long")
    t = l.select(F.col("l_orderkey").alias("doc"), pos.alias("pos"), F.col("l_linenumber").alias("page"), (F.col("l_suppkey") % 2).alias("cols"), F.col("l_quantity").cast("long").alias("n"))
    return join_continued(t, "doc", "pos", "page", "cols", "n")


@query()
def corrected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits applied to texts."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    edits = d.select("doc_id", F.explode(F.split("text", "\n")).alias("find")).where(F.length("find") > 30).select("doc_id", "find", F.upper("find").alias("put"))
    return apply_corrections(d, "doc_id", "text", edits).select("doc_id", F.md5("text").alias("sha"), "applied")


@query()
def lost_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first hundred words of a text leave out."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dropped_text(d, d.withColumn("text", T.capped(F.col("text"), 100)), "doc_id", "text")
