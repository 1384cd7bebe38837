"""Folds over ordered rows that no window expresses: greedy packing and grouping, alignment, sequential exclusion.

Each is an aggregate() over the ordered array of one small group (a document, a question), or applyInPandas per
document where the state is richer. Groups are bounded by a document, never by a source.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from foliant.functions import text as T
from foliant.operators.texts import sections
from foliant.registry import query
from foliant.session import ship_package, table


def per_group(rows: DataFrame, keys: list[str], fold: Callable[[list[dict]], list[tuple]], schema) -> DataFrame:
    """fold applied to the rows of each small group, as plain lists: a group arrives as one row with an array, so many
    groups share an Arrow batch."""
    spark = ship_package(rows.sparkSession)
    types = to_arrow_schema(spark.createDataFrame([], schema).schema)
    names = types.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [t for group in batch.column(0) for t in fold(group.as_py())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), types, strict=True)], names)

    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*rows.columns)).alias("rows")).select("rows").mapInArrow(run, schema)


def pack_numbers(sizes: Column, budget: int) -> Column:
    """Pack number of each size in order: a new pack opens when the next would exceed the budget; one too large has a
    pack of its own."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("pack"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, size: Column) -> Column:
        fresh = (a["pack"] < 0) | (a["sum"] + size > budget)
        pack = F.when(fresh, a["pack"] + 1).otherwise(a["pack"])
        total = F.when(fresh, size.cast("long")).otherwise(a["sum"] + size)
        return F.struct(total.alias("sum"), pack.alias("pack"), F.concat(a["out"], F.array(pack)).alias("out"))

    return F.aggregate(sizes, start, step, lambda a: a["out"])


def pack_rows(rows: DataFrame, key: str, order: str, size: str, budget: int) -> DataFrame:
    """rows (key, order, size) with their pack."""
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, size))).alias("r"))
    g = g.withColumn("p", pack_numbers(F.transform("r", lambda x: x[size]), budget))
    return g.select(key, F.inline(F.arrays_zip(F.col("r").alias("r"), F.col("p").alias("p")))).select(key, f"r.{order}", f"r.{size}", F.col("p").alias("pack"))


def cut_text(text: str, target: int, limit: int) -> list[str]:
    """Parts of at most limit words, cut at sentence ends past the target where there are any; no word is lost."""
    parts, now = [], []
    for word in (text or "").split():
        now.append(word)
        if len(now) >= limit or (len(now) >= target and word[-1] in ".!?"):
            parts.append(" ".join(now))
            now = []
    if now:
        parts.append(" ".join(now))
    return parts


def cut_to_limit(docs: DataFrame, key: str, text: str, target: int = 600, limit: int = 1000) -> DataFrame:
    """(key, part, words): long texts in parts, by a fold in the JVM over each text's words."""
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("ends"), F.lit(0).alias("at"))

    def step(a: Column, w: Column) -> Column:
        n = a["n"] + 1
        end = (n >= limit) | ((n >= target) & w.rlike(r"[.!?]$"))
        return F.struct(F.when(end, 0).otherwise(n).alias("n"), F.when(end, F.concat(a["ends"], F.array(a["at"] + 1))).otherwise(a["ends"]).alias("ends"), (a["at"] + 1).alias("at"))

    w = docs.select(key, T.words(F.col(text)).alias("w"))
    ends = F.aggregate("w", start, step, lambda a: F.when(a["n"] > 0, F.concat(a["ends"], F.array(a["at"]))).otherwise(a["ends"]))
    cut = w.withColumn("ends", ends)
    bounds = F.transform("ends", lambda e, i: F.struct(i.alias("part"), (e - F.when(i > 0, F.get("ends", i - 1)).otherwise(0)).alias("words")))
    return cut.select(key, F.inline(bounds))


def align(pairs: DataFrame, key: str) -> DataFrame:
    """(key, new, old) for entries of two versions: equal runs keep their row, inside a replaced stretch new entries take
    old rows one by one. pairs holds arrays `old` and `new` per key."""
    ship_package(pairs.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, old, new in zip(pdf[key], pdf["old"], pdf["new"], strict=True):
            for tag, a, b, c, d in difflib.SequenceMatcher(None, list(old), list(new), autojunk=False).get_opcodes():
                for i in range(d - c):
                    out.append((k, c + i, a + i if tag == "equal" or (tag == "replace" and a + i < b) else None))
        return pd.DataFrame(out, columns=[key, "new", "old"]).astype({"new": "int64", "old": "Int64"})

    return pairs.mapInPandas(lambda it: (run(p) for p in it), f"{key} long, new long, old long")


def exclude_taken(ranked: DataFrame, group: str, probe: str, owner: str, score: str, k: int) -> DataFrame:
    """(group, probe, owner): probes in order each take their k best owners that no earlier probe of the group took."""
    kind = dict(ranked.dtypes)

    def run(rows: list[dict]) -> list[tuple]:
        taken, counts, out = set(), {}, []
        for r in sorted(rows, key=lambda r: (r[probe], -r[score], r[owner])):
            if counts.get(r[probe], 0) < k and r[owner] not in taken:
                taken.add(r[owner])
                counts[r[probe]] = counts.get(r[probe], 0) + 1
                out.append((r[group], r[probe], r[owner]))
        return out

    return per_group(ranked.select(group, probe, owner, score), [group], run, f"{group} {kind[group]}, {probe} {kind[probe]}, {owner} {kind[owner]}")


def link_ranges(marks: DataFrame, key: list[str], order: str, end: str) -> DataFrame:
    """(key, low, high): range lows meet the next high of their key, first come first served."""
    kinds = dict(marks.dtypes)

    def run(rows: list[dict]) -> list[tuple]:
        waiting, out = [], []
        for r in sorted(rows, key=lambda r: r[order]):
            if r[end] == "low":
                waiting.append(r[order])
            elif waiting:
                out.append((*[r[k] for k in key], waiting.pop(0), r[order]))
        return out

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), f"low {kinds[order]}, high {kinds[order]}"])
    return per_group(marks, key, run, schema)


@query()
def pack_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document packed in order under a budget of 120 tokens."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return pack_rows(s.select("doc_id", "pos", T.count_tokens(F.col("line")).alias("size")), "doc_id", "pos", "size", 120)


@query()
def cut_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in parts of about 600 words."""
    return cut_to_limit(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


@query()
def sync_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document aligned with those of the next one."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("old"))
    n = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("old").alias("new"))
    return align(d.join(n, "doc_id"), "doc_id")


@query()
def probe_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes that take turns: each customer's order priorities take the two best clerks left."""
    o = table(spark, sf_dir, "orders")
    return exclude_taken(o.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", 2)


@query()
def linked_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lows of a range met with the next highs."""
    e = table(spark, sf_dir, "events").where("event_type IN ('view', 'click')")
    return link_ranges(e.select("user_id", "event_id", F.when(F.col("event_type") == "view", "low").otherwise("high").alias("end")), ["user_id"], "event_id", "end")
