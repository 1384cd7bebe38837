"""Geometry of pages: boxes, suppression, reading order, captions. Boxes are columns x0, y0, x1, y1.

Pages are small and independent, so each greedy rule runs on the rows of one page at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from foliant.operators.folds import per_group
from foliant.registry import query
from foliant.session import table

IOU = 0.5


def area(x0, y0, x1, y1):
    """Works on columns of Spark and of pandas alike where coordinates are ordered."""
    return (x1 - x0) * (y1 - y0)


def overlap(a: str, b: str) -> Column:
    """Share of box a that box b covers; prefixes name the boxes."""
    w = F.greatest(F.lit(0.0), F.least(f"{a}x1", f"{b}x1") - F.greatest(f"{a}x0", f"{b}x0"))
    h = F.greatest(F.lit(0.0), F.least(f"{a}y1", f"{b}y1") - F.greatest(f"{a}y0", f"{b}y0"))
    return F.try_divide(w * h, area(F.col(f"{a}x0"), F.col(f"{a}y0"), F.col(f"{a}x1"), F.col(f"{a}y1")))


def iou(a: tuple, b: tuple) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    both = w * h
    return both / (area(*a) + area(*b) - both)


def _box(r: dict) -> tuple:
    return r["x0"], r["y0"], r["x1"], r["y1"]


def suppress(boxes: DataFrame, by: list[str], least: float = IOU) -> DataFrame:
    """Greedy suppression: best score first (ties by id), a box goes if it overlaps a kept one by more than least."""

    columns = boxes.columns

    def run(rows: list[dict]) -> list[tuple]:
        kept, out = [], []
        for r in sorted(rows, key=lambda r: (-r["score"], r["id"])):
            if all(iou(_box(r), k) <= least for k in kept):
                kept.append(_box(r))
                out.append(tuple(r[c] for c in columns))
        return out

    return per_group(boxes, by, run, boxes.schema)


def match_boxes(truth: DataFrame, found: DataFrame, page: str) -> DataFrame:
    """(page, truth, found, kind): one-to-one by falling IoU from 0.5 on; kind match, confusion, missed or extra."""

    def run(rows: list[dict]) -> list[tuple]:
        a, b = (sorted((r for r in rows if r["side"] == side), key=lambda r: r["id"]) for side in (0, 1))
        pairs = sorted((-v, i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (v := iou(_box(x), _box(y))) >= IOU)
        used_a, used_b, out, at = set(), set(), [], rows[0][page]
        for _, i, j in pairs:
            if i not in used_a and j not in used_b:
                used_a.add(i)
                used_b.add(j)
                out.append((at, a[i]["id"], b[j]["id"], "match" if a[i]["label"] == b[j]["label"] else "confusion"))
        out += [(at, r["id"], None, "missed") for i, r in enumerate(a) if i not in used_a]
        return out + [(at, None, r["id"], "extra") for j, r in enumerate(b) if j not in used_b]

    both = truth.withColumn("side", F.lit(0)).unionByName(found.withColumn("side", F.lit(1)))
    return per_group(both, [page], run, f"{page} {dict(truth.dtypes)[page]}, truth long, found long, kind string")


def reading_order(blocks: DataFrame, page: str, width: float, spanning: float = 0.6) -> DataFrame:
    """blocks with their place: wide blocks part a page into bands; a band's columns are read left to right, each down."""

    columns = blocks.columns

    def run(rows: list[dict]) -> list[tuple]:
        band, keyed = 0, []
        for r in sorted(rows, key=lambda r: (r["y0"], r["x0"], r["id"])):
            wide = r["x1"] - r["x0"] >= spanning * width
            band += wide
            keyed.append(((2 * band + (not wide), not wide and (r["x0"] + r["x1"]) / 2 > width / 2, r["y0"], r["x0"], r["id"]), r))
        return [(*(r[c] for c in columns), i) for i, (_, r) in enumerate(sorted(keyed, key=lambda x: x[0]), 1)]

    return per_group(blocks, [page], run, StructType([*blocks.schema.fields, StructField("place", IntegerType())]))


def captions(media: DataFrame, texts: DataFrame, page: str, reach: float = 60.0) -> DataFrame:
    """(page, media, caption): each medium in order takes the nearest free caption of its page within reach."""

    def run(rows: list[dict]) -> list[tuple]:
        used, out = set(), []
        for m in sorted((r for r in rows if r["side"] == 0), key=lambda r: r["id"]):
            gaps = [(max(c["y0"] - m["y1"], m["y0"] - c["y1"], 0.0), c["id"]) for c in rows if c["side"] == 1 and c["id"] not in used]
            best = min((g for g in gaps if g[0] <= reach), default=None)
            if best:
                used.add(best[1])
                out.append((m[page], m["id"], best[1]))
        return out

    both = media.withColumn("side", F.lit(0)).unionByName(texts.withColumn("side", F.lit(1)))
    return per_group(both, [page], run, f"{page} {dict(media.dtypes)[page]}, media long, caption long")


def _page_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes from parts of orders: a page per order, geometry from quantities."""
    l = table(spark, sf_dir, "lineitem")
    x, y = (F.col("l_partkey") % 400).cast("double"), (F.col("l_suppkey") * 37 % 600).cast("double")
    return l.select(
        F.col("l_orderkey").alias("page"), ((F.col("l_linenumber") * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")).cast("long").alias("id"), F.col("l_returnflag").alias("label"), F.col("l_quantity").alias("score"),
        x.alias("x0"), y.alias("y0"), (x + 100 + F.col("l_quantity") * 5).alias("x1"), (y + 80 + F.col("l_quantity")).alias("y1"))


@query()
def suppressed_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes left by greedy suppression per page and label."""
    return suppress(_page_boxes(spark, sf_dir), ["page", "label"]).select("page", "id", "label", "score")


@query()
def matched_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a truth matched with found ones."""
    b = _page_boxes(spark, sf_dir)
    return match_boxes(b.where("score % 2 = 0"), b.where("score % 3 = 0"), "page")


@query()
def ordered_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in reading order."""
    return reading_order(_page_boxes(spark, sf_dir), "page", 600.0).select("page", "id", "place")


@query()
def nearest_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions given to media."""
    b = _page_boxes(spark, sf_dir)
    return captions(b.where("label = 'A'"), b.where("label = 'N'"), "page")


@query("""
    WITH b AS (SELECT l_orderkey AS page, (l_linenumber * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_quantity AS q, CAST(l_partkey % 400 AS DOUBLE) AS x0, CAST(l_suppkey * 37 % 600 AS DOUBLE) AS y0 FROM lineitem WHERE true),
    c AS (SELECT page, id, x0, y0, x0 + 100 + q * 5 AS x1, y0 + 80 + q AS y1 FROM b)
    SELECT a.page, a.id AS a, b.id AS b FROM c a JOIN c b ON a.page = b.page AND a.id <> b.id
    WHERE greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) / ((a.x1 - a.x0) * (a.y1 - a.y0)) >= 0.9
""")
def covered_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that another box covers: a spatial predicate within a page, where boxes are few."""
    b = _page_boxes(spark, sf_dir).select("page", "id", "x0", "y0", "x1", "y1")
    side = lambda p: b.select("page", *[F.col(c).alias(p + c) for c in b.columns[1:]])
    both = side("a").join(side("b"), "page").where("aid <> bid")
    return both.where(overlap("a", "b") >= 0.9).select("page", F.col("aid").alias("a"), F.col("bid").alias("b"))
