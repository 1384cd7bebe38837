"""Structure of documents: fonts, headings, directories, title pages, gutters, and long sections cut into parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators.folds import per_group
from foliant.operators.layout import _box, _page_boxes, iou
from foliant.operators.texts import LINES, sections
from foliant.registry import query
from foliant.session import table

# A heading's length, size against the body and least length in capitals; a directory's thresholds.
HEADING_MIN, HEADING_MAX, HEADING_RATIO, CAPITALS_MIN = 3, 120, 1.2, 6
DIRECTORY_SCORE, DIRECTORY_TITLED, DIRECTORY_HEAD, DIRECTORY_REST, DIRECTORY_ENTRIES, DIRECTORY_HEAD_CHARS = 0.55, 0.35, 0.5, 350, 4, 600
MEDIA = ("table", "image", "chart")
#: Words below which a part is no part of its own.
LEAST_PART = 100


def body_size(blocks: DataFrame, document: str) -> DataFrame:
    """(document, body): the font size that most characters of plain text have, the smaller of equals."""
    n = blocks.where((F.col("type") == "text") & F.col("size").isNotNull()).groupBy(document, "size").agg(F.sum(F.length("content")).alias("n"))
    return n.groupBy(document).agg(F.max_by("size", F.struct(F.col("n"), -F.col("size"))).alias("body"))


def dominant_font(spans: DataFrame, block: list[str]) -> DataFrame:
    """(block..., size, bold): the size that most characters of a block have, and whether at least half of them are bold."""
    n = spans.where("chars > 0").groupBy(*block, F.round("size", 1).alias("size")).agg(F.sum("chars").alias("n"), F.sum(F.when(F.col("bold"), F.col("chars")).otherwise(0)).alias("b"))
    return n.groupBy(*block).agg(F.max_by("size", F.struct(F.col("n"), -F.col("size"))).alias("size"), (F.sum("b") * 2 >= F.sum("n")).alias("bold"))


def looks_like_heading(text: Column, size: Column, bold: Column, body: Column) -> Column:
    """Short, no prose, and larger than the body, bold and larger, or in capitals."""
    n, t = F.length(text), F.trim(text)
    prose = t.rlike(r"[.!?]$") | t.rlike(r"[.!?]\s+[A-ZÄÖÜ]")
    larger = F.coalesce((size >= body * HEADING_RATIO) | (bold & (size > body)), F.lit(False))
    capitals = t.rlike(r"\p{Lu}") & ~t.rlike(r"\p{Ll}") & (n >= CAPITALS_MIN) & F.coalesce(size >= body, F.lit(True))
    return F.coalesce(n.between(HEADING_MIN, HEADING_MAX) & ~prose & (larger | capitals), F.lit(False))


def promote_headings(blocks: DataFrame, document: str, page: str) -> DataFrame:
    """blocks whose unlabelled text looks like a heading become titles, unless they share a row with a medium, title or caption
    of their page. Pages hold few blocks; they meet on the page."""
    sized = blocks.join(body_size(blocks, document), document, "left")
    hit = sized.where((F.col("type") == "text") & F.col("label").isNull() & looks_like_heading(F.col("content"), F.col("size"), F.coalesce("bold", F.lit(False)), F.col("body")))
    taken = blocks.where(F.col("type").isin("table", "image") | F.coalesce(F.col("label").isin("paragraph_title", "doc_title", "caption"), F.lit(False))).select(document, page, F.col("y0").alias("__a"), F.col("y1").alias("__b"))
    same_row = (F.least("y1", "__b") - F.greatest("y0", "__a")) / F.greatest(F.lit(1e-9), F.col("y1") - F.col("y0")) > 0.8
    beside = hit.join(taken, [document, page]).where(same_row).select(document, page, "id").distinct()
    chosen = hit.join(beside, [document, page, "id"], "left_anti").select(document, page, "id", F.lit(True).alias("__p"))
    return blocks.join(chosen, [document, page, "id"], "left").withColumn("label", F.when(F.col("__p"), "paragraph_title").otherwise(F.col("label"))).drop("__p")


def title_page(blocks: DataFrame, document: str, page: str) -> DataFrame:
    """(document, page): that of the first title block with text, else the first page."""
    titled = (F.col("label") == "doc_title") & (F.coalesce(F.trim("content"), F.lit("")) != "")
    return blocks.groupBy(document).agg(F.coalesce(F.min(F.when(titled, F.col(page))), F.min(page)).alias(page))


def multi_column_pages(gutters: DataFrame, document: str) -> DataFrame:
    """(document, pages, widest): pages with a gutter, and the most columns of one."""
    return gutters.groupBy(document).agg(F.count_if(F.col("gutters") > 0).alias("pages"), (F.max("gutters") + 1).alias("widest"))


def find_gutters(blocks: DataFrame, page: str, width: float, least_gap: float = 8.0, least_share: float = 0.15, spanning: float = 0.6) -> DataFrame:
    """(page, gutters, edges): empty vertical strips between the text blocks of a page, found by a sweep over x.

    Wide blocks don't count, and a column needs least_share of the characters of the page, else it joins the one before.
    The blocks of a page are few and are swept as one list.
    """
    kind = dict(blocks.dtypes)[page]

    def run(rows: list[dict]) -> list[tuple]:
        narrow = sorted((r["x0"], r["x1"], r["chars"]) for r in rows if r["x1"] - r["x0"] < spanning * width)
        columns: list[list[float]] = []
        for x0, x1, chars in narrow:
            if columns and x0 < columns[-1][1] + least_gap:
                columns[-1][1] = max(columns[-1][1], x1)
                columns[-1][2] += chars
            else:
                columns.append([x0, x1, chars])
        total = sum(c[2] for c in columns) or 1
        strong: list[list[float]] = []
        for c in columns:
            if c[2] < least_share * total:
                if strong:
                    strong[-1][1] = max(strong[-1][1], c[1])
            else:
                strong.append(c)
        edges = [(a[1] + b[0]) / 2 for a, b in zip(strong, strong[1:], strict=False)]
        return [(rows[0][page], len(edges), edges)]

    return per_group(blocks, [page], run, f"{page} {kind}, gutters int, edges array<double>")


def suppress_media(boxes: DataFrame, page: str, most: float = 0.7) -> DataFrame:
    """boxes without media that overlap a better medium of another class; ties by id."""
    columns = boxes.columns

    def run(rows: list[dict]) -> list[tuple]:
        kept, out = [], []
        for r in sorted((r for r in rows if r["label"] in MEDIA), key=lambda r: (-r["score"], r["id"])):
            if all(iou(_box(r), k) <= most for k in kept):
                kept.append(_box(r))
                out.append(r)
        return [tuple(r[c] for c in columns) for r in out + [r for r in rows if r["label"] not in MEDIA]]

    return per_group(boxes, [page], run, boxes.schema)


def directory_metrics(content: Column) -> Column:
    """struct<score, entries, rest>: the share of characters in entries of a listing (a line with leader dots or a wide gap
    before its page number), their number, and the characters outside."""
    entry = r"(?m)^.*(?:\.{3,}|…|\s{3,}|\t)\s*\d{1,4}\s*$"

    def of(t: Column) -> Column:
        return T.let(F.regexp_extract_all(t, F.lit(entry), F.lit(0)), lambda found: F.struct(
            F.try_divide(F.aggregate(found, F.lit(0), lambda a, x: a + F.length(x)), F.length(t)).alias("score"), F.size(found).alias("entries"),
            (F.length(t) - F.aggregate(found, F.lit(0), lambda a, x: a + F.length(x))).alias("rest")))

    empty = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("entries"), F.length(F.coalesce(content, F.lit(""))).alias("rest"))
    return F.when(F.length(F.coalesce(content, F.lit(""))) < 40, empty).otherwise(T.let(content, of))


def is_directory(title: Column, content: Column) -> Column:
    """Is a section a table of contents or a list of figures: enough entries, and a title that says so or a listing from the
    start with little beside it. Sections with media, and bibliographies, are none."""
    media = content.rlike(r"\[p\d+_[a-z0-9]+\]")
    literature = F.coalesce(title, F.lit("")).rlike(r"(?i)literatur|references|bibliograph")
    named = F.coalesce(title, F.lit("")).rlike(r"(?i)inhalt|contents|verzeichnis|list of|index")
    head = directory_metrics(F.substring(content, 1, DIRECTORY_HEAD_CHARS))
    judge = lambda m: (m["entries"] >= DIRECTORY_ENTRIES) & ((named & (m["score"] >= DIRECTORY_TITLED)) | ((m["score"] >= DIRECTORY_SCORE) & (m["rest"] <= DIRECTORY_REST) & (head["score"] >= DIRECTORY_HEAD)))
    return F.coalesce(~media & ~literature & T.let(directory_metrics(content), judge), F.lit(False))


def drop_directories(sections_: DataFrame, title: str, content: str) -> DataFrame:
    return sections_.where(~is_directory(F.col(title), F.col(content)))


def even_cuts(sizes: Column, target: int) -> Column:
    """Starts of parts, from 0: a part closes at the first boundary where it has reached the target."""
    start = F.struct(F.lit(0).alias("run"), F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("i"))

    def step(a: Column, size: Column) -> Column:
        cut = (a["i"] > 0) & (a["run"] >= target)
        return F.struct((F.when(cut, 0).otherwise(a["run"]) + size).alias("run"), F.when(cut, F.concat(a["cuts"], F.array(a["i"]))).otherwise(a["cuts"]).alias("cuts"), (a["i"] + 1).alias("i"))

    return F.aggregate(sizes, start, step, lambda a: a["cuts"])


def sanitize_cuts(cuts: Column, sizes: Column, least: int = LEAST_PART) -> Column:
    """Cuts that name a real boundary, in order and once, none of them leaving a part of fewer than `least` words."""
    total = lambda a, b: F.aggregate(F.slice(sizes, a + 1, F.greatest(b - a, F.lit(0))), F.lit(0), lambda s, x: s + x)
    real = F.array_sort(F.array_distinct(F.filter(cuts, lambda c: (c > 0) & (c < F.size(sizes)))))
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<int>").alias("kept"))
    step = lambda a, c: F.when(total(a["last"], c) >= least, F.struct(c.alias("last"), F.concat(a["kept"], F.array(c)).alias("kept"))).otherwise(a)
    kept = F.aggregate(real, start, step, lambda a: a["kept"])
    short = lambda k: (F.size(k) > 0) & (total(F.element_at(k, -1), F.size(sizes)) < least)
    return T.let(kept, lambda k: F.when(short(k), F.slice(k, 1, F.size(k) - 1)).otherwise(k))


def group_units(sizes: Column, target: int, most: int, least: int = LEAST_PART) -> Column:
    """Starts of the parts that units are grouped into, 0 first; a short last part joins the one before if both fit."""
    total = lambda a: F.aggregate(F.slice(sizes, a + 1, F.size(sizes)), F.lit(0), lambda s, x: s + x)
    starts = F.concat(F.array(F.lit(0)), even_cuts(sizes, target))
    joins = lambda s: (F.size(s) > 1) & (total(F.element_at(s, -1)) < least) & (total(F.element_at(s, -2)) <= most)
    return T.let(starts, lambda s: F.when(joins(s), F.slice(s, 1, F.size(s) - 1)).otherwise(s))


def split_oversized(segments: DataFrame, section: str, order: str, text: str, most: int = 1000, target: int = 600) -> DataFrame:
    """segments with their part: sections of more than `most` words are cut at the segment boundaries next to the target."""
    w = segments.groupBy(section).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.size(T.words(F.col(text))).alias("n")))).alias("r"))
    sizes = F.transform("r", lambda x: x["n"])
    cuts = F.when(F.aggregate(sizes, F.lit(0), lambda a, x: a + x) > most, sanitize_cuts(even_cuts(sizes, target), sizes)).otherwise(F.array().cast("array<int>"))
    numbered = w.withColumn("cuts", cuts).select(section, "cuts", F.posexplode("r").alias("i", "x"))
    return numbered.select(section, F.col("x.o").alias(order), F.col("x.n").alias("words"), F.size(F.filter("cuts", lambda c: c <= F.col("i"))).alias("part"))


def outline(segments: DataFrame, section: str, order: str) -> DataFrame:
    """(section, outline): one numbered line per segment (kind, text, ref)."""
    line = T.outline_line(F.col(order), F.col("kind"), F.col("text"), F.col("ref"))
    g = segments.groupBy(section).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))).alias("r"))
    return g.select(section, F.array_join(F.transform("r", lambda x: x["l"]), "\n").alias("outline"))


def class_scores(matches: DataFrame, label: str) -> DataFrame:
    """(label, precision, recall) of matched boxes: kind match, confusion, missed or extra, with the label told and found."""
    k = F.col("kind")
    g = matches.groupBy(label).agg(F.count_if(k == "match").alias("hit"), F.count_if(k.isin("extra", "confusion")).alias("wrong"), F.count_if(k == "missed").alias("missed"))
    return g.select(label, F.round(F.try_divide(F.col("hit"), F.col("hit") + F.col("wrong")), 6).alias("precision"), F.round(F.try_divide(F.col("hit"), F.col("hit") + F.col("missed")), 6).alias("recall"))


_B = LINES + """
    , b AS (SELECT doc_id, pos AS id, (pos - 1) // 5 AS page, substr(line, 1, 50) AS content, 'text' AS type, CASE WHEN pos % 11 = 1 THEN 14.0::DOUBLE WHEN pos % 6 = 2 THEN 12.5 ELSE 10.0 END AS size, pos % 4 = 0 AS bold,
        CASE WHEN pos % 11 = 1 THEN 'doc_title' END AS label, CAST(pos * 20 AS DOUBLE) AS y0, CAST(pos * 20 + 15 AS DOUBLE) AS y1 FROM s),
    n AS (SELECT doc_id, size, sum(length(content)) AS n FROM b GROUP BY 1, 2), f AS (SELECT doc_id, arg_max(size, (n, -size)) AS body FROM n GROUP BY 1)
"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    pos, y = F.col("pos"), (F.col("pos") * 20).cast("double")
    size = F.when(pos % 11 == 1, 14.0).when(pos % 6 == 2, 12.5).otherwise(10.0)
    return s.select("doc_id", pos.alias("id"), F.floor((pos - 1) / 5).alias("page"), F.substring("line", 1, 50).alias("content"), F.lit("text").alias("type"), size.alias("size"), (pos % 4 == 0).alias("bold"),
                    F.when(pos % 11 == 1, "doc_title").alias("label"), y.alias("y0"), (y + 15).alias("y1"))


@query(_B + "SELECT * FROM f")
def body_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body's font size of each document."""
    return body_size(_blocks(spark, sf_dir), "doc_id")


@query(_B + r"""
    SELECT doc_id, id FROM b JOIN f USING (doc_id) WHERE label IS NULL AND length(content) BETWEEN 3 AND 120 AND NOT regexp_matches(trim(content), '[.!?]$') AND NOT regexp_matches(trim(content), '[.!?]\s+[A-ZÄÖÜ]')
      AND (size >= body * 1.2 OR (bold AND size > body) OR (regexp_matches(trim(content), '\p{Lu}') AND NOT regexp_matches(trim(content), '\p{Ll}') AND length(content) >= 6 AND size >= body))
""")
def promoted_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that become headings by their font."""
    return promote_headings(_blocks(spark, sf_dir), "doc_id", "page").where("label = 'paragraph_title'").select("doc_id", "id")


@query(_B + "SELECT doc_id, coalesce(min(page) FILTER (label = 'doc_title' AND trim(content) <> '' AND id > 1), min(page)) AS page FROM b GROUP BY 1")
def title_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that each document's title stands on; the first line is none here."""
    b = _blocks(spark, sf_dir).withColumn("label", F.when(F.col("id") > 1, F.col("label")))
    return title_page(b, "doc_id", "page")


@query("""
    WITH n AS (SELECT l_orderkey AS block, round(l_discount * 100, 1) AS size, sum(CAST(l_quantity AS BIGINT)) AS n, sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS b FROM lineitem GROUP BY 1, 2)
    SELECT block, arg_max(size, (n, -size)) AS size, sum(b) * 2 >= sum(n) AS bold FROM n GROUP BY 1
""")
def dominant_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and weight of blocks made of spans."""
    l = table(spark, sf_dir, "lineitem")
    spans = l.select(F.col("l_orderkey").alias("block"), (F.col("l_discount") * 100).alias("size"), F.col("l_quantity").cast("long").alias("chars"), (F.col("l_linestatus") == "F").alias("bold"))
    return dominant_font(spans, ["block"])


@query()
def page_gutters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of pages by a sweep over their blocks."""
    b = _page_boxes(spark, sf_dir)
    small = b.select("page", "id", "x0", (F.col("x0") + 40 + F.col("score")).alias("x1"), F.col("score").cast("long").alias("chars"))
    return find_gutters(small, "page", 600.0)


@query()
def suppressed_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media left where two classes claim one region."""
    label = F.when(F.col("label") == "A", "table").when(F.col("label") == "N", "image").otherwise("text")
    return suppress_media(_page_boxes(spark, sf_dir).withColumn("label", label), "page", 0.3).select("page", "id", "label")


@query(LINES + """
    , n AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Contents' ELSE 'Part' END AS title, string_agg(CASE WHEN doc_id % 2 = 0 OR pos % 3 = 0 THEN substr(line, 1, 30) || ' ..... ' || pos ELSE line END, chr(10) ORDER BY pos) AS content FROM s GROUP BY 1),
    e AS (SELECT doc_id, title, content, list_filter(string_split(content, chr(10)), lambda x: regexp_matches(x, '\\.{3,}\\s*\\d{1,4}\\s*$')) AS found,
          list_filter(string_split(content[1:600], chr(10)), lambda x: regexp_matches(x, '\\.{3,}\\s*\\d{1,4}\\s*$')) AS first FROM n),
    m AS (SELECT doc_id, title, length(content) AS len, len(found) AS entries, coalesce(list_sum(list_transform(found, lambda x: length(x))), 0) AS covered, length(content[1:600]) AS hlen, coalesce(list_sum(list_transform(first, lambda x: length(x))), 0) AS hcovered FROM e)
    SELECT doc_id FROM m WHERE NOT (len >= 40 AND entries >= 4 AND ((title = 'Contents' AND covered / len >= 0.35) OR (covered / len >= 0.55 AND len - covered <= 350 AND hlen >= 40 AND hcovered / hlen >= 0.5)))
""".replace("\\\\", "\\"))
def sections_without_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections that aren't listings; some are made into listings here."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    line = F.when((F.col("doc_id") % 2 == 0) | (F.col("pos") % 3 == 0), F.concat(F.substring("line", 1, 30), F.lit(" ..... "), F.col("pos").cast("string"))).otherwise(F.col("line"))
    g = s.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))), lambda x: x["l"]), "\n").alias("content"))
    return drop_directories(g.withColumn("title", F.when(F.col("doc_id") % 4 == 0, "Contents").otherwise("Part")), "title", "content").select("doc_id")


@query()
def split_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long documents cut at line boundaries."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return split_oversized(s, "doc_id", "pos", "line", 200, 120)


@query(LINES + r"""
    , k AS (SELECT doc_id, pos, CASE WHEN pos % 5 = 0 THEN 'table' ELSE 'text' END AS kind, line, list_filter(regexp_split_to_array(line, '[ \t\n\r\f\x0B]+'), lambda x: x <> '') AS w FROM s)
    SELECT doc_id, md5(string_agg(lpad(CAST(pos AS VARCHAR), 4, ' ') || ' ' || CASE WHEN kind = 'text' THEN '[' || len(w) || ' words] ' || array_to_string(w[1:14], ' ') || CASE WHEN len(w) > 14 THEN ' …' ELSE '' END ELSE '[TABLE] p' || pos END, chr(10) ORDER BY pos)) AS outline FROM k GROUP BY 1
""")
def section_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of documents by their lines."""
    s = sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    seg = s.select("doc_id", "pos", F.when(F.col("pos") % 5 == 0, "table").otherwise("text").alias("kind"), F.col("line").alias("text"), F.concat(F.lit("p"), F.col("pos").cast("string")).alias("ref"))
    return outline(seg, "doc_id", "pos").withColumn("outline", F.md5("outline"))


@query("""
    WITH m AS (SELECT l_returnflag AS label, CASE l_linenumber % 4 WHEN 0 THEN 'missed' WHEN 1 THEN 'match' WHEN 2 THEN 'extra' ELSE 'match' END AS kind FROM lineitem)
    SELECT label, round(count(*) FILTER (kind = 'match') / count(*) FILTER (kind IN ('match', 'extra')), 6) AS precision, round(count(*) FILTER (kind = 'match') / count(*) FILTER (kind IN ('match', 'missed')), 6) AS recall FROM m GROUP BY 1
""")
def detection_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall per class."""
    n = F.col("l_linenumber") % 4
    m = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), F.when(n == 0, "missed").when(n == 2, "extra").otherwise("match").alias("kind"))
    return class_scores(m, "label")
