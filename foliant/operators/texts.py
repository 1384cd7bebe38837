"""Sections, lines, tables and numbers of documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked


def sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line): the lines of a text in order, from 1."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("p", "line")).select(key, (F.col("p") + 1).cast("long").alias("pos"), "line")


LINES = "WITH s AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


#: Words of a quote that find the texts to look into.
PROBE = 3


def carriers(quotes: DataFrame, quote: str, texts: DataFrame, key: str) -> DataFrame:
    """(quote, key): which texts (key, body) carry which quotes (quote id, quote), both flat.

    A quote's inner words (its first and last may be cut) give one probe, the hash of PROBE words in a row. The runs of words of every
    text are cut to the probes where they are read, by the counted list of probes, and meet their quotes by an equi-join;
    only those pairs are compared. Quotes of fewer words are tried against every text; their list is counted too.
    """
    w = F.split("quote", " ")
    inner = quotes.withColumn("__w", F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0))))
    probed = inner.where(F.size("__w") >= PROBE).select(quote, "quote", F.xxhash64(F.array_join(F.slice("__w", 1, PROBE), " ")).alias("probe"))
    short = inner.where(F.size("__w") < PROBE).select(quote, "quote")
    runs = texts.select(key, "body", F.explode(F.array_distinct(T.shingles(F.col("body"), PROBE))).alias("probe"))
    met = runs.join(checked(probed), "probe").where(F.contains("body", "quote")).select(quote, key)
    if short.isEmpty():
        return met
    return met.unionByName(texts.join(checked(short), F.contains("body", "quote")).select(quote, key))


def strip_running_headers(lines: DataFrame, doc: str, page: str, line: str, least_pages: int = 4, share: float = 0.3) -> DataFrame:
    """Lines that aren't running headers: a header's key is on at least max(3, int(share * pages)) pages of a document of
    least_pages or more; the first page keeps its own."""
    keyed = lines.withColumn("__key", T.normalize_header(F.col(line)))
    pages = lines.groupBy(doc).agg(F.count_distinct(page).alias("__pages"))
    seen = keyed.where("__key <> ''").groupBy(doc, "__key").agg(F.count_distinct(page).alias("__n")).join(pages, doc)
    heads = seen.where((F.col("__pages") >= least_pages) & (F.col("__n") >= F.greatest(F.lit(3), F.floor(F.col("__pages") * share)))).select(doc, "__key")
    first = lines.groupBy(doc).agg(F.min(page).alias("__first"))
    marked = keyed.join(heads.withColumn("__head", F.lit(True)), [doc, "__key"], "left").join(first, doc)
    return marked.where(F.col("__head").isNull() | (F.col(page) == F.col("__first"))).select(*lines.columns)


@query(LINES + "SELECT doc_id, pos, line, length(line) AS n FROM s")
def section_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its place."""
    return _lines(spark, sf_dir).select("doc_id", "pos", "line", F.length("line").alias("n"))


@query(r"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words, greatest(1, length(text) // 4) AS tokens FROM documents""")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and the token estimate of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.words(F.col("text"))).alias("words"), T.count_tokens(F.col("text")).alias("tokens"))


@query(r"""
    WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM documents)
    SELECT doc_id, md5(CASE WHEN len(ws) > 100 THEN array_to_string(ws[1:100], ' ') ELSE text END) AS capped FROM w
""")
def capped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred words of every document, as a digest."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.capped(F.col("text"), 100)).alias("capped"))


@query(LINES + """
    SELECT doc_id, pos, (pos - 1) // 3 AS piece, lag(line) OVER w IS NOT NULL AS has_previous, length(lead(line) OVER w) AS next_length FROM s
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
""")
def fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in runs of three, each with its neighbours."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    piece = F.floor((F.col("pos") - 1) / 3)
    return _lines(spark, sf_dir).select("doc_id", "pos", piece.alias("piece"), F.lag("line").over(w).isNotNull().alias("has_previous"), F.length(F.lead("line").over(w)).alias("next_length"))


@query(LINES + """
    , t AS (SELECT doc_id, pos FROM s WHERE line <> '' AND pos % 3 <> 0)
    SELECT doc_id, pos, lead(pos, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM t
""")
def following_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second next section, tables skipped."""
    s = _lines(spark, sf_dir).where("line <> '' AND pos % 3 <> 0")
    return s.select("doc_id", "pos", F.lead("pos", 2).over(Window.partitionBy("doc_id").orderBy("pos")).alias("following"))


@query(LINES + """
    , f AS (SELECT doc_id, pos, CASE WHEN length(line) < 80 THEN 1 ELSE 0 END AS short FROM s),
    r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, short ORDER BY pos) AS run FROM f)
    SELECT doc_id, min(pos) AS first, count(*) AS lines FROM r WHERE short = 1 GROUP BY doc_id, run
""")
def continuation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive short lines, as gaps and islands."""
    s = _lines(spark, sf_dir).where(F.length("line") < 80).select("doc_id", "pos")
    run = F.col("pos") - F.row_number().over(Window.partitionBy("doc_id").orderBy("pos"))
    return s.withColumn("run", run).groupBy("doc_id", "run").agg(F.min("pos").alias("first"), F.count("*").alias("lines")).drop("run")


@query(LINES + """
    SELECT doc_id, count(*) AS rows, round(1 - count(DISTINCT line) / count(*), 6) AS duplication, count(*) > 0 AND 1 - count(DISTINCT line) / count(*) <= 0.4 AS passed
    FROM s GROUP BY 1
""")
def qa_duplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality gate for transcribed tables: repeated rows."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("r"))
    dup = T.duplication(F.col("r"))
    return d.select("doc_id", F.size("r").cast("long").alias("rows"), F.round(dup, 6).alias("duplication"), (dup <= 0.4).alias("passed"))


@query(LINES + r"""
    , k AS (SELECT doc_id, pos, line, (pos - 1) // 2 AS page, trim(regexp_replace(regexp_replace(lower(line), '\b\d{1,4}\b', ' ', 'g'), '[\s[:punct:]]+', ' ', 'g')) AS key FROM s),
    n AS (SELECT doc_id, count(DISTINCT page) AS pages, min(page) AS first FROM k GROUP BY 1),
    h AS (SELECT doc_id, key FROM k JOIN n USING (doc_id) WHERE key <> '' AND pages >= 4 GROUP BY doc_id, key, pages HAVING count(DISTINCT page) >= greatest(3, floor(pages * 0.3)))
    SELECT doc_id, pos FROM k JOIN n USING (doc_id) WHERE page = first OR NOT EXISTS (SELECT 1 FROM h WHERE h.doc_id = k.doc_id AND h.key = k.key)
""")
def header_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without running headers, two lines to a page."""
    s = _lines(spark, sf_dir).withColumn("page", F.floor((F.col("pos") - 1) / 2))
    return strip_running_headers(s, "doc_id", "page", "line").select("doc_id", "pos")


@query(r"""
    WITH b AS (SELECT doc_id, trim(regexp_replace(text, '^(\s*(\d+\.?)+\s+)+', '')) AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_matches(t, '\p{Lu}') AND NOT regexp_matches(t, '\p{Ll}') AS shout, string_split(t, ' ') AS ws FROM b)
    SELECT doc_id, md5(CASE WHEN shout THEN array_to_string(list_transform(ws, lambda x: CASE WHEN length(x) <= 4 THEN x ELSE x[1:1] || lower(x[2:]) END), ' ') ELSE t END) AS title, shout FROM w
""")
def title_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as titles: without numbering, those in capitals lowered."""
    title = T.normalize_title(F.col("text"))
    bare = F.trim(F.regexp_replace("text", r"^(\s*(\d+\.?)+\s+)+", ""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(title).alias("title"), (bare.rlike(r"\p{Lu}") & ~bare.rlike(r"\p{Ll}")).alias("shout"))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice * 100 AS BIGINT) AS DOUBLE) / 100 AS value FROM lineitem
""")
def canonical_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers printed in three ways and read back."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (cents / 100).cast("decimal(20,2)").alias("v"))
    english = F.format_number("v", 2)
    german = F.translate(english, ",.", ".,")
    plain = F.col("v").cast("string")
    printed = F.when(F.col("l_linenumber") % 3 == 0, english).when(F.col("l_linenumber") % 3 == 1, german).otherwise(plain)
    return l.select("l_orderkey", "l_linenumber", T.canonical_number(printed).cast("double").alias("value"))


@query(r"""
    WITH f AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(' ' || text, '[^\p{L}\d.,-](\d{1,3})[^\d.,\p{L}]', 1))) AS n FROM documents)
    SELECT doc_id, count(*) AS numbers FROM (SELECT doc_id, CAST(n AS INT) AS n FROM f GROUP BY 1, 2) GROUP BY 1
""")
def numbers_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many distinct short whole numbers each text prints."""
    found = F.regexp_extract_all(F.concat(F.lit(" "), "text"), F.lit(r"[^\p{L}\d.,-](\d{1,3})[^\d.,\p{L}]"), F.lit(1))
    d = table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.transform(found, lambda x: x.cast("int"))).alias("n"))
    return d.where(F.size("n") > 0).select("doc_id", F.size("n").alias("numbers"))


@query(r"""
    WITH b AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS quote FROM benchmark),
    d AS (SELECT doc_id, trim(regexp_replace(replace(translate(text, '„“”‟«»‚‘’‑–—−', repeat(chr(34), 6) || repeat(chr(39), 3) || '----'), '**', ''), '\s+', ' ', 'g')) AS body FROM documents)
    SELECT item_id, doc_id FROM b, d WHERE length(quote) >= 8 AND contains(body, quote)
""")
def quotes_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents carry which benchmark passage whole."""
    quotes = table(spark, sf_dir, "benchmark").select("item_id", T.flat(F.col("text")).alias("quote")).where(F.length("quote") >= T.QUOTE_MIN_CHARS)
    d = table(spark, sf_dir, "documents").select("doc_id", T.flat(F.col("text")).alias("body"))
    return carriers(quotes, "item_id", d, "doc_id")


@query(r"""
    WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}]{3,}')) AS ws FROM documents),
    p AS (SELECT a.doc_id AS doc_id, a.ws AS x, b.ws AS y FROM w a JOIN w b ON b.doc_id = a.doc_id + 1)
    SELECT doc_id, round(len(list_intersect(x, y)) / nullif(len(x), 0), 6) AS containment FROM p
""")
def text_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a document's words that the next one has."""
    w = table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), F.lit(0))).alias("x"))
    n = w.select((F.col("doc_id") - 1).alias("doc_id"), F.col("x").alias("y"))
    return w.join(n, "doc_id").select("doc_id", F.round(T.containment(F.col("x"), F.col("y")), 6).alias("containment"))


# Stop words that tell two languages apart.
STOP_WORDS = {"de": ["der", "die", "das", "und", "nicht", "mit", "von", "ist", "auf", "ein"], "en": ["the", "of", "and", "to", "with", "was", "that", "is", "for", "by"]}


@query("""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '') AS ws FROM documents),
    c AS (SELECT doc_id, len(list_filter(ws, lambda x: x IN ('der','die','das','und','nicht','mit','von','ist','auf','ein'))) AS de,
                 len(list_filter(ws, lambda x: x IN ('the','of','and','to','with','was','that','is','for','by'))) AS en FROM w)
    SELECT doc_id, CASE WHEN greatest(de, en) = 0 THEN 'other' WHEN de >= en THEN 'de' ELSE 'en' END AS language FROM c
""")
def stop_word_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's language by its stop words."""
    return table(spark, sf_dir, "documents").select("doc_id", T.language_of(F.col("text"), STOP_WORDS).alias("language"))


@query("""SELECT doc_id, lang || ', ' || source || ' (' || n_chars || ')' AS label FROM documents""")
def citation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable labels of sources."""
    return table(spark, sf_dir, "documents").select("doc_id", F.format_string("%s, %s (%d)", "lang", "source", "n_chars").alias("label"))


@query("""
    SELECT page_id, length(html) AS chars, len(regexp_extract_all(html, '[A-Za-z]')) AS alpha,
           CASE WHEN length(html) = 0 THEN 'NO_TEXT' WHEN len(regexp_extract_all(html, '[A-Za-z]')) < 0.3 * length(html) THEN 'BROKEN_ENCODING' ELSE 'OK' END AS verdict FROM pages
""")
def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest gate: is a page's text readable."""
    letters = F.length(F.regexp_replace("html", "[^A-Za-z]", ""))
    verdict = F.when(F.length("html") == 0, "NO_TEXT").when(letters < 0.3 * F.length("html"), "BROKEN_ENCODING").otherwise("OK")
    return table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("chars"), letters.alias("alpha"), verdict.alias("verdict"))


@query(LINES + """
    , c AS (SELECT doc_id, line, min(pos) AS pos FROM s WHERE line <> '' GROUP BY 1, 2)
    SELECT doc_id, pos, dense_rank() OVER (PARTITION BY doc_id ORDER BY pos) AS citation FROM c
""")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct quotes numbered by first appearance."""
    c = _lines(spark, sf_dir).where("line <> ''").groupBy("doc_id", "line").agg(F.min("pos").alias("pos"))
    return c.select("doc_id", "pos", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("pos")).alias("citation"))
