"""Retrieval: word search by BM25, exact vector search, fusion of rankings, and selection from ranked lists.

documents are the passages, benchmark items the questions, embeddings the vectors (their labels the owners).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import ship_package, table
from foliant.staging import checked, staged

# Fixed values of the ranking functions.
K1, B, TITLE_WEIGHT, TEXT_WEIGHT = 1.2, 0.75, 2.0, 1.0
LEAST_IDF = 1e-6
RRF_K = 60
QUERY_WORDS = 24


def tokens(text: Column) -> Column:
    """Words of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def query_words(text: Column) -> Column:
    """The first 24 distinct words of a question that are longer than one character."""
    return F.slice(F.array_distinct(F.filter(tokens(text), lambda w: F.length(w) > 1)), 1, QUERY_WORDS)


def postings(passages: DataFrame, key: str, title: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(postings, lengths): (term, key, f) with f the weighted frequency, and (key, n). Passages without words are left out."""
    marked = passages.select(key, F.concat(F.transform(tokens(F.col(title)), lambda w: F.struct(w.alias("term"), F.lit(TITLE_WEIGHT).alias("w"))), F.transform(tokens(F.col(text)), lambda w: F.struct(w.alias("term"), F.lit(TEXT_WEIGHT).alias("w")))).alias("words")).where(F.size("words") > 0)
    lengths = marked.select(key, F.size("words").alias("n"))
    return marked.select(key, F.inline("words")).groupBy("term", key).agg(F.sum("w").alias("f")), lengths


def bm25(questions: DataFrame, question: str, words: str, index: tuple[DataFrame, DataFrame], key: str) -> DataFrame:
    """(question, key, score) of all passages that share a word; statistics over the whole index, filters come after.

    Question words are few beside the postings, so the postings are cut to them before anything is joined or summed: the
    counted list of asked words is broadcast, and the filter runs in the scan of the words. idf and the asking questions
    of a term are lists of that size too, so a posting never leaves its task before the sum per question and passage.
    """
    terms, lengths = index
    asked = staged(questions.select(question, F.explode(words).alias("term")))
    total = lengths.agg(F.count("*").cast("double").alias("total"), F.avg("n").alias("mean"))
    wanted = staged(terms.join(checked(asked.select("term").distinct()), "term", "left_semi"))
    idf = wanted.groupBy("term").agg(F.count("*").alias("df")).join(total)  # one row of totals
    raw = F.ln((F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = staged(idf.select("term", F.when(raw > 0, raw).otherwise(LEAST_IDF).alias("idf"), "mean"))
    scored = wanted.join(checked(idf), "term").join(lengths, key)
    part = F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("n") / F.col("mean")))
    return scored.select("term", key, part.alias("part")).join(checked(asked), "term").groupBy(question, key).agg(F.sum("part").alias("score"))


def top(rows: DataFrame, by: list[str], score: str, tie: str, n: int) -> DataFrame:
    """The n best rows per key, ties by the smallest id, with their rank."""
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return rows.withColumn("rank", F.row_number().over(w.orderBy(F.desc(score), tie))).where(F.col("rank") <= n)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """A vector at length 1; a zero vector stays."""
    size = F.sqrt(dot(v, v))
    return F.when(size > 0, F.transform(v, lambda x: x / size)).otherwise(v)


#: Probes that one broadcast holds; more of them are searched for block by block.
PROBES = 20_000


def _probe_blocks(probes: DataFrame):
    """(ids, matrix) of the probes, PROBES at a time in the order of their ids; one pass over the vectors serves a block."""
    n = probes.count()
    blocks = -(-n // PROBES)
    for k in range(blocks):
        part = probes if blocks == 1 else probes.where(F.pmod(F.xxhash64("probe"), F.lit(blocks)) == k)
        rows = sorted((r["probe"], r["wanted"]) for r in part.select("probe", "wanted").collect())
        yield np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)


def nearest(probes: DataFrame, vectors: DataFrame, k: int, owner: str | None = None, places: int = 5) -> DataFrame:
    """(probe, vec_id, score, rank, owner): per probe the k vectors of largest inner product, ties by the smallest id.

    With owner, only the best vector of each owner counts. Each task multiplies its vectors with the block of probes and
    keeps k rows per probe (and with owner, the best per owner first), so that what is shuffled grows with tasks times
    probes times k and never with pairs. Vectors and probes have vec_id, embedding and probe, wanted.
    """
    ship_package(vectors.sparkSession)
    label = owner or "vec_id"
    kind = dict(vectors.dtypes)[label]
    schema = f"probe long, vec_id long, score double, owner {kind}"
    out = None
    for ids, matrix in _probe_blocks(probes):
        shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            best: list[list[tuple]] = [[] for _ in ids]
            for batch in batches:
                if not batch.num_rows:
                    continue
                vec, names = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_pylist()
                body = np.array(batch.column(1).to_pylist(), np.float64)
                for at in range(0, len(ids), 256):
                    scores = np.round(body @ matrix[at : at + 256].T, places) + 0.0
                    for j in range(scores.shape[1]):
                        order = np.lexsort((vec, -scores[:, j]))
                        held = best[at + j] + [(-scores[i, j], int(vec[i]), names[i]) for i in (order if owner else order[:k])]
                        held.sort(key=lambda r: r[:2])
                        if owner:
                            seen: dict = {}
                            for r in held:
                                seen.setdefault(r[2], r)
                            held = list(seen.values())
                        best[at + j] = held[:k]
            rows = [(int(p), v, -s, o) for p, held in zip(ids, best, strict=True) for s, v, o in held]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64(), None), strict=True)], ["probe", "vec_id", "score", "owner"])

        part = vectors.select("vec_id", "embedding", F.col(label)).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], schema)
    if owner:
        out = out.withColumn("__b", F.row_number().over(Window.partitionBy("probe", "owner").orderBy(F.desc("score"), "vec_id"))).where("__b = 1").drop("__b")
    found = top(out, ["probe"], "score", "vec_id", k)
    return found.select("probe", "vec_id", "score", "rank", F.col("owner").alias(owner)) if owner else found.select("probe", "vec_id", "score", "rank")


def dense(probes: DataFrame, vectors: DataFrame, owner: str, k: int) -> DataFrame:
    """(probe, owner, score): per probe the k vectors of largest inner product, then the best per owner."""
    near = nearest(probes, vectors, k).join(vectors.select("vec_id", owner), "vec_id")
    return near.groupBy("probe", owner).agg(F.max("score").alias("score"))


def fuse(rankings: list[DataFrame], key: list[str], k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of rankings (key, rank): (key, score, first, at). Equal scores keep the order of the first
    ranking that has them, then their rank there."""
    out = None
    for i, r in enumerate(rankings):
        part = r.select(*key, F.lit(i).alias("ranking"), "rank")
        out = part if out is None else out.unionByName(part)
    best = F.min(F.struct("ranking", "rank"))
    got = out.groupBy(*key).agg(F.sum(F.lit(1.0) / (k + F.col("rank"))).alias("score"), best.alias("best"))
    return got.select(*key, F.round("score", 9).alias("score"), F.col("best.ranking").alias("first"), F.col("best.rank").alias("at"))


def fuse_probes(scores: DataFrame, probe: str, owner: str, how: str, cut: int) -> DataFrame:
    """One ranking over several probes: each probe's best `cut`, then max, mean or sum per owner, and the winning probe
    (the first of equals)."""
    per = top(scores, [probe], "score", owner, cut)
    agg = {"max": F.max, "mean": F.avg, "sum": F.sum}[how]
    return per.groupBy(owner).agg(F.round(agg("score"), 6).alias("score"), F.max_by(probe, F.struct(F.col("score"), -F.col(probe))).alias("winner"))


def budgeted(ranked: DataFrame, kind: str, rank: str, shares: dict[str, int], budget: int) -> DataFrame:
    """Shares of a budget by kind, scaled to it by whole-number division; what they leave goes to the best of the rest."""
    total = sum(shares.values())
    quota = F.create_map(*[F.lit(x) for k, v in shares.items() for x in (k, v * budget // total)])
    w = Window.partitionBy(kind).orderBy(rank)
    # Only the first `budget` of a kind can be taken, so the one global order is over a few rows a kind.
    first = ranked.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= budget)
    marked = first.withColumn("own", F.col("__k") <= F.coalesce(F.try_element_at(quota, F.col(kind)), F.lit(0)))
    return marked.orderBy(F.desc("own"), rank).limit(budget).drop("__k", "own")


def best_of_each(ranked: DataFrame, kind: str, rank: str, n: int) -> DataFrame:
    """The first n of each kind of a ranked list."""
    return ranked.withColumn("__n", F.row_number().over(Window.partitionBy(kind).orderBy(rank))).where(F.col("__n") <= n).drop("__n")


def _index(spark: SparkSession, sf_dir: str):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), "text")
    return postings(d, "doc_id", "title", "text")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", query_words(F.col("text")).alias("words"))


_WORDS = r"""
    w AS (SELECT doc_id, unnest(regexp_extract_all(lower(source), '[\p{L}\p{N}]+')) AS term, 2.0::DOUBLE AS f FROM documents
          UNION ALL SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')), 1.0 FROM documents),
    p AS (SELECT term, doc_id, sum(f) AS f FROM w GROUP BY 1, 2),
    l AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1),
    q0 AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark),
    q1 AS (SELECT item_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS i FROM q0),
    q2 AS (SELECT item_id, term, min(i) AS i FROM q1 WHERE length(term) > 1 GROUP BY 1, 2),
    q AS (SELECT item_id, term FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY i) AS r FROM q2) WHERE r <= 24)
"""
_BM25 = "WITH " + _WORDS + """,
    df AS (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY 1),
    t AS (SELECT count(*)::DOUBLE AS total, avg(n) AS mean FROM l),
    idf AS (SELECT term, CASE WHEN ln((total - df + 0.5) / (df + 0.5)) > 0 THEN ln((total - df + 0.5) / (df + 0.5)) ELSE 1e-6 END AS idf, mean FROM df, t),
    s AS (SELECT item_id, doc_id, round(sum(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
          FROM q JOIN p USING (term) JOIN idf USING (term) JOIN l USING (doc_id) GROUP BY 1, 2),
    b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
"""


def _bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = bm25(_questions(spark, sf_dir), "item_id", "words", _index(spark, sf_dir), "doc_id")
    return top(scores.withColumn("score", F.round("score", 6)), ["item_id"], "score", "doc_id", 10)


@query("WITH " + _WORDS + "SELECT item_id, list_sort(list(term)) AS words FROM q GROUP BY 1")
def lexical_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a question is searched by."""
    return _questions(spark, sf_dir).where(F.size("words") > 0).select("item_id", F.sort_array("words").alias("words"))


@query("WITH " + _WORDS + "SELECT term, count(*) AS documents, round(sum(f), 1) AS weight FROM p GROUP BY 1")
def postings_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverted index by term."""
    return _index(spark, sf_dir)[0].groupBy("term").agg(F.count("*").alias("documents"), F.round(F.sum("f"), 1).alias("weight"))


@query(_BM25 + "SELECT item_id, doc_id, rank, score FROM b WHERE rank <= 10")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best passages of each question by BM25."""
    return _bm25(spark, sf_dir).select("item_id", "doc_id", "rank", "score")


_DENSE = """
    WITH v AS (SELECT vec_id, label, embedding FROM embeddings), pr AS (SELECT vec_id AS probe, embedding AS wanted FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT probe, vec_id, label, round(list_sum(list_transform(list_zip(embedding, wanted), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 5) AS score FROM v, pr),
    r AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, vec_id) AS rank FROM s)
"""


def _probes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("probe"), F.col("embedding").alias("wanted")), v


@query(_DENSE + "SELECT probe, label, max(score) AS score FROM r WHERE rank <= 20 GROUP BY 1, 2")
def dense_owner_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact vector search: the twenty nearest vectors of each probe, best per owner."""
    return dense(*_probes(spark, sf_dir), "label", 20)


@query(_DENSE + """
    , o AS (SELECT probe, label, max(score) AS score FROM r WHERE rank <= 20 GROUP BY 1, 2),
    c AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, label) AS k FROM o)
    SELECT label, round(max(score), 6) AS score, max_by(probe, (score, -probe)) AS winner FROM c WHERE k <= 5 GROUP BY 1
""")
def multi_probe_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ranking of owners over all probes."""
    return fuse_probes(dense(*_probes(spark, sf_dir), "label", 20), "probe", "label", "max", 5)


_HYBRID = _BM25 + """
    , c AS (SELECT count(*) AS n FROM documents), v AS (SELECT vec_id, vec_id * 13 % n AS doc_id, embedding FROM embeddings, c),
    x AS (SELECT item_id, embedding AS wanted FROM benchmark JOIN embeddings ON vec_id = item_id),
    y AS (SELECT item_id, doc_id, vec_id, round(list_sum(list_transform(list_zip(embedding, wanted), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)), 5) AS score FROM x, v WHERE doc_id % 10 <> 9),
    z AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY score DESC, vec_id) AS r FROM y),
    e AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, vec_id) AS rank FROM z WHERE r = 1),
    bc AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE doc_id % 10 <> 9),
    u AS (SELECT item_id, doc_id, 0 AS ranking, rank FROM e WHERE rank <= 10 UNION ALL SELECT item_id, doc_id, 1, rank FROM bc WHERE rank <= 10),
    f AS (SELECT item_id, doc_id, round(sum(1.0 / (60 + rank)), 9) AS score, min((ranking, rank)) AS best,
          max(CASE WHEN ranking = 0 THEN rank END) AS dense_rank, max(CASE WHEN ranking = 1 THEN rank END) AS lexical_rank FROM u GROUP BY 1, 2)
"""


@query(_HYBRID + "SELECT item_id, doc_id, score, dense_rank, lexical_rank, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, best) AS place FROM f")
def hybrid_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector search and word search over current documents, fused by reciprocal ranks.

    A question's vector is that of its number; vectors belong to documents by their id, and a tenth of the documents
    isn't current. Statistics of words are over all documents; what isn't current is left out before the cut.
    """
    current = F.col("doc_id") % 10 != 9
    n = table(spark, sf_dir, "documents").count()
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") * 13 % n).alias("doc_id"), "embedding")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("vec_id")).join(e, "vec_id").select(F.col("vec_id").alias("probe"), F.col("embedding").alias("wanted"))
    first = nearest(asked, e.where(current), 10, owner="doc_id").select(F.col("probe").alias("item_id"), "doc_id", "rank")
    scores = bm25(_questions(spark, sf_dir), "item_id", "words", _index(spark, sf_dir), "doc_id").where(current)
    words = top(scores.withColumn("score", F.round("score", 6)), ["item_id"], "score", "doc_id", 10).select("item_id", "doc_id", "rank")
    first, words = staged(first), staged(words)  # each is read twice
    ranks = first.withColumnRenamed("rank", "dense_rank").join(words.withColumnRenamed("rank", "lexical_rank"), ["item_id", "doc_id"], "full")
    fused = fuse([first, words], ["item_id", "doc_id"]).join(ranks, ["item_id", "doc_id"])
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "first", "at"))
    return fused.select("item_id", "doc_id", "score", "dense_rank", "lexical_rank", place.alias("place"))


@query("""
    SELECT CASE vec_id % 6 WHEN 0 THEN 'section_text' WHEN 1 THEN 'section_title' WHEN 2 THEN 'table_caption' WHEN 3 THEN 'table_text' WHEN 4 THEN 'figure_caption' ELSE 'figure_text' END AS embedding_type,
           count(*) AS n, count(DISTINCT label) AS owners FROM embeddings GROUP BY 1
""")
def embedding_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors and owners per embedding type."""
    names = F.array(*map(F.lit, ("section_text", "section_title", "table_caption", "table_text", "figure_caption", "figure_text")))
    e = table(spark, sf_dir, "embeddings")
    return e.groupBy(F.element_at(names, (F.col("vec_id") % 6 + 1).cast("int")).alias("embedding_type")).agg(F.count("*").alias("n"), F.count_distinct("label").alias("owners"))


@query("""
    WITH r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY rank) <= CASE lang WHEN 'en' THEN 3 * 20 // 6 WHEN 'de' THEN 2 * 20 // 6 WHEN 'fr' THEN 1 * 20 // 6 ELSE 0 END AS own FROM r)
    SELECT doc_id, lang, rank FROM (SELECT *, row_number() OVER (ORDER BY own DESC, rank) AS n FROM o) WHERE n <= 20
""")
def pool_budgeted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of twenty dealt to languages by shares, from a ranking by length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").withColumn("best", F.struct((-F.col("n_chars")).alias("n"), "doc_id"))
    taken = budgeted(d, "lang", "best", {"en": 3, "de": 2, "fr": 1}, 20)
    # The rank in the whole list is one more than the rows ahead: a count against twenty rows, not an order of all.
    ahead = d.select(F.col("best").alias("other")).join(F.broadcast(taken.select("best")), F.col("other") <= F.col("best")).groupBy("best").agg(F.count("*").alias("rank"))
    return taken.join(ahead, "best").select("doc_id", "lang", "rank")


@query("""SELECT doc_id, lang, rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 5""")
def shown_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of each kind."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return top(d, ["lang"], "n_chars", "doc_id", 5).select("doc_id", "lang", "rank")


@query("""
    SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS norm, len(embedding) AS dims FROM embeddings
""")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and dimension of every vector."""
    e = table(spark, sf_dir, "embeddings")
    v = F.col("embedding")
    return e.select("vec_id", F.round(F.sqrt(dot(v, v)), 4).alias("norm"), F.size(v).alias("dims"))
