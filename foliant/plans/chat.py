"""The steps of a chat turn as DataFrame steps: search, fuse, rerank, pack, ask, check statements, answer.

A turn is a dict of named tables; a drawing is a list of steps {"step": name, ...settings}. Model calls are joins with
recorded answers, so a turn is a plan like any other. Names are checked first, and so is what each step needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators import folds, lookup, retrieval
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table

Turn = dict[str, DataFrame]
STEPS: dict[str, tuple[Callable[[Turn, dict], DataFrame], tuple[str, ...]]] = {}
#: What a statement may rest on.
BASES = ("text", "computed", "image")


def step(*needs: str) -> Callable:
    """Register a step by its name, with the tables of the turn that it reads."""

    def keep(f: Callable[[Turn, dict], DataFrame]) -> Callable[[Turn, dict], DataFrame]:
        STEPS[f.__name__.rstrip("_")] = (f, needs)
        return f

    return keep


def check_statements(statements: DataFrame, excerpts: DataFrame, crops: DataFrame, runs: DataFrame) -> DataFrame:
    """statements (batch, n, text, basis, index, block, quote, run) with why and owner: why is null for a shown one, else the
    first check that failed: blank, image, no_source, quote or run. Shown and dropped make all.

    excerpts (batch, index, source, owner, attached), crops (batch, block, owner) delivered, runs (batch, run, ok).
    """
    s = statements.join(excerpts.select("batch", "index", "source", F.col("owner").alias("__e"), "attached"), ["batch", "index"], "left")
    s = s.join(crops.select("batch", "block", F.col("owner").alias("__c")), ["batch", "block"], "left").join(runs.select("batch", "run", "ok"), ["batch", "run"], "left")
    image, crop = F.col("basis") == "image", F.col("block").isNotNull()
    read = F.coalesce(F.trim("quote"), F.lit("")) != ""
    grounded = F.coalesce(T.quote_in(F.col("quote"), F.col("source")), F.lit(False))
    why = (
        F.when((F.coalesce(F.trim("text"), F.lit("")) == "") | ~F.coalesce(F.col("basis").isin(*BASES), F.lit(False)), "blank")
        .when(image & crop, F.when(F.col("__c").isNull() | ~read, "image"))
        .when(F.col("__e").isNull(), "no_source")
        .when(image, F.when(~F.coalesce("attached", F.lit(False)) | ~read, "image"))
        .when(~grounded, "quote").when((F.col("basis") == "computed") & ~F.coalesce("ok", F.lit(False)), "run")
    )
    owner = F.when(image & crop, F.col("__c")).otherwise(F.col("__e"))
    return s.withColumn("why", why).withColumn("owner", F.when(F.col("why").isNull(), owner)).drop("__e", "__c", "source", "attached", "ok")


def assemble(shown: DataFrame, key: str, marker: str, note: str) -> DataFrame:
    """(key, answer, answer_text) of shown statements (key, n, text, citation, visual): one is a sentence, several are a list,
    each with its citation; the note is added once if a statement read off a picture doesn't say so."""
    mark = F.when(F.col("citation").isNotNull(), F.concat(F.lit(" ["), F.col("citation").cast("string"), F.lit("]"))).otherwise("")
    g = shown.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "text", mark.alias("mark")))).alias("s"), F.bool_or(F.col("visual") & ~F.contains(F.lower("text"), F.lit(marker.lower()))).alias("silent"))
    one = F.concat(F.get("s", 0)["text"], F.get("s", 0)["mark"])
    many = F.array_join(F.transform("s", lambda x: F.concat(F.lit("- "), x["text"], x["mark"])), "\n")
    tail = F.when(F.col("silent"), "\n\n" + note).otherwise("")
    plain = F.array_join(F.transform("s", lambda x: x["text"]), "\n")
    return g.select(key, F.concat(F.when(F.size("s") == 1, one).otherwise(many), tail).alias("answer"), F.concat(plain, tail).alias("answer_text"))


@step("questions", "passages")
def search(turn: Turn, s: dict) -> DataFrame:
    """Ranked passages (question, key, score, rank) by words."""
    index = retrieval.postings(turn["passages"], "key", "title", "text")
    scores = retrieval.bm25(turn["questions"].select("question", retrieval.query_words(F.col("text")).alias("words")), "question", "words", index, "key")
    return retrieval.top(scores.withColumn("score", F.round("score", 6)), ["question"], "score", "key", s.get("top", 10))


@step()
def fuse(turn: Turn, s: dict) -> DataFrame:
    """Rankings of the turn as one, by reciprocal ranks."""
    fused = retrieval.fuse([turn[name].select("question", "key", "rank") for name in s["rankings"]], ["question", "key"])
    place = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("score"), "first", "at"))
    return fused.select("question", "key", "score", place.alias("rank"))


@step("hits")
def rerank(turn: Turn, s: dict) -> DataFrame:
    """The first `pool` hits of a question by a second score (table `scores`: key, second, by question or not), the rest as they
    were."""
    scores = turn[s["scores"]]
    pooled = turn["hits"].join(scores, [c for c in ("question", "key") if c in scores.columns], "left").withColumn("in_pool", F.col("rank") <= s["pool"])
    ordered = lookup.reordered(pooled.withColumn("second", F.coalesce("second", F.lit(0.0))), "question", "rank", "second")
    return ordered.select("question", "key", "score", F.col("place").alias("rank"))


@step("hits", "passages")
def pack(turn: Turn, s: dict) -> DataFrame:
    """Hits in order as packs under a budget of tokens."""
    sized = turn["hits"].join(turn["passages"].select("key", T.count_tokens(F.col("text")).alias("size")), "key")
    packs = folds.pack_rows(sized.select("question", "rank", "size"), "question", "rank", "size", s["budget"])
    return packs.join(turn["hits"], ["question", "rank"])


@step("packs", "recorded")
def ask(turn: Turn, s: dict) -> DataFrame:
    """The recorded answers (question, pack, n, text, basis, ...) to the packs that were asked; others are empty."""
    return turn["packs"].select("question", "pack").distinct().join(turn["recorded"], ["question", "pack"], "left")


@step("hits")
def cut(turn: Turn, s: dict) -> DataFrame:
    return turn["hits"].where(F.col("rank") <= s["n"])


@step("values")
def values_passages(turn: Turn, s: dict) -> DataFrame:
    """The passages of chosen values, each once."""
    return turn["values"].select("question", "key").distinct()


@step("rows", "trust")
def graph_values(turn: Turn, s: dict) -> DataFrame:
    """Rows of a graph answer with the evidence of their node; a row without a line of trust is not shown."""
    return turn["rows"].join(turn["trust"], "node")


@step("answers")
def merge(turn: Turn, s: dict) -> DataFrame:
    return lookup.merge_answers(turn["answers"], "question", "pack", "text", "citations")


@step("rows")
def format_table(turn: Turn, s: dict) -> DataFrame:
    return lookup.markdown_table(turn["rows"], "question", s["order"], s["columns"])


def chat_problems(drawing: list[dict], tables: set[str]) -> list[str]:
    """Steps that nobody knows, and tables that aren't there yet where a step reads them."""
    out, there = [], set(tables)
    for i, s in enumerate(drawing):
        known = STEPS.get(s.get("step"))
        if known is None:
            out.append(f"[{i}]: unknown step {s.get('step')}")
            continue
        out += [f"[{i}]: {s['step']} reads {n}, which is not there yet" for n in (*known[1], *s.get("rankings", ()), *([s["scores"]] if "scores" in s else [])) if n not in there]
        there.add(s.get("into", s["step"]))
    return out


def run_chat(turn: Turn, drawing: list[dict]) -> Turn:
    """The turn with the table of every step under its `into`, or the step's name."""
    wrong = chat_problems(drawing, set(turn))
    if wrong:
        raise ValueError("; ".join(wrong))
    out = dict(turn)
    for s in drawing:
        out[s.get("into", s["step"])] = STEPS[s["step"]][0](out, s)
    return out


_BM = retrieval._BM25


@query(_BM + """, r AS (SELECT item_id AS question, doc_id AS key, score, rank FROM b WHERE rank <= 10),
    o AS (SELECT question, key, row_number() OVER (PARTITION BY question ORDER BY rank <= 5 DESC, CASE WHEN rank <= 5 THEN -CAST(key % 17 AS DOUBLE) END NULLS FIRST, rank) AS rank FROM r),
    z AS (SELECT question, o.key, rank, greatest(1, length(text) // 4) AS size FROM o JOIN documents ON doc_id = o.key WHERE rank <= 6),
    packed AS (WITH RECURSIVE fold AS (SELECT question, key, rank, size AS total, 0 AS pack FROM z WHERE rank = 1 UNION ALL
          SELECT z.question, z.key, z.rank, CASE WHEN fold.total + z.size > 600 THEN z.size ELSE fold.total + z.size END, CASE WHEN fold.total + z.size > 600 THEN fold.pack + 1 ELSE fold.pack END FROM fold JOIN z ON z.question = fold.question AND z.rank = fold.rank + 1) SELECT * FROM fold)
    SELECT question, key, rank, pack FROM packed""")
def chat_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn of search, reranking, a cut and packing for every question."""
    d = table(spark, sf_dir, "documents")
    turn = {"questions": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question"), "text"), "passages": d.select(F.col("doc_id").alias("key"), F.col("source").alias("title"), "text"),
            "second": d.select(F.col("doc_id").alias("key"), (F.col("doc_id") % 17).cast("double").alias("second"))}
    drawing = [{"step": "search", "into": "hits"}, {"step": "rerank", "scores": "second", "pool": 5, "into": "hits"}, {"step": "cut", "n": 6, "into": "hits"}, {"step": "pack", "budget": 600, "into": "packs"}]
    return run_chat(turn, drawing)["packs"].select("question", "key", "rank", "pack")


_STATEMENTS = HARVEST + """
    , s AS (SELECT document AS batch, pos AS n, pos % 8 AS k, CAST(value AS BIGINT) AS v FROM h),
    w AS (SELECT batch, n, k, v, CASE WHEN k = 0 THEN 'blank' WHEN k = 1 AND v % 2 = 0 THEN 'image' WHEN k = 2 THEN 'no_source' WHEN k = 3 AND v % 2 = 0 THEN 'image' WHEN k = 4 THEN 'quote' WHEN k = 5 AND v % 2 = 0 THEN 'run' END AS why FROM s)
"""


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("k"), F.col("v")
    s = harvest(spark, sf_dir).select(F.col("document").alias("batch"), F.col("pos").alias("n"), (F.col("pos") % 8).cast("int").alias("k"), F.col("value").cast("long").alias("v"))
    basis = F.when(k == 0, "guess").when(k.isin(1, 3), "image").when(k == 5, "computed").otherwise("text")
    quote = F.when(k == 4, "a quote that stands nowhere").otherwise("the passage says so")
    made = s.select("batch", "n", F.concat(F.lit("statement "), v.cast("string")).alias("text"), basis.alias("basis"), F.when(k == 2, 99).when(k == 3, (v % 2).cast("int")).otherwise(0).alias("index"),
                    F.when(k == 1, F.concat(F.lit("crop"), (v % 2).cast("string"))).alias("block"), quote.alias("quote"), F.when(k == 5, (v % 2).cast("int")).alias("run"))
    batches = s.select("batch").distinct()
    # Excerpt 1 came with its crop and excerpt 0 didn't; crop1 was delivered; run 1 succeeded.
    excerpts = batches.select("batch", F.explode(F.array(F.lit(0), F.lit(1))).alias("index"), F.lit("It is here that the passage says so.").alias("source"), F.col("batch").alias("owner")).withColumn("attached", F.col("index") == 1)
    crops = batches.select("batch", F.lit("crop1").alias("block"), (F.col("batch") + 1).alias("owner"))
    runs = batches.select("batch", F.explode(F.array(F.lit(0), F.lit(1))).alias("run")).withColumn("ok", F.col("run") == 1)
    return check_statements(made, excerpts, crops, runs)


@query(_STATEMENTS + "SELECT batch, n, why, CASE WHEN why IS NULL THEN CASE WHEN k = 1 THEN batch + 1 ELSE batch END END AS owner FROM w")
def checked_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of a model against what they were shown."""
    return _statements(spark, sf_dir).select("batch", "n", "why", "owner")


@query(_STATEMENTS + """
    , c AS (SELECT batch, n, 'statement ' || v AS t, k IN (1, 3) AS visual, row_number() OVER (PARTITION BY batch ORDER BY n) AS c FROM w WHERE why IS NULL),
    g AS (SELECT batch, count(*) AS m, string_agg('- ' || t || ' [' || c || ']', chr(10) ORDER BY n) AS many, string_agg(t || ' [' || c || ']', chr(10) ORDER BY n) AS one, string_agg(t, chr(10) ORDER BY n) AS plain, bool_or(visual) AS silent FROM c GROUP BY 1)
    SELECT batch, CASE WHEN m = 1 THEN one ELSE many END || CASE WHEN silent THEN chr(10) || chr(10) || 'Read off a picture.' ELSE '' END AS answer, plain || CASE WHEN silent THEN chr(10) || chr(10) || 'Read off a picture.' ELSE '' END AS answer_text FROM g
""")
def assembled_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the statements that hold."""
    s = _statements(spark, sf_dir).where("why IS NULL")
    shown = s.select("batch", "n", "text", F.row_number().over(Window.partitionBy("batch").orderBy("n")).alias("citation"), (F.col("basis") == "image").alias("visual"))
    return assemble(shown, "batch", "picture", "Read off a picture.")
