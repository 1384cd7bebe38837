"""A small flow language: a drawing of boxes as data, checked first and compiled to one DataFrame plan.

A drawing is a list of boxes {"box": name, ...settings}. Frames hold boxes of their own: `if` takes the first way whose
condition holds for a row, `round` repeats its boxes until nothing changes or `most` is reached.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions.conditions import Facts, compile_condition, problems
from foliant.operators import claims, verification
from foliant.operators.lookup import reordered
from foliant.operators.retrieval import best_of_each, bm25, fuse, postings, top
from foliant.operators.texts import sections
from foliant.registry import query
from foliant.session import table
from foliant.staging import checked, discard, staged

Box = Callable[[DataFrame, dict], DataFrame]
BOXES: dict[str, Box] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def box(*needs: str) -> Callable[[Box], Box]:
    def keep(f: Box) -> Box:
        BOXES[f.__name__.rstrip("_")], NEEDS[f.__name__.rstrip("_")] = f, needs  # a trailing _ keeps a name apart
        return f

    return keep


def facts_of(df: DataFrame) -> Facts:
    """Every column as a variable."""
    return {("var", c): ("list" if t.startswith("array") else "var", F.col(c)) for c, t in df.dtypes}


@box("name", "value")
def set_(df: DataFrame, s: dict) -> DataFrame:
    """A variable from a SQL expression."""
    return df.withColumn(s["name"], F.expr(s["value"]))


@box("when")
def filter_(df: DataFrame, s: dict) -> DataFrame:
    return df.where(compile_condition(s["when"], facts_of(df)))


@box("of", "name")
def each(df: DataFrame, s: dict) -> DataFrame:
    """One row per entry of a list."""
    return df.withColumn(s["name"], F.explode(s["of"]))


@box("lists", "name")
def merge(df: DataFrame, s: dict) -> DataFrame:
    """Lists one after another, later repeats left out."""
    return df.withColumn(s["name"], F.array_distinct(F.concat(*s["lists"])))


@box("by", "order", "rank")
def order(df: DataFrame, s: dict) -> DataFrame:
    w = Window.partitionBy(*s["by"]).orderBy(*[F.expr(o).desc() if o in s.get("falling", ()) else F.expr(o).asc() for o in s["order"]])
    return df.withColumn(s["rank"], F.row_number().over(w))


@box("kind", "rank", "n")
def shown(df: DataFrame, s: dict) -> DataFrame:
    return best_of_each(df, s["kind"], s["rank"], s["n"])


@box("key")
def repeats(df: DataFrame, s: dict) -> DataFrame:
    return df.dropDuplicates(s["key"])


@box("ways")
def if_(df: DataFrame, s: dict) -> DataFrame:
    """The first way whose condition holds for a row; ways end in the same columns. Rows of no way pass, or take `else`."""
    free, out = F.lit(True), None
    facts = facts_of(df)
    ways = [(compile_condition(w["when"], facts), w["boxes"]) for w in s["ways"]] + [(F.lit(True), s.get("else", []))]
    for held, boxes in ways:
        part = compile_flow(df.where(free & held), boxes)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        free = free & ~held
    return out


@box("boxes", "most")
def round_(df: DataFrame, s: dict) -> DataFrame:
    """Its boxes again and again; every turn is written in the shared folder, and it ends when the watched sum stays the same."""
    before = None
    for _ in range(s["most"]):
        after = staged(compile_flow(df, s["boxes"]))
        discard(df)
        df = after
        now = df.agg(F.expr(s.get("watch", "count(*)"))).first()[0]
        if now == before:
            break
        before = now
    return df


@box("table", "on")
def beside(df: DataFrame, s: dict) -> DataFrame:
    """Columns of a table beside the rows, by a left join; a small table is broadcast when counted."""
    return df.join(checked(s["table"]), s["on"], "left")


@box("spec")
def check_value_(df: DataFrame, s: dict) -> DataFrame:
    """Type, unit and vocabulary of claimed values; refused ones stay, with their refusal."""
    return claims.check_value(df, s["spec"])


@box()
def check(df: DataFrame, s: dict) -> DataFrame:
    """Claims against their quotes and sources."""
    return verification.verify(df, s.get("decimal", "."))


@box("address", "value", "tolerance")
def settle(df: DataFrame, s: dict) -> DataFrame:
    return verification.settle(df, s["address"], s["value"], s["tolerance"])


@box("event", "name")
def state(df: DataFrame, s: dict) -> DataFrame:
    """The state that an event column ends in."""
    return df.withColumn(s["name"], claims.state_for(F.col(s["event"])))


@box("recorded", "key")
def ask(df: DataFrame, s: dict) -> DataFrame:
    """The recorded answers to the rows' requests, by key; a request that was never recorded has none."""
    return df.join(s["recorded"], s["key"], "left")


@box("passages", "question", "words")
def retrieve(df: DataFrame, s: dict) -> DataFrame:
    """The best passages of each row's question by words."""
    scores = bm25(df, s["question"], s["words"], postings(s["passages"], "key", "title", "text"), "key")
    return top(scores.withColumn("score", F.round("score", 6)), [s["question"]], "score", "key", s.get("top", 10))


@box("by", "rank", "score", "pool")
def rerank(df: DataFrame, s: dict) -> DataFrame:
    return reordered(df.withColumn("in_pool", F.col(s["rank"]) <= s["pool"]), s["by"], s["rank"], s["score"]).drop("in_pool")


@box("text", "key")
def split(df: DataFrame, s: dict) -> DataFrame:
    """A row per line of a text."""
    return sections(df, s["key"], s["text"])


@box("run", "schema")
def python(df: DataFrame, s: dict) -> DataFrame:
    """A function of one's own over Arrow batches as pandas frames: run(frame) gives a frame of the schema."""
    run = s["run"]
    return df.mapInPandas(lambda frames: (run(f) for f in frames), s["schema"])


@box("path")
def write(df: DataFrame, s: dict) -> DataFrame:
    """The rows as Parquet; a folder that is there is replaced by a new one when it is whole."""
    df.write.mode("overwrite").parquet(s["path"])
    return df.sparkSession.read.schema(df.schema).parquet(s["path"])


#: Columns that a box adds, by the settings that name them or outright; boxes that give another table name all of it.
ADDS = {"set": ["name"], "each": ["name"], "merge": ["name"], "order": ["rank"], "state": ["name"]}
GIVES = {"check": {"reason", "status", "tier", "flags"}, "check_value": {"refusal", "flags", "value_target", "value_uri", "unit", "unit_raw"}, "rerank": {"place"}}


def availability(boxes: list[dict], columns: set[str]) -> list[set[str]]:
    """The columns that are there before each box, by data-flow: what a box reads later must be among them."""
    out, there = [], set(columns)
    for b in boxes:
        out.append(set(there))
        there |= {b[k] for k in ADDS.get(b.get("box"), []) if k in b} | GIVES.get(b.get("box"), set())
        ways = [*(w.get("boxes", []) for w in b.get("ways", [])), b.get("else", [])] if "ways" in b else [b["boxes"]] if "boxes" in b else []
        for inner in ways:
            for x in inner:
                there |= {x[k] for k in ADDS.get(x.get("box"), []) if k in x}
    return out


def flow_problems(boxes: list[dict], columns: set[str], where: str = "flow") -> list[str]:
    """Unknown boxes, missing settings, and conditions about columns that aren't there yet, before anything runs."""
    out = []
    for i, (b, there) in enumerate(zip(boxes, availability(boxes, columns), strict=True)):
        at = f"{where}[{i}]"
        name = b.get("box")
        if name not in BOXES:
            out.append(f"{at}: unknown box {name}")
            continue
        out += [f"{at}: {name} needs {n}" for n in NEEDS[name] if n not in b]
        for part in [b.get("boxes", []), b.get("else", []), *(w.get("boxes", []) for w in b.get("ways", []))]:
            out += flow_problems(part, there, at)
        known = {("var", c): ("var", F.lit(0)) for c in there}
        for condition in [b["when"]] if name == "filter" and "when" in b else [w["when"] for w in b.get("ways", []) if "when" in w]:
            out += problems(condition, known, at)
    return out


def compile_flow(df: DataFrame, boxes: list[dict]) -> DataFrame:
    """The plan of a drawing. A box whose `off` is true is passed."""
    for b in boxes:
        if not b.get("off"):
            df = BOXES[b["box"]](df, b)
    return df


def run_flow(df: DataFrame, boxes: list[dict]) -> DataFrame:
    wrong = flow_problems(boxes, set(df.columns))
    if wrong:
        raise ValueError("; ".join(wrong))
    return compile_flow(df, boxes)


@query("""
    WITH t AS (SELECT *, n_chars // 100 AS size FROM documents), f AS (SELECT doc_id, lang, source, size, CASE WHEN lang = 'en' THEN size * 2 ELSE size END AS weight FROM t WHERE size >= 5),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, doc_id) AS rank FROM f)
    SELECT doc_id, lang, weight, rank FROM r WHERE rank <= 3
""")
def flow_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drawing with a filter, a choice of ways, an order and a cut."""
    drawing = [
        {"box": "set", "name": "size", "value": "n_chars div 100"},
        {"box": "filter", "when": {"all": [{"of": "var", "is": "size", "op": "at_least", "value": 5}]}},
        {"box": "if", "ways": [{"when": {"any": [{"of": "var", "is": "lang", "op": "is", "value": "en"}]}, "boxes": [{"box": "set", "name": "weight", "value": "size * 2"}]}], "else": [{"box": "set", "name": "weight", "value": "size"}]},
        {"box": "order", "by": ["lang"], "order": ["weight", "doc_id"], "falling": ["weight"], "rank": "rank"},
        {"box": "shown", "kind": "lang", "rank": "rank", "n": 3},
    ]
    return run_flow(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), drawing).select("doc_id", "lang", "weight", "rank")


@query("""
    WITH a AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
    b AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents),
    u AS (SELECT doc_id, lang, rank FROM a WHERE rank <= 8 UNION ALL SELECT doc_id, lang, rank FROM b WHERE rank <= 8)
    SELECT lang, doc_id, round(sum(1.0 / (60 + rank)), 9) AS score FROM u GROUP BY 1, 2
""")
def rrf_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rankings per language fused."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    one = run_flow(d, [{"box": "order", "by": ["lang"], "order": ["n_chars", "doc_id"], "falling": ["n_chars"], "rank": "rank"}]).where("rank <= 8")
    two = run_flow(d, [{"box": "order", "by": ["lang"], "order": ["doc_id"], "rank": "rank"}]).where("rank <= 8")
    return fuse([one, two], ["lang", "doc_id"]).select("lang", "doc_id", "score")


@query("""
    WITH s AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
    a AS (SELECT doc_id, pos, length(line) AS n, CASE pos % 4 WHEN 0 THEN 'skipped' WHEN 1 THEN 'refused' ELSE 'other' END AS event FROM s WHERE length(line) >= 40)
    SELECT doc_id, pos, CASE event WHEN 'skipped' THEN 'unanswered' WHEN 'refused' THEN 'unbacked' END AS state, CASE WHEN pos % 2 = 0 THEN 'known' END AS answer FROM a
""")
def flow_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drawing that splits texts, filters lines, asks recorded answers and sets states."""
    recorded = spark.createDataFrame([(0, "known")], "even long, answer string")
    drawing = [
        {"box": "split", "key": "doc_id", "text": "text"}, {"box": "set", "name": "n", "value": "length(line)"},
        {"box": "filter", "when": {"all": [{"of": "var", "is": "n", "op": "at_least", "value": 40}]}},
        {"box": "set", "name": "event", "value": "CASE pos % 4 WHEN 0 THEN 'skipped' WHEN 1 THEN 'refused' ELSE 'other' END"},
        {"box": "state", "event": "event", "name": "state"}, {"box": "set", "name": "even", "value": "pos % 2"}, {"box": "ask", "recorded": recorded, "key": "even"},
    ]
    return run_flow(table(spark, sf_dir, "documents").select("doc_id", "text"), drawing).select("doc_id", "pos", "state", "answer")
