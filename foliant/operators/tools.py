"""The eight read tools over a value store, called by name, by a query string, or by a JSON-RPC message.

Each tool returns a DataFrame that the caller collects within its own limit.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import parse_qsl

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import retrieval, values
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query
from foliant.session import table

#: Rows of a page at most, and where a page starts.
PAGE = 50


class BadRequest(ValueError):
    """A call that cannot be answered as it stands."""


class Store:
    """Values (document, pos, parameter, value, level, line and coordinates), refusals (document, parameter, reason) and passages
    (key, title, text) of one profile."""

    def __init__(self, rows: DataFrame, refusals: DataFrame, passages: DataFrame, spec: DataFrame):
        self.rows, self.refusals, self.passages, self.spec = rows, refusals, passages, spec


def list_documents(store: Store) -> DataFrame:
    return store.rows.groupBy("document").agg(F.count("*").alias("values"), F.count_distinct("parameter").alias("parameters"))


def list_parameters(store: Store) -> DataFrame:
    return store.spec.join(store.rows.groupBy("parameter").agg(F.count("*").alias("values"), F.count_distinct("document").alias("documents")), "parameter", "left").fillna(0)


def find_values(store: Store, document=None, parameter=None, worst=None, coordinates=None, limit: int = PAGE, offset: int = 0) -> DataFrame:
    unknown = [c for c in coordinates or {} if c not in store.rows.columns]
    if unknown:
        raise BadRequest(f"no coordinate {unknown[0]}")
    return values.find(store.rows, document=document, parameter=parameter, worst=worst, coordinates=coordinates, limit=min(int(limit), PAGE), offset=int(offset), order=["document", "pos"])


def get_value(store: Store, id: str) -> DataFrame:
    return store.rows.where(F.col("id") == id)


def get_states(store: Store, document=None) -> DataFrame:
    s = values.states(store.rows.withColumn("accepted", F.lit(True)), store.spec, store.rows)
    return s if document is None else s.where(F.col("document") == document)


def get_coverage(store: Store) -> DataFrame:
    return get_states(store).groupBy("parameter", "state").agg(F.count("*").alias("n"))


def find_refusals(store: Store, document=None, parameter=None, reason=None, limit: int = PAGE, offset: int = 0) -> DataFrame:
    out = store.refusals
    for name, wanted in (("document", document), ("parameter", parameter)):
        out = out if wanted is None else out.where(F.col(name) == wanted)
    out = out if reason is None else out.where(F.startswith("reason", F.lit(reason)))
    return out.orderBy(*store.refusals.columns).offset(int(offset)).limit(min(int(limit), PAGE))


def search(store: Store, text: str, top: int = 10) -> DataFrame:
    spark = store.passages.sparkSession
    asked = spark.createDataFrame([(0, text)], "question long, text string").select("question", retrieval.query_words(F.col("text")).alias("words"))
    scores = retrieval.bm25(asked, "question", "words", retrieval.postings(store.passages, "key", "title", "text"), "key")
    return retrieval.top(scores.withColumn("score", F.round("score", 6)), ["question"], "score", "key", min(int(top), PAGE)).drop("question")


TOOLS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (list_documents, list_parameters, find_values, get_value, get_states, get_coverage, find_refusals, search)}


def call(store: Store, name: str, arguments: dict | None = None) -> DataFrame:
    """One tool by its name; an unknown name or argument is a BadRequest."""
    if name not in TOOLS:
        raise BadRequest(f"no tool {name}")
    f = TOOLS[name]
    known = set(f.__code__.co_varnames[1 : f.__code__.co_argcount])
    wrong = sorted(set(arguments or {}) - known)
    if wrong:
        raise BadRequest(f"{name} takes no {wrong[0]}")
    return f(store, **(arguments or {}))


def answer(store: Store, path: str, query_string: str = "") -> DataFrame:
    """A GET request: the last part of the path is the tool, coordinate.x=y go to its coordinates; no name twice."""
    arguments: dict = {}
    for name, value in parse_qsl(query_string):
        into, key = (arguments.setdefault("coordinates", {}), name.removeprefix("coordinate.")) if name.startswith("coordinate.") else (arguments, name)
        if key in into:
            raise BadRequest(f"{name} is given twice")
        into[key] = value
    return call(store, path.rstrip("/").rsplit("/", 1)[-1], arguments)


def respond(store: Store, message: str) -> str | None:
    """A JSON-RPC message: tools/list, or tools/call whose rows (a page at most) come back as text. Notifications get nothing."""
    try:
        asked = json.loads(message)
    except json.JSONDecodeError:
        return json.dumps({"jsonrpc": "2.0", "id": None, "error": {"code": -32700, "message": "no JSON"}})
    if "id" not in asked:
        return None
    reply: dict = {"jsonrpc": "2.0", "id": asked["id"]}
    method, params = asked.get("method"), asked.get("params") or {}
    if method == "tools/list":
        reply["result"] = {"tools": [{"name": n, "description": (f.__doc__ or n.replace("_", " ")).strip()} for n, f in TOOLS.items()]}
    elif method == "tools/call":
        try:
            rows = [json.loads(x) for x in call(store, params.get("name"), params.get("arguments")).limit(PAGE).select(F.to_json(F.struct("*"))).toPandas().iloc[:, 0]]
            reply["result"] = {"content": [{"type": "text", "text": json.dumps(rows, ensure_ascii=False)}], "isError": False}
        except BadRequest as e:
            reply["result"] = {"content": [{"type": "text", "text": str(e)}], "isError": True}
    else:
        reply["error"] = {"code": -32601, "message": f"no method {method}"}
    return json.dumps(reply, ensure_ascii=False)


def demo_store(spark: SparkSession, sf_dir: str) -> Store:
    """lineitem as values and refusals, documents as passages."""
    h = harvest(spark, sf_dir).withColumn("level", F.when(F.col("discount") >= 0.08, "D").otherwise("A")).withColumn("id", F.concat_ws(".", "document", "pos"))
    passages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.col("source").alias("title"), "text")
    refusals = h.where("discount = 0.05").select("document", "parameter", F.when(F.col("pos") % 2 == 0, "quote_too_short").otherwise("wrong_type").alias("reason"), "pos")
    return Store(h, refusals, passages, h.select("parameter").distinct())


@query(HARVEST + "SELECT document, pos, value FROM h WHERE parameter = 'R' AND status = 'F' AND discount < 0.08 ORDER BY document, pos LIMIT 20 OFFSET 5")
def tool_find_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of values by a query string."""
    return answer(demo_store(spark, sf_dir), "/v1/find_values", "parameter=R&worst=A&coordinate.status=F&limit=20&offset=5").select("document", "pos", "value")


@query(HARVEST + "SELECT document, parameter, CASE WHEN pos % 2 = 0 THEN 'quote_too_short' ELSE 'wrong_type' END AS reason, pos FROM h WHERE discount = 0.05 AND pos % 2 = 0 ORDER BY 1, 2, 3, 4 LIMIT 50")
def tool_find_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of refusals of one reason."""
    return call(demo_store(spark, sf_dir), "find_refusals", {"reason": "quote"})


@query(HARVEST + "SELECT parameter, count(*) AS values, count(DISTINCT document) AS documents FROM h GROUP BY 1")
def tool_list_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameters of a store."""
    return call(demo_store(spark, sf_dir), "list_parameters")


@query(HARVEST + """, s AS (SELECT d.document, p.parameter, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.document = d.document AND h.parameter = p.parameter) THEN 'read' ELSE 'silent' END AS state
    FROM (SELECT DISTINCT document FROM h) d CROSS JOIN (SELECT DISTINCT parameter FROM h) p) SELECT parameter, state, count(*) AS n FROM s GROUP BY 1, 2""")
def tool_get_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a store by parameter and state."""
    return call(demo_store(spark, sf_dir), "get_coverage")
