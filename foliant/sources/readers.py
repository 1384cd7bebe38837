"""Readers: JSON lines, harvests, traces, folders of files, Turtle and Prometheus text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import parse_date
from foliant.registry import query
from foliant.session import ship_package, table


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines split at line feeds only, plain or gzip; lines that can't be read come with their text in `broken`."""
    raw = spark.read.option("lineSep", "\n").text(path).where("trim(value) <> ''")
    parsed = raw.select(F.from_json(F.rtrim("value"), schema, {"mode": "PERMISSIVE"}).alias("r"), "value", F.try_parse_json("value").isNull().alias("bad"))
    return parsed.select("r.*", F.when(F.col("bad"), F.col("value")).alias("broken"))


def harvest_folder(spark: SparkSession, path: str, schema: str) -> dict[str, DataFrame]:
    """A folder of harvests, one file per document: tuples, refusals, parameter states and broken lines, told by `kind`."""
    lines = json_lines(spark, path, "kind string, " + schema).withColumn("document", F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl(?:\.gz)?$", 1))
    of = lambda kind: lines.where((F.col("kind") == kind) & F.col("broken").isNull())
    return {"tuples": of("tuple"), "refusals": of("refusal"), "states": of("parameter_state"), "broken": lines.where(F.col("broken").isNotNull())}


def folder(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(filename, path, bytes, sha256) of the files below a folder; equal names get their folder in front."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    named = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    twice = named.groupBy("name").count().where("count > 1").select("name", F.lit(True).alias("twice"))
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return named.join(twice, "name", "left").select(F.when(F.col("twice"), F.concat_ws("_", parent, "name")).otherwise(F.col("name")).alias("filename"), "path", "bytes", "sha256")


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o, literal) of a file of N-Triples, or of Turtle with one triple a line."""
    line = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:\^\^<[^>]*>|@[A-Za-z-]+)?)\s*\.\s*$'
    raw = spark.read.text(path).where(F.col("value").rlike(line))
    g = lambda i: F.regexp_extract("value", line, i)
    return raw.select(g(1).alias("s"), g(2).alias("p"), F.when(g(3) != "", g(3)).otherwise(g(4)).alias("o"), (g(3) == "").alias("literal"))


_TURTLE = re.compile(
    r'''(?P<space>\s+)|(?P<comment>\#[^\n]*)|(?P<prefix>@prefix\b|@base\b|PREFIX\b|BASE\b)|(?P<iri><[^>]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<text>"(?:[^"\\\n]|\\.)*")'''
    r'''|(?P<tag>\^\^|@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<number>[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?(?=[\s;,.\])]))|(?P<mark>[;,.\[\]()])|(?P<name>[^\s;,\[\]()<>"]*[^\s;,\[\]()<>".]|:)''',
    re.DOTALL,
)
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", '"': '"', "\\": "\\"}
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def parse_turtle(text: str) -> list[tuple[str, str, str, bool, str | None]]:
    """(s, p, o, literal, comment) of a Turtle text: prefixes, lists of predicates and objects, literals with tags, blank nodes in
    brackets. comment holds the comment lines right above a subject. Collections in parentheses are refused."""
    prefixes: dict[str, str] = {}
    out: list[tuple] = []
    tokens = [(m.lastgroup, m.group()) for m in _TURTLE.finditer(text) if m.lastgroup != "space"]
    at, blank, remark = 0, 0, []

    def term(kind: str, raw: str) -> tuple[str, bool]:
        if kind == "iri":
            body = raw[1:-1]
            return (body if ":" in body else prefixes.get("@base", "") + body), False
        if kind in ("text", "long"):
            body = raw[3:-3] if kind == "long" else raw[1:-1]
            return re.sub(r"\\(u[0-9A-Fa-f]{4}|.)", lambda m: chr(int(m.group(1)[1:], 16)) if m.group(1)[0] == "u" and len(m.group(1)) == 5 else _ESCAPES.get(m.group(1), m.group(1)), body), True
        if kind == "number" or raw in ("true", "false"):
            return raw, True
        if raw == "a":
            return TYPE, False
        prefix, _, local = raw.partition(":")
        if prefix == "_":
            return raw, False
        if prefix not in prefixes:
            raise ValueError(f"no prefix {prefix}")
        return prefixes[prefix] + local, False

    def objects(subject: str, note: str | None, stop: str) -> None:
        """Predicates and objects up to the stop mark."""
        nonlocal at, blank
        predicate = None
        while True:
            kind, raw = tokens[at]
            at += 1
            if kind == "comment":
                continue
            if kind == "mark" and raw == stop:
                return
            if kind == "mark" and raw == ";":
                predicate = None
            elif kind == "mark" and raw == "[":
                blank += 1
                node = f"_:b{blank}"
                out.append((subject, predicate, node, False, note))
                objects(node, None, "]")
            elif kind == "mark" and raw == "(":
                raise ValueError("collections are not read")
            elif kind == "tag":
                if raw == "^^":
                    at += 1
            elif kind != "mark":
                value, literal = term(kind, raw)
                if predicate is None:
                    predicate = value
                else:
                    out.append((subject, predicate, value, literal, note))

    while at < len(tokens):
        kind, raw = tokens[at]
        at += 1
        if kind == "comment":
            remark.append(raw[1:].strip())
        elif kind == "prefix":
            base = raw.lower().lstrip("@") == "base"
            name = "@base" if base else tokens[at][1].rstrip(":")
            prefixes[name] = tokens[at + (not base)][1][1:-1]
            at += 1 + (not base)
            if at < len(tokens) and tokens[at] == ("mark", "."):
                at += 1
            remark = []
        elif kind == "mark" and raw == "[":
            blank += 1
            objects(f"_:b{blank}", None, "]")
            objects(f"_:b{blank}", None, ".")
        else:
            subject, _ = term(kind, raw)
            objects(subject, "\n".join(remark) or None, ".")
            remark = []
    return out


def turtle_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, s, p, o, literal, comment) of the Turtle files below a folder; a file is read whole by one task."""
    ship_package(spark)
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.ttl").text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(f, *t) for f, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in parse_turtle(text or "")]
            for i in range(0, len(rows), 20_000):
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 20_000], strict=True), kinds, strict=True)], ["file", "s", "p", "o", "literal", "comment"])

    return files.mapInArrow(run, "file string, s string, p string, o string, literal boolean, comment string")


def cassette(requests: DataFrame, recorded: DataFrame, model) -> DataFrame:
    """Answers of a model: recorded ones by key, others asked once per distinct key through model(keys DataFrame)."""
    known = requests.join(recorded, "key", "left")
    asked = model(known.where("answer IS NULL").select("key").distinct())
    return known.where("answer IS NOT NULL").unionByName(known.where("answer IS NULL").drop("answer").join(asked, "key"), allowMissingColumns=True)


def request_key(*parts: Column) -> Column:
    """The key of a request: equal requests have equal keys."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def parsed_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON of trace events, typed."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS published FROM orders
""")
def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as information dictionaries print them, read back."""
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_date(F.concat(F.lit("D:"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("120000Z"))).alias("published"))


@query("""
    SELECT event_type, count(DISTINCT user_id) AS asked, count(*) AS requests FROM events GROUP BY 1
""")
def asked_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal requests are asked once: distinct keys beside all requests."""
    e = table(spark, sf_dir, "events").select("event_type", request_key(F.col("event_type"), F.col("user_id")).alias("key"))
    return e.groupBy("event_type").agg(F.count_distinct("key").alias("asked"), F.count("*").alias("requests"))
