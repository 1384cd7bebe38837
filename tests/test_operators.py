"""Operators on a few rows whose answers are plain."""

import json

import pytest
from pyspark.sql import functions as F

from foliant.operators import evaluation, folds, graph, layout, refinement, retrieval, store, tools, values, verification, versions
from foliant.plans import chat
from foliant.plans.flow import availability, flow_problems, run_flow
from foliant.sources import readers, writers
from foliant.streaming import traces


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def test_versions_supersede_in_order(spark):
    d = spark.createDataFrame([(1, "a", "2020"), (2, "a", None), (3, None, "2020"), (4, None, "2021")], "id long, g string, p string")
    got = {r["id"]: (r["supersedes"], r["is_current"]) for r in versions.link_versions(d, "g", "p", "id").collect()}
    assert got == {2: (None, False), 1: (2, True), 3: (None, True), 4: (None, True)}


def test_pairing_takes_twins_first(spark):
    old = spark.createDataFrame([("d", "x", 1), ("d", "y", 2), ("d", "z", 3)], "k string, sig string, pos long")
    new = spark.createDataFrame([("d", "y", 1), ("d", "w", 2)], "k string, sig string, pos long")
    got = {(r["old"], r["new"], r["kind"]) for r in evaluation.pair_rows(old, new, ["k"], "sig", "pos").collect()}
    assert got == {(2, 1, "same"), (1, 2, "changed"), (3, None, "gone")}


def test_equal_fused_scores_keep_the_first_ranking(spark):
    a = spark.createDataFrame([("p", 1), ("q", 2)], "d string, rank int")
    b = spark.createDataFrame([("q", 1), ("p", 2)], "d string, rank int")
    got = retrieval.fuse([a, b], ["d"]).orderBy(F.desc("score"), "first", "at").collect()
    assert [r["d"] for r in got] == ["p", "q"]


def test_trust_is_the_worst_of_origin_and_reasons(spark):
    d = spark.createDataFrame([(["open:year"], False), ([], True), ([], False), (["conflict", "open:x"], True)], "r array<string>, capped boolean")
    assert [r["l"] for r in d.select(values.trust(F.col("r"), F.col("capped")).alias("l")).collect()] == ["C", "B", "A", "D"]


def test_an_oversized_hit_is_packed_alone(spark):
    d = spark.createDataFrame([("q", 1, 5), ("q", 2, 500), ("q", 3, 4), ("q", 4, 96)], "k string, pos long, size long")
    assert rows(folds.pack_rows(d, "k", "pos", "size", 100), "pos", "pack") == [(1, 0), (2, 1), (3, 2), (4, 2)]


def test_no_word_is_lost_by_cuts(spark):
    text = " ".join(f"w{i}." if i % 9 == 0 else f"w{i}" for i in range(50))
    d = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, t string")
    got = rows(folds.cut_to_limit(d, "id", "t", 10, 15), "id", "part", "words")
    assert [w for i, _, w in got if i == 1] == [len(p.split()) for p in folds.cut_text(text, 10, 15)] and sum(w for _, _, w in got) == 50


def test_suppression_keeps_the_best_box(spark):
    b = spark.createDataFrame([(1, 1, "t", 0.9, 0.0, 0.0, 10.0, 10.0), (1, 2, "t", 0.8, 1.0, 1.0, 10.0, 10.0), (1, 3, "t", 0.7, 50.0, 0.0, 60.0, 10.0)], "page long, id long, label string, score double, x0 double, y0 double, x1 double, y1 double")
    assert rows(layout.suppress(b, ["page", "label"]), "id") == [(1,), (3,)]


def test_patterns_bind_and_options_stay_open(spark):
    t = spark.createDataFrame([("a", "type", "x"), ("b", "type", "x"), ("a", "name", "n")], "s string, p string, o string")
    got = graph.match(t, [("?s", "type", "x")], [("?s", "name", "?n")])
    assert {(r["s"], r["n"]) for r in got.collect()} == {("a", "n"), ("b", None)}


def test_closure_has_no_depth(spark):
    ring = [(100 + i, 100 + (i + 1) % 5) for i in range(5)]
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(0, 2), (0, 1), (7, 7), (200, 100)] + ring, "child long, parent long")
    got = rows(graph.closure(spark, e), "child", "ancestor")
    wanted = {(i, j) for i in range(41) for j in range(i + 1, 41)} | {(i, j) for i in [*range(100, 105), 200] for j in range(100, 105) if i != j}
    assert len(got) == len(set(got)) and set(got) == wanted


def test_merged_sections_go_to_the_last_kept(spark):
    s = spark.createDataFrame([(1, 1, "a", "merge_into_previous"), (1, 2, "b", "keep"), (1, 3, "c", "remove"), (1, 4, "d", "merge_into_previous")], "doc long, pos long, t string, action string")
    assert rows(refinement.apply_actions(s, "doc", "pos", "t", "action"), "pos", "t", "parts") == [(1, "a b d", 3)]


def test_claims_fail_at_the_first_check(spark):
    c = spark.createDataFrame([("5", "a quote of 5 t", "so: a quote of 5 t.", "section"), ("5", "short", "short", "section"), ("6", "a quote of 5 t", "so: a quote of 5 t.", "section"), ("6", "a quote of 5 t", "so: a quote of 5 t.", "figure")], "value string, quote string, source string, kind string")
    assert [r["reason"] for r in verification.verify(c).collect()] == [None, "quote_too_short", "value_not_in_quote", None]


def test_flows_are_checked_before_they_run(spark):
    assert flow_problems([{"box": "nothing"}, {"box": "set", "name": "x"}], set()) == ["flow[0]: unknown box nothing", "flow[1]: set needs value"]
    d = spark.createDataFrame([(1, 5), (2, 50)], "id long, n long")
    out = run_flow(d, [{"box": "round", "most": 4, "watch": "sum(n)", "boxes": [{"box": "set", "name": "n", "value": "least(n * 2, 60)"}]}])
    assert rows(out) == [(1, 60), (2, 60)]


def test_files_come_back_as_written(spark, tmp_path):
    t = spark.createDataFrame([("http://a", "p", 'say "x"'), ("http://a", "q", "1")], "s string, p string, o string")
    writers.to_turtle(t, str(tmp_path / "ttl"))
    assert ':p "say \\"x\\"' in "".join(p.read_text() for p in (tmp_path / "ttl").glob("part-*"))
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "doc1.jsonl").write_text('{"kind":"tuple","value":1}\n{"kind":"refusal","reason":"r s"}\nbroken{\n')
    got = readers.harvest_folder(spark, str(tmp_path / "h"), "value long, reason string")
    assert rows(got["tuples"], "document", "value") == [("doc1", 1)] and got["refusals"].count() == 1 and rows(got["broken"], "broken") == [("broken{",)]
    writers.to_csv(spark.createDataFrame([("=1+1", 2)], "a string, n int"), str(tmp_path / "csv"))
    assert "'=1+1,2" in "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))


def test_streams_give_what_batches_give(spark, sf_dir, tmp_path):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(str(tmp_path / "in"))
    stream = traces.windowed(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    assert rows(traces.run_to_end(stream, str(tmp_path / "w1"), str(tmp_path / "c1"), "complete")) == rows(traces.windowed(spark.read.parquet(f"{sf_dir}/events.parquet")))


def test_limits_are_kept_between_samples(spark, tmp_path):
    spark.createDataFrame([("h", i, False, 0.5, 0, 1000) for i in range(3)] + [("h", 3, True, 0.5, 0, 0)], "host string, at long, preempted boolean, kv double, waiting int, used int").coalesce(1).write.parquet(str(tmp_path / "s"))
    s = spark.readStream.schema("host string, at long, preempted boolean, kv double, waiting int, used int").parquet(str(tmp_path / "s"))
    assert rows(traces.run_to_end(traces.limits(s), str(tmp_path / "l1"), str(tmp_path / "c2")), "at", "limit") == [(0, 72), (1, 80), (2, 88), (3, 70)]


def test_chat_steps_are_checked_before_they_run():
    assert chat.chat_problems([{"step": "search", "into": "hits"}, {"step": "nothing"}, {"step": "pack", "budget": 9}, {"step": "fuse", "rankings": ["hits", "other"]}], {"questions", "passages"}) == ["[1]: unknown step nothing", "[3]: fuse reads other, which is not there yet"]


def test_tools_answer_messages(spark, sf_dir):
    store = tools.demo_store(spark, sf_dir)
    said = json.loads(tools.respond(store, json.dumps({"id": 1, "method": "tools/call", "params": {"name": "get_value", "arguments": {"id": "none"}}})))
    assert said["result"] == {"content": [{"type": "text", "text": "[]"}], "isError": False}
    assert json.loads(tools.respond(store, '{"id": 2, "method": "tools/call", "params": {"name": "get_value", "arguments": {"x": 1}}}'))["result"]["isError"]
    assert len(json.loads(tools.respond(store, '{"id": 3, "method": "tools/list"}'))["result"]["tools"]) == 8 and tools.respond(store, '{"method": "x"}') is None
    assert "error" in json.loads(tools.respond(store, "{")) and json.loads(tools.respond(store, '{"id": 4, "method": "x"}'))["error"]["code"] == -32601
    with pytest.raises(tools.BadRequest):
        tools.answer(store, "/find_values", "parameter=A&parameter=B")


def test_document_files_become_tables(spark, tmp_path):
    (tmp_path / "d1").mkdir()
    box = [0.0, 1.0, 2.0, 3.0]
    made = {"sections": [{"title": "T", "content": '["a", "b [p1_t0]"]', "page_number": 2, "pages": [2, 3, 2], "segments": [{"page": 2, "kind": "text", "text": "a", "bbox": box}, {"page": 3, "kind": "table", "ref": "p1_t0"}], "tables": [{"id": "p1_t0", "path": "", "page_number": 3, "caption": "C", "body": "| x |", "bbox": box}]}]}
    (tmp_path / "d1" / "document.json").write_text(json.dumps(made))
    t = store.to_tables(store.read_documents(spark, str(tmp_path)))
    assert rows(t["sections"]) == [("d1", 0, "T", "a\nb [p1_t0]", 2)] and rows(t["section_pages"], "page") == [(2,), (3,)] and t["segments"].count() == 2 and rows(t["items"], "block_id", "caption") == [("p1_t0", "C")]
    found = {(r["embedding_type"], r["text"]) for r in store.embedding_inputs(t["sections"], t["items"]).collect()}
    assert found == {("section_text", "T\na\nb C"), ("section_title", "T"), ("table_text", "C\n| x |")}
    now = store.fingerprint(t["segments"], "document", "text")
    assert [store.index_state(s, now).first()[0] for s in (None, "x", now.first()["digest"])] == ["missing", "stale", "current"]


def test_turtle_is_read_whole(spark, tmp_path):
    text = """@prefix ex: <http://e/> .
PREFIX x: <http://x/>
# trust: B
# one more
ex:a a ex:T ; ex:p "say \\"x\\" \\u00e9"@de , 4.5 ; x:q [ ex:r ex:b ; ex:n true ] .
<http://e/c> ex:d <f> ; ex:l \"\"\"two
lines\"\"\"^^ex:text .
"""
    (tmp_path / "g.ttl").write_text(text)
    got = {tuple(r)[1:] for r in readers.turtle_files(spark, str(tmp_path)).collect()}
    note, e = "trust: B\none more", "http://e/"
    assert got == {(e + "a", readers.TYPE, e + "T", False, note), (e + "a", e + "p", 'say "x" é', True, note), (e + "a", e + "p", "4.5", True, note), (e + "a", "http://x/q", "_:b1", False, note),
                   ("_:b1", e + "r", e + "b", False, None), ("_:b1", e + "n", "true", True, None), (e + "c", e + "d", "f", False, None), (e + "c", e + "l", "two\nlines", True, None)}
    with pytest.raises(ValueError):
        readers.parse_turtle("<a> <b> (1 2) .")


def test_tables_are_swapped_whole(spark, tmp_path):
    path, old = str(tmp_path / "t"), str(tmp_path / "past" / "t1")
    first = writers.swap(spark.createDataFrame([(1,)], "a int"), path)
    second = writers.swap(first.withColumn("a", F.col("a") + 1), path, old)
    assert rows(second) == [(2,)] and rows(spark.read.parquet(old)) == [(1,)] and not (tmp_path / "t.old").exists()
    writers.swap(spark.createDataFrame([(3,)], "a int"), path)
    assert rows(spark.read.parquet(path)) == [(3,)]
    asked = spark.sql("SELECT 'q' AS question, 'a' AS answer, timestamp'2024-05-06 07:08:09' AS asked_at")
    writers.log_requests(asked, str(tmp_path / "log"))
    writers.log_requests(asked, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_flows_know_what_is_there(spark):
    drawing = [{"box": "set", "name": "x", "value": "1"}, {"box": "filter", "when": {"all": [{"of": "var", "is": "x", "op": "is", "value": 1}]}}, {"box": "filter", "when": {"all": [{"of": "var", "is": "y", "op": "is", "value": 1}]}}, {"box": "check_value"}]
    assert availability(drawing, {"a"}) == [{"a"}, {"a", "x"}, {"a", "x"}, {"a", "x"}]
    assert flow_problems(drawing, {"a"}) == ["flow[2].all[0]: unknown property var.y", "flow[3]: check_value needs spec"]
    d = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(run_flow(d, [{"box": "python", "run": lambda f: f.assign(b=f.b * 2), "schema": "a int, b int"}, {"box": "beside", "table": spark.createDataFrame([(1, "z")], "a int, c string"), "on": "a"}])) == [(1, 4, "z")]
