"""Column functions keep the promises of numbers, quotes, titles and conditions."""

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.functions.conditions import compile_condition, language_facts, language_problems, problems, sentence
from foliant.operators.evaluation import wilson
from foliant.operators.refinement import correct
from foliant.operators.versions import filename_for
from foliant.streaming.traces import decide


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "point", "comma"), [
    ("2.045.118,75", "2045118.75", "2045118.75"), ("9,300,000.50", "9300000.5", "9300000.5"), ("88413.2", "88413.2", "88413.2"), ("-12,50", "-12.5", "-12.5"), ("−3", "-3", "-3"),
    ("4.096", "4.096", "4096"), ("4,096", "4096", "4.096"), ("0.125", "0.125", "125"), ("007", "7", "7"), ("0,5", "0.5", "0.5"), ("abc", None, None), ("3.7.1", "371", "371"), ("12 500", "12500", "12500"),
    ("-0", "0", "0"), ("+4", "4", "4"), (".5", "0.5", "0.5"), (",", None, None), ("", None, None),
])
def test_numbers_have_one_spelling(spark, text, point, comma):
    assert one(spark, T.canonical_number(F.col("t")), t=text) == point and one(spark, T.canonical_number(F.col("t"), ","), t=text) == comma


def test_numbers_in_a_text_are_distinct_and_in_order(spark):
    assert one(spark, T.numbers_in(F.col("t")), t="from 3 to 4.096,5 and 3 (−7)") == ["3", "4096.5", "-7"]


def test_quotes_are_found_in_flat_text(spark):
    assert one(spark, T.quote_in(F.col("q"), F.col("s")), q="“the  total”", s='It was "the total" of all')
    assert not one(spark, T.quote_in(F.col("q"), F.col("s")), q="total", s="a total of")


def test_compatibility_characters_are_one(spark):
    assert one(spark, T.flat(F.col("t")), t="the eﬃcient  CO₂ ½ m² ﬂow ｗｉｄｅ") == "the efficient CO2 1⁄2 m2 flow wide"
    assert one(spark, T.quote_in(F.col("q"), F.col("s")), q="efficient office", s="an eﬃcient oﬃce")
    assert one(spark, T.fold_label(F.col("t")), t="CO₂-Ausstoß") == "co2-ausstoß"


def test_parts_of_tables(spark):
    t = "A title.\n| a | b |\n|---|---|\n| 1 | 2.5 |\n| 1 | 2.5 |\n| 3 | 4 |\na foot"
    assert [tuple(r) for r in one(spark, T.table_rows(F.col("t")), t=t)] == [("A title.", "title"), ("| a | b |", "head"), ("|---|---|", "rule"), ("| 1 | 2.5 |", "body"), ("| 1 | 2.5 |", "body"), ("| 3 | 4 |", "body"), ("a foot", "foot")]
    assert one(spark, T.table_rows(F.col("t")), t="no | table") is None and one(spark, T.head_of(F.col("t")), t=t) == "A title.\n| a | b |\n|---|---|"
    assert one(spark, T.drop_stutter(F.col("t")), t=t).count("2.5") == 1
    assert tuple(one(spark, T.cell_index(F.col("t"), F.lit("4")), t=t)) == (2, 2) and one(spark, T.cell_index(F.col("t"), F.lit("2.5")), t=t) is None


@pytest.mark.parametrize(("text", "wanted"), [("19.5", ("", 19, 5, None)), ("T3", ("T", 3, None, None)), ("12-14", ("", 12, None, 14)), ("A2-A4", ("A", 2, None, 4)), ("0", None), ("14-12", None), ("A2-B4", None), ("1.2-3", None), ("x", None)])
def test_addresses(spark, text, wanted):
    got = one(spark, T.address_of(F.col("t")), t=text)
    assert (None if got is None else tuple(got)) == wanted


def test_counts_of_words_and_numbers_of_their_own(spark):
    assert one(spark, T.times_alone(F.col("t"), F.lit("gas")), t="gas, biogas gas-fired gas") == 3 and one(spark, T.times_alone(F.col("t"), F.lit("x")), t="") == 0
    assert one(spark, T.times_number(F.col("t"), F.lit("109")), t="109 and 11.109 and 109,0 t") == 2
    assert one(spark, T.computed_from(F.lit("12.5"), F.lit(12.46))) and not one(spark, T.computed_from(F.lit("12.5"), F.lit(12.4)))
    assert one(spark, T.years_in(F.col("t")), t="1850, 2030 and 20301, 2045") == ["2030", "2045"]


def test_sentences_end_where_they_should(spark):
    got = one(spark, T.sentences_of(F.col("t"), ["approx", "z.B", "No"]), t="It rose by approx. Five units. On 3. May it fell!  \nSee z.B. Fig. 2? Yes.")
    assert got == ["It rose by approx. Five units.", "On 3. May it fell!", "See z.B. Fig.", "2?", "Yes."]


def test_replies_cut_off_are_closed(spark):
    closed = one(spark, T.close_brackets(F.col("t")), t='{"a": [1, {"b": "x]')
    assert closed == '{"a": [1, {"b": "x]"}]}'
    assert one(spark, T.loads_object(F.col("t")).isNotNull(), t=closed) and not one(spark, T.loads_object(F.col("t")).isNotNull(), t="[1]") and not one(spark, T.loads_object(F.col("t")).isNotNull(), t="{")


def test_placeholders_and_arguments(spark):
    df = spark.createDataFrame([("see [p1_t0] and [p1_t1]", {"p1_t0": "Table 1", "p1_t1": " "})], "t string, c map<string,string>")
    assert df.select(T.fill_placeholders(F.col("t"), F.col("c"))).first()[0] == "see Table 1 and [p1_t1]"
    assert df.select(T.fill_placeholders(F.col("t"), F.col("c"), True)).first()[0] == "see [p1_t0: Table 1] and [p1_t1]"
    got = one(spark, T.arguments_of(F.col("t")), t="parameter=heat%20use&coordinate.year=2030&level=&limit=5")
    assert got["plain"] == {"parameter": "heat use", "limit": "5"} and got["coordinates"] == {"year": "2030"}
    assert one(spark, T.wording_key(F.lit(" a "), F.lit(None), F.lit("b"))) == "a /  / b" and one(spark, T.wording_key(F.lit("a"), F.lit(None))) == "a"
    assert one(spark, T.family_name(F.lit("Jürgen Müller1,2*"))) == "muller" and one(spark, T.summary_line(F.lit(" "))) == "—"


def test_titles_lose_numbers_and_capitals(spark):
    assert one(spark, T.normalize_title(F.col("t")), t="1.2 3. ENERGY IN THE CITY") == "Energy IN THE CITY"


def test_file_names_of_urls(spark):
    assert one(spark, filename_for(F.col("u")), u="https://a.example/x/Report.PDF?y=1#z") == "report.pdf"


@pytest.mark.parametrize(("hits", "total", "low", "high"), [(0, 5, 0.0, 0.434482), (5, 5, 0.565518, 1.0), (0, 0, None, None)])
def test_wilson_is_exact_at_the_ends(spark, hits, total, low, high):
    got = one(spark, wilson(F.col("h"), F.col("n")), h=hits, n=total)
    assert got is None if low is None else (round(got["low"], 6), round(got["high"], 6)) == (low, high)


def test_conditions_hold_as_written(spark):
    facts = {("v", "n"): ("number", F.col("n")), ("v", "t"): ("text", F.col("t")), ("x", "state"): ("choice", F.col("s")), ("var", "w"): ("var", F.col("w"))}
    df = spark.createDataFrame([(None, "Abc", "unbacked", "7"), (3.0, "d", None, "x")], "n double, t string, s string, w string")

    def hold(tree):
        return [r["c"] for r in df.select(compile_condition(tree, facts).alias("c")).collect()]

    assert hold({"all": [{"of": "v", "is": "n", "op": "less", "value": 1}]}) == [True, False]
    assert hold({"any": [{"of": "v", "is": "t", "op": "contains", "value": "B"}, {"of": "x", "is": "state", "op": "is", "value": "none"}]}) == [True, True]
    assert hold({"all": [{"of": "x", "is": "state", "op": "is", "value": "open"}]}) == [True, False]
    assert hold({"all": [{"of": "var", "is": "w", "op": "less", "value": 9, "not": True}]}) == [False, True]
    assert hold({"all": []}) == [True, True] and hold({"any": []}) == [False, False]
    assert problems({"all": [{"of": "v", "is": "n", "op": "contains", "value": 1}, {"of": "q", "is": "n", "op": "is"}]}, facts) != []


def test_edits_must_occur_once_and_not_shrink():
    assert correct("a b a c", [("a", "x"), ("c", "d")]) == ("a b a d", 1)
    assert correct("abcdefghij", [("abcdefgh", "")]) == ("abcdefghij", 0)


def test_limit_controller_shrinks_and_grows():
    assert decide(100, False, 0.95, 0, 100) == 80 and decide(16, True, 0.1, 0, 0) == 16
    assert decide(100, False, 0.5, 0, 100) == 108 and decide(100, False, 0.5, 0, 50) == 100 and decide(510, False, 0.5, 0, 510) == 512


def test_whole_entries_of_a_cut_list(spark):
    t = '{"x": 1, "items": [{"a": "b], {"}, "two", [3, 4], {"cut": '
    assert one(spark, T.rescued(F.col("t"), "items"), t=t) == ['{"a": "b], {"}', '"two"', "[3, 4]"] and one(spark, T.rescued(F.col("t"), "none"), t=t) is None
    assert one(spark, T.rescued(F.col("t"), "items"), t='{"items": [1, 2], "more": [3]}') == ["1", "2"] and one(spark, T.rescued(F.col("t"), "items"), t='{"items": [12') is None


@pytest.mark.parametrize(("text", "thought", "cut", "cause"), [
    ('{"a": 1}', None, False, None), ('{"b": 1}', None, False, "missing_key"), ("", "hm", False, "reasoning_only"), ("", "", True, "cut_off"), (" ", None, False, "empty"), ('{"a": [1', None, True, "cut_off"),
    ('{"a": [1', None, False, "syntax"), ("none", None, False, "no_object"), ("[1]", None, False, "not_an_object"), ('so: {"a": 1}', None, False, "outside_text"),
])
def test_causes_of_unusable_replies(spark, text, thought, cut, cause):
    df = spark.createDataFrame([(text, thought, cut)], "t string, h string, c boolean")
    assert df.select(T.reply_cause(F.col("t"), F.col("h"), F.col("c"), "a")).first()[0] == cause


def test_the_language_of_conditions(spark):
    good = {"all": [{"of": "quote", "is": "length", "op": "less", "value": 20}, {"of": "coordinate", "is": "state", "op": "one_of", "value": ["open", "none"]}, {"of": "line", "is": "heading", "not": True}, {"of": "var", "is": "n"}]}
    assert language_problems(good) == [] and language_problems(good, {"quote", "coordinate", "line", "var:n"}) == []
    assert language_problems(good, {"quote", "coordinate", "line"}) == ["var:n is not known here"]
    assert sentence(good) == "when the quote's length is less than 20 and the coordinate's state is one of open or none and not the line's heading and n"
    bad = [{"of": "quote", "is": "size", "op": "is", "value": 1}, {"of": "quote", "is": "length", "op": "less", "value": "x"}, {"of": "chunk", "is": "kind", "op": "one_of", "value": ["page"]}, {"of": "line", "is": "heading", "op": "is", "value": 1},
           {"of": "value", "is": "words", "op": "contains"}, {"of": "value", "is": "words", "op": "contains", "value": 3}, {"of": "quote", "is": "length", "op": "is", "value": 1, "x": 2}]
    assert len(language_problems({"any": bad})) == len(bad) and language_problems({"all": []}) and language_problems({"all": [], "any": []})
    assert language_problems({"all": [{"of": "field", "is": "kind", "op": "one_of", "value": ["money"]}]}, None, {"field.kind": ["money"]}) == []
    df = spark.createDataFrame([(10, "unbacked", False, "x_1"), (30, None, False, "0"), (10, None, True, ""), (10, None, False, "7")], "q int, s string, h boolean, n string")
    facts = language_facts({"quote.length": F.col("q"), "coordinate.state": F.col("s"), "line.heading": F.col("h"), "var.n": F.col("n")})
    assert [r[0] for r in df.select(compile_condition(good, facts)).collect()] == [True, False, False, True]
    assert [r[0] for r in df.select(compile_condition({"all": [{"of": "var", "is": "n", "op": "term"}]}, facts)).collect()] == [True, False, False, False]
