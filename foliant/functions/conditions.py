"""Conditions as data: {"all" | "any": [{"of", "is", "op", "value", "not"}, ...]} compiled to one Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The operators of each kind of property.
OPERATORS = {
    "yes": {"yes", None},
    "number": {"is", "is_not", "less", "more", "at_least", "at_most"},
    "text": {"is", "is_not", "contains", "empty", "matches"},
    "choice": {"is", "is_not", "one_of"},
    "list": {"has", "empty"},
    "var": {"is", "is_not", "less", "more", "at_least", "at_most", "contains", "empty", "whole", "one_of", "matches", "has", "term", None},
}
OPEN_STATES = ("exhausted", "unanswered", "unbacked")
_ORDER = {"less": "__lt__", "more": "__gt__", "at_least": "__ge__", "at_most": "__le__"}

# What a condition can be about, each subject's properties by kind, and the choices of a choice.
SUBJECTS = {
    "line": {"yes": "heading passage_begins table_begins figure_begins new_page", "choice": "role", "number": "lines_in_piece"},
    "field": {"yes": "has_list numbers once takes_group", "text": "name unit", "choice": "kind", "number": "rows"},
    "value": {"text": "field words quote", "number": "length number", "yes": "scenario_name in_table in_text", "choice": "passage"},
    "chunk": {"choice": "kind"},
    "figure": {"text": "description", "yes": "has_image", "number": "page image_width image_height"},
    "coordinate": {"text": "name", "choice": "state kind", "yes": "own_only required year closed_before plan_years unanswered own_value"},
    "answer": {"yes": "answered zero other_passage words_empty", "number": "finds follow_ups_used", "choice": "refusal"},
    "quote": {"number": "length lines", "yes": "number year"},
    "pieces": {"number": "shown left never_shown"},
    "round": {"number": "number"},
    "document": {"yes": "works plan_years", "number": "pieces pages requests seconds", "choice": "language", "text": "title"},
    "run": {"yes": "whole"},
}
FREE_SUBJECTS = ("var", "reading", "fact")
CHOICES = {
    ("line", "role"): "text title head body foot figure number heading", ("value", "passage"): "section table figure", ("chunk", "kind"): "section table figure",
    ("field", "kind"): "float int text category", ("coordinate", "kind"): "number list text name work quantity", ("document", "language"): "de en other",
    ("coordinate", "state"): "read unstated unbacked exhausted unanswered derived out_of_slice open none",
    ("answer", "refusal"): "none not_an_address words_not_in_line not_an_option name_not_listed quote_not_in_source quote_too_short answer_not_in_quote wrong_type unbacked own_check other",
}
SAID = {"is": "is", "is_not": "is not", "less": "is less than", "more": "is more than", "at_least": "is at least", "at_most": "is at most", "contains": "contains", "empty": "is empty",
        "one_of": "is one of", "has": "has", "matches": "matches", "whole": "is a whole number", "term": "is the identifier of a term"}

#: (subject, property) to (kind, column).
Facts = dict[tuple[str, str], tuple[str, Column]]


def problems(condition: dict, facts: Facts, where: str = "condition") -> list[str]:
    """What is wrong with a condition, before anything runs; empty if nothing is. Conditions nest."""
    out = []
    names = [k for k in ("all", "any") if k in condition]
    if len(names) != 1 or len(condition) != 1:
        return [f"{where}: one of all and any is needed"]
    for i, row in enumerate(condition[names[0]]):
        at = f"{where}.{names[0]}[{i}]"
        if "all" in row or "any" in row:
            out += problems(row, facts, at)
            continue
        fact = facts.get((row.get("of"), row.get("is")))
        if fact is None:
            out.append(f"{at}: unknown property {row.get('of')}.{row.get('is')}")
        elif row.get("op") not in OPERATORS[fact[0]]:
            out.append(f"{at}: {row.get('op')} is no operator of {fact[0]}")
    return out


def compile_condition(condition: dict, facts: Facts) -> Column:
    """The condition as a Column of true and false, never null. An empty `all` holds, an empty `any` doesn't."""
    wrong = problems(condition, facts)
    if wrong:
        raise ValueError("; ".join(wrong))
    rows = condition.get("all", condition.get("any"))
    made = [compile_condition(r, facts) if "all" in r or "any" in r else _row(r, facts) for r in rows]
    if "all" in condition:
        return reduce(lambda a, b: a & b, made, F.lit(True))
    return reduce(lambda a, b: a | b, made, F.lit(False))


def _row(row: dict, facts: Facts) -> Column:
    kind, column = facts[row["of"], row["is"]]
    held = F.coalesce(_holds(kind, column, row.get("op"), row.get("value"), row["is"]), F.lit(False))
    return ~held if row.get("not") else held


def _holds(kind: str, c: Column, op: str, value, name: str) -> Column:
    folded = F.lower(c.cast("string")) if kind in ("text", "choice", "var") else c
    if op in ("yes", None):
        # A variable on its own holds unless it is empty, zero, false or the empty text.
        return c if kind == "yes" else ~F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin("", "0", "0.0", "false")
    if op == "term":
        return F.coalesce(c.cast("string"), F.lit("")).rlike(r"^[A-Za-z]+_\d+$")
    if op in _ORDER:
        # A typed number that is missing reads as 0; a variable that is no number compares as false.
        number = F.coalesce(c.cast("double"), F.lit(0.0)) if kind == "number" else c.cast("string").try_cast("double")
        return getattr(number, _ORDER[op])(F.lit(float(value)))
    if op in ("is", "is_not"):
        if kind == "number":
            same = F.coalesce(c.cast("double"), F.lit(0.0)) == float(value)
        elif name == "state" and value == "open":
            same = c.isin(*OPEN_STATES)
        elif name == "state" and value == "none":
            same = c.isNull()
        else:
            as_number = c.cast("string").try_cast("double") == F.lit(str(value)).try_cast("double")
            same = F.coalesce(as_number, folded == str(value).lower()) if kind == "var" else folded == str(value).lower()
        return ~F.coalesce(same, F.lit(False)) if op == "is_not" else same
    if op == "contains":
        return F.contains(F.coalesce(folded, F.lit("")), F.lit(str(value).lower()))
    if op == "empty":
        return (F.size(F.coalesce(c, F.array())) == 0) if kind == "list" else F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""
    if op == "one_of":
        held = folded.isin(*[str(v).lower() for v in value])
        if name == "state":
            held = F.coalesce(held, F.lit(False)) | (F.coalesce(c.isin(*OPEN_STATES), F.lit(False)) & F.lit("open" in value)) | (c.isNull() & F.lit("none" in value))
        return held
    if op == "matches":
        return c.cast("string").rlike(value)
    if op == "whole":
        number = c.cast("string").try_cast("double")
        return number == F.floor(number)
    return F.array_contains(c, value)  # has


def kind_of(subject: str, name: str) -> str | None:
    """The kind of a subject's property; free subjects have variables."""
    if subject in FREE_SUBJECTS:
        return "var"
    return next((kind for kind, names in SUBJECTS.get(subject, {}).items() if name in names.split()), None)


def language_facts(columns: dict[str, Column]) -> Facts:
    """Facts from columns named subject.property, such as quote.length or var.size."""
    out = {}
    for full, column in columns.items():
        subject, name = full.split(".", 1)
        kind = kind_of(subject, name)
        if kind is None:
            raise ValueError(f"{subject} has no property {name}")
        out[subject, name] = (kind, column)
    return out


def language_problems(condition: dict, where: set[str] | None = None, entries: dict[str, list[str]] | None = None) -> list[str]:
    """What is wrong with a condition of the subjects at a place that knows `where` (names of subjects, var:name for variables;
    None: all). entries replaces the choices of a property, by subject.property, with a spec's own."""
    joiners = [k for k in ("all", "any") if isinstance(condition, dict) and k in condition]
    if len(joiners) != 1 or len(condition) != 1 or not isinstance(condition[joiners[0]], list) or not condition[joiners[0]]:
        return ["a condition is one list of rows under all or any"]
    return [said for row in condition[joiners[0]] if (said := _problem(row, where, entries or {}))]


def _problem(row: dict, where: set[str] | None, entries: dict[str, list[str]]) -> str | None:
    if not isinstance(row, dict) or set(row) - {"of", "is", "op", "value", "not"}:
        return "a row has of, is, op, value and not"
    subject, name, op, value = (row.get(k) for k in ("of", "is", "op", "value"))
    kind = kind_of(subject, name) if isinstance(name, str) else None
    if kind is None:
        return f"{subject} has no property {name}"
    here = f"var:{name.split('.')[0]}" if subject == "var" else subject
    if where is not None and here not in where:
        return f"{here} is not known here"
    if not isinstance(row.get("not", False), bool):
        return "not is yes or no"
    if op not in OPERATORS[kind] or (kind == "choice" and op != "one_of"):
        return f"{subject}.{name} does not take {op}"
    bare = op in (None, "yes", "empty", "whole", "term")
    if bare != ("value" not in row):
        return f"{subject}.{name} {SAID.get(op, '')}: " + ("no value" if bare else "the value is missing")
    if bare:
        return None
    if (kind == "number" or op in _ORDER) and (isinstance(value, bool) or not isinstance(value, int | float)):
        return f"{subject}.{name} is a number, not {value!r}"
    if op == "one_of":
        known = entries.get(f"{subject}.{name}") or CHOICES.get((subject, name), "").split()
        if not isinstance(value, list) or not value:
            return f"{subject}.{name}: pick one at least"
        wrong = [v for v in value if known and v not in known]
        return f"{subject}.{name} is one of {', '.join(known)}, not {wrong[0]!r}" if wrong else None
    return None if kind != "text" or isinstance(value, str) else f"{subject}.{name} is a text, not {value!r}"


def sentence(condition: dict) -> str:
    """A condition in words."""
    joiner = "all" if "all" in condition else "any"
    return "when " + (" and " if joiner == "all" else " or ").join(_said(r) for r in condition[joiner])


def _said(row: dict) -> str:
    no, op, value = "not " if row.get("not") else "", row.get("op"), row.get("value")
    what = str(row["is"]) if row["of"] == "var" else f"the {row['of']}'s {str(row['is']).replace('_', ' ')}"
    if op in (None, "yes"):
        return f"{no}{what}"
    shown = "" if value is None else " " + (" or ".join(map(str, value)) if isinstance(value, list) else str(value))
    return f"{what} {no}{SAID[op]}{shown}"
