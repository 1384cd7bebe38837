"""Column builders for text, numbers and tables; all stay inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as the same, and marks that count as a minus sign.
SAME = {"„": '"', "“": '"', "”": '"', "‟": '"', "«": '"', "»": '"', "‚": "'", "‘": "'", "’": "'", "‑": "-", "–": "-", "—": "-", "−": "-", " ": " "}
MINUS = "-–−"
QUOTE_MIN_CHARS = 8


def let(value: Column, use) -> Column:
    """use(value) with value computed once, however often use names it: a one-element array binds it."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Where compatibility characters stand that become several: fractions, the ellipsis, letter-like signs, units, ligatures.
SPREAD = (range(0xBC, 0xBF), range(0x2026, 0x2027), range(0x2100, 0x2190), range(0x3380, 0x33E0), range(0xFB00, 0xFB07))


def _compatible() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility characters of the basic plane by what Unicode's NFKC makes of them: one character, or several."""
    one, more = {}, {}
    for code in range(0x80, 0xFFFE):
        c = chr(code)
        n = c if 0xD800 <= code < 0xE000 else unicodedata.normalize("NFKC", c)
        if n != c and c not in SAME:
            if len(n) == 1:
                one[c] = SAME.get(n, n)
            elif any(code in r for r in SPREAD):
                more[c] = n
    return one, more


_ONE, _MORE = _compatible()


def nfkc(text: Column) -> Column:
    """Compatibility characters as their plain ones: ligatures, sub- and superscripts, wide forms, letter-like signs, units.

    Characters are mapped one by one; combining marks are left as they are.
    """
    plain = F.translate(text, "".join(_ONE), "".join(_ONE.values()))
    # One array of pairs that only a text with such a character walks; nested calls would outgrow generated code.
    pairs = F.split(F.lit("\u0001".join(f"{c}\u0002{n}" for c, n in _MORE.items())), "\u0001")
    spread = F.aggregate(pairs, plain, lambda t, p: F.replace(t, F.substring(p, 1, 1), F.substring_index(p, "\u0002", -1)))
    return F.when(plain.rlike("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in SPREAD) + "]"), spread).otherwise(plain)


def flat(text: Column) -> Column:
    """Text for comparisons: compatibility and look-alike characters unified, line-break tags and bold marks gone, white
    space collapsed."""
    plain = F.translate(nfkc(F.coalesce(text, F.lit(""))), "".join(SAME), "".join(SAME.values()))
    plain = F.when(F.contains(plain, F.lit("<")), F.regexp_replace(plain, r"(?i)<br\s*/?>", " ")).otherwise(plain)
    return F.trim(F.regexp_replace(F.replace(plain, F.lit("**"), F.lit("")), r"\s+", " "))


def quote_in(quote: Column, source: Column, least: int = QUOTE_MIN_CHARS) -> Column:
    """Is a quote, long enough, in a source, both flat."""
    return (F.length(flat(quote)) >= least) & F.contains(flat(source), flat(quote))


def canonical_number(text: Column, decimal: str = ".") -> Column:
    """One spelling of a printed number: no grouping, a point before decimals, null if it is none.

    decimal is the mark that the documents write decimals with. With both marks the last one is the decimal mark. Of one
    kind, several marks group, and a single one before exactly three digits groups unless it is the decimal mark; any
    other single mark is the decimal mark.
    """
    groups = "," if decimal == "." else "."

    def read(body: Column) -> Column:
        back = {c: F.locate(c, F.reverse(body)) for c in ",."}
        both = (back[","] > 0) & (back["."] > 0)
        last = F.when(both, F.least(*back.values())).otherwise(F.greatest(*back.values()))
        marks = F.length(body) - F.length(F.translate(body, ",.", ""))
        whole = (last == 0) | (~both & ((marks > 1) | ((last == 4) & (back[groups] == 4))))
        front = F.translate(F.when(whole, body).otherwise(F.substring(body, F.lit(1), F.length(body) - last)), ",.", "")
        rest = F.when(whole, "").otherwise(F.rtrim(F.right(body, last - 1), F.lit("0")))
        front = F.ltrim(front, F.lit("0"))
        return F.when(body.rlike(r"^[\d.,]*\d[\d.,]*$"), F.concat(F.when(front == "", "0").otherwise(front), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest))))

    def signed(t: Column) -> Column:
        minus = F.substring(t, 1, 1) == "-"
        bare = F.when(minus | (F.substring(t, 1, 1) == "+"), F.substring(t, F.lit(2), F.length(t))).otherwise(t)
        return let(let(bare, read), lambda n: F.when(minus & (n != "0"), F.concat(F.lit("-"), n)).otherwise(n))

    spaced = F.translate(F.trim(text), "–−", "--")
    bare = lambda t: F.when(t.rlike(r"\s|'"), F.regexp_replace(t, r"(?<=\d)[\s\u00a0\u202f\u2009'](?=\d{3}(\D|$))", "")).otherwise(t)
    # Most printed numbers are plain whole ones and need no reading.
    return let(spaced, lambda t: F.when(t.rlike(r"^-?[1-9]\d*$"), t).otherwise(let(bare(t), signed)))


def numbers_in(text: Column, decimal: str = ".") -> Column:
    """The distinct canonical numbers of a text, in order."""
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), "–−", "--"), F.lit(r"(?<![\p{L}\d.,])-?\d+(?:[.,]\d+)*"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda x: canonical_number(x, decimal)), lambda x: x.isNotNull()))


def printed_rounding(text: Column) -> Column:
    """Half a unit of the last digit printed."""
    return 0.5 * F.pow(F.lit(10.0), -F.length(F.regexp_extract(text, r"[.](\d+)$", 1)))


def precision(text: Column) -> Column:
    """Significant digits as printed."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"[^0-9]", ""), r"^0+|0+$", ""))


def words(text: Column) -> Column:
    """Words by white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")


def capped(text: Column, most: int) -> Column:
    """At most so many words, joined by one space where cut."""
    w = words(text)
    return F.when(F.size(w) > most, F.array_join(F.slice(w, 1, most), " ")).otherwise(text)


def count_tokens(text: Column) -> Column:
    """The fallback estimate: a token per four characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4))


def shingles(text: Column, k: int) -> Column:
    """Hashes of all runs of k words; the words are split once."""
    runs = lambda w: F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])))).otherwise(F.array().cast("array<long>"))
    return let(words(text), runs)


def strip_private_use(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Co}", "")


def clean_unicode(text: Column) -> Column:
    """Without surrogates, control characters (tab and line ends stay) and non-characters."""
    return F.regexp_replace(text, r"[\p{Cs}\x00-\x08\x0b\x0c\x0e-\x1f\x7f﷐-﷯￾￿]", "")


def dehyphenate(text: Column) -> Column:
    """A word divided at a line end is joined if it goes on in lower case."""
    return F.regexp_replace(text, r"(\p{L})-\n(\p{Ll})", "$1$2")


def normalize_title(title: Column) -> Column:
    """Without stacked numbering; titles in capitals are lowered word by word, but for acronyms of up to four letters."""
    bare = F.trim(F.regexp_replace(title, r"^(\s*(\d+\.?)+\s+)+", ""))
    shout = bare.rlike(r"\p{Lu}") & ~bare.rlike(r"\p{Ll}")
    lowered = F.array_join(F.transform(F.split(bare, " "), lambda w: F.when(F.length(w) <= 4, w).otherwise(F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, F.lit(2), F.length(w)))))), " ")
    return F.when(shout, lowered).otherwise(bare)


def normalize_header(text: Column) -> Column:
    """A running header's key: without numbers of up to four digits and punctuation, lower-cased."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\b\d{1,4}\b", " "), r"[\s\p{Punct}]+", " "))


def parse_date(text: Column) -> Column:
    """D:YYYYMMDD... as YYYY, YYYY-MM or YYYY-MM-DD, as far as it goes."""
    y, m, d = (F.regexp_extract(text, r"^(?:D:)?(\d{4})(?:(\d{2})(?:(\d{2}))?)?", i) for i in (1, 2, 3))
    return F.when(y == "", None).when(m == "", y).when(d == "", F.concat_ws("-", y, m)).otherwise(F.concat_ws("-", y, m, d))


def format_published(text: Column) -> Column:
    """20240708 as 2024-07-08, 2023q4 as 2023 Q4; others as they are."""
    return F.regexp_replace(F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"), r"^(\d{4})[qQ]([1-4])$", "$1 Q$2")


def bare_doi(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")


def cells_of(row: Column) -> Column:
    """Cells of a Markdown table row."""
    return F.transform(F.split(F.regexp_replace(F.trim(row), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))


def is_rule(row: Column) -> Column:
    """The rule under a table's head."""
    return row.rlike(r"^\s*\|?(\s*:?-{3,}:?\s*\|)+(\s*:?-{3,}:?\s*)?\|?\s*$")


def containment(part: Column, whole: Column) -> Column:
    """Share of distinct items of part that whole has."""
    return F.try_divide(F.size(F.array_intersect(part, whole)), F.size(F.array_distinct(part)))


def duplication(rows: Column) -> Column:
    """Share of rows that repeat another."""
    return 1 - F.try_divide(F.size(F.array_distinct(rows)), F.size(rows))


def window_around(text: Column, needle: Column, before: int, after: int) -> Column:
    """Characters around the first occurrence of needle; null without one."""
    at = F.call_function("locate", needle, text)
    return F.when(at > 0, F.substring(text, F.greatest(F.lit(1), at - before), F.length(needle) + before + after))


def guard_formula(text: Column) -> Column:
    """A cell that a spreadsheet would run gets a quote in front."""
    return F.when(text.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)


def language_of(text: Column, lists: dict[str, list[str]]) -> Column:
    """The language whose stop words are most frequent, `other` without any; ties go to the first."""
    w = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: x != "")
    counts = {k: F.size(F.filter(w, _among(v))) for k, v in lists.items()}
    most = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    chain = F.when(most == 0, "other")
    for k, n in counts.items():
        chain = chain.when(n == most, k)
    return chain


def _among(values: list[str]):
    return lambda x: x.isin(values)


def caption_like(text: Column, most: int = 40) -> Column:
    """Short enough to be a caption."""
    return F.coalesce((F.trim(text) != "") & (F.size(words(text)) <= most), F.lit(False))


def caption_opener(text: Column, openers: list[str]) -> Column:
    """Does a text open as a caption does: one of the words, then a number."""
    return F.coalesce(text.rlike(r"(?i)^\s*(" + "|".join(openers) + r")\.?\s*\d"), F.lit(False))


def year_in_range(number: Column, least: int = 1900, most: int = 2100) -> Column:
    return F.coalesce(number.between(least, most) & (number == F.floor(number)), F.lit(False))


def years_in(text: Column, least: int = 1900, most: int = 2100) -> Column:
    """The years that a text names, as four digits of their own, in order."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<!\d)\d{4}(?!\d)"), F.lit(0))
    return F.filter(found, lambda y: y.cast("int").between(least, most))


def fold_label(text: Column) -> Column:
    """One spelling of a vocabulary label: compatibility characters and case unified, nothing else."""
    return F.lower(nfkc(text))


def salient_tokens(text: Column) -> Column:
    """Distinct numbers, and words of two letters or more, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\d+(?:[.,]\d+)*|\p{L}{2,}"), F.lit(0)))


def long_words(text: Column) -> Column:
    """Distinct words of three letters or more, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0)))


def unreadable(source: Column, markdown: Column, known: Column, most_shared: float, least_known: float) -> Column:
    """Can a source not be read as the table: few of the transcription's tokens stand in it, and few of its words in the
    rest of the document."""

    def judge(x: Column) -> Column:
        shared = F.size(F.array_intersect(x["md"], x["here"])) / F.size(x["md"])
        told = F.size(F.array_intersect(x["said"], known)) / F.size(x["said"])
        return (F.size(x["md"]) > 0) & (F.size(x["said"]) > 0) & (shared < most_shared) & (told < least_known)

    return let(F.struct(salient_tokens(markdown).alias("md"), salient_tokens(source).alias("here"), long_words(source).alias("said")), judge)


def compared(number: Column, signs: bool = True) -> Column:
    """The spelling to look for: the magnitude where signs don't belong to numbers."""
    return number if signs else F.ltrim(number, F.lit("-"))


def times_alone(text: Column, needle: Column) -> Column:
    """How often a needle stands in a text with no letter or digit at its ends."""
    def count(t: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - F.length(needle) + 1)), lambda i: F.substring(t, i, F.length(needle)) == needle)
        alone = F.filter(at, lambda i: ~F.substring(t, F.greatest(i - 1, F.lit(1)), F.when(i > 1, 1).otherwise(0)).rlike(r"[\p{L}\d]") & ~F.substring(t, i + F.length(needle), F.lit(1)).rlike(r"[\p{L}\d]"))
        return F.when(F.contains(t, needle) & (needle != ""), F.size(alone)).otherwise(0)

    return let(F.coalesce(text, F.lit("")), count)


def times_number(text: Column, value: Column, decimal: str = ".") -> Column:
    """How often a number stands in a text as a number of its own."""
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), "–−", "--"), F.lit(r"(?<![\p{L}\d.,])-?\d+(?:[.,]\d+)*"), F.lit(0))
    return let(canonical_number(value.cast("string"), decimal), lambda v: F.size(F.filter(F.transform(found, lambda x: canonical_number(x, decimal)), lambda n: n == v)))


def computed_from(value: Column, expected: Column, noise: float = 1e-9) -> Column:
    """Is a number, as text, what its inputs make, to the rounding it is printed with."""
    v = value.cast("double")
    return F.coalesce(F.abs(v - expected) <= printed_rounding(value) + noise * F.greatest(F.abs(v), F.abs(expected)), F.lit(False))


def address_of(text: Column) -> Column:
    """struct<letter, line, cell, last> of an address such as 19.5, T3 or 12-14; null where it is none."""
    shape = r"^\s*([A-Z]?)(\d+)(?:\.(\d+))?(?:\s*-\s*([A-Z]?)(\d+))?\s*$"
    part = lambda i: F.regexp_extract(text, shape, i)
    line, last, cell = part(2).try_cast("int"), part(5).try_cast("int"), part(3).try_cast("int")
    good = text.rlike(shape) & (line > 0) & ((part(4) == "") | (part(4) == part(1))) & (last.isNull() | ((last >= line) & cell.isNull()))
    return F.when(good, F.struct(part(1).alias("letter"), line.alias("line"), cell.alias("cell"), last.alias("last")))


def table_rows(text: Column) -> Column:
    """array<struct<line, role>> of a Markdown table: title, head, rule, body and foot lines; null without a rule."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.trim(x) != "")
    is_row = lambda x: F.trim(x).rlike(r"^\|.*\|$")

    def roles(ls: Column) -> Column:
        rule = F.array_position(F.transform(ls, lambda x, i: is_rule(x) & (i > 0) & is_row(F.get(ls, i - 1))), True)
        before = F.filter(F.sequence(F.lit(1), F.size(ls)), lambda i: (i < rule) & ~is_row(F.get(ls, i - 1)))
        head = F.coalesce(F.array_max(before), F.lit(0)) + 1  # the first of the rows right above the rule
        after = F.filter(F.sequence(F.lit(1), F.size(ls)), lambda i: (i > rule) & ~is_row(F.get(ls, i - 1)))
        foot = F.coalesce(F.array_min(after), F.size(ls) + 1)
        role = lambda i: F.when(i < head, "title").when(i < rule, "head").when(i == rule, "rule").when(i >= foot, "foot").otherwise("body")
        return F.when(rule > 0, F.transform(ls, lambda x, i: F.struct(F.trim(x).alias("line"), role(i.cast("int") + 1).alias("role"))))

    return F.when(F.size(lines) > 0, let(lines, roles))


def head_of(text: Column) -> Column:
    """A table's title and head with the rule; empty where there is no head."""
    return let(table_rows(text), lambda rows: F.coalesce(F.array_join(F.transform(F.filter(rows, lambda r: r["role"].isin("title", "head", "rule")), lambda r: r["line"]), "\n"), F.lit("")))


def lines_of_number(quote: Column, value: Column, decimal: str = ".") -> Column:
    """The table rows of a quote that print a number."""
    rows = F.filter(F.split(F.coalesce(quote, F.lit("")), r"\r?\n"), lambda x: F.contains(x, F.lit("|")))
    return let(canonical_number(value.cast("string"), decimal), lambda v: F.filter(rows, lambda x: F.array_contains(numbers_in(x, decimal), v)))


def cell_index(quote: Column, value: Column, decimal: str = ".") -> Column:
    """struct<cell, cells>: the one cell, from 1, of the one row of a quote that prints a number; null if not certain."""
    def among(found: Column) -> Column:
        def place(cells: Column) -> Column:
            hits = F.filter(F.sequence(F.lit(1), F.size(cells)), lambda i: F.array_contains(numbers_in(F.element_at(cells, i), decimal), canonical_number(value.cast("string"), decimal)))
            return let(hits, lambda h: F.when(F.size(h) == 1, F.struct(F.element_at(h, 1).alias("cell"), F.size(cells).alias("cells"))))

        return F.when(F.size(found) == 1, let(cells_of(F.element_at(found, 1)), place))

    return let(lines_of_number(quote, value, decimal), among)


def drop_stutter(markdown: Column) -> Column:
    """Runs of identical data rows of a table as one."""
    lines = F.split(F.coalesce(markdown, F.lit("")), "\n")
    data = lambda x: F.trim(x).rlike(r"^\|.*[^|:\-\s]")
    return let(lines, lambda ls: F.array_join(F.filter(ls, lambda x, i: ~((i > 0) & data(x) & F.coalesce(F.trim(F.get(ls, i - 1)) == F.trim(x), F.lit(False)))), "\n"))


def sentences_of(text: Column, abbreviations: list[str]) -> Column:
    """Sentences of a text: they end at . ! or ? before white space and a capital, a digit or a quotation mark, but not
    after an abbreviation, a single letter or an ordinal number."""
    marked = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), r"([.!?][\"'»”)]*) (?=[\p{Lu}\d\"'«„“(])", "$1\u0001")
    kept = r"(?i)((?:^|[\s(\u0001])(?:" + "|".join(sorted(a.replace(".", r"\.") for a in abbreviations)) + r"|\p{L}|\d{1,2})\.)\u0001"
    joined = F.regexp_replace(F.regexp_replace(marked, kept, "$1 "), kept, "$1 ")
    return F.filter(F.split(joined, "\u0001"), lambda x: x != "")


def fill_placeholders(text: Column, captions: Column, keep_id: bool = False) -> Column:
    """[p13_tbl0] as the caption of its item, or with keep_id as [p13_tbl0: caption]; ids without a caption stay.

    captions is a map of the few items of the text's own section.
    """
    entries = F.filter(F.map_entries(F.coalesce(captions, F.create_map().cast("map<string,string>"))), lambda e: F.coalesce(F.trim(e["value"]) != "", F.lit(False)))
    new = lambda e: F.concat(F.lit("["), e["key"], F.lit(": "), F.trim(e["value"]), F.lit("]")) if keep_id else F.trim(e["value"])
    return F.aggregate(entries, text, lambda t, e: F.replace(t, F.concat(F.lit("["), e["key"], F.lit("]")), new(e)))


def outline_line(number: Column, kind: Column, text: Column, ref: Column, sample: int = 14) -> Column:
    """One line of a section's outline: a segment's number, its size and how it starts."""
    w = words(text)
    head = F.concat(F.array_join(F.slice(w, 1, sample), " "), F.when(F.size(w) > sample, " …").otherwise(""))
    shown = F.when(kind == "text", F.concat(F.lit("["), F.size(w).cast("string"), F.lit(" words] "), head)).otherwise(F.concat(F.lit("["), F.when(kind == "table", "TABLE").otherwise("FIGURE"), F.lit("] "), F.coalesce(ref, F.lit(""))))
    return F.concat(F.lpad(number.cast("string"), 4, " "), F.lit(" "), shown)


def summary_line(text: Column, most: int = 300) -> Column:
    """A text on one line, visibly cut; a dash for none."""
    one = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(one == "", "—").when(F.length(one) > most, F.concat(F.rtrim(F.substring(one, 1, most)), F.lit(" …"))).otherwise(one)


def wording_key(*fields: Column) -> Column:
    """The wordings that tell two numbers of one address apart, joined."""
    return F.trim(F.array_join(F.transform(F.array(*[c.cast("string") for c in fields]), lambda x: F.coalesce(F.trim(x), F.lit(""))), " / "), F.lit(" /"))


def request_digest(*parts: Column) -> Column:
    """The key of a question asked before: sha-256 of its parts with a zero character between."""
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def name_words(name: Column) -> Column:
    """The words of a person's name without marks, digits and case; accents are folded where Unicode composes them."""
    plain = F.translate(F.lower(F.coalesce(name, F.lit(""))), *_ACCENTS)
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(r"\p{L}{2,}"), F.lit(0)))


def name_words_kept(text: Column) -> Column:
    """All words of letters and digits in order, lower-cased, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def family_name(name: Column) -> Column:
    """The last word of a displayed name."""
    return F.coalesce(F.try_element_at(name_words(name), F.lit(-1)), F.lit(""))


def _accents() -> tuple[str, str]:
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250) if len(unicodedata.normalize("NFKD", chr(c))) > 1 and unicodedata.combining(unicodedata.normalize("NFKD", chr(c))[1])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTS = _accents()


def arguments_of(query: Column) -> Column:
    """struct<plain, coordinates> of a query string; names that begin with coordinate. go to the second map, empty values
    are left out."""
    pairs = F.filter(F.transform(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: F.struct(F.url_decode(F.substring_index(p, "=", 1)).alias("k"), F.url_decode(F.when(F.contains(p, F.lit("=")), F.substring_index(p, "=", -1)).otherwise("")).alias("v"))), lambda e: (e["k"] != "") & (e["v"] != ""))
    prefix = "coordinate."
    of = lambda inside: F.map_from_entries(F.transform(F.filter(pairs, lambda e: F.startswith(e["k"], F.lit(prefix)) == inside), lambda e: F.struct(F.when(F.lit(inside), F.substring(e["k"], F.lit(len(prefix) + 1), F.length(e["k"]))).otherwise(e["k"]), e["v"])))
    return F.struct(of(False).alias("plain"), of(True).alias("coordinates"))


def close_brackets(text: Column) -> Column:
    """A cut-off JSON text with the closers that it lacks; brackets in strings don't count, an open string is closed."""
    start = F.struct(F.lit("").alias("stack"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"))

    def step(a: Column, c: Column) -> Column:
        stack, quoted, escaped = a["stack"], a["quoted"], a["escaped"]
        opens, closes = ~quoted & c.isin("{", "["), ~quoted & c.isin("}", "]")
        moved = F.when(opens, F.concat(F.when(c == "{", "}").otherwise("]"), stack)).when(closes, F.substring(stack, F.lit(2), F.length(stack))).otherwise(stack)
        return F.struct(moved.alias("stack"), F.when((c == '"') & ~escaped, ~quoted).otherwise(quoted).alias("quoted"), (quoted & (c == "\\") & ~escaped).alias("escaped"))

    def close(t: Column) -> Column:
        return F.aggregate(F.split(t, ""), start, step, lambda a: F.concat(t, F.when(a["quoted"], '"').otherwise(""), a["stack"]))

    return let(F.rtrim(F.coalesce(text, F.lit(""))), close)


def loads_object(text: Column) -> Column:
    """A text that is one JSON object as variant, else null."""
    v = F.try_parse_json(text)
    return F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), v)


def rescued(text: Column, key: str) -> Column:
    """The complete entries, as JSON texts, of the list `key` of a reply that was cut off; null where there is none.

    A fold over the characters keeps depth and strings; an entry ends where the depth is back at the list's own.
    """
    tail = F.regexp_extract(F.coalesce(text, F.lit("")), "(?s)\"" + key + "\"\\s*:\\s*\\[(.*)$", 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(False).alias("done"), F.lit("").alias("now"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, c: Column) -> Column:
        quoted, depth = a["quoted"], a["depth"]
        flips = (c == '"') & ~a["escaped"]
        opens, closes = ~quoted & c.isin("{", "["), ~quoted & c.isin("}", "]")
        ends = ~quoted & (depth == 0) & c.isin(",", "]")
        after = F.when(opens, depth + 1).when(closes, depth - 1).otherwise(depth)
        kept = F.when(ends & (F.trim(a["now"]) != ""), F.concat(a["out"], F.array(F.trim(a["now"])))).otherwise(a["out"])
        moved = F.struct(after.alias("depth"), F.when(flips, ~quoted).otherwise(quoted).alias("quoted"), (quoted & (c == "\\") & ~a["escaped"]).alias("escaped"), (~quoted & (depth == 0) & (c == "]")).alias("done"),
                         F.when(ends, "").otherwise(F.concat(a["now"], c)).alias("now"), kept.alias("out"))
        return F.when(a["done"], a).otherwise(moved)

    # An object or text that is whole at the cut counts; a bare number or word might go on.
    last = lambda a: F.when(~a["done"] & (a["depth"] == 0) & ~a["quoted"] & F.trim(a["now"]).rlike(r'[}\]"]$'), F.concat(a["out"], F.array(F.trim(a["now"])))).otherwise(a["out"])
    return let(F.aggregate(F.split(tail, ""), start, step, last), lambda out: F.when((tail != "") & (F.size(out) > 0), out))


def reply_cause(text: Column, thought: Column, ran_out: Column, key: str) -> Column:
    """Why a reply can't be used, null if it is one JSON object with the key: cut_off, reasoning_only, empty, no_object,
    not_an_object, outside_text, syntax or missing_key."""
    t = F.trim(F.coalesce(text, F.lit("")))

    def judge(x: Column) -> Column:
        v = F.try_parse_json(x)
        whole = F.when(v.isNotNull(), F.schema_of_variant(v))
        inner = F.try_parse_json(F.regexp_extract(x, r"(?s)(\{.*\})", 1))
        return (
            F.when((x == "") & (F.coalesce(F.trim(thought), F.lit("")) != ""), "reasoning_only").when((x == "") & ran_out, "cut_off").when(x == "", "empty")
            .when(F.startswith(whole, F.lit("OBJECT")), F.when(F.variant_get(v, "$." + key, "variant").isNull(), "missing_key"))
            .when(v.isNotNull(), "not_an_object").when(ran_out, "cut_off").when(~F.contains(x, F.lit("{")), "no_object").when(inner.isNotNull(), "outside_text").otherwise("syntax")
        )

    return let(t, judge)
