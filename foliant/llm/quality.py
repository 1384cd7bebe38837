"""Quality rules as weak supervision (operator 7), in DataFrame functions throughout.

Rules over counted features vote good, bad or abstain. Expectation-maximisation over the votes of all documents
estimates how often each rule is right and how common good documents and each kind of bad ones are; a document is
kept if the posterior probability that it is good reaches one half.

The EM runs over the table of vote patterns, which has at most 3 ** len(rules()) rows however many documents there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import sql_words, staged

# Upper-case letters that are counted.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒŸ"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 40
KEEP = 0.5
#: Prior belief in how often a rule rejects documents that aren't bad in its own way, and finds those that are.
FALSE_ALARM, DETECTS = 0.01, 0.9
#: Weight of that belief, in votes as a share of the documents, and in votes at least.
BELIEF, LEAST_BELIEF = 0.01, 10.0


def occurrences(text: Column, characters: str) -> Column:
    """How many of the characters a text holds."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that come twice or more, the first included.

    Windows are known by a 64-bit hash. Most texts have no repeated window, which one pass over a hash set shows; only
    the rest sort their windows. Positions of repeated windows, in order, each cover up to the next one, three words at
    most.
    """
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))

    def covered(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # s is bound once by a one-element array, else each use would sort again.
        return F.element_at(F.transform(F.array(pairs), among_sorted), 1)

    def among_sorted(s: Column) -> Column:
        size = F.size(s)
        same_before = lambda i: (i > 0) & (F.get(s, i - 1)["h"] == F.get(s, i)["h"])
        same_after = lambda i: (i < size - 1) & (F.get(s, i + 1)["h"] == F.get(s, i)["h"])
        at = F.sort_array(F.transform(F.filter(s, lambda x, i: same_before(i) | same_after(i)), lambda x: x["i"]))
        return F.element_at(F.transform(F.array(at), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.when(i < F.size(p) - 1, F.least(F.lit(3), F.get(p, i + 1) - x)).otherwise(F.lit(3))), F.lit(0), lambda a, x: a + x)), 1)

    of = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))
    return F.when(n < 4, F.lit(0)).otherwise(F.element_at(F.transform(F.array(windows), of), 1)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """\\n-split lines that hold a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    return F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1).cast("long")


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts of every whole text; null is the empty text."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key), t.alias("__t"))
    split = base.select(key, "__t", sql_words(F.col("__t")).alias("__w"))
    return split.select(
        key,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        occurrences(F.col("__t"), SYMBOLS).alias("n_symbols"),
        duplicate_lines(F.col("__t")).alias("n_dup_lines"),
        repeat_words(F.col("__w")).alias("n_repeat_words"),
        occurrences(F.col("__t"), UPPER).alias("n_upper"),
        occurrences(F.col("__t"), "!").alias("n_exclaim"),
        occurrences(F.col("__t"), ".").alias("n_stops"),
        occurrences(F.col("__t"), "\n").alias("n_breaks"),
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(2)


def rules() -> dict[str, Column]:
    """Each rule votes 0 (bad), 1 (good) or 2 (abstains), by whole-number comparisons of the counts."""
    c = F.col
    return {
        "symbols": _vote(c("n_symbols") * 100 > c("word_chars") * 5, c("n_symbols") * 100 < c("word_chars")),
        "upper": _vote(c("n_upper") * 100 > c("word_chars") * 40, c("n_upper") * 100 < c("word_chars") * 15),
        "dup_lines": _vote(c("n_dup_lines") * 2 > c("n_breaks") + 1, c("n_dup_lines") == 0),
        "repeats": _vote(c("n_repeat_words") * 100 > c("n_words") * 30, c("n_repeat_words") * 100 < c("n_words") * 10),
        "word_length": _vote((c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 13), (c("word_chars") >= c("n_words") * 3) & (c("word_chars") <= c("n_words") * 10)),
        "sentences": _vote((c("n_stops") * 150 < c("n_words")) | (c("n_stops") * 2 > c("n_words")), (c("n_stops") * 50 > c("n_words")) & (c("n_stops") * 3 < c("n_words"))),
        "exclaims": _vote(c("n_exclaim") * 10 > c("n_words"), c("n_exclaim") * 50 <= c("n_words")),
        "length": _vote(c("n_words") < MIN_WORDS, c("n_words") >= 2 * MIN_WORDS),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[list[float], list[list[float]]]:
    """EM over (votes, number of documents): shares of the classes and, per class and rule, P(bad vote | class, it votes).

    Class 0 is good; class 1 + r is bad in the way that rule r looks for, since bad documents of one kind pass the rules
    for another. Abstaining says nothing. The accuracies are free: a weak belief, as many made votes as BELIEF says, tells
    the classes apart at the start and what the documents say outweighs it. It grows with the documents, so that a corpus
    of any size gives the same estimates. Shares are smoothed by one document.
    """
    n = len(patterns[0][0]) if patterns else 0
    votes_made = max(LEAST_BELIEF, BELIEF * sum(count for _, count in patterns))
    believed = [[FALSE_ALARM] * n for _ in range(n + 1)]
    for r in range(n):
        believed[1 + r][r] = DETECTS
    shares, table = [1 - 0.02 * n] + [0.02] * n, believed
    for _ in range(rounds if patterns else 0):
        mass = [1.0] * (n + 1)
        bad = [[p * votes_made for p in row] for row in believed]
        cast = [[votes_made] * n for _ in believed]
        for votes, count in patterns:
            for k, p in enumerate(posteriors(votes, shares, table)):
                mass[k] += p * count
                for r, v in enumerate(votes):
                    if v != 2:
                        cast[k][r] += p * count
                        bad[k][r] += p * count * (1 - v)
        shares = [m / sum(mass) for m in mass]
        table = [[x / y for x, y in zip(*row, strict=True)] for row in zip(bad, cast, strict=True)]
    return shares, table


def posteriors(votes: tuple[int, ...], shares: list[float], table: list[list[float]]) -> list[float]:
    """Probabilities of the classes, given votes."""
    like = [s * math.prod(b if v == 0 else 1 - b if v == 1 else 1.0 for v, b in zip(votes, by_rule, strict=True)) for s, by_rule in zip(shares, table, strict=True)]
    return [x / sum(like) for x in like]


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, the counts, base_failed, p_good and kept.

    base_failed holds for fewer than 50 words or more than half of them in repeated windows; such rows are never kept.
    Null and empty texts have counts of 0 and fail. Repeated rows are counted and returned as often as they come; a null
    key is passed on; an empty table gives no rows; extra columns are ignored.
    """
    names = list(rules())
    counted = staged(features(docs, key, text).withColumns(rules()))
    patterns = [(tuple(r[n] for n in names), r["count"]) for r in counted.groupBy(names).count().collect()]
    shares, table = estimate(sorted(patterns))
    # The classes' likelihoods as products over the rules that vote.
    like = []
    for share, by_rule in zip(shares, table, strict=True):
        one = F.lit(share)
        for name, bad in zip(names, by_rule, strict=False):
            one = one * F.when(F.col(name) == 0, bad).when(F.col(name) == 1, 1 - bad).otherwise(1.0)
        like.append(one)
    total = like[0]
    for one in like[1:]:
        total = total + one
    p = like[0] / total
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), p.alias("p_good"), (~failed & (p >= KEEP)).alias("kept"),
    )
