"""URL filters: path rules, then logistic regression on hashed character n-grams (operator 1), in DataFrame functions.

The model is trained from a small table of labelled urls; its weights are an array literal of DIMENSIONS numbers,
whatever the number of pages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 2048
#: Lengths of the character n-grams.
SIZES = (3, 4)
ROUNDS = 120
RATE = 8.0
RIDGE = 0.002
#: The labelled table is small: it is trained on at the driver.
MOST_LABELLED = 10_000
#: A url is blocked from this probability on.
BLOCK_AT = 0.5

# The rules (verdict, host, path); an empty host stands for none.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# The labelled urls, 1 for block.
LABELLED = [
    ("https://www.daily-casino-bonus.example/slots/win", 1), ("http://free-pills.example/order?cheap=1", 1),
    ("http://xxx-video.example/adult/watch", 1), ("https://bet-now.example/casino/poker", 1),
    ("http://cheap-viagra.example/buy/now", 1), ("http://login-verify-account.example/secure/update", 1),
    ("https://m.hot-adult-cam.example/live/xxx", 1), ("http://crack-keygen.example/download/warez", 1),
    ("http://win-prize.example/claim/free-gift", 1), ("https://payday-loan.example/apply/instant", 1),
    ("http://tracker.ads.example/click/banner", 1), ("http://spam-links.example/seo/backlinks", 1),
    ("https://poker-slots.example/bonus/free", 1), ("http://adult-dating.example/hot/singles", 1),
    ("http://torrent-warez.example/crack/serial", 1), ("https://replica-watches.example/cheap/sale", 1),
    ("https://www.city-library.example/en/catalogue/120", 0), ("https://docs.project.example/guide/install.html", 0),
    ("https://blog.gardening.example/en/2019/spring", 0), ("http://news.example/world/article/4411", 0),
    ("https://www.university.example/research/papers/", 0), ("https://wiki.example/de/Geschichte", 0),
    ("https://museum.example/fr/collections/12.html", 0), ("http://www.weather.example/es/today", 0),
    ("https://en.dictionary.example/word/river", 0), ("https://m.recipes.example/en/soup/881", 0),
    ("https://science.example/journal/volume/3", 0), ("http://www.school.example/en/timetable/", 0),
    ("https://forum.linux.example/en/topic/5512", 0), ("https://history.example/de/artikel/77.html", 0),
    ("https://maps.example/fr/ville/9910", 0), ("https://www.theatre.example/en/programme/41", 0),
]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.locate("://", url) > 0, lower).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column) -> Column:
    """The longest fitting rule as struct<verdict, rule>, null if none fits.

    Longest means by the length of host plus path; at equal lengths the first in the list wins. An empty path starts
    with no rule's path.
    """
    chain = None
    for verdict, where, below in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(below)
        hit = F.struct(F.lit(verdict).alias("verdict"), F.lit(where + below).alias("rule"))
        chain = F.when(fits, hit) if chain is None else chain.when(fits, hit)
    return chain


def _numbers_of(name: str, n: int):
    """The lambda from a text's characters to the feature numbers of its n-grams."""

    def numbers(a: Column) -> Column:
        one = lambda i: F.pmod(F.xxhash64(F.lit(name), *(F.get(a, i + k) for k in range(n))), F.lit(DIMENSIONS)).cast("int") + 1
        return F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(0), F.size(a) - n), one)).otherwise(F.array().cast("array<int>"))

    return numbers


def grams(host: Column, path: Column) -> Column:
    """Feature numbers 1 to DIMENSIONS of all n-grams of ^host$ and of the path, each distinct one once.

    A text is split into its characters once for each n, so the work grows with its length and not with its square.
    """
    parts = []
    for name, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$")))):
        # The characters are bound by a one-element array, else each look-up would split the text again.
        parts += [F.element_at(F.transform(F.array(F.split(text, "")), _numbers_of(name, n)), 1) for n in SIZES]
    return F.array_distinct(F.concat(*parts))


def train(spark: SparkSession, labelled: DataFrame | None = None) -> list[float]:
    """Bias and DIMENSIONS weights from at most MOST_LABELLED labelled urls (url, block).

    Null urls count as empty, null labels are left out; more rows than the bound are an error. Batch gradient descent
    over the feature numbers, every url's features scaled to unit length.
    """
    if labelled is None:
        labelled = spark.createDataFrame(LABELLED, "url string, block int")
    u = F.col("url")
    x = labelled.where(F.col("block").isNotNull()).select(F.col("block").cast("double").alias("y"), grams(F.coalesce(host_of(u), F.lit("")), F.coalesce(path_of(u), F.lit(""))).alias("g"))
    rows = sorted((r["y"], tuple(r["g"])) for r in x.limit(MOST_LABELLED + 1).collect())
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled urls")
    weights = [0.0] * (DIMENSIONS + 1)
    for _ in range(ROUNDS if rows else 0):
        steps = [0.0] * (DIMENSIONS + 1)
        for y, found in rows:
            scale = len(found) ** -0.5 if found else 0.0
            z = weights[0] + scale * sum(weights[f] for f in found)
            error = (1 / (1 + math.exp(-z)) - y) / len(rows)
            steps[0] += 0.1 * error
            for f in found:
                steps[f] += scale * error
        weights = [w - RATE * (d + (RIDGE * w if k else 0.0)) for k, (w, d) in enumerate(zip(weights, steps, strict=True))]
    return weights


def probability(found: Column, weights: list[float]) -> Column:
    """P(block) of a url by its feature numbers."""
    table = F.split(F.lit(",".join(map(repr, weights[1:]))), ",").cast("array<double>")  # folded to one literal
    total = F.aggregate(found, F.lit(0.0), lambda a, f: a + F.element_at(table, f))
    z = F.lit(weights[0]) + F.when(F.size(found) > 0, total / F.sqrt(F.size(found).cast("double"))).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def judge(pages: DataFrame, weights: list[float], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: (key, host, path, rule, verdict, p_block).

    Null urls and urls without :// have empty host and path and get the model's verdict for them. Repeated rows come
    out repeated; null keys are passed on; an empty table gives no rows; extra columns are ignored.
    """
    u = F.col(url)
    parts = pages.select(F.col(key), F.coalesce(host_of(u), F.lit("")).alias("host"), F.coalesce(path_of(u), F.lit("")).alias("path"))
    ruled = parts.select(key, "host", "path", rule_of(F.col("host"), F.col("path")).alias("hit"), grams(F.col("host"), F.col("path")).alias("g"))
    scored = ruled.select(key, "host", "path", "hit", probability(F.col("g"), weights).alias("p_block"))
    learned = F.when(F.col("p_block") >= BLOCK_AT, "block").otherwise("allow")
    return scored.select(key, "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", learned).alias("verdict"), "p_block")
