"""Mixing sources to target weights by a temperature (operator 4).

The share of each source's tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are) and
normalised. Bisection finds the exponent that meets a target: an entropy to reach, or a limit on how often a source
may be repeated. The weights are then realised within a token budget: a source's documents are dealt into blocks by
a hash, the blocks are permuted anew for every pass, whole passes are taken while the budget lasts, and the last pass
stops inside one block at one document.

A row decides by itself: its source's plan, one row per source, says how many passes it gets and where the last one
ends. No text is shuffled, no source is gathered, and the bisection reads sums over the sources only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import sql_words, staged

#: Blocks of a source, and bits of the hash that cuts the one block at which the budget ends into parts.
BLOCKS, PART_BITS = 4096, 12
#: Exponents tried at once in one round of the bisection, and rounds: 2 ** -30 of the interval is left.
GRID, ROUNDS = 32, 6
SEED = 17


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for; budget in tokens, by default as many as there are.

    entropy: share, from 0 to 1, of the largest entropy possible (the log of the number of sources) to reach at least.
    repeats: passes over any source at most. The largest exponent that meets both targets is taken for the entropy, and
    the smallest for the repeats; if they conflict, the limit on repeats wins. If a budget of the limit's tokens
    doesn't exist, exponent 1 is taken and the budget is cut to what the limit allows.
    """

    entropy: float | None = 0.9
    repeats: float | None = 4.0
    budget: int | None = None


def tokens_of(text: Column) -> Column:
    """Tokens of a text: its words [^\\x20\\x09-\\x0D]+."""
    return F.size(sql_words(text)).cast("long")


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent t: (entropy of the weights, largest weight / share)."""
    aggs = []
    for k, t in enumerate(exponents):
        aggs += [F.sum(F.pow("p", F.lit(t))).alias(f"z{k}"), F.sum(F.pow("p", F.lit(t)) * F.log("p")).alias(f"l{k}")]
    r = shares.agg(F.min("p").alias("least"), F.max("p").alias("most"), *aggs).first()
    out = []
    for k, t in enumerate(exponents):
        z, lp = r[f"z{k}"], r[f"l{k}"]
        # w = p**t / z, so the entropy is log z - t * sum(p**t log p) / z, and w / p is largest at the least p.
        out.append((math.log(z) - t * lp / z, r["least"] ** (t - 1) / z))
    return out


def exponent(shares: DataFrame, target: Target, total: int, budget: int) -> tuple[float, int]:
    """(exponent, budget) for sources of shares p; each round narrows the interval GRID-fold by one aggregation."""
    n = shares.count()
    if n < 2:
        cap = total * target.repeats if target.repeats else budget
        return 1.0, int(min(budget, cap))

    def search(meets, lo: float, hi: float) -> tuple[float, float]:
        """Interval (lo, hi) with meets false at one end and true at the other, narrowed; meets is monotone."""
        at_hi = meets(_sums(shares, [hi])[0])
        for _ in range(ROUNDS):
            grid = [lo + (hi - lo) * k / GRID for k in range(GRID + 1)]
            flags = [meets(s) for s in _sums(shares, grid)]
            k = next(i for i, f in enumerate(flags) if f == at_hi)
            lo, hi = (grid[k - 1], grid[k]) if k else (grid[0], grid[0])
            if lo == hi:
                break
        return lo, hi

    t = 1.0
    if target.entropy is not None:
        enough = lambda s: s[0] >= target.entropy * math.log(n) - 1e-12  # noqa: E731  falls as t rises
        if not enough(_sums(shares, [1.0])[0]):
            t = search(enough, 0.0, 1.0)[0]
    if target.repeats is not None:
        within = lambda s: s[1] * budget <= target.repeats * total * (1 + 1e-12)  # noqa: E731  holds from some t on
        if not within(_sums(shares, [t])[0]):
            if within(_sums(shares, [1.0])[0]):
                t = search(within, t, 1.0)[1]
            else:
                t, budget = 1.0, int(target.repeats * total)
    return t, budget


def _place(row: Column, source: Column, epoch: Column) -> tuple[Column, Column]:
    """(block, rank): a row's block of its source, and the block's position in the permutation of a pass.

    The rank is a hash of block and pass, so permutations need no state; two blocks of one rank count as one.
    """
    block = F.pmod(F.xxhash64(F.lit(SEED), row), F.lit(BLOCKS))
    return block, F.xxhash64(F.lit(SEED), source, epoch, block)


def _cut(parts: DataFrame, order: str) -> DataFrame:
    """(source, cut, room) per source: the first part by order that no longer fits into room, and what room it meets.

    parts are (source, room, order, n); a source's parts are as few as the hashes that number them allow.
    """
    summed = parts.groupBy("source", "room", order).agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = summed.withColumn("upto", F.sum("n").over(upto)).where("upto > room")
    first = over.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(order))).where("k = 1")
    return first.select("source", F.col(order).alias("cut"), (F.col("room") - F.col("upto") + F.col("n")).alias("room"))


def _scheduled(docs: DataFrame, target: Target, key: str, source: str, text: str) -> tuple[DataFrame, DataFrame, float]:
    """(rows, plan, exponent): rows are (row, id, source, tokens, copies, weight), row a struct of all columns of docs, so
    that no name of theirs meets one of the plan's."""
    name = F.coalesce(F.col(source).cast("string"), F.lit("\x00null"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).alias("id"), name.alias("source"), tokens_of(F.col(text)).alias("tokens"))
    counted = staged(rows.select("id", "source", "tokens"))
    totals = staged(counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    total = int(totals.agg(F.sum("tokens")).first()[0] or 0)
    budget = target.budget if target.budget is not None else total
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    shares = totals.where("tokens > 0").withColumn("p", share)
    t, budget = exponent(shares, target, total, budget) if total else (1.0, 0)
    z = shares.agg(F.sum(F.pow("p", F.lit(t)))).first()[0] or 1.0
    some = F.col("tokens") > 0
    plan = totals.withColumn("weight", F.when(some, F.pow(share, F.lit(t)) / F.lit(z)).otherwise(0.0)).withColumn("want", F.floor(F.col("weight") * budget))
    plan = plan.withColumn("passes", F.when(some, F.floor(F.col("want") / F.col("tokens"))).otherwise(1).cast("int"))
    plan = plan.withColumn("left", F.when(some, F.col("want") - F.col("passes") * F.col("tokens")).otherwise(0))
    # Where the last pass ends: in a block, in one of the parts that a hash cuts the block into, at a document there.
    # No window sees more than BLOCKS or 2 ** PART_BITS rows of a source, or a block's part of its documents.
    places = counted.join(_small(plan.select("source", "passes", F.col("left").alias("room"))), "source")
    _, rank = _place(F.col("id"), F.col("source"), F.col("passes"))
    order = F.xxhash64(F.lit(SEED + 1), F.col("id"))
    places = places.select("source", "room", F.col("tokens").alias("n"), rank.alias("rank"), order.alias("order"), F.shiftright(order, 64 - PART_BITS).alias("part"))
    block = staged(_cut(places, "rank"))
    inside = places.drop("room").join(_small(block), "source").where("rank = cut").drop("cut")
    part = staged(_cut(inside, "part"))
    inside = inside.drop("room").join(_small(part), "source").where("part = cut").drop("cut")
    stop = _cut(inside, "order")
    ends = block.select("source", F.col("cut").alias("cut_rank")).join(stop.select("source", F.col("cut").alias("stop_order")), "source", "left")
    plan = staged(plan.join(ends, "source", "left"))
    joined = rows.join(_small(plan.select("source", "passes", "weight", "cut_rank", "stop_order")), "source", "left")
    last = F.when(F.col("cut_rank").isNull(), F.lit(False)).otherwise((rank < F.col("cut_rank")) | ((rank == F.col("cut_rank")) & (order < F.col("stop_order"))))
    out = joined.select("row", "id", "source", "tokens", (F.col("passes") + last.cast("int")).alias("copies"), "weight")
    return out, plan, t


def schedule(docs: DataFrame, target: Target = Target(), key: str = "doc_id", source: str = "source", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, plan). rows is docs with added columns __tokens, __copies, __weight and __source; plan has one row per source.

    Null sources are a source of their own; null and empty texts have no tokens and come as often as their block's pass
    says. Equal keys share their place in the order. The last pass of a source stops before the first document that
    would exceed its budget, so a source falls short of it by less than one document. docs must not have columns of the
    added names.
    """
    rows, plan, t = _scheduled(docs, target, key, source, text)
    added = [F.col(c).alias(f"__{c}") for c in ("tokens", "copies", "weight", "source")]
    return rows.select("row.*", *added), plan.withColumnRenamed("source", "__source").withColumn("exponent", F.lit(t))


def _small(plan: DataFrame) -> DataFrame:
    """A hint to broadcast the per-source plan, while it has few rows; else the join is left to Spark."""
    return F.broadcast(plan) if plan.limit(100_001).count() <= 100_000 else plan


def mixture(docs: DataFrame, target: Target = Target(), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The realised mixture: one row per document and pass, (key, source, n_tokens, weight, epoch, block, position).

    position orders the whole mixture: passes of all sources are laid over one another, each block at the fraction of
    its source's passes at which its turn comes, so that any stretch holds the sources by their weights. Documents that
    the budget leaves out do not appear. An empty table gives no rows; extra columns of docs are ignored.
    """
    rows, _, _ = _scheduled(docs.select(F.col(key), F.col(source), F.col(text)), target, key, source, text)
    each = rows.where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    block, rank = _place(F.col("id"), F.col("source"), F.col("epoch"))
    position = (F.col("epoch") + (rank.cast("double") / F.lit(2.0**64) + 0.5)) / F.col("copies")
    return each.select(F.col("id").alias(key), F.col(f"row.`{source}`").alias("source"), F.col("tokens").alias("n_tokens"), F.round("weight", 9).alias("weight"), "epoch", block.cast("int").alias("block"), position.alias("position"))


def mixed(docs: DataFrame, target: Target = Target(), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """docs with every row as often as the mixture has it, the columns as they were, whatever their names.

    Nulls, ties and repeated rows are treated as in schedule; an empty table stays empty.
    """
    rows, _, _ = _scheduled(docs, target, key, source, text)
    return rows.where("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
