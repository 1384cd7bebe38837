"""Exact dedup by a heavy-hitter split (operator 3).

Misra-Gries summaries find the digests that may be frequent. Their exact sizes and winners are counted, and
the few verified ones are broadcast, so that rows of a hot group are decided where they lie. All other digests
are grouped by an ordinary shuffle of digests, never of texts, in which no group exceeds a share of 1 / (k + 1).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import checked, free_name, made, staged, sweep
from foliant.session import ship_package

#: Counters of a Misra-Gries summary: digests with more than 1 / (k + 1) of all rows are surely found. There are more of
#: them the more rows there are, so that a group that isn't split has about GROUP rows at most, up to MOST_COUNTERS.
HOT_COUNTERS, MOST_COUNTERS, GROUP = 255, 16_383, 1_000_000
#: Summaries merged by one task of a merge level.
FAN_IN = 64


def shrink(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """The Misra-Gries reduction to k counters: take the (k+1)-th largest count from all and drop what is left at 0.

    Each unit taken from a survivor goes with the same unit of at least k other digests, so over any tree of merges a
    digest loses at most n / (k + 1) of its n-row total.
    """
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: c - cut for d, c in counts.items() if c > cut}


def summarise(batches: Iterator[pa.RecordBatch], k: int) -> dict[bytes, int]:
    """Misra-Gries over batches of (digest, n)."""
    summary: dict[bytes, int] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        grouped = pa.table({"digest": batch.column(0), "n": batch.column(1)}).group_by("digest").aggregate([("n", "sum")])
        for digest, n in zip(grouped.column("digest").to_pylist(), grouped.column("n_sum").to_pylist(), strict=True):
            summary[digest] = summary.get(digest, 0) + n
        summary = shrink(summary, k)
    return summary


def frequent(digests: DataFrame, k: int = HOT_COUNTERS) -> DataFrame:
    """At most k rows (digest, n) holding every digest of more than 1 / (k + 1) of the rows; n is a lower bound.

    One summary a partition, then merges of FAN_IN summaries each until one is left: no task sees more than
    FAN_IN * k counters, however many partitions there are.
    """

    def partial(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        found = summarise((pa.RecordBatch.from_arrays([b.column(0), pa.array([1] * b.num_rows, pa.int64())], ["digest", "n"]) for b in batches), k)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(found), pa.int64()), "digest": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    def merge(group: pa.Table) -> pa.Table:
        found = summarise(group.select(["digest", "n"]).to_batches(), k)
        part = pc.divide(group.column("part")[0], FAN_IN).as_py() if group.num_rows else 0
        return pa.table({"part": pa.array([part] * len(found), pa.int64()), "digest": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    schema = "part long, digest binary, n long"
    ship_package(digests.sparkSession)
    source = digests.select("digest")
    level, width = source.mapInArrow(partial, schema), source.rdd.getNumPartitions()
    while width > 1:
        level = level.groupBy((F.col("part") / FAN_IN).cast("long").alias("next")).applyInArrow(merge, schema)
        width = -(-width // FAN_IN)
    return level.select("digest", "n")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int | None = None) -> DataFrame:
    """One row per input row: (key, keep_id, group_size, kept, text_sha256).

    Equal texts are identical strings, no normalisation; null text counts as empty. The row with the largest key stays.
    A null key is smaller than any other. Rows that repeat key and text are copies as well: one of them is kept. An
    empty table gives an empty result. Extra columns of docs are ignored.
    """
    rows = docs.select(F.col(key).alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"))
    rows = staged(rows)
    total = rows.count()
    k = k or min(MOST_COUNTERS, max(HOT_COUNTERS, total // GROUP))
    candidates = frequent(rows, k).select("digest")
    # At most k rows by construction, so both broadcasts are bounded.
    hot = rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    hot = staged(hot.where(F.col("group_size") * (k + 1) > total).coalesce(1))
    by_digest = Window.partitionBy("digest")

    def ranked(df: DataFrame) -> DataFrame:
        """Among equal texts the first row by descending id is the one kept."""
        return df.withColumn("kept", F.row_number().over(by_digest.orderBy(F.desc_nulls_last("id"))) == 1)

    inside = rows.join(F.broadcast(hot), "digest")
    won = F.col("id").eqNullSafe(F.col("keep_id"))
    columns = ["id", "keep_id", "group_size", "kept", "digest"]
    decided = inside.where(~won).withColumn("kept", F.lit(False)).select(columns)
    winners = ranked(inside.where(won)).select(columns)
    rest = rows.join(F.broadcast(hot), "digest", "left_anti")
    rest = ranked(rest).withColumn("keep_id", F.max("id").over(by_digest)).withColumn("group_size", F.count("*").over(by_digest)).select(columns)
    return decided.unionByName(winners).unionByName(rest).select(F.col("id").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int | None = None) -> DataFrame:
    """docs with one row of each group of equal texts, all columns kept, whatever their names.

    Texts move only if the list of dropped keys is too large to broadcast. Keys repeated among the kept rows are rare;
    only their rows are sorted to keep one row per text. Null texts are copies of the empty one; an empty table stays empty.
    """
    start = made()
    report = staged(exact_groups(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text", k))
    kept = report.where("kept").select(F.col("id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    losers = report.where(~F.col("kept")).select("id", F.col("text_sha256").alias("sha")).distinct()
    # A key may stand for a kept and a dropped row at once (repeated rows, or one key with two texts): then the text decides.
    tied = staged(losers.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")), "left_semi").coalesce(1))
    again = not tied.isEmpty()
    dropped = staged(losers.join(tied, ["sha"], "left_anti") if again else losers)
    sweep(docs.sparkSession, start, tied, dropped)
    dropped = checked(dropped)
    sha, rank = free_name("sha", [*docs.columns, "id", "sha"]), free_name("rank", docs.columns)
    work = docs.withColumn(sha, F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256))
    out = work.join(dropped, work[f"`{key}`"].eqNullSafe(dropped["id"]) & (work[sha] == dropped["sha"]), "left_anti")
    if again:
        first = Window.partitionBy(sha).orderBy(F.desc_nulls_last(f"`{key}`"))
        some = out.join(tied, out[sha] == tied["sha"], "left_semi").withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
        out = out.join(tied, out[sha] == tied["sha"], "left_anti").unionByName(some)
    return out.drop(sha)
