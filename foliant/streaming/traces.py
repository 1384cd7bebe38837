"""The trace as a stream: windowed counts with a watermark, and the limit controller as custom state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foliant.registry import query
from foliant.session import ship_package, table

# Fixed values of the limit controller.
SHRINK, FLOOR, GROW, CAP, START, KV_HIGH, KV_LOW = 0.8, 16, 8, 512, 64, 0.92, 0.80


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Requests and seconds per stage and window; batch and stream alike. Events later than the watermark are dropped."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if e.isStreaming else e
    g = e.groupBy(F.window("ts", width), F.col("event_type").alias("stage")).agg(F.count("*").alias("requests"), F.round(F.sum("value"), 4).alias("seconds"))
    return g.select(F.unix_micros("window.start").alias("start"), "stage", "requests", "seconds")


def decide(limit: int, preempted: bool, kv: float, waiting: int, used: int) -> int:
    """The next limit: down by a fifth under pressure, up by a step if nothing waits and the limit was really used."""
    if preempted or kv >= KV_HIGH or waiting > 0:
        return max(FLOOR, int(limit * SHRINK))
    if kv < KV_LOW and used >= limit:
        return min(CAP, limit + GROW)
    return limit


def limits(samples: DataFrame) -> DataFrame:
    """(host, at, limit) of a stream of samples (host, at, preempted, kv, waiting, used), the limit kept as state.

    A host's samples of one trigger are taken in order of time, whatever batches they arrive in; they are as many as the
    source's bound on a trigger lets in.
    """
    ship_package(samples.sparkSession)

    def step(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        limit = state.get[0] if state.exists else START
        out = []
        for r in pd.concat(list(parts), ignore_index=True).sort_values("at", kind="stable").itertuples(index=False):
            limit = decide(limit, bool(r.preempted), float(r.kv), int(r.waiting), int(r.used))
            out.append((key[0], r.at, limit))
        state.update((limit,))
        yield pd.DataFrame(out, columns=["host", "at", "limit"])

    return samples.groupBy("host").applyInPandasWithState(step, "host string, at long, limit int", "limit int", "append", GroupStateTimeout.NoTimeout)


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """A bounded stream run until its input is used up, its result in a Parquet table at path.

    Appended rows are added batch by batch under a folder of the batch's number, so a repeated batch replaces itself; a
    complete result replaces the one before.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}" if mode == "append" else path)

    q = df.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("""
    SELECT (epoch_us(ts) // 3600000000) * 3600000000 AS start, event_type AS stage, count(*) AS requests, round(sum(value), 4) AS seconds FROM events GROUP BY 1, 2
""")
def windowed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per hour and stage; the same function serves the stream."""
    return windowed(table(spark, sf_dir, "events"))
