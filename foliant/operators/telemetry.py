"""Ledgers, traces and completion reports. events stands in for the trace: a request of stage event_type, asked at ts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import table
from foliant.staging import checked

MILLION = 1_000_000


def usage_totals(ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger totals by keys: distinct runs and sums of the token columns."""
    return ledger.groupBy(*keys).agg(
        F.count_distinct("run").alias("runs"), F.sum("requests").alias("requests"), F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.sum("cached_tokens").alias("cached_tokens"))


def cost(totals: DataFrame, prices: DataFrame) -> DataFrame:
    """Price of each row; cached tokens, never more than the input, at their own price. Models without a price cost null."""
    cached = F.least(F.greatest("cached_tokens", F.lit(0)), F.col("input_tokens"))
    paid = (F.col("input_tokens") - cached) * F.col("in_price") + cached * F.col("cached_price") + F.col("output_tokens") * F.col("out_price")
    return totals.join(checked(prices), "model", "left").withColumn("cost", F.round(paid / MILLION, 6))


def queue_waits(spans: DataFrame, key: str, asked: str, sent: str, answered: str) -> DataFrame:
    """in_flight from sending to answering, with the seconds that requests waited in the queue between asking and sending."""
    waited = spans.groupBy(key).agg(F.sum(F.col(sent) - F.col(asked)).alias("waited_s"), F.max(F.col(sent) - F.col(asked)).alias("longest_wait_s"))
    return in_flight(spans, key, sent, answered).join(waited, key)


def in_flight(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Sweep over (start, end) in seconds per key: requests, service seconds, most and mean in flight.

    Ends come before starts at the same moment. The mean is service time over the time covered.
    """
    edges = spans.select(key, F.col(start).alias("at"), F.lit(1).alias("step")).unionByName(spans.select(key, F.col(end).alias("at"), F.lit(-1).alias("step")))
    # Equal edges are summed first, so the window sorts a row per moment, not per request.
    summed = edges.groupBy(key, "at", "step").agg(F.sum("step").alias("step_sum"))
    now = F.sum("step_sum").over(Window.partitionBy(key).orderBy("at", "step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    most = summed.withColumn("now", now).groupBy(key).agg(F.max("now").alias("most"))
    total = spans.groupBy(key).agg(F.count("*").alias("requests"), F.sum(F.col(end) - F.col(start)).alias("service_s"), (F.max(end) - F.min(start)).alias("covered_s"))
    return total.join(most, key).withColumn("mean", F.round(F.col("service_s") / F.greatest("covered_s", F.lit(1)), 6))


def rank_percentile(rows: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """sorted(values)[min(n - 1, int(n * share))] per key, by counts per value instead of a list of all."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys)
    upto = F.sum("c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("c").over(w)
    place = F.least(total - 1, F.floor(total * F.lit(share)))
    return counts.withColumn("upto", upto).withColumn("place", place).where("upto > place").groupBy(*keys).agg(F.min(value).alias("percentile"))


def prometheus(lines: DataFrame, column: str = "value") -> DataFrame:
    """Samples of the text exposition format: (name, total over all label sets); comments and broken lines are left out."""
    sample = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{[^}]*\})?\s+([-+0-9.eE]+)"
    parsed = lines.select(F.regexp_extract(column, sample, 1).alias("name"), F.regexp_extract(column, sample, 2).try_cast("double").alias("x"))
    return parsed.where((F.col("name") != "") & F.col("x").isNotNull()).groupBy("name").agg(F.sum("x").alias("total"))


def counter_differences(samples: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """What a counter grew by since the sample before; a counter that fell was reset and grew by its value."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(at))
    return samples.withColumn("grown", F.when(before.isNull(), None).when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value)))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("stage"), F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"), (F.col("user_id") % 17).alias("run"), F.lit(1).cast("long").alias("requests"),
        F.floor(F.col("value") * 100).alias("input_tokens"), F.floor(F.col("value") * 10).alias("output_tokens"), F.floor(F.col("value") * 30).alias("cached_tokens"))


LEDGER = """
    WITH l AS (SELECT event_type AS stage, 'm' || (user_id % 3) AS model, user_id % 17 AS run, 1 AS requests,
        CAST(floor(value * 100) AS BIGINT) AS input_tokens, CAST(floor(value * 10) AS BIGINT) AS output_tokens, CAST(floor(value * 30) AS BIGINT) AS cached_tokens FROM events),
    s AS (SELECT stage, model, count(DISTINCT run) AS runs, CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
        CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cached_tokens) AS BIGINT) AS cached_tokens FROM l GROUP BY 1, 2)
"""


@query(LEDGER + "SELECT * FROM s")
def usage_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger totals per stage and model."""
    return usage_totals(_ledger(spark, sf_dir), ["stage", "model"])


@query(LEDGER + """
    , p AS (SELECT * FROM (VALUES ('m0', 1.0, 0.5, 4.0), ('m1', 2.0, 1.0, 8.0)) AS p(model, in_price, cached_price, out_price))
    SELECT stage, s.model, round(((input_tokens - least(greatest(cached_tokens, 0), input_tokens)) * CAST(in_price AS DOUBLE)
        + least(greatest(cached_tokens, 0), input_tokens) * CAST(cached_price AS DOUBLE) + output_tokens * CAST(out_price AS DOUBLE)) / 1000000, 6) AS cost
    FROM s LEFT JOIN p ON s.model = p.model
""")
def usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per stage and model by a price table."""
    prices = spark.createDataFrame([("m0", 1.0, 0.5, 4.0), ("m1", 2.0, 1.0, 8.0)], "model string, in_price double, cached_price double, out_price double")
    return cost(usage_totals(_ledger(spark, sf_dir), ["stage", "model"]), prices).select("stage", "model", "cost")


@query("SELECT count(*) AS n FROM events WHERE props IS NULL")
def unattributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows without a profile."""
    return table(spark, sf_dir, "events").where("props IS NULL").agg(F.count("*").alias("n"))


@query("""
    WITH s AS (SELECT event_type AS stage, epoch_us(ts) // 1000000 AS a, epoch_us(ts) // 1000000 + CAST(floor(value) AS BIGINT) AS b FROM events),
    e AS (SELECT stage, a AS moment, 1 AS step FROM s UNION ALL SELECT stage, b, -1 FROM s),
    r AS (SELECT stage, sum(step) OVER (PARTITION BY stage ORDER BY moment, step ROWS UNBOUNDED PRECEDING) AS now FROM e),
    m AS (SELECT stage, CAST(max(now) AS BIGINT) AS most FROM r GROUP BY 1)
    SELECT stage, count(*) AS requests, CAST(sum(b - a) AS BIGINT) AS service_s, max(b) - min(a) AS covered_s, any_value(most) AS most,
           round(sum(b - a) / greatest(max(b) - min(a), 1), 6) AS mean FROM s JOIN m USING (stage) GROUP BY 1
""")
def at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many requests of a stage were in flight at once."""
    e = table(spark, sf_dir, "events")
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    s = e.select(F.col("event_type").alias("stage"), start.alias("a"), (start + F.floor("value")).alias("b"))
    return in_flight(s, "stage", "a", "b")


@query("""
    WITH s AS (SELECT event_type AS stage, epoch_us(ts) // 1000000 AS q, epoch_us(ts) // 1000000 + user_id % 5 AS a, epoch_us(ts) // 1000000 + user_id % 5 + CAST(floor(value) AS BIGINT) AS b FROM events),
    e AS (SELECT stage, a AS moment, 1 AS step FROM s UNION ALL SELECT stage, b, -1 FROM s),
    r AS (SELECT stage, sum(step) OVER (PARTITION BY stage ORDER BY moment, step ROWS UNBOUNDED PRECEDING) AS now FROM e),
    m AS (SELECT stage, CAST(max(now) AS BIGINT) AS most FROM r GROUP BY 1)
    SELECT stage, count(*) AS requests, CAST(sum(b - a) AS BIGINT) AS service_s, any_value(most) AS most, CAST(sum(a - q) AS BIGINT) AS waited_s, max(a - q) AS longest_wait_s FROM s JOIN m USING (stage) GROUP BY 1
""")
def queue_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long the requests of a stage waited before they were sent."""
    e = table(spark, sf_dir, "events")
    asked = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    sent = asked + F.col("user_id") % 5
    s = e.select(F.col("event_type").alias("stage"), asked.alias("q"), sent.alias("a"), (sent + F.floor("value")).alias("b"))
    return queue_waits(s, "stage", "q", "a", "b").select("stage", "requests", "service_s", "most", "waited_s", "longest_wait_s")


@query("""
    SELECT event_type AS stage, list_sort(list(value))[CAST(least(count(*) - 1, floor(count(*) * 0.9)) AS BIGINT) + 1] AS percentile FROM events GROUP BY 1
""")
def percentile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 90th percentile of a measure by rank."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), "value")
    return rank_percentile(e, ["stage"], "value", 0.9)


@query("""
    SELECT o_custkey AS document, count(*) FILTER (o_orderstatus = 'O') > 0 AS opened, count(*) FILTER (o_orderstatus = 'F') > 0 AS finished,
           count(*) FILTER (o_orderstatus = 'P') > 0 AS partly, count(*) AS n FROM orders GROUP BY 1
""")
def stage_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stages each document has been through."""
    s = F.col("o_orderstatus")
    has = lambda v: F.count_if(s == v) > 0
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("document")).agg(has("O").alias("opened"), has("F").alias("finished"), has("P").alias("partly"), F.count("*").alias("n"))


@query("""
    SELECT user_id AS document, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type IN ('view', 'click')) AS asked,
           round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS served, count(DISTINCT event_type) AS kinds,
           count(*) FILTER (CAST(json_extract_string(props, '$.k') AS BIGINT) > 50) AS late FROM events GROUP BY 1
""")
def trace_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over the kinds of trace events, in one pass."""
    t = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("document")).agg(
        F.count("*").alias("events"), F.count_if(t == "error").alias("errors"), F.count_if(t.isin("view", "click")).alias("asked"),
        F.round(F.sum(F.when(t == "purchase", F.col("value")).otherwise(0.0)), 4).alias("served"), F.count_distinct("event_type").alias("kinds"),
        F.count_if(F.get_json_object("props", "$.k").cast("long") > 50).alias("late"))


@query("""
    WITH a AS (SELECT event_type AS stage, avg(value) AS mean FROM events GROUP BY 1),
    w AS (SELECT event_type AS stage, count(*) FILTER (user_id % 4 = 0) AS open FROM events GROUP BY 1)
    SELECT stage, open, round(open * mean, 4) AS tokens FROM w JOIN a USING (stage)
""")
def estimate_work_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open requests times what one took on average so far."""
    g = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count_if(F.col("user_id") % 4 == 0).alias("open"), F.avg("value").alias("mean"))
    return g.select("stage", "open", F.round(F.col("open") * F.col("mean"), 4).alias("tokens"))


@query("""
    SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
           lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE event_type <> 'error'
""")
def requests_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of each trace in order, with the kind of the one before."""
    e = table(spark, sf_dir, "events").where("event_type <> 'error'")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select("user_id", "event_id", "event_type", F.row_number().over(w).alias("n"), F.lag("event_type").over(w).alias("before"))


@query("""
    WITH s AS (SELECT user_id, ts, event_id, CAST(floor(value * 10) AS BIGINT) AS v FROM events),
    d AS (SELECT user_id, event_id, v, lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM s)
    SELECT user_id, event_id, CASE WHEN b IS NULL THEN NULL WHEN v >= b THEN v - b ELSE v END AS grown FROM d
""")
def counter_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a counter grew by between samples."""
    e = table(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("at"), "event_id", F.floor(F.col("value") * 10).alias("v"))
    return counter_differences(e, "user_id", "at", "v").select("user_id", "event_id", "grown")


def spread(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Least, median, 90th percentile (by rank) and largest of a measure."""
    ends = rows.groupBy(*keys).agg(F.min(value).alias("least"), F.max(value).alias("most"))
    for name, share in (("median", 0.5), ("p90", 0.9)):
        ends = ends.join(rank_percentile(rows, keys, value, share).withColumnRenamed("percentile", name), keys)
    return ends


@query("""
    SELECT event_type AS stage, min(value) AS least, max(value) AS most,
           list_sort(list(value))[CAST(least(count(*) - 1, floor(count(*) * 0.5)) AS BIGINT) + 1] AS median,
           list_sort(list(value))[CAST(least(count(*) - 1, floor(count(*) * 0.9)) AS BIGINT) + 1] AS p90 FROM events GROUP BY 1
""")
def trace_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spread of a trace measure per stage."""
    return spread(table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), "value"), ["stage"], "value")


def seconds_of(ts: Column) -> Column:
    """Whole seconds since the epoch."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1_000_000)
