"""Writers: CSV guarded against formulas, JSON lines per document, Turtle text, ledgers by append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import guard_formula
from foliant.operators.graph import triples_of, turtle
from foliant.operators.values import HARVEST, harvest
from foliant.registry import query


def flat_rows(values: DataFrame, keep: list[str], coordinates: str, names: list[str]) -> DataFrame:
    """Map columns as one column per name of a list that is known in advance."""
    return values.select(*keep, *[F.try_element_at(F.col(coordinates), F.lit(n)).alias(n) for n in names])


def guarded(df: DataFrame) -> DataFrame:
    """Text cells that a spreadsheet would run are quoted."""
    return df.withColumns({c: guard_formula(F.col(c)) for c, t in df.dtypes if t == "string"})


def to_csv(df: DataFrame, path: str) -> None:
    guarded(df).write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)


def to_jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines; with `by` a folder per value, which readers prune."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def to_turtle(triples: DataFrame, path: str) -> None:
    turtle(triples).orderBy("s").select("block").write.mode("overwrite").option("lineSep", "\n\n").text(path)


def provenance(rows: DataFrame, subject: Column, base: str, source: Column, run: Column, quote: Column) -> DataFrame:
    """The provenance graph beside the value graph: per value the passage that it was derived from, the run that made it, and
    the passage's quote."""
    entity = F.concat(F.lit(base), subject.cast("string"))
    return triples_of(rows, entity, {"wasDerivedFrom": F.concat(F.lit(base + "source/"), source.cast("string")), "wasGeneratedBy": F.concat(F.lit(base + "run/"), run.cast("string")), "value": quote})


def log_requests(requests: DataFrame, path: str) -> None:
    """Request log rows appended under the day they were asked (column asked_at); the answer is kept as its digest."""
    rows = requests.withColumn("day", F.to_date("asked_at"))
    if "answer" in rows.columns:
        rows = rows.withColumn("answer_hash", F.sha2(F.coalesce("answer", F.lit("")), 256)).drop("answer")
    rows.write.mode("append").partitionBy("day").parquet(path)


def _paths(spark: SparkSession, *names: str):
    paths = [spark._jvm.org.apache.hadoop.fs.Path(n) for n in names]
    return paths[0].getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), paths


def swap(df: DataFrame, path: str, archive: str | None = None) -> DataFrame:
    """A table written whole beside its place and then put there; the one that it replaces goes to the archive, or away.

    Readers see the old table or the new one. df may read the old table.
    """
    spark = df.sparkSession
    fresh, old = path.rstrip("/") + ".new", path.rstrip("/") + ".old"
    df.write.mode("overwrite").parquet(fresh)
    files, (place, new, before) = _paths(spark, path, fresh, old)
    if files.exists(place):
        target = before if archive is None else _paths(spark, archive)[1][0]
        if archive is not None and files.exists(target):
            raise ValueError(f"{archive} is there already")
        files.mkdirs(target.getParent())
        files.rename(place, target)
    files.rename(new, place)
    files.delete(before, True)
    return spark.read.schema(df.schema).parquet(path)


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


@query(HARVEST + """SELECT document, pos, parameter, status, CAST(year AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS place FROM h""")
def export_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as flat rows with a column per coordinate."""
    h = harvest(spark, sf_dir)
    m = h.withColumn("coordinates", F.create_map(F.lit("status"), F.col("status"), F.lit("year"), F.col("year").cast("string")))
    return guarded(flat_rows(m, ["document", "pos", "parameter"], "coordinates", ["status", "year", "place"]))


@query(HARVEST + """SELECT document, count(*) AS lines, min('{"parameter":"' || parameter || '","year":' || year || '}') AS first FROM h GROUP BY 1""")
def export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as JSON lines, counted per document."""
    h = harvest(spark, sf_dir).select("document", as_json("parameter", "year").alias("line"))
    return h.groupBy("document").agg(F.count("*").alias("lines"), F.min("line").alias("first"))


@query(HARVEST + """
    , t AS (SELECT 'p/' || document || '.' || pos AS s, document, pos, status, parameter FROM h)
    SELECT s, 'wasDerivedFrom' AS p, 'p/source/' || document AS o FROM t UNION ALL SELECT s, 'wasGeneratedBy', 'p/run/' || parameter FROM t UNION ALL SELECT s, 'value', status FROM t WHERE status = 'F'
""")
def provenance_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each value comes from, as triples."""
    h = harvest(spark, sf_dir)
    return provenance(h, F.concat_ws(".", "document", "pos"), "p/", F.col("document"), F.col("parameter"), F.when(F.col("status") == "F", F.col("status")))
