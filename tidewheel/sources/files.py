"""Text, JSON and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; the scan reads nothing else."""
    return spark.read.parquet(path).select(*columns)


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of per-period parts as one table; one schema, no merging of footers."""
    return spark.read.option("mergeSchema", "false").parquet(folder)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with every column as text, so that ids such as 7407.10 stay what they are."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_new_periods(df: DataFrame, path: str, period: str) -> None:
    """Add the periods that are not there yet. Existing periods are skipped before any work is done on
    their rows; a period is either complete or absent, because files appear at the commit."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(period).distinct()
        df = df.join(done, period, "left_anti")
    except Exception as exc:  # no folder yet
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
    writer = df.write.mode("overwrite").partitionBy(period)
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)


def write_report(df: DataFrame, folder: str) -> None:
    """A small result table as JSON and as CSV."""
    df.write.mode("overwrite").json(f"{folder}/json")
    df.write.mode("overwrite").option("header", "true").csv(f"{folder}/csv")


def explode_hourly_payload(payloads: DataFrame, column: str, measures: Sequence[str]) -> DataFrame:
    """JSON of parallel arrays to one row per hour. Arrays of different length stop the job, unreadable
    numbers become null, and of a repeated hour the first entry wins."""
    schema = "hourly struct<time:array<string>," + ",".join(f"{m}:array<string>" for m in measures) + ">"
    parsed = payloads.select(F.from_json(column, schema).alias("p")).select("p.hourly.*")
    sizes = F.array_distinct(F.array(F.size("time"), *[F.size(m) for m in measures]))
    checked = parsed.select(
        F.when(F.size(sizes) == 1, F.arrays_zip("time", *measures))
        .otherwise(F.raise_error(F.lit("the arrays of a payload differ in length")).cast(
            "array<struct<time:string," + ",".join(f"{m}:string" for m in measures) + ">>"))
        .alias("z")
    )
    rows = checked.select(F.posexplode("z").alias("at", "h"))
    rows = rows.select("at", F.col("h.time").cast("timestamp_ntz").alias("weather_hour"),
                       *[F.col(f"h.{m}").try_cast("double").alias(m) for m in measures])
    picked = rows.groupBy("weather_hour").agg(F.min(F.struct("at", *measures)).alias("r"))
    return picked.select("weather_hour", *[F.col(f"r.{m}").alias(m) for m in measures])
