"""Incremental runs: progress by minute, cumulative counters, the one-time check of the mapping rate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import remove, shared_path


def events(spark: SparkSession, path: str, files: int = 64) -> DataFrame:
    """A stream of the event table's files, so many at a time."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/[{name[0]}]{name[1:]}")  # a pattern: one file or a folder of files
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def by_minute(rows: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(start, n, mapped) of 60-second windows; an event is mapped unless it is an error. Rows later than ``late`` may be dropped by a stream that emits closed windows."""
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    counted = rows.groupBy(F.window("ts", "60 seconds").alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") != "error").alias("mapped"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "mapped")


class RateTooLow(Exception):
    """A run was stopped by its rate check."""


def run_to_table(stream: DataFrame, name: str, check: Callable[[DataFrame], bool] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns its last complete result. Each batch writes a table of its own, named by its number, so a batch that is run again writes the same; the one before goes.

    ``check`` is asked after each batch until it says something but None; True stops the run at once with ``RateTooLow``, without the input that is left."""
    spark, path = stream.sparkSession, shared_path(stream.sparkSession, name)
    done: list[int] = []
    asked: list[bool] = []

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch-{batch}")
        for old in done:
            if old != batch:
                remove(spark, f"{path}/batch-{old}")
        done[:] = [batch]
        if check and not asked and (said := check(spark.read.parquet(f"{path}/batch-{batch}"))) is not None:
            asked.append(said)
            if said:
                raise RateTooLow(name)

    query = stream.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(write).start()
    try:
        query.awaitTermination()
    except Exception:
        if asked and asked[0]:
            raise RateTooLow(f"{name}: stopped after batch {done[0]}") from None
        raise
    return spark.read.parquet(f"{path}/batch-{done[-1]}") if done else spark.createDataFrame([], stream.schema)


def low_rate(after: int, cutoff: float) -> Callable[[DataFrame], bool | None]:
    """A check of running totals (reads, mapped): None until ``after`` reads are seen, then whether too few are mapped."""

    def said(totals: DataFrame) -> bool | None:
        row = rate_check(totals, after, cutoff).first()
        return bool(row.abort) if row and row.checked else None

    return said


def windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_table(by_minute(events(spark, f"{sf_dir}/events.parquet")), "minutes")


WINDOWS_SQL = "select date_trunc('minute', ts) start, count(*) n, count_if(event_type <> 'error') mapped from events group by 1"


def rate_check(totals: DataFrame, after: int, cutoff: float) -> DataFrame:
    """(reads, mapped, rate, checked, abort): whether ``after`` reads are reached and too few of them are mapped."""
    rate = F.round(F.try_divide(F.col("mapped"), F.col("reads")), 6)
    return totals.select("reads", "mapped", rate.alias("rate"), (F.col("reads") >= after).alias("checked"), ((F.col("reads") >= after) & (rate < cutoff)).alias("abort"))


def checkpoint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = events(spark, f"{sf_dir}/events.parquet").agg(F.count("*").alias("reads"), F.count_if(F.col("event_type") != "error").alias("mapped"))
    return rate_check(run_to_table(totals, "totals"), 1000, 0.9)


CHECKPOINT_SQL = """select reads, mapped, round(mapped / reads, 6) rate, reads >= 1000 checked, reads >= 1000 and round(mapped / reads, 6) < 0.9 abort from (select count(*) reads, count_if(event_type <> 'error') mapped from events)"""
