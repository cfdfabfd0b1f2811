"""Joins of intervals by bins, as-of joins, islands and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_path


def overlap_join(a: DataFrame, b: DataFrame, group: list[str], width: int, a_span: tuple[str, str] = ("a_start", "a_end"), b_span: tuple[str, str] = ("b_start", "b_end")) -> DataFrame:
    """All pairs of one group whose closed intervals meet, each once: both sides go to the bins they touch, a pair is kept in the later of its first bins. Column names other than ``group`` must differ. A hot bin is an equi-join key, so AQE can split it."""
    cut = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    left = a.where(F.col(a_span[0]) <= F.col(a_span[1])).withColumn("_bin", cut(*a_span))
    right = b.where(F.col(b_span[0]) <= F.col(b_span[1])).withColumn("_bin", cut(*b_span))
    first = F.greatest(F.floor(F.col(a_span[0]) / width), F.floor(F.col(b_span[0]) / width))
    return left.join(right, [*group, "_bin"]).where((F.col("_bin") == first) & (F.col(a_span[0]) <= F.col(b_span[1])) & (F.col(b_span[0]) <= F.col(a_span[1]))).drop("_bin")


def floor_join(queries: DataFrame, blocks: DataFrame, group: list[str], at: str, start: str, fields: list[str], width: int) -> DataFrame:
    """Each query with ``before`` and ``after``: the fields of the last block that starts at or before ``at``, and of the first that starts after it (null where there is none).

    Both sides are cut into bins of ``width``; a bin carries over the last block before it and the first after it, found over the few bins that hold a block, so the window over rows is one bin's and a group of any size spreads over tasks."""
    one = F.struct(*[F.col(f).alias(f) for f in fields])
    cells = blocks.select(*group, F.floor(F.col(start) / width).alias("_bin"), F.col(start).alias("_s"), one.alias("_b"))
    q = queries.withColumns({"_bin": F.floor(F.col(at) / width), "_s": F.col(at)})
    per = cells.groupBy(*group, "_bin").agg(F.max_by("_b", "_s").alias("_last"), F.min_by("_b", "_s").alias("_first"))
    named = q.select(*group, "_bin").distinct().join(per, [*group, "_bin"], "full")
    w = Window.partitionBy(*group).orderBy("_bin")
    ends = named.withColumns({"_prev": F.last("_last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "_next": F.first("_first", True).over(w.rowsBetween(1, Window.unboundedFollowing))}).select(*group, "_bin", "_prev", "_next")
    inside = cells.groupBy(*group, "_bin").agg(F.sort_array(F.collect_list(F.struct("_s", "_b"))).alias("_in"))
    out = q.join(ends, [*group, "_bin"], "left").join(inside, [*group, "_bin"], "left")
    low = F.filter("_in", lambda z: z._s <= F.col("_s"))
    high = F.filter("_in", lambda z: z._s > F.col("_s"))
    out = out.withColumns({"before": F.coalesce(F.get(low, F.size(low) - 1)["_b"], F.col("_prev")), "after": F.coalesce(F.get(high, F.lit(0))["_b"], F.col("_next"))})
    return out.drop("_bin", "_s", "_prev", "_next", "_in")


def islands(rows: DataFrame, group: list[str], start: str, end: str, gap: int) -> DataFrame:
    """``rows`` with ``island``: numbered from 0 in their group, a new one where a row starts over ``gap`` beyond all ends before it."""
    w = Window.partitionBy(*group).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = rows.withColumn("_new", (F.coalesce(F.col(start) - reach > gap, F.lit(False))).cast("int"))
    return out.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def coverage(events: DataFrame, group: list[str], start: str, end: str, weight: Column, tile: int = 1 << 20) -> DataFrame:
    """(group, start, end, value): runs [start, end) of equal coverage that isn't 0, by a sweep over summed +weight and -weight, never base by base.

    Intervals are cut at tile bounds, so the running sum's windows are a tile of a chromosome and no total is carried between tasks; runs that meet at a tile's edge are joined afterwards over the runs next to an edge only."""
    cut = events.select(*group, F.col(start).alias("s"), F.col(end).alias("e"), weight.alias("w")).where("s < e")
    cut = cut.withColumn("t", F.explode(F.sequence(F.floor(F.col("s") / tile), F.floor((F.col("e") - 1) / tile))))
    cut = cut.withColumns({"s": F.greatest("s", F.col("t") * tile), "e": F.least("e", (F.col("t") + 1) * tile)})
    steps = cut.select(*group, "t", F.explode(F.array(F.struct(F.col("s").alias("p"), F.col("w").alias("d")), F.struct(F.col("e").alias("p"), (-F.col("w")).alias("d")))).alias("x"))
    steps = steps.groupBy(*group, "t", F.col("x.p").alias("p")).agg(F.sum("x.d").alias("d")).where("d <> 0")
    w = Window.partitionBy(*group, "t").orderBy("p")
    runs = steps.select(*group, "t", F.col("p").alias("start"), F.lead("p").over(w).alias("end"), F.sum("d").over(w).alias("value")).where("value <> 0 and end is not null")
    edge = (F.col("start") == F.col("t") * tile) | (F.col("end") == (F.col("t") + 1) * tile)
    inner = runs.where(~edge).select(*group, "start", "end", "value")
    v = Window.partitionBy(*group).orderBy("start")
    met = runs.where(edge).withColumn("new", F.coalesce((F.lag("end").over(v) != F.col("start")) | (F.lag("value").over(v) != F.col("value")), F.lit(True)).cast("int"))
    met = met.withColumn("run", F.sum("new").over(v)).groupBy(*group, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("value").alias("value"))
    return inner.unionByName(met.select(*group, "start", "end", "value"))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their number from 1 in the order of columns that name them: sorted by ranges into a table in the shared folder (the ranges' bounds are drawn anew in each run), then counted by range, so that no task orders all rows."""
    spark = rows.sparkSession
    path = shared_path(spark, "numbered")
    rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    sizes = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return held.withColumn("_i", inside).join(F.broadcast(before), "_part").select(*rows.columns, (F.col("_before") + F.col("_i")).cast("int").alias(name))
