"""Single-cell tags: barcode resolution, tag collapse, matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seq
from .intervals import numbered


def bad_tag(umi: Column, has_n: Column, length: int) -> Column:
    """A tag with an unknown base or of one letter only."""
    same = [sum(c << (2 * i) for i in range(length)) for c in range(4)]
    return has_n | umi.isin(*same)


def whitelist(cells: DataFrame, length: int) -> DataFrame:
    """Distinct cell barcodes; one of another length raises."""
    checked = F.when(F.length("cb") != length, F.raise_error(F.lit("a whitelist barcode has another length")).cast("string")).otherwise(F.col("cb"))
    return cells.select(checked.alias("cb")).distinct()


def resolve(candidates: DataFrame, exact: DataFrame, share: float = 0.975) -> DataFrame:
    """(read, cb): reads by their candidate barcodes. An exact one wins. A single near one counts if some read has it exactly. Of several, each weighs n * 10 ** (-q / 10), q at most 33, and the heaviest is taken if it has ``share`` of the sum.

    ``candidates``: read, cb, d (0 or 1), q; ``exact``: cb, n."""
    c = candidates.join(exact, "cb", "left").withColumn("w", F.coalesce("n", F.lit(0)) * F.pow(F.lit(10.0), -F.least("q", F.lit(33)) / 10.0))
    per = c.groupBy("read").agg(F.min(F.when(F.col("d") == 0, F.col("cb"))).alias("own"), F.count("*").alias("k"), F.sum("w").alias("total"), F.max(F.struct("w", (-F.col("cb")).alias("m"))).alias("best"))
    heaviest = F.col("best.w")
    near = F.when((F.col("k") == 1) & (heaviest > 0), -F.col("best.m")).when((F.col("k") > 1) & (heaviest > 0) & (heaviest >= share * F.col("total")), -F.col("best.m"))
    return per.select("read", F.coalesce("own", near).alias("cb")).where("cb is not null")


def tag_pairs(tags: DataFrame, length: int, by: list[str]) -> DataFrame:
    """(by, a, b): tags of one group that differ in one base. Each tag is indexed by its two halves, one of which such a pair shares, so a group isn't joined with itself."""
    low = length // 2
    part = lambda c: F.array(c.bitwiseAND(F.lit((1 << (2 * low)) - 1)), F.shiftrightunsigned(c, 2 * low))
    t = tags.select(*by, "umi").distinct().select(*by, "umi", F.posexplode(part(F.col("umi"))).alias("half", "key"))
    a, b = t.withColumnRenamed("umi", "a"), t.withColumnRenamed("umi", "b")
    return a.join(b, [*by, "half", "key"]).where(seq.distance(F.col("a"), F.col("b")) == 1).select(*by, "a", "b")


def collapse_all(tags: DataFrame, length: int, by: list[str]) -> DataFrame:
    """(by, n_tags, n_components): distinct tags of each group, and connected components of tags one base apart.

    Only tags with neighbours travel, as edges; a group's task spreads the least label over its edges and along labels until nothing changes, and returns how many tags were joined to others."""
    one = tags.select(*by, "umi").distinct()
    edges = tag_pairs(tags, length, by).where("a < b")
    schema = ", ".join([*(f"{c} {tags.schema[c].dataType.simpleString()}" for c in by), "joined long"])

    def run(t: pa.Table) -> pa.Table:
        a, b = (t.column(c).combine_chunks().to_numpy() for c in "ab")
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        u, v, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
        while True:
            low, new = np.minimum(root[u], root[v]), root.copy()
            for x in (u, v, root[u], root[v]):
                np.minimum.at(new, x, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pa.table([*(t.column(c).slice(0, 1) for c in by), pa.array([len(ids) - len(np.unique(root))])], names=[*by, "joined"])

    joined = edges.groupBy(*by).applyInArrow(run, schema)
    out = one.groupBy(*by).agg(F.count("*").alias("n_tags")).join(joined, by, "left")
    return out.select(*by, "n_tags", (F.col("n_tags") - F.coalesce("joined", F.lit(0))).alias("n_components"))


def collapse_directional(records: DataFrame, length: int, by: list[str]) -> DataFrame:
    """(by, n_kept): tags that no neighbour of one base dominates; n dominates m if n > 2 * m - 1."""
    counts = records.groupBy(*by, "umi").agg(F.count("*").alias("n"))
    pairs = tag_pairs(counts, length, by)
    n = lambda k: counts.select(*by, F.col("umi").alias(k), F.col("n").alias(f"n{k}"))
    lost = pairs.join(n("a"), [*by, "a"]).join(n("b"), [*by, "b"]).where("nb > 2 * na - 1").select(*by, F.col("a").alias("umi")).distinct()
    return counts.join(lost, [*by, "umi"], "left_anti").groupBy(*by).agg(F.count("*").alias("n_kept"))


def matrix(records: DataFrame) -> DataFrame:
    """(row, col, n) of a feature-by-cell matrix of distinct tags; rows and columns are numbered from 1 in the order of features and cells, by ranges, so that no task orders all cells."""
    counts = records.groupBy("feature", "cb").agg(F.count_distinct("umi").alias("n"))
    number = lambda c, name: numbered(counts.select(c).distinct(), [c], name)
    return counts.join(number("feature", "row"), "feature").join(number("cb", "col"), "cb").select("row", "col", "feature", "cb", "n")


def stats(records: DataFrame) -> DataFrame:
    """One row of a matrix's totals: cells, reads, distinct tags, features, the most and the median of a cell's tags, the median of its features, and the share of reads that repeat a tag."""
    per = records.groupBy("cb").agg(F.count("*").alias("reads"), F.count_distinct("feature").alias("features"), F.count_distinct("feature", "umi").alias("tags"))
    middle = lambda c: F.expr(f"cast(percentile_disc(0.5) within group (order by {c}) as bigint)")
    out = per.agg(F.count("*").alias("cells"), F.sum("reads").alias("reads"), F.sum("tags").alias("tags"), F.max("tags").alias("most_tags"), middle("tags").alias("median_tags"), middle("features").alias("median_features"), F.round(1 - F.sum("tags") / F.sum("reads"), 6).alias("saturation"))
    return out.crossJoin(records.agg(F.count_distinct("feature").alias("features")))  # one row each


def assign_features(reads: DataFrame) -> DataFrame:
    """Counts by reason of a read's genes array: unmapped, no_feature, ambiguous, multi, else counted."""
    n = F.size("genes")
    reason = F.when(F.col("nh") == 0, "unmapped").when(F.col("nh") > 1, "multi").when(n == 0, "no_feature").when(n > 1, "ambiguous").otherwise("counted")
    return reads.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
