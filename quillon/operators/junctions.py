"""Splice junctions: collapse, filters, two-stage reads, annotated sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds by motif class (0 non-canonical, 1 GT/AG, 2 GC/AG, 3 AT/AC).
UNIQUE_MIN, TOTAL_MIN, OVERHANG_MIN, DISTANCE_MIN, INTRON_MAX = (3, 1, 1, 1), (3, 1, 1, 1), (30, 12, 12, 12), (10, 0, 5, 10), (50000, 100000, 200000)


def emit(observed: DataFrame, read: Sequence[str]) -> DataFrame:
    """A junction seen at several loci of a read counts once, with its largest overhang."""
    return observed.groupBy(*read, "start", "gap").agg(*[F.max(c).alias(c) for c in ("motif", "annot", "nh", "overhang")])


def collapse(observed: DataFrame) -> DataFrame:
    """(start, gap, motif, annot, uniq, multi, overhang); a junction whose rows disagree on motif or annotation raises."""
    out = observed.groupBy("start", "gap").agg(
        F.min("motif").alias("motif"), F.max("motif").alias("_m"), F.min("annot").alias("annot"), F.max("annot").alias("_a"), F.count_if(F.col("nh") == 1).alias("uniq"), F.count_if(F.col("nh") > 1).alias("multi"), F.max("overhang").alias("overhang")
    )
    bad = (F.col("motif") != F.col("_m")) | (F.col("annot") != F.col("_a"))
    return out.withColumn("motif", F.when(bad, F.raise_error(F.lit("a junction's motif or annotation differs between reads")).cast("int")).otherwise(F.col("motif"))).drop("_m", "_a")


def _by(values: Sequence[int], klass: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), klass + 1)


def keep_supported(junctions: DataFrame, unique=UNIQUE_MIN, total=TOTAL_MIN, overhang=OVERHANG_MIN, intron=INTRON_MAX) -> DataFrame:
    """Annotated junctions, and those with enough reads, overhang and a gap that so few reads may span; a threshold of -1 is never met."""
    k = F.expr("(motif + 1) div 2").cast("int")
    n = F.col("uniq") + F.col("multi")
    meets = lambda v, by: (_by(by, k) >= 0) & (v >= _by(by, k))
    wide = F.when(n > len(intron), True).otherwise(F.col("gap") <= F.element_at(F.array(*[F.lit(v) for v in intron]), F.greatest(n, F.lit(1)).cast("int")))
    return junctions.where((F.col("annot") == 1) | ((meets(F.col("uniq"), unique) | meets(n, total)) & (F.col("overhang") >= _by(overhang, k)) & wide))


def keep_distant(junctions: DataFrame, distance=DISTANCE_MIN, tile: int = 1 << 24) -> DataFrame:
    """Annotated junctions, and those whose donor and acceptor are at least the motif's distance from any other's. The first donor's left neighbour is coordinate 0.

    Neighbours are looked for in tiles of the genome: a site goes to its tile and, within the largest distance of an edge, to the next, so no window holds all junctions."""
    reach = max(distance)
    k = F.expr("(motif + 1) div 2").cast("int")

    def near(rows: DataFrame, site: Column, name: str) -> DataFrame:
        at = rows.select("start", "gap", site.alias("p"))
        tiles = F.explode(F.sequence(F.floor((F.col("p") - reach) / tile), F.floor((F.col("p") + reach) / tile)))
        w = Window.partitionBy("t").orderBy("p")
        left, right = F.col("p") - F.lag("p").over(w), F.lead("p").over(w) - F.col("p")
        found = at.withColumn("t", tiles).withColumns({"l": F.coalesce(left, F.lit(1 << 62)), "r": F.coalesce(right, F.lit(1 << 62))})
        return found.where(F.col("t") == F.floor(F.col("p") / tile)).select("start", "gap", F.least("l", "r", "p").alias(name))

    out = junctions.join(near(junctions, F.col("start"), "_d"), ["start", "gap"]).join(near(junctions, F.col("start") + F.col("gap"), "_a"), ["start", "gap"])
    return out.where((F.col("annot") == 1) | ((F.col("_d") >= _by(distance, k)) & (F.col("_a") >= _by(distance, k)))).drop("_d", "_a")


def keep_by_junctions(reads: DataFrame, observed: DataFrame, kept: DataFrame, key: Sequence[str]) -> DataFrame:
    """Reads all of whose junctions are in ``kept``; reads without junctions stay."""
    lost = observed.join(kept.select("start", "gap"), ["start", "gap"], "left_anti").select(*key).distinct()
    return reads.join(lost, list(key), "left_anti")


def from_exons(exons: DataFrame, transcript: str = "tr", gene: str = "gene", start: str = "es", end: str = "ee") -> DataFrame:
    """(start, end, genes): gaps between consecutive exons of a transcript; exons that touch or overlap make none. A junction's genes are a set."""
    w = Window.partitionBy(transcript).orderBy(start, end)
    rows = exons.withColumn("_p", F.lag(end).over(w)).where(F.col(start) > F.col("_p") + 1)
    return rows.select((F.col("_p") + 1).alias("start"), (F.col(start) - 1).alias("end"), F.col(gene).alias("g")).groupBy("start", "end").agg(F.sort_array(F.collect_set("g")).alias("genes"))


def dedupe(junctions: DataFrame) -> DataFrame:
    """One row for each (chr, start, end): on a strand the highest priority, then canonical, then the smaller left shift; between strands priority, then a defined strand, then, if neither is canonical, strand 0, else the strand that the motif says (odd: 1, even: 2)."""
    canon = (F.col("motif") > 0).cast("int")
    w = Window.partitionBy("chr", "start", "end", "strand").orderBy(F.desc("priority"), F.desc(canon), "shift_left", "motif")
    one = junctions.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    agrees = F.when(F.col("motif") == 0, 0).when(F.col("strand") == 2 - F.col("motif") % 2, 1).otherwise(0)
    both = Window.partitionBy("chr", "start", "end")
    ranked = one.withColumn("_r", F.row_number().over(both.orderBy(F.desc("priority"), F.desc((F.col("strand") > 0).cast("int")), F.desc(agrees), F.desc(canon), "shift_left", "strand")))
    top = F.max("priority").over(both)
    tie = F.sum(F.when(F.col("priority") == top, F.when(F.col("strand") > 0, 1).otherwise(0)).otherwise(0)).over(both) > 1
    any_canon = F.max(F.when(F.col("priority") == top, canon).otherwise(0)).over(both) > 0
    ranked = ranked.withColumns({"_tie": tie, "_any": any_canon})
    return ranked.where("_r = 1").withColumn("strand", F.when(F.col("_tie") & ~F.col("_any"), 0).otherwise(F.col("strand"))).drop("_r", "_tie", "_any")


def pass_one(found: DataFrame, known: DataFrame) -> DataFrame:
    """Junctions of a first pass that the index lacks."""
    return found.join(known.select("start", "gap"), ["start", "gap"], "left_anti")
