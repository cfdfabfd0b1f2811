"""After alignment: choice of loci, filters, flags, order, seeds and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import islands


def select_loci(loci: DataFrame, read: list[str], score_range: int = 1, most: int = 10, order: list[str] = ("chr", "pos"), seed: int | None = None) -> DataFrame:
    """Loci within ``score_range`` of their read's best, with nh, hi (from 1) and primary (the first of the best); reads of over ``most`` such loci are dropped. ``seed``: the order among equal scores is that of a seeded hash."""
    w = Window.partitionBy(*read)
    near = loci.withColumn("_max", F.max("score").over(w)).where(F.col("score") >= F.col("_max") - score_range)
    near = near.withColumn("nh", F.count("*").over(w)).where(F.col("nh") <= most)
    ties = [F.xxhash64(F.lit(seed), *order)] if seed is not None else []
    ranked = near.withColumn("hi", F.row_number().over(w.orderBy(F.desc("score"), *ties, *order)))
    return ranked.withColumn("primary", F.col("hi") == 1).drop("_max")


def unmapped_reason(n: Column, score: Column, matched: Column, mismatches: Column, length: Column, most: int = 10, score_min: float = 0.66, match_min: float = 0.66, mismatch_max: int = 10, mismatch_share: float = 0.3) -> Column:
    """other, short, mismatch, multi in that order; null for mapped reads."""
    allowed = F.least(F.lit(mismatch_max), F.floor(length * mismatch_share))
    return F.when(n == 0, "other").when((score < F.floor((length - 1) * score_min)) | (matched < F.floor((length - 1) * match_min)), "short").when(mismatches > allowed, "mismatch").when(n > most, "multi")


def flag(paired: Column, proper: Column, unmapped: Column, mate_unmapped: Column, reverse: Column, mate_reverse: Column, first: Column, primary: Column, duplicate: Column) -> Column:
    bits = [(paired, 1), (paired & proper, 2), (unmapped, 4), (paired & mate_unmapped, 8), (reverse, 16), (paired & mate_reverse, 32), (paired & first, 64), (paired & ~first, 128), (~primary, 256), (duplicate, 1024)]
    out = F.lit(0)
    for cond, value in bits:
        out = out + F.when(cond, value).otherwise(0)
    return out


def mapq(nh: Column, unique: int = 255) -> Column:
    return F.when(nh == 1, unique).when(nh == 2, 3).when(nh <= 4, 1).otherwise(0)


def cigar(blocks: Column, left_clip: Column, right_clip: Column) -> Column:
    """CIGAR of blocks (r: read start, g: genome start, len): a step in both is a gap N of the genome's surplus, one in the read alone an insertion, a deletion if ``del`` is set."""
    rest = F.transform(F.sequence(F.lit(1), F.size(blocks) - 1), lambda i: F.struct(F.get(blocks, i - 1).alias("p"), F.get(blocks, i).alias("q")))
    body = F.transform(rest, lambda s: F.concat(
        F.when(s.q.r - s.p.r - s.p.len > 0, F.concat((s.q.r - s.p.r - s.p.len).cast("string"), F.lit("I"))).otherwise(""),
        F.when(s.q.g - s.p.g - s.p.len > 0, F.concat((s.q.g - s.p.g - s.p.len).cast("string"), F.lit("N"))).otherwise(""), s.q.len.cast("string"), F.lit("M")))
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    return F.concat(clip(left_clip), F.get(blocks, F.lit(0)).len.cast("string"), F.lit("M"), F.when(F.size(blocks) > 1, F.array_join(body, "")).otherwise(""), clip(right_clip))


def template_length(start: Column, end: Column, mate_start: Column, mate_end: Column) -> Column:
    """Signed span of a pair on one reference: plus for the leftmost mate."""
    span = F.greatest(end, mate_end) - F.least(start, mate_start) + 1
    return F.when(start <= mate_start, span).otherwise(-span)


def coordinate_sort(rows: DataFrame, order: list[str]) -> DataFrame:
    """Mapped rows by place, unmapped (null place) last: a range exchange by sampled bounds and a sort in each range."""
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order])


def seed_top(seeds: DataFrame, window: list[str], k: int = 50) -> DataFrame:
    """The k seeds of each window that anchors and longer ones come first in; windows with over k anchors are dropped whole."""
    w = Window.partitionBy(*window)
    out = seeds.withColumn("_r", F.row_number().over(w.orderBy(F.desc("anchor"), F.desc("length"), "r_start", "g_start"))).withColumn("_a", F.count_if(F.col("anchor")).over(w))
    return out.where((F.col("_r") <= k) & (F.col("_a") <= k)).drop("_r", "_a")


def windows(anchors: DataFrame, group: list[str], at: str, bins: int = 16, reach: int = 9, flank: int = 4, last: Column | None = None) -> DataFrame:
    """(group, island, first_bin, last_bin, anchors): anchors' bins of 2^bins bases, joined within ``reach`` bins, widened by ``flank`` inside the chromosome, whose last bin may be given by the groups' columns. Which anchors meet doesn't depend on their order; a group is a read's strand and chromosome."""
    binned = anchors.withColumn("_b", F.floor(F.col(at) / (1 << bins)))
    joined = islands(binned.withColumn("_e", F.col("_b")), group, "_b", "_e", reach)
    out = joined.groupBy(*group, "island").agg(F.min("_b").alias("first_bin"), F.max("_b").alias("last_bin"), F.count("*").alias("anchors"))
    end = F.col("last_bin") + flank
    return out.withColumns({"first_bin": F.greatest(F.col("first_bin") - flank, F.lit(0)), "last_bin": end if last is None else F.least(end, last)})


def drop_dominated(rows: DataFrame, window: list[str], key: str, blocks: str, score: str) -> DataFrame:
    """Alignments no other of their window dominates: one whose blocks hold all of theirs with a higher score, or the same blocks, score and a smaller key. Meeting is by a window's alignments that share a block."""
    each = rows.select(*window, key, score, F.size(blocks).alias("size"), F.explode(blocks).alias("block"))
    a = each.select(*window, F.col(key).alias("a"), F.col(score).alias("sa"), F.col("size").alias("na"), "block")
    b = each.select(*window, F.col(key).alias("b"), F.col(score).alias("sb"), F.col("size").alias("nb"), "block")
    pairs = a.join(b, [*window, "block"]).where("a <> b and na <= nb").groupBy(*window, "a", "b", "sa", "sb", "na", "nb").agg(F.count("*").alias("c")).where("c = na")
    lost = pairs.where("sb > sa or (sb = sa and (nb > na or b < a))").select(*window, F.col("a").alias(key)).distinct()
    return rows.join(lost, [*window, key], "left_anti")
