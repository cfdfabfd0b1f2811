"""Quantification: genes, coverage, duplicates, lift-over, run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import coverage, floor_join, overlap_join

MODES = ("none", "same", "reverse")


def gene_hits(blocks: DataFrame, genes: DataFrame, read: list[str], width: int = 50_000) -> DataFrame:
    """(read, gene_id, strand, str) of blocks that meet a gene's closed interval."""
    a = blocks.select(*read, "chr", F.col("bs").alias("a_start"), F.col("bend").alias("a_end"), "str")
    b = genes.select("chr", F.col("gs").alias("b_start"), F.col("ge").alias("b_end"), "gene_id", "strand")
    return overlap_join(a, b, ["chr"], width).select(*read, "gene_id", "strand", "str").distinct()


def gene_counts(blocks: DataFrame, exons: DataFrame, read: list[str], width: int = 50_000) -> DataFrame:
    """(gene_id, none, same, reverse): uniquely mapped reads whose blocks meet exons of exactly one gene, for three strand rules; exons without strand fit each. gene_id -1 counts reads of no gene, -2 of several, -3 reads of several loci.

    ``exons``: chr, gs, ge, gene_id, strand; a gene may have any number of them. Reads and hits meet in one aggregate by read."""
    hits = gene_hits(blocks.where("nh = 1"), exons, read, width)
    fits = {"none": F.lit(True), "same": (F.col("strand") == 0) | (F.col("strand") == F.col("str") + 1), "reverse": (F.col("strand") == 0) | (F.col("strand") == 2 - F.col("str"))}
    gene = {m: F.when(f, F.col("gene_id")).alias(m) for m, f in fits.items()}
    nothing = [F.lit(None).cast(exons.schema["gene_id"].dataType).alias(m) for m in MODES]
    rows = hits.select(*read, F.lit(False).alias("many"), *gene.values()).unionAll(blocks.where("nh > 0").select(*read, (F.col("nh") > 1).alias("many"), *nothing))
    both = [f(m).alias(f"{n}_{m}") for m in MODES for n, f in (("l", F.min), ("h", F.max))]
    per = rows.groupBy(*read).agg(F.max("many").alias("many"), *both)
    chosen = [F.when(F.col("many"), -3).when(F.col(f"l_{m}").isNull(), -1).when(F.col(f"l_{m}") != F.col(f"h_{m}"), -2).otherwise(F.col(f"l_{m}")) for m in MODES]
    long = per.select(F.explode(F.array(*[F.struct(F.lit(m).alias("m"), c.cast("long").alias("g")) for m, c in zip(MODES, chosen, strict=True)])).alias("x"))
    counts = long.groupBy(F.col("x.g").alias("gene_id")).agg(*[F.count_if(F.col("x.m") == m).alias(m) for m in MODES])
    names = exons.select(F.col("gene_id").cast("long")).distinct().unionAll(exons.sparkSession.range(3).select((-1 - F.col("id")).alias("gene_id")))
    return names.join(counts, "gene_id", "left").select("gene_id", *[F.coalesce(m, F.lit(0)).alias(m) for m in MODES])


def full_overlap(blocks: DataFrame, genes: DataFrame, read: list[str], width: int = 50_000) -> DataFrame:
    """(read, genes): sorted genes whose whole span any block of an alignment meets on its strand."""
    hits = gene_hits(blocks, genes, read, width).where("strand = 0 or strand = str + 1")
    return hits.groupBy(*read).agg(F.sort_array(F.collect_set("gene_id")).alias("genes"))


def project(alignments: DataFrame, exons: DataFrame, width: int = 100_000) -> DataFrame:
    """``alignments`` with ``tr``, ``t_str`` and ``t_blocks``: the transcripts that hold each of their blocks in an exon, with the blocks' (r, t, len) in the transcript's bases, from 0.

    ``alignments``: chr, str (0 or 1), read_length, ``blocks`` (r, g, len) and ``gaps``, what lies between neighbours: N a junction, which must run from an exon's last base to the next one's first, I or D an indel inside an exon, P the gap between mates, after which the block may begin in any exon. Blocks joined by N become one. On a transcript of strand 2 all is turned round.
    ``exons``: chr, tr, tr_str (1 or 2), es, ee. Only an alignment's first block is joined by place; the others are tested against the transcript's exons, one row a pair."""
    w = Window.partitionBy("tr").orderBy("es")
    one = exons.withColumns({"i": F.row_number().over(w) - 1, "before": F.coalesce(F.sum(F.col("ee") - F.col("es") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    whole = one.groupBy("tr").agg(F.sort_array(F.collect_list(F.struct("i", "es", "ee", "before"))).alias("ex"), F.sum(F.col("ee") - F.col("es") + 1).alias("t_length"))
    first = F.get("blocks", F.lit(0))
    a = alignments.withColumns({"a_start": first["g"], "a_end": first["g"] + first["len"] - 1})
    e = one.select("chr", "tr", "tr_str", F.col("i").alias("at"), F.col("es").alias("b_start"), F.col("ee").alias("b_end"))
    met = overlap_join(a, e, ["chr"], width).where("a_start >= b_start and a_end <= b_end").join(whole, "tr")
    kind = "array<struct<r:bigint,t:bigint,len:bigint>>"

    def step(s: Column, i: Column) -> Column:
        b, gap = F.get("blocks", i), F.get("gaps", i - 1)
        last = F.get("blocks", i - 1)
        here, after = F.get("ex", s["at"]), F.get("ex", s["at"] + 1)
        other = F.get(F.filter("ex", lambda x: (x.es <= b.g) & (b.g <= x.ee)), F.lit(0))
        joins = (last.g + last.len - 1 == here.ee) & (b.g == after.es)
        now = F.when(i == 0, here).when(gap == "N", F.when(joins, after)).when(gap == "P", other).otherwise(here)
        ok = s["ok"] & now.isNotNull() & F.coalesce((b.g >= now.es) & (b.g + b.len - 1 <= now.ee), F.lit(False))
        t = now.before + b.g - now.es
        grown = F.concat(F.slice(s["out"], F.lit(1), F.greatest(F.size(s["out"]) - 1, F.lit(0))), F.transform(F.slice(s["out"], -1, 1), lambda x: F.struct(x.r.alias("r"), x.t.alias("t"), (x.len + b.len).cast("long").alias("len"))))
        added = F.concat(s["out"], F.array(F.struct(b.r.cast("long").alias("r"), t.cast("long").alias("t"), b.len.cast("long").alias("len"))))
        out = F.when(ok, F.when((i > 0) & (gap == "N"), grown).otherwise(added)).otherwise(s["out"])
        return F.struct(ok.alias("ok"), F.coalesce(now.i, s["at"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(True).alias("ok"), F.col("at").cast("int").alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))
    # blocks are few: the walk is one expression
    walked = met.withColumn("_w", F.aggregate(F.sequence(F.lit(0), F.size("blocks") - 1), start, step)).where("_w.ok")
    turned = F.reverse(F.transform("_w.out", lambda x: F.struct((F.col("read_length") - x.r - x.len).cast("long").alias("r"), (F.col("t_length") - x.t - x.len).cast("long").alias("t"), x.len.alias("len"))))
    minus = F.col("tr_str") == 2
    return walked.select(*alignments.columns, "tr", F.when(minus, 1 - F.col("str")).otherwise(F.col("str")).alias("t_str"), F.when(minus, turned).otherwise(F.col("_w.out")).alias("t_blocks"))


#: Units of a base's worth: the least that 1 to 20 divide, so that shares of up to 20 loci are whole; others are rounded to one.
SCALE = 232_792_560


def signal(blocks: DataFrame, by_strand: bool = True, scale: int = SCALE, part: str = "whole", read: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """(chr, str, kind, start, end, value) of unique reads, each base ``scale``, and of all reads, each scale / nh. Duplicates (``dup``) and nh 0 are skipped, and chromosomes whose names don't begin with ``prefix``.

    ``part``: the whole blocks, those of second mates (``mate`` 2), or the start: the 5' base of each first mate's alignment (rows of one ``read``). Both kinds go through one sweep."""
    group = ["chr", "str", "kind"] if by_strand else ["chr", "kind"]
    rows = blocks.where("nh > 0").where(F.startswith(F.col("chr").cast("string"), F.lit(prefix)))
    if "dup" in blocks.columns:
        rows = rows.where("not dup")
    if part == "second":
        rows = rows.where("mate = 2")
    elif part == "start":
        rows = rows.where("mate = 1").groupBy(*read, "chr", "str", "nh").agg(F.min("bs").alias("a"), F.max("bend").alias("b"))
        rows = rows.withColumn("bs", F.when(F.col("str") == 0, F.col("a")).otherwise(F.col("b"))).withColumn("bend", F.col("bs"))
    kinds = F.when(F.col("nh") == 1, F.array(F.lit("unique"), F.lit("all"))).otherwise(F.array(F.lit("all")))
    each = rows.withColumns({"_e": F.col("bend") + 1, "kind": F.explode(kinds)})
    return coverage(each, group, "bs", "_e", F.round(F.lit(scale) / F.col("nh")).cast("long"))


def per_million(signal_: DataFrame, reads: DataFrame, scale: int = SCALE, prefix: str = "") -> DataFrame:
    """Values per million loci: of unique ones, or of those and 1 / nh of each other; ``reads`` has a row (chr, nh) for each locus; the totals are one row."""
    own = reads.where("nh > 0").where(F.startswith(F.col("chr").cast("string"), F.lit(prefix)))
    share = F.when(F.col("nh") > 1, F.round(F.lit(scale) / F.col("nh")).cast("long")).otherwise(F.lit(0))
    total = own.agg(F.count_if(F.col("nh") == 1).alias("_u"), F.coalesce(F.sum(share), F.lit(0)).alias("_m"))
    norm = F.when(F.col("kind") == "unique", F.col("_u")).otherwise(F.col("_u") + F.col("_m") / scale)
    return signal_.crossJoin(F.broadcast(total)).withColumn("rpm", F.round(F.col("value") / scale * 1e6 / norm, 6)).drop("_u", "_m")


def wiggle(signal_: DataFrame) -> DataFrame:
    """A row for each 1-based base."""
    return signal_.withColumn("pos", F.explode(F.sequence(F.col("start") + 1, F.col("end")))).drop("start", "end")


def pair_keys(pairs: DataFrame, bases: int = 0) -> DataFrame:
    """Columns ``key1`` to ``key7``: what pairs have in common that are copies of one fragment: both mates' starts and CIGARs as if soft clips were aligned, both flags, and the first ``bases`` bases of the second mate as it was sequenced.

    ``pairs``: pos1, cigar1, flag1, pos2, cigar2, flag2, seq2 (as aligned)."""
    out = pairs
    for i in (1, 2):  # lengths and operations apart, in columns of their own, so that each CIGAR is read once
        c = f"cigar{i}"
        out = out.withColumns({f"_n{i}": F.split(F.rtrim(F.translate(c, "MIDNSHP=X", " " * 9)), " ").cast("array<int>"), f"_o{i}": F.translate(c, "0123456789", "")})
        n, ops = F.col(f"_n{i}"), F.col(f"_o{i}")
        out = out.withColumns({f"_l{i}": F.when(F.startswith(ops, F.lit("S")), F.get(n, F.lit(0))).otherwise(0), f"_r{i}": F.when(F.endswith(ops, F.lit("S")), F.element_at(n, -1)).otherwise(0)})

    def whole(i: int) -> Column:
        n, ops, left, right = (F.col(f"_{x}{i}") for x in "nolr")
        clips = (left > 0).cast("int") + (right > 0).cast("int")
        kept = F.slice(n, 1 + (left > 0).cast("int"), F.size(n) - clips)
        grown = F.transform(kept, lambda x, j: x + F.when(j == 0, left).otherwise(0) + F.when(j == F.size(n) - clips - 1, right).otherwise(0))
        letters = F.split(F.substring(ops, 1 + (left > 0).cast("int"), F.length(ops) - clips), "")
        return F.array_join(F.zip_with(grown, letters, lambda x, o: F.concat(x.cast("string"), o)), "")

    turned = F.col("flag2").bitwiseAND(F.lit(16)) > 0
    first = F.when(turned, F.substring("seq2", F.length("seq2") - bases + 1, F.lit(bases))).otherwise(F.substring("seq2", F.lit(1), F.lit(bases)))
    made = [F.col("pos1") - F.col("_l1"), F.col("pos2") - F.col("_l2"), F.col("flag1"), F.col("flag2"), whole(1), whole(2), first]
    return out.withColumns({f"key{i}": c for i, c in enumerate(made, 1)}).drop(*[f"_{x}{i}" for x in "nolr" for i in (1, 2)])


def mark_duplicates(reads: DataFrame, keys: list[str], score: str, name: list[str], multi: bool = False) -> DataFrame:
    """``duplicate``: all but the best of reads with equal keys (nulls are equal), of equal scores the first name; ``multi``: reads of several loci (``nh``) too. Keys are named by 128 bits of hash, so that two numbers are sorted and joined and not all keys; only the best of each group is aggregated, so a hot group costs a minimum, not a sort."""
    told = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]  # a null alone would leave a hash as it was
    named = reads.withColumns({"_h": F.xxhash64(*told), "_g": F.xxhash64(F.lit(1), *told[::-1])})
    best = named.groupBy("_h", "_g").agg(F.min(F.struct((-F.col(score)).alias("s"), *name)).alias("_best"))
    found = F.struct((-F.col(score)).alias("s"), *name) != F.col("_best")
    found = found | (F.col("nh") > 1) if multi else found
    return named.join(best, ["_h", "_g"]).withColumn("duplicate", found).drop("_best", "_h", "_g")


def lift_over(intervals: DataFrame, blocks: DataFrame, start: str = "s", end: str = "e", width: int = 1 << 20) -> DataFrame:
    """``new_start`` and ``new_end`` by chain blocks (chr, s1, s2, len) of one chain a chromosome: a place inside a block shifts with it; a left end in a gap moves to the next block's start, a right end to the previous block's end; null where there is none or the end falls before the start."""
    fields = ["s1", "s2", "len"]
    left = floor_join(intervals, blocks, ["chr"], start, "s1", fields, width)
    inside = lambda at: F.col("before").isNotNull() & (F.col(at) < F.col("before.s1") + F.col("before.len"))
    left = left.withColumn("new_start", F.when(inside(start), F.col("before.s2") + F.col(start) - F.col("before.s1")).otherwise(F.col("after.s2"))).drop("before", "after")
    right = floor_join(left, blocks, ["chr"], end, "s1", fields, width)
    right = right.withColumn("new_end", F.when(inside(end), F.col("before.s2") + F.col(end) - F.col("before.s1")).otherwise(F.col("before.s2") + F.col("before.len") - 1)).drop("before", "after")
    ok = F.col("new_end") >= F.col("new_start")
    return right.withColumns({"new_start": F.when(ok, F.col("new_start")), "new_end": F.when(ok, F.col("new_end"))})


def check_chromosomes(intervals: DataFrame, blocks: DataFrame) -> DataFrame:
    """Raises, when rows are read, at a chromosome that the chain lacks."""
    known = blocks.select("chr").distinct().withColumn("_k", F.lit(True))
    return intervals.join(known, "chr", "left").withColumn("chr", F.when(F.col("_k").isNull(), F.raise_error(F.concat(F.lit("the chain lacks "), F.col("chr").cast("string"))).cast(intervals.schema["chr"].dataType)).otherwise(F.col("chr"))).drop("_k")


def final_stats(alignments: DataFrame) -> DataFrame:
    """One row of run totals from nh, mapped length and mismatches of each read."""
    n = lambda e: F.count_if(F.expr(e))
    out = alignments.agg(F.count("*").alias("reads"), n("nh = 1").alias("unique"), n("nh > 1 and nh <= 10").alias("multi"), n("nh > 10").alias("too_many"), F.sum(F.when(F.col("nh") == 1, F.col("length"))).alias("bases"), F.sum(F.when(F.col("nh") == 1, F.col("mismatches"))).alias("mismatches"))
    pct: list[tuple[str, Column]] = [("unique_percent", F.round(100.0 * F.col("unique") / F.col("reads"), 2)), ("mean_length", F.round(F.col("bases") / F.col("unique"), 4)), ("mismatch_percent", F.round(100.0 * F.col("mismatches") / F.col("bases"), 4))]
    return out.withColumns(dict(pct))
