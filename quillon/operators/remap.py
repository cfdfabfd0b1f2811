"""Alignment in stages: two passes with junctions, reads remapped with their other alleles, checks on projected alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_path
from .align import align
from .annotation import fetch, flanks, genome_bins


def blocks_of(alignments: DataFrame) -> DataFrame:
    """``ops``: the CIGAR as (n, op), and ``blocks``: (r, g, len) of its M operations, read starts from 0, genome starts as ``pos``."""
    n = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MINDS]"), F.lit(1)).cast("array<int>")
    op = F.regexp_extract_all("cigar", F.lit(r"\d+([MINDS])"), F.lit(1))
    ops = F.zip_with(n, op, lambda a, b: F.struct(a.alias("n"), b.alias("op")))
    empty = F.expr("cast(array() as array<struct<r:int,g:bigint,len:int>>)")
    walk = F.aggregate("ops", F.struct(F.lit(0).alias("r"), F.col("pos").alias("g"), empty.alias("out")), lambda s, o: F.struct(
        (s.r + F.when(o.op.isin("M", "I", "S"), o.n).otherwise(0)).alias("r"), (s.g + F.when(o.op.isin("M", "N", "D"), o.n).otherwise(0)).alias("g"),
        F.when(o.op == "M", F.concat(s.out, F.array(F.struct(s.r.alias("r"), s.g.alias("g"), o.n.alias("len"))))).otherwise(s.out).alias("out")), lambda s: s.out)
    return alignments.withColumn("ops", ops).withColumn("blocks", walk)


def introns(alignments: DataFrame) -> DataFrame:
    """(read, chr, start, gap, overhang, nh): the N operations, with the smaller of the neighbouring blocks."""
    rows = blocks_of(alignments).select("read", "chr", "nh", "pos", "ops", "blocks", F.posexplode(F.slice("blocks", 2, F.greatest(F.size("blocks") - 1, F.lit(0)))).alias("i", "b"))
    before = F.get("blocks", F.col("i"))
    gap = F.col("b.g") - before.g - before.len
    return rows.select("read", "chr", (before.g + before.len).alias("start"), gap.alias("gap"), F.least(before.len, F.col("b.len")).alias("overhang"), "nh").where((F.col("gap") >= 21))


def supported(alignments: DataFrame, least: int = 1, overhang: int = 10) -> DataFrame:
    """(chr, start, end, n) of introns, 0-based with the end after them, that at least ``least`` reads of one locus span with that overhang."""
    seen = introns(alignments).where(F.col("nh") == 1).groupBy("chr", "start", "gap").agg(F.count_distinct("read").alias("n"), F.max("overhang").alias("o"))
    good = seen.where((F.col("n") >= least) & (F.col("o") >= overhang))
    return good.select("chr", (F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("gap")).alias("end"), "n")


def with_junctions(genome: DataFrame, junctions: DataFrame, overhang: int, most: int = 1_000_000) -> DataFrame:
    """``genome`` (chr, seq) and, as further sequences, the flanks of the junctions put together, named after their place; over ``most`` junctions raise."""
    n = junctions.count()
    if n > most:
        raise ValueError(f"{n} junctions are over the limit of {most}")
    width = max(1 << 16, overhang)
    named = junctions.select(F.col("chr").cast("string").alias("chr"), "start", "end").distinct()
    joined = flanks(named, genome_bins(genome.select(F.col("chr").cast("string").alias("chr"), "seq"), width, overhang), width, overhang)
    name = F.concat_ws("\x1f", F.lit("sj"), "chr", "start", "end", F.least(F.col("start"), F.lit(overhang)))
    return genome.select(F.col("chr").cast("string").alias("chr"), "seq").unionByName(joined.select(name.alias("chr"), F.col("flank").alias("seq")))


def on_genome(alignments: DataFrame, bonus: int = 2) -> DataFrame:
    """Alignments to a genome with junctions, all on the genome: one on a junction's flanks has its block across the junction cut in two and ``bonus`` more score; one that doesn't cross is left out, as the genome has it too."""
    part = F.split("chr", "\x1f")
    at = lambda i: F.get(part, F.lit(i)).cast("long")
    on = F.startswith("chr", F.lit("sj\x1f"))
    rows = blocks_of(alignments.where(on)).withColumns({"_c": F.get(part, F.lit(1)), "_s": at(2), "_e": at(3), "_l": at(4)})
    # each operation with the flanks' place where it begins
    uses = lambda o: F.when(o.op.isin("M", "D", "N"), o.n).otherwise(0)
    begin = lambda i: F.aggregate(F.slice("ops", F.lit(1), i), F.col("pos") - 1, lambda s, o: s + uses(o))
    rows = rows.withColumn("_o", F.transform("ops", lambda o, i: F.struct(begin(i).alias("at"), o.n.alias("n"), o.op.alias("op"))))
    cross = lambda o: (o.at < F.col("_l")) & (o.at + o.n > F.col("_l"))
    text = lambda n, op: F.concat(n.cast("string"), op)
    cut = lambda o: F.concat(text(F.col("_l") - o.at, F.lit("M")), text(F.col("_e") - F.col("_s"), F.lit("N")), text(o.at + o.n - F.col("_l"), F.lit("M")))
    rows = rows.where(F.size(F.filter("_o", lambda o: (o.op == "M") & cross(o))) == 1)
    rows = rows.withColumn("cigar", F.array_join(F.transform("_o", lambda o: F.when((o.op == "M") & cross(o), cut(o)).otherwise(text(o.n, o.op))), ""))
    moved = rows.withColumns({"pos": F.col("_s") - F.col("_l") + F.col("pos"), "chr": F.col("_c"), "score": F.col("score") + bonus})
    out = alignments.where(~on).unionByName(moved.select(alignments.columns))
    best = out.withColumn("_m", F.max("score").over(Window.partitionBy("read"))).where("score = _m").drop("_m")
    one = best.dropDuplicates(["read", "chr", "pos", "strand", "cigar"])
    return one.withColumn("nh", F.count("*").over(Window.partitionBy("read")).cast("int"))


def two_pass(reads: DataFrame, genome: DataFrame, known: DataFrame | None = None, least: int = 1, overhang: int = 10, flank: int = 100, limit: int = 1_000_000, most: int = 10) -> DataFrame:
    """Alignments of a second pass: a first one finds junctions, those supported (and ``known``: chr, start, end) are put in the genome, and all reads are mapped again, so that short ends beyond a junction are placed across it."""
    path = shared_path(reads.sparkSession, "pass1")
    found = supported(align(reads, genome), least, overhang).select(F.col("chr").cast("string").alias("chr"), "start", "end")
    found = found if known is None else found.unionByName(known.select(F.col("chr").cast("string").alias("chr"), "start", "end"))
    found.distinct().write.parquet(path)
    junctions = reads.sparkSession.read.parquet(path)
    again = align(reads, with_junctions(genome, junctions, flank, limit), most=100 * most)
    return on_genome(again).where(F.col("nh") <= most)


def other_alleles(alignments: DataFrame, variants: DataFrame, sequences: DataFrame, genome: DataFrame, most: int = 10) -> DataFrame:
    """(read, tag): whether reads with variants map back with the other alleles. -1: no variant; 2: several loci; 7: over ``most`` variants; 3: a base that is neither allele; 4: a remapped read does not map; 5: to several loci; 6: elsewhere; 1: all to their place.

    ``variants``: chr, pos (from 1), a1, a2; ``sequences``: read, seq as aligned to the + strand."""
    rows = blocks_of(alignments)
    each = rows.select("read", "chr", F.explode("blocks").alias("b")).select("read", "chr", "b", F.explode(F.sequence(F.floor(F.col("b.g") / 1024), F.floor((F.col("b.g") + F.col("b.len") - 1) / 1024))).alias("bin"))
    met = each.join(variants.withColumn("bin", F.floor(F.col("pos") / 1024)), ["chr", "bin"]).where((F.col("pos") >= F.col("b.g")) & (F.col("pos") < F.col("b.g") + F.col("b.len")))
    at = met.select("read", (F.col("b.r") + F.col("pos") - F.col("b.g")).cast("int").alias("offset"), "a1", "a2").distinct()
    per = at.groupBy("read").agg(F.array_sort(F.collect_list(F.struct("offset", "a1", "a2"))).alias("snps"))
    loci = alignments.groupBy("read").agg(F.first("chr").alias("chr"), F.min("pos").alias("pos"), F.first("cigar").alias("cigar"), F.max("nh").alias("nh")).join(per, "read", "left").join(sequences.select("read", "seq"), "read")
    base = lambda s: F.substring(F.col("seq"), s.offset + 1, F.lit(1))
    strange = F.exists("snps", lambda s: (base(s) != s.a1) & (base(s) != s.a2))
    first = F.when(F.col("snps").isNull(), -1).when(F.col("nh") > 1, 2).when(F.size("snps") > most, 7).when(strange, 3)
    loci = loci.withColumn("early", first)
    todo = loci.where("early is null")
    choices = todo.withColumn("choice", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.size("snps")).cast("int") - 1)))
    made = F.aggregate(F.transform("snps", lambda s, i: F.struct(s.offset.alias("o"), F.when(F.pmod(F.floor(F.col("choice") / F.pow(F.lit(2), i)), F.lit(2)) == 0, s.a1).otherwise(s.a2).alias("b"))), F.col("seq"), lambda t, x: F.overlay(t, x.b, x.o + 1, F.lit(1)))
    choices = choices.withColumn("new", made).where("new <> seq").select("read", F.concat_ws("\x1f", "read", "choice").alias("id"), "new", F.col("chr").alias("c0"), F.col("pos").alias("p0"), F.col("cigar").alias("g0"))
    again = align(choices.select(F.col("id").alias("read"), F.col("new").alias("seq")), genome).groupBy(F.col("read").alias("id")).agg(F.max("nh").alias("n"), F.min(F.struct("chr", "pos", "cigar")).alias("m"))
    here = (F.col("m.chr") == F.col("c0")) & (F.col("m.pos") == F.col("p0")) & (F.col("m.cigar") == F.col("g0"))
    step = F.when(F.col("n").isNull(), 4).when(F.col("n") > 1, 5).when(~here, 6).otherwise(1)
    order = F.when(step == 1, 9).otherwise(step)
    late = choices.join(again, "id", "left").groupBy("read").agg(F.min(order).alias("late")).select("read", F.when(F.col("late") == 9, 1).otherwise(F.col("late")).alias("late"))
    return loci.select("read", "early").join(late, "read", "left").select("read", F.coalesce("early", "late", F.lit(1)).cast("int").alias("tag"))


def extend_clips(alignments: DataFrame, bins: DataFrame, width: int, most: int = 10, share: float = 0.3) -> DataFrame:
    """Alignments without soft clips: the first and last block grow over them, ``pos``, ``cigar`` and ``mismatches`` follow; those with more mismatches then than ``most``, or than that share of the read's length less one, are left out, as are those that would begin before the chromosome.

    ``alignments``: chr, pos (from 1), cigar, mismatches, seq as aligned; ``bins``: the genome's, of ``width`` bases, overlapping by a read's length."""
    number = lambda rule: F.coalesce(F.regexp_extract("cigar", rule, 1).try_cast("int"), F.lit(0))
    rows = blocks_of(alignments).withColumns({"_a": number(r"^(\d+)S"), "_b": number(r"(\d+)S$"), "_last": F.element_at("blocks", -1)})
    rows = rows.withColumns({"_s": F.col("pos") - 1 - F.col("_a"), "_e": F.col("_last.g") + F.col("_last.len") - 1}).where("_s >= 0").drop("ops", "blocks", "_last")
    rows = fetch(rows.withColumnRenamed("_s", "_begin"), bins, width, "_begin", F.col("_a"), "_left")
    rows = fetch(rows, bins, width, "_e", F.col("_b"), "_right").where("length(_left) = _a and length(_right) = _b")
    wrong = lambda x, y: F.size(F.filter(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: (p != q) & p.isin(*"ACGT") & q.isin(*"ACGT")), lambda z: z))
    front, back = F.substring(F.col("seq"), F.lit(1), F.col("_a")), F.substring(F.col("seq"), F.length("seq") - F.col("_b") + 1, F.col("_b"))
    # a column of its own for each side's count
    rows = rows.withColumn("_p", F.when(F.col("_a") > 0, wrong(front, F.col("_left"))).otherwise(0)).withColumn("_q", F.when(F.col("_b") > 0, wrong(back, F.col("_right"))).otherwise(0))
    core = F.regexp_replace("cigar", r"^\d+S|\d+S$", "")
    grown = F.concat((F.regexp_extract(core, r"^(\d+)", 1).cast("int") + F.col("_a")).cast("string"), F.regexp_replace(core, r"^\d+", ""))
    rows = rows.withColumn("_c", grown)
    whole = F.concat(F.regexp_replace("_c", r"\d+M$", ""), (F.regexp_extract("_c", r"(\d+)M$", 1).cast("int") + F.col("_b")).cast("string"), F.lit("M"))
    out = rows.withColumns({"cigar": whole, "pos": F.col("_begin") + 1, "mismatches": F.col("mismatches") + F.col("_p") + F.col("_q")})
    return out.where(F.col("mismatches") <= F.least(F.lit(most), F.floor(share * (F.length("seq") - 1)))).select(alignments.columns)


def transcript_bans(alignments: DataFrame, paired: bool = False, indels: bool = False, clips: bool = False) -> DataFrame:
    """Alignments fit for transcript counts: without indels and soft clips unless they are allowed (``extend_clips`` first turns clips into aligned bases), both mates if ``paired``; one primary a read, by a hash of its place."""
    banned = ("" if indels else "ID") + ("" if clips else "S")
    fit = alignments.where(~F.col("cigar").rlike(f"[{banned}]")) if banned else alignments
    if paired:
        fit = fit.where("mates = 2")
    w = Window.partitionBy("read").orderBy(F.xxhash64("read", "chr", "pos"), "chr", "pos")
    return fit.withColumn("primary", F.row_number().over(w) == 1)
