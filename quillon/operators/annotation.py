"""Annotation tables: exon lengths, spans, motifs, k-mer and suffix indexes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import floor_join

BASES = np.full(256, 4, np.uint8)
BASES[[65, 67, 71, 84]] = range(4)


def exon_lengths(exons: DataFrame, transcript: str = "tr", start: str = "es", end: str = "ee", ties: tuple[str, ...] = ()) -> DataFrame:
    """Each exon with its number, the summed lengths of those before it, and the largest end so far; ``ties`` order exons of equal ends."""
    w = Window.partitionBy(transcript).orderBy(start, end, *ties)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return exons.withColumns({"exon": F.row_number().over(w), "before": F.coalesce(F.sum(F.col(end) - F.col(start) + 1).over(before), F.lit(0)), "reach": F.max(end).over(w.rowsBetween(Window.unboundedPreceding, 0))})


def spans(exons: DataFrame, by: str, start: str = "es", end: str = "ee", group: tuple[str, ...] = ()) -> DataFrame:
    """Each gene's start, end and exons, and ``reach``, the largest end of the genes up to it in the order of starts; genes, not exons, meet in a group's window."""
    out = exons.groupBy(*group, by).agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("exons"))
    w = Window.partitionBy(*group).orderBy("start", by).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("reach", F.max("end").over(w))


def motif(donor: Column, acceptor: Column) -> Column:
    """0 non-canonical, 1 GT/AG, 2 CT/AC, 3 GC/AG, 4 CT/GC, 5 AT/AC, 6 GT/AT."""
    out = F.lit(0)
    for i, (d, a) in enumerate((("GT", "AG"), ("CT", "AC"), ("GC", "AG"), ("CT", "GC"), ("AT", "AC"), ("GT", "AT")), 1):
        out = F.when((donor == d) & (acceptor == a), i).otherwise(out)
    return out


def strand_of(motif_: Column) -> Column:
    """0 for none, 1 for odd and 2 for even motifs."""
    return F.when(motif_ == 0, 0).otherwise(2 - motif_ % 2)


def genome_bins(chromosomes: DataFrame, width: int, overlap: int) -> DataFrame:
    """(chr, bin, seq): pieces of ``width`` bases and ``overlap`` more, so that what starts in a bin lies in its row."""
    n = F.greatest(F.ceil(F.length("seq") / width).cast("int"), F.lit(1))
    return chromosomes.select("chr", F.explode(F.sequence(F.lit(0), n - 1)).alias("bin"), "seq").select("chr", "bin", F.substring("seq", F.col("bin") * width + 1, F.lit(width + overlap)).alias("seq"))


def fetch(places: DataFrame, bins: DataFrame, width: int, at: str, size: Column, name: str) -> DataFrame:
    """``places`` with the bases from 0-based ``at`` on; at most the bins' overlap long."""
    return places.withColumn("bin", F.floor(F.col(at) / width)).join(bins.withColumnRenamed("seq", "_s"), ["chr", "bin"], "left").withColumn(name, F.substring("_s", (F.col(at) - F.col("bin") * width + 1).cast("int"), size)).drop("bin", "_s")


def kmers(bins: DataFrame, width: int, k: int) -> DataFrame:
    """(kmer, chr, pos): each k-mer of A, C, G, T; bins overlap by k - 1 bases."""
    last = F.least(F.length("seq") - k, F.lit(width - 1))
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    made = F.posexplode(F.transform(starts, lambda i: F.substring(F.col("seq"), i + 1, F.lit(k))))  # rows don't carry the bin's bases
    return bins.select("chr", "bin", made.alias("i", "kmer")).select("kmer", "chr", (F.col("bin").cast("long") * width + F.col("i")).alias("pos")).where("kmer not rlike '[^ACGT]'")


def kmer_index(kmers_: DataFrame) -> DataFrame:
    return kmers_.groupBy("kmer").agg(F.count("*").alias("n"), F.min(F.struct("chr", "pos")).alias("first"))


def codes_of(text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-mers of a text at all its places as numbers of 2 bits a base, and which of them hold known bases alone; ``k`` is 31 at most."""
    if not 1 <= k <= 31:
        raise ValueError("k from 1 to 31")
    x = BASES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    n = max(len(x) - k + 1, 0)
    wrong = np.concatenate(([0], np.cumsum(x > 3)))
    code = np.zeros(n, np.int64)
    for i in range(k):
        code = code << 2 | (x[i : i + n] & 3)
    return code, wrong[k : k + n] == wrong[:n]


def kmer_lists(bins: DataFrame, width: int, k: int) -> DataFrame:
    """(chr, bin, h): the k-mers that begin in a bin as one list of numbers, so no base is walked to again for each of them; bins overlap by k - 1 bases."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                code, known = codes_of(batch.column(2)[i].as_py() or "", k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([code[:width][known[:width]]], pa.list_(pa.int64()))], ["chr", "bin", "h"])

    return bins.select("chr", "bin", "seq").mapInArrow(run, f"chr {bins.schema['chr'].dataType.simpleString()}, bin int, h array<bigint>")


def kmer_counts(bins: DataFrame, width: int, k: int) -> DataFrame:
    """``kmer_index`` of the bins' k-mers, which are counted in each batch before any is a row."""
    letters = np.frombuffer(b"ACGT", np.uint8)

    def run(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows.take(pc.sort_indices(rows, [("chr", "ascending"), ("bin", "ascending")], null_placement="at_start"))  # a k-mer's first place is its least
            code, row, at = [], [], []
            for i, (b, text) in enumerate(zip(rows.column("bin").to_pylist(), rows.column("seq").to_pylist(), strict=True)):
                c, known = codes_of(text, k)
                place = np.flatnonzero(known[:width])
                code.append(c[place])
                row.append(np.full(len(place), i, np.int64))
                at.append(place + b * width)
            if not code:
                continue
            each, first, n = np.unique(np.concatenate(code), return_index=True, return_counts=True)
            text = letters[each[:, None] >> 2 * np.arange(k)[::-1] & 3].tobytes().decode()
            kmer = [text[i * k : (i + 1) * k] for i in range(len(each))]
            chr_ = rows.column("chr").combine_chunks().take(pa.array(np.concatenate(row)[first], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(kmer, pa.string()), pa.array(n, pa.int64()), chr_, pa.array(np.concatenate(at)[first], pa.int64())], ["kmer", "n", "chr", "pos"])

    some = bins.where("seq is not null").select("chr", "bin", "seq")
    counted = some.mapInArrow(run, f"kmer string, n long, chr {bins.schema['chr'].dataType.simpleString()}, pos long")
    return counted.groupBy("kmer").agg(F.sum("n").alias("n"), F.min(F.struct("chr", "pos")).alias("first"))


def both_halves(chromosomes: DataFrame) -> DataFrame:
    """(chr, half, seq): the chromosomes and, as half 1, their other strands."""
    turned = F.reverse(F.translate("seq", "ACGT", "TGCA"))
    return chromosomes.select("chr", F.posexplode(F.array("seq", turned)).alias("half", "seq"))


def suffix_table(bins: DataFrame, width: int, depth: int, every: int = 1) -> DataFrame:
    """(suffix, chr, pos), range-partitioned and sorted by the first ``depth`` bases: a suffix array whose rows are spread by sampled bounds. Bins overlap by ``depth`` bases; of the places every ``every``th is taken."""
    made = F.posexplode(F.transform(F.sequence(F.lit(0), F.least(F.length("seq"), F.lit(width)) - 1), lambda i: F.substring(F.col("seq"), i + 1, F.lit(depth))))
    rows = bins.where("length(seq) > 0").select("chr", "bin", made.alias("i", "suffix")).select("suffix", "chr", (F.col("bin").cast("long") * width + F.col("i")).alias("pos")).where(F.col("pos") % every == 0)
    return rows.repartitionByRange("suffix", "chr", "pos").sortWithinPartitions("suffix", "chr", "pos")


def ranked(suffixes: DataFrame, path: str) -> DataFrame:
    """The suffix table with each row's ``rank`` from 0: written to ``path`` by ranges, as their bounds are drawn anew in each run, then counted by range."""
    suffixes.withColumn("part", F.spark_partition_id()).write.parquet(path)
    rows = suffixes.sparkSession.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a range
    inside = F.row_number().over(Window.partitionBy("part").orderBy("suffix", "chr", "pos")) - 1
    return rows.withColumn("_i", inside).join(before, "part").select("suffix", "chr", "pos", (F.col("before") + F.col("_i")).alias("rank"))


def prefix_index(ranked_: DataFrame, levels: int) -> DataFrame:
    """(level, prefix, first, last, unknown): of each prefix of 1 to ``levels`` known bases that occurs, the first and last rank; ``unknown``: whether a suffix between has another letter or ends within the level."""
    each = ranked_.select("rank", F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level"), "suffix")
    each = each.withColumn("prefix", F.substring("suffix", F.lit(1), F.col("level")))
    known = each.where("length(prefix) = level and not prefix rlike '[^ACGT]'").groupBy("level", "prefix").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    # a prefix is followed by other letters where its longer ones don't fill its ranks
    longer = known.select((F.col("level") - 1).alias("level"), F.expr("substring(prefix, 1, level - 1)").alias("prefix"), (F.col("last") - F.col("first") + 1).alias("n"))
    filled = longer.where("level > 0").groupBy("level", "prefix").agg(F.sum("n").alias("n"))
    out = known.join(filled, ["level", "prefix"], "left")
    return out.select("level", "prefix", "first", "last", ((F.col("level") < levels) & (F.coalesce("n", F.lit(0)) < F.col("last") - F.col("first") + 1)).alias("unknown"))


def absent_prefixes(index: DataFrame, level: int) -> DataFrame:
    """Prefixes of a level that don't occur."""
    digit = F.transform(F.sequence(F.lit(level - 1), F.lit(0)), lambda i: F.substring(F.lit("ACGT"), (F.floor(F.col("id") / F.pow(F.lit(4), i)) % 4).cast("int") + 1, F.lit(1)))
    every = index.sparkSession.range(4**level).select(F.array_join(digit, "").alias("prefix"))
    return every.join(index.where(F.col("level") == level).select("prefix"), "prefix", "left_anti")


def insert_suffixes(ranked_: DataFrame, more: DataFrame, path: str) -> DataFrame:
    """The ranked table with more suffixes (extra sequences, junction flanks): sorted and ranked together."""
    both = ranked_.select("suffix", "chr", "pos").unionByName(more.select("suffix", "chr", "pos"))
    return ranked(both.repartitionByRange("suffix", "chr", "pos").sortWithinPartitions("suffix", "chr", "pos"), path)


def repeat_shift(left: Column, right: Column) -> Column:
    """Bases by which a gap can slide to the right: the common prefix of two strings, without unknown bases, 255 at most. To the left: of the reversed bases before the gap and those that end it."""
    n = F.least(F.length(left), F.length(right), F.lit(255))
    wrong = F.filter(F.sequence(F.lit(1), n), lambda i: (F.substring(left, i, 1) != F.substring(right, i, 1)) | ~F.substring(left, i, 1).isin(*"ACGT"))
    return F.when(n <= 0, 0).otherwise(F.coalesce(F.array_min(wrong) - 1, n))


def shifts(junctions: DataFrame, bins: DataFrame, width: int, most: int = 255) -> DataFrame:
    """``motif``, ``shift_left`` and ``shift_right`` of introns (chr, 0-based start, end after it); bins overlap by ``most`` bases."""
    left = lambda at: F.greatest(F.col(at) - most, F.lit(0))
    out = junctions.withColumns({"_a": left("start"), "_b": left("end")})
    for name, at in (("_p", "_a"), ("_q", "start"), ("_r", "_b"), ("_t", "end")):
        out = fetch(out, bins, width, at, F.lit(most), name)
    before = lambda c, at, low: F.reverse(F.substring(c, F.lit(1), (F.col(at) - F.col(low)).cast("int")))
    ends = F.substring("_r", (F.col("end") - F.col("_b") - 1).cast("int"), F.lit(2))
    return out.withColumns({
        "motif": motif(F.substring("_q", 1, 2), ends), "shift_left": repeat_shift(before("_p", "start", "_a"), before("_r", "end", "_b")), "shift_right": repeat_shift(F.col("_q"), F.col("_t")),
    }).drop("_a", "_b", "_p", "_q", "_r", "_t")


def locate(positions: DataFrame, chromosomes: DataFrame, at: str = "pos", width: int = 1 << 24) -> DataFrame:
    """``chr``, ``chr_start`` and ``chr_length`` of the chromosome of each genome-wide position; positions outside all are dropped."""
    fields = ["chr", "chr_start", "chr_length"]
    found = floor_join(positions.withColumn("_g", F.lit(0)), chromosomes.select("*", F.lit(0).alias("_g")), ["_g"], at, "chr_start", fields, width)
    return found.where(F.col(at) < F.col("before.chr_start") + F.col("before.chr_length")).select("*", "before.*").drop("_g", "before", "after")


def flanks(junctions: DataFrame, bins: DataFrame, width: int, overhang: int) -> DataFrame:
    """``flank``: the bases of both sides of each intron (0-based start, end after it) put together; bins overlap by ``overhang`` bases."""
    at = junctions.withColumns({"_l": F.greatest(F.col("start") - overhang, F.lit(0)), "_r": F.col("end")})
    left = fetch(at, bins, width, "_l", F.lit(overhang), "_a").withColumn("_a", F.substring("_a", F.lit(1), (F.col("start") - F.col("_l")).cast("int")))
    return fetch(left, bins, width, "_r", F.lit(overhang), "_b").withColumn("flank", F.concat("_a", "_b")).drop("_l", "_r", "_a", "_b")


def allele_choices(flanks_: DataFrame, most: int = 10) -> DataFrame:
    """Each flank with every choice of the two alleles of its ``snps`` (array of offset from 0, a1, a2); flanks with over ``most`` have none but their own bases."""
    n = F.size("snps")
    pick = F.explode(F.when(n <= most, F.sequence(F.lit(0), F.pow(F.lit(2), n).cast("int") - 1)).otherwise(F.array(F.lit(-1))))
    rows = flanks_.withColumn("choice", pick)
    put = F.aggregate(F.transform("snps", lambda s, i: F.struct(s.offset.alias("o"), F.when(F.pmod(F.floor(F.col("choice") / F.pow(F.lit(2), i)), F.lit(2)) == 0, s.a1).otherwise(s.a2).alias("b"))), F.col("flank"), lambda t, x: F.overlay(t, x.b, x.o + 1, F.lit(1)))
    return rows.withColumn("variant", F.when(F.col("choice") < 0, F.col("flank")).otherwise(put))


def window_parameters(genome_bases: int, intron_max: int = 0, mates_gap: int = 0, bits: int = 16, reach: int = 9, flank: int = 4, bin_bits: int = 18) -> dict[str, int]:
    """Window bins from the limits of introns and mates. Without limits the defaults hold. Otherwise a bin is about a
    quarter of the largest of 4, the intron limit and the mates' limit (1000 if not given), in whole powers of two, but
    not so small that the genome has many more than 40 000 bins; the flank is the larger limit in bins, rounded up, and
    the reach twice that. No bin is larger than a chromosome's."""
    near = lambda x: math.floor(math.log2(x) + 0.5)
    limited = intron_max > 0 or mates_gap > 0
    if limited:
        bits = max(near(max(4, intron_max, mates_gap or 1000) // 4), near(genome_bases // 40_000 + 1))
    bits = min(bits, bin_bits)
    if limited:
        flank = (max(intron_max, mates_gap) >> bits) + 1
        reach = 2 * flank
    return {"bits": bits, "reach": reach, "flank": flank, "bins": (genome_bases >> bits) + 1}


def gene_tables(exons: DataFrame) -> dict[str, DataFrame]:
    """Four tables of annotated exons (chr, start, end, strand, tr, gene, gene_name, gene_type), numbered from 0: ``genes``, ``transcripts`` by their place, ``exons`` of each transcript with its number and the bases before it, and ``exon_genes``, each different exon of a gene by place."""
    genes = exons.groupBy("gene").agg(F.min("gene_name").alias("gene_name"), F.min("gene_type").alias("gene_type"))
    genes = genes.withColumn("g", F.row_number().over(Window.orderBy("gene")) - 1)  # as many rows as genes
    tr = exons.groupBy("tr", "gene", "chr", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_exons"))
    order = Window.orderBy("chr", "start", "end", "tr")  # as many rows as transcripts
    tr = tr.join(genes.select("gene", "g"), "gene").withColumns({"t": F.row_number().over(order) - 1, "reach": F.max("end").over(Window.partitionBy("chr").orderBy("start", "end", "tr").rowsBetween(Window.unboundedPreceding, 0))})
    w = Window.partitionBy("tr").orderBy("start", "end")
    own = exons.select("tr", "start", "end").join(tr.select("tr", "t"), "tr")
    own = own.select("t", (F.row_number().over(w) - 1).alias("exon"), "start", "end", F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    places = exons.select("chr", "start", "end", "strand", "gene").distinct().join(genes.select("gene", "g"), "gene").drop("gene")
    return {"genes": genes, "transcripts": tr, "exons": own, "exon_genes": places}


def apply_consensus(bins: DataFrame, variants: DataFrame, width: int) -> DataFrame:
    """(chr, bin, seq, replaced, mismatches): the genome's bins (of ``width`` bases, without overlap) with the variants' bases (chr, pos from 0, ref, alt) where their reference base agrees. A bin and its variants meet in one row; no base becomes a row."""
    each = variants.withColumn("bin", F.floor(F.col("pos") / width).cast("int")).groupBy("chr", "bin").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "alt"))).alias("v"))
    both = bins.join(each, ["chr", "bin"], "left").withColumn("v", F.coalesce("v", F.expr("cast(array() as array<struct<pos:bigint,ref:string,alt:string>>)")))
    at = lambda x: (x.pos - F.col("bin") * width).cast("int")
    agrees = lambda x: F.substring(F.col("seq"), at(x) + 1, F.lit(1)) == x.ref
    # a column of its own: lambdas repeated in one projection disturb each other
    both = both.withColumn("_ok", F.filter("v", agrees))
    made = F.aggregate("_ok", F.col("seq"), lambda s, x: F.overlay(s, x.alt, at(x) + 1, F.lit(1)))
    return both.select("chr", "bin", made.alias("seq"), F.size("_ok").alias("replaced"), (F.size("v") - F.size("_ok")).alias("mismatches"))
