"""Queries that write files of each format and read them again, genome index queries, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..operators import annotation as A
from ..operators import junctions as J
from ..operators import quant as Q
from ..sources import bam, index, readers, writers
from ..sources.shared import shared_path
from .fixtures import code_of, derived, duck, table
from .front_queries import D25, DECODED, KEYS, NAME, K, name

# --- files ---------------------------------------------------------------------------------------


def chromosomes(spark, d):
    """Five chromosomes of the parts' codes in order."""
    chip = derived(spark, d, "chip_map").where("pk < 1000000")
    one = F.struct("pk", seq.decode(F.col("barcode"), 25).alias("s"))
    return chip.groupBy(F.concat(F.lit("c"), F.col("pk") % 5).alias("chr")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x.s), "").alias("seq"))


GENOME = duck("chip_map") + f""", g as (select 'c' || (pk % 5) chr, string_agg({D25}, '' order by pk) seq from chip_map where pk < 1000000 group by 1)"""


def fasta(spark, d):
    path = shared_path(spark, "genome")
    lines = F.regexp_replace("seq", "(.{60})", "$1\n")
    chromosomes(spark, d).select(F.concat(F.lit(">"), F.col("chr"), F.lit(" made of parts\n"), lines).alias("value")).write.text(path)
    got = readers.read_fasta(spark, path)
    return got.join(readers.chromosome_starts(got, 12), "chr").select("chr", "description", "chr_start", "chr_length", F.md5("seq").alias("bases"))


FASTA = GENOME + """ select chr, 'made of parts' description, cast(coalesce(sum(ceil(length(seq) / 4096.0) * 4096) over (order by chr rows between unbounded preceding and 1 preceding), 0) as bigint) chr_start, length(seq) chr_length, md5(seq) bases from g"""


def gtf_rows(spark, d):
    e = derived(spark, d, "exons").select("tr", "gene", F.concat(F.lit("c"), F.col("tr") % 7).alias("chr"), F.col("es").alias("start"), F.col("ee").alias("end")).distinct()
    text = F.concat_ws("; ", F.concat(F.lit('transcript_id "t'), F.col("tr"), F.lit('"')), F.when(F.col("gene") % 10 > 0, F.concat(F.lit('gene_id "g'), F.col("gene"), F.lit('"'))), F.when(F.col("gene") % 2 == 0, F.concat(F.lit('gene_name "n'), F.col("gene"), F.lit('"'))), F.when(F.col("gene") % 3 == 0, F.lit('gene_biotype "coding"')))
    exon = e.select(F.concat_ws("\t", "chr", F.lit("x"), F.lit("exon"), "start", "end", F.lit("."), F.when(F.col("tr") % 2 == 0, "+").otherwise("-"), F.lit("."), text).alias("value"))
    other = e.select(F.concat_ws("\t", "chr", F.lit("x"), F.lit("CDS"), "start", "end", F.lit("."), F.lit("+"), F.lit("."), text).alias("value"))
    path = shared_path(spark, "annotation")
    exon.unionAll(other).unionAll(spark.createDataFrame([("#!made",)], "value string")).write.text(path)
    return A.gene_tables(readers.read_gtf(spark, path))


def gtf_transcripts(spark, d):
    t = gtf_rows(spark, d)
    own = t["exons"].groupBy("t").agg(F.max("before").alias("last"), F.max("exon").alias("exon"))
    return t["transcripts"].join(t["genes"].select("gene", "gene_name", "gene_type"), "gene").join(own, "t").select("t", "tr", "g", "gene", "gene_name", "gene_type", "chr", "strand", "start", "end", "reach", "n_exons", "last", "exon")


GTF = duck("exons") + """, e as (select distinct 't' || tr tr, case when gene % 10 > 0 then 'g' || gene else 't' || tr end gene, case when gene % 2 = 0 then 'n' || gene when gene % 10 > 0 then 'g' || gene else 't' || tr end gn, case when gene % 3 = 0 then 'coding' else '' end gt, 'c' || (tr % 7) chr, case when tr % 2 = 0 then '+' else '-' end strand, es s, ee e from exons),
g as (select gene, min(gn) gene_name, min(gt) gene_type, row_number() over (order by gene) - 1 g from e group by gene),
t as (select tr, gene, chr, strand, min(s) "start", max(e) "end", count(*) n_exons from e group by all),
u as (select *, row_number() over (order by chr, "start", "end", tr) - 1 t, max("end") over (partition by chr order by "start", "end", tr rows unbounded preceding) reach from t),
x as (select tr, sum(e - s + 1) over (partition by tr order by s, e rows between unbounded preceding and 1 preceding) b, row_number() over (partition by tr order by s, e) - 1 n from e),
y as (select tr, cast(coalesce(max(b), 0) as bigint) "last", cast(max(n) as int) exon from x group by tr)
select cast(t as int) t, tr, cast(g as int) g, gene, gene_name, gene_type, chr, strand, "start", "end", reach, n_exons, "last", exon from u join g using (gene) join y using (tr)""".replace("group by all", "group by tr, gene, chr, strand")


def junction_file(spark, d):
    """Junctions written as a table and read again, with their motifs' strands."""
    j = J.collapse(J.emit(derived(spark, d, "junction_obs"), KEYS))
    starts = spark.range(12).select(F.concat(F.lit("c"), F.col("id")).alias("chr"), (F.col("id") * 20_000).alias("chr_start"), F.lit(20_000).cast("long").alias("chr_length"))
    path = shared_path(spark, "junctions")
    writers.junction_table(j, starts).write.text(path)
    return readers.read_junctions(spark, path)


JUNCTIONS = duck("junction_obs") + """, c as (select start, gap, min(motif) motif from junction_obs group by 1, 2)
select 'c' || (start // 20000) chr, start % 20000 + 1 start, start % 20000 + gap "end", case when motif = 0 then 0 else 2 - motif % 2 end strand from c where start < 240000"""


def vcf(spark, d):
    s = derived(spark, d, "snps")
    base = lambda c: F.element_at(F.array(*map(F.lit, "ACGT")), F.col(c) + 1)
    kind = F.col("pos") % 5
    alt = F.when(kind == 0, F.concat(base("a1"), F.lit(","), base("a2"))).when(kind == 1, F.lit("TTG")).otherwise(base("a1"))
    call = F.when(kind == 0, "1|2:9").when(kind == 2, "0/0").when(kind == 3, "1/1").otherwise("0|1")
    line = F.concat_ws("\t", F.concat(F.lit("c"), F.col("chr")), "pos", F.lit("."), base("ref"), alt, F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT:DP"), call)
    path = shared_path(spark, "variants")
    s.select(line.alias("value")).unionAll(spark.createDataFrame([("##fileformat=VCFv4.2",)], "value string")).write.text(path)
    return readers.read_vcf(spark, path)


VCF = duck("snps") + """, s as (select 'c' || chr chr, pos, substr('ACGT', ref + 1, 1) ref, substr('ACGT', a1 + 1, 1) x, substr('ACGT', a2 + 1, 1) y, pos % 5 k from snps)
select chr, pos, ref, case k when 0 then x when 3 then x else ref end a1, case k when 0 then y else x end a2 from s where k not in (1, 2) and not (case k when 0 then x when 3 then x else ref end = ref and case k when 0 then y else x end = ref)"""


def chains(spark, d):
    """Chains of three blocks each."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("p"), F.col("p_size").alias("n"))
    line = F.concat(F.lit("chain 9 c"), F.col("p") % 3, F.lit(" 99999 + "), F.col("p") * 1000, F.lit(" "), F.col("p") * 1000 + 900, F.lit(" d 99999 + "), F.col("p") * 1100, F.lit(" 0 "), F.col("p"), F.lit("\n"), F.col("n") + 10, F.lit(" 5 7\n"), F.col("n") + 20, F.lit("\t0\t3\n"), F.lit(30), F.lit("\n"))
    path = shared_path(spark, "chains")
    p.select(line.alias("value")).write.text(path)
    return readers.read_chain(spark, path)


CHAINS = """with p as (select p_partkey p, p_size n from part), b as (select p, n, unnest([0, 1, 2]) i from p)
select 'c' || (p % 3) chr, 'd' chr2, cast(p * 1000 + case i when 0 then 0 when 1 then n + 15 else 2 * n + 35 end as bigint) s1, cast(p * 1100 + case i when 0 then 0 when 1 then n + 17 else 2 * n + 40 end as bigint) s2, cast(case i when 0 then n + 10 when 1 then n + 20 else 30 end as bigint) len from b"""


def position_maps(spark, d):
    """The chip's map as text, records and Parquet, read again."""
    chip = derived(spark, d, "chip_map").select("barcode", "x", "y")
    out = None
    for kind in ("txt", "bin", "parquet"):
        path = f"{shared_path(spark, 'map')}.{kind}"
        writers.position_map(chip, path)
        got = readers.read_position_map(spark, path).select(F.lit(kind).alias("kind"), "barcode", "x", "y")
        out = got if out is None else out.unionByName(got)
    return out


def count_files(spark, d):
    """Barcode counts as text and as records, read again, with the number of those seen once."""
    n = derived(spark, d, "reads").where("n_pos < 0").groupBy("barcode").agg(F.count("*").alias("n"))
    out = None
    for kind in ("txt", "bin"):
        path = f"{shared_path(spark, 'counts')}.{kind}"
        writers.counts(n, path)
        got = readers.read_counts(spark, path)
        one = got.withColumns({"kind": F.lit(kind), "singles": F.lit(readers.singles(got))})
        out = one if out is None else out.unionByName(one)
    return out


COUNTS = duck("reads") + """, c as (select barcode, count(*) n from reads where n_pos < 0 group by barcode) select unnest(['txt', 'bin']) kind, barcode, n, (select count_if(n = 1) from c) singles from c"""


def records(spark, d):
    b = derived(spark, d, "blocks").where("b = 0")
    text = seq.decode(F.pmod(F.expr(code_of("k3")) - 57_885_161, F.lit(1 << 50)), 25)
    placed = F.col("k4") % 6 > 0
    return b.select(
        name().alias("qname"), F.when(placed, F.col("str") * 16).otherwise(4).cast("int").alias("flag"), F.when(placed, F.concat(F.lit("c"), F.col("chr"))).otherwise("*").alias("rname"), F.when(placed, F.col("bs") + 1).otherwise(0).alias("pos"),
        F.when(placed, F.when(F.col("nh") == 1, 255).otherwise(1)).otherwise(0).cast("int").alias("mapq"), F.when(placed, F.concat(F.lit("3S10M"), F.col("k2") * 7, F.lit("N12M"))).otherwise("*").alias("cigar"),
        F.when(placed, F.when(F.col("k2") % 2 == 0, "=").otherwise("*")).otherwise("*").alias("rnext"), F.when(placed & (F.col("k2") % 2 == 0), F.col("bend")).otherwise(0).alias("pnext"), (F.col("k2") * 3).cast("long").alias("tlen"), text.alias("seq"), F.repeat(F.lit("F"), F.lit(25)).alias("qual"), F.when(placed, F.col("nh")).cast("int").alias("nh"), F.concat_ws("_", "k2", "k4").alias("cb"),
    )


RECORDS = duck("blocks") + f""", r as (select {NAME} qname, k4 % 6 > 0 ok, *, (k3 * 98245165300007) % 1125899906842624 code from blocks where b = 0),
s as (select qname, cast(case when ok then str * 16 else 4 end as int) flag, case when ok then 'c' || chr else '*' end rname, case when ok then bs + 1 else 0 end pos, case when ok then case when nh = 1 then 255 else 1 end else 0 end mapq, case when ok then '3S10M' || k2 * 7 || 'N12M' else '*' end cigar,
  case when ok and k2 % 2 = 0 then '=' else '*' end rnext, case when ok and k2 % 2 = 0 then bend else 0 end pnext, cast(k2 * 3 as bigint) tlen, {DECODED.format(n=25, c='code')} seq, repeat('F', 25) qual, case when ok then cast(nh as varchar) end nh, k2 || '_' || k4 cb, bs, k2 gap, ok from r)"""
FIELDS = "qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, nh, cb"


def sam_files(spark, d):
    path = shared_path(spark, "sam")
    writers.write_lines(writers.sam(records(spark, d), {"nh": "NH:i", "cb": "CB:Z"}), path, writers.sam_header([(f"c{i}", 1 << 29) for i in range(5)]))
    got = readers.read_sam(spark, f"{path}/body")
    return got.select(*[c for c in got.columns if c != "tags"], F.col("tags")["NH"].alias("nh"), F.col("tags")["CB"].alias("cb"))


def bam_files(spark, d):
    """Rows as BAM parts by place, put together in one file, and read again, with their bins."""
    path = shared_path(spark, "bam")
    rows, names = records(spark, d), [(f"c{i}", 1 << 29) for i in range(5)]
    bam.write_bam(rows, path, names, writers.sam_header(names), {"nh": "NH", "cb": "CB"}, True)
    bam.concatenate(path, f"{path}-whole.bam")
    got = bam.read_bam(spark, f"{path}-whole.bam")
    expected = F.when(F.col("pos") > 0, seq.reg2bin(F.col("pos") - 1, F.col("pos") - 1 + 22 + F.regexp_extract("cigar", r"(\d+)N", 1).cast("long"))).otherwise(4680)
    return got.select(*[c for c in got.columns if c not in ("tags", "bin")], F.col("tags")["NH"].alias("nh"), F.col("tags")["CB"].alias("cb"), (F.col("bin") == expected).alias("bin_fits"))


def index_files(spark, d):
    path = shared_path(spark, "index")
    index.write_index({"junctions": J.collapse(J.emit(derived(spark, d, "junction_obs"), KEYS)), "genes": derived(spark, d, "genes")}, path, {"bits": 18})
    tables, parameters = index.read_index(spark, path)
    return tables["junctions"].join(tables["genes"].groupBy().agg(F.count("*").alias("genes"))).select("start", "gap", "uniq", "multi", "genes", F.lit(parameters["bits"]).alias("bits"))


INDEX = duck("junction_obs", "genes") + f""", e as (select {K}, start, gap, max(nh) nh from junction_obs group by {K}, start, gap) select start, gap, count_if(nh = 1) uniq, count_if(nh > 1) multi, (select count(*) from genes) genes, 18 bits from e group by start, gap"""


def count_lines(spark, d):
    """The lines of the gene table and of the signal."""
    from .genome_queries import gene_counts

    genes = writers.gene_counts(gene_counts(spark, d)).select(F.lit("genes").alias("kind"), F.split("value", "\t").alias("v"))
    signal = writers.bedgraph(Q.signal(derived(spark, d, "blocks"), False).where("kind = 'all'")).select(F.lit("signal").alias("kind"), F.split("value", "\t").alias("v"))
    return genes.unionAll(signal).select("kind", *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(4)])


def _lines() -> str:
    from .genome_queries import GENES

    head, tail = GENES.rsplit("\nselect ", 1)
    return f"""{head}, q as (select {tail}),
w as (select chr, bs, bend, cast(round(2 * {Q.SCALE // 2}.0 / nh) as bigint) w from blocks), s as (select chr, p, sum(w) dd from (select chr, bs p, w from w union all select chr, bend + 1, -w from w) group by chr, p having sum(w) <> 0),
z as (select chr, p, lead(p) over (partition by chr order by p) e, sum(dd) over (partition by chr order by p) v from s)
select 'genes' kind, case gene_id when -3 then 'N_multimapping' when -2 then 'N_ambiguous' when -1 then 'N_noFeature' else cast(gene_id as varchar) end v0, cast("none" as varchar) v1, cast(same as varchar) v2, cast(reverse as varchar) v3 from q
union all select 'signal', cast(chr as varchar), cast(p as varchar), cast(e as varchar), printf('%.5f', cast(v as double) / {Q.SCALE}) from z where v <> 0"""


# --- the genome's index --------------------------------------------------------------------------

DEPTH, WIDTH = 12, 4096


def halves(spark, d):
    h = A.both_halves(chromosomes(spark, d))
    return h.select(F.concat_ws(":", "chr", "half").alias("chr"), "seq")


HALVES = GENOME + """, h as (select chr || ':0' chr, seq from g union all select chr || ':1', reverse(translate(seq, 'ACGT', 'TGCA')) from g)"""
SUFFIXES = HALVES + """, p as (select chr, unnest(range(0, length(seq), 4)) pos, seq from h), s as (select substr(seq, pos + 1, 12) suffix, chr, pos from p)"""


def suffixes(spark, d):
    rows = A.suffix_table(A.genome_bins(halves(spark, d), WIDTH, DEPTH), WIDTH, DEPTH, 4)
    return A.ranked(rows, shared_path(spark, "suffixes"))


def more_suffixes(spark, d):
    """The ranked table with the suffixes of the junctions' flanks put in."""
    more = flanks(spark, d).select(F.concat(F.lit("sj"), F.col("gene_id")).alias("chr"), F.col("flank").alias("seq"))
    extra = A.suffix_table(A.genome_bins(more, WIDTH, DEPTH), WIDTH, DEPTH, 4)
    return A.insert_suffixes(suffixes(spark, d), extra, shared_path(spark, "suffixes"))


def prefixes(spark, d):
    i = A.prefix_index(suffixes(spark, d), 5)
    none = A.absent_prefixes(i, 5).select(F.lit(-5).alias("level"), "prefix", F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(False).alias("unknown"))
    return i.unionByName(none)


PREFIXES = SUFFIXES + """, r as (select *, row_number() over (order by suffix, chr, pos) - 1 rank from s), l as (select rank, suffix, unnest(range(1, 6)) level from r),
k as (select level, substr(suffix, 1, level) prefix, min(rank) f, max(rank) z, count(*) n from l where length(suffix) >= level group by 1, 2),
u as (select k.level, k.prefix, f, z, k.level < 5 and coalesce((select sum(n) from k j where j.level = k.level + 1 and starts_with(j.prefix, k.prefix)), 0) < z - f + 1 unknown from k)
select cast(level as int) "level", prefix, f "first", z "last", unknown from u union all
select -5, x.p, -1, -1, false from (select a.c || b.c || e.c || f.c || g.c p from (select unnest(['A', 'C', 'G', 'T']) c) a, (select unnest(['A', 'C', 'G', 'T']) c) b, (select unnest(['A', 'C', 'G', 'T']) c) e, (select unnest(['A', 'C', 'G', 'T']) c) f, (select unnest(['A', 'C', 'G', 'T']) c) g) x where x.p not in (select prefix from k where level = 5)"""


def introns(spark, d):
    n = F.col("gene_id")
    place = derived(spark, d, "genes").select("gene_id", F.concat(F.lit("c"), n % 5).alias("chr"), (n * 7 % 900).alias("start"), (n * 7 % 900 + 30 + n % 50).alias("end"))
    return place.join(chromosomes(spark, d).select("chr", F.length("seq").alias("size")), "chr").where(F.col("end") + 5 < F.col("size")).drop("size")


INTRONS = GENOME + """, i as (select p_partkey gene_id, 'c' || (p_partkey % 5) chr, p_partkey * 7 % 900 s, p_partkey * 7 % 900 + 30 + p_partkey % 50 e from part), j as (select i.*, seq from i join g using (chr) where e + 5 < length(seq))"""


def shifts(spark, d):
    out = A.shifts(introns(spark, d), A.genome_bins(chromosomes(spark, d), WIDTH, 255), WIDTH, 255)
    return out.withColumn("strand", A.strand_of(F.col("motif"))).select("gene_id", "motif", "strand", "shift_left", "shift_right")


SHIFTS = INTRONS + """, m as (select *, substr(seq, s + 1, 2) || substr(seq, e - 1, 2) q,
  coalesce(list_min(list_filter(range(0, least(s, e)), lambda k: substr(seq, s - k, 1) <> substr(seq, e - k, 1))), least(s, e)) l,
  coalesce(list_min(list_filter(range(0, least(255, length(seq) - e)), lambda k: substr(seq, s + 1 + k, 1) <> substr(seq, e + 1 + k, 1))), least(255, length(seq) - e)) r from j),
n as (select *, case q when 'GTAG' then 1 when 'CTAC' then 2 when 'GCAG' then 3 when 'CTGC' then 4 when 'ATAC' then 5 when 'GTAT' then 6 else 0 end motif from m)
select gene_id, motif, case when motif = 0 then 0 else 2 - motif % 2 end strand, cast(least(l, 255) as int) shift_left, cast(r as int) shift_right from n"""


def flanks(spark, d):
    return A.flanks(introns(spark, d), A.genome_bins(chromosomes(spark, d), WIDTH, 20), WIDTH, 20)


FLANKS = INTRONS + """, f as (select gene_id, substr(seq, greatest(s - 20, 0) + 1, s - greatest(s - 20, 0)) || substr(seq, e + 1, 20) flank from j)"""


def choices(spark, d):
    f = flanks(spark, d).where("length(flank) > 12").withColumn("snps", F.expr("filter(array(struct(2 as offset, 'A' as a1, 'C' as a2), struct(cast(5 + gene_id % 4 as int) as offset, 'G' as a1, 'T' as a2)), x -> gene_id % 3 > 0 or x.offset = 2)"))
    return A.allele_choices(f).select("gene_id", "choice", "variant")


CHOICES = FLANKS + """, c as (select gene_id, flank, 5 + gene_id % 4 o, gene_id % 3 > 0 two from f where length(flank) > 12), d as (select *, unnest(case when two then [0, 1, 2, 3] else [0, 1] end) choice from c),
e as (select *, substr(flank, 1, 2) || case when choice % 2 = 0 then 'A' else 'C' end || substr(flank, 4) v from d)
select gene_id, choice, case when two then substr(v, 1, cast(o as int)) || case when choice // 2 = 0 then 'G' else 'T' end || substr(v, cast(o + 2 as int)) else v end variant from e"""


def clips(spark, d):
    """Reads of 40 bases whose clipped ends are the genome's, turned round."""
    from ..operators import remap

    n, lead, tail = F.col("p_partkey"), (F.col("p_partkey") % 6).cast("int"), (F.col("p_partkey") % 4).cast("int")
    at = (n * 7 % 900).cast("int")
    rows = table(spark, d, "part").select(n.alias("read"), F.concat(F.lit("c"), n % 5).alias("chr"), at.alias("s"), lead.alias("a"), tail.alias("b")).join(chromosomes(spark, d), "chr").where(F.col("s") + 40 <= F.length("seq"))
    cut = lambda start, size: F.substring("seq", start + 1, size)
    bases = F.concat(F.reverse(cut(F.col("s"), F.col("a"))), cut(F.col("s") + F.col("a"), 40 - F.col("a") - F.col("b")), F.reverse(cut(F.col("s") + 40 - F.col("b"), F.col("b"))))
    clip = lambda c: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit("S"))).otherwise("")
    made = rows.select("read", "chr", (F.col("s") + F.col("a") + 1).cast("long").alias("pos"), F.concat(clip("a"), (40 - F.col("a") - F.col("b")).cast("string"), F.lit("M"), clip("b")).alias("cigar"), (F.col("read") % 3).cast("int").alias("mismatches"), bases.alias("seq"), F.lit(1).alias("nh"))
    return remap.extend_clips(made, A.genome_bins(chromosomes(spark, d), WIDTH, 100), WIDTH, 4).select("read", "chr", "pos", "cigar", "mismatches")


CLIPS = GENOME + """, r as (select p_partkey "read", 'c' || (p_partkey % 5) chr, p_partkey * 7 % 900 s, cast(p_partkey % 6 as int) a, cast(p_partkey % 4 as int) b from part), q as (select r.*, seq from r join g using (chr) where s + 40 <= length(seq)),
m as (select *, cast("read" % 3 + len(list_filter(range(0, a), lambda i: substr(seq, s + a - i, 1) <> substr(seq, s + 1 + i, 1))) + len(list_filter(range(0, b), lambda i: substr(seq, s + 40 - i, 1) <> substr(seq, s + 41 - b + i, 1))) as int) mismatches from q)
select "read", chr, s + 1 pos, '40M' cigar, mismatches from m where mismatches <= 4"""


def consensus(spark, d):
    bins = A.genome_bins(chromosomes(spark, d), 500, 0)
    v = derived(spark, d, "snps").select(F.concat(F.lit("c"), (F.col("pos") % 5)).alias("chr"), (F.expr("pos div 5") % 900).alias("pos"), F.element_at(F.array(*map(F.lit, "ACGT")), F.col("ref") + 1).alias("ref")).distinct().withColumn("alt", F.lit("N"))
    return A.apply_consensus(bins, v.groupBy("chr", "pos").agg(F.min("ref").alias("ref"), F.min("alt").alias("alt")), 500)


CONSENSUS = GENOME + f""", t as ({{snps}}), v as (select 'c' || (pos % 5) chr, pos // 5 % 900 p, min(substr('ACGT', ref + 1, 1)) ref from t group by 1, 2),
b as (select chr, seq whole, unnest(range(0, greatest((length(seq) + 499) // 500, 1))) bin from g), x as (select chr, cast(bin as int) bin, i, substr(whole, bin * 500 + i + 1, 1) c from (select *, unnest(range(0, 500)) i from b) where bin * 500 + i < length(whole)),
y as (select x.*, ref from x left join v on v.chr = x.chr and v.p = x.bin * 500 + x.i), z as (select chr, bin, string_agg(case when ref = c then 'N' else c end, '' order by i) seq, count_if(coalesce(ref = c, false)) replaced, count_if(coalesce(ref <> c, false)) m from y group by chr, bin),
o as (select chr, p // 500 bin, count(*) n from v join g using (chr) where p // 500 < greatest((length(seq) + 499) // 500, 1) group by 1, 2)
select z.chr, z.bin, seq, cast(replaced as int) replaced, cast(coalesce(o.n, 0) - replaced as int) mismatches from z left join o on o.chr = z.chr and o.bin = z.bin"""


def _consensus() -> str:
    from .fixtures import duck_text

    return CONSENSUS.replace("{snps}", duck_text("snps"))


QUERIES = {
    "fasta_chromosomes": (fasta, FASTA),
    "gtf_transcripts": (gtf_transcripts, GTF),
    "junction_file": (junction_file, JUNCTIONS),
    "vcf_variants": (vcf, VCF),
    "chain_file": (chains, CHAINS),
    "position_map_files": (position_maps, duck("chip_map") + " select unnest(['txt', 'bin', 'parquet']) kind, barcode, x, y from chip_map"),
    "barcode_count_files": (count_files, COUNTS),
    "sam_files": (sam_files, RECORDS + f" select {FIELDS} from s"),
    "bam_files": (bam_files, RECORDS + f" select {FIELDS}, true bin_fits from s"),
    "index_files": (index_files, INDEX),
    "table_lines": (count_lines, _lines()),
    "suffix_ranks": (suffixes, SUFFIXES + " select suffix, chr, pos, row_number() over (order by suffix, chr, pos) - 1 rank from s"),
    "suffix_insertion": (more_suffixes, SUFFIXES + FLANKS.replace(GENOME, "") + """, q as (select 'sj' || gene_id chr, flank, unnest(range(0, length(flank), 4)) pos from f), a as (select * from s union all select substr(flank, pos + 1, 12), chr, pos from q)
select suffix, chr, pos, row_number() over (order by suffix, chr, pos) - 1 rank from a"""),
    "prefix_index": (prefixes, PREFIXES),
    "junction_shifts": (shifts, SHIFTS),
    "junction_flanks": (lambda s, d: flanks(s, d).select("gene_id", "flank"), FLANKS + " select gene_id, flank from f"),
    "flank_alleles": (choices, CHOICES),
    "clip_extension": (clips, CLIPS),
    "consensus_genome": (consensus, _consensus()),
}
