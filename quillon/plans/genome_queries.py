"""Queries on annotation, junctions, genes, coverage, duplicates and lift-over, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation as A
from ..operators import intervals as I
from ..operators import junctions as J
from ..operators import quant as Q
from .fixtures import LINE_KEYS, derived, duck, table

KEYS = ["k1", "k2", "k3", "k4", "k5"]
K = "k1, k2, k3, k4, k5"


# --- annotation ----------------------------------------------------------------------------------


def gtf_junctions(spark, d):
    return J.from_exons(derived(spark, d, "exons")).select("start", "end", F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"))


GTF = duck("exons") + """, l as (select gene, es, lag(ee) over (partition by tr order by es, ee) p from exons)
select p + 1 start, es - 1 "end", array_to_string(list_sort(list_distinct(list(gene))), ',') genes from l where es > p + 1 group by all"""
GTF = GTF.replace(" group by all", " group by 1, 2")


def junction_sources(spark, d):
    """Junctions of three sources at few places, strands and motifs."""
    li = table(spark, d, "lineitem")
    return li.select(
        (F.col("l_partkey") % 5).alias("chr"), (F.col("l_partkey") % 400 * 100).alias("start"), (F.col("l_partkey") % 400 * 100 + 50).alias("end"), (F.col("l_orderkey") % 3).cast("int").alias("strand"),
        F.element_at(F.array(F.lit(0), F.lit(10), F.lit(20), F.lit(30)), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("priority"), (F.col("l_linenumber") % 7).cast("int").alias("motif"), (F.col("l_orderkey") % 11).cast("int").alias("shift_left"),
    )


def dedupe(spark, d):
    return J.dedupe(junction_sources(spark, d))


DEDUPE = """with j as (select l_partkey % 5 chr, l_partkey % 400 * 100 start, l_partkey % 400 * 100 + 50 "end", cast(l_orderkey % 3 as int) strand, [0, 10, 20, 30][cast(l_suppkey % 4 + 1 as int)] priority, cast(l_linenumber % 7 as int) motif, cast(l_orderkey % 11 as int) shift_left from lineitem),
o as (select * from j qualify row_number() over (partition by chr, start, "end", strand order by priority desc, cast(motif > 0 as int) desc, shift_left, motif) = 1),
p as (select *, max(priority) over (partition by chr, start, "end") top from o),
r as (select *, sum(case when priority = top and strand > 0 then 1 else 0 end) over (partition by chr, start, "end") > 1 tie, max(case when priority = top and motif > 0 then 1 else 0 end) over (partition by chr, start, "end") > 0 anyc,
 row_number() over (partition by chr, start, "end" order by priority desc, cast(strand > 0 as int) desc, case when motif = 0 then 0 when strand = 2 - motif % 2 then 1 else 0 end desc, cast(motif > 0 as int) desc, shift_left, strand) rn from p)
select chr, start, "end", case when tie and not anyc then 0 else strand end strand, priority, motif, shift_left from r where rn = 1"""


def exon_lengths(spark, d):
    return A.exon_lengths(derived(spark, d, "exons"), ties=("o_orderkey",)).select("tr", "o_orderkey", "exon", "before", "reach")


EXONS = duck("exons") + """ select tr, o_orderkey, cast(row_number() over w as int) exon, cast(coalesce(sum(ee - es + 1) over (w rows between unbounded preceding and 1 preceding), 0) as bigint) "before", max(ee) over (w rows unbounded preceding) reach from exons window w as (partition by tr order by es, ee, o_orderkey)"""


def gene_spans(spark, d):
    return A.spans(derived(spark, d, "exons").withColumn("chr", F.col("tr") % 3), "gene", group=("chr",))


SPANS = duck("exons") + """, s as (select tr % 3 chr, gene, min(es) start, max(ee) "end", count(*) exons from exons group by 1, 2) select *, max("end") over (partition by chr order by start, gene) reach from s"""


def kmer_index(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("chr"), F.translate("text", "acgtu", "ACGTT").alias("t"))
    bins = A.genome_bins(docs.select("chr", F.regexp_replace("t", "[^ACGT]", "N").alias("seq")), 4096, 5)
    return A.kmer_counts(bins, 4096, 4).select("kmer", "n", F.col("first.chr").alias("chr"), F.col("first.pos").alias("pos"))


KMERS = """with t as (select doc_id chr, regexp_replace(translate(text, 'acgtu', 'ACGTT'), '[^ACGT]', 'N', 'g') seq from documents),
k as (select chr, i pos, substr(seq, i + 1, 4) kmer from (select chr, seq, unnest(range(0, length(seq) - 3)) i from t)),
g as (select kmer, count(*) n, min((chr, pos)) f from k where not regexp_matches(kmer, '[^ACGT]') group by kmer)
select kmer, n, struct_extract(f, 1) chr, struct_extract(f, 2) pos from g"""


# --- junctions -----------------------------------------------------------------------------------


def collapsed(spark, d):
    return J.collapse(J.emit(derived(spark, d, "junction_obs"), KEYS))


EMIT = duck("junction_obs") + f""", e as (select {K}, start, gap, max(motif) motif, max(annot) annot, max(nh) nh, max(overhang) overhang from junction_obs group by all),
c as (select start, gap, min(motif) motif, min(annot) annot, count_if(nh = 1) uniq, count_if(nh > 1) multi, max(overhang) overhang from e group by start, gap)"""
EMIT = EMIT.replace("from junction_obs group by all", f"from junction_obs group by {K}, start, gap")
ONE = EMIT + """, f1 as (select *, cast((motif + 1) // 2 as int) k, uniq + multi t from c),
g1 as (select * from f1 where annot = 1 or ((uniq >= [3, 1, 1, 1][k + 1] or t >= [3, 1, 1, 1][k + 1]) and overhang >= [30, 12, 12, 12][k + 1] and (t > 3 or gap <= [50000, 100000, 200000][cast(t as int)])))"""
TWO = ONE + """, dn as (select *, least(start - coalesce(lag(start) over w, 0), coalesce(lead(start) over w, 9223372036854775807) - start) dd from g1 window w as (order by start)),
an as (select *, least(start + gap - coalesce(lag(start + gap) over w, 0), coalesce(lead(start + gap) over w, 9223372036854775807) - start - gap) ad from dn window w as (order by start + gap)),
g2 as (select start, gap, motif, annot, uniq, multi, overhang from an where annot = 1 or (dd >= [10, 0, 5, 10][k + 1] and ad >= [10, 0, 5, 10][k + 1]))"""


def filtered(spark, d):
    return J.keep_distant(J.keep_supported(collapsed(spark, d)))


def bysjout(spark, d):
    seen = derived(spark, d, "junction_obs")
    return J.keep_by_junctions(seen.select(*KEYS).distinct(), seen, filtered(spark, d), KEYS)


def snp_overlap(spark, d):
    """Variants under unique reads' blocks: the read's base is made of its keys."""
    blocks = derived(spark, d, "blocks").where("nh = 1").select(*KEYS, "chr", "b", F.col("bs").alias("a_start"), F.col("bend").alias("a_end"))
    snps = derived(spark, d, "snps").select("chr", F.col("pos").alias("b_start"), F.col("pos").alias("b_end"), "ref", "a1", "a2")
    met = I.overlap_join(blocks, snps, ["chr"], 50_000).withColumn("base", ((F.col("k1") + F.col("k4")) % 5).cast("int"))
    allele = F.when(F.col("base") == 4, 4).when(F.col("base") == F.col("a1"), 1).when(F.col("base") == F.col("a2"), 2).otherwise(3)
    return met.select(*KEYS, "b", F.col("b_start").alias("pos"), (F.col("b_start") - F.col("a_start")).alias("offset"), allele.alias("allele"))


SNP = duck("blocks", "snps") + f""" select {K}, b, pos, pos - bs "offset", case when (k1 + k4) % 5 = 4 then 4 when (k1 + k4) % 5 = a1 then 1 when (k1 + k4) % 5 = a2 then 2 else 3 end allele
from blocks join snps on blocks.chr = snps.chr and pos between bs and bend where nh = 1"""


# --- genes, coverage, duplicates, lift-over ------------------------------------------------------


def gene_counts(spark, d):
    return Q.gene_counts(derived(spark, d, "blocks"), derived(spark, d, "gene_exons"), KEYS)


GENES = duck("blocks", "gene_exons") + f""", genes as (select distinct gene_id from gene_exons), h as (select distinct {K}, gene_id, strand, str from blocks b join gene_exons g on b.chr = g.chr and bs <= ge and gs <= bend where nh = 1),
u as (select distinct {K} from blocks where nh = 1), m as (select unnest(['none', 'same', 'reverse']) m),
f as (select {K}, m, gene_id from h, m where m = 'none' or strand = 0 or (m = 'same' and strand = str + 1) or (m = 'reverse' and strand = 2 - str)),
p as (select {K}, m, min(gene_id) lo, max(gene_id) hi from f group by {K}, m),
a as (select m.m, case when lo is null then -1 when lo <> hi then -2 else lo end gene_id from u cross join m left join p on p.m = m.m and p.k1 = u.k1 and p.k2 = u.k2 and p.k3 = u.k3 and p.k4 = u.k4 and p.k5 = u.k5
  union all select m.m, -3 from (select distinct {K} from blocks where nh > 1) cross join m),
n as (select gene_id from genes union all select unnest([-1, -2, -3]))
select gene_id, count_if(coalesce(m = 'none', false)) "none", count_if(coalesce(m = 'same', false)) same, count_if(coalesce(m = 'reverse', false)) reverse from n left join a using (gene_id) group by gene_id"""


def full_overlap(spark, d):
    return Q.full_overlap(derived(spark, d, "blocks"), derived(spark, d, "genes"), KEYS).select(*KEYS, F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"))


FULL = duck("blocks", "genes") + f""" select {K}, array_to_string(list_sort(list_distinct(list(gene_id))), ',') genes from blocks b join genes g on b.chr = g.chr and bs <= ge and gs <= bend where strand = 0 or strand = str + 1 group by {K}"""


def projection(spark, d):
    """Alignments of the pieces, moved onto transcripts of three exons for each part, some of the other strand."""
    p = derived(spark, d, "pieces", LINE_KEYS).where("kind <> -9 or i = 2")
    one = F.struct("i", F.col("r").cast("bigint").alias("r"), F.col("g").alias("g"), F.col("len").alias("len"), "kind")
    rows = p.groupBy(*KEYS, (F.col("k3") % 5).alias("chr"), (F.col("k1") % 2).cast("int").alias("str"), "read_length").agg(F.sort_array(F.collect_list(one)).alias("x"))
    sign = lambda x: F.when(x.kind >= 0, "N").when(x.kind == -1, "D").when(x.kind == -2, "I").otherwise("P")
    rows = rows.select(*KEYS, "chr", "str", "read_length", F.transform("x", lambda x: F.struct(x.r.alias("r"), x.g.alias("g"), x.len.alias("len"))).alias("blocks"), F.transform(F.slice("x", 1, 2), sign).alias("gaps"))
    return Q.project(rows, transcripts(spark, d)).select(*KEYS, "tr", "t_str", F.array_join(F.transform("t_blocks", lambda b: F.concat_ws(":", b.r, b.t, b.len)), ",").alias("at"))


def transcripts(spark, d):
    return spark.sql(_spark_exons(), line=table(spark, d, "lineitem"), part=table(spark, d, "part"))


#: Exons that end and begin where some alignments' junctions do: of the alignments whose keys are the least of their part.
EXON_TEXT = """select k3 tr, cast(k3 % 5 as int) chr, cast(1 + k3 % 2 as int) tr_str, e.o, case e.o when 0 then k3 * 1000 - 20 when 1 then k3 * 1000 + k4 + l0 + 100 + k4 * 10 else k3 * 1000 + k4 + l0 + 160 + k4 * 10 + l1 + k2 * 10 end es,
  case e.o when 0 then k3 * 1000 + k4 + l0 - 1 when 1 then k3 * 1000 + k4 + l0 + 100 + k4 * 10 + l1 - 1 else k3 * 1000 + k4 + l0 + 160 + k4 * 10 + l1 + k2 * 10 + 300 end ee
from (select l_partkey k3, min(l_suppkey) k4, min(l_linenumber) k2, min(cast(3 + l_quantity as bigint) % 23 + 1) l0, min(cast(4 + l_linenumber * 3 as bigint)) l1 from LINE where l_suppkey * 100 + l_linenumber in (select 100 * s + n from (select l_suppkey s, 1 n from LINE) q) group by l_partkey) t
cross join (select 0 o union all select 1 o union all select 2 o) e"""


def _spark_exons() -> str:
    return EXON_TEXT.replace("LINE", "{line}")


PROJECT = duck("pieces") + f""", ex0 as ({EXON_TEXT.replace('LINE', 'lineitem')}), ex as (select tr, chr, tr_str, cast(o as int) o, es, ee, coalesce(sum(ee - es + 1) over (partition by tr order by es rows between unbounded preceding and 1 preceding), 0) bef, sum(ee - es + 1) over (partition by tr) tl from ex0),
a as (select {K}, k3 % 5 chr, k1 % 2 str, read_length, max(case when i = 0 then r end) r0, max(case when i = 1 then r end) r1, max(case when i = 2 then r end) r2, max(case when i = 0 then g end) g0, max(case when i = 1 then g end) g1, max(case when i = 2 then g end) g2,
  max(case when i = 0 then len end) l0, max(case when i = 1 then len end) l1, max(case when i = 2 then len end) l2, max(case when i = 0 then kind end) m0, max(case when i = 1 then kind end) m1 from pieces group by {K}, 6, 7, read_length),
c as (select a.*, tr, unnest([0, -1]) dd from a, (select 0 tr) z),
j as (select c.* exclude (tr, dd), k3 + dd tr from c),
f as (select j.*, tr_str, tl, o o0, es s0, ee e0, bef b0 from j join ex using (tr, chr) where g0 >= es and g0 + l0 - 1 <= ee),
s as (select f.*, x.o o1, x.es s1, x.ee e1, x.bef b1 from f join ex x on x.tr = f.tr where g1 >= x.es and g1 + l1 - 1 <= x.ee and
  case when m0 >= 0 then x.o = o0 + 1 and g0 + l0 - 1 = e0 and g1 = x.es when m0 = -3 then true else x.o = o0 end),
t as (select s.*, y.es s2, y.bef b2 from s join ex y on y.tr = s.tr where g2 >= y.es and g2 + l2 - 1 <= y.ee and
  case when m1 >= 0 then y.o = o1 + 1 and g1 + l1 - 1 = e1 and g2 = y.es when m1 = -3 then true else y.o = o1 end),
q as (select {K}, tr, tr_str, str, read_length, tl, r0, b0 + g0 - s0 t0, r1, b1 + g1 - s1 t1, r2, b2 + g2 - s2 t2, l0, l1, l2, m0 >= 0 n0, m1 >= 0 n1 from t),
l as (select *, case when n0 and n1 then [struct_pack(r := r0, t := t0, l := l0 + l1 + l2)] when n0 then [struct_pack(r := r0, t := t0, l := l0 + l1), struct_pack(r := r2, t := t2, l := l2)]
  when n1 then [struct_pack(r := r0, t := t0, l := l0), struct_pack(r := r1, t := t1, l := l1 + l2)] else [struct_pack(r := r0, t := t0, l := l0), struct_pack(r := r1, t := t1, l := l1), struct_pack(r := r2, t := t2, l := l2)] end b from q)
select {K}, tr, case when tr_str = 2 then 1 - str else str end t_str, array_to_string(case when tr_str = 1 then list_transform(b, lambda x: x.r || ':' || cast(x.t as bigint) || ':' || x.l) else list_reverse(list_transform(b, lambda x: (read_length - x.r - x.l) || ':' || cast(tl - x.t - x.l as bigint) || ':' || x.l)) end, ',') "at" from l"""


def many_loci(spark, d):
    """Blocks of reads of 1 to 26 loci."""
    return derived(spark, d, "blocks").withColumn("nh", F.when(F.col("nh") > 1, F.col("k4") % 25 + 2).otherwise(1))


def bedgraph(spark, d):
    return Q.signal(many_loci(spark, d))


def _signal(by: str, where: str = "true", events: str = "select chr, str, bs, bend, kind, w from n") -> str:
    return duck("blocks") + f""", m as (select * exclude (nh), case when nh > 1 then k4 % 25 + 2 else 1 end nh, 1 + k2 % 2 mate from blocks where {where}),
n as (select *, 'unique' kind, {Q.SCALE} w from m where nh = 1 union all select *, 'all', cast(round({Q.SCALE}.0 / nh) as bigint) from m), k as ({events}),
s as (select {by}, kind, p, sum(w) dd from (select {by}, kind, bs p, w from k union all select {by}, kind, bend + 1, -w from k) group by {by}, kind, p having sum(w) <> 0),
r as (select {by}, kind, p start, lead(p) over w "end", cast(sum(dd) over w as bigint) value from s window w as (partition by {by}, kind order by p))"""


BED = _signal("chr, str") + """ select chr, str, kind, start, "end", value from r where value <> 0"""


def rpm(spark, d):
    """Per million, of the chromosomes whose names begin with 1 or hold it."""
    blocks = many_loci(spark, d).withColumn("chr", F.col("chr") + 10 * ((F.col("chr") + 1) % 3))
    return Q.per_million(Q.signal(blocks, False, prefix="1"), blocks.where("b = 0"), prefix="1")


RPM = _signal("chr", "true", "select chr + 10 * ((chr + 1) % 3) chr, bs, bend, kind, w from n where cast(chr + 10 * ((chr + 1) % 3) as varchar) like '1%'") + f""", t as (select count_if(nh = 1) u, sum(case when nh > 1 then cast(round({Q.SCALE}.0 / nh) as bigint) else 0 end) v from m where b = 0 and cast(chr + 10 * ((chr + 1) % 3) as varchar) like '1%')
select chr, kind, start, "end", value, round(value / {Q.SCALE}.0 * 1e6 / case when kind = 'unique' then u else u + v / {Q.SCALE}.0 end, 6) rpm from r, t where value <> 0"""


def starts(spark, d):
    """The 5' bases of first mates, and second mates' blocks."""
    blocks = many_loci(spark, d).withColumn("mate", (F.col("k2") % 2 + 1).cast("int"))
    first = Q.signal(blocks, part="start", read=tuple(KEYS)).withColumn("part", F.lit("start"))
    return first.unionByName(Q.signal(blocks, part="second").withColumn("part", F.lit("second")))


STARTS = _signal("part, chr, str", "true", f"""select 'second' part, chr, str, bs, bend, kind, w from n where mate = 2 union all
  select 'start', chr, str, p, p, kind, w from (select {K}, chr, str, kind, w, case when str = 0 then min(bs) else max(bend) end p from n where mate = 1 group by all)""").replace("group by all", f"group by {K}, chr, str, kind, w") + ' select part, chr, str, kind, start, "end", value from r where value <> 0'


def wiggle(spark, d):
    """Bases of the signal, summed up by chromosome."""
    w = Q.wiggle(Q.signal(many_loci(spark, d), False))
    return w.groupBy("chr", "kind").agg(F.count("*").alias("bases"), F.sum("pos").alias("places"), F.sum(F.col("pos") % 97 * F.col("value") % 1_000_003).alias("worth"))


WIGGLE = _signal("chr") + """, b as (select chr, kind, value, unnest(range(start + 1, "end" + 1)) pos from r where value <> 0) select chr, kind, count(*) bases, cast(sum(pos) as bigint) places, cast(sum(pos % 97 * value % 1000003) as bigint) worth from b group by 1, 2"""


def duplicates(spark, d):
    """Pairs of few places, clips and flags; some without a place."""
    b = derived(spark, d, "blocks").where("b = 0")
    clip = lambda c: F.when(F.col(c) % 3 == 0, "4S26M").when(F.col(c) % 3 == 1, "30M").otherwise("2S20M100N6M2S")
    start = lambda c: F.when(F.col(c) % 3 == 0, 4).when(F.col(c) % 3 == 1, 0).otherwise(2)
    pairs = b.select(*KEYS, "chr", F.when(F.col("k2") < 7, F.col("k3") % 20 * 100 + start("k4")).alias("pos1"), clip("k4").alias("cigar1"), (F.lit(99) + F.col("k1") % 2 * 16).cast("int").alias("flag1"), (F.col("k3") % 20 * 100 + 300 + start("k2")).alias("pos2"), clip("k2").alias("cigar2"), (F.lit(147) - F.col("k1") % 2 * 16).cast("int").alias("flag2"), F.concat(F.repeat(F.lit("ACG"), F.lit(9)), F.when(F.col("k4") % 2 == 0, "TTT").otherwise("TTA")).alias("seq2"), (F.col("bend") - F.col("bs")).alias("score"), "nh")
    return Q.mark_duplicates(Q.pair_keys(pairs, 4), ["chr", *[f"key{i}" for i in range(1, 8)]], "score", KEYS, True).select(*KEYS, "key5", "duplicate")


DUPS = duck("blocks") + f""", p as (select {K}, chr, case when k2 < 7 then k3 % 20 * 100 end a, case when k4 % 3 = 2 then '22M100N8M' else '30M' end c1, k1 % 2 f, k3 % 20 * 100 + 300 z, case when k2 % 3 = 2 then '22M100N8M' else '30M' end c2, case when k1 % 2 = 1 then 'ACGA' when k4 % 2 = 0 then 'GTTT' else 'GTTA' end q, bend - bs score, nh from blocks where b = 0)
select {K}, c1 key5, nh > 1 or row_number() over (partition by chr, a, c1, f, z, c2, q order by score desc, {K}) > 1 duplicate from p"""


def lifted(spark, d):
    genes = derived(spark, d, "genes").select("gene_id", "chr", (F.col("gs") + 137 * (F.col("gene_id") % 9)).alias("s"), (F.col("ge") + 137 * (F.col("gene_id") % 9)).alias("e"))
    return Q.lift_over(genes, derived(spark, d, "chain_blocks")).fillna(-1, ["new_start", "new_end"])


LIFT = duck("genes", "chain_blocks") + """, g as (select gene_id, chr, gs + 137 * (gene_id % 9) s, ge + 137 * (gene_id % 9) e from genes),
a as (select g.*, (select max(s1) from chain_blocks c where c.chr = g.chr and s1 <= s) p, (select min(s1) from chain_blocks c where c.chr = g.chr and s1 > s) n, (select max(s1) from chain_blocks c where c.chr = g.chr and s1 <= e) q from g),
b as (select a.*, case when s < p + x.len then x.s2 + s - p else y.s2 end ns, case when e < q + z.len then z.s2 + e - q else z.s2 + z.len - 1 end ne from a
 left join chain_blocks x on x.chr = a.chr and x.s1 = p left join chain_blocks y on y.chr = a.chr and y.s1 = n left join chain_blocks z on z.chr = a.chr and z.s1 = q)
select chr, gene_id, s, e, case when ne >= ns then ns else -1 end new_start, case when ne >= ns then ne else -1 end new_end from b"""


def stats(spark, d):
    reads = derived(spark, d, "blocks").groupBy(*KEYS).agg(F.max(F.when(F.col("k2") == 7, 20).otherwise(F.col("nh"))).alias("nh"), F.sum(F.col("bend") - F.col("bs") + 1).alias("length"), F.max(F.col("k4") % 4).alias("mismatches"))
    return Q.final_stats(reads)


STATS = duck("blocks") + f""", r as (select {K}, max(case when k2 = 7 then 20 else nh end) nh, sum(bend - bs + 1) length, max(k4 % 4) mismatches from blocks group by {K}),
t as (select count(*) reads, count_if(nh = 1) "unique", count_if(nh > 1 and nh <= 10) multi, count_if(nh > 10) too_many, cast(sum(case when nh = 1 then length end) as bigint) bases, cast(sum(case when nh = 1 then mismatches end) as bigint) mismatches from r)
select *, round(100.0 * "unique" / reads, 2) unique_percent, round(bases / "unique", 4) mean_length, round(100.0 * mismatches / bases, 4) mismatch_percent from t"""

QUERIES = {
    "gtf_junctions": (gtf_junctions, GTF),
    "junction_dedupe_priority": (dedupe, DEDUPE),
    "transcript_exon_cumlen": (exon_lengths, EXONS),
    "gene_spans": (gene_spans, SPANS),
    "kmer_index": (kmer_index, KMERS),
    "junction_collapse": (collapsed, EMIT + " select * from c"),
    "junction_filter": (filtered, TWO + " select * from g2"),
    "bysjout_semijoin": (bysjout, TWO + f" select distinct {K} from junction_obs anti join (select distinct {K} from junction_obs anti join g2 using (start, gap)) using ({K})"),
    "snp_overlap": (snp_overlap, SNP),
    "gene_counts_3strand": (gene_counts, GENES),
    "gene_full_overlap": (full_overlap, FULL),
    "transcript_projection": (projection, PROJECT),
    "coverage_bedgraph": (bedgraph, BED),
    "coverage_rpm": (rpm, RPM),
    "mark_duplicates": (duplicates, DUPS),
    "coverage_parts": (starts, STARTS),
    "coverage_wiggle": (wiggle, WIGGLE),
    "liftover_asof": (lifted, LIFT),
    "final_stats": (stats, STATS),
}
