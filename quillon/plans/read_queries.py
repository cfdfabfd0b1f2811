"""Queries on alignments, cells and runs, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, cells, chimera, sam
from ..streaming import progress
from .fixtures import code_of, derived, duck, table

KEYS = ["k1", "k2", "k3", "k4", "k5"]
K = "k1, k2, k3, k4, k5"


def loci(spark, d):
    """Several loci of each order: its lines."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("read"), (F.col("l_partkey") % 7).alias("chr"), (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("pos"), (F.lit(90) - F.col("l_linenumber") % 3 - F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_suppkey") % 2)).cast("int").alias("score"), F.col("l_extendedprice").alias("x"))


LOCI = """with loci as (select l_orderkey "read", l_partkey % 7 chr, l_partkey * 1000 + l_suppkey pos, cast(90 - l_linenumber % 3 - case when l_returnflag = 'R' then 0 else l_suppkey % 2 end as int) score, l_extendedprice x from lineitem)"""


def multimappers(spark, d):
    return sam.select_loci(loci(spark, d), ["read"], 1, 4, ("chr", "pos", "x"))


MULTI = LOCI + """, a as (select *, max(score) over (partition by "read") top from loci), b as (select *, count(*) over (partition by "read") nh from a where score >= top - 1)
select "read", chr, pos, score, x, nh, cast(row_number() over (partition by "read" order by score desc, chr, pos, x) as int) hi, row_number() over (partition by "read" order by score desc, chr, pos, x) = 1 "primary" from b where nh <= 4"""


def reasons(spark, d):
    li = table(spark, d, "lineitem")
    length, n = F.lit(100), (F.col("l_partkey") % 13).cast("int")
    reason = sam.unmapped_reason(n, F.col("l_quantity") * 2, F.col("l_quantity") + 40, (F.col("l_suppkey") % 15).cast("int"), length)
    return li.select(F.coalesce(reason, F.lit("mapped")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


REASONS = """select case when l_partkey % 13 = 0 then 'other' when l_quantity * 2 < floor(99 * 0.66) or l_quantity + 40 < floor(99 * 0.66) then 'short' when l_suppkey % 15 > least(10, floor(100 * 0.3)) then 'mismatch' when l_partkey % 13 > 10 then 'multi' else 'mapped' end reason, count(*) n from lineitem group by 1"""


def flags(spark, d):
    b = derived(spark, d, "blocks").where("b = 0")
    bit = lambda c, m, r=0: F.col(c) % m == r
    flag = sam.flag(F.lit(True), bit("k4", 2), F.lit(False), bit("k3", 11), F.col("str") == 1, F.col("str") == 0, bit("k2", 2), bit("k4", 3), bit("k1", 17))
    return b.select(*KEYS, flag.alias("flag"), sam.mapq(F.col("nh")).alias("mapq")).groupBy("flag", "mapq").agg(F.count("*").alias("n"))


FLAGS = duck("blocks") + """ select cast(1 + case when k4 % 2 = 0 then 2 else 0 end + case when k3 % 11 = 0 then 8 else 0 end + case when str = 1 then 16 else 32 end + case when k2 % 2 = 0 then 64 else 128 end + case when k4 % 3 = 0 then 0 else 256 end + case when k1 % 17 = 0 then 1024 else 0 end as int) flag,
 cast(case nh when 1 then 255 when 2 then 3 when 3 then 1 when 4 then 1 else 0 end as int) mapq, count(*) n from blocks where b = 0 group by 1, 2"""


def sorted_rows(spark, d):
    b = derived(spark, d, "blocks").where("b = 0").select(*KEYS, F.when(F.col("k2") < 7, F.col("chr")).alias("chr"), F.when(F.col("k2") < 7, F.col("bs")).alias("bs"))
    return sam.coordinate_sort(b, ["chr", "bs", *KEYS]).fillna(-1, ["chr", "bs"])


def seeds(spark, d):
    """Seeds of a window: the lines of a part."""
    s = table(spark, d, "lineitem").select(F.col("l_partkey").alias("window"), F.col("l_quantity").cast("int").alias("length"), (F.col("l_suppkey") % 4 == 0).alias("anchor"), F.col("l_orderkey").alias("r_start"), F.col("l_extendedprice").alias("g_start"))
    return sam.seed_top(s, ["window"], 10)


SEEDS = """select "window", length, anchor, r_start, g_start from (select *, row_number() over (partition by "window" order by anchor desc, length desc, r_start, g_start) r, count_if(anchor) over (partition by "window") a
 from (select l_partkey "window", cast(l_quantity as int) length, l_suppkey % 4 = 0 anchor, l_orderkey r_start, l_extendedprice g_start from lineitem)) where r <= 10 and a <= 10"""


def windows(spark, d):
    """Anchors of an order's lines, some far apart, on a chromosome of 40 bins."""
    at = F.col("l_linenumber") * F.col("l_linenumber") * 61_000 + F.col("l_partkey") % 100 * 4_099 + F.col("l_suppkey") % 3 * 600_000
    anchors = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), (F.col("l_suppkey") % 2).alias("chr"), (F.col("l_partkey") % 2).alias("str"), at.alias("at"))
    return sam.windows(anchors, ["read", "chr", "str"], "at", last=F.lit(40) + F.col("chr"))


WINDOWS = """with a as (select l_orderkey "read", l_suppkey % 2 chr, l_partkey % 2 str, (l_linenumber * l_linenumber * 61000 + l_partkey % 100 * 4099 + l_suppkey % 3 * 600000) // 65536 b from lineitem),
n as (select *, case when b - max(b) over (partition by "read", chr, str order by b rows between unbounded preceding and 1 preceding) > 9 then 1 else 0 end n from a),
i as (select *, sum(n) over (partition by "read", chr, str order by b rows unbounded preceding) island from n)
select "read", chr, str, cast(island as bigint) island, greatest(min(b) - 4, 0) first_bin, least(max(b) + 4, 40 + chr) last_bin, count(*) anchors from i group by "read", chr, str, island"""


def dominated(spark, d):
    """Alignments of a window: orders of a customer, their blocks the parts they hold."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.col("l_partkey") % 5)).alias("blocks"))
    rows = li.join(table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("window")), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select("window", F.col("o_orderkey").alias("key"), "blocks", (F.size("blocks") * 10 + F.col("o_orderkey") % 3).alias("score"))
    return sam.drop_dominated(rows, ["window"], "key", "blocks", "score").select("window", "key", "score")


DOMINATED = """with r as (select o_custkey "window", o_orderkey "key", list_sort(list_distinct(list(l_partkey % 5))) blocks from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
s as (select *, len(blocks) * 10 + "key" % 3 score from r)
select "window", "key", score from s a where not exists (select 1 from s b where b."window" = a."window" and b."key" <> a."key" and list_has_all(b.blocks, a.blocks) and (b.score > a.score or (b.score = a.score and (len(b.blocks) > len(a.blocks) or b."key" < a."key"))))"""


def chimeras(spark, d):
    """Segments of a read: the lines of an order."""
    li = table(spark, d, "lineitem")
    start = (F.col("l_linenumber") * 17 + F.col("l_suppkey") % 9).cast("int")
    s = li.select(F.col("l_orderkey").alias("read"), F.col("l_extendedprice").alias("seg"), start.alias("r_start"), (start + 20 + F.col("l_partkey") % 15).cast("int").alias("r_end"), (F.col("l_partkey") % 5).alias("chr"), (F.col("l_partkey") * 100).alias("g_start"), (F.col("l_linenumber") % 2).alias("strand"), (F.lit(20) + F.col("l_quantity")).cast("int").alias("score"), F.lit(110).alias("length"))
    return chimera.junction_rows(chimera.segment_pairs(s, ["read"], 60, 30, 4, 5, 10))


CHIMERAS = """with s as (select l_orderkey "read", l_extendedprice seg, cast(l_linenumber * 17 + l_suppkey % 9 as int) r_start, cast(l_linenumber * 17 + l_suppkey % 9 + 20 + l_partkey % 15 as int) r_end, l_partkey % 5 chr, l_partkey * 100 g, l_linenumber % 2 str, cast(20 + l_quantity as int) score from lineitem),
p as (select a."read", a.r_start ras, a.r_end rae, a.chr chr_a, a.g ga, a.str sa, b.r_start rbs, b.r_end rbe, b.chr chr_b, b.g gb, b.str sb, a.score + b.score + least(b.r_start - a.r_end - 1, 0) score from s a join s b on a."read" = b."read" and a.r_start < b.r_start and a.r_end < b.r_end and b.r_start - a.r_end - 1 <= 5),
q as (select *, max(score) over (partition by "read") m from p where score >= 60 and score >= 80), n as (select *, count(*) over (partition by "read") n_pairs from q where score >= m - 4)
select chr_a, case when sa = 0 then ga + rae - ras + 1 else ga - 1 end donor, case when sa = 0 then '+' else '-' end donor_strand, chr_b, case when sb = 0 then gb - 1 else gb + rbe - rbs + 1 end acceptor, case when sb = 0 then '+' else '-' end acceptor_strand, score, n_pairs from n where n_pairs <= 10"""


# --- cells ---------------------------------------------------------------------------------------




def posterior(spark, d):
    li = table(spark, d, "lineitem")
    c = li.groupBy(F.col("l_orderkey").alias("read"), (F.col("l_suppkey") * 3 + F.col("l_linenumber") % 3).alias("cb")).agg(F.min(F.when((F.col("l_orderkey") % 4 == 0) & (F.col("l_linenumber") == 1), 0).otherwise(1)).alias("d"), F.max(F.col("l_quantity").cast("int") % 41).alias("q"))
    exact = c.where("d = 0").groupBy("cb").agg(F.count("*").alias("n"))
    return cells.resolve(c, exact)


POSTERIOR = """with c as (select l_orderkey "read", l_suppkey * 3 + l_linenumber % 3 cb, min(case when l_orderkey % 4 = 0 and l_linenumber = 1 then 0 else 1 end) d, max(cast(l_quantity as int) % 41) q from lineitem group by 1, 2),
e as (select cb, count(*) n from c where d = 0 group by cb), w as (select "read", cb, d, coalesce(n, 0) * pow(10.0, -least(q, 33) / 10.0) w from c left join e using (cb)),
p as (select "read", min(case when d = 0 then cb end) own, count(*) k, sum(w) total, max((w, -cb)) best from w group by "read"),
r as (select "read", coalesce(own, case when k = 1 and struct_extract(best, 1) > 0 then -struct_extract(best, 2) when k > 1 and struct_extract(best, 1) > 0 and struct_extract(best, 1) >= 0.975 * total then -struct_extract(best, 2) end) cb from p)
select "read", cb from r where cb is not null"""


def collapse_all(spark, d):
    return cells.collapse_all(derived(spark, d, "umi_records"), 6, ["cb", "feature"])


PAIRS = """, t as (select distinct cb, feature, umi from umi_records), e as (select a.cb, a.feature, a.umi a, b.umi b from t a join t b on a.cb = b.cb and a.feature = b.feature and bit_count((xor(a.umi, b.umi) | (xor(a.umi, b.umi) >> 1)) & 1365) = 1)"""
COLLAPSE = duck("umi_records") + PAIRS + """, r(cb, feature, a, b) as (select cb, feature, umi, umi from t union select r.cb, r.feature, r.a, e.b from r join e on e.cb = r.cb and e.feature = r.feature and e.a = r.b),
m as (select cb, feature, a, min(b) c from r group by all) select cb, feature, count(*) n_tags, count(distinct c) n_components from m group by cb, feature"""
COLLAPSE = COLLAPSE.replace("from r group by all)", "from r group by cb, feature, a)")


def directional(spark, d):
    return cells.collapse_directional(derived(spark, d, "umi_records"), 6, ["cb", "feature"])


DIRECTIONAL = duck("umi_records") + PAIRS + """, c as (select cb, feature, umi, count(*) n from umi_records group by cb, feature, umi),
x as (select distinct e.cb, e.feature, e.a from e join c p on p.cb = e.cb and p.feature = e.feature and p.umi = e.a join c q on q.cb = e.cb and q.feature = e.feature and q.umi = e.b where q.n > 2 * p.n - 1)
select cb, feature, count(*) n_kept from c where not exists (select 1 from x where x.cb = c.cb and x.feature = c.feature and x.a = c.umi) group by cb, feature"""


def matrix(spark, d):
    return cells.matrix(derived(spark, d, "umi_records"))


MATRIX = duck("umi_records") + """, c as (select feature, cb, count(distinct umi) n from umi_records group by feature, cb)
select cast(dense_rank() over (order by feature) as int) "row", cast(dense_rank() over (order by cb) as int) col, feature, cb, n from c"""

def aligned(spark, d):
    """Where the aligner puts each read of the made genome, and what its CIGAR holds. A boundary may move to a better motif, which is worth four mismatches at most."""
    of = lambda ops: F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{ops}]"), F.lit(1)).cast("array<int>"), F.lit(0), lambda s, x: s + x)
    return align.query(spark, d).select("read", "chr", "pos", "strand", of("MND").alias("span"), of("M").alias("aligned"), F.regexp_count("cigar", F.lit("N")).alias("introns"), (F.col("mismatches") <= 4).alias("few_mismatches"), "nh")


ALIGNED = """select concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) "read", cast(l_partkey % 4 as varchar) chr, (l_partkey * 37 + l_suppkey * 11) % 20000 + 1 pos, case when l_orderkey % 2 = 0 then '-' else '+' end strand,
 cast(80 + case when l_linenumber % 3 = 0 then 0 else 100 + l_quantity * 20 end as int) span, 80 aligned, cast(l_linenumber % 3 > 0 as int) introns, true few_mismatches, 1 nh from lineitem"""


def aligned_pieces(spark, d):
    """The same reads against the made genome cut in pieces."""
    reads, genome = align.made_reads(spark, d)
    of = lambda ops: F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{ops}]"), F.lit(1)).cast("array<int>"), F.lit(0), lambda s, x: s + x)
    out = align.align_pieces(reads, genome, piece=8192, reach=4096)
    return out.select("read", "chr", "pos", "strand", of("MND").alias("span"), of("M").alias("aligned"), F.regexp_count("cigar", F.lit("N")).alias("introns"), (F.col("mismatches") <= 4).alias("few_mismatches"), "nh")


def segment_tags(spark, d):
    """Chimeric pairs as supplementary records of each other."""
    li = table(spark, d, "lineitem")
    start = (F.col("l_linenumber") * 17 + F.col("l_suppkey") % 9).cast("int")
    s = li.select(F.col("l_orderkey").alias("read"), F.col("l_extendedprice").alias("seg"), start.alias("r_start"), (start + 20 + F.col("l_partkey") % 15).cast("int").alias("r_end"), (F.col("l_partkey") % 5).alias("chr"), (F.col("l_partkey") * 100).alias("g_start"), (F.col("l_linenumber") % 2).alias("strand"), (F.lit(20) + F.col("l_quantity")).cast("int").alias("score"), F.lit(160).alias("length"))
    pairs = chimera.segment_pairs(s, ["read"], 60, 130, 4, 5, 10)
    return chimera.supplementary(pairs, ["read"]).select("read", "seg_a", "seg_b", "part", "flag", "cigar", "sa")


TAGS = CHIMERAS.split(",\nq as")[0].replace('select a."read", a.r_start ras', 'select a."read", a.seg sega, b.seg segb, a.r_start ras') + """,
q as (select *, max(score) over (partition by "read") m from p where score >= 60 and score >= 30), n as (select *, count(*) over (partition by "read") n_pairs from q where score >= m - 4), k as (select * from n where n_pairs <= 10),
c as (select *, case when sa = 0 then case when ras > 0 then ras || 'S' else '' end || (rae - ras + 1) || 'M' || case when 159 - rae > 0 then (159 - rae) || 'S' else '' end else case when 159 - rae > 0 then (159 - rae) || 'S' else '' end || (rae - ras + 1) || 'M' || case when ras > 0 then ras || 'S' else '' end end ca,
  case when sb = 0 then case when rbs > 0 then rbs || 'S' else '' end || (rbe - rbs + 1) || 'M' || case when 159 - rbe > 0 then (159 - rbe) || 'S' else '' end else case when 159 - rbe > 0 then (159 - rbe) || 'S' else '' end || (rbe - rbs + 1) || 'M' || case when rbs > 0 then rbs || 'S' else '' end end cb from k),
w as (select *, rae - ras >= rbe - rbs first from c)
select "read", sega seg_a, segb seg_b, 'a' part, cast(sa * 16 + case when first then 0 else 2048 end as int) flag, ca cigar, chr_b || ',' || (gb + 1) || ',' || case when sb = 0 then '+' else '-' end || ',' || cb || ',255,0;' sa from w
union all select "read", sega, segb, 'b', cast(sb * 16 + case when first then 2048 else 0 end as int), cb, chr_a || ',' || (ga + 1) || ',' || case when sa = 0 then '+' else '-' end || ',' || ca || ',255,0;' from w"""


def breaks(spark, d):
    """Reads whose first bases are a code's and whose last are another's, with the genome along both."""
    from ..functions import seq

    text = lambda c: seq.decode(F.expr(code_of(c)), 24)
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_partkey").alias("k3"), F.col("l_suppkey").alias("k4"), F.col("l_extendedprice").alias("k5"))
    donor, acceptor = text("k3"), text("k4")
    donor = F.when(F.col("k1") % 3 == 0, F.overlay(donor, F.lit("GT"), (F.col("k2") + 9).cast("int"))).otherwise(donor)
    acceptor = F.when(F.col("k1") % 3 == 0, F.overlay(acceptor, F.lit("AG"), (F.col("k2") + 9).cast("int"))).otherwise(acceptor)
    rows = li.select(*KEYS, donor.alias("donor"), acceptor.alias("acceptor"))
    rows = rows.withColumn("read", F.concat(F.substring("donor", F.lit(1), (F.col("k2") + 8).cast("int")), F.substring("acceptor", (F.col("k2") + 11).cast("int"), (F.lit(14) - F.col("k2")).cast("int"))))
    return chimera.breakpoints(rows).select(*KEYS, "shift", "mismatches", "motif", "repeat")


def _code(c: str) -> str:
    return f"array_to_string(list_transform(range(23, -1, -1), lambda i: substr('ACGT', cast(((({c} * 98245165300007 + 57885161) % 1125899906842624) >> (2 * i)) & 3 as int) + 1, 1)), '')"


BREAKS = f"""with l as (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5, {_code('l_partkey')} d0, {_code('l_suppkey')} a0 from lineitem),
g as (select {K}, case when k1 % 3 = 0 then substr(d0, 1, cast(k2 + 8 as int)) || 'GT' || substr(d0, cast(k2 + 11 as int)) else d0 end dn, case when k1 % 3 = 0 then substr(a0, 1, cast(k2 + 8 as int)) || 'AG' || substr(a0, cast(k2 + 11 as int)) else a0 end ac from l),
r as (select *, substr(dn, 1, cast(k2 + 8 as int)) || substr(ac, cast(k2 + 11 as int), cast(14 - k2 as int)) rd from g),
p as (select {K}, dn, ac, rd, i, len(list_filter(range(1, i + 1), lambda j: substr(dn, j, 1) <> substr(rd, j, 1))) + len(list_filter(range(i + 1, 23), lambda j: substr(ac, j + 2, 1) <> substr(rd, j, 1))) m,
  case substr(dn, i + 1, 2) || substr(ac, i + 1, 2) when 'GTAG' then 1 when 'CTAC' then 2 else 0 end motif from (select *, cast(unnest(range(0, 23)) as int) i from r)),
q as (select *, row_number() over w n, count(*) over (partition by {K}, m, motif = 0) c from p window w as (partition by {K} order by m, motif = 0, i))
select {K}, i shift, cast(m as int) mismatches, motif, cast(c - 1 as int) repeat from q where n = 1"""


def alleles(spark, d):
    """Reads of 60 bases of the made genome, a part each, over variants whose other allele they don't hold. With the other allele on one of an end's two bases that end is clipped: another alignment."""
    from ..operators import remap

    genome = align.made_genome(spark)
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("read"), (F.col("p_partkey") % 4).alias("chr"), (F.col("p_partkey") * 53 % 25_000).cast("int").alias("at"))
    reads = p.join(F.broadcast(genome), "chr").select("read", F.substring("seq", F.col("at") + 1, F.lit(60)).alias("seq"))
    v = spark.range(120).select((F.col("id") % 4).alias("chr"), (F.col("id") * 211 + 30).alias("pos"))
    base = F.substring("seq", F.col("pos").cast("int"), F.lit(1))
    variants = v.join(F.broadcast(genome), "chr").select(F.col("chr").cast("string").alias("chr"), "pos", base.alias("a1"), F.translate(base, "ACGT", "CGTA").alias("a2"))
    found = align.align(reads, genome)
    return remap.other_alleles(found, variants, reads, genome)


ALLELES = """with r as (select cast(p_partkey as varchar) "read", p_partkey % 4 chr, p_partkey * 53 % 25000 a from part), v as (select id % 4 chr, id * 211 + 30 pos from (select unnest(range(0, 120)) id)),
n as (select "read", count(v.pos) n, count_if(coalesce(v.pos - a - 1 in (0, 1, 58, 59), false)) edge from r left join v on v.chr = r.chr and v.pos between a + 1 and a + 60 group by 1) select "read", case when n = 0 then -1 when edge > 0 then 6 else 1 end tag from n"""


def second_pass(spark, d):
    """Reads of the made genome, a part each, whose last five bases lie beyond a junction that is told."""
    from ..operators import remap

    genome = align.made_genome(spark)
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("read"), (F.col("p_partkey") % 4).alias("chr"), (F.col("p_partkey") * 37 % 20_000).cast("int").alias("at"), (F.col("p_partkey") % 900 + 100).cast("int").alias("gap"))
    bases = F.concat(F.substring("seq", F.col("at") + 1, F.lit(75)), F.substring("seq", F.col("at") + 76 + F.col("gap"), F.lit(5)))
    reads = p.join(F.broadcast(genome), "chr").select("read", bases.alias("seq"))
    known = p.select("chr", (F.col("at") + 75).cast("long").alias("start"), (F.col("at") + 75 + F.col("gap")).cast("long").alias("end"))
    return remap.two_pass(reads, genome, known).select("read", "chr", "pos", "strand", "cigar", "nh")


SECOND = """select cast(p_partkey as varchar) "read", cast(p_partkey % 4 as varchar) chr, p_partkey * 37 % 20000 + 1 pos, '+' strand, '75M' || (p_partkey % 900 + 100) || 'N5M' cigar, 1 nh from part"""


def second_segments(spark, d):
    li = table(spark, d, "lineitem")
    start = (F.col("l_linenumber") * 17 + F.col("l_suppkey") % 9).cast("int")
    s = li.select(F.col("l_orderkey").alias("read"), F.col("l_extendedprice").alias("seg"), start.alias("r_start"), (start + 20 + F.col("l_partkey") % 15).cast("int").alias("r_end"), (F.col("l_partkey") % 5).alias("chr"), (F.col("l_partkey") * 100).alias("g_start"), (F.col("l_linenumber") % 2).alias("strand"), (F.lit(20) + F.col("l_quantity")).cast("int").alias("score"), F.lit(110).alias("length"))
    return chimera.best_second(s, ["read"], 60, 30, 6)


SECONDS = """with s as (select l_orderkey "read", l_extendedprice seg, cast(l_linenumber * 17 + l_suppkey % 9 as int) r_start, cast(l_linenumber * 17 + l_suppkey % 9 + 20 + l_partkey % 15 as int) r_end, l_partkey % 5 chr, l_partkey * 100 g_start, l_linenumber % 2 strand, cast(20 + l_quantity as int) score from lineitem),
m as (select * from s qualify row_number() over (partition by "read" order by score desc, seg) = 1),
o as (select s.*, m.score ms, row_number() over (partition by s."read" order by s.score desc, s.seg) k, lead(s.score) over (partition by s."read" order by s.score desc, s.seg) nxt from s join m on m."read" = s."read" and (s.r_end < m.r_start or s.r_start > m.r_end)),
p as (select "read", ms + score total, seg, r_start, r_end, chr, g_start, strand from o where k = 1 and (nxt is null or score - nxt >= 6) and ms + score >= 80)
select p."read", 110 length, total score, case when m.r_start < p.r_start then m.seg else p.seg end seg_a, case when m.r_start < p.r_start then m.r_start else p.r_start end r_start_a, case when m.r_start < p.r_start then m.r_end else p.r_end end r_end_a, case when m.r_start < p.r_start then m.chr else p.chr end chr_a, case when m.r_start < p.r_start then m.g_start else p.g_start end g_start_a, case when m.r_start < p.r_start then m.strand else p.strand end strand_a,
 case when m.r_start < p.r_start then p.seg else m.seg end seg_b, case when m.r_start < p.r_start then p.r_start else m.r_start end r_start_b, case when m.r_start < p.r_start then p.r_end else m.r_end end r_end_b, case when m.r_start < p.r_start then p.chr else m.chr end chr_b, case when m.r_start < p.r_start then p.g_start else m.g_start end g_start_b, case when m.r_start < p.r_start then p.strand else m.strand end strand_b from p join m using ("read")"""


def cell_stats(spark, d):
    return cells.stats(derived(spark, d, "umi_records").withColumn("read", F.monotonically_increasing_id()))


STATS = duck("umi_records") + """, c as (select cb, count(*) reads, count(distinct feature) features, count(distinct (feature, umi)) tags from umi_records group by cb)
select count(*) cells, cast(sum(reads) as bigint) reads, cast(sum(tags) as bigint) tags, (select count(distinct feature) from umi_records) features, max(tags) most_tags, cast(quantile_disc(tags, 0.5) as bigint) median_tags, cast(quantile_disc(features, 0.5) as bigint) median_features, round(1 - sum(tags) / sum(reads), 6) saturation from c"""

QUERIES = {
    "cell_stats": (cell_stats, STATS),
    "chimera_breakpoints": (breaks, BREAKS),
    "chimera_second_segment": (second_segments, SECONDS),
    "other_alleles": (alleles, ALLELES),
    "second_pass": (second_pass, SECOND),
    "chimera_records": (segment_tags, TAGS),
    "multimapper_select": (multimappers, MULTI),
    "mapped_filter_reasons": (reasons, REASONS),
    "sam_flag_mapq": (flags, FLAGS),
    "coordinate_sort": (sorted_rows, duck("blocks") + f" select {K}, case when k2 < 7 then chr else -1 end chr, case when k2 < 7 then bs else -1 end bs from blocks where b = 0"),
    "seed_topk": (seeds, SEEDS),
    "windows_islands": (windows, WINDOWS),
    "dominated_alignments": (dominated, DOMINATED),
    "align_reads": (aligned, ALIGNED),
    "align_reads_in_pieces": (aligned_pieces, ALIGNED),
    "chimera_pairs": (chimeras, CHIMERAS),
    "cb_posterior_assign": (posterior, POSTERIOR),
    "umi_collapse_all": (collapse_all, COLLAPSE),
    "umi_collapse_directional": (directional, DIRECTIONAL),
    "cell_matrix": (matrix, MATRIX),
    "rate_checkpoint_stream": (progress.checkpoint_query, progress.CHECKPOINT_SQL),
    "progress_windows": (progress.windows_query, progress.WINDOWS_SQL),
}
