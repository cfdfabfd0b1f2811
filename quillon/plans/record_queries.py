"""Queries on seeds, windows and alignments as blocks, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..operators import records as R
from ..operators import reads as reads_
from ..operators import remap
from .fixtures import LINE_KEYS, derived, duck, table
from .front_queries import D25

KEYS = ["k1", "k2", "k3", "k4", "k5"]
K = "k1, k2, k3, k4, k5"


def aligned(spark, d):
    """The pieces of each read as blocks and gaps. Lines are dealt out by their keys before they are cut, so no piece is."""
    one = F.struct("i", "r", "g", "len", "frag", "kind", "annot", "lft", "rgt")
    rows = derived(spark, d, "pieces", LINE_KEYS).groupBy(*KEYS, "read_length").agg(F.sort_array(F.collect_list(one)).alias("x"))
    blocks = F.transform("x", lambda x: F.struct(x.r.cast("int").alias("r"), x.g.alias("g"), x.len.cast("int").alias("len"), x.frag.alias("frag")))
    gaps = F.transform(F.slice("x", 1, 2), lambda x: F.struct(x.kind.alias("kind"), x.annot.alias("annot"), x.lft.cast("int").alias("left"), x.rgt.cast("int").alias("right")))
    return rows.select(*KEYS, F.col("read_length").cast("int").alias("read_length"), blocks.alias("blocks"), gaps.alias("gaps"))


#: The pieces of a read in one row.
FLAT = duck("pieces") + f""", a as (select {K}, read_length, max(case when i = 0 then r end) r0, max(case when i = 1 then r end) r1, max(case when i = 2 then r end) r2, max(case when i = 0 then g end) g0, max(case when i = 1 then g end) g1, max(case when i = 2 then g end) g2,
  max(case when i = 0 then len end) l0, max(case when i = 1 then len end) l1, max(case when i = 2 then len end) l2, max(case when i = 0 then kind end) m0, max(case when i = 1 then kind end) m1, max(case when i = 0 then annot end) a0, max(case when i = 1 then annot end) a1,
  max(case when i = 0 then lft end) x0, max(case when i = 1 then lft end) x1, max(case when i = 0 then rgt end) y0, max(case when i = 1 then rgt end) y1 from pieces group by {K}, read_length)"""


def validity(spark, d):
    rows = aligned(spark, d).withColumn("mate_length", F.col("read_length"))
    out = [R.invalid(4, 3, 0, 0.66, "drop_new", True, 2).alias("strict"), R.invalid(0, 0, 0, 0.0, "keep", False, 0).alias("loose")]
    return rows.select(*KEYS, *out)


VALID = FLAT + f""", f as (select *, m0 >= 0 j0, m1 >= 0 j1 from a),
v as (select *, (a0 = 1 and j0 and (l0 < 3 or (l1 < 3 and (m1 = -3 or (j1 and a1 = 0))))) or (a1 = 1 and j1 and ((l1 < 3 and (m0 = -3 or (j0 and a0 = 0))) or l2 < 3)) short_a,
  (j0 and a0 = 0 and (l0 < 4 + x0 or l1 < 4 + y0)) or (j1 and a1 = 0 and (l1 < 4 + x1 or l2 < 4 + y1)) short_n,
  m0 > 0 and m1 > 0 and m0 % 2 <> m1 % 2 strands, (m0 = 0 and a0 = 0) or (m1 = 0 and a1 = 0) odd,
  case when m0 = -3 then (j1 and l1 + l2 < floor(0.66 * read_length)) when m1 = -3 then (j0 and l0 + l1 < floor(0.66 * read_length)) else (j0 or j1) and l0 + l1 + l2 < floor(0.66 * read_length) end short_m,
  case when m0 = -3 then g2 + l2 <= g0 or (g0 + l0 > g1 and (g0 > g1 + r0 + 2 or g0 + l0 > g2 + read_length - r2 + 2)) when m1 = -3 then g2 + l2 <= g0 or (g1 + l1 > g2 and (g0 > g2 + r0 + 2 or g1 + l1 > g2 + read_length - r2 + 2)) else false end mates2,
  case when m0 = -3 then g2 + l2 <= g0 or (g0 + l0 > g1 and (g0 > g1 + r0 or g0 + l0 > g2 + read_length - r2)) when m1 = -3 then g2 + l2 <= g0 or (g1 + l1 > g2 and (g0 > g2 + r0 or g1 + l1 > g2 + read_length - r2)) else false end mates0,
  (j0 and a0 = 0 and (l0 < x0 or l1 < y0)) or (j1 and a1 = 0 and (l1 < x1 or l2 < y1)) short_0 from f)
select {K}, case when short_a then 'short_annotated' when short_n then 'short_overhang' when strands then 'strands' when odd then 'noncanonical' when short_m then 'short_mate' when mates2 then 'mates' end strict,
 case when short_0 then 'short_overhang' when mates0 then 'mates' end loose from v"""


def scores(spark, d):
    rows = aligned(spark, d).withColumns({"wrong": F.col("k4") % 5, "n": F.aggregate("blocks", F.lit(0), lambda s, b: s + b.len)})
    return rows.select(*KEYS, R.score(F.col("n") - F.col("wrong"), F.col("wrong")).alias("score"))


GAP = "case when a{i} = 1 then 2 when m{i} = -3 then 0 when m{i} = -2 then (r{j} - r{i} - l{i}) * -2 - 2 when m{i} = -1 then (g{j} - g{i} - l{i}) * -2 - 2 when m{i} = 0 then -8 when m{i} <= 2 then 0 when m{i} <= 4 then -4 else -8 end"
SCORES = FLAT + f""" select {K}, cast(l0 + l1 + l2 - 2 * (k4 % 5) + {GAP.format(i=0, j=1)} + {GAP.format(i=1, j=2)} + ceil(log2(greatest(g2 + l2 - g0, 1)) * -0.25 - 0.5) as bigint) score from a"""


def best(spark, d):
    li = table(spark, d, "lineitem")
    return R.best_windows(li.select(F.col("l_orderkey").alias("read"), F.col("l_extendedprice").alias("window"), (F.col("l_quantity") % 4).cast("int").alias("score"), (F.col("l_partkey") % 6).alias("g_length")), ["read"])


BEST = """select l_orderkey "read", l_extendedprice "window", cast(l_quantity % 4 as int) score, l_partkey % 6 g_length from lineitem qualify row_number() over (partition by l_orderkey order by l_quantity % 4 desc, l_partkey % 6, l_extendedprice) = 1"""


def cigars(spark, d):
    """Reads without mates' gaps, and all as pairs, whose second mates follow the first ones' bases."""
    rows = aligned(spark, d)
    left = F.col("read_length") + 50
    cut = F.array_min(F.transform(F.filter(F.transform("gaps", lambda g, i: F.struct(g.kind.alias("kind"), i.alias("i"))), lambda g: g.kind == -3), lambda g: g.i))
    at = F.coalesce(cut, F.lit(9))
    moved = F.transform("blocks", lambda b, i: F.struct((b.r + F.when(i > at, F.col("read_length") + 51).otherwise(0)).alias("r"), b.g.alias("g"), b.len.alias("len"), b.frag.alias("frag")))
    one = rows.select(*KEYS, F.when(cut.isNull(), R.cigar(F.col("read_length"))).alias("cigar"), "read_length", "gaps", moved.alias("blocks"))
    return one.select(*KEYS, "cigar", R.cigar_pair(left, 2 * F.col("read_length") + 101).alias("pair"))


def _between(i: int, j: int) -> str:
    return f"case when r{j} - r{i} - l{i} > 0 then (r{j} - r{i} - l{i}) || 'I' else '' end || case when m{i} >= 0 then (g{j} - g{i} - l{i}) || 'N' when g{j} - g{i} - l{i} > 0 then (g{j} - g{i} - l{i}) || 'D' else '' end"


def _mates(i: int, j: int) -> str:
    r = f"(r{j} + case when m{i} = -3 then read_length + 51 else 0 end)"
    gap = f"(g{j} - g{i} - l{i})"
    return f"""case when {gap} < 0 then {gap} || 'p' when m{i} = -3 then case when read_length + 50 - r{i} - l{i} > 0 then (read_length + 50 - r{i} - l{i}) || 'S' else '' end || {gap} || 'p' || case when {r} - read_length - 51 > 0 then ({r} - read_length - 51) || 'S' else '' end else {_between(i, j)} end"""


CIGARS = FLAT + f""" select {K}, case when m0 <> -3 and m1 <> -3 then case when r0 > 0 then r0 || 'S' else '' end || l0 || 'M' || {_between(0, 1)} || l1 || 'M' || {_between(1, 2)} || l2 || 'M' || case when read_length - r2 - l2 > 0 then (read_length - r2 - l2) || 'S' else '' end end cigar,
 case when r0 > 0 then r0 || 'S' else '' end || l0 || 'M' || {_mates(0, 1)} || l1 || 'M' || {_mates(1, 2)} || l2 || 'M' || case when m0 = -3 or m1 = -3 then 2 * read_length + 101 - (r2 + read_length + 51) - l2 else read_length + 50 - r2 - l2 end || 'S' pair from a"""


def tags(spark, d):
    """Reads of 25 bases of a code against the bases of their part, with a deletion after the tenth in some."""
    chip = derived(spark, d, "chip_map").where("pk < 1000000").select(F.col("pk").alias("k3"), F.col("barcode").alias("code"))
    rows = derived(spark, d, "reads").join(chip, "k3")
    gone = (F.col("k1") % 3).cast("int")
    base, text = seq.decode(F.col("code"), 25), seq.decode(F.col("barcode"), 25)
    genome = F.concat(F.substring(base, 1, 10), F.substring(F.lit("TG"), F.lit(1), gone), F.substring(base, 11, 15))
    block = lambda r, g, n: F.struct(F.lit(r).alias("r"), g.cast("bigint").alias("g"), F.lit(n).alias("len"))
    two = F.array(block(0, F.lit(500), 10), block(10, F.lit(510) + gone, 15))
    gap = lambda k: F.struct(F.lit(k).alias("kind"), F.lit(0).alias("annot"), F.lit(0).alias("left"), F.lit(0).alias("right"))
    rows = rows.select(*KEYS, genome.alias("genome"), F.overlay(text, F.when(F.col("k2") == 5, "N").otherwise(F.substring(text, 3, 1)), F.lit(3)).alias("read"), F.when(gone > 0, two).otherwise(F.array(block(0, F.lit(500), 25))).alias("blocks"), F.when(gone > 0, F.array(gap(-1))).otherwise(F.slice(F.array(gap(-1)), 1, 0)).alias("gaps"))
    return rows.select(*KEYS, R.mismatch_tags(F.col("read"), F.col("genome")).alias("t")).select(*KEYS, F.col("t.nm").cast("long").alias("nm"), "t.md")


TAGS = duck("chip_map", "reads") + f""", c as (select pk k3, {D25} base from chip_map where pk < 1000000), r as (select {K}, {D25} t0 from reads),
s as (select {K}, base, k1 % 3 gone, case when k2 = 5 then substr(t0, 1, 2) || 'N' || substr(t0, 4) else t0 end t from r join c using (k3)),
p as (select {K}, gone, i, substr(base, cast(i as int), 1) b, substr(t, cast(i as int), 1) x from (select *, unnest(range(1, 26)) i from s)),
e as (select {K}, i * 10 o, i p, i - 1 eq, b, 1 w from p where b <> x union all select {K}, 105, 10, 10, '^' || substr('TG', 1, cast(gone as int)), gone from s where gone > 0),
l as (select *, eq - coalesce(lag(p) over (partition by {K} order by o), 0) run from e),
m as (select {K}, sum(w) nm, string_agg(run || b, '' order by o) md, max(p) last from l group by {K})
select {K}, cast(coalesce(nm, 0) as bigint) nm, coalesce(md, '') || (25 - coalesce(last, 0)) md from s left join m using ({K})"""


def mates(spark, d):
    b = derived(spark, d, "blocks").withColumn("mate", F.col("b") + 1)
    place = F.when((F.col("b") == 1) & (F.col("k4") % 5 == 0), F.col("chr") + 1).otherwise(F.col("chr"))
    rows = b.where("not (b = 1 and k4 % 4 = 3)").select(F.struct(*KEYS).alias("pair"), "mate", place.alias("chr"), (F.col("bs") - F.when((F.col("b") == 1) & (F.col("k2") == 3), 3000).otherwise(0)).alias("start"), F.col("bend").alias("end"))
    return R.pair_fields(rows).select("pair.*", "mate", "rnext", "pnext", F.col("tlen").cast("long").alias("tlen"))


MATES = duck("blocks") + f""", r as (select {K}, b + 1 mate, case when b = 1 and k4 % 5 = 0 then chr + 1 else chr end chr, bs - case when b = 1 and k2 = 3 then 3000 else 0 end s, bend e from blocks where not (b = 1 and k4 % 4 = 3))
select {K}, x.mate, case when y.chr is null then '*' when y.chr = x.chr then '=' else cast(y.chr as varchar) end rnext, coalesce(y.s, 0) pnext, cast(case when y.chr = x.chr then (greatest(x.e, y.e) - least(x.s, y.s) + 1) * case when x.s < y.s or (x.s = y.s and x.mate = 1) then 1 else -1 end else 0 end as bigint) tlen
from r x left join (select *, 3 - mate other from r) y using ({K}) where (y.other = x.mate or y.other is null) or false"""
MATES = MATES.replace(f"left join (select *, 3 - mate other from r) y using ({K}) where (y.other = x.mate or y.other is null) or false", f"left join (select {K}, chr, s, e, 3 - mate mate from r) y using ({K}, mate)").replace("x.mate, case", "mate, case").replace("x.mate = 1", "mate = 1")


def outputs(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), (F.col("l_partkey") % 4).alias("chr"), F.col("l_linenumber").cast("long").alias("hi"), (F.col("l_suppkey") % 2 + 1).alias("mate"), "l_extendedprice")
    one = R.output_rows(li, ["read"], 3, [1, 2]).withColumn("how", F.lit("added"))
    return one.unionByName(R.output_rows(li, ["read"], -1, None, True).withColumn("how", F.lit("pairs")))


OUTPUTS = """with l as (select l_orderkey "read", l_partkey % 4 chr, cast(l_linenumber as bigint) hi, l_suppkey % 2 + 1 mate, l_extendedprice from lineitem)
select *, 'added' how from l where hi <= 3 and "read" in (select "read" from l where hi <= 3 and chr not in (1, 2)) union all select * exclude (m), 'pairs' from (select *, count(distinct mate) over (partition by "read", hi) m from l) where m = 2"""


def ordered(spark, d):
    """Rows in input order, each with the greatest number before it in its task and range."""
    rows = derived(spark, d, "pieces").withColumn("read_no", F.col("k1") * 1000 + F.col("k3"))
    return R.input_order(rows, "read_no", ("i", *KEYS)).select("read_no", *KEYS, "i")


def starts(spark, d):
    rows = derived(spark, d, "reads").select(*KEYS, F.concat(seq.decode(F.col("barcode"), 25), F.when(F.col("k1") % 2 == 0, "N").otherwise(""), F.repeat(F.lit("ACGTT"), F.col("base_q")), F.lit("NN"), F.repeat(F.lit("G"), (F.col("k2") * 3).cast("int"))).alias("seq"))
    at = R.seed_starts(reads_.good_stretches(F.col("seq"), 12), F.length("seq"), 50, 0.5)
    return rows.select(*KEYS, F.array_join(F.transform(at, lambda s: F.concat(s.start.cast("string"), F.when(s.back, "r").otherwise("f"))), ",").alias("at"))


STARTS = duck("reads") + f""", r as (select {K}, k1 % 2 = 0 cut, base_q * 5 a, cast(k2 * 3 as int) c from reads),
t as (select *, case when cut then [struct_pack(s := 0, n := 25), struct_pack(s := 26, n := a), struct_pack(s := 28 + a, n := c)] else [struct_pack(s := 0, n := 25 + a), struct_pack(s := 27 + a, n := c)] end x, 27 + a + c + cut::int total from r),
u as (select *, list_filter(x, lambda z: z.n >= 12) y, least(50, cast(floor(0.5 * (total - 1)) as int)) m from t)
select {K}, array_to_string(flatten(list_transform(y, lambda z: flatten(list_transform(range(0, case when m < z.n then z.n // m + 1 else 1 end), lambda i: [(z.s + i * (z.n // case when m < z.n then z.n // m + 1 else 1 end)) || 'f', (z.s + z.n - 1 - i * (z.n // case when m < z.n then z.n // m + 1 else 1 end)) || 'r'])))), ',') "at" from u"""


def seeds(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), (F.col("l_partkey") % 5).alias("r_start"), (F.col("l_suppkey") % 4 + 18).alias("length"), (F.col("l_partkey") * 60).alias("loci"))
    return R.store_seeds(li.drop("loci").withColumn("loci", F.col("r_start") * 3000), ["read"])


SEEDS = """with s as (select distinct l_orderkey "read", l_partkey % 5 r_start, l_suppkey % 4 + 18 length, l_partkey % 5 * 3000 loci from lineitem)
select *, cast(row_number() over (partition by "read" order by r_start, length desc) as int) seed from s where loci <= 10000"""


def placed(spark, d):
    """Seeds of a read on few diagonals, in windows of a fixed width."""
    li = table(spark, d, "lineitem")
    s = li.select(F.col("l_custkey").alias("read") if "l_custkey" in li.columns else (F.col("l_orderkey") % 97).alias("read"), (F.col("l_partkey") % 3).alias("chr"), F.lit(0).alias("str"), (F.col("l_extendedprice") % 120).cast("long").alias("r_start"), (F.col("l_suppkey") % 9 + 4).cast("long").alias("length"), F.lit(0).alias("frag"), F.lit(-1).alias("sj"), (F.col("l_partkey") % 5 * 300_000).alias("line")).withColumn("g_start", F.col("r_start") + F.col("line")).drop("line").distinct()
    w = s.select("read", "chr", "str").distinct().crossJoin(spark.range(2).select(F.col("id").alias("window"), (F.col("id") * 10).alias("first_bin"), (F.col("id") * 10 + 6).alias("last_bin")))
    return R.seed_windows(s, w, ["read"])


PLACED = """with s as (select distinct l_orderkey % 97 "read", l_partkey % 3 chr, 0 str, cast(floor(l_extendedprice % 120) as bigint) r_start, cast(l_suppkey % 9 + 4 as bigint) length, 0 frag, -1 sj, l_partkey % 5 * 300000 line from lineitem),
m as (select *, r_start + line g_start, case when (r_start + line) // 65536 between 0 and 6 then 0 when (r_start + line) // 65536 between 10 and 16 then 1 end "window" from s),
e as (select *, max(r_start + length) over (partition by "read", chr, line order by r_start, length desc rows between unbounded preceding and 1 preceding) e from m where "window" is not null),
n as (select *, sum(case when r_start >= e then 1 else 0 end) over (partition by "read", chr, line order by r_start, length desc rows unbounded preceding) run from e)
select "read", chr, str, r_start, length, frag, sj, g_start, "window" from n qualify row_number() over (partition by "read", chr, line, run order by length desc, r_start) = 1"""


def split_hits(spark, d):
    li = table(spark, d, "lineitem")
    p = R.split_hit((F.col("l_partkey") % 60).cast("int"), (F.col("l_quantity") + 5).cast("int"), 30, F.col("l_suppkey") * 1000, F.col("l_suppkey") * 1000 + 730)
    return li.select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_partkey").alias("k3"), F.col("l_suppkey").alias("k4"), F.col("l_extendedprice").alias("k5"), F.explode(p).alias("p")).select(*KEYS, "p.*")


HITS = f"""with h as (select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5, l_partkey % 60 a, cast(l_quantity + 5 as int) n, l_suppkey * 1000 dd from lineitem), c as (select * from h where a < 30 and a + n > 30)
select {K}, 0 "offset", dd + a g, cast(30 - a as int) len from c union all select {K}, cast(30 - a as int), dd + 730, cast(n - 30 + a as int) from c"""


def length_scores(spark, d):
    li = derived(spark, d, "pieces").where("i = 0")
    return li.select(*KEYS, seq.genomic_length_score(F.col("ref_len") + F.col("k2") * 1000).alias("score"))


def bans(spark, d):
    """Alignments fit for transcript counts; each read has one primary."""
    p = derived(spark, d, "pieces").where("i = 2").select(F.col("k1").alias("read"), "k2", "k3", "k4", "k5", (F.col("k3") % 5).alias("chr"), F.col("g").alias("pos"), F.when(F.col("r") % 3 == 0, "20M3I9M").when(F.col("r") % 3 == 1, "30M").otherwise("10M50N20M").alias("cigar"), (F.col("frag") + 1).alias("mates"))
    out = remap.transcript_bans(p, True)
    return out.groupBy("read").agg(F.count("*").alias("n"), F.count_if("primary").alias("primary"))


BANS = duck("pieces") + """ select k1 "read", count(*) n, 1 "primary" from pieces where i = 2 and r % 3 <> 0 and frag = 1 group by k1"""


def merged_mates(spark, d):
    """Mates of one fragment, merged where they overlap, and a merged read's blocks cut back to its mates."""
    whole = F.concat(seq.decode(F.col("barcode"), 25), F.lit("ACCGT"), F.reverse(seq.decode(F.col("barcode"), 25)))
    rows = derived(spark, d, "reads").select(*KEYS, F.substring(whole, F.lit(1), (F.col("k1") % 30 + 22).cast("int")).alias("left"), F.substring(whole, (F.col("k2") * 3).cast("int"), F.lit(40)).alias("right"))
    out = R.merge_mates(rows, 10, 0.0)
    blocks = F.array(F.struct(F.lit(0).alias("r"), F.lit(100).alias("g"), F.lit(20).alias("len")), F.struct(F.lit(20).alias("r"), F.lit(500).alias("g"), (F.length("merged") - 20).alias("len")))
    out = out.where("merged is not null and not protrude").withColumns({"blocks": blocks, "left_length": F.length("left"), "right_length": F.length("right"), "right_start": F.length("left") - F.col("overlap")})
    text = lambda c: F.array_join(F.transform(c, lambda b: F.concat_ws(":", b.r, b.g, b.len)), ",")
    return R.split_merged(out).select(*KEYS, "overlap", "merged", text("first").alias("first"), text("second").alias("second"))


MERGED = duck("reads") + f""", s as (select {K}, substr({D25} || 'ACCGT' || reverse({D25}), 1, cast(k1 % 30 + 22 as int)) a, substr({D25} || 'ACCGT' || reverse({D25}), cast(k2 * 3 as int), 40) b from reads),
o as (select *, list_max(list_filter(range(10, least(length(a), length(b)) + 1), lambda n: substr(a, length(a) - n + 1) = substr(b, 1, n))) n, list_max(list_filter(range(10, least(length(a), length(b)) + 1), lambda n: substr(b, length(b) - n + 1) = substr(a, 1, n))) p from s),
m as (select *, a || substr(b, n + 1) w, length(a) la, length(b) lb, length(a) - n rs from o where n is not null and coalesce(p <= n, true)),
x as (select *, length(w) - 20 t from m)
select {K}, cast(n as int) overlap, w merged, case when la <= 20 then '0:100:' || la else '0:100:20,20:500:' || (least(la, length(w)) - 20) end "first",
 concat_ws(',', case when rs < 20 then '0:' || (100 + rs) || ':' || (least(20, rs + lb) - rs) end, case when rs + lb > 20 then (greatest(20, rs) - rs) || ':' || (500 + greatest(20, rs) - 20) || ':' || (least(length(w), rs + lb) - greatest(20, rs)) end) "second" from x"""


QUERIES = {
    "alignment_validity": (validity, VALID),
    "alignment_scores": (scores, SCORES),
    "best_window": (best, BEST),
    "cigar_forms": (cigars, CIGARS),
    "mismatch_tags": (tags, TAGS),
    "mate_fields": (mates, MATES),
    "output_filters": (outputs, OUTPUTS),
    "input_order": (ordered, duck("pieces") + f" select k1 * 1000 + k3 read_no, {K}, i from pieces"),
    "seed_starts": (starts, STARTS),
    "seed_store": (seeds, SEEDS),
    "seed_window_join": (placed, PLACED),
    "junction_hit_split": (split_hits, HITS),
    "genomic_length_score": (length_scores, duck("pieces") + f" select {K}, cast(least(ceil(log2(ref_len + k2 * 1000) * -0.25 - 0.5), 0) as bigint) score from pieces where i = 0"),
    "transcript_bans": (bans, BANS),
    "mate_merge": (merged_mates, MERGED),
}
