"""Queries of the barcode stage on the derived tables, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..operators import annotation as A
from ..operators import barcode as B
from ..operators import reads as R
from .fixtures import derived, duck, table

KEYS = ["k1", "k2", "k3", "k4", "k5"]
DIST = "bit_count((xor({a}, {b}) | (xor({a}, {b}) >> 1)) & 6148914691236517205)"
NEAR = DIST.format(a="q.barcode", b="c.barcode")


def exact_counts(spark, d):
    return B.coordinate_counts(derived(spark, d, "reads").where("n_pos < 0"), derived(spark, d, "chip_map"))


def neighbor(radius):
    return lambda spark, d: B.nearest_unique(derived(spark, d, "reads").where("n_pos < 0"), derived(spark, d, "chip_map"), 25, radius).fillna(-1, ["x", "y"])


def neighbor_sql(radius):
    return duck("chip_map", "reads") + f""", q as (select distinct barcode from reads where n_pos < 0 and barcode not in (select barcode from chip_map)),
h as (select q.barcode, c.barcode hit, c.x, c.y, {NEAR} dd from q, chip_map c where {NEAR} <= {radius}),
g as (select barcode, dd, count(*) n, min(x) x, min(y) y from h group by all)
select barcode, cast(dd as int) radius, n n_hits, case when n = 1 then x else -1 end x, case when n = 1 then y else -1 end y from g qualify row_number() over (partition by barcode order by dd) = 1"""


def n_rescue(spark, d):
    return B.rescue_n(derived(spark, d, "reads"), derived(spark, d, "chip_map"), KEYS)


N_RESCUE = duck("chip_map", "reads") + """, t as (select k1, k2, k3, k4, k5, (barcode & ~(3::bigint << (2 * n_pos))) | (b << (2 * n_pos)) barcode from reads, (select unnest([0::bigint, 1, 2, 3]) b) where n_pos >= 0)
select k1, k2, k3, k4, k5, min(x) x, min(y) y from t join chip_map using (barcode) group by all having count(*) = 1"""


def runs(spark, d):
    reads, chip = derived(spark, d, "reads"), derived(spark, d, "chip_map")
    first = chip.select("barcode", (F.col("pk") % 3 + 1).alias("n"))
    second = reads.where("n_pos < 0").groupBy("barcode").agg(F.count("*").alias("n"))
    return B.overlap(first, second, 25, 2)


OVERLAP = duck("chip_map", "reads") + f""", a as (select barcode, pk % 3 + 1 n from chip_map), b as (select barcode, count(*) n from reads where n_pos < 0 group by barcode),
miss as (select * from b where barcode not in (select barcode from a)),
h as (select q.barcode, count(*) hits, min(c.barcode) hit, min({NEAR}) dd from miss q, a c where {NEAR} <= 2 group by q.barcode),
met as (select b.barcode, b.n, case when e.n is not null then b.barcode when hits = 1 then h.hit end hit, coalesce(e.n, case when hits = 1 then m.n end) n1,
  case when e.n is not null then 0 when hits = 1 then dd when hits > 1 then -1 end d from b left join a e using (barcode) left join h using (barcode) left join a m on m.barcode = h.hit) """


def transfer(spark, d):
    return B.base_transfers(runs(spark, d))


def dup_positions(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("barcode"), (F.col("l_partkey") % 64 + F.col("l_linenumber") % 2 + F.when(F.col("l_quantity") == 50, 5).otherwise(0)).cast("int").alias("x"), (F.col("l_suppkey") % 2).cast("int").alias("y"))
    return B.resolve_positions(rows)


DUP = """with p as (select distinct l_partkey barcode, cast(l_partkey % 64 + l_linenumber % 2 + case when l_quantity = 50 then 5 else 0 end as int) x, cast(l_suppkey % 2 as int) y from lineitem),
g as (select barcode, count(*) n_positions, min((x, y)) s, max(x) - min(x) dx, max(y) - min(y) dy from p group by barcode)
select barcode, struct_extract(s, 1) x, struct_extract(s, 2) y, n_positions, case when n_positions = 1 then 'single' when n_positions <= 4 and dx <= 1 and dy <= 1 then 'neighbours' else 'duplicate' end kind from g"""


def segments(spark, d):
    return B.segment_counts(derived(spark, d, "reads").where("n_pos < 0"), 24, 3, KEYS)


SEGMENTS = duck("reads") + """ select part, count(*) n from (select unnest(list_distinct([barcode & 65535, (barcode >> 16) & 65535, (barcode >> 32) & 65535])) part from reads where n_pos < 0) group by part"""


def mapped(spark, d):
    """Reads with the way they were mapped and the reason why their tag is dropped."""
    reads, chip = derived(spark, d, "reads"), derived(spark, d, "chip_map")
    near = B.nearest_unique(reads.where("n_pos < 0"), chip, 25, 1).where("x is not null").select("barcode", F.lit("mismatch").alias("m1"))
    exact = chip.select("barcode", F.lit("exact").alias("m0"))
    full = reads.where("n_pos < 0").join(exact, "barcode", "left").join(near, "barcode", "left").withColumn("how", F.coalesce("m0", "m1")).select(*KEYS, "umi", "base_q", "how")
    part = reads.where("n_pos >= 0").join(B.rescue_n(reads, chip, KEYS).select(*KEYS, F.lit("n").alias("how")), KEYS, "left").select(*KEYS, "umi", "base_q", "how")
    scores = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("base_q") + i * F.col("k2")) % 41)
    return full.unionByName(part).withColumn("reason", B.umi_reason(F.col("umi"), F.col("k1") % 97 == 0, scores))


MAPPED = duck("chip_map", "reads") + f""", q as (select distinct barcode from reads where n_pos < 0 and barcode not in (select barcode from chip_map)),
h as (select q.barcode, count(*) n from q, chip_map c where {NEAR} <= 1 group by q.barcode having count(*) = 1),
t as (select k1, k2, k3, k4, k5, (barcode & ~(3::bigint << (2 * n_pos))) | (b << (2 * n_pos)) barcode from reads, (select unnest([0::bigint, 1, 2, 3]) b) where n_pos >= 0),
r as (select k1, k2, k3, k4, k5 from t join chip_map using (barcode) group by all having count(*) = 1),
mapped as (select r0.*, case when n_pos < 0 and c.barcode is not null then 'exact' when n_pos < 0 and h.barcode is not null then 'mismatch' when n_pos >= 0 and r.k1 is not null then 'n' end how,
  case when k1 % 97 = 0 then 'n' when umi = 0 then 'poly_a' when len(list_filter(range(0, 10), lambda i: (base_q + i * k2) % 41 < 11)) > 1 then 'low_quality' end reason
  from reads r0 left join chip_map c using (barcode) left join h using (barcode) left join r using (k1, k2, k3, k4, k5)) """


def umi_cascade(spark, d):
    return mapped(spark, d).where("how is not null").groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def report(spark, d):
    return B.mapping_report(mapped(spark, d))


REPORT = MAPPED + """, n as (select count(*) total, count_if(how is not null) mapped, count_if(coalesce(how = 'exact', false)) exact, count_if(coalesce(how = 'mismatch', false)) mismatch, count_if(coalesce(how = 'n', false)) with_n,
 count_if(how is not null and reason is not null) filtered, count_if(how is not null and coalesce(reason = 'poly_a', false)) umi_poly_a, count_if(how is not null and coalesce(reason = 'low_quality', false)) umi_low_quality from mapped)
select *, round(mapped * 100.0 / total, 2) mapped_percent, round(exact * 100.0 / total, 2) exact_percent, round(mismatch * 100.0 / total, 2) mismatch_percent, round(with_n * 100.0 / total, 2) with_n_percent, round(filtered * 100.0 / total, 2) filtered_percent from n"""


def qualities(spark, d):
    scores = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: (F.col("base_q") + i * F.col("k2")) % 41)
    reads = derived(spark, d, "reads").select(scores.alias("s"))
    return reads.select(*[seq.at_least(F.col("s"), q).alias(f"q{q}") for q in (10, 20, 30)]).agg(F.count("*").alias("reads"), *[F.sum(f"q{q}").alias(f"q{q}") for q in (10, 20, 30)])


QUALITIES = duck("reads") + """ select count(*) reads, sum(len(list_filter(s, lambda x: x >= 10))) q10, sum(len(list_filter(s, lambda x: x >= 20))) q20, sum(len(list_filter(s, lambda x: x >= 30))) q30
from (select list_transform(range(0, 25), lambda i: (base_q + i * k2) % 41) s from reads)"""


def poly_a(spark, d):
    """Reads made of some C and G, the 25 bases of a code, and a tail of A with a change."""
    reads = derived(spark, d, "reads")
    text = F.concat(F.repeat(F.lit("CG"), (F.col("k2") % 7).cast("int")), seq.decode(F.col("barcode"), 25), F.repeat(F.lit("A"), F.col("base_q")), F.lit("T"), F.repeat(F.lit("A"), F.lit(4)), F.lit("GATC"))
    rows = reads.select(*KEYS, text.alias("seq")).withColumn("qual", F.repeat(F.lit("J"), F.length("seq")))
    return B.trim_poly_a(rows, 12, 2).select(*KEYS, "pos", "dropped", F.length("kept").alias("kept_length"), "kept_qual")


POLY_A = duck("reads") + """, s as (select k1, k2, k3, k4, k5, repeat('CG', cast(k2 % 7 as int)) || array_to_string(list_transform(range(24, -1, -1), lambda i: substr('ACGT', cast((barcode >> (2 * i)) & 3 as int) + 1, 1)), '')
  || repeat('A', base_q) || 'T' || repeat('A', 4) || 'GATC' seq from reads),
p as (select *, coalesce(list_min(list_filter(range(0, length(seq) - 11), lambda i: length(replace(substr(seq, i + 1, 12), 'A', '')) <= 2)), -1) pos from s)
select k1, k2, k3, k4, k5, cast(pos as int) pos, pos >= 0 and pos < 30 dropped, cast(case when pos < 0 then length(seq) when pos < 30 then 0 else pos end as int) kept_length, repeat('J', case when pos < 0 then length(seq) when pos < 30 then 0 else pos end) kept_qual from p"""


def mask(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("block"), (F.col("n_nationkey") % 5).alias("col"), F.expr("n_nationkey div 5").alias("row"), (F.lit(10) + F.col("n_nationkey") % 5).alias("dnb_cols"), (F.lit(8) + F.expr("n_nationkey div 5")).alias("dnb_rows"))
    return B.mask_positions(n, 2, 90)


MASK = """with b as (select n_nationkey block, n_nationkey % 5 col, n_nationkey // 5 row, 10 + n_nationkey % 5 w, 8 + n_nationkey // 5 h from nation),
c as (select col, coalesce(sum(max(w) + 2) over (order by col rows between unbounded preceding and 1 preceding), 0) x0, max(w) cw from b group by col),
r as (select row, coalesce(sum(max(h) + 2) over (order by row rows between unbounded preceding and 1 preceding), 0) y0, max(h) rh from b group by row),
z as (select (select max(y0 + rh) from r) high),
s as (select block, col, row, w, unnest(range(0, cast(w * h as bigint))) dnb from b)
select block, cast(dnb as int) dnb, cast(high - 1 - (y0 + dnb // w) as bigint) x, cast(x0 + dnb % w as bigint) y from s join c using (col) join r using (row), z"""


def merged(spark, d):
    n = exact_counts(spark, d)
    other = derived(spark, d, "chip_map").groupBy("x", "y").agg(F.count("*").alias("n"))
    return B.merge_lists(n, other)


COUNTS = "select x, y, count(*) n from reads join chip_map using (barcode) where n_pos < 0 group by x, y"
MERGED = duck("chip_map", "reads") + f" select x, y, cast(sum(n) as bigint) n from ({COUNTS} union all select x, y, count(*) n from chip_map group by x, y) group by x, y"


def boxes(spark, d):
    return B.box_sum(exact_counts(spark, d))


BOXES = duck("chip_map", "reads") + f" select cast(x + i as int) x, cast(y + j as int) y, cast(sum(n) as bigint) n from ({COUNTS}), (select unnest(range(-2, 3)) i), (select unnest(range(-2, 3)) j) group by 1, 2"

def adapters(spark, d):
    """Bases of a code, then a cut adapter with a change in some."""
    reads = derived(spark, d, "reads")
    tail = F.substring(F.when(F.col("k1") % 5 == 0, "GATCACAGGT").otherwise("GATTACAGGT"), F.lit(1), (F.col("k2") + 3).cast("int"))
    rows = reads.select(*KEYS, F.concat(seq.decode(F.col("barcode"), 25), tail).alias("seq"), F.repeat(F.lit("I"), F.lit(28)).alias("qual"))
    return R.clip_adapter(rows, "GATTACAGGT", 0.1).select(*KEYS, "seq")


DECODED = "array_to_string(list_transform(range(24, -1, -1), lambda i: substr('ACGT', cast((barcode >> (2 * i)) & 3 as int) + 1, 1)), '')"
ADAPTERS = duck("reads") + f""", s as (select {', '.join(KEYS)}, {DECODED} || substr(case when k1 % 5 = 0 then 'GATCACAGGT' else 'GATTACAGGT' end, 1, cast(k2 + 3 as int)) t from reads),
p as (select *, list_transform(range(0, length(t)), lambda i: struct_pack(i := i, n := least(length(t) - i, 10), m := len(list_filter(range(1, least(length(t) - i, 10) + 1), lambda j: substr(t, i + j, 1) = substr('GATTACAGGT', j, 1))))) x from s),
q as (select *, list_min(list_transform(list_filter(x, lambda z: z.n - z.m <= z.n * 0.1), lambda z: struct_pack(a := -z.m, b := z.i))) best from p)
select {', '.join(KEYS)}, case when best is null then t else substr(t, 1, cast(best.b as int)) end seq from q"""


def stretches(spark, d):
    """Known stretches of a code's bases with two unknown ones put in."""
    text = F.concat(F.substring(seq.decode(F.col("barcode"), 25), F.lit(1), (F.col("k1") % 25).cast("int")), F.lit("N"), seq.decode(F.col("barcode"), 25), F.lit("N"), F.repeat(F.lit("ACG"), F.col("k2").cast("int")))
    at = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x.start, x.length)), ",")
    place = (F.col("k1") % 30).cast("int")
    qual = F.concat(F.repeat(F.lit("J"), place), F.lit("#"), F.repeat(F.lit("J"), F.lit(39) - place))
    rows = derived(spark, d, "reads").withColumn("s", R.good_stretches(text, 12)).withColumn("q", R.good_stretches(F.lit("ACGT" * 10), 12, qual, 5))
    return rows.select(*KEYS, F.size("s").cast("long").alias("n"), at("s").alias("at"), at("q").alias("by_quality"))


STRETCHES = duck("reads") + f""", s as (select {', '.join(KEYS)}, cast(k1 % 25 as int) a, 3 * cast(k2 as int) c from reads)
select {', '.join(KEYS)}, cast((a >= 12)::int + 1 + (c >= 12)::int as bigint) n, concat_ws(',', case when a >= 12 then '0:' || a end, (a + 1) || ':25', case when c >= 12 then (a + 27) || ':' || c end) "at", concat_ws(',', case when k1 % 30 >= 12 then '0:' || (k1 % 30) end, case when 39 - k1 % 30 >= 12 then (k1 % 30 + 1) || ':' || (39 - k1 % 30) end) by_quality from s"""


def located(spark, d):
    chromosomes = spark.range(7).select(F.concat(F.lit("c"), F.col("id")).alias("chr"), (F.col("id") * 4_000_000).alias("chr_start"), (F.lit(3_000_000) + F.col("id") * 100_000).alias("chr_length"))
    places = table(spark, d, "lineitem").select(*[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], (F.col("l_partkey") * 13_007 + F.col("l_suppkey")).alias("pos"))
    return A.locate(places, chromosomes).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pos", "chr", (F.col("pos") - F.col("chr_start")).alias("at"))


LOCATED = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, pos, 'c' || (pos // 4000000) chr, pos % 4000000 "at" from (select *, l_partkey * 13007 + l_suppkey pos from lineitem) where pos // 4000000 < 7 and pos % 4000000 < 3000000 + (pos // 4000000) * 100000"""

def cells(spark, d):
    """A mask's cells; up to two barcodes a spot."""
    return B.mask_cells(derived(spark, d, "chip_map").select("barcode", (F.col("x") + 3).alias("x"), (F.col("y") + 5).alias("y")), 4)


CELLS = duck("chip_map") + """ select y - min(y) over () "row", x - min(x) over () col, cast(row_number() over (partition by x, y order by barcode) - 1 as int) segment, barcode from chip_map"""

QUERIES = {
    "adapter_clip": (adapters, ADAPTERS),
    "good_stretches": (stretches, STRETCHES),
    "chromosome_locate": (located, LOCATED),
    "barcode_exact_counts": (exact_counts, duck("chip_map", "reads") + " " + COUNTS),
    "barcode_neighbor_join_k1": (neighbor(1), neighbor_sql(1)),
    "barcode_neighbor_join_k2": (neighbor(2), neighbor_sql(2)),
    "barcode_neighbor_join_k3": (neighbor(3), neighbor_sql(3)),
    "mask_cells": (cells, CELLS),
    "barcode_n_rescue": (n_rescue, N_RESCUE),
    "barcode_overlap_stats": (lambda s, d: B.overlap_stats(runs(s, d)), OVERLAP + """ select count(*) codes, cast(sum(n) as bigint) reads, count_if(coalesce(d = 0, false)) exact, cast(coalesce(sum(case when d = 0 then n end), 0) as bigint) exact_reads,
 count_if(coalesce(d > 0, false)) near, cast(coalesce(sum(case when d > 0 then n end), 0) as bigint) near_reads, count_if(coalesce(d = -1, false)) ambiguous, count_if(d is null) unmet, count_if(coalesce(d >= 0 and n1 = 1, false)) met_once from met"""),
    "barcode_base_transfer_matrix": (transfer, OVERLAP + """ select cast(place as int) place, cast((hit >> (2 * place)) & 3 as int) base, cast((barcode >> (2 * place)) & 3 as int) read_as, cast(sum(n) as bigint) n from (select hit, barcode, n, cast(unnest(range(0, 25)) as int) place from met where d > 0)
 where (hit >> (2 * place)) & 3 <> (barcode >> (2 * place)) & 3 group by all"""),
    "barcode_dup_positions": (dup_positions, DUP),
    "barcode_segment_counts": (segments, SEGMENTS),
    "umi_filter_cascade": (umi_cascade, MAPPED + " select coalesce(reason, 'kept') reason, count(*) n from mapped where how is not null group by 1"),
    "quality_histogram": (qualities, QUALITIES),
    "polya_trim": (poly_a, POLY_A),
    "mapping_report": (report, REPORT),
    "mask_geometry": (mask, MASK),
    "merge_coordinate_lists": (merged, MERGED),
    "heatmap_box_sum": (boxes, BOXES),
}
