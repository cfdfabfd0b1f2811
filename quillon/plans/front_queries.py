"""Queries of the read front end and of barcode lists, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..operators import barcode as B
from ..operators import cells
from ..operators import frontend as E
from ..sources import readers, writers
from ..sources.shared import shared_path
from .fixtures import derived, duck, table

KEYS = ["k1", "k2", "k3", "k4", "k5"]
K = "k1, k2, k3, k4, k5"
DECODED = "array_to_string(list_transform(range({n} - 1, -1, -1), lambda i: substr('ACGT', cast(({c} >> (2 * i)) & 3 as int) + 1, 1)), '')"
D25, D10 = DECODED.format(n=25, c="barcode"), DECODED.format(n=10, c="umi")
NAME = "'r' || k1 || '.' || k2 || '.' || k3 || '.' || k4 || '.' || cast(round(k5 * 100) as bigint)"


def name():
    return F.concat(F.lit("r"), F.concat_ws(".", "k1", "k2", "k3", "k4", F.round(F.col("k5") * 100).cast("long")))


def pairs_on_disk(spark, d):
    """The reads as two FASTQ files of parts, written and read again: barcodes (25 bases, with N) and tags (10) in the
    first, bases made of the keys in the second."""
    rows = derived(spark, d, "reads").select(*KEYS, "barcode", "n_pos", "umi", name().alias("name"))
    text = seq.decode(F.col("barcode"), 25)
    text = F.when(F.col("n_pos") >= 0, F.overlay(text, F.lit("N"), F.lit(25) - F.col("n_pos"))).otherwise(text)
    text = F.when(F.col("k1") % 37 == 0, F.overlay(text, F.lit("NN"), F.lit(3))).otherwise(text)
    one = rows.select(*KEYS, F.concat("name", F.lit("/1")).alias("name"), F.concat(text, seq.decode(F.col("umi"), 10)).alias("seq"))
    two = rows.select(*KEYS, F.concat("name", F.lit("/2")).alias("name"), F.concat(F.repeat(F.lit("ACGGT"), F.lit(6)), seq.decode(F.col("umi"), 10)).alias("seq"))
    out = []
    for mate in (one, two):
        path = shared_path(spark, "reads")
        ranged = mate.withColumn("qual", F.repeat(F.lit("I"), F.length("seq"))).repartition(8, *KEYS).sortWithinPartitions(*KEYS)
        writers.fastq(ranged).write.text(path)
        out.append(readers.read_fastq(spark, path))
    return out


def front_end(spark, d):
    """FASTQ pairs to named, coded and routed reads."""
    pairs = E.slice_tags(readers.pair(*pairs_on_disk(spark, d)))
    rows = E.split_unknown(E.check_lengths(pairs, F.col("r1.seq"), 35))
    code = E.encode_or_fail(F.col("umi"))
    return rows.select(E.tagged_name(F.col("r2.name"), F.col("barcode"), code).alias("name"), "way", "n_pos", "barcode", code.alias("umi"), F.length("cb_qual").alias("quals"))


#: what the N put in makes of a code: those bases read as A
SET = "(n_pos >= 0)::int + case when k1 % 37 = 0 then 2 - (n_pos in (21, 22))::int else 0 end"
BLANK = "barcode & ~(case when n_pos >= 0 then 3::bigint << (2 * n_pos) else 0 end) & ~(case when k1 % 37 = 0 then 15::bigint << 42 else 0 end)"
FRONT = duck("reads") + f""", s as (select *, {SET} n, {BLANK} code, {NAME} nm from reads)
select nm || ' ' || to_hex(code) || ' ' || to_hex(cast(umi as bigint)) "name", case n when 0 then 'exact' when 1 then 'rescue' else 'drop' end way, cast(case when n = 1 then n_pos else -1 end as int) n_pos, code barcode, cast(umi as bigint) umi, 25 quals from s"""


def loaded(spark, d):
    """Reads whose names carry a position, a filter mark and a mate, in another quality offset."""
    rows = derived(spark, d, "reads")
    full = F.concat(name(), F.lit("|||CB:Z:"), F.concat_ws("_", "k2", "k4"), F.when(F.col("k1") % 3 == 0, "/2").otherwise("/1"), F.when(F.col("k1") % 4 == 0, " 1:Y:0:ACG").otherwise(" 2:N:0:ACG"))
    text = F.concat(F.lower(seq.decode(F.col("barcode"), 25)), F.when(F.col("k2") > 3, "GATTACAGGT").otherwise(""))
    made = rows.select(*KEYS, full.alias("name"), text.alias("seq"), F.repeat(F.lit("h"), F.length(text)).alias("qual"))
    out = E.load_reads(made, 2, 1, "GATTACAGG", -31)
    return out.select("read", F.array_join("tags", ",").alias("tags"), "mate", "failed", "seq", F.substring("qual", 1, 1).alias("q"), (F.length("qual") - F.length("seq")).alias("same"), "adapter_bases")


LOADED = duck("reads") + f""", s as (select *, {NAME} nm, {D25} || case when k2 > 3 then 'GATTACAGGT' else '' end whole from reads),
t as (select *, substr(whole, 3, length(whole) - 3) t from s),
x as (select *, list_transform(range(0, length(t)), lambda i: struct_pack(i := i, n := least(length(t) - i, 9), m := len(list_filter(range(1, least(length(t) - i, 9) + 1), lambda j: substr(t, i + j, 1) = substr('GATTACAGG', j, 1))))) x from t),
b as (select *, list_min(list_transform(list_filter(x, lambda z: z.n - z.m <= z.n * 0.1), lambda z: struct_pack(a := -z.m, b := z.i))) best from x),
e as (select *, case when best is null then length(t) else best.b end n from b)
select nm "read", 'CB:Z:' || k2 || '_' || k4 || case when k1 % 3 = 0 then '/2' else '/1' end tags, cast(case when k1 % 3 = 0 then 2 else 1 end as int) mate, k1 % 4 = 0 failed, substr(t, 1, cast(n as int)) seq, case when n = 0 then '' else 'I' end q, 0 same, cast(length(t) - n as int) adapter_bases from e"""


def tag_slices(spark, d):
    rows = derived(spark, d, "reads")
    text = F.concat(seq.decode(F.col("barcode"), 25), F.when(F.col("k1") % 5 == 0, F.repeat(F.substring(F.lit("ACGT"), (F.col("k2") % 4 + 1).cast("int"), F.lit(1)), F.lit(10))).when(F.col("k1") % 7 == 0, "ACGTNACGTA").otherwise(seq.decode(F.col("umi"), 10)))
    text = F.substring(text, F.lit(1), F.when(F.col("k1") % 11 == 0, 30).otherwise(35))
    return E.cell_tags(rows.select(*KEYS, text.alias("seq")), (0, 16), (25, 10)).select(*KEYS, "cb", "umi", "reject")


TAGS = duck("reads") + f""", s as (select *, substr({D25} || case when k1 % 5 = 0 then repeat(substr('ACGT', cast(k2 % 4 + 1 as int), 1), 10) when k1 % 7 = 0 then 'ACGTNACGTA' else {D10} end, 1, case when k1 % 11 = 0 then 30 else 35 end) t from reads)
select {K}, substr(t, 1, 16) cb, substr(t, 26, 10) umi, case when length(t) < 35 then 'short' when contains(substr(t, 26, 10), 'N') then 'n' when regexp_matches(substr(t, 26, 10), '^(A+|C+|G+|T+)$') then 'homopolymer' end reject from s"""


def whitelist_match(spark, d):
    """Candidates of each read's barcode in the chip's list."""
    chip = derived(spark, d, "chip_map").select("barcode")
    listed = cells.whitelist(chip.select(seq.decode(F.col("barcode"), 25).alias("cb")).unionAll(chip.limit(0).select(F.lit("").alias("cb"))), 25)
    codes = listed.select(seq.encode(F.col("cb")).alias("barcode"))
    reads = derived(spark, d, "reads").select(F.struct(*KEYS).alias("read"), "barcode", "n_pos", F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: (F.col("base_q") + i * F.col("k2")) % 41).alias("qual"))
    return B.match_cells(reads, codes, 25).select("read.*", "cb", "d", "q")


NEAR = "bit_count((xor(r.barcode, c.barcode) | (xor(r.barcode, c.barcode) >> 1)) & 6148914691236517205)"
MATCH = duck("chip_map", "reads") + f""", w as (select distinct barcode from chip_map),
m as (select * from reads where n_pos < 0 and barcode not in (select barcode from w)), u as (select distinct barcode from m),
n as (select r.barcode, c.barcode cb, cast(floor(log2(cast(xor(r.barcode, c.barcode) as double)) / 2) as int) p from u r, w c where {NEAR} = 1),
t as (select {K}, (barcode & ~(3::bigint << (2 * n_pos))) | (b << (2 * n_pos)) barcode from reads, (select unnest([0::bigint, 1, 2, 3]) b) where n_pos >= 0),
f as (select {K}, min(barcode) cb from t join w using (barcode) group by {K} having count(*) = 1)
select {K}, barcode cb, 0 d, 0 q from reads where n_pos < 0 and barcode in (select barcode from w)
union all select {K}, n.cb, 1, cast((base_q + (24 - p) * k2) % 41 as int) from m join n using (barcode) union all select {K}, cb, 1, 0 from f"""


def features(spark, d):
    """Reasons of reads by the genes of their alignment."""
    b = derived(spark, d, "blocks").where("b = 0").select(F.when(F.col("k4") % 9 == 0, 0).otherwise(F.col("nh")).alias("nh"), F.when(F.col("k3") % 3 == 0, F.expr("cast(array() as array<bigint>)")).when(F.col("k3") % 5 == 0, F.array("k3", "k4")).otherwise(F.array("k3")).alias("genes"))
    return cells.assign_features(b)


FEATURES = duck("blocks") + """ select case when k4 % 9 = 0 then 'unmapped' when nh > 1 then 'multi' when k3 % 3 = 0 then 'no_feature' when k3 % 5 = 0 then 'ambiguous' else 'counted' end reason, count(*) n from blocks where b = 0 group by 1"""


def spots(spark, d):
    """Spots of a map's FASTQ: names end in the spot's number, barcodes are read backwards."""
    r = derived(spark, d, "reads")
    text = F.concat(F.lit("GG"), F.when(F.col("n_pos") >= 0, F.overlay(seq.decode(F.col("barcode"), 25), F.lit("N"), F.lit(4))).otherwise(seq.decode(F.col("barcode"), 25)))
    rows = r.select(F.concat(F.lit("chip_a_"), F.col("k1") * 10 + F.col("k2")).alias("name"), text.alias("seq"))
    return B.positions_from_reads(rows, 2, 25, 100, True, 300)


SPOTS = duck("reads") + f""" select cast(list_reduce(list_prepend(0::bigint, list_transform(range(0, 25), lambda i: 3 - ((barcode >> (2 * i)) & 3))), lambda a, x: a * 4 + x) as bigint) barcode, (k1 * 10 + k2) % 100 x, (k1 * 10 + k2) // 100 y from reads where n_pos < 0 and (k1 * 10 + k2) // 100 < 300"""


def types(spark, d):
    scores = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: (F.col("base_q") + i * F.col("k2")) % 41)
    return B.barcode_stats(derived(spark, d, "reads").select(*KEYS, "base_q", "barcode"), scores, KEYS)


TYPES = duck("reads") + f""", r as (select *, barcode c from reads), f as (select c, lag(c) over (order by {K}) p from r), t as (select c, count(*) n from r group by c),
s as (select sum(len(list_filter(range(0, 25), lambda i: (base_q + i * k2) % 41 < 10))) low from reads)
select (select count(*) from r) reads, (select count(*) from t) types, (select count_if(n = 1) from t) singles, (select cast(sum(n - 1) as bigint) from t) repeated, (select count_if(coalesce(c = p, false)) from f) follows, round((select low from s) * 100.0 / ((select count(*) from r) * 25), 2) low_percent"""


def poly(spark, d):
    r = derived(spark, d, "reads")
    text = F.when(F.col("k1") % 6 == 0, F.concat(F.repeat(F.lit("T"), F.lit(25) - F.col("k2").cast("int")), F.substring(seq.decode(F.col("barcode"), 25), F.lit(1), F.col("k2").cast("int")))).when(F.col("k1") % 6 == 1, F.overlay(seq.decode(F.col("barcode"), 25), F.lit("N"), F.lit(9))).otherwise(seq.decode(F.col("barcode"), 25))
    return r.select(*KEYS, B.poly_base(text, 0.8).alias("poly"), B.poly_t(text, 3).alias("poly_t"))


POLY = duck("reads") + f""", s as (select *, case when k1 % 6 = 0 then repeat('T', 25 - cast(k2 as int)) || substr({D25}, 1, cast(k2 as int)) when k1 % 6 = 1 then substr({D25}, 1, 8) || 'N' || substr({D25}, 10) else {D25} end t from reads)
select {K}, contains(t, 'N') or list_max(list_transform(['A', 'C', 'G', 'T'], lambda b: length(t) - length(replace(t, b, '')))) >= 20 poly, length(replace(t, 'T', '')) <= 3 poly_t from s"""


def plain_map(spark, d):
    near = F.expr("case when k1 % 13 = 0 then barcode | 1125899906842608 else barcode end")
    return B.map_plain(derived(spark, d, "reads").withColumn("barcode", near), derived(spark, d, "chip_map"), KEYS, 1, 3)


PLAIN = duck("chip_map", "reads") + f""", r as (select {K}, n_pos, case when k1 % 13 = 0 then barcode | 1125899906842608 else barcode end barcode from reads), c as (select barcode, x, y from chip_map),
p as (select r.*, x, y, length(replace({DECODED.format(n=25, c='r.barcode')}, 'T', '')) <= 3 t from r left join c using (barcode) where n_pos < 0),
t as (select {K}, (barcode & ~(3::bigint << (2 * n_pos))) | (b << (2 * n_pos)) barcode from r, (select unnest([0::bigint, 1, 2, 3]) b) where n_pos >= 0),
f as (select {K}, min(x) x, min(y) y from t join c using (barcode) group by {K} having count(*) = 1)
select {K}, case when t then 'poly_t' when x is not null then 'exact' end how, case when not t then x end x, case when not t then y end y from p
union all select {K}, case when x is not null then 'n' end, x, y from (select {K} from r where n_pos >= 0) left join f using ({K})"""


def strict(spark, d):
    return B.strict_unique(derived(spark, d, "chip_map").select("barcode", "x", "y").unionAll(derived(spark, d, "reads").where("n_pos < 0").select("barcode", F.lit(1).alias("x"), F.lit(2).alias("y"))))


STRICT = duck("chip_map", "reads") + " select barcode, min(x) x, min(y) y from (select barcode, x, y from chip_map union all select barcode, 1, 2 from reads where n_pos < 0) group by barcode having count(*) = 1"


def near_spots(spark, d):
    a = derived(spark, d, "chip_map").select("barcode", F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = derived(spark, d, "reads").where("n_pos < 0").select("barcode", "k1", "k2", "k3", (F.col("k1") % 128).cast("int").alias("x2"), (F.col("k4") % 20).cast("int").alias("y2"))
    met = a.join(b, "barcode").withColumn("near", B.near_spots(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), 20))
    return met.groupBy("near").agg(F.count("*").alias("n"), F.sum("k2").alias("k"))


SPOT = duck("chip_map", "reads") + " select abs(x - k1 % 128) <= 20 and abs(y - k4 % 20) <= 20 near, count(*) n, cast(sum(k2) as bigint) k from chip_map join reads using (barcode) where n_pos < 0 group by 1"


def variant(spark, d):
    scores = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("base_q") + i * F.col("k2")) % 41)
    rows = derived(spark, d, "reads").withColumn("u", F.when(F.col("k1") % 5 == 0, 0).otherwise(F.col("umi")))
    both = [B.umi_reason(F.col("u"), F.lit(False), scores, 10).alias("paired"), B.umi_reason(F.col("u"), F.lit(False), scores, 10, paired=False).alias("single")]
    return rows.select(*both).groupBy(*[F.coalesce(c, F.lit("kept")).alias(c) for c in ("paired", "single")]).agg(F.count("*").alias("n"))


VARIANT = duck("reads") + """, r as (select case when k1 % 5 = 0 then 0 else umi end u, len(list_filter(range(0, 10), lambda i: (base_q + i * k2) % 41 < 10)) low from reads)
select case when u = 0 then 'poly_a' when low > 1 then 'low_quality' else 'kept' end paired, case when u = 0 then 'poly_a' else 'kept' end single, count(*) n from r group by 1, 2"""


def ranges(spark, d):
    """The chip's range from the fields of view in use, and spots of fields on one plane."""
    f = table(spark, d, "supplier").select((F.col("s_suppkey") % 9 + 2).alias("fov_c"), (F.col("s_nationkey") % 7 + 1).alias("fov_r"), (F.col("s_suppkey") % 50).alias("x"), (F.col("s_suppkey") % 40).alias("y"), "s_suppkey")
    placed = B.field_positions(f, 50, 40, 3).agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.max("x").alias("mx"))
    return B.chip_range(f, 50, 40, 3).crossJoin(placed).withColumns({f"pitch{i}": F.lit(B.pitch(i)) for i in range(4)})  # one row each


RANGE = """with f as (select s_suppkey % 9 + 2 c, s_nationkey % 7 + 1 r, s_suppkey % 50 x, s_suppkey % 40 y from supplier)
select min((c - 1) * 53) x0, max((c - 1) * 53 + 49) x1, min((r - 1) * 43) y0, max((r - 1) * 43 + 39) y1, cast(sum(x + (c - 1) * 53) as bigint) sx, cast(sum(y + (r - 1) * 43) as bigint) sy, max(x + (c - 1) * 53) mx, 900 pitch0, 715 pitch1, 600 pitch2, 500 pitch3 from f"""


def rotation(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("block"), (F.col("n_nationkey") % 5).alias("col"), F.expr("n_nationkey div 5").alias("row"), (F.lit(10) + F.col("n_nationkey") % 5).alias("dnb_cols"), (F.lit(8) + F.expr("n_nationkey div 5")).alias("dnb_rows"))
    one = lambda turn: B.mask_positions(n, 2, turn).withColumn("turn", F.lit(turn))
    return one(0).unionByName(one(180))


ROTATION = """with b as (select n_nationkey block, n_nationkey % 5 col, n_nationkey // 5 row, 10 + n_nationkey % 5 w, 8 + n_nationkey // 5 h from nation),
c as (select col, coalesce(sum(max(w) + 2) over (order by col rows between unbounded preceding and 1 preceding), 0) x0, max(w) cw from b group by col),
r as (select row, coalesce(sum(max(h) + 2) over (order by row rows between unbounded preceding and 1 preceding), 0) y0, max(h) rh from b group by row),
z as (select (select max(y0 + rh) from r) high, (select max(x0 + cw) from c) wide),
s as (select block, col, row, w, unnest(range(0, cast(w * h as bigint))) dnb from b),
p as (select block, cast(dnb as int) dnb, x0 + dnb % w x, y0 + dnb // w y, high, wide from s join c using (col) join r using (row), z)
select block, dnb, cast(x as bigint) x, cast(y as bigint) y, 0 turn from p union all select block, dnb, cast(wide - 1 - x as bigint), cast(high - 1 - y as bigint), 180 from p"""


def pair_merge(spark, d):
    """Pairs cut from one fragment; some have a base changed, of low quality or high."""
    r = derived(spark, d, "reads")
    whole = F.concat(seq.decode(F.col("barcode"), 25), F.reverse(seq.decode(F.col("barcode"), 25)), F.lit("ACCGT"), seq.decode(F.col("umi"), 10))
    r = r.select(*KEYS, F.substring(whole, 1, 50).alias("a"), F.substring(whole, (F.col("k1") % 19 + 2).cast("int"), F.lit(46)).alias("b"))
    at = (F.col("k2") * 2).cast("int")
    b = F.when(F.col("k1") % 3 < 2, F.overlay(F.col("b"), F.lit("N"), at)).otherwise(F.col("b"))
    q = F.when(F.col("k1") % 3 == 0, F.overlay(F.repeat(F.lit("H"), F.lit(46)), F.lit("#"), at)).otherwise(F.repeat(F.lit("H"), F.lit(46)))
    r = r.select(*KEYS, "a", F.repeat(F.lit("I"), F.lit(50)).alias("p"), b.alias("b"), q.alias("q"))
    r = r.withColumn("overlap", B.merge_overlap(F.col("a"), F.col("p"), F.col("b"), F.col("q")))
    m = B.merge_reads(F.col("a"), F.col("p"), F.col("b"), F.col("q"), F.col("overlap"))
    return r.withColumn("m", F.when(F.col("overlap").isNotNull(), m)).select(*KEYS, F.coalesce("overlap", F.lit(-1)).alias("overlap"), "m.seq", "m.qual")


PAIR = duck("reads") + f""", w as (select {K}, {D25} || reverse({D25}) || 'ACCGT' || {D10} f, cast(k2 * 2 as int) j from reads),
s as (select {K}, j, substr(f, 1, 50) a, substr(f, cast(k1 % 19 + 2 as int), 46) b0 from w),
t as (select *, case when k1 % 3 < 2 then substr(b0, 1, j - 1) || 'N' || substr(b0, j + 1) else b0 end b, case when k1 % 3 = 0 then repeat('H', j - 1) || '#' || repeat('H', 46 - j) else repeat('H', 46) end q from s),
o as (select *, list_min(list_filter(range(30, 47), lambda n: len(list_filter(range(1, n + 1), lambda i: substr(a, 50 - n + i, 1) <> substr(b, i, 1) and substr(q, i, 1) <> '#')) = 0
   and len(list_filter(range(1, n + 1), lambda i: substr(a, 50 - n + i, 1) <> substr(b, i, 1))) <= 2)) n from t)
select {K}, cast(coalesce(n, -1) as int) overlap, case when n is not null then substr(a, 1, 50 - n) || array_to_string(list_transform(range(1, n + 1), lambda i: case when substr(q, i, 1) = '#' then substr(a, 50 - n + i, 1) else substr(b, i, 1) end), '') || substr(b, n + 1) end seq,
 case when n is not null then repeat('I', cast(50 - n as int)) || array_to_string(list_transform(range(1, n + 1), lambda i: case when substr(a, 50 - n + i, 1) = substr(b, i, 1) then chr(cast(40 + ord(substr(q, i, 1)) as int)) when substr(q, i, 1) = '#' then 'I' else substr(q, i, 1) end), '') || substr(q, n + 1) end qual from o"""


def position_tags(spark, d):
    r = derived(spark, d, "reads").join(derived(spark, d, "chip_map"), "barcode").where("n_pos < 0")
    return r.select(*KEYS, "pk", seq.position_tag(F.col("x"), F.col("y")).alias("t"), seq.position_tag(F.col("x"), F.col("y"), seq.decode(F.col("umi"), 10)).alias("u"))


POSITION = duck("chip_map", "reads") + f" select {K}, pk, '|||CB:Z:' || x || '_' || y t, '|||CB:Z:' || x || '_' || y || '|||UR:Z:' || {D10} u from reads join chip_map using (barcode) where n_pos < 0"


def unplaced(spark, d):
    """Reads whose barcode the chip lacks, written as FASTQ and read again, their names with the mates' marks."""
    reads, chip = derived(spark, d, "reads").where("n_pos < 0"), derived(spark, d, "chip_map")
    lost = E.unmapped(reads, reads.join(chip.select("barcode"), "barcode", "left_semi"), KEYS)
    mate = (F.col("k1") % 2 + 1).cast("int")
    rows = lost.select(E.mate_marks(name(), mate, (F.col("k2") % 3).cast("int")).alias("name"), seq.decode(F.col("barcode"), 25).alias("seq")).withColumn("qual", F.repeat(F.lit("F"), F.lit(25)))
    path = shared_path(spark, "unmapped")
    writers.fastq(rows).write.option("compression", "gzip").text(path)
    return readers.read_fastq(spark, path).select("name", "seq", "qual")


UNPLACED = duck("chip_map", "reads") + f""" select {NAME} || ' ' || (k1 % 2) || ':N: ' || case k2 % 3 when 1 then '10' when 2 then '01' else '00' end "name", {D25} seq, repeat('F', 25) qual from reads where n_pos < 0 and barcode not in (select barcode from chip_map)"""


def interleaved(spark, d):
    """Mates one after the other in a list of files, the first reads only."""
    r = derived(spark, d, "reads").select(*KEYS, name().alias("name"), seq.decode(F.col("barcode"), 25).alias("s"))
    both = F.concat(F.lit("@"), F.col("name"), F.lit("/1\n"), F.col("s"), F.lit("\n+\n"), F.repeat(F.lit("I"), F.lit(25)), F.lit("\n@"), F.col("name"), F.lit("/2\n"), F.reverse("s"), F.lit("\n+\n"), F.repeat(F.lit("H"), F.lit(25)))
    path, listed = shared_path(spark, "interleaved"), shared_path(spark, "list")
    r.repartitionByRange(4, *KEYS).sortWithinPartitions(*KEYS).select(both.alias("value")).write.text(path)
    spark.createDataFrame([(path,)], "value string").coalesce(1).write.text(listed)
    got = readers.interleaved(readers.read_fastq(spark, readers.paths_of(spark, listed)))
    return E.first_reads(got, -1).select(F.col("r1.name").alias("n1"), F.col("r2.name").alias("n2"), F.col("r1.seq").alias("s1"), F.col("r2.seq").alias("s2"), F.col("r2.qual").alias("q2"))


INTERLEAVED = duck("reads") + f""" select {NAME} || '/1' n1, {NAME} || '/2' n2, {D25} s1, reverse({D25}) s2, repeat('H', 25) q2 from reads"""


def limited(spark, d):
    """The first thousand pairs of each file of the front end."""
    one, _ = pairs_on_disk(spark, d)
    return E.first_reads(one, 100).groupBy("read_no").agg(F.count("*").alias("files"))


QUERIES = {
    "read_front_end": (front_end, FRONT),
    "aligner_loader": (loaded, LOADED),
    "cell_tag_slices": (tag_slices, TAGS),
    "whitelist_match": (whitelist_match, MATCH),
    "feature_reasons": (features, FEATURES),
    "map_spots_from_reads": (spots, SPOTS),
    "barcode_types": (types, TYPES),
    "poly_letter_filter": (poly, POLY),
    "plain_barcode_map": (plain_map, PLAIN),
    "strict_positions": (strict, STRICT),
    "near_spots": (near_spots, SPOT),
    "umi_filter_variant": (variant, VARIANT),
    "chip_range": (ranges, RANGE),
    "mask_rotation": (rotation, ROTATION),
    "pair_overlap_merge": (pair_merge, PAIR),
    "position_tags": (position_tags, POSITION),
    "unmapped_reads_sink": (unplaced, UNPLACED),
    "interleaved_pairs": (interleaved, INTERLEAVED),
    "read_limit": (limited, "select unnest(range(0, 100)) read_no, cast(8 as bigint) files"),
}
