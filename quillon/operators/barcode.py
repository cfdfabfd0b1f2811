"""The barcode stage: dictionary joins exact, near and over an unknown base; filters, counters, reports, chip geometry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq

BROADCAST_ROWS = 2_000_000  # a dictionary of up to so many rows (about 50 MB) may be sent to all executors


def with_dictionary(reads: DataFrame, dictionary: DataFrame, on: str, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Joins a dictionary by hash; it is broadcast only if its row count is given and small, otherwise Spark decides by measured sizes."""
    return reads.join(F.broadcast(dictionary) if rows is not None and rows <= BROADCAST_ROWS else dictionary, on, how)


def coordinate_counts(reads: DataFrame, chip: DataFrame) -> DataFrame:
    """(x, y, n): reads of each coordinate by exact barcode. Reads are counted by barcode before the join, so a hot barcode crosses it once."""
    per = reads.groupBy("barcode").agg(F.count("*").alias("n"))
    return with_dictionary(per, chip.select("barcode", "x", "y"), "barcode").groupBy("x", "y").agg(F.sum("n").alias("n"))


def _changed(code: Column, length: int) -> Column:
    """A code and all codes one base from it."""
    return F.array(code, *[code.bitwiseXOR(F.lit(c << (2 * i))) for i in range(length) for c in (1, 2, 3)])


def neighbours(queries: DataFrame, dictionary: DataFrame, length: int = 25, radius: int = 1) -> DataFrame:
    """(barcode, hit, d): dictionary codes within ``radius`` (1 to 3) of each distinct query code, itself too.

    One half of the bases of a pair has at most radius // 2 differences, so dictionary codes are indexed by either half, and queries look up each half with that many changes: 2 keys at radius 1 and about 80 at radius 2 and 3, where all codes in reach would be 75, 2775 and 64 875."""
    if not 1 <= radius <= 3:
        raise ValueError("radius 1 to 3")
    low = length // 2
    halves = [(0, low), (low, length - low)]
    part = lambda c, at, n: F.shiftrightunsigned(c, 2 * at).bitwiseAND(F.lit((1 << (2 * n)) - 1))
    index = dictionary.select(F.col("barcode").alias("hit")).distinct().select("hit", F.posexplode(F.array(*[part(F.col("hit"), *h) for h in halves])).alias("half", "key"))
    keys = [_changed(part(F.col("barcode"), *h), h[1]) if radius > 1 else F.array(part(F.col("barcode"), *h)) for h in halves]
    probes = queries.select("barcode").distinct().select("barcode", F.posexplode(F.array(*keys)).alias("half", "ks")).select("barcode", "half", F.explode("ks").alias("key"))
    d = seq.distance(F.col("barcode"), F.col("hit"))
    return probes.join(index, ["half", "key"]).select("barcode", "hit", d.alias("d")).where(F.col("d") <= radius).distinct()


def nearest_unique(queries: DataFrame, chip: DataFrame, length: int = 25, radius: int = 1) -> DataFrame:
    """(barcode, radius, n_hits, x, y): of the codes that the map lacks, the first radius with hits; x and y only if it is one hit. The map's barcodes are unique."""
    missed = queries.select("barcode").distinct().join(chip.select("barcode"), "barcode", "left_anti")
    near = neighbours(missed, chip, length, radius)
    first = near.groupBy("barcode", "d").agg(F.count("*").alias("n"), F.min("hit").alias("hit")).groupBy("barcode").agg(F.min(F.struct("d", "n", "hit")).alias("f"))
    found = first.select("barcode", F.col("f.d").alias("radius"), F.col("f.n").alias("n_hits"), F.when(F.col("f.n") == 1, F.col("f.hit")).alias("hit"))
    at = chip.select(F.col("barcode").alias("hit"), "x", "y")
    return found.join(at, "hit", "left").select("barcode", "radius", "n_hits", "x", "y")


def rescue_n(reads: DataFrame, chip: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, x, y of reads with one unknown base (bit pair ``n_pos``) for which one of the four bases alone gives a code of the map. Candidates are looked up once for each distinct (code, place)."""
    one = reads.where("n_pos >= 0").withColumn("blank", F.col("barcode").bitwiseAND(F.bitwise_not(F.expr("shiftleft(3L, 2 * n_pos)"))))
    tries = one.select("blank", "n_pos").distinct().select("blank", "n_pos", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("base")).withColumn("barcode", F.expr("blank | shiftleft(cast(base as bigint), 2 * n_pos)"))
    hits = tries.join(chip.select("barcode", "x", "y"), "barcode").groupBy("blank", "n_pos").agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y")).where("n = 1").drop("n")
    return one.join(hits, ["blank", "n_pos"]).select(*keys, "x", "y")


def overlap(run1: DataFrame, run2: DataFrame, length: int = 25, radius: int = 1) -> DataFrame:
    """(barcode, n, hit, n1, d): each code of the second run with the code of the first that it meets: itself, else the only one of all radii pooled; ``d`` is null where there is none and -1 where there are several."""
    exact = run2.join(run1.select("barcode", F.col("n").alias("n1")), "barcode", "left")
    missed = exact.where("n1 is null").select("barcode")
    near = neighbours(missed, run1, length, radius).groupBy("barcode").agg(F.count("*").alias("hits"), F.min("hit").alias("hit"), F.min("d").alias("d"))
    near = near.join(run1.select(F.col("barcode").alias("hit"), F.col("n").alias("m1")), "hit")
    out = exact.join(near, "barcode", "left")
    single = F.col("hits") == 1
    hit = F.when(F.col("n1").isNotNull(), F.col("barcode")).when(single, F.col("hit"))
    d = F.when(F.col("n1").isNotNull(), 0).when(single, F.col("d")).when(F.col("hits") > 1, -1)
    return out.select("barcode", "n", hit.alias("hit"), F.coalesce("n1", F.when(single, F.col("m1"))).alias("n1"), d.cast("int").alias("d"))


def overlap_stats(met: DataFrame) -> DataFrame:
    c = lambda w, v="1": F.coalesce(F.sum(F.expr(f"case when {w} then {v} else 0 end")), F.lit(0)).cast("long")
    return met.agg(
        F.count("*").alias("codes"), F.coalesce(F.sum("n"), F.lit(0)).alias("reads"), c("d = 0").alias("exact"), c("d = 0", "n").alias("exact_reads"), c("d > 0").alias("near"), c("d > 0", "n").alias("near_reads"),
        c("d = -1").alias("ambiguous"), c("d is null").alias("unmet"), c("d >= 0 and n1 = 1").alias("met_once"),
    )


def base_transfers(met: DataFrame, length: int = 25) -> DataFrame:
    """(place, base, read_as, n): bases of the first run's code against the second's, where they differ."""
    at = met.where("d > 0").select("hit", "barcode", "n", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("place"))
    base = lambda c: F.expr(f"cast(shiftright({c}, 2 * place) & 3 as int)")
    return at.select("place", base("hit").alias("base"), base("barcode").alias("read_as"), "n").where("base <> read_as").groupBy("place", "base", "read_as").agg(F.sum("n").alias("n"))


def resolve_positions(positions: DataFrame, drop: bool = False) -> DataFrame:
    """(barcode, x, y, n_positions, kind): a barcode of up to 4 positions pairwise at most one apart on both axes has the smallest of them; others keep the one first seen, taken as the smallest, and are ``duplicate`` (``drop``: go)."""
    out = positions.select("barcode", "x", "y").distinct().groupBy("barcode").agg(
        F.count("*").alias("n_positions"), F.min(F.struct("x", "y")).alias("p"), (F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy")
    )
    near = (F.col("n_positions") <= 4) & (F.col("dx") <= 1) & (F.col("dy") <= 1)
    kind = F.when(F.col("n_positions") == 1, "single").when(near, "neighbours").otherwise("duplicate")
    out = out.select("barcode", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "n_positions", kind.alias("kind"))
    return out.where("kind <> 'duplicate'") if drop else out


def strict_unique(positions: DataFrame) -> DataFrame:
    """Barcodes that occur once."""
    return positions.groupBy("barcode").agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y")).where("n = 1").drop("n")


def segment_counts(reads: DataFrame, length: int, segments: int, order: list[str]) -> DataFrame:
    """(part, n): reads of each distinct part of the code, parts of equal length counted once a read."""
    size = length // segments
    mask = (1 << (2 * size)) - 1
    parts = F.array_distinct(F.array(*[F.shiftrightunsigned("barcode", 2 * size * i).bitwiseAND(F.lit(mask)) for i in range(segments)]))
    return reads.select(F.explode(parts).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


def barcode_stats(reads: DataFrame, scores: Column, order: list[str], low: int = 10) -> DataFrame:
    """One row of a run's barcodes: reads, low_percent (bases under ``low``), types, singles, repeated (reads beyond a
    type's first), and follows: reads whose barcode is that of the read before them, an estimate of spots read twice.
    The order is found in ranges, whose first reads are compared with the last ones of the ranges before."""
    per = reads.groupBy("barcode").agg(F.count("*").alias("n"))
    types = per.agg(F.count("*").alias("types"), F.count_if(F.col("n") == 1).alias("singles"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"))
    bases = reads.agg(F.count("*").alias("reads"), F.sum(F.size(F.filter(scores, lambda s: s < low))).alias("_low"), F.sum(F.size(scores)).alias("_all"))
    ranged = reads.select("barcode", F.struct(*order).alias("o")).repartitionByRange("o").sortWithinPartitions("o").withColumn("part", F.spark_partition_id())
    w = Window.partitionBy("part").orderBy("o")
    inner = ranged.withColumn("_p", F.lag("barcode").over(w))
    ends = inner.groupBy("part").agg(F.min_by("barcode", "o").alias("first"), F.max_by("barcode", "o").alias("last"), F.count_if(F.col("barcode") == F.col("_p")).alias("k"))
    joined = ends.withColumn("_q", F.lag("last").over(Window.orderBy("part")))  # a row a range
    follows = joined.agg(F.coalesce(F.sum(F.col("k") + F.coalesce((F.col("first") == F.col("_q")).cast("int"), F.lit(0))), F.lit(0)).alias("follows"))
    out = bases.crossJoin(types).crossJoin(follows)  # one row each
    return out.withColumn("low_percent", percent(F.col("_low"), F.col("_all"))).drop("_low", "_all")


def umi_reason(umi: Column, has_n: Column, scores: Column | None = None, low: int = 11, most: int = 1, paired: bool = True) -> Column:
    """Why a tag is dropped: n, then poly_a (code 0), then, of paired reads, low_quality (over ``most`` bases under ``low``); null if it stays."""
    out = F.when(has_n, "n").when(umi == 0, "poly_a")
    return out.when(F.size(F.filter(scores, lambda s: s < low)) > most, "low_quality") if scores is not None and paired else out


def trim_poly_a(reads: DataFrame, window: int, mismatches: int, least: int = 30, text: str = "seq") -> DataFrame:
    """``pos``, ``dropped``, the kept sequence and, if there is a ``qual``, its kept qualities: a run of A that begins before ``least`` drops the read, a later one cuts it."""
    out = reads.withColumn("pos", seq.find_poly_a(F.col(text), window, mismatches))
    gone = (F.col("pos") >= 0) & (F.col("pos") < least)
    cut = lambda c: F.when(gone, "").when(F.col("pos") >= least, F.substring(F.col(c), F.lit(1), F.col("pos"))).otherwise(F.col(c))
    quals = {"kept_qual": cut("qual")} if "qual" in reads.columns else {}
    return out.withColumns({"dropped": gone, "kept": cut(text), **quals})


def percent(a: Column, b: Column) -> Column:
    return F.round(F.try_divide(a * F.lit(100.0), b), 2)


def mapping_report(mapped: DataFrame) -> DataFrame:
    """One row of counts and percentages from reads with ``how`` (exact, mismatch, n, null: not mapped) and ``reason`` (of a dropped tag)."""
    n = lambda e: F.count_if(F.coalesce(F.expr(e), F.lit(False)))
    out = mapped.agg(
        F.count("*").alias("total"), n("how is not null").alias("mapped"), n("how = 'exact'").alias("exact"), n("how = 'mismatch'").alias("mismatch"), n("how = 'n'").alias("with_n"),
        n("how is not null and reason is not null").alias("filtered"), n("how is not null and reason = 'poly_a'").alias("umi_poly_a"), n("how is not null and reason = 'low_quality'").alias("umi_low_quality"),
    )
    return out.withColumns({f"{c}_percent": percent(F.col(c), F.col("total")) for c in ("mapped", "exact", "mismatch", "with_n", "filtered")})


def mask_positions(blocks: DataFrame, track: int = 2, rotate: int = 0) -> DataFrame:
    """(block, dnb, x, y): every spot of a chip mask, its block shifted by the widths of the blocks before it and a track between, the chip turned by 0, 90 or 180 degrees. Blocks are few; spots are made by explode."""
    cols = blocks.groupBy("col").agg(F.max("dnb_cols").alias("w"))
    rows = blocks.groupBy("row").agg(F.max("dnb_rows").alias("h"))
    before = lambda by: Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    cols = cols.withColumn("x0", F.coalesce(F.sum(F.col("w") + track).over(before("col")), F.lit(0)))
    rows = rows.withColumn("y0", F.coalesce(F.sum(F.col("h") + track).over(before("row")), F.lit(0)))
    whole = cols.agg(F.max(F.col("x0") + F.col("w")).alias("wide")).crossJoin(rows.agg(F.max(F.col("y0") + F.col("h")).alias("high")))  # one row
    spots = blocks.join(cols, "col").join(rows, "row").crossJoin(F.broadcast(whole)).withColumn("dnb", F.explode(F.sequence(F.lit(0), F.col("dnb_cols") * F.col("dnb_rows") - 1)))
    x, y = F.col("x0") + F.col("dnb") % F.col("dnb_cols"), F.col("y0") + F.floor(F.col("dnb") / F.col("dnb_cols"))
    turned = {0: (x, y), 90: (F.col("high") - 1 - y, x), 180: (F.col("wide") - 1 - x, F.col("high") - 1 - y)}[rotate]
    return spots.select("block", "dnb", turned[0].cast("long").alias("x"), turned[1].cast("long").alias("y"))


def field_positions(positions: DataFrame, wide: int, high: int, gap: int) -> DataFrame:
    """Spots of fields of view (fov_c, fov_r from 1) on one plane."""
    return positions.withColumns({"x": F.col("x") + (F.col("fov_c") - 1) * (wide + gap), "y": F.col("y") + (F.col("fov_r") - 1) * (high + gap)})


def merge_lists(*lists: DataFrame) -> DataFrame:
    """(x, y, n) of several coordinate lists, counts added."""
    return reduce(DataFrame.unionByName, lists).groupBy("x", "y").agg(F.sum("n").alias("n"))


def box_sum(points: DataFrame, reach: int = 2) -> DataFrame:
    """(x, y, n): the sum of the square around each point of the raster that any point reaches."""
    shifts = F.explode(F.expr(f"flatten(transform(sequence(-{reach}, {reach}), i -> transform(sequence(-{reach}, {reach}), j -> struct(i as i, j as j))))"))
    return points.select("x", "y", "n", shifts.alias("s")).select((F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"), "n").groupBy("x", "y").agg(F.sum("n").alias("n"))


def downscale(points: DataFrame, factor: int) -> DataFrame:
    return points.select(F.floor(F.col("x") / factor).alias("x"), F.floor(F.col("y") / factor).alias("y"), "n").groupBy("x", "y").agg(F.sum("n").alias("n"))


def merge_overlap(left: Column, left_qual: Column, right: Column, right_qual: Column, least: int = 30, good: int = 30, poor: int = 15, most: int = 2) -> Column:
    """Bases by which a read's end and the other's start (on one strand) overlap: the first length from ``least`` on at
    which each difference is between a base of quality ``good`` or more and one of ``poor`` or less, ``most`` at most;
    null if there is none."""
    p, q = seq.phred(left_qual), seq.phred(right_qual)
    a, b = F.split(left, ""), F.split(right, "")
    size = F.least(F.length(left), F.length(right))

    def fits(n: Column) -> Column:
        pairs = F.zip_with(F.slice(a, F.length(left) - n + 1, n), F.slice(b, F.lit(1), n), lambda x, y: x != y)
        scores = F.zip_with(F.slice(p, F.length(left) - n + 1, n), F.slice(q, F.lit(1), n), lambda x, y: ((x >= good) & (y <= poor)) | ((x <= poor) & (y >= good)))
        wrong = F.filter(F.zip_with(pairs, scores, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda z: z.x)
        return F.forall(wrong, lambda z: z.y) & (F.size(wrong) <= most)

    return F.when(size >= least, F.array_min(F.filter(F.sequence(F.lit(least), size), fits)))


def merge_reads(left: Column, left_qual: Column, right: Column, right_qual: Column, overlap: Column, good: int = 30, poor: int = 15) -> Column:
    """(seq, qual) of two reads that overlap by that many bases: equal bases add their qualities; of different ones the
    left one's if it is good and the other poor, else the right one's."""
    n = F.length(left) - overlap
    p, q = F.slice(seq.phred(left_qual), n + 1, overlap), F.slice(seq.phred(right_qual), F.lit(1), overlap)
    base = F.zip_with(F.slice(F.split(left, ""), n + 1, overlap), F.slice(F.split(right, ""), F.lit(1), overlap), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    score = F.zip_with(p, q, lambda x, y: F.struct(x.alias("p"), y.alias("q")))
    one = F.zip_with(base, score, lambda z, w: F.when(z.x == z.y, F.struct(z.x.alias("b"), (w.p + w.q).alias("s"))).when((w.p >= good) & (w.q <= poor), F.struct(z.x.alias("b"), w.p.alias("s"))).otherwise(F.struct(z.y.alias("b"), w.q.alias("s"))))
    rest = lambda c: F.substring(c, overlap + 1, F.length(c))
    made = F.concat(F.substring(left, F.lit(1), n), F.array_join(F.transform(one, lambda z: z.b), ""), rest(right))
    quals = F.concat(F.substring(left_qual, F.lit(1), n), F.array_join(F.transform(one, lambda z: F.chr(z.s + 33)), ""), rest(right_qual))
    return F.struct(made.alias("seq"), quals.alias("qual"))


#: Distance of spots on a chip, in nanometres, by pitch class.
PITCHES = (900, 715, 600, 500)


def pitch(kind: int) -> int:
    return PITCHES[kind]


def chip_range(fields: DataFrame, wide: int, high: int, gap: int) -> DataFrame:
    """One row: least and largest x and y of the fields of view (fov_c, fov_r) in use."""
    x, y = (F.col("fov_c") - 1) * (wide + gap), (F.col("fov_r") - 1) * (high + gap)
    return fields.agg(F.min(x).alias("x0"), F.max(x + wide - 1).alias("x1"), F.min(y).alias("y0"), F.max(y + high - 1).alias("y1"))


def poly_base(code_text: Column, share: float = 0.8) -> Column:
    """Whether a barcode holds another letter than A, C, G, T, or one of them in at least that share."""
    n = F.length(code_text)
    most = F.greatest(*[n - F.length(F.replace(code_text, F.lit(b), F.lit(""))) for b in "ACGT"])
    return (seq.n_count(code_text) > 0) | (most >= n * share)


def poly_t(code_text: Column, most_other: int) -> Column:
    return F.length(F.replace(code_text, F.lit("T"), F.lit(""))) <= most_other


def map_plain(reads: DataFrame, chip: DataFrame, keys: list[str], radius: int = 0, other: int = 3, length: int = 25) -> DataFrame:
    """(keys, how, x, y) by the rule without neighbours: barcodes of almost only T are dropped first (``poly_t``); codes
    without unknown bases are looked up exactly; those with one (``n_pos``) are filled in only if ``radius`` is over 0."""
    text = seq.decode(F.col("barcode"), length)
    poly = (F.col("n_pos") < 0) & poly_t(text, other)
    plain = reads.where("n_pos < 0").withColumn("_t", poly).join(chip.select("barcode", "x", "y"), "barcode", "left")
    how = F.when(F.col("_t"), "poly_t").when(F.col("x").isNotNull(), "exact")
    found = plain.select(*keys, how.alias("how"), *[F.when(how == "exact", F.col(c)).alias(c) for c in ("x", "y")])
    unknown = reads.where("n_pos >= 0").select(*keys)
    if radius == 0:
        return found.unionByName(unknown.select(*keys, F.lit(None).cast("string").alias("how"), *[F.lit(None).cast(chip.schema[c].dataType).alias(c) for c in ("x", "y")]))
    filled = rescue_n(reads, chip, keys)
    return found.unionByName(unknown.join(filled, keys, "left").withColumn("how", F.when(F.col("x").isNotNull(), "n")).select(*keys, "how", "x", "y"))


def near_spots(x1: Column, y1: Column, x2: Column, y2: Column, distance: int) -> Column:
    """Signed difference on both axes within a distance: an estimate of one spot read twice."""
    return (F.abs(x1 - x2) <= distance) & (F.abs(y1 - y2) <= distance)


def positions_from_reads(reads: DataFrame, start: int, length: int, columns: int, reverse: bool = False, rows: int | None = None) -> DataFrame:
    """(barcode, x, y) from reads whose name ends in a spot's number; reads with another letter in the barcode are dropped, as are spots off a mask of ``rows`` rows."""
    text = F.substring("seq", start + 1, length)
    spot = F.regexp_extract("name", r"(\d+)\D*$", 1).try_cast("long")
    code = seq.encode(seq.reverse_complement(text) if reverse else text)
    return reads.select(code.alias("barcode"), (spot % columns).alias("x"), F.floor(spot / columns).alias("y")).where("barcode is not null and x is not null").where(F.lit(True) if rows is None else F.col("y") < rows)


def mask_cells(positions: DataFrame, segments: int) -> DataFrame:
    """(row, col, segment, barcode): the cells of a chip mask; a spot's barcodes fill its segments in order, more than there are raise."""
    w = Window.partitionBy("x", "y").orderBy("barcode")
    out = positions.select("barcode", "x", "y").distinct().withColumn("segment", F.row_number().over(w) - 1)
    full = F.when(F.col("segment") >= segments, F.raise_error(F.lit("a spot has more barcodes than segments")).cast("int")).otherwise(F.col("segment"))
    low = positions.agg(F.min("x").alias("_x"), F.min("y").alias("_y"))
    return out.crossJoin(low).select((F.col("y") - F.col("_y")).alias("row"), (F.col("x") - F.col("_x")).alias("col"), full.alias("segment"), "barcode")  # low is one row


def match_cells(reads: DataFrame, whitelist: DataFrame, length: int) -> DataFrame:
    """(read, cb, d, q): candidates of each read's cell barcode: itself if it is listed, else all listed ones one base off, with the quality of the base that differs; a read with one unknown base (``n_pos``) has the listed ones of its four fillings, if that is one.

    ``reads``: read, barcode, n_pos (-1 for none), qual (array of scores); ``whitelist``: barcode."""
    full = reads.where("n_pos < 0")
    exact = full.join(whitelist.select("barcode"), "barcode", "left_semi").select("read", F.col("barcode").alias("cb"), F.lit(0).alias("d"), F.lit(0).alias("q"))
    rest = full.join(whitelist.select("barcode"), "barcode", "left_anti")
    near = neighbours(rest.select("barcode"), whitelist, length, 1)
    x = F.col("barcode").bitwiseXOR(F.col("hit"))
    place = F.floor(F.log2(x.cast("double")) / 2).cast("int")  # from the last base
    one = rest.join(near, "barcode").select("read", F.col("hit").alias("cb"), F.lit(1).alias("d"), F.get("qual", F.lit(length - 1) - place).cast("int").alias("q"))
    filled = rescue_n(reads, whitelist.select("barcode", F.col("barcode").alias("x"), F.lit(0).alias("y")), ["read"]).select("read", F.col("x").alias("cb"), F.lit(1).alias("d"), F.lit(0).alias("q"))
    return exact.unionByName(one).unionByName(filled)
