"""Alignments as arrays of blocks: seeds in windows, validity, scores, CIGAR forms, NM and MD, mates, output filters.

``blocks``: array of (r, g, len, frag), read and genome starts from 0 and the mate's number; ``gaps``: array, one shorter, of
(kind, annot, left, right): -3 the gap between mates, -2 an insertion, -1 a deletion, 0 and on a junction's motif; whether it is
annotated; the bases by which it could slide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores of gaps by motif class (0 other, 1 GT/AG, 2 GC/AG, 3 AT/AC), of indels, of annotated junctions.
MOTIF_SCORES, INDEL_OPEN, INDEL_BASE, ANNOTATED = (-8, 0, -4, -8), -2, -2, 2


def seed_starts(stretches: Column, read_length: Column, most: int = 50, share: float = 1.0) -> Column:
    """array of (start, backwards): where the search for seeds begins in each good stretch (start, length): a stretch longer
    than the least of ``most`` and ``share`` of the read is cut into equal parts, each begun from both ends."""
    limit = F.least(F.lit(most), F.floor(share * (read_length - 1)).cast("int"))
    n = lambda s: F.when(limit < s.length, F.floor(s.length / F.greatest(limit, F.lit(1))).cast("int") + 1).otherwise(1)
    part = lambda s: F.floor(s.length / n(s)).cast("int")
    each = lambda s: F.transform(F.sequence(F.lit(0), n(s) - 1), lambda i: F.array(F.struct((s.start + i * part(s)).alias("start"), F.lit(False).alias("back")), F.struct((s.start + s.length - 1 - i * part(s)).alias("start"), F.lit(True).alias("back"))))
    return F.flatten(F.flatten(F.transform(stretches, each)))


def store_seeds(seeds: DataFrame, read: list[str], loci_most: int = 10_000, most: int = 1000) -> DataFrame:
    """Seeds (r_start, length, loci) of each read, once each and without those of over ``loci_most`` loci, numbered from 1 by start, longer ones first; a read with over ``most`` of them raises."""
    one = seeds.where(F.col("loci") <= loci_most).dropDuplicates([*read, "r_start", "length"])
    number = F.row_number().over(Window.partitionBy(*read).orderBy("r_start", F.desc("length")))
    return one.withColumn("seed", F.when(number > most, F.raise_error(F.lit(f"a read has over {most} seeds")).cast("int")).otherwise(number))


def seed_windows(seeds: DataFrame, windows: DataFrame, read: list[str], bits: int = 16) -> DataFrame:
    """Seeds joined to their read's window that holds their bin; of seeds on one diagonal (read start minus genome start, mate and
    junction alike) that overlap on the read, the longest stays, then the first.

    ``seeds``: read, chr, str, r_start, g_start, length, frag, sj; ``windows``: read, chr, str, window, first_bin, last_bin (disjoint). A read's windows are few, so the join is by its key; the runs of overlapping seeds of a diagonal are islands."""
    on = [*read, "chr", "str"]
    met = seeds.withColumn("_b", F.floor(F.col("g_start") / (1 << bits))).join(windows, on).where("_b between first_bin and last_bin")
    line = [*on, "window", "frag", "sj", "_d"]
    met = met.withColumn("_d", F.col("r_start") - F.col("g_start"))
    before = Window.partitionBy(*line).orderBy("r_start", F.desc("length"))
    reach = F.max(F.col("r_start") + F.col("length")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.coalesce((F.col("r_start") >= F.col("_e")).cast("int"), F.lit(0))).over(before.rowsBetween(Window.unboundedPreceding, 0))
    met = met.withColumn("_e", reach).withColumn("_run", run)
    best = F.row_number().over(Window.partitionBy(*line, "_run").orderBy(F.desc("length"), "r_start"))
    return met.withColumn("_r", best).where("_r = 1").drop("_b", "_d", "_e", "_run", "_r", "first_bin", "last_bin")


def split_hit(place: Column, length: Column, overhang: int, donor: Column, acceptor: Column) -> Column:
    """Pieces (offset, g, len) of a hit at ``place`` of a junction's joined flanks (``overhang`` bases each, that begin at ``donor`` and ``acceptor``); null if it doesn't cross the junction."""
    left = F.lit(overhang) - place
    pieces = F.array(F.struct(F.lit(0).alias("offset"), (donor + place).alias("g"), left.alias("len")), F.struct(left.alias("offset"), acceptor.alias("g"), (length - left).alias("len")))
    return F.when((left > 0) & (left < length), pieces)


def _pairs(gaps: Column) -> Column:
    """array of (i, gap, p, q): each gap with the blocks before and after it."""
    at = F.sequence(F.lit(0), F.size(gaps) - 1)
    rows = F.transform(at, lambda i: F.struct(i.alias("i"), F.get(gaps, i).alias("gap"), F.get("blocks", i).alias("p"), F.get("blocks", i + 1).alias("q")))
    return F.when(F.size(gaps) > 0, rows).otherwise(F.slice(rows, 1, 0))


def invalid(overhang: int = 5, annotated_overhang: int = 3, spliced_least: int = 0, spliced_share: float = 0.66, noncanonical: str = "keep", strands: bool = True, protrude: int = 0) -> Column:
    """Why an alignment is not reported, null if it is; the first of: short_annotated, short_overhang (with the bases that a
    junction could slide), strands (junctions of both), noncanonical (``keep``, ``drop``, ``drop_new``), short_mate (a spliced
    mate with few aligned bases), mates (the second ends before the first begins, or one reaches beyond the other's end).

    Columns: blocks, gaps, read_length (of the row), mate_length (of a mate)."""
    pairs, n = _pairs(F.col("gaps")), F.size("blocks")
    gap = lambda i: F.get("gaps", i)
    joins = lambda g: g.kind >= 0
    new = lambda g: joins(g) & (g.annot == 0)
    # at an annotated junction a short block is bad where nothing annotated holds its other end
    edge = lambda i: F.when((i < 0) | (i > n - 2), True).otherwise((gap(i).kind == -3) | new(gap(i)))
    short_annotated = F.exists(pairs, lambda x: joins(x.gap) & (x.gap.annot == 1) & (((x.p.len < annotated_overhang) & edge(x.i - 1)) | ((x.q.len < annotated_overhang) & edge(x.i + 1))))
    short_new = F.exists(pairs, lambda x: new(x.gap) & ((x.p.len < overhang + x.gap.left) | (x.q.len < overhang + x.gap.right)))
    strand = F.transform(F.filter("gaps", lambda g: g.kind > 0), lambda g: 2 - g.kind % 2)
    both = (F.size(F.array_distinct(strand)) > 1) & F.lit(strands)
    bad_motif = {"keep": F.lit(False), "drop": F.exists("gaps", lambda g: g.kind == 0), "drop_new": F.exists("gaps", lambda g: (g.kind == 0) & (g.annot == 0))}[noncanonical]
    cut = F.coalesce(F.array_min(F.transform(F.filter(pairs, lambda x: x.gap.kind == -3), lambda x: x.i)), n)  # the last block of the first mate
    length = lambda part: F.aggregate(part, F.lit(0), lambda s, b: s + b.len)
    spliced = lambda low, high: F.exists(pairs, lambda x: joins(x.gap) & (x.i >= low) & (x.i < high))
    first, second = F.slice("blocks", F.lit(1), F.least(cut + 1, n)), F.slice("blocks", F.least(cut + 2, n + 1), n)
    least = F.greatest(F.lit(spliced_least), F.floor(spliced_share * F.col("mate_length")).cast("int"))
    short_mate = (spliced(F.lit(0), cut) & (length(first) < least)) | ((cut < n) & spliced(cut + 1, n) & (length(second) < least))
    a, m, b, z = F.get("blocks", F.lit(0)), F.get("blocks", cut), F.get("blocks", cut + 1), F.get("blocks", n - 1)
    over = (a.g > b.g + a.r + protrude) | (m.g + m.len > z.g + F.col("read_length") - z.r + protrude)
    mates = (cut < n) & ((z.g + z.len <= a.g) | ((m.g + m.len > b.g) & over))
    return F.when(short_annotated, "short_annotated").when(short_new, "short_overhang").when(both, "strands").when(bad_motif, "noncanonical").when(F.coalesce(short_mate, F.lit(False)), "short_mate").when(F.coalesce(mates, F.lit(False)), "mates")


def score(matches: Column, mismatches: Column, log_scale: float = 0.25) -> Column:
    """Matches less mismatches, the gaps' scores, and a term for the genomic length: ceil(log2(length) * -scale - 0.5)."""
    one = lambda x: F.when(x.gap.annot == 1, ANNOTATED).when(x.gap.kind == -3, 0).when(x.gap.kind == -2, (x.q.r - x.p.r - x.p.len) * INDEL_BASE + INDEL_OPEN).when(x.gap.kind == -1, (x.q.g - x.p.g - x.p.len) * INDEL_BASE + INDEL_OPEN).otherwise(F.element_at(F.array(*map(F.lit, MOTIF_SCORES)), F.floor((x.gap.kind + 1) / 2).cast("int") + 1))
    gaps = F.aggregate(_pairs(F.col("gaps")), F.lit(0).cast("long"), lambda s, x: s + one(x))
    last = F.get("blocks", F.size("blocks") - 1)
    span = F.greatest(last.g + last.len - F.get("blocks", F.lit(0)).g, F.lit(1))
    return matches - mismatches + gaps + F.ceil(F.log2(span.cast("double")) * -log_scale - 0.5)


def best_windows(rows: DataFrame, read: list[str]) -> DataFrame:
    """The window of each read with the highest score, of equal ones the shortest on the genome, then the first."""
    w = Window.partitionBy(*read).orderBy(F.desc("score"), "g_length", "window")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def _ops(x: Column) -> Column:
    """What lies between two blocks, as a CIGAR's operations: an insertion, then a junction or deletion."""
    r, g = x.q.r - x.p.r - x.p.len, x.q.g - x.p.g - x.p.len
    ins = F.when(r > 0, F.concat(r.cast("string"), F.lit("I"))).otherwise("")
    return F.concat(ins, F.when((x.gap.kind >= 0) | (x.gap.annot == 1), F.concat(g.cast("string"), F.lit("N"))).when(g > 0, F.concat(g.cast("string"), F.lit("D"))).otherwise(""))


def _clip(n: Column) -> Column:
    return F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")


def cigar(read_length: Column) -> Column:
    """The CIGAR of a read without a mate's gap."""
    first, last = F.get("blocks", F.lit(0)), F.get("blocks", F.size("blocks") - 1)
    body = F.transform(_pairs(F.col("gaps")), lambda x: F.concat(_ops(x), x.q.len.cast("string"), F.lit("M")))
    return F.concat(_clip(first.r), first.len.cast("string"), F.lit("M"), F.array_join(body, ""), _clip(read_length - last.r - last.len))


def cigar_pair(left: Column, whole: Column) -> Column:
    """The CIGAR of both mates in one string: the gap between them is p, negative where they overlap, between the clips of both
    sides. Read places of the second mate follow the first's ``left`` bases and one more; ``whole`` is the last place's end."""
    first, last = F.get("blocks", F.lit(0)), F.get("blocks", F.size("blocks") - 1)
    begin = first.r - F.when(first.r < left, 0).otherwise(left + 1)

    def between(x: Column) -> Column:
        g = x.q.g - x.p.g - x.p.len
        mates = F.concat(_clip(left - x.p.r - x.p.len), g.cast("string"), F.lit("p"), _clip(x.q.r - left - 1))
        return F.when(g < 0, F.concat(g.cast("string"), F.lit("p"))).when(x.gap.kind == -3, mates).otherwise(_ops(x))

    body = F.transform(_pairs(F.col("gaps")), lambda x: F.concat(between(x), x.q.len.cast("string"), F.lit("M")))
    end = F.when(last.r < left, left).otherwise(whole) - last.r - last.len
    return F.concat(_clip(begin), first.len.cast("string"), F.lit("M"), F.array_join(body, ""), _clip(end))


def mismatch_tags(read: Column, genome: Column) -> Column:
    """(nm, md) of an alignment: ``read`` has the read's bases at its blocks, ``genome`` the bases from the first block's start on
    without junctions; a deletion is told by its gap. NM counts differing or unknown bases and those of indels; MD has the runs
    of equal bases, the genome's base at each difference, and ^ with the bases of a deletion."""
    pairs = _pairs(F.col("gaps"))
    base = F.get("blocks", F.lit(0)).g
    # each block's place in ``genome``: less the junctions before it
    skipped = lambda i: F.aggregate(F.filter(pairs, lambda x: (x.i < i) & (x.gap.kind >= 0)), F.lit(0).cast("long"), lambda s, x: s + x.q.g - x.p.g - x.p.len)
    place = lambda i, b: (b.g - base - skipped(i)).cast("int")
    same = lambda x, y: (x == y) & x.isin(*"ACGT")

    def piece(i: Column, b: Column) -> Column:
        a, g = F.split(F.substring(read, b.r + 1, b.len), ""), F.split(F.substring(genome, place(i, b) + 1, b.len), "")
        text = F.zip_with(a, g, lambda x, y: F.when(same(x, y), F.lit("=")).otherwise(y))
        dropped = F.when(F.get("gaps", i).kind == -1, F.concat(F.lit("^"), F.substring(genome, place(i, b) + b.len + 1, (F.get("blocks", i + 1).g - b.g - b.len).cast("int")), F.lit("|"))).otherwise("")
        return F.concat(F.array_join(text, ""), F.coalesce(dropped, F.lit("")))

    line = F.array_join(F.transform("blocks", lambda b, i: piece(i, b)), "")
    # a run of equal bases, then what ends it: a base, or a deletion
    parts = F.regexp_extract_all(line, F.lit(r"(=*(?:\^[ACGTN]+\||[ACGTN]|$))"), F.lit(1))
    run = lambda p: F.length(p) - F.length(F.replace(p, F.lit("="), F.lit("")))
    bare = F.when(line.rlike("=$") | (F.length(line) == 0), parts).otherwise(F.concat(F.filter(parts, lambda p: p != ""), F.array(F.lit(""))))
    shown = F.filter(bare, lambda p: F.lit(True))
    md = F.array_join(F.transform(shown, lambda p: F.concat(run(p).cast("string"), F.replace(F.replace(p, F.lit("="), F.lit("")), F.lit("|"), F.lit("")))), "")
    md = F.when(line.rlike("=$"), F.regexp_replace(md, r"(?<=\d)0$", "")).otherwise(md)
    wrong = F.length(F.regexp_replace(line, r"\^[ACGTN]+\||=", ""))
    indels = F.aggregate(pairs, F.lit(0).cast("long"), lambda s, x: s + F.when(x.gap.kind == -1, x.q.g - x.p.g - x.p.len).when(x.gap.kind == -2, x.q.r - x.p.r - x.p.len).otherwise(0))
    return F.struct((wrong + indels).alias("nm"), md.alias("md"))


def pair_fields(pairs: DataFrame) -> DataFrame:
    """``rnext``, ``pnext`` and ``tlen`` of the mates of a pair (a row a mate: pair, mate, chr, start, end, from 1; null where
    unmapped). Mates of one chromosome have = and the signed span, plus for the first one on the genome (of equal starts mate 1)."""
    other = pairs.select("pair", (F.lit(3) - F.col("mate")).alias("mate"), *[F.col(c).alias(f"_{c}") for c in ("chr", "start", "end")])
    out = pairs.join(other, ["pair", "mate"], "left")
    one = F.col("chr") == F.col("_chr")
    span = F.greatest("end", "_end") - F.least("start", "_start") + 1
    ahead = (F.col("start") < F.col("_start")) | ((F.col("start") == F.col("_start")) & (F.col("mate") == 1))
    tlen = F.when(F.coalesce(one, F.lit(False)), F.when(ahead, span).otherwise(-span)).otherwise(0)
    name = F.when(F.col("_chr").isNull(), "*").when(F.coalesce(one, F.lit(False)), "=").otherwise(F.col("_chr").cast("string"))
    return out.withColumns({"rnext": name, "pnext": F.coalesce("_start", F.lit(0)), "tlen": tlen}).drop("_chr", "_start", "_end")


def output_rows(rows: DataFrame, read: list[str], most: int = -1, added: list[str] | None = None, pairs: bool = False) -> DataFrame:
    """What is written of a read's loci (chr, hi, mate): the first ``most`` (all if negative), or none if all of them lie on
    the ``added`` references; ``pairs``: only loci that both mates have."""
    out = rows if most < 0 else rows.where(F.col("hi") <= most)
    if added is not None:
        outside = F.max((~F.col("chr").isin(*added)).cast("int")).over(Window.partitionBy(*read))
        out = out.withColumn("_o", outside).where("_o = 1").drop("_o")
    if pairs:
        both = Window.partitionBy(*read, "hi")
        out = out.withColumn("_m", F.max("mate").over(both) - F.min("mate").over(both)).where("_m = 1").drop("_m")
    return out


def input_order(rows: DataFrame, number: str = "read_no", then: tuple[str, ...] = ("hi",)) -> DataFrame:
    """Rows in the order of the input: a range exchange by the read's number."""
    return rows.orderBy(number, *then)


def merge_mates(pairs: DataFrame, least: int = 10, wrong_share: float = 0.01) -> DataFrame:
    """``overlap`` and ``merged`` of mates on one strand (left, right): the longest overlap of at least ``least`` bases with at
    most that share of differing ones; null where there is none. ``protrude``: whether the right mate begins before the left."""
    left, right = F.col("left"), F.col("right")

    def found(a: str, b: str) -> Column:
        n = F.least(F.size(a), F.size(b))
        sizes = F.when(n >= least, F.sequence(F.lit(least), n)).otherwise(F.array().cast("array<int>"))
        differ = lambda k: F.zip_with(F.slice(a, F.size(a) - k + 1, k), F.slice(b, F.lit(1), k), lambda x, y: x != y)
        return F.array_max(F.filter(sizes, lambda k: F.size(F.filter(differ(k), lambda x: x)) <= F.floor(k * wrong_share)))

    out = pairs.withColumns({"_l": F.split("left", ""), "_q": F.split("right", "")})
    # generated, so that later filters and projections don't search anew
    both = F.struct(found("_l", "_q").alias("a"), found("_q", "_l").alias("b"))
    out = out.select(*pairs.columns, F.explode(F.array(both)).alias("_o")).select(*pairs.columns, F.col("_o.a").alias("_a"), F.col("_o.b").alias("_b"))
    turned = F.coalesce(F.col("_b") > F.coalesce("_a", F.lit(0)), F.lit(False))
    size = F.when(turned, F.col("_b")).otherwise(F.col("_a"))
    made = F.when(turned, F.concat(right, F.substring(left, F.col("_b") + 1, F.length(left)))).otherwise(F.concat(left, F.substring(right, F.col("_a") + 1, F.length(right))))
    return out.withColumns({"overlap": size, "protrude": F.when(size.isNotNull(), turned), "merged": F.when(size.isNotNull(), made)}).drop("_a", "_b")


def split_merged(alignments: DataFrame, left: str = "left_length", right: str = "right_length", at: str = "right_start") -> DataFrame:
    """``first`` and ``second``: a merged read's blocks cut back to its mates: the left one's first ``left`` bases, and the right
    one's from ``at`` on, both in the mate's own places."""

    def cut(low: Column, high: Column) -> Column:
        kept = F.filter("blocks", lambda b: (b.r < high) & (b.r + b.len > low))
        return F.transform(kept, lambda b: F.struct((F.greatest(b.r, low) - low).alias("r"), (b.g + F.greatest(b.r, low) - b.r).alias("g"), (F.least(b.r + b.len, high) - F.greatest(b.r, low)).alias("len")))

    return alignments.withColumns({"first": cut(F.lit(0), F.col(left)), "second": cut(F.col(at), F.col(at) + F.col(right))})


def better_of(pairs: DataFrame, merged: DataFrame, read: list[str]) -> DataFrame:
    """Of each read the merged mates' alignment where its score is not below the pair's."""
    m = merged.select(*read, F.col("score").alias("_s"))
    keep = pairs.join(m, read, "left").where(F.col("_s").isNull() | (F.col("_s") < F.col("score"))).drop("_s")
    p = pairs.groupBy(*read).agg(F.max("score").alias("_s"))
    won = merged.join(p, read, "left").where(F.col("_s").isNull() | (F.col("score") >= F.col("_s"))).drop("_s")
    return keep.withColumn("from_merged", F.lit(False)).unionByName(won.withColumn("from_merged", F.lit(True)))
