"""Chimeric reads: pairs of segments, breakpoints, rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segment_pairs(segments: DataFrame, read: list[str], score_min: int = 0, drop_max: int = 20, score_range: int = 1, gap_max: int = 0, loci_max: int = 10, single: str = "single") -> DataFrame:
    """Pairs (a before b on the read) of a read's segments with few bases between or shared, a summed score of at least ``score_min`` and within ``drop_max`` of the read's length, within ``score_range`` of the best; reads of over ``loci_max`` such pairs are dropped.

    ``segments``: read, seg (number), r_start, r_end, chr, g_start, strand, score, length. A read's segments are few, so the self-join is one of keys."""
    cols = ["seg", "r_start", "r_end", "chr", "g_start", "strand", "score"]
    a = segments.select(*read, "length", *[F.col(c).alias(f"{c}_a") for c in cols])
    b = segments.select(*read, *[F.col(c).alias(f"{c}_b") for c in cols])
    between = F.col("r_start_b") - F.col("r_end_a") - 1
    pairs = a.join(b, read).where((F.col("r_start_a") < F.col("r_start_b")) & (F.col("r_end_a") < F.col("r_end_b")) & (between <= gap_max))
    pairs = pairs.withColumn("score", F.col("score_a") + F.col("score_b") + F.least(between, F.lit(0))).where((F.col("score") >= score_min) & (F.col("score") >= F.col("length") - drop_max))
    w = Window.partitionBy(*read)
    near = pairs.withColumn("_m", F.max("score").over(w)).where(F.col("score") >= F.col("_m") - score_range).withColumn("n_pairs", F.count("*").over(w)).where(F.col("n_pairs") <= loci_max)
    return near.drop("_m", "score_a", "score_b")


def best_second(segments: DataFrame, read: list[str], score_min: int = 0, drop_max: int = 20, separation: int = 10) -> DataFrame:
    """The main segment of each read (the highest score, then the first number) with its best partner: of the segments beside it on the read the highest score, which must be ``separation`` above the next one's; the two scores must sum to ``score_min`` and to the read's length less ``drop_max`` at least. Columns as in ``segment_pairs``, a before b on the read.

    A read's segments are few; three windows over one exchange find all of it."""
    w = Window.partitionBy(*read)
    order = w.orderBy(F.desc("score"), "seg")
    ranked = segments.withColumn("_r", F.row_number().over(order))
    main = lambda c: F.max(F.when(F.col("_r") == 1, F.col(c))).over(w)
    rows = ranked.withColumns({"_s": main("r_start"), "_e": main("r_end"), "_m": main("score")})
    beside = rows.where((F.col("_r") == 1) | (F.col("r_end") < F.col("_s")) | (F.col("r_start") > F.col("_e")))
    beside = beside.withColumns({"_k": F.row_number().over(order), "_next": F.lead("score").over(order)})
    apart = F.col("_next").isNull() | (F.col("score") - F.col("_next") >= separation)
    total = F.col("_m") + F.col("score")
    ok = apart & (total >= score_min) & (total >= F.col("length") - drop_max)
    cols = ["seg", "r_start", "r_end", "chr", "g_start", "strand"]
    one = beside.where("_k = 1").select(*read, "length", F.struct(*cols).alias("x"))
    two = beside.where("_k = 2").where(ok).select(*read, F.struct(*cols).alias("y"), total.alias("score"))
    both = one.join(two, read)
    first = F.col("x.r_start") < F.col("y.r_start")
    a, b = F.when(first, F.col("x")).otherwise(F.col("y")), F.when(first, F.col("y")).otherwise(F.col("x"))
    return both.select(*read, "length", "score", *[a[c].alias(f"{c}_a") for c in cols], *[b[c].alias(f"{c}_b") for c in cols])


def breakpoints(rows: DataFrame) -> DataFrame:
    """``shift``, ``mismatches``, ``motif`` (1 GT/AG, 2 its complement CT/AC, 0 other) and ``repeat``: where between two segments a read best changes over: the place of the fewest mismatches, of equal ones one with a motif, then the first; and how many other places are as good.

    ``read``: the bases that either segment may hold; ``donor`` and ``acceptor``: the genome along them, the donor's two bases longer at its end, the acceptor's at its begin."""
    n = F.length("read")
    base = lambda c, i: F.substring(c, i, 1)
    # mismatches of the first i bases with the donor, and of all with the acceptor, as running sums
    wrong = lambda c, skip: F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), F.array(F.lit(0)), lambda s, i: F.concat(s, F.array(F.element_at(s, -1) + (base(F.col(c), i + skip) != base(F.col("read"), i)).cast("int"))))
    out = rows.withColumn("_w", F.explode(F.array(F.struct(wrong("donor", 0).alias("d"), wrong("acceptor", 2).alias("a")))))

    def place(i: Column) -> Column:
        cost = F.get("_w.d", i) + F.element_at("_w.a", -1) - F.get("_w.a", i)
        pair = F.concat(F.substring(F.col("donor"), i + 1, F.lit(2)), F.substring(F.col("acceptor"), i + 1, F.lit(2)))
        kind = F.when(pair == "GTAG", 1).when(pair == "CTAC", 2).otherwise(0)
        return F.struct(cost.alias("mismatches"), (kind == 0).alias("plain"), i.alias("shift"), kind.alias("motif"))

    out = out.withColumn("_p", F.explode(F.array(F.transform(F.sequence(F.lit(0), n), place))))
    best = F.array_min("_p")
    as_good = F.size(F.filter("_p", lambda p: (p.mismatches == best.mismatches) & (p.plain == best.plain))) - 1
    return out.select(*rows.columns, best.shift.alias("shift"), best.mismatches.alias("mismatches"), best.motif.alias("motif"), as_good.alias("repeat"))


def junction_rows(pairs: DataFrame) -> DataFrame:
    """Donor and acceptor of each pair, as the usual table's first columns."""
    donor = F.when(F.col("strand_a") == 0, F.col("g_start_a") + F.col("r_end_a") - F.col("r_start_a") + 1).otherwise(F.col("g_start_a") - 1)
    acceptor = F.when(F.col("strand_b") == 0, F.col("g_start_b") - 1).otherwise(F.col("g_start_b") + F.col("r_end_b") - F.col("r_start_b") + 1)
    sign = lambda c: F.when(F.col(c) == 0, "+").otherwise("-")
    return pairs.select("chr_a", donor.alias("donor"), sign("strand_a").alias("donor_strand"), "chr_b", acceptor.alias("acceptor"), sign("strand_b").alias("acceptor_strand"), "score", "n_pairs")


def supplementary(pairs: DataFrame, read: list[str]) -> DataFrame:
    """A record for each segment of a pair (``part`` a and b): flag, CIGAR and SA tag. The longer segment, of equal ones the first, is the representative record, the other has 2048; SA names the other one's chromosome, place, strand and CIGAR. ``length`` is the read's."""

    def side(own: str, other: str, first: Column) -> DataFrame:
        c = lambda n, x: F.col(f"{n}_{x}")
        clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")

        def cigar(x: str) -> Column:
            before, after = clip(c("r_start", x)), clip(F.col("length") - 1 - c("r_end", x))
            body = F.concat((c("r_end", x) - c("r_start", x) + 1).cast("string"), F.lit("M"))
            return F.when(c("strand", x) == 0, F.concat(before, body, after)).otherwise(F.concat(after, body, before))

        sign = F.when(c("strand", other) == 0, "+").otherwise("-")
        sa = F.concat(F.concat_ws(",", c("chr", other).cast("string"), (c("g_start", other) + 1).cast("string"), sign, cigar(other), F.lit("255"), F.lit("0")), F.lit(";"))
        flag = (c("strand", own) * 16 + F.when(first, 0).otherwise(2048)).cast("int")
        return pairs.select(*read, "seg_a", "seg_b", F.lit(own).alias("part"), c("chr", own).alias("chr"), (c("g_start", own) + 1).alias("pos"), flag.alias("flag"), cigar(own).alias("cigar"), sa.alias("sa"))

    longer = F.col("r_end_a") - F.col("r_start_a") >= F.col("r_end_b") - F.col("r_start_b")
    return side("a", "b", longer).unionByName(side("b", "a", ~longer))
