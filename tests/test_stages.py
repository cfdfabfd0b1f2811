"""Reads before alignment, alignment in stages, and the index, on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from quillon.operators import annotation, barcode, reads, remap
from quillon.sources import index


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_adapters_and_stretches(spark):
    assert one(spark, reads.adapter_start(F.lit("ACGTACGTTTGCA"), "TTGCA")) == 8 and one(spark, reads.adapter_start(F.lit("CCCC"), "GGGG")) == 4 and one(spark, reads.adapter_start(F.lit(""), "GG")) == 0
    got = one(spark, reads.good_stretches(F.lit("ACGTN" + "ACGTACGTACGT" + "NN" + "ACGTACGTACGTA"), 12))
    assert [tuple(x) for x in got] == [(5, 12), (19, 13)]
    assert one(spark, reads.shift_quality(F.lit("h@"), -31)) == "I!"
    df = spark.createDataFrame([("ACGTAC", "IIIIII")], "seq string, qual string")
    assert tuple(reads.clip(df, 1, 2).first()) == ("CGT", "III") and tuple(reads.clip(df, 5, 5).first()) == ("", "")


def test_local_alignment():
    assert reads.local_alignment("GATTACA", "GATTACA") == (7, 7, 7) and reads.local_alignment("AAA", "CCC")[0] == 0
    assert reads.local_alignment("ACGTACGTAC" + "GGCATTAGCC", "ACGTACGTAC" + "T" + "GGCATTAGCC")[0] == 17


def test_spots_and_cells(spark):
    rows = [("s 5", "ACGT"), ("s 9", "ANGT"), ("s", "ACGT")]
    got = barcode.positions_from_reads(spark.createDataFrame(rows, "name string, seq string"), 0, 4, 4).collect()
    assert [tuple(r) for r in got] == [(27, 1, 1)]
    spots = spark.createDataFrame([(7, 3, 4), (5, 3, 4), (6, 4, 4)], "barcode int, x int, y int")
    assert sorted(map(tuple, barcode.mask_cells(spots, 2).collect())) == [(0, 0, 0, 5), (0, 0, 1, 7), (0, 1, 0, 6)]
    with pytest.raises(Exception, match="segments"):
        barcode.mask_cells(spots, 1).collect()
    assert one(spark, barcode.poly_base(F.lit("AAAAC"))) and not one(spark, barcode.poly_base(F.lit("AACCG"))) and one(spark, barcode.poly_base(F.lit("ACNG")))
    r = spark.createDataFrame([(1, 27, -1, [9, 8, 7, 6]), (2, 26, -1, [9, 8, 7, 6]), (3, 27, 0, [0] * 4), (4, 200, -1, [0] * 4)], "read int, barcode long, n_pos int, qual array<int>")
    got = barcode.match_cells(r, spark.createDataFrame([(27,)], "barcode long"), 4)
    assert sorted(map(tuple, got.collect())) == [(1, 27, 0, 0), (2, 27, 1, 6), (3, 27, 1, 0)]


def test_flanks_alleles_and_places(spark):
    text = "".join(random.Random(1).choice("ACGT") for _ in range(200))
    bins = annotation.genome_bins(spark.createDataFrame([("c", text)], "chr string, seq string"), 32, 10)
    got = annotation.flanks(spark.createDataFrame([("c", 50, 90), ("c", 4, 30)], "chr string, start int, end int"), bins, 32, 10).collect()
    assert {r.flank for r in got} == {text[40:50] + text[90:100], text[:4] + text[30:40]}
    rows = spark.createDataFrame([("AAAA", [(1, "C", "G"), (3, "T", "A")])], "flank string, snps array<struct<offset:int,a1:string,a2:string>>")
    assert {r.variant for r in annotation.allele_choices(rows).collect()} == {"ACAT", "AGAT", "ACAA", "AGAA"}
    chromosomes = spark.createDataFrame([("a", 0, 90), ("b", 128, 50)], "chr string, chr_start long, chr_length long")
    places = annotation.locate(spark.createDataFrame([(5,), (100,), (130,), (178,)], "pos long"), chromosomes, width=64)
    assert sorted((r.pos, r.chr) for r in places.collect()) == [(5, "a"), (130, "b")]
    got = lambda *a: tuple(annotation.window_parameters(*a)[k] for k in ("bits", "reach", "flank"))
    assert got(1 << 20) == (16, 9, 4) and got(3_100_000_000, 1000) == (16, 2, 1) and got(3_100_000_000, 500_000, 500_000) == (17, 8, 4)
    assert got(1_000_000, 3, 0) == (8, 2, 1) and got(10_000, 2_000_000) == (18, 16, 8)


def test_two_passes_and_other_alleles(spark):
    rng = random.Random(5)
    g = "".join(rng.choice("ACGT") for _ in range(4000))
    g = g[:1000] + "GT" + g[1002:1498] + "AG" + g[1500:]
    genome = spark.createDataFrame([("c", g)], "chr string, seq string")
    rows = [(f"s{i}", g[960 + i : 1000] + g[1500 : 1540 + i]) for i in range(4)] + [("p", g[200:280]), ("q", g[300:380])]
    made = spark.createDataFrame(rows, "read string, seq string")
    from quillon.operators.align import align

    first = align(made, genome)
    short = [("a", g[926:1000] + g[1500:1506]), ("b", g[995:1000] + g[1500:1575]), ("t", "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[x] for x in reversed(g[990:1000] + g[1500:1570])))]
    both = made.unionAll(spark.createDataFrame(short, "read string, seq string"))
    once = {r["read"]: r.cigar for r in align(both, genome).collect()}
    assert once["a"].endswith("S") and once["b"].startswith("5S")
    got = {r["read"]: (r.chr, r.pos, r.strand, r.cigar, r.nh) for r in remap.two_pass(both, genome).collect()}
    assert got["a"] == ("c", 927, "+", "74M500N6M", 1) and got["b"] == ("c", 996, "+", "5M500N75M", 1) and got["t"] == ("c", 991, "-", "10M500N70M", 1)
    assert got["p"] == ("c", 201, "+", "80M", 1) and got["s0"] == ("c", 961, "+", "40M500N40M", 1) and len(got) == len(rows) + 3
    with pytest.raises(ValueError, match="limit"):
        remap.two_pass(both, genome, limit=0)
    told = spark.createDataFrame([("c", 1000, 1500)], "chr string, start long, end long")
    lone = both.where("read = 'a'")
    assert remap.two_pass(lone, genome).first().cigar == once["a"] and remap.two_pass(lone, genome, told).first().cigar == "74M500N6M"
    found = {tuple(r) for r in remap.introns(first).select("start", "gap").collect()}
    assert found == {(1001, 500)}
    other = {"A": "C", "C": "G", "G": "T", "T": "A"}
    variants = spark.createDataFrame([("c", 221, g[220], other[g[220]]), ("c", 341, other[g[340]], other[other[g[340]]])], "chr string, pos long, a1 string, a2 string")
    tags = {r["read"]: r.tag for r in remap.other_alleles(first, variants, made, genome).collect()}
    assert tags["p"] == 1 and tags["q"] == 3 and tags["s0"] == -1
    assert remap.transcript_bans(first).where("primary").count() == len(rows)


def test_index_round_trip(spark, tmp_path):
    table = spark.range(5)
    index.write_index({"t": table}, str(tmp_path / "i"), {"k": 3})
    tables, parameters = index.read_index(spark, str(tmp_path / "i"))
    assert parameters == {"k": 3} and tables["t"].count() == 5
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "i" / "t"))
    with pytest.raises(ValueError, match="whole"):
        index.read_index(spark, str(tmp_path / "i"))
