"""Functions, readers, the aligner and joins on small hand-made cases."""

import gzip
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import seq
from quillon.operators import align as A
from quillon.operators import annotation, barcode, cells, chimera, frontend, intervals, junctions, quant, reads
from quillon.sources import bam, readers, writers


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_codes_and_complements(spark):
    lit = F.lit
    assert one(spark, seq.encode(lit("ACGT")), seq.encode(lit("ACTG"), "ACTG"), seq.encode(lit("ANT")), seq.encode(lit(""))) == (27, 0b11100100, None, 0)
    assert one(spark, seq.decode(lit(27).cast("long"), 4), seq.decode(lit(0b11100100).cast("long"), 4, "ACTG")) == ("ACGT", "ACTG")
    assert one(spark, seq.reverse_complement(lit("AAAATTTTCCCCGGGG")), seq.reverse_complement(lit("ACGTN"))) == ("CCCCGGGGAAAATTTT", "NACGT")
    assert one(spark, seq.name_index(lit("x 1:N:0:TATAGCCT+GGTCCCGA"))) == ("GGTCCCGA",)
    assert one(spark, seq.position_tag(lit(3), lit(4), lit("1F"))) == ("|||CB:Z:3_4|||UR:Z:1F",)
    assert seq.neighbour_count(25, 1) == 75 and seq.neighbour_count(25, 2) == 2775
    assert one(spark, seq.human(lit(12345)), seq.genomic_length_score(lit(1024))) == ("12.35K", -3)


def test_poly_a_edges(spark):
    f = lambda s, n=5, m=1: one(spark, seq.find_poly_a(F.lit(s), n, m))[0]
    assert f("AAA") == -1 and f("CCCCCAAAAA") == 4 and f("CAAAAC") == 0 and f("CCCCC") == -1 and f("AACAA", 5, 0) == -1


def test_bins(spark):
    assert one(spark, seq.reg2bin(F.lit(0), F.lit(1)), seq.reg2bin(F.lit(0), F.lit(1 << 29))) == (4681, 0)


def test_neighbours_match_brute_force(spark):
    rng = random.Random(1)
    codes = [rng.randrange(4**9) for _ in range(150)]
    queries = [c ^ (rng.randrange(1, 4) << (2 * rng.randrange(9))) ^ (rng.randrange(4) << (2 * rng.randrange(9))) for c in codes]
    far = lambda a, b: sum((a ^ b) >> (2 * i) & 3 != 0 for i in range(9))
    for radius in (1, 2, 3):
        got = barcode.neighbours(spark.createDataFrame([(q,) for q in queries], "barcode long"), spark.createDataFrame([(c,) for c in codes], "barcode long"), 9, radius)
        want = {(q, c, far(q, c)) for q, c in itertools.product(queries, codes) if far(q, c) <= radius}
        assert {tuple(r) for r in got.collect()} == want


def test_overlap_join_matches_brute_force(spark):
    rng = random.Random(2)
    rows = lambda n, w: [(rng.randint(0, 2), s, s + rng.randint(0, w)) for s in (rng.randint(-50, 300) for _ in range(n))]
    a, b = rows(60, 90), rows(60, 30)
    got = intervals.overlap_join(spark.createDataFrame(a, "g int, a_start int, a_end int"), spark.createDataFrame(b, "g int, b_start int, b_end int"), ["g"], 17)
    want = sorted((x[0], *x[1:], *y[1:]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    assert sorted(map(tuple, got.select("g", "a_start", "a_end", "b_start", "b_end").collect())) == want


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_floor_join(spark, width):
    blocks = [(c, s) for c in (0, 1) for s in random.Random(c).sample(range(200), 12)]
    queries = [(c, p) for c in (0, 1, 2) for p in range(0, 220, 3)]
    got = intervals.floor_join(spark.createDataFrame(queries, "c int, p int"), spark.createDataFrame(blocks, "c int, s int"), ["c"], "p", "s", ["s"], width)
    for r in got.collect():
        own = [s for c, s in blocks if c == r.c]
        assert (r.before.s if r.before else None) == max((s for s in own if s <= r.p), default=None)
        assert (r.after.s if r.after else None) == min((s for s in own if s > r.p), default=None)


@pytest.mark.parametrize("tile", [8, 64, 1 << 20])
def test_coverage_matches_bases(spark, tile):
    rng = random.Random(tile)
    rows = [(0, s, s + rng.randint(0, 40), rng.randint(1, 3)) for s in (rng.randint(0, 150) for _ in range(30))] + [(1, 8, 64, 1)]
    got = intervals.coverage(spark.createDataFrame(rows, "g int, s int, e int, w int"), ["g"], "s", "e", F.col("w"), tile).collect()
    bases = {}
    for g, s, e, w in rows:
        for p in range(s, e):
            bases[g, p] = bases.get((g, p), 0) + w
    have = {(r.g, p): r.value for r in got for p in range(r.start, r.end)}
    assert have == bases
    runs = sorted((r.g, r.start, r.end, r.value) for r in got)
    assert all(not (a[0] == b[0] and a[2] == b[1] and a[3] == b[3]) for a, b in zip(runs, runs[1:]))


def test_junction_rules(spark):
    rows = [(1, 100, 60, 1, 0, 1, 20), (1, 100, 60, 1, 0, 1, 25), (2, 100, 60, 1, 0, 2, 9), (3, 500, 60, 0, 0, 1, 40)]
    obs = spark.createDataFrame(rows, "read int, start int, gap int, motif int, annot int, nh int, overhang int")
    got = {r.start: r for r in junctions.collapse(junctions.emit(obs, ["read"])).collect()}
    assert (got[100].uniq, got[100].multi, got[100].overhang) == (1, 1, 25) and got[500].uniq == 1
    kept = junctions.keep_supported(junctions.collapse(junctions.emit(obs, ["read"])))
    assert [r.start for r in kept.collect()] == [100]
    assert junctions.keep_supported(spark.createDataFrame([(1, 9, 1, 0, 9, 9, 99)], "start int, gap int, motif int, annot int, uniq int, multi int, overhang int"), unique=(-1,) * 4, total=(-1,) * 4).count() == 0
    bad = spark.createDataFrame([(1, 5, 5, 1, 0, 1, 9), (2, 5, 5, 2, 0, 1, 9)], "read int, start int, gap int, motif int, annot int, nh int, overhang int")
    with pytest.raises(Exception, match="differs"):
        junctions.collapse(bad).collect()


def test_lift_over_edges(spark):
    blocks = spark.createDataFrame([("c", 10, 110, 10), ("c", 30, 150, 10)], "chr string, s1 int, s2 int, len int")
    at = [(12, 15), (5, 12), (22, 33), (35, 45), (22, 25), (50, 60), (0, 5)]
    got = {(r.s, r.e): (r.new_start, r.new_end) for r in quant.lift_over(spark.createDataFrame([("c", *x) for x in at], "chr string, s int, e int"), blocks).collect()}
    assert got == {(12, 15): (112, 115), (5, 12): (110, 112), (22, 33): (150, 153), (35, 45): (155, 159), (22, 25): (None, None), (50, 60): (None, None), (0, 5): (None, None)}
    with pytest.raises(Exception, match="lacks"):
        quant.check_chromosomes(spark.createDataFrame([("z", 1, 2)], "chr string, s int, e int"), blocks).collect()


def test_cell_barcode_posterior(spark):
    c = spark.createDataFrame([(1, 5, 0, 0), (2, 6, 1, 10), (3, 9, 1, 0), (4, 6, 1, 3), (4, 7, 1, 30), (5, 6, 1, 10), (5, 7, 1, 10)], "read int, cb int, d int, q int")
    exact = spark.createDataFrame([(5, 1), (6, 3), (7, 2)], "cb int, n int")
    assert {r["read"]: r.cb for r in cells.resolve(c, exact).collect()} == {1: 5, 2: 6, 4: 6}


def test_tag_collapse(spark):
    tags = [(1, 1, u) for u in (0, 0, 0, 1, 5, 48, 3 << 8)]
    rec = spark.createDataFrame(tags, "cb int, feature int, umi long")
    r = cells.collapse_all(rec, 6, ["cb", "feature"]).first()
    assert (r.n_tags, r.n_components) == (5, 1)
    assert cells.collapse_directional(rec, 6, ["cb", "feature"]).first().n_kept == 2


def test_motifs_and_shifts(spark):
    m = lambda d, a: one(spark, annotation.motif(F.lit(d), F.lit(a)))[0]
    assert [m("GT", "AG"), m("CT", "AC"), m("GC", "AG"), m("CT", "GC"), m("AT", "AC"), m("GT", "AT"), m("AA", "AA")] == [1, 2, 3, 4, 5, 6, 0]
    assert one(spark, annotation.repeat_shift(F.lit("ACGT"), F.lit("ACTT")), annotation.repeat_shift(F.lit(""), F.lit("A")), annotation.repeat_shift(F.lit("AA"), F.lit("AAA"))) == (2, 0, 2)


def test_suffix_table_is_sorted(spark):
    bins = annotation.genome_bins(spark.createDataFrame([("c", "GATTACAGATTACA" * 20)], "chr string, seq string"), 64, 8)
    rows = annotation.suffix_table(bins, 64, 8).collect()
    assert len(rows) == 280 and [r.suffix for r in rows] == sorted(r.suffix for r in rows)


def genome(rng, n=3000):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_aligner_finds_spliced_clipped_and_changed_reads():
    rng = random.Random(7)
    g = genome(rng)
    g = g[:600] + "GT" + g[602:1098] + "AG" + g[1100:]
    ix = A.build([("c1", g), ("c2", genome(rng))])
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    changed = g[200:240] + ("A" if g[240] != "A" else "C") + g[241:300]
    reads = [g[100:200], turn(g[100:200]), g[550:600] + g[1100:1150], changed, g[300:350] + g[353:403], g[400:450] + "ACG" + g[450:500], "N" * 50, "", g[2950:] + "A" * 20]
    got = A.align_batch(ix, reads)
    assert got[0] == [("c1", 101, "+", "100M", 100, 0)] and got[1] == [("c1", 101, "-", "100M", 100, 0)]
    assert got[2][0][:4] == ("c1", 551, "+", "50M500N50M") and got[3][0][:4] == ("c1", 201, "+", "100M") and got[3][0][5] == 1
    assert got[4][0][3].count("D") == 1 and got[5][0][3].count("I") == 1 and got[6] == [] and got[7] == []
    assert got[8][0][3].endswith("S") and got[8][0][1] == 2951


def test_aligner_joins_repeats_near_anchors_and_long_introns():
    rng = random.Random(17)
    exon, unique, far = genome(rng, 40), genome(rng, 40), genome(rng, 50)
    copies = "".join(genome(rng, 30) + exon for _ in range(80))
    first = genome(rng, 500) + unique + "GT" + genome(rng, 996) + "AG" + exon + genome(rng, 200_000) + copies
    second = genome(rng, 300) + far + "GT" + genome(rng, 299_996) + "AG" + genome(rng, 500)
    ix = A.build([("c1", first), ("c2", second)])
    at = second.index(far)
    reads = [unique + exon, far + second[at + 50 + 300_000 : at + 100 + 300_000], exon]
    got = A.align_batch(ix, reads)
    assert [h[:4] for h in got[0]] == [("c1", 501, "+", "40M1000N40M")]
    assert [h[:4] for h in got[1]] == [("c2", 301, "+", "50M300000N50M")] and got[2] == []


def test_windows_bound_seeds_by_window():
    rng = random.Random(18)
    word = [genome(rng, 20) for _ in range(2)]
    text = genome(rng, 400) + (word[0] + genome(rng, 9)) * 60 + genome(rng, 1_000_000) + word[1] + (word[0] + genome(rng, 7)) * 60
    ix = A.build([("c1", text)])
    read = A.CODE[np.frombuffer((word[1] + "N" + word[0] + "N" + text[100:140]).encode(), np.uint8)][None]
    found = A.windows(ix, A.seeds(ix, read, np.array([read.shape[1]]))[0])
    assert [len(w) for w in found] == [50, 50] and all(w[0][3] and not w[1][3] for w in found)
    assert found[0][0][2] == 100 and found[1][0][2] == text.index(word[1])


def test_suffix_order_of_bases():
    x = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint8)
    raw = x.tobytes()
    assert A.suffix_order(x).tolist() == sorted(range(300), key=lambda i: raw[i:])


def test_breakpoint(spark):
    rows = [("AAAAAGTCCC", "TTTTTTAGGG"[:10], "AAAAAAGG"), ("ACGTACGTAC", "CCACGTACGT", "ACGTACGT"), ("GT", "AG", "")]
    got = chimera.breakpoints(spark.createDataFrame(rows, "donor string, acceptor string, read string")).collect()
    assert (got[0].shift, got[0].mismatches) == (4, 1) and (got[1].mismatches, got[1].repeat) == (0, 8) and (got[2].shift, got[2].motif) == (0, 1)


def test_fastq_split_anywhere(spark, tmp_path):
    rng = random.Random(3)
    records = [(f"r{i} x", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+IJ!5") for _ in range(n))) for i, n in enumerate(rng.randint(1, 60) for _ in range(400))]
    text = "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records)
    (tmp_path / "a.fq").write_text(text)
    (tmp_path / "crlf.fq").write_text(text[:-1].replace("\n", "\r\n"))
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for name in ("a.fq", "b.fq.gz", "crlf.fq"):
                got = readers.read_fastq(spark, str(tmp_path / name)).orderBy("read_no").collect()
                assert [(r.name, r.seq, r.qual) for r in got] == records and [r.read_no for r in got] == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "bad.fq").write_text("@a\nACG\n+\nII\n")
    with pytest.raises(Exception, match="broken"):
        readers.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    (tmp_path / "empty.fq").write_text("")
    assert readers.read_fastq(spark, str(tmp_path / "empty.fq")).count() == 0
    both = readers.pair(readers.read_fastq(spark, str(tmp_path / "a.fq")), readers.read_fastq(spark, str(tmp_path / "b.fq.gz")))
    assert both.where("r1.seq = r2.seq").count() == 400 and readers.interleaved(readers.read_fastq(spark, str(tmp_path / "a.fq"))).count() == 200


def test_annotation_readers(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c1 first\nACGT\nacgt\n>c2\nNNAC\n")
    assert [tuple(r) for r in readers.read_fasta(spark, str(tmp_path / "g.fa")).orderBy("chr").collect()] == [("c1", "first", "ACGTACGT"), ("c2", "", "NNAC")]
    (tmp_path / "a.gtf").write_text('#x\nc1\ts\texon\t5\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "n1"; gene_biotype "b";\nc1\ts\tgene\t5\t9\t.\t+\t.\tgene_id "g1";\nc1\ts\texon\t5\t9\t.\t-\t.\ttranscript_id "t2";\n')
    got = sorted(map(tuple, readers.read_gtf(spark, str(tmp_path / "a.gtf")).collect()), key=str)
    assert got == [("c1", 5, 9, "+", "t1", "g1", "n1", "b"), ("c1", 5, 9, "-", "t2", "t2", "t2", "")]
    head = "##x\n#CHROM\n"
    (tmp_path / "v.vcf").write_text(head + "c\t5\t.\tA\tC,G\t.\t.\t.\tGT\t1|2\nc\t6\t.\tA\tC\t.\t.\t.\tGT\t0/0\nc\t7\t.\tAT\tC\t.\t.\t.\tGT\t0/1\nc\t8\t.\tA\tT\t.\t.\t.\tGT:X\t0/1:9\nc\t9\t.\tA\tT\t.\t.\t.\tGT\t1\n")
    assert sorted(map(tuple, readers.read_vcf(spark, str(tmp_path / "v.vcf")).collect())) == [("c", 5, "A", "C", "G"), ("c", 8, "A", "A", "T")]
    (tmp_path / "c.chain").write_text("chain 9 a 100 + 10 60 b 90 + 5 50 1\n10 5 2\n20 0 3\n5\n\nchain 9 z 9 + 0 9 y 9 + 0 9 2\n9\n")
    assert sorted(map(tuple, readers.read_chain(spark, str(tmp_path / "c.chain")).collect())) == [("a", "b", 10, 5, 10), ("a", "b", 25, 17, 20), ("a", "b", 45, 40, 5), ("z", "y", 0, 0, 9)]
    (tmp_path / "j.tab").write_text("c 5 9 +\nc\t6\t9\t2\nc 7 9 .\n")
    assert sorted(r.strand for r in readers.read_junctions(spark, str(tmp_path / "j.tab")).collect()) == [0, 1, 2]
    np.array([(7, 1, 2), (0, 3, 4)], np.dtype([("b", "<u8"), ("x", "<u4"), ("y", "<u4")])).tofile(tmp_path / "m.bin")
    assert [tuple(r) for r in readers.read_position_map(spark, str(tmp_path / "m.bin")).collect()] == [(7, 1, 2)]


def test_sam_round_trip(spark, tmp_path):
    rows = [("q1", 0, "c", 5, 255, "4M", "*", 0, 0, "ACGT", "IIII", 1), ("q2", 4, None, 0, 0, None, None, 0, 0, "A", "I", None)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, nh int")
    writers.write_lines(writers.sam(df, {"nh": "NH:i"}), str(tmp_path / "o"), writers.sam_header([("c", 9)]))
    got = {r.qname: r for r in readers.read_sam(spark, str(tmp_path / "o" / "body")).collect()}
    assert got["q1"].tags == {"NH": "1"} and got["q2"].tags == {} and got["q2"].rname == "*" and got["q1"].pos == 5


def test_merged_pair(spark):
    left, right = "ACGTACGTAA" + "GATTACAGATTACAGATTACAGATTACAGATTACA", "GATTACAGATTACAGATTACAGATTACAGATTACA" + "CCC"
    n = lambda a, p, b, q: one(spark, barcode.merge_overlap(*map(F.lit, (a, p, b, q))))[0]
    high, other = "I" * 45, "GATTACAGAT" + "G" + right[11:]
    assert n(left, high, right, "I" * 38) == 35 and n("A", "I", "A", "I") is None
    # a difference must be between a good base and a poor one
    assert n(left, high, other, "I" * 38) is None and n(left, high, other, "I" * 10 + "#" + "I" * 27) == 35
    got = one(spark, barcode.merge_reads(*map(F.lit, (left, high, other, "I" * 10 + "#" + "I" * 27, 35))))[0]
    assert got.seq == left + "CCC" and got.qual == "I" * 10 + "q" * 10 + "I" + "q" * 24 + "III"


def test_adapter_cuts_bases_and_qualities_alike(spark):
    df = spark.createDataFrame([("ACGTACGTACGG", "ABCDEFGHIJKL"), ("ACGATTACAGGT", "ABCDEFGHIJKL"), ("", "")], "seq string, qual string")
    assert [tuple(r) for r in reads.clip_adapter(df, "GATTACAGG").collect()] == [("ACGTACGTACG", "ABCDEFGHIJK"), ("AC", "AB"), ("", "")]


def test_front_end_raises_and_routes(spark):
    df = spark.createDataFrame([("ACGT", 1), ("ACG", 2)], "seq string, n int")
    with pytest.raises(Exception, match="read length"):
        frontend.check_lengths(df, F.col("seq")).collect()
    assert frontend.check_lengths(df.where("n = 1"), F.col("seq")).count() == 1 and frontend.check_lengths(df.limit(0), F.col("seq")).count() == 0
    with pytest.raises(Exception, match="no code"):
        df.select(frontend.encode_or_fail(F.lit("ACNT"))).collect()
    names = [one(spark, frontend.tagged_name(F.lit(x), F.lit(255), F.lit(1)))[0] for x in ("a/1", "a/2/b/2", "a/1/2", "a")]
    assert names == ["a FF 1", "a/2/b FF 1", "a/1 FF 1", "a FF 1"]
    rows = frontend.split_unknown(spark.createDataFrame([("ACGT",), ("ANGT",), ("NNGT",)], "cb string")).collect()
    assert [(r.way, r.n_pos, r.barcode) for r in rows] == [("exact", -1, 27), ("rescue", 2, 11), ("drop", -1, 11)]


def test_path_lists_of_any_length(spark, tmp_path):
    (tmp_path / "list").write_text("\n".join(f"/data/reads_{i}.fq" for i in range(12_345)))
    (tmp_path / "one").write_text("@r/1\nA\n+\nI\n")
    assert len(readers.paths_of(spark, str(tmp_path / "list"))) == 12_345
    assert readers.paths_of(spark, str(tmp_path / "one")) == [str(tmp_path / "one")]


def test_duplicate_positions(spark):
    rows = [(1, x, y) for x in (0, 1) for y in (0, 1)] + [(2, 0, 0), (2, 3, 0), (3, 9, 9)]
    got = {r.barcode: (r.x, r.y, r.kind) for r in barcode.resolve_positions(spark.createDataFrame(rows, "barcode int, x int, y int")).collect()}
    assert got == {1: (0, 0, "neighbours"), 2: (0, 0, "duplicate"), 3: (9, 9, "single")}


def test_bam_parts_and_one_file(spark, tmp_path):
    rows = [(f"q{i}", 0 if i % 7 else 4, f"c{i % 2}" if i % 7 else "*", 1 + (i * 37) % 900 if i % 7 else 0, 255, "5S20M3N5M" if i % 7 else "*", "=" if i % 3 and i % 7 else "*", 9 if i % 3 and i % 7 else 0, -5, "ACGTNACGTN" * 3, "I" * 30 if i % 2 else "*", i, 0.5, [i, 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, n int, f float, b array<int>").repartition(3)
    names = [("c0", 5000), ("c1", 1 << 20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = bam.write_bam(df, str(tmp_path / "p"), names, "@HD\tVN:1.4\n" + "@CO\t" + "x" * 70_000 + "\n", {"n": "NM", "f": "XF", "b": "XB"}, True).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    size = bam.concatenate(str(tmp_path / "p"), str(tmp_path / "one.bam"))
    raw = (tmp_path / "one.bam").read_bytes()
    assert len(parts) > 1 and len(raw) == size and raw.endswith(bam.EOF) and raw.count(bam.EOF) == 1
    # an ordinary gzip reader reads it; places are in order across the parts, unplaced rows last
    with gzip.open(tmp_path / "one.bam") as f:
        assert f.read(4) == b"BAM\1"
    got = bam.read_bam(spark, str(tmp_path / "one.bam")).collect()
    assert len(got) == 3000 and len(bam.read_bam(spark, str(tmp_path / "p")).collect()) == 3000
    places = [(r.rname == "*", r.rname, r.pos) for r in got]
    assert places == sorted(places)
    by = {r.qname: r for r in got}
    for r in rows:
        x = by[r[0]]
        assert tuple(x)[:11] == r[:11] and x.tags["NM"] == str(r[11]) and x.tags["XF"] == "0.5" and x.tags["XB"] == f"{r[11]},2"
    with pytest.raises(FileExistsError):
        bam.write_bam(df, str(tmp_path / "p"), names, "")
    empty = bam.write_bam(df.limit(0), str(tmp_path / "e"), names, "").collect()
    assert len(empty) >= 1 and bam.read_bam(spark, str(tmp_path / "e")).count() == 0


def test_binary_records_are_cut_anywhere(spark, tmp_path, monkeypatch):
    from quillon.sources import binary

    monkeypatch.setattr(binary, "RANGE", 100)
    df = spark.createDataFrame([(i, i % 7, i % 5) for i in range(1, 900)], "barcode long, x int, y int").repartition(3)
    writers.position_map(df, str(tmp_path / "m.bin"))
    assert sorted(tuple(r) for r in readers.read_position_map(spark, str(tmp_path / "m.bin")).collect()) == sorted(tuple(r) for r in df.collect())
    (tmp_path / "short.bin").write_bytes(b"x" * 17)
    with pytest.raises(Exception, match="inside a record"):
        readers.read_position_map(spark, str(tmp_path / "short.bin")).collect()


def test_numbers_follow_the_order(spark):
    rows = [(i * 7919 % 10_007,) for i in range(5000)]
    got = intervals.numbered(spark.createDataFrame(rows, "v int").repartition(6), ["v"], "n").collect()
    assert [r.v for r in sorted(got, key=lambda r: r.n)] == sorted(r[0] for r in rows) and {r.n for r in got} == set(range(1, 5001))


def test_duplicates_with_null_keys_keep_all_rows(spark):
    df = spark.createDataFrame([("a", None, 5, 1), ("b", None, 7, 1), ("c", 1, 3, 1), ("d", 1, 3, 2)], "name string, k int, score int, nh int")
    got = {r.name: r.duplicate for r in quant.mark_duplicates(df, ["k"], "score", ["name"]).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": True}
    assert {r.name for r in quant.mark_duplicates(df, ["k"], "score", ["name"], True).where("duplicate").collect()} == {"a", "d"}
    many = df.withColumn("nh", F.lit(3))
    assert quant.mark_duplicates(many, ["k"], "score", ["name"], True).where("duplicate").count() == 4


def test_rows_are_in_order_across_partitions(spark):
    from quillon.operators import records, sam

    df = spark.createDataFrame([(i * 37 % 101 if i % 9 else None, i) for i in range(500)], "pos int, n int").repartition(7)
    got = [(r.pos is None, r.pos or 0, r.n) for r in sam.coordinate_sort(df, ["pos", "n"]).collect()]
    assert got == sorted(got)
    back = [r.read_no for r in records.input_order(df.selectExpr("n read_no", "1 hi")).collect()]
    assert back == list(range(500))


def test_block_gzip_reads_in_ranges(spark, tmp_path):
    rng = random.Random(3)
    reads_ = [(f"r{i}/1", "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 400)))) for i in range(700)]
    text = "".join(f"@{n}\n{s}\n+\n{'I' * len(s)}\n" for n, s in reads_).encode()
    raw = b"".join(bam.block(text[i : i + 3001]) for i in range(0, len(text), 3001)) + bam.EOF
    (tmp_path / "a.fq.gz").write_bytes(raw)
    for blocks in (1, 3, 1000):
        got = readers.read_block_fastq(spark, str(tmp_path / "a.fq.gz"), blocks).orderBy("read_no").collect()
        assert [(r.read_no, r.name, r.seq) for r in got] == [(i, n, s) for i, (n, s) in enumerate(reads_)]
    (tmp_path / "b.fq.gz").write_bytes(gzip.compress(text))
    with pytest.raises(Exception, match="block-gzipped"):
        readers.read_block_fastq(spark, str(tmp_path / "b.fq.gz")).collect()


def test_picture_and_report(spark):
    import struct
    import zlib

    df = spark.createDataFrame([(0, 0, 1), (99, 49, 4), (98, 49, 4)], "x int, y int, n long")
    raw = writers.heat_png(df, 10, 5)
    assert raw.startswith(b"\x89PNG") and struct.unpack(">II", raw[16:24]) == (10, 5)
    size = struct.unpack(">I", raw[33:37])[0]
    cells_ = zlib.decompress(raw[41 : 41 + size])
    assert len(cells_) == 55 and cells_[1] == 32 and cells_[54] == 255 and sum(cells_) == 287
    assert writers.heat_png(df.limit(0), 3, 3)[:4] == b"\x89PNG"
    page = writers.report_html({"reads <all>": 5, "rate": "9%"}, "A & B")
    assert "reads &lt;all&gt;" in page and "A &amp; B" in page


def test_local_alignments_of_rows(spark):
    df = spark.createDataFrame([("x", "GATTACA", "TTACA"), ("y", None, "A"), ("z", "AAAA", "AATAA")], "k string, a string, b string")
    got = {r.k: (r.score, r.a_end, r.b_end) for r in reads.local_alignments(df).collect()}
    assert got["x"] == (5, 7, 5) and got["y"] == (0, 0, 0) and got["z"][0] == reads.local_alignment("AAAA", "AATAA")[0]


def test_a_run_of_too_low_a_rate_is_stopped(spark, tmp_path):
    from quillon.streaming import progress

    for i in range(4):
        spark.createDataFrame([(j, "error" if j % 2 else "view") for j in range(100)], "event_id long, event_type string").withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    totals = lambda: progress.events(spark, str(tmp_path / "events.parquet"), 1).agg(F.count("*").alias("reads"), F.count_if(F.col("event_type") != "error").alias("mapped"))
    with pytest.raises(progress.RateTooLow):
        progress.run_to_table(totals(), "low", progress.low_rate(150, 0.9))
    assert progress.run_to_table(totals(), "fine", progress.low_rate(150, 0.4)).first().reads == 400
    assert progress.run_to_table(totals(), "early", progress.low_rate(10_000, 0.9)).first().reads == 400


def test_a_large_genome_is_aligned_in_pieces(spark, monkeypatch):
    rng = random.Random(7)
    g = ["".join(rng.choice("ACGT") for _ in range(9000)) for _ in range(2)]
    g[1] = g[1][:4000] + g[0][1000:1300] + g[1][4300:]  # a repeat
    genome = spark.createDataFrame([("a", g[0]), ("b", g[1]), ("c", "ACGT")], "chr string, seq string")
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(f"u{i}", g[i % 2][i * 97 % 8800 :][:80]) for i in range(60)] + [(f"m{i}", turn(g[0][1000 + i * 20 :][:80])) for i in range(8)]
    rows += [(f"s{i}", g[0][5000 + i * 100 - 40 : 5000 + i * 100] + g[0][5700 + i * 100 :][:40]) for i in range(20)] + [("none", "A" * 80), ("short", "ACG"), ("nothing", None)]
    made = spark.createDataFrame(rows, "read string, seq string")
    whole = sorted(tuple(r) for r in A.align(made, genome).collect())
    cut = sorted(tuple(r) for r in A.align_pieces(made, genome, piece=2000, reach=1500, load=7).select("read", "chr", "pos", "strand", "cigar", "score", "mismatches", "nh").collect())
    assert cut == whole and {r[-1] for r in whole} == {1, 2}
    monkeypatch.setattr(A, "LARGEST", 100)
    assert sorted(tuple(r) for r in A.align(made, genome).select("read", "chr", "pos", "strand", "cigar", "score", "mismatches", "nh").collect()) == whole
    assert A.align_pieces(made.limit(0), genome).count() == 0 and A.align_pieces(made, genome.limit(0)).count() == 0


def test_bam_index_finds_regions(spark, tmp_path):
    rng = random.Random(13)
    rows = []
    for i in range(6000):
        pos = rng.choice([rng.randint(1, 3_000_000), rng.randint(1, 20_000)])
        rows.append((f"q{i}", 0, f"c{i % 2}", pos, 255, rng.choice(["50M", "20M90000N30M", "10S40M"]), "*", 0, 0, "ACGTA" * 10, "*"))
    rows += [(f"u{i}", 4, "*", 0, 0, "*", "*", 0, 0, "ACGTA", "*") for i in range(9)]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string")
    bam.write_bam(df, str(tmp_path / "p"), [("c0", 4_000_000), ("c1", 4_000_000)], "", sort=True)
    one = str(tmp_path / "one.bam")
    bam.concatenate(str(tmp_path / "p"), one)
    assert bam.write_index(one) == one + ".bai"
    span = {"50M": 50, "20M90000N30M": 90_050, "10S40M": 40}
    for chromosome, begin, end in (("c0", 0, 100), ("c1", 16_000, 16_800), ("c0", 1_000_000, 1_200_000), ("c1", 0, 4_000_000), ("c0", 3_500_000, 3_600_000), ("c1", 2_999_000, 2_999_001)):
        want = sorted(r[0] for r in rows if r[2] == chromosome and r[3] - 1 < end and r[3] - 1 + span[r[5]] > begin)
        assert sorted(r["qname"] for r in bam.read_region(one, chromosome, begin, end)) == want
    bam.write_bam(df.orderBy(F.rand(1)).coalesce(1), str(tmp_path / "u"), [("c0", 4_000_000), ("c1", 4_000_000)], "")
    with pytest.raises(ValueError, match="not sorted"):
        bam.write_index(str(tmp_path / "u" / "part-00000.bam"))
