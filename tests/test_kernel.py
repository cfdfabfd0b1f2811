"""The aligner's kernel on the made genome, without Spark."""

import hashlib
import random

import numpy as np
import pytest

from quillon.operators import align as A

DIGITS, TURN = str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"), str.maketrans("ACGT", "TGCA")


@pytest.fixture(scope="module")
def genome():
    chromosomes = [(str(c), "".join(hashlib.sha256(f"{c}:{p}".encode()).hexdigest().translate(DIGITS) for p in range(400))) for c in range(4)]
    return dict(chromosomes), A.build(chromosomes)


def test_extension_over_a_mismatch_beats_a_seed_by_chance(genome):
    """Twelve bases from the changed one on lie elsewhere too, 18 689 bases before: the read stays whole, on both strands."""
    seq, ix = genome
    read = seq["1"][21_329:21_389]
    read = read[:11] + read[11].translate(str.maketrans("ACGT", "CGTA")) + read[12:]
    both = A.align_batch(ix, [read, read[::-1].translate(TURN)])
    assert both == [[("1", 21_330, strand, "60M", 58, 1)] for strand in "+-"]


def mixed_reads(seq, n, seed=3):
    rng, out = random.Random(seed), []
    for _ in range(n):
        s = seq[rng.choice("0123")]
        at = rng.choice([0, len(s) - 90, rng.randrange(len(s) - 90), rng.randrange(len(s) - 90)])
        size = rng.choice([12, 30, 60, 80])
        gap = rng.choice([0, 0, 1, 3, 20, 21, 300, 5000]) if at < 18_000 else 0
        cut = rng.randrange(5, size - 4)
        t = s[at : at + cut] + rng.choice(["", "", "A", "GGT"]) + s[at + cut + gap : at + size + gap]
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice("ACGTN") + t[i + 1 :]
        t = rng.choice(["", "", "ACGTTGCA"]) + t + rng.choice(["", "", "TTTTTTTTTTT"])
        out.append(t if rng.random() < 0.5 else t[::-1].translate(TURN))
    return [*out, "", "N" * 30, "ACGT"]


def test_plain_rows_are_what_chains_give(genome, monkeypatch):
    seq, ix = genome
    reads = mixed_reads(seq, 3000)
    got, held, plain = A.align_batch(ix, reads), [], A.plain_rows
    monkeypatch.setattr(A, "plain_rows", lambda *a: held.append(len(plain(*a))) or {})
    monkeypatch.setattr(A, "FEW_LOCI", 0)  # windows by arrays
    assert got == A.align_batch(ix, reads) and held[0] > 1000 and sum(map(bool, got)) > 1500


def test_longest_prefixes_by_their_definition(genome):
    seq, ix = genome
    reads = mixed_reads(seq, 6)
    text = "$".join(seq.values())
    size = np.array([len(t) for t in reads])
    wide = np.full((len(reads), max(size)), 4, np.uint8)
    for i, t in enumerate(reads):
        wide[i, : len(t)] = A.CODE[np.frombuffer(t.encode(), np.uint8)]
    row = np.repeat(np.arange(len(reads)), size)
    at = np.concatenate([np.arange(n) for n in size])
    length, lo, hi = A.longest_prefixes(ix, wide, size, row, at)
    for r, a, n, x, y in zip(row, at, length, lo, hi, strict=True):
        t = reads[r][a:]
        assert n == max(k for k in range(len(t) + 1) if t[:k] in text)
        places = [i for i in range(len(text)) if text.startswith(t[:n], i)] if n else None
        assert places is None or sorted(ix.suffixes[x:y].tolist()) == places


def test_kmers_of_batches_are_those_of_rows(spark):
    from quillon.operators import annotation as G

    rng = random.Random(5)
    rows = [(f"c{i % 7}x", i // 7, "".join(rng.choice("ACGTACGTACGTN") for _ in range(rng.choice([0, 2, 3, 60, 69])))) for i in range(60)]
    bins = spark.createDataFrame([*rows, ("c9", 0, "NNNNNN"), (None, 3, "ACGTACGT"), ("c9", 1, None)], "chr string, bin int, seq string")
    for k in (1, 4, 9):
        plain = G.kmer_index(G.kmers(bins, 61, k)).collect()
        assert sorted(plain, key=str) == sorted(G.kmer_counts(bins, 61, k).collect(), key=str)
        assert sum(r.n for r in plain) == sum(len(r.h) for r in G.kmer_lists(bins, 61, k).collect()) > 0


def test_codes_without_known_kmers():
    from quillon.operators import annotation as G

    assert G.codes_of("ACGTN", 5)[1].tolist() == [False] and len(G.codes_of("AC", 3)[0]) == 0 and G.codes_of("ACGT", 4)[0].tolist() == [27]


@pytest.mark.parametrize("k", [5, 20])
def test_looked_up_kmers_of_both_strands(genome, k):
    from quillon.operators import annotation as G

    reads = [*mixed_reads(genome[0], 50), "ACGTA", "ACGTAC"]
    ends, held = A.looked_up_kmers(reads, k, 5)
    for i, t in enumerate(reads):
        want = set()
        for s in (t, t[::-1].translate(TURN)):
            for at in {*range(0, len(s) - k + 1, 5), len(s) - k} if len(s) >= k else ():
                code, known = G.codes_of(s[at : at + k], k)
                want |= {int(code[0])} if known[0] else set()
        assert held[ends[i] : ends[i + 1]].tolist() == sorted(want)
