"""Sequence functions as column expressions: codes, complements, qualities, runs of A."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = 0x5555555555555555


def encode(seq: Column, rule: str = "ACGT") -> Column:
    """2-bit code of up to 31 bases: ``ACGT`` is big-endian with A0 C1 G2 T3, ``ACTG`` little-endian with A0 C1 T2 G3. Null if another letter occurs."""
    order = F.sequence(F.lit(1), F.length(seq))
    digit = lambda i: (F.instr(F.lit(rule), F.substring(seq, i, 1)) - 1).cast("long")
    if rule == "ACGT":
        value = F.aggregate(order, F.lit(0).cast("long"), lambda acc, i: acc * 4 + digit(i))
    else:
        value = F.aggregate(F.reverse(order), F.lit(0).cast("long"), lambda acc, i: acc * 4 + digit(i))
    return F.when(seq == "", 0).when(~seq.rlike("[^ACGT]"), value)


def decode(code: Column, length: int, rule: str = "ACGT") -> Column:
    """The bases of a 2-bit code."""
    at = [F.substring(F.lit(rule), F.shiftright(code, 2 * i).bitwiseAND(F.lit(3)).cast("int") + 1, F.lit(1)) for i in range(length)]
    return F.concat(*(at[::-1] if rule == "ACGT" else at)) if at else F.lit("")


def reverse_complement(seq: Column) -> Column:
    """IUPAC letters too."""
    return F.reverse(F.translate(seq, "ACGTUNRYKMSWBDHVacgtunrykmswbdhv", "TGCAANYRMKSWVHDBtgcaanyrmkswvhdb"))


def distance(a: Column, b: Column) -> Column:
    """Bases that differ between two codes of one length."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(PAIRS)))


def neighbour_count(length: int, radius: int) -> int:
    """Codes within a radius of 1 to 3, without the code itself."""
    import math

    return sum(3**r * math.comb(length, r) for r in range(1, radius + 1))


def phred(qual: Column) -> Column:
    """Array of Phred+33 scores."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)


def at_least(scores: Column, q: int) -> Column:
    return F.size(F.filter(scores, lambda s: s >= q))


def n_count(seq: Column) -> Column:
    """Letters other than A, C, G and T."""
    return F.length(F.regexp_replace(seq, "[ACGT]", ""))


def find_poly_a(seq: Column, window: int, mismatches: int) -> Column:
    """0-based start of the first window of that length with at most so many letters other than A; -1 if there is none or the read is shorter."""
    last = F.length(seq) - window
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    other = lambda i: F.length(F.replace(F.substring(seq, i + 1, F.lit(window)), F.lit("A"), F.lit("")))
    return F.coalesce(F.array_min(F.filter(starts, lambda i: other(i) <= mismatches)), F.lit(-1))


def name_index(name: Column) -> Column:
    """The last index of a read name that ends like 1:N:0:TATAGCCT+GGTCCCGA."""
    return F.regexp_extract(name, r"([ACGTN]+)$", 1)


def position_tag(x: Column, y: Column, umi: Column | None = None) -> Column:
    tag = F.concat(F.lit("|||CB:Z:"), F.concat_ws("_", x, y))
    return tag if umi is None else F.concat(tag, F.lit("|||UR:Z:"), umi)


def reg2bin(begin: Column, end: Column) -> Column:
    """The smallest bin of the usual five-level scheme that holds [begin, end), 0-based."""
    last = end - 1
    out = F.lit(0)
    for shift, base in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = F.when(F.shiftright(begin, shift) == F.shiftright(last, shift), F.lit(base) + F.shiftright(begin, shift)).otherwise(out)
    return out


def genomic_length_score(length: Column, scale: float = -0.25, floor_log: int = 0) -> Column:
    """ceil(log2(length) * scale - 0.5), at most 0."""
    return F.least(F.ceil(F.log2(length.cast("double")) * scale - 0.5), F.lit(floor_log))


def human(n: Column) -> Column:
    """12345 as 12.35K."""
    return F.when(n >= 1e9, F.concat(F.format_number(n / 1e9, 2), F.lit("G"))).when(n >= 1e6, F.concat(F.format_number(n / 1e6, 2), F.lit("M"))).when(n >= 1e3, F.concat(F.format_number(n / 1e3, 2), F.lit("K"))).otherwise(n.cast("string"))


def register(spark) -> None:
    """The functions that SQL text can call too."""
    for text in (
        "base_distance(a bigint, b bigint) returns int return bit_count(((a ^ b) | shiftrightunsigned(a ^ b, 1)) & 6148914691236517205)",
        "reverse_complement(s string) returns string return reverse(translate(s, 'ACGTN', 'TGCAN'))",
        "n_count(s string) returns int return length(regexp_replace(s, '[ACGT]', ''))",
    ):
        spark.sql(f"create or replace temporary function {text}")
