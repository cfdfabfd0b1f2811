"""From FASTQ pairs to tagged reads: slices, codes, names, length checks, routing, and the aligner's loader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seq
from .reads import clip, clip_adapter, shift_quality


def slice_tags(pairs: DataFrame, barcode: tuple[int, int] = (0, 25), umi: tuple[int, int] = (25, 10)) -> DataFrame:
    """``cb``, ``cb_qual``, ``umi`` and ``umi_qual``: (start, length) slices of the first read of pairs (read_no, r1, r2).
    A tag of length 0 is ten T, without qualities."""
    cut = lambda c, at: F.substring(F.col(c), F.lit(at[0] + 1), F.lit(at[1]))
    tag = (cut("r1.seq", umi), cut("r1.qual", umi)) if umi[1] else (F.lit("T" * 10), F.lit(None).cast("string"))
    return pairs.withColumns({"cb": cut("r1.seq", barcode), "cb_qual": cut("r1.qual", barcode), "umi": tag[0], "umi_qual": tag[1]})


def encode_or_fail(text: Column, rule: str = "ACGT") -> Column:
    """The 2-bit code; a letter other than A, C, G, T raises when the row is read."""
    code = seq.encode(text, rule)
    return F.when(code.isNull() & text.isNotNull(), F.raise_error(F.concat(F.lit("no code for "), text)).cast("long")).otherwise(code)


def tagged_name(name: Column, code: Column, umi: Column) -> Column:
    """A read's name without its mate's mark (the last /2, else the last /1) and, in hexadecimal, its two codes."""
    two = F.regexp_replace(name, "^(.*)/2(?!.*/2)", "$1")
    one = F.regexp_replace(name, "^(.*)/1(?!.*/1)", "$1")
    return F.concat_ws(" ", F.when(F.contains(name, F.lit("/2")), two).otherwise(one), F.hex(code), F.hex(umi))


def check_lengths(reads: DataFrame, text: Column, expected: int | None = None) -> DataFrame:
    """The reads, unchanged; one whose length differs from ``expected`` (else from the first row's) raises when it is read."""
    if expected is None:
        first = reads.select(F.length(text)).first()
        if first is None:
            return reads
        expected = first[0]
    column = reads.columns[0]
    wrong = F.raise_error(F.concat(F.lit(f"read length is not {expected} but "), F.length(text).cast("string")))
    return reads.withColumn(column, F.when(F.length(text) != expected, wrong.cast(reads.schema[column].dataType)).otherwise(F.col(column)))


def split_unknown(reads: DataFrame, text: str = "cb") -> DataFrame:
    """``way``: exact without unknown bases, rescue with one, drop with more; ``n_pos``: the bit pair of the one unknown
    base, else -1; ``barcode``: the code, unknown bases as A."""
    n = seq.n_count(F.col(text))
    way = F.when(n == 0, "exact").when(n == 1, "rescue").otherwise("drop")
    place = F.length(text) - F.length(F.regexp_replace(F.col(text), "[^ACGT].*$", "")) - 1
    code = seq.encode(F.regexp_replace(F.col(text), "[^ACGT]", "A"))
    return reads.withColumns({"way": way, "n_pos": F.when(n == 1, place).otherwise(-1).cast("int"), "barcode": code})


def load_reads(reads: DataFrame, five: int = 0, three: int = 0, adapter: str = "", quality_shift: int = 0) -> DataFrame:
    """What the aligner takes of FASTQ rows (name, seq, qual): ``read`` (the name's first word without a mate's mark and
    without what follows |||), ``tags`` (what follows it), ``mate`` (1 or 2), ``failed`` (a Y in the name's second word),
    the clipped bases in upper case with qualities of the usual offset, and the bases cut at the 3' end."""
    word = F.regexp_extract("name", r"^(\S*)", 1)
    comment = F.regexp_extract("name", r"^\S*\s+(\S+)", 1)
    bare = F.regexp_replace(F.element_at(F.split(word, r"\|\|\|", 2), 1), "/[12]$", "")
    tags = F.filter(F.slice(F.split(word, r"\|\|\|"), 2, 1000), lambda t: t != "")
    mate = F.coalesce(F.regexp_extract(word, "/([12])$", 1).try_cast("int"), F.regexp_extract(comment, "^([12]):", 1).try_cast("int"), F.lit(1))
    out = reads.withColumns({"read": bare, "tags": tags, "mate": mate, "failed": comment.rlike("^[12]:Y:"), "seq": F.upper("seq")})
    if quality_shift:
        out = out.withColumn("qual", shift_quality(F.col("qual"), quality_shift))
    out = clip(out, five, three).withColumn("_n", F.length("seq"))
    if adapter:
        out = clip_adapter(out, adapter)
    return out.withColumn("adapter_bases", F.col("_n") - F.length("seq")).drop("_n")


def cell_tags(reads: DataFrame, barcode: tuple[int, int], umi: tuple[int, int], text: str = "seq") -> DataFrame:
    """``cb``, ``umi`` and ``reject``: short (the read ends before its tags), n (an unknown base in the tag), homopolymer
    (a tag of one letter), else null."""
    out = reads.withColumns({k: F.substring(F.col(text), F.lit(a + 1), F.lit(n)) for k, (a, n) in (("cb", barcode), ("umi", umi))})
    one = F.length(F.replace(F.col("umi"), F.substring("umi", 1, 1), F.lit(""))) == 0
    short = F.length(text) < max(sum(barcode), sum(umi))
    return out.withColumn("reject", F.when(short, "short").when(seq.n_count(F.col("umi")) > 0, "n").when(one, "homopolymer"))


def unmapped(reads: DataFrame, mapped: DataFrame, key: list[str]) -> DataFrame:
    """Reads that have no mapped row, for the sinks of unmapped reads and of reads without a place."""
    return reads.join(mapped.select(*key).distinct(), key, "left_anti")


def mate_marks(name: Column, mate: Column, mapped_mate: Column) -> Column:
    """Names of unmapped reads: the mate's number, and what is known of the other mate (00 none, 10 first, 01 second mapped)."""
    return F.concat(name, F.lit(" "), (mate - 1).cast("string"), F.lit(":N: "), F.when(mapped_mate == 1, "10").when(mapped_mate == 2, "01").otherwise("00"))


def first_reads(reads: DataFrame, most: int, number: str = "read_no") -> DataFrame:
    """Reads of the first ``most`` numbers; all if it is negative."""
    return reads if most < 0 else reads.where(F.col(number) < most)
