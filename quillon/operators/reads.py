"""Reads before alignment: clips, adapters, good stretches, merged mates; and a plain local alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clip(reads: DataFrame, five: int = 0, three: int = 0) -> DataFrame:
    """Cuts bases from both ends of ``seq`` and ``qual``."""
    n = F.greatest(F.length("seq") - five - three, F.lit(0))
    return reads.withColumns({c: F.substring(c, F.lit(five + 1), n) for c in ("seq", "qual")})


def adapter_start(text: Column, adapter: str, share: float = 0.1) -> Column:
    """0-based place where an adapter begins at the 3' end: of the places where at most that share of the compared letters differs, the one of the most matches, then the first; the length of the text if there is none."""
    n = F.length(text)
    size = lambda i: F.least(n - i, F.lit(len(adapter)))
    same = lambda i: F.aggregate(F.zip_with(F.split(F.substring(text, i + 1, size(i)), ""), F.split(F.substring(F.lit(adapter), F.lit(1), size(i)), ""), lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, v: s + v)
    places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((-same(i)).alias("m"), i.alias("i"), (size(i) - same(i) <= size(i) * share).alias("ok")))
    best = F.array_min(F.filter(places, lambda p: p.ok))
    return F.when(n == 0, 0).otherwise(F.coalesce(best.i, n))


def clip_adapter(reads: DataFrame, adapter: str, share: float = 0.1, after: int = 0) -> DataFrame:
    """Cuts the adapter, what follows it, and ``after`` bases more."""
    # counted once in a column of its own: two copies of its nested lambdas in one projection disturb each other
    out = reads.withColumn("_cut", F.greatest(adapter_start(F.col("seq"), adapter, share) - after, F.lit(0)))
    return out.withColumns({c: F.substring(c, F.lit(1), F.col("_cut")) for c in ("seq", "qual")}).drop("_cut")


def good_stretches(text: Column, least: int = 12, qual: Column | None = None, low: int = 0) -> Column:
    """array of (start, length) of stretches of known bases of at least that length, starts from 0; with ``qual``, bases of a quality under ``low`` count as unknown."""
    if qual is not None:
        masked = F.zip_with(F.split(text, ""), F.split(qual, ""), lambda b, q: F.when(F.ascii(q) - 33 < low, F.lit("N")).otherwise(b))
        text = F.array_join(masked, "")
    parts = F.split(text, "(?<=[^ACGT])|(?=[^ACGT])")
    kind = "cast(array() as array<struct<start:int,length:int>>)"
    long = lambda p: (F.length(p) >= least) & ~p.rlike("[^ACGT]")
    added = lambda s, p: F.concat(s.out, F.array(F.struct(s.at.alias("start"), F.length(p).alias("length"))))
    step = lambda s, p: F.struct((s.at + F.length(p)).alias("at"), F.when(long(p), added(s, p)).otherwise(s.out).alias("out"))
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.expr(kind).alias("out")), step, lambda s: s.out)


def shift_quality(qual: Column, by: int) -> Column:
    """Qualities of another offset, such as 64 to 33 by -31, at least '!'."""
    return F.array_join(F.transform(F.split(qual, ""), lambda c: F.chr(F.greatest(F.ascii(c) + by, F.lit(33)))), "")


def local_alignment(a: str, b: str, match: int = 1, mismatch: int = -1, opens: int = -2, extends: int = -1) -> tuple[int, int, int]:
    """(score, end in a, end in b) of the best local alignment with affine gaps, row by row; a gap of n costs opens + n * extends."""
    x, y = (np.frombuffer(s.encode(), np.uint8) for s in (a, b))
    low = -(1 << 30)
    score, down, best = np.zeros(len(y) + 1, np.int64), np.full(len(y) + 1, low), (0, 0, 0)
    ramp = extends * np.arange(len(y) + 1)
    for i, c in enumerate(x):
        down = np.maximum(score + opens, down) + extends
        new = np.zeros(len(y) + 1, np.int64)
        new[1:] = np.maximum(0, score[:-1] + np.where(y == c, match, mismatch))
        new = np.maximum(new, down)
        # gaps along the row: the best of the cells before, less the way from them
        across = np.maximum.accumulate(new - ramp)[:-1] + ramp[1:] + opens
        new[1:] = np.maximum(new[1:], across)
        new = np.maximum(new, 0)
        score = new
        j = int(score.argmax())
        best = max(best, (int(score[j]), i + 1, j), key=lambda t: t[0])
    return best


def local_alignments(pairs: DataFrame, a: str = "a", b: str = "b", **costs: int) -> DataFrame:
    """``pairs`` with ``score``, ``a_end`` and ``b_end`` of the best local alignment of two texts; null texts count as empty."""
    names = pairs.columns

    def run(batches):
        for batch in batches:
            x, y = (batch.column(names.index(c)).to_pylist() for c in (a, b))
            got = [local_alignment(p or "", q or "", **costs) for p, q in zip(x, y, strict=True)]
            more = [pa.array([g[i] for g in got], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*names, "score", "a_end", "b_end"])

    schema = T.StructType([*pairs.schema.fields, *[T.StructField(n, T.IntegerType()) for n in ("score", "a_end", "b_end")]])
    return pairs.mapInArrow(run, schema)
