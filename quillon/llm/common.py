"""What the training-data operators share: scratch tables in the cluster's shared folder, byte views of text columns, rolling hashes and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: An odd base, two mixing multipliers.
BASE = 0x9E3779B97F4A7C15 | 1
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB


# --- scratch tables ------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only where it is unset (tests, one machine) a local folder is made."""
    if not (found := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="scratch_")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class Scratch:
    """Tables written as Parquet to the shared folder: they cut lineage and survive lost executors. ``drop`` removes one early, the rest goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}", 0
        atexit.register(self._remove, self.root)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        if path := getattr(df, "_scratch_path", None):
            self._remove(path)

    def _remove(self, path: str) -> None:
        try:
            jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # noqa: BLE001  the session may be gone; the folder belongs to the cluster's clean-up then
            pass


# --- bytes of text columns -----------------------------------------------------------------------


def blobs(column: pa.Array, most: int = 1 << 19, rows: int = 256) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows with about ``most`` bytes and at most ``rows`` rows; a longer row comes alone. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    # only ``rows`` rows are converted at once, so a batch of long texts isn't copied as a whole
    for first in range(0, len(column), rows):
        a = column.slice(first, rows).cast(pa.large_string()).fill_null("").cast(pa.large_binary())
        n, kept = len(a), a.buffers()
        off = np.frombuffer(kept[1], np.int64)[a.offset : a.offset + n + 1]
        data = np.frombuffer(kept[2], np.uint8) if kept[2] is not None and kept[2].size else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
            yield first + lo, first + hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
            lo = hi


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


class Roller:
    """Polynomial hashes modulo 2^64 of any byte ranges of a text, by prefix sums. Bytes are replaced by random odd numbers first."""

    def __init__(self, base: int = BASE):
        self.up, self.down = base, pow(base, -1, 1 << 64)
        self.table = np.random.default_rng(20011).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.n = 0
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        if n > self.n:
            self.n = max(n, 2 * self.n)
            self.powers, self.inverse = _powers(self.up, self.n), _powers(self.down, self.n)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Sums that ``between`` takes: one entry more than there are bytes."""
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverse[start])

    def windows(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hash of each ``k``-byte window."""
        m = len(prefix) - k
        return mix((prefix[k:] - prefix[:m]) * self.inverse[:m]) if m > 0 else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


# --- connected components ------------------------------------------------------------------------


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for each id of an edge, by alternating large-star and small-star steps.

    Each round halves the longest path at least; every round is written to the shared folder. Ids are longs. No edges: no rows.
    A vertex with many neighbours is pre-aggregated (a minimum) and its rows are joined, not collected."""
    now = scratch.save(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while True:
        # the least of each neighbourhood is a table of its own: the joins with it are then plain exchanges, and Spark splits a hub's rows
        # large star: every larger neighbour points to the smallest of the neighbourhood
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = scratch.save(both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: each vertex and its smaller neighbours point to the smallest of them
        low = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.save(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        same = new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty()
        for old in (least, large, low, now):
            scratch.drop(old)
        now = new
        if same:
            break
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots.select("id", F.col("id").alias("component")))
