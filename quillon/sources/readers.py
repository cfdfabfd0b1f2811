"""Readers of sequencing and annotation files, all through Spark's own readers, so any store and codec it knows will do."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import seq
from . import binary

FASTQ = "file string, block long, no long, name string, seq string, strand string, qual string, bad boolean"
SIDE = ["file", "block", "no", "name", "seq", "strand", "qual", "bad"]


def _is_record(four: list[str]) -> bool:
    return len(four) == 4 and four[0].startswith("@") and four[2].startswith("+") and len(four[1]) == len(four[3])


def paths_of(spark: SparkSession, path: str) -> list[str]:
    """A path, or, if the file's first line names a readable path, the paths that its lines name."""
    first = spark.read.text(path).first()
    line = first.value.strip() if first else ""
    if "/" not in line or line.startswith(("@", ">", "#")) or "\t" in line:
        return [path]
    # a list is as long as there are files to read, which the driver lists anyway
    return [x for r in spark.read.text(path).collect() if (x := r.value.strip())]


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, read_no, name, seq, strand, qual) of FASTQ files, plain ones split anywhere, compressed ones whole. read_no counts from 0 in a file. A record whose sequence and quality differ in length, or a cut one, raises.

    Each block finds its first record by its shape (four lines, the third a plus, the second and fourth equally long) and hands on the lines before it and after its last record; a file's few such lines are put together afterwards."""
    return records(spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def read_block_fastq(spark: SparkSession, paths: str | list[str], blocks: int = 256) -> DataFrame:
    """``read_fastq`` of block-gzipped files (.gz of blocks that tell their sizes), so many blocks a task. One pass hops over the blocks' headers; a task then reads its blocks, and on to the end of its last line."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")

    def hop(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, inner = binary.filesystem(name)
                at, starts = 0, []
                with store.open_input_file(inner) as f:
                    while len(head := f.read_at(18, at)) == 18:
                        if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"BC":
                            raise ValueError(f"{name} is not block-gzipped")
                        starts.append(at)
                        at += int.from_bytes(head[16:18], "little") + 1
                cuts = [*starts[::blocks], at]
                yield pa.RecordBatch.from_arrays([pa.array([name] * (len(cuts) - 1), pa.string()), pa.array(cuts[:-1], pa.int64()), pa.array(cuts[1:], pa.int64())], ["file", "block", "stop"])

    def lines(batches):
        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, inner = binary.filesystem(name)
                held, at, past, skip = b"", start, False, start > 0
                with store.open_input_file(inner) as f:
                    while len(head := f.read_at(18, at)) == 18:
                        size = int.from_bytes(head[16:18], "little") + 1
                        raw = zlib.decompress(f.read_at(size - 26, at + 18), -15)
                        at += size
                        past = past or at > stop
                        if past:  # the next task begins after this block's first line feed
                            held += raw[: raw.index(b"\n") + 1] if b"\n" in raw else raw
                            if b"\n" in raw:
                                break
                            continue
                        held += raw
                        if skip:
                            if b"\n" not in held:
                                held = b""
                                continue
                            held, skip = held[held.index(b"\n") + 1 :], False
                        parts = held.split(b"\n")
                        held = parts.pop()
                        if parts:
                            yield pa.RecordBatch.from_arrays([pa.array([p.decode() for p in parts]), pa.array([name] * len(parts)), pa.array([start] * len(parts), pa.int64())], ["value", "file", "block"])
                rest = [] if skip and not past else [p.decode() for p in held.split(b"\n")]
                rest = rest[:-1] if rest and not rest[-1] else rest
                if rest:
                    yield pa.RecordBatch.from_arrays([pa.array(rest), pa.array([name] * len(rest)), pa.array([start] * len(rest), pa.int64())], ["value", "file", "block"])

    ranges = files.repartition("path").mapInArrow(hop, "file string, block long, stop long").repartition("file", "block")
    return records(ranges.mapInArrow(lines, "value string, file string, block long"))


def records(lines: DataFrame) -> DataFrame:
    """The reads of lines (value, file, block), a block's lines in order in one task."""

    def run(batches):
        now, held, synced, no = None, [], False, 0
        rows: list[tuple] = []

        def side(lines, kind):
            # lines that belong to a record across blocks: kind -1 before the first record, -2 after the last
            return [(now[0], now[1], kind, x, str(i), None, None, False) for i, x in enumerate(lines)]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()))], SIDE)

        for batch in batches:
            for value, file, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, block) != now:
                    if now:
                        rows += side(held, -2 if synced else -1)
                    now, held, synced, no = (file, block), [], block == 0, 0
                held.append(value.rstrip("\r"))
                if synced and len(held) == 4:
                    rows.append((file, block, no, held[0][1:], held[1], held[2], held[3], not _is_record(held)))
                    held, no = [], no + 1
                elif not synced and len(held) >= 4 and _is_record(held[-4:]):
                    rows += side(held[:-4], -1)
                    rows.append((file, block, no, held[-4][1:], *held[-3:], False))
                    held, synced, no = [], True, 1
            if rows:
                yield batch_of(rows)
                rows = []
        if now:
            yield batch_of(rows + side([x for x in held if x or not synced], -2 if synced else -1))

    parts = lines.mapInArrow(run, FASTQ)
    whole = parts.where("no >= 0")

    def mend(t: pa.Table) -> pa.Table:
        got = t.to_pylist()
        out, lines, at = [], [], None
        # the last lines of a block and the first of the next make one record; blocks without a record of their own add to it
        got.sort(key=lambda r: (r["block"], r["no"] == -2, int(r["seq"])))
        for r in got:
            if r["no"] == -2 and at is None:
                at = r["block"]
            lines.append(r["name"])
            if at is None:
                at = r["block"]
            if len(lines) == 4:
                out.append((r["file"], at, 1 << 40, lines[0][1:], *lines[1:], not _is_record(lines)))
                lines, at = [], None
        if any(lines):
            out.append((got[-1]["file"], at, 1 << 40, "", "", "", "", True))
        return pa.table({n: pa.array([o[i] for o in out], ty) for i, (n, ty) in enumerate(zip(SIDE, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()), strict=True))})

    mended = parts.where("no < 0").groupBy("file").applyInArrow(mend, FASTQ)
    rows = whole.unionByName(mended)
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.max("no").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "block", "offset", "n")
    number = F.col("offset") + F.when(F.col("no") >= 1 << 40, F.col("n") - 1).otherwise(F.col("no"))
    seq = F.when(F.col("bad"), F.raise_error(F.concat(F.lit("broken record near "), F.coalesce("name", F.lit("")))).cast("string")).otherwise(F.col("seq"))
    return rows.join(offsets, ["file", "block"]).select("file", number.alias("read_no"), "name", seq.alias("seq"), "strand", "qual")


def pair(first: DataFrame, second: DataFrame) -> DataFrame:
    """(file_no, read_no, r1, r2) of two mates' reads, the files of each taken in the order of their names; the shorter file of two ends them."""

    def one(d: DataFrame, n: str) -> DataFrame:
        files = d.select("file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("file")) - 1)  # a row a file
        return d.join(F.broadcast(files), "file").select("file_no", "read_no", F.struct("name", "seq", "qual").alias(n))

    return one(first, "r1").join(one(second, "r2"), ["file_no", "read_no"])


def interleaved(reads: DataFrame) -> DataFrame:
    """Pairs of files in which mates follow each other."""
    mate = reads.withColumns({"m": F.col("read_no") % 2, "read_no": F.floor(F.col("read_no") / 2)})
    return pair(mate.where("m = 0"), mate.where("m = 1"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chr, description, seq); a record is one row, cut at its header sign by the text reader itself."""
    rows = spark.read.option("lineSep", ">").text(paths).where("trim(value) <> ''")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", ""))
    return rows.select(F.regexp_extract(head, r"^(\S*)", 1).alias("chr"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), body.alias("seq"))


def chromosome_starts(chromosomes: DataFrame, bits: int = 18) -> DataFrame:
    """``chr_start`` and ``chr_length`` of chromosomes (few rows) padded to whole bins."""
    length = F.length("seq").cast("long")
    padded = F.ceil(length / (1 << bits)) * (1 << bits)
    return chromosomes.select("chr", length.alias("chr_length"), F.coalesce(F.sum(padded).over(Window.orderBy("chr").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("chr_start"))


def attribute(name: str, c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, rf'(?:^|;)\s*{name}\s+"?([^";]*)"?', 1), F.lit(""))


def read_gtf(spark: SparkSession, paths: str | list[str], feature: str = "exon", transcript: str = "transcript_id", gene: str = "gene_id", names: str = "gene_name", types: tuple[str, ...] = ("gene_type", "gene_biotype"), prefix: str = "") -> DataFrame:
    """(chr, start, end, strand, tr, gene, gene_name, gene_type) of exons; without a gene the transcript stands for it, without a name the gene, without a type an empty one."""
    p = F.split("value", "\t")
    rows = spark.read.text(paths).where("not value like '#%'").select(p.alias("p")).where((F.size("p") >= 9) & (F.get("p", F.lit(2)) == feature))
    a = F.get("p", F.lit(8))
    rows = rows.select(F.concat(F.lit(prefix), F.get("p", F.lit(0))).alias("chr"), F.get("p", F.lit(3)).cast("long").alias("start"), F.get("p", F.lit(4)).cast("long").alias("end"), F.get("p", F.lit(6)).alias("strand"), attribute(transcript, a).alias("tr"), attribute(gene, a).alias("g"), attribute(names, a).alias("n"), F.coalesce(*[attribute(t, a) for t in types], F.lit("")).alias("gene_type"))
    rows = rows.where("tr is not null").withColumn("gene", F.coalesce("g", "tr"))
    return rows.select("chr", "start", "end", "strand", "tr", "gene", F.coalesce("n", "gene").alias("gene_name"), "gene_type")


def read_junctions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chr, start, end, strand) with strand 1 for 1 or +, 2 for 2 or -, else 0."""
    p = F.split("value", r"\s+")
    s = F.get(p, F.lit(3))
    return spark.read.text(paths).where("trim(value) <> ''").select(F.get(p, F.lit(0)).alias("chr"), F.get(p, F.lit(1)).cast("long").alias("start"), F.get(p, F.lit(2)).cast("long").alias("end"), F.when(s.isin("1", "+"), 1).when(s.isin("2", "-"), 2).otherwise(0).alias("strand"))


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chr, pos, ref, a1, a2) of single-base variants of a diploid sample that isn't homozygous for the reference."""
    p = F.split("value", "\t")
    rows = spark.read.text(paths).where("not value like '#%'").where(F.size(p) >= 10)
    at = lambda i: F.get(p, F.lit(i))
    alleles = F.concat(F.array(at(3)), F.split(at(4), ","))
    g = F.regexp_extract_all(F.split(at(9), ":")[0], F.lit(r"(\d+)"), F.lit(1))
    rows = rows.select(at(0).alias("chr"), at(1).cast("long").alias("pos"), at(3).alias("ref"), alleles.alias("x"), g.alias("g")).where((F.size("g") == 2) & F.forall("x", lambda a: a.rlike("^[ACGT]$")))
    rows = rows.withColumns({"a1": F.get("x", F.get("g", F.lit(0)).cast("int")), "a2": F.get("x", F.get("g", F.lit(1)).cast("int"))})
    return rows.where("a1 is not null and a2 is not null and not (a1 = ref and a2 = ref)").select("chr", "pos", "ref", "a1", "a2")


def read_chain(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chr, chr2, s1, s2, len): blocks of chains, their starts summed up from the lengths and gaps before them. A chain is a row until its lines are exploded."""
    rows = spark.read.option("lineSep", "chain ").text(paths).where("trim(value) <> ''")
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    h = F.split(F.get(lines, F.lit(0)), r"\s+")
    rows = rows.select(F.get(h, F.lit(1)).alias("chr"), F.get(h, F.lit(4)).cast("long").alias("o1"), F.get(h, F.lit(6)).alias("chr2"), F.get(h, F.lit(9)).cast("long").alias("o2"), F.get(h, F.lit(11)).alias("id"), F.slice(lines, 2, F.size(lines)).alias("b"))
    each = rows.select("chr", "chr2", "id", "o1", "o2", F.posexplode("b").alias("i", "t")).withColumn("t", F.split(F.trim("t"), r"\s+"))
    each = each.withColumns({"len": F.get("t", F.lit(0)).cast("long"), "d1": F.coalesce(F.get("t", F.lit(1)).cast("long"), F.lit(0)), "d2": F.coalesce(F.get("t", F.lit(2)).cast("long"), F.lit(0))})
    w = Window.partitionBy("chr", "chr2", "id", "o1", "o2").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("chr", "chr2", (F.col("o1") + F.coalesce(F.sum(F.col("len") + F.col("d1")).over(w), F.lit(0))).alias("s1"), (F.col("o2") + F.coalesce(F.sum(F.col("len") + F.col("d2")).over(w), F.lit(0))).alias("s2"), "len")


def read_position_map(spark: SparkSession, path: str, encode: bool = True) -> DataFrame:
    """(barcode, x, y): .parquet, .bin (u64, u32, u32, little-endian, 0 for an empty cell; cut anywhere between records), .h5, or text of barcode, x, y, whose letters become codes if ``encode``."""
    kind = path.rstrip("/").rsplit(".", 1)[-1]
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "h5":
        return read_mask(spark, path)
    if kind == "bin":
        import numpy as np

        def decode(raw: bytes) -> pa.RecordBatch:
            a = np.frombuffer(raw, np.dtype([("barcode", "<u8"), ("x", "<u4"), ("y", "<u4")]))
            a = a[a["barcode"] != 0]
            return pa.RecordBatch.from_arrays([pa.array(a["barcode"].astype(np.int64)), pa.array(a["x"].astype(np.int32)), pa.array(a["y"].astype(np.int32))], ["barcode", "x", "y"])

        return binary.read_records(spark, path, 16, decode, "barcode long, x int, y int")
    rows = spark.read.schema("barcode string, x int, y int").option("sep", "\t").option("comment", "#").csv(path)
    return rows.withColumn("barcode", code_of(F.col("barcode"))) if encode else rows


def code_of(text: Column) -> Column:
    """The code of a barcode written in letters or as a number."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("long")).otherwise(seq.encode(text))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, n) of a text table or of .bin records (u64, u64); lines that begin with # are skipped, letters become codes."""
    if path.rstrip("/").endswith(".bin"):
        import numpy as np

        def decode(raw: bytes) -> pa.RecordBatch:
            a = np.frombuffer(raw, "<u8").reshape(-1, 2).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in a.T], ["barcode", "n"])

        return binary.read_records(spark, path, 16, decode, "barcode long, n long")
    rows = spark.read.schema("barcode string, n long").option("sep", "\t").option("comment", "#").csv(path)
    return rows.withColumn("barcode", code_of(F.col("barcode")))


def singles(counts: DataFrame) -> int:
    """How many barcodes of a count table were seen once."""
    return counts.where("n = 1").count()


def read_mask(spark: SparkSession, path: str, dataset: str = "bpMatrix_1") -> DataFrame:
    """(barcode, x, y) of an HDF5 chip mask, if h5py is installed where the tasks run; files are local to them."""
    try:
        import h5py
    except ImportError as e:
        raise NotImplementedError("HDF5 masks need h5py; convert them to Parquet otherwise") from e
    with h5py.File(path, "r") as f:
        rows, columns, _ = f[dataset].shape

    def run(batches):
        import h5py
        import numpy as np

        with h5py.File(path, "r") as f:
            for batch in batches:
                for lo in batch.column(0).to_pylist():
                    slab = f[dataset][lo : lo + 256]
                    y, x, s = np.nonzero(slab)
                    yield pa.RecordBatch.from_arrays([pa.array(slab[y, x, s].astype(np.int64)), pa.array(x.astype(np.int32)), pa.array((y + lo).astype(np.int32))], ["barcode", "x", "y"])

    return spark.range(0, rows, 256).repartition(max(1, rows // 256)).mapInArrow(run, "barcode long, x int, y int")


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The eleven fields and the tags (name to value) of SAM text."""
    p = F.split("value", "\t")
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    kinds = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}
    tags = F.map_from_entries(F.transform(F.slice(p, 12, F.greatest(F.size(p) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t)))))
    return spark.read.text(paths).where("not value like '@%'").select(*[F.get(p, F.lit(i)).cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)], tags.alias("tags"))
