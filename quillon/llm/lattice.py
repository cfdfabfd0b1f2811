"""Near-duplicate embeddings by lattice hashing: random projections to E8 lattice points, neighbouring cells probed, links confirmed by cosine."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, mix

TABLES, PROBES, SCALE = 10, 16, 1.25
LINK = 0.98
FLOATS = 2048  # numbers of a block of vectors: it bounds a row, and with it an Arrow batch
ODD = np.random.default_rng(88).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or all of +-1/2 with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(out)


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better of the two cosets of D8, whole and half-odd coordinates, each with an even sum."""

    def even(y):
        z = np.rint(y)
        odd = np.flatnonzero(z.sum(1).astype(np.int64) % 2)
        if len(odd):
            d = y[odd] - z[odd]
            i = np.abs(d).argmax(1)
            z[odd, i] += np.where(d[np.arange(len(odd)), i] >= 0, 1, -1)
        return z

    a, b = even(x), even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cells(points: np.ndarray, seed: np.ndarray) -> np.ndarray:
    twice = np.rint(2 * points).astype(np.int64).view(np.uint64)
    return mix((twice * ODD[:8]).sum(-1, dtype=np.uint64) * ODD[9] + seed)


def usable(embedding: str = "embedding", label: str = "label"):
    ok = F.col(embedding).isNotNull() & F.col(label).isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(ok & F.exists(embedding, lambda x: x != 0), F.lit(False))


def probe(classes: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """(cell, own, home, rep): the cell of each vector in each table (``own``), and the neighbouring cells nearest to it, all with the vector's cell in the first table, its home; the one row of a vector that is its home names it."""
    schema = "cell long, own boolean, home long, rep long"
    names = ["cell", "own", "home", "rep"]

    def run(batches):
        near, plans = roots(), {}
        for batch in batches:
            rep, label, vectors = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            size = np.array([len(v) for v in vectors])
            kind = np.array([hash_of(str(v)) for v in label.to_pylist()], np.uint64)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                x = np.array([vectors[int(i)].as_py() for i in at], np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if dim not in plans:
                    plans[dim] = np.random.default_rng(int(dim)).normal(size=(tables, int(dim), 8)) * scale
                home = None
                for t in range(tables):
                    y = x @ plans[dim][t]
                    p = nearest(y)
                    seed = mix(kind[at] + ODD[10] * np.uint64(t) + ODD[11] * np.uint64(dim))
                    own = cells(p, seed).view(np.int64)
                    home = own if t == 0 else home
                    named = pa.array(rep[at]) if t == 0 else pa.nulls(len(at), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.ones(len(at), bool)), pa.array(home), named], names)
                    if probes:
                        top = np.argpartition(-((y - p) @ near.T), probes - 1, 1)[:, :probes]
                        other = cells(p[:, None, :] + near[top], seed[:, None]).view(np.int64).ravel()
                        yield pa.RecordBatch.from_arrays([pa.array(other), pa.array(np.zeros(other.size, bool)), pa.array(np.repeat(home, probes)), pa.nulls(other.size, pa.int64())], names)

    return classes.select("rep", F.col("label").cast("string"), "embedding").mapInArrow(run, schema)


def hash_of(s: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s)


def cosine(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each row of the two, brought to a largest component between 1/2 and 1 first (by powers of two, exactly), so that no square overflows or vanishes."""
    p, q = (np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) for x in (p, q))
    return (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))


class Tally:
    """Links found in a task, as a row (rep, n, root) for each vector that has any: the number of others linked to it, and the smallest vector that it is joined with."""

    def __init__(self, most: int = 2_000_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.held, self.a, self.b, self.na, self.nb = 0, [], [], [], []

    def add(self, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> None:
        self.a.append(a), self.b.append(b), self.na.append(na), self.nb.append(nb)
        self.held += len(a)

    def rows(self, last: bool = False):
        if not self.held or not (last or self.held >= self.most):
            return
        a, b, na, nb = (np.concatenate(x).astype(np.int64) for x in (self.a, self.b, self.na, self.nb))
        self._clear()
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, at, np.concatenate([nb, na]))
        u, v, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
        while True:  # the least label spreads over links and along labels
            low, new = np.minimum(root[u], root[v]), root.copy()
            for x in (u, v, root[u], root[v]):
                np.minimum.at(new, x, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(ids[root])], ["rep", "n", "root"])


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, reps, copies, vectors in one row after the other) of lists of (rep, copies, embedding)."""
    flat = column.flatten()
    rep, copies, e = (flat.field(i) for i in range(3))
    return column.offsets.to_numpy() - column.offsets[0].as_py(), rep.to_numpy(), copies.to_numpy(), e.cast(pa.list_(pa.float64()))


def compare(least: float):
    """A task's function: tallies of all links between the vectors of two blocks (lists ``x`` and ``y``), or inside one block where ``same``."""

    def run(batches):
        tally = Tally()
        for batch in batches:
            xo, xr, xn, xe = _unpack(batch.column(0))
            yo, yr, yn, ye = _unpack(batch.column(1))
            same = np.asarray(batch.column(2))
            xd, yd = (e.value_lengths().to_numpy(zero_copy_only=False) for e in (xe, ye))
            xs, ys = np.diff(xo), np.diff(yo)
            # single vectors, which most blocks are, all at once
            one = np.flatnonzero((xs == 1) & (ys == 1) & ~same)
            one = one[xd[xo[one]] == yd[yo[one]]]
            for dim in np.unique(xd[xo[one]]):
                at = one[xd[xo[one]] == dim]
                i, j = xo[at], yo[at]
                p, q = (e.take(pa.array(k)).flatten().to_numpy().reshape(-1, dim) for e, k in ((xe, i), (ye, j)))
                ok = cosine(p, q) >= least
                tally.add(xr[i[ok]], yr[j[ok]], xn[i[ok]], yn[j[ok]])
            for r in np.flatnonzero((xs > 1) | (ys > 1)):
                i, j = slice(xo[r], xo[r + 1]), slice(yo[r], yo[r + 1])
                dim = int(xd[xo[r]])
                if (xd[i] != dim).any() or (yd[j] != dim).any():
                    continue  # a home holds vectors of one length, but for a collision of hashes
                p, q = (e.slice(k.start, k.stop - k.start).flatten().to_numpy().reshape(-1, dim) for e, k in ((xe, i), (ye, j)))
                a, b = np.nonzero(products(p, q) >= least - 1e-9)
                if same[r]:
                    a, b = a[a < b], b[a < b]
                ok = cosine(p[a], q[b]) >= least if len(a) else np.zeros(0, bool)
                tally.add(xr[i][a[ok]], yr[j][b[ok]], xn[i][a[ok]], yn[j][b[ok]])
            yield from tally.rows()
        yield from tally.rows(True)

    return run


def products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of all rows of the one with all of the other, by a matrix product of unit vectors."""
    p, q = (np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) for x in (p, q))
    return (p / np.sqrt((p * p).sum(1, keepdims=True))) @ (q / np.sqrt((q * q).sum(1, keepdims=True))).T


def link(vectors: DataFrame, scratch: Scratch, least: float = LINK, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of one label (not null) and one length linked where their cosine, in doubles, is ``least`` or more.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link with nothing. Rows that repeat a vec_id with its vector and label are one vector; with another vector or label they are vectors of their own. Equal vectors of a label are one class: they are linked to each other and counted, never paired.

    Each class has a home, its cell in the first table. Two homes are compared if in any table a class of one is in a cell that a class of the other is in or probes; of a cell only its homes meet, so many vectors of few homes cost few rows. Homes are cut into blocks of bounded size and compared by matrix products, each pair of blocks once; a task returns a row for each vector that has links, not for each link. What is met is confirmed by cosine, so no link is false; some may be missed (README: recall)."""
    rows = scratch.save(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn("ok", usable()).withColumns({"c1": F.xxhash64("label", "embedding"), "c2": F.xxhash64(F.lit(1), "embedding", "label")}).dropDuplicates(["vec_id", "c1", "c2"]))
    good = rows.where("ok and vec_id is not null")
    same = [F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")]
    # a number of its own for each class, fixed by writing it: a vec_id may have several vectors
    classes = scratch.save(good.groupBy("c1", "c2").agg(*same).withColumn("rep", F.monotonically_increasing_id()))
    met = scratch.save(probe(classes, tables, probes, scale))
    homes = met.where("rep is not null").select("rep", "home")
    sizes = homes.groupBy("home").agg(F.count("*").alias("k"))
    held = classes.select("rep", "copies", "embedding").join(homes, "rep").join(sizes, "home")
    count = F.ceil(F.col("k") * F.size("embedding") / FLOATS)
    block = F.pmod(F.xxhash64("rep"), count).cast("int")
    listed = scratch.save(held.groupBy("home", block.alias("block")).agg(F.collect_list(F.struct("rep", "copies", "embedding")).alias("x")))
    dealt = met.select("cell", "own", "home").repartition("cell").distinct()
    own, any_ = dealt.where("own").select("cell", F.col("home").alias("a")), dealt.select("cell", F.col("home").alias("b"))
    pairs = scratch.save(own.join(any_, "cell").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    scratch.drop(met)
    x, y = listed.select(F.col("home").alias("a"), "block", "x"), listed.select(F.col("home").alias("b"), F.col("block").alias("block2"), F.col("x").alias("y"))
    across = pairs.join(x, "a").join(y, "b").select("x", "y", F.lit(False).alias("same"))
    within = x.where("size(x) > 1").select("x", F.col("x").alias("y"), F.lit(True).alias("same"))
    beside = x.join(y.withColumnRenamed("b", "a"), "a").where("block < block2").select("x", "y", F.lit(False).alias("same"))
    links = scratch.save(across.unionAll(within).unionAll(beside).mapInArrow(compare(least), "rep long, n long, root long"))
    counts = links.groupBy("rep").agg(F.sum("n").alias("others"))
    joined = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch).withColumnRenamed("id", "rep")
    of = scratch.save(classes.select("c1", "c2", "rep", "least", "copies").join(counts, "rep", "left").join(joined, "rep", "left").withColumn("c", F.coalesce("component", "rep")))
    lowest = of.groupBy("c").agg(F.min("least").alias("component"))
    of = of.drop("component").join(lowest, "c").select("c1", "c2", F.lit(True).alias("ok"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "component")
    out = rows.withColumn("ok", F.when(F.col("ok") & F.col("vec_id").isNotNull(), True)).join(of, ["c1", "c2", "ok"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark))


SQL = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
u as (select *, sqrt(list_dot_product(e, e)) m from v where list_dot_product(e, e) > 0),
l as (select a.vec_id a, b.vec_id b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.m * b.m) >= 0.98),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on l.a = r.b)
select e.vec_id, (select count(*) from l where l.a = e.vec_id) n_links, m.c component_id, e.vec_id = m.c kept
from embeddings e join (select a, min(b) c from r group by a) m on m.a = e.vec_id
"""
