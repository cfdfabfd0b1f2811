"""Near-duplicates: MinHash signatures, a multi-index Hamming join by pigeonhole, exact confirmation on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Roller, Scratch, blobs, components, mix

WORDS = 5
CHUNKS, SYMBOLS, BITS = 7, 4, 16  # a signature: 7 longs of 4 symbols of 16 bits
ERRORS = 1  # wrong symbols that a chunk may have
TIGHT = 5
BLOCK = 8192  # members of a bucket's block
ROWS = 1024  # documents of a cluster's block
CHUNK_NAMES = [f"s{i}" for i in range(CHUNKS)]
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ODD = np.random.default_rng(41).integers(1, 1 << 62, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(data: np.ndarray, off: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word, in order. A row of over 8 MB is hashed in pieces cut at white space."""
    if len(data) > 8 << 20 and len(off) == 2:
        out, lo = [], 0
        while lo < len(data):
            hi = min(lo + (4 << 20), len(data))
            gap = np.flatnonzero(SPACE[data[hi:]][: 1 << 20]) if hi < len(data) else []
            hi = hi + int(gap[0]) if len(gap) else len(data) if hi + (1 << 20) >= len(data) else hi
            while hi < len(data) and not SPACE[data[hi]]:
                hi += 1
            out.append(words(data[lo:hi], np.array([0, hi - lo]), roller)[1])
            lo = hi
        h = np.concatenate(out)
        return np.zeros(len(h), np.int64), h
    low = LOWER[data]
    inside = ~SPACE[low]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = off[1:-1]
    first, last = edge[edge < len(data)], edge[edge > 0] - 1
    start[first] = inside[first]
    end[last] = inside[last]
    a, b = np.flatnonzero(start), np.flatnonzero(end) + 1
    return np.searchsorted(off, a, "right") - 1, roller.between(roller.prefix(low), a, b)


def shingle_sets(data: np.ndarray, off: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, sizes): the distinct shingles of each row as row << 55 | 55-bit hash."""
    row, h = words(data, off, roller)
    rows = len(off) - 1
    count = np.bincount(row, minlength=rows)
    n = max(0, len(h) - WORDS + 1)
    value = sum((h[i : i + n] * ODD[i] for i in range(WORDS)), np.zeros(n, np.uint64))
    whole = row[:n] == row[WORDS - 1 : WORDS - 1 + n]
    value, owner = [mix(value[whole])], [row[:n][whole]]
    begin = np.cumsum(count) - count
    for few in range(1, WORDS):
        at = np.flatnonzero(count == few)
        value.append(mix(sum((h[begin[at] + i] * ODD[i] for i in range(few)), np.zeros(len(at), np.uint64)) ^ ODD[100 + few]))
        owner.append(at)
    key = np.sort((np.concatenate(owner).astype(np.uint64) << np.uint64(55)) | (np.concatenate(value) >> np.uint64(9)))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key, np.bincount((key >> np.uint64(55)).astype(np.int64), minlength=rows)


def signatures(key: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x 7 signature longs, rows x 2 hashes of the set)."""
    rows = len(size)
    chunks, ident = np.zeros((rows, CHUNKS), np.uint64), np.zeros((rows, 2), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        begin = (np.cumsum(size) - size)[some]
        x = key & np.uint64((1 << 55) - 1)
        for i in range(CHUNKS * SYMBOLS):
            low = np.minimum.reduceat((x ^ ODD[i + 10]) * ODD[i + 50], begin)
            chunks[some, i // SYMBOLS] |= (mix(low) >> np.uint64(64 - BITS)) << np.uint64(BITS * (i % SYMBOLS))
        for i in (0, 1):
            ident[some, i] = np.add.reduceat(mix(x * ODD[90 + i]), begin)
    return chunks, ident


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x, n, c1, c2, s0..s6) for each row: the text's hash, set size, hash of the set, signature."""
    names = ["doc_id", "x", "n", "c1", "c2", *CHUNK_NAMES]

    def run(batches):
        roller = Roller()
        for batch in batches:
            got = [signatures(k, n) + (n,) for _, _, d, o in blobs(batch.column(2)) for k, n in [shingle_sets(d, o, roller)]]
            if got:
                s, c, n = (np.concatenate(x) for x in zip(*got, strict=True))
                parts = [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (*c.T, *s.T))]
                yield pa.RecordBatch.from_arrays(parts, names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("x"), F.col(text).alias("t")).mapInArrow(run, ", ".join(f"{x} long" for x in names))


def sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x): each row's distinct shingle hashes, sorted, as bytes."""

    def run(batches):
        roller = Roller()
        for batch in batches:
            for lo, hi, d, o in blobs(batch.column(1)):
                k, n = shingle_sets(d, o, roller)
                x, at = (k & np.uint64((1 << 55) - 1)), np.concatenate(([0], np.cumsum(n)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["id", "x"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id long, x binary")


def keys(reps: DataFrame) -> DataFrame:
    """(key, rep): for each chunk, its symbols without one, for each choice of that one."""
    masks = [~(((1 << BITS) - 1) << (BITS * j)) & ((1 << 64) - 1) for j in range(SYMBOLS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    made = [F.xxhash64(F.lit(i * SYMBOLS + j), F.col(s).bitwiseAND(F.lit(m))) for i, s in enumerate(CHUNK_NAMES) for j, m in enumerate(signed)]
    return reps.select(F.explode(F.array(*made)).alias("key"), "rep")


def confirm(pairs: DataFrame, docs: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """The pairs (a < b) whose full sets satisfy 100 * intersection >= percent * union. The member's set travels to the hub's: a hub of many members is a large, splittable partition."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    have = scratch.save(sets(docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")))
    both = pairs.join(have.select(F.col("id").alias("b"), F.col("x").alias("xb")), "b").join(have.select(F.col("id").alias("a"), F.col("x").alias("xa")), "a")

    def run(batches):
        for batch in batches:
            a, b, xb, xa = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "xb", "xa"))
            ok = pa.array([linked(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64), percent) for p, q in zip(xa, xb, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], ["a", "b"])

    out = scratch.save(both.select("a", "b", "xb", "xa").mapInArrow(run, "a long, b long").distinct())
    scratch.drop(have)
    return out


def rest(multi: DataFrame, reps: DataFrame, labels: DataFrame, percent: int, leaders: bool) -> DataFrame:
    """Edges (a, b) among members of buckets that hold several components.

    ``leaders``: of members alike within TIGHT symbols, the links to their first. Otherwise a forest that spans all pairs of different components whose sizes allow a link: as many edges as members at most, however many such pairs there are. A bucket's members of its smallest member's component are dealt over blocks and the others go to each, as only pairs with one of the others are looked for."""
    named = multi.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("label", F.coalesce("component", "rep"))
    kept = named.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count("*").alias("size"), F.min(F.struct("rep", "label")).alias("hub")).where("l <> m").select("key", "size", F.col("hub.label").alias("main"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = named.join(kept, "key").withColumn("block", F.explode(F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("rep"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1))))
    wide = dealt.select("key", "block", "rep", "label", (F.col("label") == F.col("main")).alias("of_main")).join(reps, "rep")

    def run(t):
        t = t.sort_by("rep")
        rep, label, n, main = (t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("rep", "label", "n", "of_main"))
        s = np.stack([t.column(c).combine_chunks().to_numpy() for c in CHUNK_NAMES], 1).view(np.uint16).reshape(len(rep), CHUNKS * SYMBOLS)
        tree = np.arange(len(rep))
        done = np.zeros(len(rep), bool)
        for i in np.arange(len(rep)) if leaders else np.flatnonzero(~main):
            if leaders and done[i]:
                continue
            at = alike(n, label, i, n, label, percent)
            if leaders:
                at = at[(s[at] != s[i]).sum(1) <= TIGHT]
                at = at[~done[at] & (at > i)]
                done[at] = True
                tree[at] = i
            elif len(at):
                roots = np.unique(np.append(tree[at], tree[i]))
                tree[np.isin(tree, roots)] = roots[0]
        b = np.flatnonzero(tree != np.arange(len(rep)))
        return pa.table({"a": rep[tree[b]], "b": rep[b]})

    return wide.groupBy("key", "block").applyInArrow(run, "a long, b long").distinct()


def alike(n, label, i, sizes, labels, percent: int) -> np.ndarray:
    """The others of another component that may link with document ``i`` by size."""
    return np.flatnonzero((labels != label[i]) & (100 * np.minimum(sizes, n[i]) >= percent * np.maximum(sizes, n[i])))


def meeting(s: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the other signatures share a key with ``s``: a chunk agrees but for ERRORS symbols."""
    return ((others != s).reshape(-1, CHUNKS, SYMBOLS).sum(2) <= ERRORS).any(1)


def confirm_clusters(forest: DataFrame, reps: DataFrame, labels: DataFrame, docs: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links (a, b) among the clusters that a forest spans, enough of them to join all that full sets join.

    Each member's set goes to its cluster's tasks: those outside the cluster's largest component, in blocks, against all members, in blocks. A task compares full sets where the two share a key, sizes allow a link and they are not joined yet, and returns only links that join components."""
    cluster = components(forest, scratch).withColumnsRenamed({"id": "rep", "component": "cluster"})
    member = scratch.save(cluster.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component"))
    parts = member.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    plan = parts.groupBy("cluster").agg(F.sum("k").alias("all"), F.max(F.struct("k", "label")).alias("m")).where("all > m.k")
    ceil = lambda c: F.ceil(c / ROWS).cast("int")
    # written, so that its size is known: it is broadcast if it is small, else a large cluster's rows are split
    plan = scratch.save(plan.select("cluster", F.col("m.label").alias("main"), ceil(F.col("all") - F.col("m.k")).alias("gi"), ceil(F.col("all")).alias("gj")))
    named = member.join(plan, "cluster")
    own = lambda g, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(g)).cast("int")
    rows = named.where("label <> main").select("cluster", "rep", "label", own("gi", 1).alias("i"), F.explode(F.sequence(F.lit(0), F.col("gj") - 1)).alias("j"), F.lit(True).alias("row"))
    columns = named.select("cluster", "rep", "label", F.explode(F.sequence(F.lit(0), F.col("gi") - 1)).alias("i"), own("gj", 2).alias("j"), F.lit(False).alias("row"))
    ids = member.select(F.col("rep").alias("doc_id"))
    have = scratch.save(sets(docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")).withColumnRenamed("id", "rep"))
    wide = rows.unionByName(columns).join(reps, "rep").join(have, "rep")

    def run(t):
        t = t.sort_by([("rep", "ascending")])
        rep, label, n, is_row = (t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("rep", "label", "n", "row"))
        s = np.stack([t.column(c).combine_chunks().to_numpy() for c in CHUNK_NAMES], 1).view(np.uint16).reshape(len(rep), CHUNKS * SYMBOLS)
        x = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("x").combine_chunks()]
        column = np.flatnonzero(~is_row)
        sc, nc, now = s[column], n[column], label.copy()
        out = []
        for i in np.flatnonzero(is_row):
            at = alike(n, now, i, nc, now[column], percent)
            for j in column[at[meeting(s[i], sc[at])]]:
                if now[i] != now[j] and linked(x[i], x[j], percent):
                    out.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                    now[now == max(now[i], now[j])] = min(now[i], now[j])
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    out = scratch.save(wide.groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long").where("a < b").distinct())
    scratch.drop(have)
    return out


def linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets satisfy 100 * intersection >= percent * union, and share something."""
    if len(p) > len(q):
        p, q = q, p
    common = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(p) else 0
    return common > 0 and 100 * common >= percent * (len(p) + len(q) - common)


def link(docs: DataFrame, scratch: Scratch, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: documents linked where 100 * intersection >= percent * union of their sets of 5-word shingles.

    Texts null, empty or of white space have empty sets and link with nothing; under 5 words the whole sequence is the one shingle. Rows of equal sets are one class, its smallest doc_id standing for it. Rows that repeat a doc_id with its text share its component, with other texts they have their own texts' components; a null doc_id links with nothing, has a null component and is kept.

    A pair that shares a key is compared, however far its signatures are, if sizes allow a link. A pair at the similarity bound shares one with probability 1 - 9e-5 (each chunk of 4 symbols has at most one wrong with 0.738; 7 chunks), a pair at 0.8 with 1 - 6e-6; all pairs of at most 13 different symbols do. Links are confirmed on full sets: first each member of a bucket with its smallest, which joins groups of copies without pairs of members; then, in buckets that still hold several components, tight neighbours; then what is left in different components, in tasks that hold the full sets and return only links that join."""
    return decided(docs, scratch, percent, key, text).drop("x")


def decided(docs: DataFrame, scratch: Scratch, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``link``'s rows with ``x``, the hash of the row's text."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    base = scratch.save(sketch(docs))
    reps = base.where("n > 0 and doc_id is not null").groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"), *[F.first(s).alias(s) for s in CHUNK_NAMES])
    classes = scratch.save(reps)
    reps = classes.select("rep", "n", *CHUNK_NAMES)
    all_keys = keys(reps)
    hubs = all_keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).where("members > 1")
    multi = scratch.save(all_keys.join(hubs, "key").select("key", "rep", "hub"))
    star = multi.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    p, q = (reps.select(F.col("n").alias(x), F.col("rep").alias(k)) for x, k in (("p", "a"), ("q", "b")))
    star = star.join(q, "b").join(p, "a").where(100 * F.least("p", "q") >= percent * F.greatest("p", "q")).select("a", "b")
    tested = scratch.save(star)
    good = confirm(tested, docs, scratch, percent)
    labels = components(good, scratch)
    labels = scratch.save(labels)
    for leaders in (True, False):
        more = rest(multi.select("key", "rep"), reps, labels, percent, leaders)
        more = scratch.save(more.join(tested, ["a", "b"], "left_anti") if leaders else more)
        if more.isEmpty():
            continue
        got = confirm(more, docs, scratch, percent) if leaders else confirm_clusters(more, reps, labels, docs, scratch, percent)
        if not got.isEmpty():
            good = good.unionAll(got)
            labels = scratch.save(components(good, scratch))
    named = classes.select("n", "c1", "c2", "rep").join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").select("n", "c1", "c2", F.coalesce("component", "rep").alias("component"))
    out = base.select("doc_id", "x", "n", "c1", "c2").join(named, ["n", "c1", "c2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "x", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows, with all their columns, of one document of each group: that of the smallest doc_id. Each row is decided by its own text, so a doc_id that is taken twice loses only what is a copy; a row repeated with its doc_id and text stays once."""
    found = scratch.save(decided(docs, scratch))
    same = lambda d: (docs["doc_id"] == d["_d"]) & (F.xxhash64(docs["text"]) == d["_x"])
    lost = found.where("not kept").select(F.col("doc_id").alias("_d"), F.col("x").alias("_x")).distinct()
    kept = docs.join(lost, same(lost), "left_anti")
    twice = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_d"), F.col("x").alias("_x")).count().where("count > 1").drop("count")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, same(twice), "left_anti").unionAll(again)


def query(spark, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark))


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end) sh from w),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on e.a = r.b)
select d.doc_id, coalesce(n.n, 0) n_shingles, m.c component_id, d.doc_id = m.c kept
from documents d left join n using (doc_id) join (select a, min(b) c from r group by a) m on m.a = d.doc_id
"""
