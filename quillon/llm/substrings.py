"""Exact removal of long repeated byte strings, by suffix arrays of shards.

A window is a string of ``length`` bytes. Its anchor is the K-byte gram of least hash in it (the last of equal
ones), which depends on the window's bytes alone: equal windows have equal anchors at equal places. Consecutive
windows of one anchor occurrence form a context, the bytes that they cover. So windows need comparing only among
the contexts of one anchor:

* an anchor that occurs once repeats nothing; one whose contexts are all equal, by 128 bits of hash, repeats them
  whole: a suffix array of that one string, counted n times, would say the same, so no text of it moves;
* the other anchors' distinct contexts are dealt over shards, each of which sorts its suffixes by Larsson-Sadakane
  refinement, finds common prefixes by Kasai's method, and so the windows that occur twice;
* where only the first document of a string keeps it, contexts of later documents go whole, and of a context's
  first document the windows that an earlier document has;
* an anchor's contexts are dealt over shards by PART, so one of many contexts lies in several. Of such an anchor
  each shard hands on the sorted fingerprints of its windows by range; the ranges of all shards are merged by binary
  search, and each shard looks its windows up in what the merge found."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Roller, Scratch, blobs

LENGTH, K = 400, 32
SHARD = 900_000  # bytes of contexts in a shard
PART = 1200  # different contexts of an anchor that one shard takes
SLICE = 4 << 20
LOW = np.uint64((1 << 24) - 1)


# --- anchors -------------------------------------------------------------------------------------


def anchors(data: np.ndarray, off: np.ndarray, roller: Roller, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """(row, h, c, d, s, e) of each context: its anchor's hash, two hashes of its bytes, its first and last window start in the row."""
    if len(data) > 2 * SLICE and len(off) == 2:  # slices of one long row overlap by length - 1 bytes
        parts = []
        for lo in range(0, len(data) - length + 1, SLICE):
            row, h, c, d, s, e = anchors(data[lo : lo + SLICE + length - 1], np.array([0, min(SLICE + length - 1, len(data) - lo)]), roller, length, k)
            parts.append((row, h, c, d, s + lo, e + lo))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none, none
    g = roller.windows(roller.prefix(data), k)
    v = (g & ~LOW) | (LOW - np.arange(len(g), dtype=np.uint64))
    w = length - k + 1
    v = np.concatenate([v, np.full(-len(v) % w, ~np.uint64(0))]).reshape(-1, w)
    left, right = np.minimum.accumulate(v, 1).ravel(), np.minimum.accumulate(v[:, ::-1], 1)[:, ::-1].ravel()
    at = (LOW - (np.minimum(right[:n], left[w - 1 : w - 1 + n]) & LOW)).astype(np.int64)
    bad = np.zeros(len(data) + 1, np.int32)  # starts of windows that leave their row
    np.add.at(bad, np.maximum(off[1:] - length + 1, 0), 1)
    np.add.at(bad, off[1:], -1)
    ok = np.cumsum(bad[:n]) == 0
    cut = np.empty(n, bool)
    cut[0] = True
    cut[1:] = (at[1:] != at[:-1]) | ~ok[:-1] | ~ok[1:]
    s = np.flatnonzero(cut)
    e = np.append(s[1:], n) - 1
    s, e = s[ok[s]], e[ok[s]]
    mv = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_128_digest
    both = b"".join([digest(mv[a:b]) for a, b in zip(s.tolist(), (e + length).tolist(), strict=True)])
    c, d = np.frombuffer(both, np.int64).reshape(-1, 2).T
    row = np.searchsorted(off, s, "right") - 1
    return row, g[at[s]].view(np.int64), c, d, s - off[row], e - off[row]


# --- suffix arrays -------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each): groups of equal prefixes are refined by the ranks that stand h further on, h doubling, sorted groups left alone."""
    n = len(text)
    bits = max(1, (n + 1).bit_length())
    place = np.arange(n, dtype=np.uint64)
    depth = 5 if bits <= 21 else 4  # bytes, and 3 bits that tell the text's end from a zero byte
    low = 64 - 8 * depth - 3
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    for i in range(depth):
        key = (key << np.uint64(8)) | padded[i : i + n]
    key = (key << np.uint64(3)) | np.minimum(np.uint64(n) - place, np.uint64(depth))
    packed = np.sort((key << np.uint64(low)) | place)
    sa = (packed & np.uint64((1 << low) - 1)).astype(np.int64)
    value = packed >> np.uint64(low)
    new = np.concatenate(([True], value[1:] != value[:-1])) if n else np.zeros(0, bool)
    where = np.arange(n)
    head = np.maximum.accumulate(np.where(new, where, 0)) if n else where
    rank = np.empty(n, np.int64)
    rank[sa] = head
    active = np.flatnonzero(~(new & np.append(new[1:], True)))
    h = depth
    while len(active):
        p = sa[active]
        q = p + h
        after = np.where(q < n, rank[np.minimum(q, n - 1)] + 1, 0)
        group = rank[p]
        if 3 * bits <= 64:
            packed = np.sort((group.astype(np.uint64) << np.uint64(2 * bits)) | (after.astype(np.uint64) << np.uint64(bits)) | p.astype(np.uint64))
            p, value = (packed & np.uint64((1 << bits) - 1)).astype(np.int64), packed >> np.uint64(bits)
        else:
            order = np.lexsort((after, group))
            p, value = p[order], (group[order] << 32) | after[order]
        new = np.concatenate(([True], value[1:] != value[:-1]))
        sa[active] = p
        rank[p] = np.maximum.accumulate(np.where(new, active, 0))
        active = active[~(new & np.append(new[1:], True))]
        h *= 2
    rank[sa] = where
    return sa, rank


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """For each rank, the common prefix with the suffix before it, ``most`` at most. Kasai's rule (a suffix one further on keeps all but one byte) runs along all contexts side by side."""
    n = len(text)
    pad = np.concatenate([text, np.zeros(most + 16, np.uint8)]).astype(np.uint64)
    word = pad[: n + most + 8]
    for i in range(1, 8):
        word = (word << np.uint64(8)) | pad[i : i + n + most + 8]
    out = np.zeros(n, np.int32)
    length = np.zeros(len(begin), np.int64)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    for t in range(int(size.max()) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, "left"))
        p = begin[:live] + t
        r = rank[p]
        q = sa[np.maximum(r - 1, 0)]
        now = np.maximum(length[:live] - 1, 0)
        now[r == 0] = 0
        go = np.flatnonzero((now < most) & (r > 0))
        while len(go):
            x = word[p[go] + now[go]] ^ word[q[go] + now[go]]
            same = x == 0
            left = go[~same]
            if len(left):  # the first different byte
                y, add = x[~same], np.zeros(len(left), np.int64)
                for shift in (32, 16, 8):
                    zero = (y >> np.uint64(64 - shift)) == 0
                    add += np.where(zero, shift // 8, 0)
                    y = np.where(zero, y << np.uint64(shift), y)
                now[left] += add
            go = go[same]
            now[go] += 8
            go = go[now[go] < most]
        now = np.minimum(now, most)
        out[r] = now
        length[:live] = now
    return out


def repeated_windows(texts: list[bytes], weights: np.ndarray, length: int = LENGTH, owners: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, flags): flags over all bytes mark each window start whose string starts elsewhere too; a text of weight 2 is itself two occurrences. With ``owners``, a number for each text, those whose string starts in a text of a smaller one."""
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    text = np.frombuffer(b"".join(texts), np.uint8)
    sa, rank = suffix_array(text)
    lcp = common_prefixes(text, sa, rank, begin, size, length)
    owner = np.repeat(np.arange(len(texts)), size)
    inside = np.arange(len(text)) - begin[owner] <= size[owner] - length
    group = np.cumsum(lcp < length)
    mine = inside[sa]
    flags = np.zeros(len(text), bool)
    if owners is None:
        total = np.bincount(group[mine], weights=weights[owner[sa[mine]]], minlength=group[-1] + 1 if len(group) else 1)
        flags[sa] = mine & (total[group] >= 2)
    elif len(text):
        least, own = np.full(group[-1] + 1, len(owners)), owners[owner[sa]]
        np.minimum.at(least, group[mine], own[mine])
        flags[sa] = mine & (own > least[group])
    return text, begin, flags


RUNS = "h long, c long, d long, f int, l int"
SHARDS = RUNS + ", sub int, range int, prints binary"


def _runs(h: np.ndarray, c: np.ndarray, d: np.ndarray, begin: np.ndarray, flags: np.ndarray) -> dict[str, np.ndarray]:
    """First and last flagged start of each run, in its context."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    # a context's last length - 1 bytes are never flagged, so runs stay in theirs
    i = np.searchsorted(begin, a, "right") - 1
    return {"h": h[i], "c": c[i], "d": d[i], "f": (a - begin[i]).astype(np.int32), "l": (b - begin[i]).astype(np.int32)}


def _shard(length: int, first: bool):
    """A task's function: the runs of a shard's repeated windows and, for each part of an anchor that lies in several
    shards, its windows' sorted fingerprints by range (``range`` 0 and on), each with the first document that holds
    it, and all of them in order (``range`` -1)."""

    def run(t: pa.Table) -> pa.Table:
        h, c, d, n, sub, subs, ids, ts = (t.column(x).combine_chunks().to_numpy() for x in ("h", "c", "d", "n", "sub", "subs", "id", "t"))
        texts = [v.as_buffer().to_pybytes() for v in t.column("x").combine_chunks()]
        place = np.empty(len(texts), np.int64)
        order = np.lexsort((ts, ids))
        place[order] = np.cumsum(np.concatenate(([False], (np.diff(ids[order]) != 0) | (np.diff(ts[order]) != 0))))
        text, begin, flags = repeated_windows(texts, n, length, place if first else None)
        runs = pa.table(_runs(h, c, d, begin, flags))
        size = np.array([len(v) for v in texts], np.int64)
        rows, roller = [], Roller()
        for key in sorted({(int(h[i]), int(sub[i]), int(subs[i])) for i in np.flatnonzero(subs > 1)}):
            own = np.flatnonzero((h == key[0]) & (sub == key[1]))
            own = own[np.argsort(place[own], kind="stable")]
            prints = [roller.windows(roller.prefix(text[begin[i] : begin[i] + size[i]]), length) for i in own]
            held = np.concatenate([[len(own)], c[own], d[own], [len(p) for p in prints]]).astype(np.int64)
            rows.append((key[0], key[1], -1, held.tobytes() + np.concatenate(prints).tobytes()))
            each, at = np.unique(np.concatenate(prints), return_index=True)  # of equal ones the first document's
            doc = own[np.repeat(np.arange(len(own)), [len(p) for p in prints])[at]]
            cuts = np.searchsorted((each // np.uint64((1 << 64) // key[2] + 1)).astype(np.int64), np.arange(key[2] + 1))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    rows.append((key[0], key[1], i, each[a:b].tobytes() + ids[doc[a:b]].tobytes() + ts[doc[a:b]].tobytes()))
        kinds = {"h": pa.int64(), "sub": pa.int32(), "range": pa.int32(), "prints": pa.binary()}
        handed = pa.table({k: pa.array([r[i] for r in rows], kind) for i, (k, kind) in enumerate(kinds.items())})
        out = pa.concat_tables([runs, handed], promote_options="default")
        return out.select(["h", "c", "d", "f", "l", "sub", "range", "prints"])

    return run


def _merge(first: bool):
    """A task's function: of each shard's run, the fingerprints that another shard's run holds too, or those that
    another holds for an earlier document, by binary search in all runs' merged order."""

    def run(t: pa.Table) -> pa.Table:
        runs = [np.frombuffer(x.as_buffer(), np.int64).reshape(3, -1) for x in t.column("prints").combine_chunks()]
        prints, ids, ts = np.concatenate(runs, axis=1)
        prints = prints.view(np.uint64)
        order = np.lexsort((ts, ids, prints))
        merged = prints[order]
        head = order[np.searchsorted(merged, prints, "left")]
        if first:
            cut = (ids != ids[head]) | (ts != ts[head])
        else:
            cut = np.searchsorted(merged, prints, "right") - np.searchsorted(merged, prints, "left") > 1
        at = np.cumsum([0, *(r.shape[1] for r in runs)])
        out = [prints[a:b][cut[a:b]].tobytes() for a, b in zip(at, at[1:], strict=False)]
        return pa.table({"h": t.column("h"), "sub": t.column("sub"), "prints": pa.array(out, pa.binary())})

    return run


def _look_up(length: int):
    """A task's function: the runs of a part's windows that the merge found in another part."""

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        parts = [_runs(none, none, none, none, np.zeros(0, bool))]
        if own.num_rows and found.num_rows:
            known = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in found.column("prints").combine_chunks()]))
            for h, raw in zip(own.column("h").to_pylist(), own.column("prints").combine_chunks(), strict=True):
                held = np.frombuffer(raw.as_buffer(), np.int64)
                m = int(held[0])
                c, d, size = held[1 : m + 1], held[m + 1 : 2 * m + 1], held[2 * m + 1 : 3 * m + 1]
                prints = held[3 * m + 1 :].view(np.uint64)
                # one place between contexts that is never flagged, so that runs end there
                begin = np.cumsum(size + 1) - size - 1
                flags = np.zeros(int(size.sum()) + m, bool)
                at = np.arange(len(prints)) + np.repeat(np.arange(m), size)
                flags[at] = known[np.minimum(np.searchsorted(known, prints), len(known) - 1)] == prints
                parts.append(_runs(np.full(m, h), c, d, begin, flags))
        return pa.table({k: np.concatenate([p[k] for p in parts]) for k in parts[0]})

    return run


# --- the operator --------------------------------------------------------------------------------


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id and t name a document: its key and its text's hash."""
    x = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(x).alias("t"), x.alias("x"))


def find_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, first: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t, spans): byte ranges [from, to) of documents that are covered by repeated windows of ``length`` bytes, not yet merged; documents without any are left out. Rows that repeat a document are occurrences of their own.

    ``first``: only windows that start in an earlier document too, in the order of keys (null first) and then text hashes; rows of one key and text are one document then."""
    x = keyed(docs, key, text)
    names = ["id", "t", "h", "c", "d", "s", "e"]

    def scan(batches):
        roller = Roller()
        for batch in batches:
            for lo, hi, data, off in blobs(batch.column(2)):
                row, h, c, d, s, e = anchors(data, off, roller, length)
                ids, ts = (batch.column(i).slice(lo, hi - lo).take(pa.array(row)) for i in (0, 1))
                rest = [pa.array(np.ascontiguousarray(v)) for v in (h, c, d)] + [pa.array(v.astype(np.int32)) for v in (s, e)]
                yield pa.RecordBatch.from_arrays([ids, ts, *rest], names)

    seen = scratch.save(x.where(F.octet_length("x") >= length).mapInArrow(scan, "id long, t long, h long, c long, d long, s int, e int"))
    lows = [f(v).alias(f"{n}{v}") for v in "cd" for n, f in (("lo", F.min), ("hi", F.max))]
    kinds = seen.groupBy("h").agg(F.count("*").alias("n"), *lows).where("n > 1").select("h", F.expr("loc <> hic or lod <> hid").alias("mixed"))
    # a table of its own: the join's two sides are then plain exchanges, and Spark splits a frequent anchor's rows
    twice = scratch.save(seen.join(scratch.save(kinds), "h"))
    scratch.drop(seen)
    mixed = twice.where("mixed")
    each = (twice if first else mixed).groupBy("h", "c", "d", "mixed").agg(F.count("*").alias("n"), F.min(F.struct("id", "t", "s", "e")).alias("one"))
    contexts = scratch.save(each)
    if first:
        of = contexts.select("h", "c", "d", F.col("one.id").alias("id1"), F.col("one.t").alias("t1"))
        twice = scratch.save(twice.join(of, ["h", "c", "d"]).withColumn("own", F.expr("id = id1 and t = t1")).drop("id1", "t1"))
        mixed, contexts = twice.where("mixed and own"), contexts.where("mixed")
    counts = scratch.save(contexts.groupBy("h").agg(F.count("*").alias("m"), F.sum(F.col("one.e") - F.col("one.s") + length).alias("bytes")))
    total = counts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD))
    parts = counts.select("h", F.ceil(F.col("m") / PART).cast("int").alias("subs"))
    dealt = contexts.join(parts, "h").withColumn("sub", F.pmod("c", "subs").cast("int"))
    one = F.struct("h", "c", "d", "n", "sub", "subs", "one.s", "one.e").alias("w")
    want = dealt.select("one.id", "one.t", one).groupBy("id", "t").agg(F.collect_list("w").alias("w"))
    fields = {"h": pa.int64(), "c": pa.int64(), "d": pa.int64(), "n": pa.int64(), "sub": pa.int32(), "subs": pa.int32()}

    def cut(batches):
        def packed(rows):
            arrays = [pa.array([w[k] for w, *_ in rows], kind) for k, kind in fields.items()]
            rest = [pa.array([r[i] for r in rows], kind) for i, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.binary()))]
            return pa.RecordBatch.from_arrays([*arrays, *rest], [*fields, "id", "t", "x"])

        for batch in batches:
            rows = []
            ids, ts = (batch.column(i).to_pylist() for i in (2, 3))
            for x, w, i, t in zip(batch.column(1).cast(pa.binary()), batch.column(0), ids, ts, strict=True):
                x = x.as_buffer().to_pybytes()
                for one in w.as_py():
                    rows.append((one, i, t, x[one["s"] : one["e"] + length]))
                    if len(rows) > 4000:
                        yield packed(rows)
                        rows = []
            yield packed(rows)

    schema = "h long, c long, d long, n long, sub int, subs int, id long, t long, x binary"
    got = x.join(want.hint("shuffle_hash"), ["id", "t"]).select("w", "x", "id", "t").mapInArrow(cut, schema)
    # a repeated row of a document brings its contexts again: the shard takes each once
    shard = F.pmod(F.xxhash64("h", "sub"), F.lit(shards)).alias("shard")
    found = scratch.save(got.groupBy(shard).applyInArrow(_once(_shard(length, first)), SHARDS))
    handed = found.where("range is not null").select("h", "sub", "range", "prints")
    merged = handed.where("range >= 0").groupBy("h", "range").applyInArrow(_merge(first), "h long, sub int, prints binary").where("octet_length(prints) > 0")
    later = handed.where("range < 0").groupBy("h", "sub").cogroup(merged.groupBy("h", "sub")).applyInArrow(_look_up(length), RUNS)
    runs = found.where("range is null").select("h", "c", "d", "f", "l").unionAll(scratch.save(later))
    end = F.col("s") + F.col("l") + length
    spans = mixed.join(runs, ["h", "c", "d"]).select("id", "t", (F.col("s") + F.col("f")).alias("s"), end.alias("e"))
    whole = twice.where("not own" if first else "not mixed").select("id", "t", "s", (F.col("e") + length).alias("e"))
    spans = spans.unionAll(whole)
    return spans.groupBy("id", "t").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def _once(run):
    def first(t: pa.Table) -> pa.Table:
        names = np.stack([t.column(x).combine_chunks().to_numpy() for x in "hcd"])
        _, at = np.unique(names, axis=1, return_index=True)
        return run(t.take(pa.array(np.sort(at))).combine_chunks())

    return first


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def with_spans(docs: DataFrame, scratch: Scratch, length: int, first: bool, key: str, text: str, rest: list[Column]) -> DataFrame:
    found = find_repeats(docs, scratch, length, first, key, text).hint("shuffle_hash")
    x = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(x).alias("t"), *rest)
    return named.join(found, ["id", "t"], "left").drop("id", "t")


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row: what is left of its UTF-8 bytes when each byte is removed that lies in a string of ``length`` bytes which also starts anywhere else.

    Null counts as empty; shorter texts are kept whole. Rows that repeat a text remove each other wholly, whatever their keys; repeated rows give repeated results."""

    def run(batches):
        for batch in batches:
            n, gone, spans, sha = [], [], [], []
            for x, w in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                x, w = memoryview(x.as_buffer()), _merged(w.as_py() or [])
                digest, at = hashlib.sha256(), 0
                for s, e in w:
                    digest.update(x[at:s])
                    at = e
                digest.update(x[at:])
                n.append(len(x)), gone.append(sum(e - s for s, e in w)), spans.append(len(w)), sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    rest = [F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("x")]
    return with_spans(docs, scratch, length, False, key, text, rest).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, first: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with all their columns, repeated bytes cut out of the text; what a cut leaves of a character goes too. A row whose text is cut to nothing goes; one that had none stays.

    ``first``: each string stays in the first document that holds it (in the order of keys, null first), where it may repeat, and is cut out of later ones."""
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts, keep = [], []
            for x, w in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                w = _merged(w.as_py() or [])
                if w:
                    raw, out, last = x.as_buffer().to_pybytes(), [], 0
                    for s, e in w:
                        out.append(raw[last:s])
                        last = e
                    x = b"".join([*out, raw[last:]]).decode(errors="ignore")
                    texts.append(x)
                    keep.append(bool(x))
                else:
                    texts.append(x.as_py())
                    keep.append(True)
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names).filter(pa.array(keep))

    # positions, not names: a column may have any name
    rest = [F.col(c).alias(f"col_{i}") for i, c in enumerate(docs.columns)]
    return with_spans(docs, scratch, length, first, key, text, rest).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark))
