"""Benchmark decontamination: q-gram lemma filtering in overlapping diagonal bands, then banded alignment."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, blobs, mix

Q = 12  # bytes of a q-gram
RATE = 0.07  # edits for each byte of a segment
SEGMENT, STRIDE = 96, 48  # long items are looked for by overlapping segments
BLOCK = 4 << 20  # bytes of benchmark text that one pass over the documents carries
SLICE = 4 << 20  # bytes of a long row that are searched at once
GAP = 64  # places of a q-gram no further apart than this count as one run
MOST = 2_000_000  # hits counted at once
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32
HITS = "doc_id {}, item_id long, start long, end long, distance int"


def fold(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of rows, place of each byte in ``data``): lower-cased, runs of white space made one blank."""
    low = FOLD[data]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    keep[off[:-1][off[:-1] < len(low)]] = True
    at = np.flatnonzero(keep)
    return low[at], np.searchsorted(at, off), at


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit key of each ``Q`` bytes: two overlapping 8-byte words, mixed."""
    x = data.astype(np.uint64)
    for n in (1, 2, 4):
        x = (x[:-n] << np.uint64(8 * n)) | x[n:] if len(x) > n else x[:0]
    over = Q - 8
    return mix(x[:-over] * np.uint64(0x9E3779B97F4A7C15) ^ x[over:]) if len(x) > over else x[:0]


@dataclass
class Index:
    """Segments (texts, edit budget, least count, item) and their q-grams: ``known`` keys in order, and for each entry
    (key's number << 32 | segment) its first and last place in the segment and how often it is there; ``hot`` marks
    which low bits of a key occur."""

    items: np.ndarray
    texts: list[np.ndarray]
    budget: np.ndarray
    least: np.ndarray
    known: np.ndarray
    entry: np.ndarray
    first: np.ndarray
    last: np.ndarray
    times: np.ndarray
    hot: np.ndarray


def index(items: list[tuple[int, bytes]], rate: float = RATE) -> Index:
    """Items under ``Q`` bytes are no evidence and match nothing. The budget of m bytes is rate * m edits, less where the lemma's count m + 1 - (k + 1) * Q would not reach 1."""
    owner, texts = [], []
    for item, text in items:
        data = fold(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        starts = [0] if len(data) < SEGMENT + STRIDE else [*range(0, len(data) - SEGMENT, STRIDE), len(data) - SEGMENT]
        for s in starts:
            part = data[s:] if len(starts) == 1 else data[s : s + SEGMENT]
            if len(part) >= Q:
                owner.append(item)
                texts.append(part)
    m = np.array([len(t) for t in texts], int)
    k = np.minimum((rate * m).astype(int), m // Q - 1) if len(m) else m
    g = [grams(t) for t in texts]
    known, number = np.unique(np.concatenate(g) if g else np.zeros(0, np.uint64), return_inverse=True)
    seg = np.repeat(np.arange(len(texts)), [len(x) for x in g]) if g else np.zeros(0, int)
    at = np.concatenate([np.arange(len(x), dtype=np.int32) for x in g]) if g else np.zeros(0, np.int32)
    name = (number.astype(np.int64) << 32) | seg
    order = np.argsort(name, kind="stable")
    entry, first, times = np.unique(name[order], return_index=True, return_counts=True)
    hot = np.zeros(1 << 22, bool)
    hot[(known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    places = at[order]
    return Index(np.array(owner, np.int64), texts, k, m + 1 - (k + 1) * Q, known, entry, places[first], places[first + times - 1] if len(first) else places, times.astype(np.int32), hot)


def banded(pattern: np.ndarray, width: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edit distance of each row of ``pattern`` (its first ``width`` bytes) to a substring of the same row of ``texts``, in a diagonal band: column j of DP row i stands for text[i + j]."""
    n, m = pattern.shape
    w = texts.shape[1] - m
    ramp = np.arange(w + 1, dtype=np.int32)
    now = np.zeros((n, w + 1), np.int32)
    out = np.full(n, 1 << 20, np.int32)
    for i in range(m):
        new = now + (texts[:, i : i + w + 1] != pattern[:, i : i + 1])[:, : w + 1] if texts.shape[1] >= i + w + 1 else now
        new[:, :-1] = np.minimum(new[:, :-1], now[:, 1:] + 1)
        new = np.minimum.accumulate(new - ramp, axis=1) + ramp
        now = new
        done = width == i + 1
        if done.any():
            out[done] = now[done].min(1)
    return out


def candidates(ix: Index, row: np.ndarray, gram: np.ndarray, x0: np.ndarray, x1: np.ndarray, lo: int, hi: int):
    """Arrays (row, segment, band) with the lemma's count, of segments lo to hi - 1. A run of a q-gram's places x0 to x1
    in a row may give any of its diagonals the q-gram's count in the segment: an upper bound, so nothing is lost, and
    repetitive texts cost a row for each band, not one for each pair of places. Too many at once are halved."""
    a, b = (np.searchsorted(ix.entry, (gram << 32) | s) for s in (lo, hi))
    n = b - a
    some = n > 0
    row, gram, x0, x1, a, n = row[some], gram[some], x0[some], x1[some], a[some], n[some]
    total = int(n.sum())
    if not total:
        return
    wide = total > MOST
    if not wide:
        which = np.repeat(np.arange(len(n)), n)
        entry = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(total)
        seg = ix.entry[entry] & ((1 << 32) - 1)
        step = ix.budget[seg] + 1
        # diagonals are shifted to stay positive; band b holds 2 * step of them from b * step on
        low = (x0[which] - ix.last[entry] + (1 << 20)) // step - 1
        bands = (x1[which] - ix.first[entry] + (1 << 20)) // step - low + 1
        wide = int(bands.sum()) > 4 * MOST
    if wide and hi - lo > 1:
        mid = (lo + hi) // 2
        for part in ((lo, mid), (mid, hi)):
            yield from candidates(ix, row, gram, x0, x1, *part)
        return
    if wide and row[0] != row[-1]:
        rows = np.unique(row)
        for mine in (row < rows[len(rows) // 2], row >= rows[len(rows) // 2]):
            yield from candidates(ix, row[mine], gram[mine], x0[mine], x1[mine], lo, hi)
        return
    if total > MOST:
        which, entry = np.arange(len(n)), a  # one segment has one entry of a q-gram
        seg = np.full(len(n), lo)
        step = ix.budget[seg] + 1
        low = (x0 - ix.last[entry] + (1 << 20)) // step - 1
        bands = (x1 - ix.first[entry] + (1 << 20)) // step - low + 1
    each = np.repeat(np.arange(len(bands)), bands)
    band = np.repeat(low - (np.cumsum(bands) - bands), bands) + np.arange(len(each))
    key = (row[which][each].astype(np.int64) << 46) | (seg[each] << 26) | band
    order = np.argsort(key, kind="stable")
    key, weight = key[order], ix.times[entry][each][order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key, count = key[new], np.add.reduceat(weight, new)
    seg = (key >> 26) & ((1 << 20) - 1)
    ok = count >= ix.least[seg]
    yield key[ok] >> 46, seg[ok], key[ok] & ((1 << 26) - 1)


def search(ix: Index, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, distance) of the regions of whole rows that match a segment within its budget, spans of one item merged where they meet. A long row is searched in slices that overlap by more than a region."""
    if len(off) == 2 and len(data) > 2 * SLICE:
        found, over = [], 16 * (SEGMENT + STRIDE)
        for lo in range(0, len(data), SLICE):
            part = data[lo : lo + SLICE + over]
            found += [(0, item, a + lo, b + lo, d) for _, item, a, b, d in search(ix, part, np.array([0, len(part)]))]
        return merged(found)
    folded, off, place = fold(data, off)
    g = grams(folded)
    pos = np.flatnonzero(ix.hot[(g & np.uint64((1 << 22) - 1)).astype(np.int64)])
    if not len(pos) or not len(ix.known):
        return []
    gram = np.minimum(np.searchsorted(ix.known, g[pos]), len(ix.known) - 1)
    row = np.searchsorted(off, pos, "right") - 1
    ok = (ix.known[gram] == g[pos]) & (pos + Q <= off[row + 1])
    pos, row, gram = pos[ok], row[ok], gram[ok].astype(np.int64)
    if not len(pos):
        return []
    order = np.argsort(gram, kind="stable")
    pos, row, gram = pos[order], row[order], gram[order]
    new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (row[1:] != row[:-1]) | (pos[1:] - pos[:-1] > GAP)))
    a, b = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(pos)) - 1
    order = np.argsort(row[a], kind="stable")
    a, b = a[order], b[order]
    out = []
    for row, seg, band in candidates(ix, row[a], gram[a], pos[a] - off[row[a]], pos[b] - off[row[a]], 0, len(ix.texts)):
        for lo in range(0, len(row), 2000):
            out += confirmed(ix, folded, off, row[lo : lo + 2000], seg[lo : lo + 2000], band[lo : lo + 2000])
        out = merged(out)
    return merged([(r, item, int(place[off[r] + a]) - int(place[off[r]]), int(place[off[r] + b - 1]) - int(place[off[r]]) + 1, d) for r, item, a, b, d in out])


def confirmed(ix: Index, folded: np.ndarray, off: np.ndarray, row: np.ndarray, seg: np.ndarray, band: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The candidates that banded alignment confirms; equal regions are aligned once."""
    k, m = ix.budget[seg], np.array([len(ix.texts[i]) for i in seg])
    begin = band * (k + 1) - (1 << 20) - k  # the first diagonal, and k before it
    span = 2 * (k + 1) + 2 * k
    top, wide = m.max(), span.max()
    at = begin[:, None] + np.arange(top + wide)[None]
    size = (off[row + 1] - off[row])[:, None]
    ok = (at >= 0) & (at < size)
    part = np.where(ok, folded[np.clip(at + off[row][:, None], 0, len(folded) - 1)], 255)  # 255 is in no UTF-8 text
    named = np.ascontiguousarray(np.hstack([part.astype(np.uint8), seg.astype(np.uint32)[:, None].view(np.uint8)]))
    _, one, of = np.unique(named.view(f"V{named.shape[1]}").ravel(), return_index=True, return_inverse=True)
    pattern = np.zeros((len(one), top), np.uint8)
    for i, x in enumerate(seg[one]):
        pattern[i, : m[one[i]]] = ix.texts[x]
    d = banded(pattern, m[one], part[one])[of]
    hit = np.flatnonzero(d <= k)
    start, end = np.maximum(0, begin[hit]), np.minimum(size[hit, 0], begin[hit] + span[hit] + m[hit])
    return merged(list(zip(row[hit].tolist(), ix.items[seg[hit]].tolist(), start.tolist(), end.tolist(), d[hit].tolist(), strict=True)))


def merged(spans: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Spans of one row and item that meet, made one, with the least distance."""
    out: list[list[int]] = []
    for r, item, start, end, d in sorted(spans):
        if out and out[-1][0] == r and out[-1][1] == item and start <= out[-1][3]:
            out[-1][3], out[-1][4] = max(out[-1][3], end), min(out[-1][4], d)
        else:
            out.append([r, item, start, end, d])
    return [tuple(x) for x in out]


HELD: dict[str, Index] = {}  # of a worker: the index of the block that it works on, built once


def held(name: str, items: list[tuple[int, bytes]], rate: float) -> Index:
    if name not in HELD:
        HELD.clear()
        HELD[name] = index(items, rate)
    return HELD[name]


def blocks(benchmark: DataFrame):
    """(number of blocks, their items one block after the other), each block of about ``BLOCK`` bytes of text; one at least."""
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("binary").alias("t")).where("i is not null and octet_length(t) > 0").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // BLOCK))
    return n, (sorted((r.i, bytes(r.t)) for r in items.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b).collect()) for b in range(n))


def find(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, rate: float = RATE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, distance): regions of documents within ``rate`` edits a byte of a benchmark segment, case and white space (any run of it is one blank) aside; start and end are byte offsets of the searched region.

    Null or empty texts and items match nothing; repeated rows give repeated results; empty tables give none. The benchmark is carried to the tasks in blocks of about ``BLOCK`` bytes, each a pass over the documents whose hits are written before the next block is read: neither driver nor workers hold more than one."""
    n, each = blocks(benchmark)
    found, kind = None, docs.schema[key].dataType.simpleString()
    for items in each:

        def run(batches, items=items, name=uuid.uuid4().hex):
            ix = held(name, items, rate)
            for batch in batches:
                rows, hits = [], []
                for lo, _, data, off in blobs(batch.column(1)):
                    for r, *rest in search(ix, data, off):
                        rows.append(lo + r), hits.append(rest)
                columns = [pa.array([h[i] for h in hits], t) for i, t in enumerate([pa.int64()] * 3 + [pa.int32()])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["doc_id", "item_id", "start", "end", "distance"])

        part = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, HITS.format(kind))
        part = scratch.save(part) if n > 1 else part
        found = part if found is None else found.unionAll(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, rate: float = RATE, text: str = "text") -> DataFrame:
    """The rows, with all their columns, in which no benchmark segment is found: each is judged by its own text, so neither a shared nor a null key decides. One pass a block, written before the next."""
    schema, (n, each) = docs.schema, blocks(benchmark)
    for items in each:

        def run(batches, items=items, name=uuid.uuid4().hex):
            ix = held(name, items, rate)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, data, off in blobs(batch.column(batch.schema.get_field_index(text))):
                    for r, *_ in search(ix, data, off):
                        keep[lo + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
        docs = scratch.save(docs) if n > 1 else docs
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find(docs, benchmark, Scratch(spark))
