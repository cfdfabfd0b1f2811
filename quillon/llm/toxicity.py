r"""Toxicity by a subsequence string kernel and a support vector machine on Nystroem landmarks.

A string's features are its subsequences of three symbols within SPAN + 1 places, each occurrence weighted by DECAY to the power of its span, all divided by the norm that the occurrences would have if none repeated: gaps and inserted characters keep part of the weight. The strings are words between two edges, symbols folded (case, look-alike digits, signs dropped), spelled-out single letters joined.

Sentences take the label of their document, so a sentence of a toxic document is toxic by some word at most (multiple instances). Words that cover the toxic documents and no others start the positive side; the machine then picks further witnesses and hard negatives in turns. On the landmarks' side the decision is a sum over features, so scoring is a table look-up for each symbol and pattern, and no kernel is evaluated then."""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blobs

SPAN, DECAY = 5, np.float32(0.6)
PATTERNS = [(a, b) for b in range(2, SPAN + 1) for a in range(1, b)]
EDGE, ROW, DROP = 0, 254, 255
LONG = 4 << 20
#: Look-alikes of letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def _fold() -> np.ndarray:
    t = np.full(256, DROP, np.uint8)
    for i in range(26):
        t[65 + i] = t[97 + i] = i + 1
    for k, v in LOOKALIKES.items():
        t[ord(k)] = ord(v) - 96
    t[[32, *range(9, 14)]] = EDGE
    t[128:192] = 27 + np.arange(64) % 5  # the last byte of a letter beyond ASCII stands for it
    return t


FOLD = _fold()


@dataclass
class Model:
    """``table``: the decision's weight of each feature; score = 1 / (1 + exp(-(slope * decision + offset)))."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float


def stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols with one edge before each word and one at the end, the edges' places, the row of each word)."""
    s = np.insert(FOLD[data], off[:-1], ROW)
    s = np.append(s[s != DROP], np.uint8(ROW))
    edge = (s == EDGE) | (s == ROW)
    keep = ~edge
    keep[1:] |= edge[1:] & ~edge[:-1]
    keep |= s == ROW
    s = s[keep]
    # an edge right after a row's mark says nothing
    dull = np.concatenate(([False], (s[1:] == EDGE) & (s[:-1] == ROW))) | np.append((s[:-1] == EDGE) & (s[1:] == ROW), False)
    s = s[~dull]
    place = np.flatnonzero((s == EDGE) | (s == ROW))
    size = np.diff(place) - 1
    joined = np.zeros(len(place), bool)
    joined[1:-1] = (size[:-1] == 1) & (size[1:] == 1) & (s[place[1:-1]] == EDGE)
    if joined.any():
        s = np.delete(s, place[joined])
        place = np.flatnonzero((s == EDGE) | (s == ROW))
    row = np.cumsum(s[place] == ROW) - 1
    s[s == ROW] = EDGE
    return s, place, row[:-1]


def _norms(size: np.ndarray) -> np.ndarray:
    total = sum((np.maximum(size + 2 - b, 0) * (b - 1) * float(DECAY) ** (2 * b) for b in range(2, SPAN + 1)), np.zeros(len(size)))
    return np.sqrt(np.maximum(total, 1e-12)).astype(np.float32)


def decisions(s: np.ndarray, place: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of feature weights of each word, over its norm; words of no symbols get 0."""
    n = len(s)
    size = np.diff(place) - 1
    if not len(size):
        return np.zeros(0, np.float32)
    left = np.repeat(place[1:], size + 1) - np.arange(n - 1)
    wide = np.concatenate([s, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    total = np.zeros(n - 1, np.float32)
    head = wide[: n - 1] * 1024
    for b in range(2, SPAN + 1):
        tail, part = head + wide[b : b + n - 1], np.zeros(n - 1, np.float32)
        for a in range(1, b):
            part += table[tail + wide[a : a + n - 1] * 32]
        part[left < b] = 0
        total += part * DECAY**b
    return np.add.reduceat(total, place[:-1]) / _norms(size) * (size > 0)


def _highest(data: np.ndarray, off: np.ndarray, model: Model) -> np.ndarray:
    s, place, row = stream(data, off)
    d = np.where(np.diff(place) > 1, decisions(s, place, model.table) + model.bias, -20).astype(np.float32)
    out = np.full(len(off) - 1, -20, np.float32)
    np.maximum.at(out, row, d)
    return out


def highest(data: np.ndarray, off: np.ndarray, model: Model) -> np.ndarray:
    """Each row's highest decision of a word; rows without words get the lowest there is. A row longer than LONG is taken in pieces cut at white space, wherever that is, so that no word is cut."""
    if len(off) > 2 or len(data) <= LONG:
        return _highest(data, off, model)
    cuts = [0]
    while cuts[-1] + LONG < len(data):
        hi, gap = cuts[-1] + LONG, ()
        while hi < len(data) and not len(gap):
            gap = np.flatnonzero(FOLD[data[hi : hi + LONG]] == EDGE)
            hi += LONG
        cuts.append(hi - LONG + int(gap[0]) if len(gap) else len(data))
    cuts = cuts if cuts[-1] == len(data) else [*cuts, len(data)]
    return np.array([max(_highest(data[a:b], np.array([0, b - a]), model)[0] for a, b in zip(cuts, cuts[1:], strict=False))])


def features(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a folded word's occurrences, and their weights."""
    s = np.frombuffer(b"\0" + word + b"\0", np.uint8).astype(np.int32)
    at, w = [], []
    for a, b in PATTERNS:
        n = len(s) - b
        if n > 0:
            at.append(s[:n] * 1024 + s[a : a + n] * 32 + s[b : b + n])
            w.append(np.full(n, DECAY**b, np.float32))
    at, w = np.concatenate(at), np.concatenate(w)
    return at, w / np.sqrt((w * w).sum())


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """A squared-hinge support vector machine by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = ridge * np.eye(x1.shape[1])
    reg[-1, -1] = 1e-6
    old = None
    for _ in range(40):
        sv = y * (x1 @ w) < 1
        if old is not None and (sv == old).all():
            break
        old, a = sv, x1[sv] * cost[sv, None]
        w = np.linalg.solve(reg + x1[sv].T @ a, a.T @ y[sv])
    return w[:-1], w[-1]


def families(bags: list[list[bytes]], share: float = 0.3, rare: int = 50) -> np.ndarray:
    """The documents of which no earlier one has that share of their rare words, those in at most ``rare`` of the learning documents: copies teach nothing new and make any word look telling."""
    where = defaultdict(list)
    for i, bag in enumerate(bags):
        for w in bag:
            where[w].append(i)
    kept = []
    for i, bag in enumerate(bags):
        met = Counter(j for w in bag if len(where[w]) <= rare for j in where[w] if j < i)
        few = sum(len(where[w]) <= rare for w in bag)
        if not met or max(met.values()) < max(2, share * few):
            kept.append(i)
    return np.array(kept, np.int64)


def fit(texts: list[str], toxic: list[int], landmarks: int = 200, negatives: int = 4000, turns: int = 4, seed: int = 5) -> Model:
    """Learns from whole texts. Without both labels, everything scores low (or high, if all are toxic). ``negatives``: words of clean documents that each turn fits on, those that score highest among all of them first; ``landmarks``: of the Nystroem map."""
    labels = np.array(toxic, bool)
    if not len(labels) or labels.all() or not labels.any():
        sure = 5.0 if len(labels) and labels.all() else -5.0
        return Model(np.zeros(32768, np.float32), 0.0, 0.0, sure)
    bags: list[list[bytes]] = []
    for _, _, data, off in blobs(pa.array(texts, pa.large_string())):
        s, place, row = stream(data, off)
        raw, got = s.tobytes(), [set() for _ in range(len(off) - 1)]
        for a, b, r in zip(place[:-1].tolist(), place[1:].tolist(), row.tolist(), strict=True):
            if b - a > 1:
                got[r].add(raw[a + 1 : b])
        bags += [sorted(g) for g in got]
    alone = families(bags)
    bags, labels = [bags[i] for i in alone], labels[alone]
    clean = Counter(w for bag, t in zip(bags, labels, strict=True) if not t for w in bag)
    holds = defaultdict(set)
    for i in np.flatnonzero(labels):
        for w in bags[i]:
            if clean[w] == 0 or clean[w] * 20 < len(labels):
                holds[w].add(int(i))
    # greedy cover of the toxic documents by words that others lack
    heap = [(-(len(v) - 3 * clean[w]), w) for w, v in holds.items() if len(v) - 3 * clean[w] >= 3]
    heapq.heapify(heap)
    covered: set[int] = set()
    witnesses: list[bytes] = []
    while heap:
        gain, w = heapq.heappop(heap)
        now = len(holds[w] - covered) - 3 * clean[w]
        if now < 3:
            continue
        if -gain != now:
            heapq.heappush(heap, (-now, w))
            continue
        witnesses.append(w)
        covered |= holds[w]
    # what is as exclusive as the cover's words is a witness too
    witnesses = sorted({*witnesses, *(w for w, v in holds.items() if len(v) >= 5 and not clean[w])})
    rng = np.random.default_rng(seed)
    plain = sorted(clean)
    plain = [plain[i] for i in rng.permutation(len(plain))[:negatives]]
    if not witnesses or not plain:
        share = float(labels.mean())
        return Model(np.zeros(32768, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    all_words = sorted({w for bag in bags for w in bag})
    number = {w: i for i, w in enumerate(all_words)}
    members = [np.array([number[w] for w in bag], np.int64) for bag in bags]
    joined = np.frombuffer(b"\0" + b"\0".join(all_words) + b"\0", np.uint8)
    places = np.flatnonzero(joined == EDGE)
    known = Counter(w for bag, t in zip(bags, labels, strict=True) if t for w in bag)
    for turn in range(turns):
        half = landmarks // 2
        marks = [witnesses[i] for i in rng.permutation(len(witnesses))[:half]] + plain[: landmarks - min(half, len(witnesses))]
        phi = np.zeros((len(marks), 32768), np.float32)
        for i, w in enumerate(marks):
            at, v = features(w)
            np.add.at(phi[i], at, v)
        values, vectors = np.linalg.eigh((phi @ phi.T).astype(np.float64))
        good = values > 1e-6 * values[-1]
        whiten = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
        side, other = phi.T.copy(), witnesses + plain
        k = np.stack([v @ side[at] for at, v in map(features, other)])
        y = np.where(np.arange(len(other)) < len(witnesses), 1.0, -1.0)
        cost = np.where(y > 0, np.array([max(1, known[w]) ** 0.5 for w in other]), 1.0)
        cost = np.where(y > 0, cost / cost[y > 0].sum(), 1.0 / (y < 0).sum())
        w, bias = _machine((k @ whiten).astype(np.float64), y, cost)
        table = (side @ (whiten @ w.astype(np.float32))).astype(np.float32)
        d = decisions(joined, places, table) + bias
        top = np.array([d[m].max() if len(m) else -20.0 for m in members])
        if turn + 1 < turns:
            hard = {all_words[i] for m, t in zip(members, labels, strict=True) if not t and len(m) for i in m[np.argsort(-d[m])[:3]] if d[i] > -0.7}
            plain = sorted(hard) + [p for p in plain if p not in hard]
            have = set(witnesses)
            fresh = set()
            for i in np.flatnonzero(labels):
                if not have.intersection(bags[i]) and len(members[i]):
                    j = members[i][d[members[i]].argmax()]
                    if d[j] > 0 and not clean[all_words[j]]:
                        fresh.add(all_words[j])
            witnesses = sorted(have | fresh)
    # a logistic curve over the documents' highest decisions, balanced
    slope, offset, x = 4.0, 0.0, np.clip(top, -5, 5)
    weight = np.where(labels, 0.5 / labels.sum(), 0.5 / (~labels).sum())
    for _ in range(500):
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        g = weight * (p - labels)
        slope -= 8 * (g * x).sum() + 0.004 * slope
        offset -= 8 * g.sum()
    return Model(table, float(bias), float(max(slope, 0.5)), float(offset))


def learn(docs: DataFrame, labels: DataFrame, rows: Column, toxic: int = 800, clean: int = 2400, longest: int = 8000, key: str = "doc_id", text: str = "text") -> Model:
    """Fits on at most ``toxic`` and ``clean`` labelled documents of the classes, those of least hash among ``rows`` with 1 to ``longest`` characters: the one bound on what is learnt from."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).where(rows).groupBy(key).agg(F.max("toxic").alias("toxic"))
    pool = docs.where(F.length(text).between(1, longest)).select(key).distinct().join(marked, key)
    # the least of each class: every task keeps its own least, so no task sorts a class
    least = lambda y, n: pool.where(F.col("toxic") == y).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(n)
    ids = least(1, toxic).unionAll(least(0, clean)).select(F.col(key).cast("long").alias("k"), "toxic").collect()
    if not ids:
        return fit([], [])
    picked = docs.sparkSession.createDataFrame([(r.k, int(r.toxic)) for r in ids], "k long, y int")  # at most toxic + clean rows
    got = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where(F.length("t").between(1, longest)).join(F.broadcast(picked), "k").collect()
    found = sorted({(r.k, r.t, r.y) for r in got})
    return fit([t for _, t, _ in found], [y for _, _, y in found])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row: that of the most toxic word of the whole text. Texts without words, null or empty get the score of the lowest decision."""

    def run(batches):
        for batch in batches:
            d = [np.zeros(0, np.float32)] + [highest(x, off, model) for _, _, x, off in blobs(batch.column(1))]
            s = 1 / (1 + np.exp(-(model.slope * np.clip(np.concatenate(d).astype(np.float64), -5, 5) + model.offset)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["k", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, score double").select(F.col("k").alias(key), "score")


def fifth(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(5))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = learn(docs, labels, fifth() != 0)
    return score(docs, model).select("doc_id", (fifth() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
