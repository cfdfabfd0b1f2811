"""Language identification by error-correcting output codes over hashed byte n-grams."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, blobs

#: A text of no letters has this language.
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
GRAMS = (1, 2, 3)


@dataclass
class Codebook:
    """``codes``: languages x bits of +1 and -1; ``weights``: hashed n-grams x bits; ``trust``: of each bit's classifier, from held-back training rows."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    ambiguous_below: float


def codewords(k: int) -> np.ndarray:
    """All splits of up to 5 classes into two sides; more classes: seeded words far apart."""
    if k < 2:
        return np.zeros((k, 0), np.float32)
    if k <= 5:
        bits = [[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for i in range(k)] for b in range(2 ** (k - 1) - 1)]
        return np.array(bits, np.float32).T
    n, rng, best = int(np.ceil(10 * np.log2(k))), np.random.default_rng(7), (-1, None)
    for _ in range(200):
        m = rng.choice(np.array([-1, 1], np.float32), (k, n))
        apart = (m @ m.T - 2 * n * np.eye(k)).max()
        best = max(best, (n - apart, m), key=lambda x: x[0])
    return best[1]


def histograms(data: np.ndarray, off: np.ndarray, width: int) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 3-grams of each row's lower-cased bytes."""
    rows = len(off) - 1
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    out = np.zeros(rows * width, np.float32)
    step = 1 << 22
    long = np.diff(off)
    rows_at, left_at = np.repeat(np.arange(rows, dtype=np.int32), long), np.repeat(off[1:], long) - np.arange(len(data))
    for lo in range(0, len(data), step):  # a long row is counted piece by piece
        part = lower[lo : lo + step + max(GRAMS) - 1]
        row, left = rows_at[lo : lo + step], left_at[lo : lo + step]
        key = np.zeros(len(row), np.uint32)
        for n in GRAMS:
            m = len(part) - n + 1
            if m <= 0:
                break
            m = min(m, len(row))
            key[:m] = key[:m] * np.uint32(257) + part[n - 1 : n - 1 + m] + np.uint32(1)
            fits = left[:m] >= n
            slot = ((key[:m] * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(width)
            out += np.bincount((row[:m] * np.int64(width) + slot)[fits], minlength=rows * width)
    out = out.reshape(rows, width)
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))


def fit(texts: list[str], languages: list[str], width: int = 4096, ridge: float = 0.1, ambiguous_below: float = 0.05) -> Codebook:
    """A regularised least-squares classifier for each bit, on whole texts. Every fifth row is held back to weigh the bits, then all rows are fitted."""
    names = sorted(set(languages))
    codes = codewords(len(names))
    if not texts or not codes.shape[1]:
        return Codebook(names, codes, np.zeros((width, codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32), np.ones(codes.shape[1]), ambiguous_below)
    column = pa.array(texts, pa.large_string())
    x = np.concatenate([histograms(d, o, width) for _, _, d, o in blobs(column)])
    y = codes[[names.index(v) for v in languages]]

    def solve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mean, middle = x.mean(0), y.mean(0)
        c = x - mean
        w = c.T @ np.linalg.solve(c @ c.T + ridge * np.eye(len(x), dtype=np.float32), y - middle)
        return w, middle - mean @ w, mean

    back = np.arange(len(x)) % 5 == 0
    trust = np.ones(codes.shape[1])
    if 0 < back.sum() < len(x):
        w, b, _ = solve(x[~back], y[~back])
        right = (np.sign(x[back] @ w + b) == y[back]).mean(0)
        trust = np.maximum(2 * right - 1, 0.01)
    w, b, _ = solve(x, y)
    return Codebook(names, codes, w.astype(np.float32), b.astype(np.float32), trust, ambiguous_below)


def decode(book: Codebook, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest codeword, score 0 to 1, ambiguous): the loss of a codeword is the trust-weighted hinge loss of its bits."""
    if len(book.languages) == 1:
        return np.zeros(len(outputs), int), np.ones(len(outputs)), np.zeros(len(outputs), bool)
    loss = (np.maximum(0, 1 - outputs[:, None, :] * book.codes[None]) * book.trust).sum(2) / book.trust.sum()
    order = np.sort(loss, 1)
    p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
    return loss.argmin(1), p.max(1) / p.sum(1), order[:, 1] - order[:, 0] < book.ambiguous_below


def label(batch: pa.RecordBatch, text: str, book: Codebook) -> tuple[list[str], np.ndarray, np.ndarray]:
    """lang_pred, score, ambiguous for each row."""
    column = batch.column(batch.schema.get_field_index(text))
    names, scores, doubtful = [], [np.zeros(0)], [np.zeros(0, bool)]
    for lo, hi, data, off in blobs(column):
        if not book.languages:
            names += [UNDETERMINED] * (hi - lo)
            scores.append(np.zeros(hi - lo))
            doubtful.append(np.zeros(hi - lo, bool))
            continue
        best, score, flag = decode(book, histograms(data, off, book.weights.shape[0]) @ book.weights + book.bias)
        lettered = np.array([bool(LETTER.search(s or "")) for s in column.slice(lo, hi - lo).to_pylist()])
        names += [book.languages[i] if ok else UNDETERMINED for i, ok in zip(best, lettered, strict=True)]
        scores.append(np.where(lettered, np.clip(score, 0, 1), 0.0))
        doubtful.append(flag & lettered)
    return names, np.concatenate(scores), np.concatenate(doubtful)


def learn(docs: DataFrame, rows: Column, per_language: int = 300, longest: int = 50_000, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Codebook:
    """Fits on at most ``per_language`` rows of each language, those of least hash among ``rows``, of 1 to ``longest`` characters with a letter: the one bound on what is learnt from.

    Keys are of any type. Null or empty texts and null languages are not learnt from. Languages are labels: their names meet on the driver. Each task of the one scan keeps its own least rows of each language; the least of those are taken language by language, so no task sorts a language."""
    spark = docs.sparkSession
    names = [F.col(lang).alias("l"), F.xxhash64(F.col(key).cast("string")).alias("h"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.xxhash64(text).alias("x")]
    able = docs.where(rows).where(F.col(lang).isNotNull() & F.length(text).between(1, longest) & F.col(text).rlike(r"\p{L}"))

    def least(batches):
        best = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = (t if best is None else pa.concat_tables([best, t])).sort_by([(c, "ascending") for c in "lhkx"])
            l = t.column("l").combine_chunks().dictionary_encode().indices.to_numpy()
            begin = np.flatnonzero(np.concatenate(([True], l[1:] != l[:-1])))[: len(l)]
            best = t.filter(pa.array(np.arange(len(l)) - np.repeat(begin, np.diff(np.append(begin, len(l)))) < per_language))
        if best is not None:
            yield from best.to_batches()

    kind = docs.schema[lang].dataType.simpleString()
    held = Scratch(spark).save(able.select(*names).mapInArrow(least, f"l {kind}, h long, k string, x long"))
    tops = [held.where(F.col("l") == r.l).distinct().orderBy("h", "k", "x").limit(per_language) for r in held.select("l").distinct().orderBy("l").collect()]
    if not tops:
        return fit([], [])
    picked = spark.createDataFrame([r for t in tops for r in t.collect()], held.schema)  # per_language rows a language at most
    got = docs.select(*names, F.col(text).alias("t")).join(F.broadcast(picked), ["l", "h", "k", "x"], "left_semi").select("k", "t", F.col("l").cast("string"))
    found = sorted({(r.k, r.t, r.l) for r in got.collect() if LETTER.search(r.t)})
    return fit([t for _, t, _ in found], [v for _, _, v in found])


def predict(docs: DataFrame, book: Codebook, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, is_ambiguous) for each row, repeated rows included. Text null, empty or without letters: ``und`` with score 0."""

    def run(batches):
        for batch in batches:
            names, score, flag = label(batch, "t", book)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(flag)], ["k", "lang_pred", "score", "is_ambiguous"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, lang_pred string, score double, is_ambiguous boolean")
    return out.select(F.col("k").alias(key), "lang_pred", "score", "is_ambiguous")


def keep_known(docs: DataFrame, book: Codebook, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose language is known: rejected are texts that are null, empty or without letters, and those whose language is ambiguous and not told by ``lang``. A null ``lang`` becomes the prediction. If no language was learnt, only texts without letters go."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(lang)
            given = batch.column(at)
            if book.languages:
                names, _, doubtful = label(batch, text, book)
                told = ~np.asarray(given.is_null())
                keep = np.array([v != UNDETERMINED for v in names], bool) & (told | ~doubtful)
                given = pc.coalesce(given, pa.array(names, pa.string()).cast(given.type))
            else:
                keep = np.array([bool(LETTER.search(x or "")) for x in batch.column(batch.schema.get_field_index(text)).to_pylist()], bool)
            columns = [given if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def third(key: str = "doc_id") -> Column:
    """The remainder that splits learning (not 1) from held-out rows (1)."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(3))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    book = learn(docs, third() != 1)
    return predict(docs, book).select("doc_id", (third() == 1).alias("held_out"), "lang_pred", "score", "is_ambiguous")
