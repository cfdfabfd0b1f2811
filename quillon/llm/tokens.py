"""Token counts of sections: whole documents are encoded once, and each token is given to a section by its place."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id {}, n_bytes long, n_tokens long, n_crossing long, sections array<struct<field:int,line:int,start:long,stop:long,tokens:long>>"


class Encoder:
    """Token lengths in bytes, of texts encoded whole."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tool = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(k) for k in ranks]

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.size[np.asarray(self.tool.encode_to_numpy(text), np.int64)]) if text else np.zeros(0, np.int64)


def sections(fields: list[str], lines: bool) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the document, field, line, start of each section): the fields joined by a line feed, each one section or one for each of its lines. The line feed ends the section before it."""
    raw = "\n".join(fields).encode()
    field, line, start, at = [], [], [], 0
    for i, f in enumerate(fields):
        parts = f.split("\n") if lines else [f]
        for j, p in enumerate(parts):
            field.append(i), line.append(j), start.append(at)
            at += len(p.encode()) + 1
    return raw, np.array(field), np.array(line), np.array(start, np.int64)


def attribute(ends: np.ndarray, start: np.ndarray, stop: int) -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary). The rule: a token belongs to the section that holds most of its bytes, to the first of equal ones."""
    count = np.zeros(len(start), np.int64)
    if not len(ends):
        return count, 0
    begin = np.concatenate(([0], ends[:-1]))
    first, last = np.searchsorted(start, begin, "right") - 1, np.searchsorted(start, ends - 1, "right") - 1
    own = first.copy()
    bound = np.append(start, stop)
    for i in np.flatnonzero(first != last):
        held = [min(ends[i], bound[s + 1]) - max(begin[i], bound[s]) for s in range(first[i], last[i] + 1)]
        own[i] = first[i] + int(np.argmax(held))
    return np.bincount(own, minlength=len(start)).astype(np.int64), int((first != last).sum())


def count_tokens(docs: DataFrame, fields: list[str], lines: bool = True, vocabulary: str = VOCABULARY, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_crossing, sections) for each row; sections: field (its place in ``fields``), line, start, stop (byte offsets in the joined fields), tokens.

    Null fields count as empty; an empty section has no tokens; a document of empty fields has the tokens of the line feeds between them. Repeated rows give repeated results. ``vocabulary`` is a path that each executor can open."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            columns = [batch.column(i + 1) for i in range(len(fields))]
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                texts = list(zip(*[c.slice(lo, 256).to_pylist() for c in columns], strict=True))
                n_bytes, n_tokens, crossing, offsets, parts = [], [], [], [0], []
                for row in texts:
                    row = [x or "" for x in row]
                    raw, field, line, start = sections(row, lines)
                    ends = encoder.ends("\n".join(row))
                    count, over = attribute(ends, start, len(raw))
                    n_bytes.append(len(raw)), n_tokens.append(len(ends)), crossing.append(over), offsets.append(offsets[-1] + len(start))
                    parts.append((field, line, start, np.append(start[1:], len(raw)), count))
                names = ["field", "line", "start", "stop", "tokens"]
                flat = [np.concatenate(x) for x in zip(*parts, strict=True)]
                arrays = [pa.array(x.astype(np.int32 if n in ("field", "line") else np.int64)) for n, x in zip(names, flat, strict=True)]
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, names))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(crossing, pa.int64()), listed], ["doc_id", "n_bytes", "n_tokens", "n_crossing", "sections"])

    return docs.select(F.col(key).alias("doc_id"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)]).mapInArrow(run, SCHEMA.format(kind))


def query(spark, sf_dir: str) -> DataFrame:
    """Tokens of each document, of its source field, and of its lines in order."""
    found = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["source", "text"])
    of = F.filter("sections", lambda s: s.field == 1)
    return found.select(
        "doc_id", "n_bytes", "n_tokens", "n_crossing", F.size("sections").cast("long").alias("n_sections"), F.element_at("sections", 1)["tokens"].alias("source_tokens"),
        F.array_max(F.transform(of, lambda s: s.tokens)).alias("most_tokens"), F.transform(of, lambda s: s.tokens).alias("line_tokens"),
    )
