"""Mixing sources to target weights: budgets down a tree, then each leaf's token-prefix from seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BITS, STEPS = 8, 3  # a leaf's documents fall into 2^BITS ranges of their hash, and a cut range again
SEP, ESC = "\x1f", "\x1e"
WORDS = r"[^\x20\x09-\x0D]+"


def share(budget: float, weights: Sequence[float], room: Sequence[float]) -> list[float]:
    """Splits a budget by weights; what a child has no room for goes to its siblings by their weights, until all are full."""
    out, free = [0.0] * len(weights), [i for i, w in enumerate(weights) if w > 0 and room[i] > 0]
    left = min(budget, sum(room[i] for i in free))
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        tight = [i for i in free if out[i] + left * weights[i] / total >= room[i]]
        if not tight:
            for i in free:
                out[i] += left * weights[i] / total
            break
        for i in tight:
            left -= room[i] - out[i]
            out[i] = room[i]
        free = [i for i in free if i not in set(tight)]
        # what the others had keeps: their shares are dealt from the rest anew
    return out


def budgets(tokens: Mapping[tuple, int], weights: Mapping[tuple, float], total: float, epochs: int) -> dict[tuple, int]:
    """Whole tokens for each leaf. A node's weight is that of its path, 1 if not given. A shortage stays among siblings and reaches an ancestor's siblings only if the whole subtree is full."""
    depth = len(next(iter(tokens), ()))
    room: dict[tuple, float] = {}
    children: dict[tuple, set[tuple]] = {}
    for path, n in tokens.items():
        for d in range(depth + 1):
            room[path[:d]] = room.get(path[:d], 0) + n * epochs
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
    got = {(): min(total, room.get((), 0))}
    for d in range(depth):
        for node in [x for x in got if len(x) == d]:
            kids = sorted(children.get(node, ()))
            got |= dict(zip(kids, share(got[node], [weights.get(k, 1.0) for k in kids], [room[k] for k in kids]), strict=True))
    return {p: int(v + 1e-6) for p, v in got.items() if len(p) == depth and depth}


def hashed(seed: int, epoch: Column, key: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, key.cast("string"))


def path_of(values: Sequence[Column]) -> Column:
    """One string of the levels' values; separators inside values are escaped, so a path has as many parts as levels."""
    clean = [F.coalesce(c.cast("string"), F.lit("")) for c in values]
    return F.concat_ws(SEP, *[F.replace(F.replace(c, F.lit(ESC), F.lit(ESC + "0")), F.lit(SEP), F.lit(ESC + "1")) for c in clean])


def parts_of(path: str) -> tuple[str, ...]:
    return tuple(x.replace(ESC + "1", SEP).replace(ESC + "0", ESC) for x in path.split(SEP))


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple, float], scratch: Scratch, fraction: float = 0.5, epochs: int = 4, seed: int = 17, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen rows with all their columns, and ``mix_path`` (values of the levels), ``mix_tokens`` (words of the whole text) and ``mix_copies`` (times the row is taken).

    The total is ``fraction`` of all tokens. A leaf with budget b of T tokens takes b // T whole epochs, then the prefix, in the order of the next epoch's seeded hash, whose running sum stays within the rest. Input columns of those three names are replaced, others kept. Null levels count as ''. Texts null, empty or of white space have no tokens and are never chosen. Rows with one key and leaf are taken or left together.

    The words are counted once, in a table of key, path and count; the leaves' totals, which the budgets are made of, meet on the driver: a row for each kind of source, never for documents. The cut of a leaf is found in STEPS steps of 2^BITS ranges of the hash, each a sum by range, so that no task sorts more than those or than a 2^(STEPS * BITS)th of a leaf."""
    docs = docs.drop("mix_path", "mix_tokens", "mix_copies")
    path = path_of(list(levels.values()))
    tokens = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("long")
    counted = scratch.save(docs.withColumns({"mix_path": path, "mix_tokens": tokens}).where("mix_tokens > 0"))
    narrow = counted.select(F.col(key).cast("string").alias("k"), F.col("mix_path").alias("p"), F.col("mix_tokens").alias("n"))
    spark = docs.sparkSession
    have = {r.p: r.t for r in narrow.groupBy("p").agg(F.sum("n").alias("t")).collect()}
    given = budgets({parts_of(p): t for p, t in have.items()}, weights, fraction * sum(have.values()), epochs)
    plan = {p: (given[parts_of(p)] // t, given[parts_of(p)] % t) for p, t in have.items()}
    limits = spark.createDataFrame([(p, w, r) for p, (w, r) in plan.items()], "p string, whole long, rest long")
    part = narrow.join(F.broadcast(limits), "p").withColumn("h", hashed(seed, F.col("whole"), F.col("k")))
    # the range in which each leaf's running sum passes its rest, then that range's range, and so on
    bound = part.withColumn("before", F.lit(0).cast("long"))
    for step in range(1, STEPS + 1):
        name = f"r{step}"
        bound = bound.withColumn(name, F.shiftrightunsigned("h", 64 - BITS * step))
        sums = bound.groupBy("p", name).agg(F.sum("n").alias("s"), F.first("rest").alias("rest"), F.first("before").alias("base"))
        run = Window.partitionBy("p").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("base") + F.coalesce(F.sum("s").over(run), F.lit(0)))
        cut = scratch.save(sums.where("before <= rest and before + s > rest").select("p", name, "before"))  # a row a leaf at most
        bound = bound.drop("before").join(cut, ["p", name])
    order = Window.partitionBy("p").orderBy("h", "k").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = bound.withColumn("sum", F.col("before") + F.sum("n").over(order)).where("sum <= rest").groupBy("p").agg(F.max(F.struct("h", "k")).alias("last"))
    ends = cut.join(last, "p", "left").select("p", name, F.col("last.h").alias("h"), F.col("last.k").alias("k")).collect()  # a row a leaf at most
    by = {e.p: e for e in ends}
    rows = [(p, w, by[p][name], by[p].h, by[p].k) for p, (w, _) in plan.items()]
    limits = spark.createDataFrame(rows, "p_ string, whole_ long, range_ long, hash_ long, key_ string")
    # positions, not names: a column may have any name
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(counted.columns)]
    where = {c: f"c{i}" for i, c in enumerate(counted.columns)}
    k = F.col(where[key]).cast("string")
    out = counted.select(*own).join(F.broadcast(limits), F.col(where["mix_path"]) == F.col("p_"))
    out = out.withColumn("own_", hashed(seed, F.col("whole_"), k)).withColumn("mine_", F.shiftrightunsigned("own_", 64 - STEPS * BITS))
    same = F.coalesce(F.expr("own_ < hash_") | (F.expr("own_ = hash_") & (k <= F.col("key_"))), F.lit(False))
    out = out.withColumn("copies_", F.col("whole_") + (F.expr("mine_ < range_") | (F.expr("mine_ = range_") & same)).cast("long"))
    return out.where("copies_ > 0").select(*[F.col(v).alias(c) for c, v in where.items()], F.col("copies_").alias("mix_copies"))


def levels() -> dict[str, Column]:
    """Domain, language, source: the query's domains are made of the sources' numbers."""
    n = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(-1))
    domain = F.when(n == 0, "web").when(n.between(1, 7), "books").when(n.between(8, 13), "reference").otherwise("forum")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


WEIGHTS = {("web",): 0.25, ("books",): 0.35, ("reference",): 0.3, ("forum",): 0.1, ("web", "en"): 2.0, ("books", "en"): 2.0, ("books", "de"): 1.5, ("reference", "es"): 3.0, ("books", "en", "src1"): 3.0}


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mix_sources(docs.select("doc_id", "lang", "source", "text"), levels(), WEIGHTS, Scratch(spark))
    parts = F.split("mix_path", SEP)
    return out.select("doc_id", parts[0].alias("domain"), parts[1].alias("lang"), parts[2].alias("source"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_copies").alias("copies"))
