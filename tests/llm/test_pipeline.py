"""The corpus pipeline's rows against a plain version of its five stages."""

import random

import pytest
import test_operators as T
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm import mixing

KIND = "doc_id long, text string, lang string, source string, n_chars int, more double"


def made():
    """Documents with copies, near copies, shared passages of over 50 words, benchmark passages, and nothing to say."""
    rng = random.Random(41)
    items = [(i, T.prose(14, rng)) for i in range(3)]
    passages = [T.prose(55, rng) for _ in range(3)]
    base = [T.prose(rng.randint(30, 60), rng) for _ in range(4)]
    rows = []
    for i in range(36):
        text = T.prose(rng.randint(12, 50), rng)
        if i % 5 == 1:
            text += " " + passages[i % 3] + " " + T.prose(8, rng)
        if i % 9 == 4:
            text = text + " " + T.edit(items[i % 3][1], i % 4, rng).upper() + " " + T.prose(6, rng)
        if i % 6 == 5:
            text = base[i % 4] + (" " + T.prose(3, rng) if i % 4 else "")
        rows.append((i + 1, text, rng.choice(["en", "fr"]), f"src{rng.choice([0, 1, 2, 9, 15])}"))
    rows += [(50, None, "en", "src0"), (51, "", None, "src1"), (52, "12 .. 3", "en", "src1"), (53, passages[0], "en", "src2"), (54, "One two.", "fr", "src9")]
    return [(i, t, v, s, len(t or ""), 0.5) for i, t, v, s in rows], items


def expected(rows, items):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]  # each has its language
    label = T.linked_components(rows)
    rows = [r for r in rows if label[r[0]] == r[0]]
    cut = T.later_cut(rows, corpus_pipeline.REPEAT)
    rows = [(r[0], cut[r[0]], *r[2:4]) for r in rows if r[0] in cut]
    fold = lambda s: " ".join(s.lower().replace("\n", " ").split(" ")).encode()

    def holds(text):
        segments = [fold(t) for _, t in items]
        assert all(len(s) < 144 for s in segments)
        return any(T.edits(s, fold(text)) <= min(int(0.07 * len(s)), len(s) // 12 - 1) for s in segments)

    rows = [r for r in rows if not holds(r[1])]
    domain = lambda s: "web" if s == 0 else "books" if s < 8 else "reference" if s < 14 else "forum"
    have, members = {}, {}
    for i, t, lang, source in rows:
        if n := len(t.split()):
            p = (domain(int(source[3:])), lang, source)
            have[p] = have.get(p, 0) + n
            members.setdefault(p, []).append((i, t, n))
    return rows, T.dealt_tree(have, mixing.WEIGHTS, 0.5 * sum(have.values()), 4), have, members


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    rows, items = made()
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept, plan, have, members = expected(rows, items)
    assert 10 < len(kept) < 35 and {r[0] for r in kept} >= {54}
    want = {}
    for p, b in plan.items():
        whole, left = divmod(b, have[p])
        keys = spark.createDataFrame([(str(i),) for i, _, _ in members[p]], "s string").selectExpr("s", f"xxhash64(17, bigint({whole}), s) h").collect()
        h = {r.s: r.h % 2**64 for r in keys}
        total = 0
        for i, t, n in sorted(members[p], key=lambda m: (h[str(m[0])], str(m[0]))):
            total += n
            if copies := whole + (total <= left):
                want[i] = (t, n, copies, len(t))
    assert {r.doc_id: (r.text, r.mix_tokens, r.mix_copies, r.n_chars) for r in got} == want and len(got) == len(want)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    rows, items = made()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, KIND).withColumns({"h": F.lit(1), "id": F.lit("x"), "t": F.lit(2), "k": F.lit(3), "rep": F.lit(4), "label": F.lit(5), "mix_score": F.lit(6)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert all(r.h == 1 and r.id == "x" and r.mix_score == 6 and r.more == 0.5 for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).columns == [*docs.columns, "mix_path", "mix_tokens", "mix_copies"]
    assert last(spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_nulls_and_repeated_rows(spark, tmp_path, stage):
    rows, items = made()
    spark.createDataFrame([*items, (None, "x" * 40), (7, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = [(None, rows[0][1], None, None, None, None), (None, None, None, None, None, None), rows[1], rows[1], (2, "another text under a key that is taken", "en", "src1", 1, 0.1)]
    out = corpus_pipeline.STAGES[stage][1](spark, spark.createDataFrame(rows + odd, KIND), str(tmp_path)).collect()
    assert out and all(r.doc_id is None or r.doc_id < 55 for r in out)
