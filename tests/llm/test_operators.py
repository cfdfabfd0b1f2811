"""The training-data operators against brute force, round trips and edge cases, on small tables."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import chat, decontaminate, langid, lattice, licences, minhash, mixing, substrings, tokens, toxicity
from quillon.llm.common import Scratch, blobs, components

random.seed(3)
WORDS = ["the", "stone", "river", "of", "light", "moves", "under", "grey", "hills", "and", "small", "boats", "wait", "for", "rain", "at", "noon", "while", "birds", "sleep"]
DOCS = "doc_id long, text string, lang string, source string, score double, k string"


def prose(n, rng=random):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ed", "x", "ing"]) for _ in range(n))


def corpus():
    rng = random.Random(11)
    base, other = prose(300, rng), prose(120, rng)
    rows = [(i, prose(rng.randint(1, 80), rng)) for i in range(30)]
    near = base.split()
    rows += [(100, base), (101, base), (102, " ".join(near[:150] + ["changed"] + near[151:])), (103, base + "\n" + prose(20, rng)), (104, other + " " + base[:700]), (105, prose(40, rng) + " " + other)]
    rows += [(200, None), (201, ""), (202, "  \n\t "), (203, "One two"), (204, "one TWO"), (205, "é ü ñ"), (206, "... 123 !!"), (207, "ab" * 600), (208, "ab" * 500), (209, "x" * 30_000)]
    rows += [(300, base), (300, base), (None, base), (None, None)]
    return [(i, t, random.Random(str(i)).choice(["en", "fr", None]), "src1", 0.5, "k") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def removed(rows, length=400):
    """Brute force of the 400-byte rule, by rows."""
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[: len(r)] > 0
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def test_repeats_match_brute_force(spark, docs):
    rows = corpus()
    got = substrings.remove_repeats(docs, Scratch(spark)).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r[0], *x) for r, x in zip(rows, removed(rows), strict=True)), key=key)


def test_repeats_of_a_split_anchor_match_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    shared = prose(90, rng)
    rows = [(i, f"{prose(rng.randint(0, 60), rng)} {i} {shared} {prose(rng.randint(0, 60), rng)}", "en", "s", 0.0, "k") for i in range(60)]
    monkeypatch.setattr(substrings, "PART", 8)
    got = substrings.remove_repeats(spark.createDataFrame(rows, DOCS), Scratch(spark)).collect()
    assert sorted(map(tuple, got)) == sorted((r[0], *x) for r, x in zip(rows, removed(rows), strict=True))


def later_cut(rows, length):
    """Brute force: by rows in the order of ids, what is left when strings that an earlier document holds are cut."""
    seen, out = {}, {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for j in range(len(raw) - length + 1):
            if seen.setdefault(raw[j : j + length], i) != i:
                gone[j] += 1
                gone[j + length] -= 1
        kept = bytes(b for b, g in zip(raw, np.cumsum(gone)) if not g).decode(errors="ignore")
        if kept or not raw:
            out[i] = kept
    return out


@pytest.mark.parametrize("part", [2, 1200])
def test_first_documents_keep_their_strings(spark, monkeypatch, part):
    rng = random.Random(15)
    shared = [prose(30 + 8 * i, rng) for i in range(4)]
    rows = [(i, " ".join([prose(rng.randint(0, 50), rng), rng.choice(shared), prose(rng.randint(0, 9), rng), rng.choice([*shared, "ab " * 200, ""])]), "en", "s", 0.0, "k") for i in range(60)]
    rows += [(70, None, "en", "s", 0.0, "k"), (71, "", "en", "s", 0.0, "k"), (72, shared[2], "en", "s", 0.0, "k"), (73, "é" * 300, "en", "s", 0.0, "k"), (74, "x" + "é" * 300, "en", "s", 0.0, "k")]
    monkeypatch.setattr(substrings, "PART", part)
    got = substrings.cut_repeats(spark.createDataFrame(rows, DOCS), Scratch(spark), 150, True).collect()
    assert {r.doc_id: r.text or "" for r in got} == later_cut(rows, 150)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for n, letters in ((1, 2), (50, 1), (300, 2), (900, 4)):
        text = rng.integers(0, letters, n).astype(np.uint8)
        sa, rank = substrings.suffix_array(text)
        raw = text.tobytes()
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        lcp = substrings.common_prefixes(text, sa, rank, np.array([0]), np.array([n]), 40)
        for r in range(1, n):
            a, b = raw[sa[r - 1] :], raw[sa[r] :]
            want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            if max(sa[r], sa[r - 1]) + 40 <= n:
                assert lcp[r] == min(want, 40)


def test_long_row_is_scanned_in_slices(monkeypatch):
    from quillon.llm.common import Roller

    data = np.random.default_rng(1).integers(97, 101, 40_000).astype(np.uint8)
    whole = substrings.anchors(data, np.array([0, len(data)]), Roller())
    monkeypatch.setattr(substrings, "SLICE", 7000)
    parts = substrings.anchors(data, np.array([0, len(data)]), Roller())
    cover = lambda x: {(int(h), s) for h, a, b in zip(x[1], x[4], x[5]) for s in range(a, b + 1)}
    assert cover(whole) == cover(parts)


def test_repeats_edge_cases(spark, none):
    assert substrings.remove_repeats(none, Scratch(spark)).count() == 0
    cut = substrings.cut_repeats(spark.createDataFrame(corpus(), DOCS), Scratch(spark)).collect()
    assert {r.doc_id for r in cut} >= {200, 201, 202, 203} and all(r.score == 0.5 for r in cut)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked_components(rows, percent=75):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], []).append(shingles(r[1]))
    label = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((label[a], label[b]))
                label = {k: lo if v == hi else v for k, v in label.items()}
    return label


def test_near_duplicates_match_brute_force(spark, docs):
    rows, got = corpus(), minhash.link(docs, Scratch(spark)).collect()
    label = linked_components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == label.get(r.doc_id) and r.kept == (r.doc_id == r.component_id or r.doc_id is None)
    assert {(r.doc_id, r.n_shingles) for r in got if r.doc_id is not None} == {(r[0], len(shingles(r[1]))) for r in rows if r[0] is not None}


@pytest.mark.parametrize("rate", [0.03, 0.055])
def test_near_duplicates_of_a_large_group(spark, rate):
    """Variants at the bound: stars, tight neighbours and cluster tasks together find every component."""
    rng = random.Random(int(rate * 1000))
    base = [f"w{rng.randint(0, 5000)}" for _ in range(80)]
    rows = []
    for i in range(150):
        text = [w if rng.random() > rate else f"v{rng.randint(0, 10**6)}" for w in base]
        rows.append((i, " ".join(text), "en", "s", 0.0, "k"))
    got = {r.doc_id: r.component_id for r in minhash.link(spark.createDataFrame(rows, DOCS), Scratch(spark)).collect()}
    assert got == linked_components(rows)


def test_near_duplicates_of_far_signatures_that_share_a_key(spark):
    """Pairs at the bound exactly whose signatures differ in over 13 of 28 symbols, by seeds."""
    from quillon.llm.common import Roller

    far = [89, 111, 484, 573]
    rows, n = [], minhash.CHUNKS * minhash.SYMBOLS
    for seed in far:
        rng = random.Random(seed)
        words = lambda k, rng=rng: " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(k))
        base = words(604)
        rows += [(2 * seed, base + " " + words(100)), (2 * seed + 1, base + " " + words(100))]
    rows = [(i, t, "en", "s", 0.0, "k") for i, t in rows]
    [(_, _, data, off)] = blobs(pa.array([r[1] for r in rows], pa.large_string()))
    s = minhash.signatures(*minhash.shingle_sets(data, off, Roller()))[0].view(np.uint16).reshape(len(rows), n)
    assert all((s[i] != s[i + 1]).sum() > 13 and minhash.meeting(s[i], s[i + 1 : i + 2]).all() for i in range(0, len(rows), 2))
    assert not minhash.meeting(s[0], s[2:3]).any()
    got = {r.doc_id: r.component_id for r in minhash.link(spark.createDataFrame(rows, DOCS), Scratch(spark)).collect()}
    assert got == linked_components(rows) and all(got[2 * x + 1] == 2 * x for x in far)


def test_near_duplicates_edge_cases(spark, none):
    assert minhash.link(none, Scratch(spark)).count() == 0
    kept = minhash.keep_one(spark.createDataFrame(corpus(), DOCS), Scratch(spark)).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 100 in ids and not {101, 102, 103, 300} & set(ids) and 204 not in ids


def test_one_document_of_each_group_is_kept_row_by_row(spark):
    rng = random.Random(19)
    a, b, c = (prose(60, rng) for _ in range(3))
    rows = [(1, a), (2, b), (2, a), (3, c), (3, c), (4, c + " more"), (None, a), (5, None), (5, ""), (2, b)]
    docs = spark.createDataFrame([(*r, "en", "s", 0.0, "k") for r in rows], DOCS)
    kept = minhash.keep_one(docs.withColumns({"x": F.lit(1), "_d": F.lit(2)}), Scratch(spark))
    assert kept.columns == [*docs.columns, "x", "_d"]
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in [(1, a), (2, b), (3, c), (None, a), (5, None), (5, "")])


def test_words_of_a_long_row_in_pieces(monkeypatch):
    from quillon.llm.common import Roller

    data = np.frombuffer((prose(100) + " " + "y" * 300).encode() * 20_000, np.uint8)
    _, a = minhash.words(data, np.array([0, len(data)]), Roller())
    _, b = minhash.words(np.concatenate([data[:9_000_000], data[9_000_000:]]), np.array([0, len(data), len(data)]), Roller())
    assert (a == b).all()


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if k in got} and set(got) >= {a for a, b in edges if a != b}


TURNS = "conv_id long, turn long, role string, text string, loss string"


def test_chat_round_trip(spark):
    said = ["", None, "hi", r"\### Assistant: </turn> ok", "####", "a\\", "</turn>\n### user: x", "#\\#", "é\U0001f600 </", "line\n\n" * 200, "word " * 900, "\\\\n#"]
    rng = random.Random(1)
    rows = []
    for c in range(25):
        n = rng.randint(1, 30)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2] if c % 5 else rng.choice(["a: b", None, "assistant", "### x"])
            rows.append((c, t, role, rng.choice(said), "z"))
    rows += [(30, 1, "user", "same", "z")] * 3 + [(None, None, None, None, "z")]
    windows = chat.format_chats(spark.createDataFrame(rows, TURNS), 128, 32).cache()
    got = {r.conv_id: r for r in chat.digest(windows).collect()}
    by = {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((t or 0, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        lost = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    over = windows.where("tokens > 128 and n_turns > 1").count()
    assert over == 0
    later = sorted(windows.where("conv_id = 0").collect(), key=lambda r: r.window)[1:]
    assert later and all(r.formatted.startswith("### system: ") and r.n_repeated >= 1 for r in later)
    assert chat.digest(chat.format_chats(spark.createDataFrame([], TURNS))).count() == 0


def test_chat_main_path_is_native(spark):
    plan = chat.digest(chat.format_chats(spark.createDataFrame([(1, 0, "user", "x", "z")], TURNS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def edit(text, k, rng):
    t = list(text)
    for _ in range(k):
        i = rng.randrange(len(t))
        kind = rng.choice("sid")
        if kind == "s":
            t[i] = "q"
        elif kind == "d":
            del t[i]
        else:
            t.insert(i, "z")
    return "".join(t)


def test_decontamination_finds_edits_and_leaves_clean_texts(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(rng.randint(80, 400))) for i in range(30)] + [(90, None), (91, ""), (92, "short")]
    rows, want = [], set()
    for i in range(80):
        body = text(rng.randint(0, 900))
        if i % 2:
            item, x = items[i % 30]
            n = len(x.encode())
            cut = rng.randint(0, len(body))
            body = body[:cut] + " " + edit(x, int(n * 0.05) if n < 144 else 3, rng).upper() + " " + body[cut:]
            want.add((i, item))
        rows.append((i, body, "en", "s", 0.0, "k"))
    rows += [(500, None, "en", "s", 0.0, "k"), (501, "", "en", "s", 0.0, "k"), (502, "short", "en", "s", 0.0, "k"), (None, items[0][1], "en", "s", 0.0, "k")]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, bench, Scratch(spark)).collect()}
    assert {g for g in got if g[0] is not None} == want
    kept = decontaminate.drop_contaminated(docs, bench, Scratch(spark))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {i for i, _ in want} - {None}
    assert decontaminate.find(docs.limit(0), bench, Scratch(spark)).count() == 0 and decontaminate.find(docs, bench.limit(0), Scratch(spark)).count() == 0


def test_decontamination_judges_rows_that_share_a_doc_id(spark):
    rng = random.Random(14)
    item, clean = (" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20)) for _ in range(2))
    rows = [(1, clean, "en", "s", 0.0, "a"), (1, "x " + item, "en", "s", 0.0, "b"), (2, item, "en", "s", 0.0, "c"), (3, None, "en", "s", 0.0, "d"), (1, clean, "en", "s", 0.0, "e")]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(spark.createDataFrame(rows, DOCS), bench, Scratch(spark))
    assert sorted(tuple(r) for r in kept.collect()) == sorted((r for r in rows if r[5] in "ade"), key=lambda r: (r[0], r[1] or "", r[5]))


def edits(p: bytes, t: bytes) -> int:
    """Least edit distance of p to a substring of t, by the full table."""
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p):
        new = [i + 1]
        for j, y in enumerate(t):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_matches_brute_force():
    """Every item of one segment that is within its budget of a text is found, and no other, with its distance."""
    rng = random.Random(21)
    found = 0
    for letters in ("ab", "abcdef  ", "ab cdefghijklmnopqrstuvwxyz"):
        items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(12, 60))).encode()) for i in range(25)] + [(30, b"ab" * 20), (31, b"-" * 40)]
        ix = decontaminate.index(items)
        for _ in range(15):
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 150)))
            for item in rng.sample(items, 3):
                t += edit(item[1].decode(), rng.randint(0, 3), rng) + rng.choice(["", "abababababab" * 5, "-" * 80, " \n "])
            raw = np.frombuffer(t.encode(), np.uint8)
            got = {}
            for _, item, a, b, d in decontaminate.search(ix, raw, np.array([0, len(raw)])):
                assert 0 <= a < b <= len(raw)
                got[item] = min(d, got.get(item, 99))
            folded = decontaminate.fold(raw, np.array([0, len(raw)]))[0].tobytes()
            for (item, _), p, k in zip([x for x in items if x[0] in ix.items], ix.texts, ix.budget, strict=True):
                best = edits(p.tobytes(), folded)
                assert (item in got) == (best <= k) and got.get(item, best) == best
                found += item in got
    assert found > 100


def test_decontamination_of_repetitive_text_is_bounded():
    """A megabyte of one byte, of two by turns and of blanks, against items with long runs of them."""
    import time
    import tracemalloc

    items = [(1, b"x" * 300), (2, b"begin " + b" " * 300 + b"end"), (3, b"ab" * 200), (4, b"=" * 40 + b" title of the section " + b"=" * 40)]
    ix = decontaminate.index(items)
    for text, want in ((b"x" * 1_000_000, {1}), (b" " * 1_000_000, set()), (b"ab" * 500_000, {3}), (b"=" * 1_000_000, set()), (b"x " * 500_000, set())):
        raw, began = np.frombuffer(text, np.uint8), time.time()
        tracemalloc.start()
        got = decontaminate.search(ix, raw, np.array([0, len(raw)]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert {g[1] for g in got} == want and peak < 500e6 and time.time() - began < 60
        assert not want or (len(got) == 1 and got[0][2] < 300 and got[0][3] > 999_700)


def test_decontamination_in_blocks_and_slices(spark, monkeypatch):
    rng = random.Random(31)
    items = [(i, prose(30, rng)) for i in range(12)]
    rows = [(str(i), prose(40, rng) + " " + (items[i][1] if i < 12 else "") + " " + prose(5000 if i == 3 else 20, rng)) for i in range(20)]
    docs, bench = spark.createDataFrame(rows, "name string, body string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 500)
    got = decontaminate.find(docs, bench, Scratch(spark), key="name", text="body").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(str(i), i) for i in range(12)}
    assert {r.name for r in decontaminate.drop_contaminated(docs, bench, Scratch(spark), text="body").collect()} == {str(i) for i in range(12, 20)}
    monkeypatch.setattr(decontaminate, "SLICE", 3000)
    raw = np.frombuffer((prose(900, rng) + items[5][1] + prose(900, rng) + items[5][1]).encode(), np.uint8)
    found = decontaminate.search(decontaminate.index([(i, t.encode()) for i, t in items]), raw, np.array([0, len(raw)]))
    assert [f[1] for f in found] == [5, 5] and all(f[4] <= 1 for f in found)


def test_banded_alignment_matches_full():
    rng = random.Random(8)
    for _ in range(60):
        p = [rng.randint(0, 3) for _ in range(rng.randint(1, 20))]
        t = [rng.randint(0, 3) for _ in range(len(p) + rng.randint(0, 12))]
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p):
            new = [i + 1]
            for j, y in enumerate(t):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        got = decontaminate.banded(np.array([p], np.uint8), np.array([len(p)]), np.array([t], np.uint8))[0]
        assert got >= min(row) and (len(t) - len(p) < 2 * min(row) or got <= min(row) + len(p))
    p = np.frombuffer(b"segment of text", np.uint8)
    t = np.frombuffer(b"xx segmnt off text yy", np.uint8)
    assert decontaminate.banded(p[None], np.array([len(p)]), t[None])[0] == 2


def test_mixing_budgets():
    have = {("a", "en", "s1"): 100, ("a", "en", "s2"): 1000, ("a", "de", "s3"): 10, ("b", "en", "s4"): 5000}
    got = mixing.budgets(have, {("a",): 1.0, ("b",): 1.0}, 1200, 2)
    assert sum(got.values()) == 1200 and got[("b", "en", "s4")] == 600 and got[("a", "de", "s3")] == 20 and got[("a", "en", "s1")] == 200 and got[("a", "en", "s2")] == 380
    assert mixing.budgets(have, {}, 10**9, 1) == have and mixing.budgets({}, {}, 10, 1) == {}
    short = mixing.budgets(have, {("a",): 9.0, ("b",): 1.0}, 4000, 1)
    assert short[("a", "en", "s2")] == 1000 and short[("b", "en", "s4")] == 2890


def dealt(total, weights, room):
    """Water level: each child gets weight * level, its room at most, with the level at which the total is reached."""
    total = min(total, sum(r for w, r in zip(weights, room) if w > 0))
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(w * mid, r) for w, r in zip(weights, room)) < total else (lo, mid)
    return [min(w * hi, r) for w, r in zip(weights, room)]


def dealt_tree(have, weights, total, epochs):
    room, got = {}, {(): total}
    for p, n in have.items():
        for d in range(len(p) + 1):
            room[p[:d]] = room.get(p[:d], 0) + n * epochs
    got[()] = min(total, room[()])
    for d in range(len(next(iter(have)))):
        for node in [x for x in got if len(x) == d]:
            kids = sorted({p[: d + 1] for p in have if p[:d] == node})
            got |= dict(zip(kids, dealt(got[node], [weights.get(k, 1.0) for k in kids], [room[k] for k in kids])))
    return {p: int(got[p] + 1e-6) for p in have}


def test_mixing_takes_the_seeded_prefix(spark, monkeypatch):
    rng = random.Random(12)
    langs, sources = ["en", "fr", None, "a\x1fb", "a\x1e1b"], ["s0", "s1", "s2", "s\x1e"]
    rows = [(i, prose(1 + i % 40, rng), langs[i % 5], sources[i % 4], float(i), "k") for i in range(600)] + [(900, None, "en", "s1", 0.0, "k"), (901, " ", "en", "s1", 0.0, "k")] + [(7, prose(9, rng), "fr", "s3", 0.0, "k")] * 2 + [(None, "no key", "en", "s1", 0.0, "k")]
    d = spark.createDataFrame(rows, DOCS).withColumns({"mix_score": F.col("score"), "mix_tokens": F.lit("z"), "whole_": F.lit(1), "h": F.lit(2)})
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {("en",): 3.0, ("fr", "s1"): 5.0}
    monkeypatch.setattr(mixing, "BITS", 3)
    out = mixing.mix_sources(d, levels, weights, Scratch(spark), 1.4, 4, 17)
    assert sorted(out.columns) == sorted([*(c for c in d.columns if c != "mix_tokens"), "mix_path", "mix_tokens", "mix_copies"])
    got = {}
    for r in out.collect():
        assert r.mix_score == r.score and r.mix_tokens == len(r.text.split())
        got.setdefault(mixing.parts_of(r.mix_path), []).append(r)
    have, members = {}, {}
    for r in rows:
        if n := len((r[1] or "").split()):
            p = (r[2] or "", r[3])
            have[p] = have.get(p, 0) + n
            members.setdefault(p, []).append((r[0], n))
    plan = dealt_tree(have, weights, 1.4 * sum(have.values()), 4)
    cut = 0
    for p, b in plan.items():
        whole, left = divmod(b, have[p])
        ids = sorted({i for i, _ in members[p]}, key=str)
        hashes = spark.createDataFrame([(i, str(i) if i is not None else None) for i in ids], "id long, s string").selectExpr("id", f"xxhash64(17, bigint({whole}), s) h").collect()
        h = {r.id: r.h % 2**64 for r in hashes}
        want, total = {}, 0
        for x in sorted((i for i in ids), key=lambda i: (h[i], str(i))):
            total += sum(n for i, n in members[p] if i == x)
            want[x] = whole + (total <= left)
            cut += total > left
        assert {r.doc_id: r.mix_copies for r in got.get(p, [])} == {k: v for k, v in want.items() if v}
    assert cut > 50 and mixing.mix_sources(d.limit(0), levels, {}, Scratch(spark)).count() == 0


def test_language_codes_and_decoding():
    for k in (2, 3, 4, 5, 9):
        m = langid.codewords(k)
        apart = [(m[i] != m[j]).sum() for i in range(k) for j in range(i)]
        assert min(apart) >= (1 if k == 2 else 2)
        book = langid.Codebook([str(i) for i in range(k)], m, np.zeros((8, m.shape[1]), np.float32), np.zeros(m.shape[1]), np.ones(m.shape[1]), 0.05)
        best, score, flag = langid.decode(book, m * 1.0)
        assert best.tolist() == list(range(k)) and (score > 0.3).all() and not flag.any()
    assert langid.decode(book, np.zeros((1, m.shape[1])))[2][0]


def test_language_held_out_accuracy_and_edge_cases(spark, none):
    said = {"en": "the and of with that house water", "fr": "le la des avec maison être été", "de": "der die und mit haus größe über", "es": "el los con casa año niño está"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(v.split()) for _ in range(12)), lang, "s", 0.0, "k") for i in range(400) for lang, v in [rng.choice(list(said.items()))]]
    rows += [(1000, None, "en", "s", 0.0, "k"), (1001, "", "en", "s", 0.0, "k"), (1002, "12 ... !!", "fr", "s", 0.0, "k"), (1003, "maison " * 300_000, None, "s", 0.0, "k"), (None, "haus und größe", "de", "s", 0.0, "k")]
    d = spark.createDataFrame(rows, DOCS)
    got = langid.predict(d, langid.learn(d, langid.third() != 1)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(got) == len(rows) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in got}
    assert by[1000].lang_pred == by[1001].lang_pred == by[1002].lang_pred == "und" and by[1000].score == 0 and by[1003].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.predict(none, langid.learn(none, langid.third() != 1)).count() == 0
    kept = langid.keep_known(d, langid.learn(d, langid.third() != 1))
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {1000, 1001, 1002}


def test_language_learns_the_least_rows_of_many_languages(spark):
    rng = random.Random(16)
    rows = [(f"d{i}", prose(8, rng), f"l{i % 210}" if i % 9 else None) for i in range(2400)] + [("d5", "again the same key", "l5"), (None, "no key here", "l7"), ("e", "", "l1"), ("f", None, "l2"), ("g", "12 34", "l3")]
    d = spark.createDataFrame(rows, "name string, body string, tongue string").repartition(7)
    seen = {}
    fit, langid.fit = langid.fit, lambda texts, langs: seen.update(rows=sorted(zip(langs, texts))) or fit(texts[:20], langs[:20])
    try:
        langid.learn(d, F.lit(True), 3, text="body", lang="tongue", key="name")
    finally:
        langid.fit = fit
    h = {r.s: r.h for r in spark.createDataFrame([(r[0],) for r in rows if r[0]], "s string").distinct().selectExpr("s", "xxhash64(s) h").collect()} | {None: 42}
    want = []
    for lang in {r[2] for r in rows if r[2]}:
        own = sorted({(h[k], k or "", t) for k, t, v in rows if v == lang and t and any(c.isalpha() for c in t)})
        want += [(lang, t) for _, _, t in own[:3]]
    assert [x for x in seen["rows"]] == sorted(want) and len({v for v, _ in want}) == 210
    none = langid.learn(d, F.lit(False), text="body", lang="tongue", key="name")
    kept = langid.keep_known(d, none, "body", "tongue")
    assert kept.schema == d.schema and kept.count() == len(rows) - 3
    assert {r.lang_pred for r in langid.predict(d, none, "body", "name").collect()} == {"und"}


def test_language_stage_rejects_what_is_ambiguous_and_fills_in(spark):
    said = {"en": "the and of with that house water", "fr": "le la des avec maison"}
    rng = random.Random(17)
    rows = [(i, " ".join(rng.choice(v.split()) for _ in range(12)), lang) for i in range(200) for lang, v in [rng.choice(list(said.items()))]]
    rows += [(300, "the house of water", None), (301, "la maison avec", None), (302, "the the la la", "en"), (303, None, "en"), (304, "??", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    book = langid.learn(d, F.col("doc_id") < 200)
    unsure = {r.doc_id for r in langid.predict(d, book).where("is_ambiguous").collect()}
    got = {r.doc_id: r.lang for r in langid.keep_known(d, book).collect()}
    assert got[300] == "en" and got[301] == "fr" and got[302] == "en" and not {303, 304} & set(got) and set(range(200)) <= set(got)
    book.ambiguous_below = 9.0
    assert set(r.doc_id for r in langid.keep_known(d, book).collect()) == set(range(200)) | {302} and not unsure & {300, 301}


def test_toxicity_finds_disguised_words_and_edge_cases(spark, none):
    rng = random.Random(6)
    bad = ["blorgface", "snarfwit", "muckhead"]
    rows, labels = [], []
    for i in range(900):
        text = prose(rng.randint(5, 40), rng).split()
        if toxic := i % 4 == 0:
            w = rng.choice(bad)
            if rng.random() < 0.3:
                w = rng.choice([".".join(w), w[:4] + "x" + w[4:], w.replace("a", "4").upper()])
            text.insert(rng.randrange(len(text)), w)
        rows.append((i, " ".join(text), "en", "s", 0.0, "k"))
        labels.append((i, 1, int(toxic), "t"))
    rows += [(2000, None, "en", "s", 0.0, "k"), (2001, "", "en", "s", 0.0, "k"), (2002, "word " * 1_000_000 + "snarfwit", "en", "s", 0.0, "k"), (2003, "s n a r f w i t", "en", "s", 0.0, "k"), (None, "calm", None, None, None, None)]
    d = spark.createDataFrame(rows, DOCS)
    y = spark.createDataFrame([*labels, (5, 1, None, "t"), (None, 0, 1, "t"), labels[0]], "doc_id long, quality int, toxic int, text string")
    model = toxicity.learn(d, y, toxicity.fifth() != 0)
    got = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= 0.5) == (i % 4 == 0) for i in held)
    assert len(got) == len(rows) and right >= 0.95 * len(held) and all(0 <= s <= 1 for s in got.values())
    assert got[2002] > 0.5 and got[2003] > 0.5 and got[2000] < 0.5 and got[2000] == got[2001]
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.learn(none, y.limit(0), toxicity.fifth() != 0)
    assert all(0 <= r.score <= 1 for r in toxicity.score(d, empty).collect())


def test_string_kernel_weights_agree_with_look_up():
    rng = np.random.default_rng(0)
    table = rng.normal(size=32768).astype(np.float32)
    for w in ("a", "cat", "stone wall", "Ünïcode", "i d i o t"):
        raw = np.frombuffer(w.encode(), np.uint8)
        s, place, _ = toxicity.stream(raw, np.array([0, len(raw)]))
        d = toxicity.decisions(s, place, table)
        for k, (a, b) in enumerate(zip(place, place[1:])):
            at, v = toxicity.features(s[a + 1 : b].tobytes())
            assert abs(d[k] - (table[at] * v).sum()) < 1e-3


def plain_kernel(a: str, b: str) -> float:
    """The kernel by its definition: the two words' subsequences of three symbols within SPAN + 1 places, counted."""
    import itertools

    def weights(w):
        s, out, total = "^" + w + "^", {}, 0.0
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i <= toxicity.SPAN:
                v = float(toxicity.DECAY) ** (k - i)
                key = (s[i], s[j], s[k])
                out[key] = out.get(key, 0.0) + v
                total += v * v
        return out, total**0.5

    (x, p), (y, q) = weights(a), weights(b)
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / (p * q)


def test_string_kernel_matches_its_definition():
    fold = lambda w: bytes(toxicity.FOLD[np.frombuffer(w.encode(), np.uint8)])

    def kernel(a, b):
        dense = np.zeros((2, 32768))
        for row, w in zip(dense, (a, b)):
            at, v = toxicity.features(fold(w))
            np.add.at(row, at, v)
        return dense[0] @ dense[1]

    words = ["snarfwit", "snarxfwit", "snar.fwit".replace(".", ""), "wits", "aaa", "a", "banana", "x" * 90, "ab" * 60]
    for a in words:
        for b in words:
            assert abs(kernel(a, b) - plain_kernel(a, b)) < 1e-4
    assert kernel("snarfwit", "snarxfwit") > 0.6 > kernel("snarfwit", "banana")


def test_toxicity_of_a_long_text_without_blanks(monkeypatch):
    table = np.random.default_rng(1).normal(size=32768).astype(np.float32)
    model = toxicity.Model(table, 0.0, 1.0, 0.0)
    text = np.frombuffer(("a" * 50 + "bcd " + "xyz" * 900 + " end " + "q" * 3000).encode(), np.uint8)
    whole = toxicity.highest(text, np.array([0, len(text)]), model)
    monkeypatch.setattr(toxicity, "LONG", 200)
    assert np.allclose(toxicity.highest(text, np.array([0, len(text)]), model), whole, atol=1e-4)


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)) * 2
    p, r = lattice.nearest(x), lattice.roots()
    assert len(r) == 240 and np.allclose((r**2).sum(1), 2)
    assert np.allclose((2 * p) % 1, 0) and (p.sum(1) % 2 < 1e-9).all()
    d = ((x - p) ** 2).sum(1)
    assert (d[:, None] <= ((x[:, None] - p[:, None] - r[None]) ** 2).sum(2) + 1e-9).all()


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for _ in range(60):
        v = rng.normal(size=24)
        for _ in range(rng.integers(1, 7)):
            u = v + rng.normal(size=24) * rng.choice([0, 0.05, 0.1, 0.13])
            rows.append((i, [float(np.float32(x)) for x in u], int(rng.integers(0, 2)), "z"))
            i += 1
    same = rows[0]
    rows += [(i, same[1], same[2], "z"), (i + 1, None, 1, "z"), (i + 2, [0.0] * 24, 1, "z"), (i + 3, [float("nan")] * 24, 1, "z"), (i + 4, [None] + [1.0] * 23, 1, "z"), (i + 5, same[1], None, "z"), (i + 6, [], 0, "z"), (i + 7, same[1][:8], same[2], "z"), (i + 8, [x * 3 for x in same[1]], same[2], "z"), (i + 9, [float("inf")] * 24, 0, "z"), rows[4]]
    got = {r.vec_id: r for r in lattice.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string"), Scratch(spark)).collect()}
    ok = {}
    for v, e, label, _ in rows:
        if e and label is not None and None not in e and np.isfinite(e).all() and np.any(e):
            ok[v] = (label, np.array(e, np.float32).astype(float))
    links = {v: set() for v in got}
    for a in ok:
        for b in ok:
            if a != b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] / (np.linalg.norm(ok[a][1]) * np.linalg.norm(ok[b][1])) >= 0.98:
                links[a].add(b)
    have = sum(r.n_links for r in got.values())
    assert len(got) == len({r[0] for r in rows}) and have >= 0.99 * sum(map(len, links.values()))
    assert all(got[v].n_links <= len(links[v]) for v in got)
    for v in got:
        seen, todo = {v}, [v]
        while todo:
            for u in links[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        assert got[v].component_id == min(seen) and got[v].kept == (v == min(seen))
    assert lattice.link(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), Scratch(spark)).count() == 0


def test_embedding_links_of_extreme_components_and_repeated_ids(spark):
    v, w = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1]
    rows = [(1, [x * 1e200 for x in v], 0), (2, w, 0), (3, [x * 1e-200 for x in v], 0), (4, [x * 5e-324 for x in v], 0), (5, [-x for x in v], 0)]
    rows += [(6, [9.0, -1.0, 0.0, 0.0], 0), (6, [0.0, 0.0, 1.0, -5.0], 0), (7, [9.1, -1.0, 0.0, 0.0], 0), (8, [0.0, 0.0, 1.0, -5.1], 0), (6, [9.0, -1.0, 0.0, 0.0], 0)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), Scratch(spark)).collect())
    assert got == [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True), (6, 1, 6, True), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 6, False)]


def test_token_attribution():
    size = np.array([0, 5, 6, 9], np.int64)
    count, over = tokens.attribute(np.array([2, 5, 7, 9, 12]), size, 12)
    # tokens [0,2) [2,5) [5,7) [7,9) [9,12): the third shares a byte with two sections and goes to the first
    assert count.tolist() == [2, 1, 1, 1] and over == 1
    assert tokens.attribute(np.array([8]), np.array([0, 3]), 8)[0].tolist() == [0, 1]
    assert tokens.attribute(np.zeros(0, int), np.array([0]), 0)[0].tolist() == [0]


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
def test_token_counts_add_up(spark, docs, none):
    encoder = tokens.Encoder()
    for r in tokens.count_tokens(docs, ["source", "text"]).collect():
        assert sum(s.tokens for s in r.sections) == r.n_tokens and r.sections[0].start == 0 and r.sections[-1].stop == r.n_bytes
        assert all(a.stop == b.start for a, b in zip(r.sections, r.sections[1:]))
    text = "Héllo wörld\n\n  twice 123"
    ends = encoder.ends(text)
    assert ends[-1] == len(text.encode()) and b"".join(text.encode()[a:b] for a, b in zip([0, *ends], ends)).decode() == text
    assert tokens.count_tokens(none, ["text"]).count() == 0


def plain_bpe(text: str, ranks: dict, pattern: str) -> list[bytes]:
    """Byte-pair encoding by its definition: in each pre-token the pair of least rank merges first."""
    import regex

    out = []
    for word in regex.findall(pattern, text):
        parts = [bytes([b]) for b in word.encode()]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        out += parts
    return out


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
def test_token_counts_match_brute_force(spark):
    import base64

    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    rng = random.Random(18)
    rows = [(i, "\n".join(prose(rng.randint(0, 12), rng) + rng.choice(["", " é\U0001f600x", "  123", "\t\t"]) for _ in range(rng.randint(1, 6))), rng.choice(["src1", None, "a b"])) for i in range(60)]
    rows += [(90, None, None), (91, "", ""), (92, "word " * 200_000 + "\nend", "s"), (None, "x", "y")]
    got = {r.doc_id: r for r in tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, source string"), ["source", "text"]).collect()}
    assert len(got) == len(rows) and got[92].n_tokens > 200_000 and sum(s.tokens for s in got[92].sections) == got[92].n_tokens
    for i, text, source in rows:
        if i == 92:
            continue
        pieces = plain_bpe(f"{source or ''}\n{text or ''}", ranks, tokens.PATTERN)
        starts = [s.start for s in got[i].sections] + [got[i].n_bytes]
        want, at, crossing = [0] * (len(starts) - 1), 0, 0
        for p in pieces:
            held = [max(0, min(at + len(p), b) - max(at, a)) for a, b in zip(starts, starts[1:])]
            want[held.index(max(held))] += 1
            crossing += sum(h > 0 for h in held) > 1
            at += len(p)
        assert [s.tokens for s in got[i].sections] == want and got[i].n_tokens == len(pieces) and got[i].n_crossing == crossing


def test_licences(spark):
    rows = [
        ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0.\nmore"), ("a/b/c/x", "nothing"), ("a/y", None), ("a/b/c/z", "Some text\nReleased under the MIT License.\n"), ("LICENSE", "Released under the MIT License."),
        (None, "Licensed under CC BY-NC 4.0."), ("", ""), ("d/e", "a licensed plumber came by at the usual hour and left"), ("a/bc/q", "x"), ("a/b/c/d/e/f", "x " * 300_000), ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0.\nmore"),
    ]
    files = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, licence string")
    got = {r.doc_id: (r.licence, r.how, r.origin) for r in licences.licences(files, Scratch(spark)).collect()}
    assert got[0] == ("Apache-2.0", "header", None) and got[1] == ("Apache-2.0", "inherited", "a/b") and got[2] == (None, "none", None) and got[3][:2] == ("MIT", "header")
    assert got[4][:2] == ("MIT", "header") and got[5][:2] == ("CC-BY-NC-4.0", "header") and got[6] == (None, "none", None) and got[7][1] == "none" and got[8][1] == "none" and got[9] == ("Apache-2.0", "inherited", "a/b")
    assert len(got) == len(rows) and licences.licences(files.limit(0), Scratch(spark)).count() == 0
    plan = licences.licences(files, Scratch(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_licence_line_of_the_fixture_is_found(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "Proprietary", "Released under the MIT License.": "MIT",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    rows = [(i, f"d/f{i}", f"{prose(20)}\n{x}\n{prose(9)}") for i, x in enumerate(lines)] + [(9, "d/f9", "Released under the MIT License.\nAll rights reserved."), (10, "d/f10", prose(20))]
    got = {r.doc_id: (r.licence, r.how) for r in licences.licences(spark.createDataFrame(rows, "doc_id long, path string, text string"), Scratch(spark)).collect()}
    assert [got[i] for i in range(len(lines))] == [(x, "header") for x in lines.values()]
    assert got[9] == ("MIT", "header") and got[10][0] != "Proprietary"


def test_licence_query_inherits_from_nearest_directory(spark, tmp_path):
    mit, gpl = "words\nReleased under the MIT License.\n", "words\nThis work is licensed under the GNU General Public License, version 3.\n"
    texts = {2: mit, 1: gpl, 500: "Some words", 6: "in the hundred, a twenty below", 7: None, 8: "", 9: "of the thousand", 300: "x", 1500: "elsewhere"}
    spark.createDataFrame([(i, t, "other" if i == 300 else "src") for i, t in texts.items()], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in licences.query(spark, str(tmp_path)).collect()}
    files = {i: (r.path, t) for (i, t), r in zip(sorted(texts.items()), [got[i] for i in sorted(texts)], strict=True)}
    lines = {"src/t0": "MIT", "src/t0/h0": "GPL-3.0"}
    assert (got[2].path, got[1].path) == ("src/t0/LICENSE.2", "src/t0/h0/LICENSE.1") and {r.path.count("/") for r in got.values()} == {2, 3, 4}
    for i, (path, text) in files.items():
        if text in (mit, gpl):
            assert got[i].how == "header"
            continue
        above = path.split("/")[:-1]
        near = next((d for n in range(len(above), 0, -1) if (d := "/".join(above[:n])) in lines), None)
        assert (got[i].licence, got[i].how, got[i].origin) == (lines.get(near), "inherited" if near else "none", near)
    assert {r.origin for r in got.values()} == {None, "src/t0", "src/t0/h0"}


def test_blobs_cover_rows():
    column = pa.array(["a", None, "", "é" * 10, "x" * 50, "b"])
    got = b"".join(d.tobytes() for _, _, d, _ in blobs(column, 16, 2))
    assert got == ("a" + "é" * 10 + "x" * 50 + "b").encode()
    assert [(lo, hi) for lo, hi, _, _ in blobs(column.slice(1), 1000, 2)] == [(0, 2), (2, 4), (4, 5)]
