"""Decontamination, hard negatives and spelling variants against brute force, with odd rows, ties and several blocks."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.llm import _common, decontamination, hard_negatives, spelling_variants

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination ------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def leaks():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdeÑñé9") for _ in range(r.randint(1, 5))) for _ in range(60)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, say(r.randint(3, 40))) for i in range(12)]
    items += [(20, "Two words"), (21, "lone9"), (22, None), (23, " .,; "), (24, items[0][1]), (24, say(14)), (25, "x" * 300 + " " + say(9)), (None, say(10)), (26, say(12) + " " + say(12))]
    texts = [say(r.randint(0, 60)) for _ in range(20)]
    for _, t in items:
        w = (t or "").split()
        cut = r.randint(0, max(0, len(w) - 10))
        texts += [say(5) + ", " + (t or "").upper().replace(" ", " -- ") + "!\n" + say(4), say(3) + "\t" + " ".join(w[cut : cut + 11]) + "…" + say(2), " ".join(w[:9]) + " zz " + " ".join(w[9:])]
    texts += [None, "", " \n", "é" * 5000, "lone9 lone9", items[5][1] + " " + items[5][1], " ".join(items[6][1].split()[:5]), " ".join(items[6][1].split()[5:])]
    return [(i if i % 9 else None, t, "n", i) for i, t in enumerate(texts)], items


def covered(text, items, window=10):
    w = re.findall(WORD, lower(text))
    hit, found = set(), set()
    for item, t in items:
        q = re.findall(WORD, lower(t))
        for a in range(max(1, len(q) - window + 1) if q else 0):
            g = q[a : a + window]
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    if item is not None:
                        found.add(str(item))
    return len(w), hit, sorted(found)


@pytest.mark.parametrize("block", [4_000_000, 400])
def test_decontamination(spark, leaks, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    docs, items = leaks
    frame = spark.createDataFrame(docs, "doc_id long, text string, items string, hits int").repartition(3)
    rows = decontamination.find(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(docs)
    left = collections.Counter((d[0], d[1]) for d in docs)
    for r in rows:
        left[r.doc_id, r.text] -= 1
        n, hit, found = covered(r.text, items)
        assert (r.n_words, {k for h in r.hits for k in range(h.first, h.last + 1)}, r.items) == (n, hit, found)
        for h in r.hits:  # places in the text as it is
            assert re.findall(WORD, lower(r.text[h.start : h.end])) == re.findall(WORD, lower(r.text))[h.first : h.last + 1]
            assert h.start == 0 or not re.match(WORD, lower(r.text[h.start - 1])) or not re.match(WORD, lower(r.text[h.start]))
    assert set(left.values()) == {0}
    assert sum(bool(r.hits) for r in rows) > 20


def test_decontamination_cleans(spark, leaks):
    docs, items = leaks
    found = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string, items string, hits int"), spark.createDataFrame(items, "item_id long, text string"))
    for r in found.select("text", "hits", decontamination.cleaned(F.col("text"), F.col("hits")).alias("left"), decontamination.n_hit(F.col("hits")).alias("n")).collect():
        cut = {k for h in r.hits for k in range(h.start, h.end)}
        assert r.left == "".join(c for k, c in enumerate(r.text or "") if k not in cut)
        assert r.n == len(covered(r.text, items)[1])


def test_decontamination_of_nothing(spark, leaks):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(leaks[0], "doc_id long, text string, items string, hits int")
    assert decontamination.find(docs, none).where("size(hits) > 0 or size(items) > 0").count() == 0
    assert decontamination.find(docs.limit(0), spark.createDataFrame(leaks[1], "item_id long, text string")).count() == 0


# --- hard negatives -------------------------------------------------------------------------------------------------
def mined(rows, anchor, positives=5, negatives=3):
    """All scores, sorted."""
    q = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q.append((i, [math.floor(256 * x) for x in v], label))
    out = collections.Counter()
    for i, a, la in (r for r in q if anchor(r[0])):
        score = [(-sum(x * y for x, y in zip(a, v, strict=True)), j, lb) for j, v, lb in q if len(v) == len(a)]
        for p, j, _ in sorted(s for s in score if s[2] == la and s[1] != i)[:positives]:
            fit = sorted((n, k) for n, k, lb in score if lb != la and 50 * -p <= 100 * -n <= 95 * -p)[:negatives]
            for rank, (n, k) in enumerate(fit, 1):
                out[i, j, rank, k, -p, -n] += 1
    return out


def vectors_of(seed, n, size, copies):
    r = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=size) / 4], int(r.integers(0, 4))) for i in range(n)]
    hot = rows[1][1]
    rows += [(n + 7 * i, hot if i % 2 else [x * 0.8 for x in hot], i % 4) for i in range(copies)]
    rows += [(50, rows[50][1], 2), (50, rows[50][1], 2), (3, rows[3][1], 1), (10**15, rows[9][1], 1), (-400, rows[9][1], 0)]
    rows += [(n + 1, None, 1), (n + 2, [math.nan] * size, 1), (n + 3, [math.inf] * size, 1), (n + 4, [None] * size, 2), (n + 5, hot, None), (None, hot, 1), (n + 6, hot[:3], 1), (n + 8, [], 1), (n + 9, [1e9] * size, 1)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, score string, window int"


@pytest.mark.parametrize(("seed", "n", "size", "copies", "block"), [(1, 260, 6, 120, 1 << 19), (2, 150, 3, 300, 256), (3, 60, 5, 0, 1 << 19)])
def test_hard_negatives(spark, monkeypatch, seed, n, size, copies, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = [r for r in vectors_of(seed, n, size, copies) if r[1] is None or len(r[1]) < 4 or r[1][0] != 1e9]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(5)
    got = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0)
    want = mined(rows, lambda i: math.fmod(i, 10) == 0)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert len(want) > 30


def test_hard_negatives_of_nothing_and_of_large_numbers(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [2e6, 2e6], 2), (3, [1.0, 1.0], 2)]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)
    assert hard_negatives.mine(frame, F.col("vec_id") == 5).count() == 0
    most = math.isqrt((1 << 62) // 2)
    first = hard_negatives.mine(frame, F.col("vec_id") == 0, percents=(-100, 100)).orderBy("rank").first()
    assert first.positive_score == most * most + 256 * 512 and first.negative_score == most * 256 * 2_000_000 + 256 * 256 * 2_000_000


def test_search_refines_by_id(spark):
    """Rows of one score are told apart by ids in few passes, none of which gathers them."""
    rows = [(i * 3, [1.0], i % 2) for i in range(5000)]
    got = hard_negatives.mine(spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA), F.col("vec_id") == 9, percents=(100, 100)).collect()
    assert sorted((r.positive_id, r.rank, r.negative_id) for r in got) == [(p, k, (0, 6, 12)[k - 1]) for p in (3, 15, 21, 27, 33) for k in (1, 2, 3)]


# --- spelling variants ----------------------------------------------------------------------------------------------
def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(docs):
    count = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 5}
    form, links = {}, {}
    for w in n:
        links[w] = [x for x in n if near(w, x)]
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(links[w]), n.get(form[w]))
    return out


@pytest.fixture(scope="module")
def prose():
    r = random.Random(8)
    parts = ["tion", "ré", "aa", "the", "xu", "ß", "Er", "qu", "ÿ×", "ing"]
    base = ["".join(r.choice(parts) for _ in range(r.randint(2, 5))) for _ in range(60)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "aababab", "x" * 400, "x" * 399 + "y"]

    def slip(w):
        k, c = r.randrange(len(w)), r.choice("aetxé")
        return r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w + c, c + w, w[:-1]])

    words = base + [slip(w) for w in base for _ in range(6)]
    words += [slip(slip(w)) for w in base for _ in range(3)]
    weights = [r.choice([1, 1, 3, 30, 200]) for _ in words]
    texts = [(i if i % 13 else None, "".join(w + r.choice([" ", ", ", "1", "_", "Ā", "\n", " "]) for w in r.choices(words, weights, k=r.randint(0, 400)))) for i in range(160)]
    return [*texts, (500, None), (501, ""), (502, "  "), (503, "née" * 2000), (503, texts[2][1]), (503, texts[2][1])]


def test_spelling_variants(spark, prose):
    frame = spark.createDataFrame([(*d, "w", 1) for d in prose], "doc_id long, text string, word string, n int").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants.variants(frame).collect()}
    want = variants(prose)
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 20 and any(root not in (w, f) for w, (f, root, *_) in want.items())
    assert spelling_variants.variants(frame.limit(0)).count() == 0


def test_spelling_counts_are_sent_in_parts(spark, prose, monkeypatch):
    """Tasks that hold few words send them on more often; sums are the same."""
    batches = [b for b in spark.createDataFrame(prose, "doc_id long, text string").toArrow().to_batches(max_chunksize=20)]
    whole = collections.Counter()
    for b in spelling_variants._counted(iter(batches)):
        whole.update(dict(zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True)))
    monkeypatch.setattr(spelling_variants, "AT_ONCE", 10)
    monkeypatch.setattr(_common, "doc_chunks", lambda it, most=0, column="text": it)
    parts, rows = collections.Counter(), 0
    for b in spelling_variants._counted(iter(batches)):
        rows += b.num_rows
        for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
            parts[w] += n
    assert parts == whole and rows > len(whole)


def test_spelling_words_do_not_pass_the_driver(spark, prose, monkeypatch):
    """Tables of words grow with the corpus: no step broadcasts one, however small its compressed files are."""
    plans, write = [], _common.Scratch.write

    def noted(self, df, tag, by=None):
        plans.append((tag, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, df, tag, by)

    monkeypatch.setattr(_common.Scratch, "write", noted)
    out = spelling_variants.variants(spark.createDataFrame(prose, "doc_id long, text string"))
    plans.append(("out", out._jdf.queryExecution().executedPlan().toString()))
    assert {"pairs", "ways", "out"} <= {tag for tag, plan in plans if "SortMergeJoin" in plan}
    assert not [tag for tag, plan in plans if "Broadcast" in plan]
