"""The similarity join against brute force, at 50,000 names and on odd ones."""

import collections
import random

import pytest

from adjudica.operators import catalogue, similarity


def grams(k):
    return collections.Counter(k[i : i + 2] for i in range(len(k) - 1))


def best_of(names, entries):
    """key: (idx, score), the first idx on ties; none where nothing is shared."""
    sizes, post = {}, collections.defaultdict(list)
    for i, k in entries:
        g = grams(k)
        sizes[i] = sum(g.values())
        for x, c in g.items():
            post[x].append((i, c))
    out = {}
    for k in names:
        g, shared = grams(k), collections.Counter()
        for x, c in g.items():
            for i, d in post[x]:
                shared[i] += min(c, d)
        n = sum(g.values())
        if shared:
            score, i = max((2 * c / (n + sizes[i]), -i) for i, c in shared.items())
            out[k] = (-i, score)
    return out


def run(spark, names, entries, threshold=0.82):
    left = spark.createDataFrame([(k,) for k in names], "key string").repartition(3)
    right = spark.createDataFrame(entries, "idx long, key string").repartition(3)
    return {r.key: (r.idx, r.score) for r in similarity.best(left, right, threshold).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    assert {k: i for k, (i, _) in got.items()} == {k: i for k, (i, _) in want.items()}
    assert all(got[k][1] == pytest.approx(s) for k, (_, s) in want.items())


def test_fifty_thousand_names(spark):
    r = random.Random(2)
    parts = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 6))) for _ in range(400)]
    entries = [(i, " ".join(r.choice(parts) for _ in range(r.randint(1, 5)))) for i in range(50_000)]

    def slip(k):
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(k) + 1)
            k = k[:at] + r.choice(["", "x", "q", " "]) + k[at + r.randint(0, 1) :]
        return k

    names = [slip(r.choice(entries)[1]) for _ in range(120)] + [" ".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(40)]
    names += ["zzzz 99", "99999", "wyk 77 xz", "a", "", "ab", "q" * 60]
    want = best_of(set(names), entries)
    assert min(s for _, s in want.values()) < 0.5 and len({round(s, 1) for _, s in want.values()}) > 4
    same(run(spark, names, entries), want)


@pytest.mark.parametrize("seed", range(4))
def test_few_letters_many_ties(spark, seed):
    """Few letters make repeated bigrams, equal scores and sets of which one holds the other."""
    r = random.Random(seed)
    word = lambda most: "".join(r.choice("ab ") for _ in range(r.randint(0, most)))
    entries = [(i, word(r.choice([4, 12, 40]))) for i in range(120)]
    names = [word(r.choice([4, 12, 40])) for _ in range(80)]
    same(run(spark, names, entries, r.choice([0.2, 0.5, 0.82, 1.0])), best_of(set(names), entries))


def test_matched_names_keep_their_score(spark):
    entries = spark.createDataFrame([("Danos morais", 0), ("Danos materiais", 1), ("DANOS MORAIS", 2), ("Ação", 3), ("x", 4)], "canonical string, idx int")
    names = spark.createDataFrame([(n,) for n in ("danos-morais", "danos morai", "dano", "X", "y", "", None, "çãoa")], "name string")
    got = {r.name: (r.canonical, r.method, round(r.score, 6)) for r in catalogue.match(names, entries).collect()}
    assert got == {
        "danos-morais": ("DANOS MORAIS", "exact", 1.0), "danos morai": ("Danos morais", "fuzzy", 0.952381), "dano": (None, "none", 0.428571), "X": ("x", "exact", 1.0), "y": (None, "none", 0.0),
        "": (None, "none", 0.0), None: (None, "none", 0.0), "çãoa": (None, "none", 0.666667),
    }
    assert catalogue.match(names, entries.limit(0)).where("method != 'none' or score != 0").count() == 0
    assert catalogue.match(names.limit(0), entries).count() == 0


def test_no_product_in_the_plan(spark):
    plan = similarity._level(
        spark.createDataFrame([("abc", [1, 2], 2, 0.0)], "key string, tokens array<bigint>, n int, bound double"), spark.createDataFrame([(0, [1, 3], 2)], "idx long, tokens array<bigint>, m int"), 0.5, 2
    )
    text = plan._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_entries_and_names_do_not_pass_the_driver(spark, monkeypatch):
    """Only the rarity of bigrams is broadcast, and copies of a key are one entry, however many there are."""
    plans, sizes, counted, written = [], [], similarity.counted, catalogue.written

    def noted(df, name, **figures):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        out = counted(df, name, **figures)
        sizes.append((name, out[0].count()))
        return out

    def noted_too(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(similarity, "counted", noted)
    monkeypatch.setattr(catalogue, "written", noted_too)
    entries = [(i, k) for i, k in enumerate(["red bolt", "blue bolt", "a" * 40, "a" * 39 + "b"] * 30)]
    names = ["red bolts", "bleu bolt", "a" * 41, "a" * 12, "bo"]
    same(run(spark, names, entries), best_of(names, entries))
    assert [n for name, n in sizes if name == "sets"] == [4]
    left = spark.createDataFrame([(k,) for k in names], "name string")
    out = catalogue.match(left, spark.createDataFrame([(k, i) for i, k in entries], "canonical string, idx int"))
    plans.append(("out", out._jdf.queryExecution().executedPlan().toString()))
    assert {name for name, plan in plans if "Broadcast" in plan} <= {"sets", "open"}
    assert {"level", "looked", "out"} <= {name for name, plan in plans if "SortMergeJoin" in plan}
