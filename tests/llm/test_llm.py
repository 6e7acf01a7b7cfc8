"""Each operator against a brute-force version, with nulls, empty and repeated rows, ties and extra columns."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adjudica.llm import _common, embedding_dedup, hmm_lm, html_extraction, license_scan, minhash_dedup, mixing, packing, pii, quality_rules, substring_dedup, tokens
from adjudica.llm.components import connected

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, node string, n_words string, size string, kind string"


def words(text):
    return re.findall(WORD, text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def corpus():
    """Prose with exact and near copies, a shared passage, personal data, licences, odd and empty texts."""
    r = random.Random(3)
    vocab = ["".join(r.choice("abdeghilnorstuéß") for _ in range(r.randint(2, 9))) for _ in range(700)]
    prose = lambda n: " ".join(r.choice(vocab) + r.choice(["", "", ",", ".", ".\n"]) for _ in range(n))
    passage = prose(60)
    texts = [prose(r.randint(5, 250)) for _ in range(70)]
    texts += [texts[3], texts[3], texts[5].upper(), texts[7] + " end", passage + " " + prose(30), prose(20) + " " + passage, prose(9) + " " + passage + "\n" + passage]
    for k in range(12):
        texts.append(" ".join(w if r.random() > 0.02 else "zz" + str(k) for w in texts[9].split()))
    texts += [None, "", " \t\n ", "a", "A", "a b", "x " * 400, "one\x85two three \x1f", "y\n" * 30, "w" * 3000]
    texts += ["mail a.b@c.de and 10.0.0.300 10.0.0.30 call +1 (499) 555-6503 or 4111 1111 1111 1111", "Under the MIT License. under the mit, license", "Apache License, version 2 cc-by-nc Kmit"]
    return [(i, t, "en", None if i % 11 == 0 else f"s{i % 5}", 0, 7, "n", "w", "s", "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def frame(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5)


@pytest.fixture(scope="module")
def odd(spark):
    """Missing ids, repeated rows, one id with two texts."""
    t = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return spark.createDataFrame([(None, t), (None, t), (4, t), (4, t), (4, "other " + t), (2, None), (2, None)], "doc_id long, text string").withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("x"))


def repeats(docs, k=13):
    first = {}
    for i, w in docs:
        for a in range(len(w) - k + 1):
            first[tuple(w[a : a + k])] = min(i, first.get(tuple(w[a : a + k]), i))
    out = {}
    for i, w in docs:
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                gone[a : a + k] = [True] * k
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_substring_dedup(frame, corpus, odd):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(frame).collect()}
    assert got == repeats([(d[0], words(d[1])) for d in corpus])
    assert max(r.longest for r in substring_dedup.remove_repeats(frame).collect()) >= 52
    rows = substring_dedup.remove_repeats(odd).collect()
    assert len(rows) == 7 and all(r.n_removed == 0 for r in rows)
    assert substring_dedup.remove_repeats(frame.limit(0)).count() == 0


@pytest.mark.parametrize("often", [2, 5])
def test_windows_a_task_has_often_travel_as_summaries(spark, often):
    r = random.Random(often)
    word = lambda: r.choice("abcdefgh")
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for i in range(120):
        own = [f"w{i}x{j}" if i % 3 else word() for j in range(r.randint(5, 60))]
        docs.append((i, own + passage[: r.choice([0, 12, 13, 30, 40])] + own[:4] + (passage if i % 7 == 0 else [])))
    docs += [(500 + i, docs[7][1]) for i in range(30)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(2)
    got = {x.doc_id: (x.n_words, x.n_removed, x.text) for x in substring_dedup.remove_repeats(df, often=often).collect()}
    assert got == repeats(docs)


def test_a_very_long_text(spark):
    r = random.Random(5)
    w = [f"v{r.randint(0, 50_000)}" for _ in range(300_000)]
    rows = [(1, " ".join(w)), (2, "a b c " + " ".join(w[1000:200_000])), (3, "x"), (3, None)]
    got = {(x.doc_id, x.n_words): (x.n_removed, x.longest) for x in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 300_000): (0, 0), (2, 199_003): (199_000, 13 * 2**13), (3, 1): (0, 0), (3, 0): (0, 0)}


def test_rows_of_one_id_keep_their_own_places(spark):
    t = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(t)), (5, " ".join(t[:20])), (5, "a b c " + " ".join(t[5:25]))]
    got = sorted((r.n_removed, r.text) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 5").collect())
    assert got == [(20, ""), (20, "a b c")]


def check_pieces(rows, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    mine, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        mine[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], np.uint32)
        at = 0
        for p in sorted(mine[i], key=lambda r: r.start):
            own = ids[at : at + p.length]
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes())) and p.ids in (None, own.tobytes())
            at += p.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * max(1, len(sequences)))


def test_packing(spark, frame, corpus, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    hard = "Don't STOP 1234 ½ <|endoftext|> a<|startoftext|>b naïve Σίσυφος ΟΔΟΣ ﬁ ÿŸ 日本語 ''s I'LL İstanbul \x85 ª º × ÷"
    docs = [(d[0], d[1]) for d in corpus] + [(1000, hard * 3), (1001, "a " * 9000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert check_pieces(packing.pack(df, path).collect(), docs) > 0.9
    check_pieces(packing.pack(df, path, open_windows=2, with_ids=False).collect(), docs)
    assert {r.doc_id: r.n for r in packing.pack(odd, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}[2] == 2
    assert packing.pack(frame.limit(0), path).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_file_gives_its_own_ids(file):
    path = public_tokenizers.path(file)
    texts = ["two  spaces and\nlines", "Don't", None, "", " x", "ÀÖØ ½ 日本語"]
    ids, ends = tokens.WordTokenizer(path).encode(pa.array(texts), 1)
    whole = Tokenizer.from_file(path)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [[*whole.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_license_scan(frame, corpus, odd):
    def plain(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        at = [(i, label) for p, label in license_scan.PHRASES.items() for q in [p.split()] for i in range(len(w)) if w[i : i + len(q)] == q]
        return len(w), sorted(i for i, _ in at), sorted({x for _, x in at})

    rows = license_scan.scan(frame).collect()
    assert {r.doc_id: (r.n_words, sorted(r.places), r.base_labels) for r in rows} == {d[0]: plain(d[1]) for d in corpus}
    assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 for r in rows)
    assert license_scan.scan(odd).count() == 7 and license_scan.scan(frame.limit(0)).count() == 0


def test_license_spans_survive_an_inserted_word(spark):
    t = "x y this work is licensed under the very gnu general public license version 3 z"
    r = license_scan.scan(spark.createDataFrame([(1, t), (2, "gnu general public works")], "doc_id long, text string")).collect()
    assert {x.doc_id: x.labels for x in r} == {1: ["gpl-3"], 2: []}


def test_license_notices_are_told_apart(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    texts = {
        gpl.format(2): "gpl,gpl-2", gpl.format(3): "gpl,gpl-3", gpl.replace("GNU General", "GNU Affero General").format(3): "agpl-3",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "SPDX-License-Identifier: MPL-2.0": "mpl-2", "SPDX-License-Identifier: GPL-2.0-only": "gpl-2", "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: BSD-3-Clause": "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "bsd", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http": "mpl-2",
        "the licence of this program is unknown, you can redistribute nothing under the terms of anything": "",
    }
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: ",".join(r.labels) for r in got} == dict(enumerate(texts.values()))


def test_license_scan_of_long_texts_and_ties(spark):
    many = "under the mit license " * 20_000
    rows = [(1, many), (1, "x"), (2, "cc by nc cc by nc"), (None, "under the MIT license"), (3, "released under the mit license " * 3)]
    got = {(r.doc_id, r.n_words): (len(r.places), r.labels, r.score) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("z"))).collect()}
    assert got[1, 80_000][0] == 20_000 and got[2, 6] == (2, ["cc-by-nc"], 1.0) and got[None, 4][1] == ["mit"] and got[3, 15] == (3, ["mit"], 1.0)


def test_quality_rules(spark, frame, corpus, odd):
    def plain(text):
        w = words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)

    rows = quality_rules.judge(frame, keep=("lang",)).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r.doc_id: tuple(r[c] for c in cols) for r in rows} == {d[0]: plain(d[1]) for d in corpus}
    assert all(r.kept == (not r.base_failed) for r in rows) and quality_rules.judge(odd).count() == 7 and quality_rules.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast", [200_000, -1])
def test_frequent_lines(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", broadcast)
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(20))
    rows = [(i, f"Shared  line here\n{own(i)}" if i % 3 else "shared line HERE\nx y", "h") for i in range(300)]
    rows += [(1000 + i, own(5000) + f"\nsame long copy {own(6000)}", "h") for i in range(200)] + [(2000, "Shared line here\n" + own(1), None)]
    got = {r.doc_id: (r.kept, r.n_removed_lines, r.text) for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1] == (True, 1, own(1)) and got[3] == (False, 1, "x y") and got[2000][1] == 0
    assert all(got[1000 + i][0] for i in range(200)), "copies are no boilerplate"


def test_lines_count_distinct_documents(spark):
    shared = " ".join(f"b{j}" for j in range(60))
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    rows = [(i, f"{shared}\n{own(i)}", "h") for i in range(60)] + [(100 + i, "one copy " + own(999), "h") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r.n_docs for r in quality_rules.frequent_lines(docs).collect()] == [60], "each document once, copies once, in the host's count too"


def test_mixing(spark, frame, corpus, odd):
    rows = mixing.plan(frame).collect()
    size = {d[0]: len(words(d[1])) for d in corpus}
    totals = collections.Counter()
    for d in corpus:
        totals[d[3]] += size[d[0]]
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    fixed, open_ = {}, set(names)
    while True:
        level = (1.5 * sum(totals.values()) - sum(fixed.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * totals[s]]
        if not over:
            break
        fixed |= {s: 2 * totals[s] for s in over}
        open_ -= set(over)
    taken = collections.Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == totals[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(fixed.get(r.source, level * weight[r.source]))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - fixed.get(s, level * weight[s])) <= 0.02 * fixed.get(s, level * weight[s]) + 1 for s in names)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.plan(frame.repartition(2)).collect()), key=str)
    text = mixing.materialised(mixing.plan(frame, keep=("text",)), "text").groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n")).collect()
    assert {r.doc_id: r.n for r in text} == {r.doc_id: r.taken for r in rows if r.taken}
    assert mixing.plan(odd).count() == 7 and mixing.plan(frame.limit(0)).count() == 0


def judged_plainly(rows, least_docs, least_share):
    """kept, removed lines and words left of rows (doc_id, text, source) by the rule as it is told."""
    def norm(line):
        return " ".join(line.lower().split())

    docs, holds = collections.defaultdict(set), collections.defaultdict(set)
    for _, t, s in rows:
        who = tuple(words(t))
        docs[s].add(who)
        for line in (t or "").split("\n"):
            if words(line):
                holds[s, norm(line)].add(who)
    often = {k for k, v in holds.items() if len(v) > least_docs and len(v) > least_share * len(docs[k[0]])}
    out = {}
    for i, t, s in rows:
        w = words(t)
        c = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        cover = {k for j in range(len(w) - 4) if c[tuple(w[j : j + 5])] > 1 for k in range(j, j + 5)}
        gone = [line for line in (t or "").split("\n") if words(line) and (s, norm(line)) in often]
        left = len(w) - sum(len(words(line)) for line in gone)
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        out[i] = (not failed and not (left < len(w) and (left < 10 or left < 0.2 * len(w))), len(gone), left)
    return out


def test_verdicts_of_texts_that_are_mostly_boilerplate(spark):
    r = random.Random(21)
    lines = [" ".join(f"b{k}x{j}" for j in range(n)) for k, n in enumerate((40, 12, 3, 25))]
    rows = []
    for i in range(600):
        own = [f"w{i}x{j}" for j in range(r.choice([0, 5, 9, 9, 12, 30, 80]))]
        some = r.sample(lines, r.randint(0, 3)) + ([lines[0].upper() + " "] if i % 5 == 0 else [])
        rows.append((i, "\n".join([*some, " ".join(own)]), r.choice(["h", "h", "g", None])))
    rows += [(1000 + i, rows[7][1], "h") for i in range(300)]
    # at the limits: 50 documents are not more than 50
    rows += [(2000 + i, f"limit line of this host\n{' '.join(f'l{i}x{j}' for j in range(12))}", "at50") for i in range(50)] + [(3000 + i, f"limit line of this host\n{' '.join(f'm{i}x{j}' for j in range(12))}", "at51") for i in range(51)]
    got = {x.doc_id: (x.kept, x.n_removed_lines, x.n_left_words) for x in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == judged_plainly(rows, quality_rules.LEAST_DOCS, quality_rules.LEAST_SHARE)
    assert got[2000][1] == 0 and got[3000][1] == 1
    nine = [(i, f"{lines[0]}\n{' '.join(f'n{i}x{j}' for j in range(9))}", "h") for i in range(300)]
    assert not any(x.kept for x in quality_rules.judge(spark.createDataFrame(nine, "doc_id long, text string, source string")).collect())


def test_quality_of_a_very_long_text(spark):
    long = "\n".join(f"line {i} of many words" for i in range(150_000))
    got = quality_rules.judge(spark.createDataFrame([(1, long, "s"), (1, "x", "s"), (2, "y " * 500_000, None)], "doc_id long, text string, source string")).collect()
    assert sorted((x.n_words, x.n_dup_lines, x.kept) for x in got) == [(1, 0, False), (500_000, 0, False), (750_000, 0, True)]


def highest_quotients(votes, caps, house):
    """Seats by giving one at a time to the highest votes / (2 * seats + 1)."""
    seats = [0] * len(votes)
    for _ in range(house):
        open_ = [i for i in range(len(votes)) if seats[i] < caps[i] and votes[i] > 0]
        if not open_:
            break
        best = max(open_, key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


@pytest.mark.parametrize(("votes", "house"), [([949.0] + [0.51] * 100, 1000), ([5.0, 5.0, 5.0, 0.0], 7), ([1.0], 3), ([10.5, 3.25, 8.125, 8.125] * 9, 90), ([], 4)])
def test_seats_go_by_highest_quotients(spark, votes, house):
    work = _common.Scratch(spark, "seats")
    t = spark.createDataFrame([(f"p{i:03}", v, 1) for i, v in enumerate(votes)], "name string, votes double, g int")
    full = sum(votes) / house / 4 or 1.0
    caps = [math.ceil(v / full) for v in votes]
    want = {f"p{i:03}": n for i, n in enumerate(highest_quotients(votes, caps, house))}
    got = mixing.apportion(work, t.select("name", "votes"), "name", "votes", house, F.ceil(F.col("votes") / full), full)
    assert {r.name: r.seats for r in got.collect()} == want
    within = mixing.apportion_within(t, "g", "name", "votes", F.lit(house), F.ceil(F.col("votes") / full), full)
    assert {r.name: r.seats for r in within.collect()} == want


def test_seats_of_many_random_votes(spark):
    r = random.Random(8)
    work = _common.Scratch(spark, "seats")
    for n in (3, 40, 300):
        votes = [round(r.paretovariate(0.7), 3) for _ in range(n)]
        house = r.randint(1, 4 * n)
        full = sum(votes) / house / 3
        caps = [math.ceil(v / full) for v in votes]
        want = {f"p{i:03}": s for i, s in enumerate(highest_quotients(votes, caps, house))}
        t = spark.createDataFrame([(f"p{i:03}", v) for i, v in enumerate(votes)], "name string, votes double")
        assert {x.name: x.seats for x in mixing.apportion(work, t, "name", "votes", house, F.ceil(F.col("votes") / full), full).collect()} == want


def test_small_sources_come_near_their_targets(spark):
    rows = [(i, " ".join(["w"] * 40), "big") for i in range(100)] + [(1000 + i, "a b c d", f"s{i:03}") for i in range(199)]
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(F.sum("taken").alias("n"), F.min("target").alias("target")).collect()
    assert all(abs(r.n - r.target) <= 0.5 + 0.01 * r.target for r in got)


def test_mixing_of_ties_repeated_rows_and_long_texts(spark):
    rows = [(7, "a b c", "s")] * 5 + [(8, None, "s"), (9, "", None), (10, "x " * 400_000, "t"), (11, "y", "t")]
    got = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 9 and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sum(r.taken for r in got if r.doc_id == 7) == pytest.approx(30, abs=1) and next(r.target for r in got if r.doc_id == 9) == 0
    text = mixing.materialised(mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=("text",)), "text")
    n = {r.doc_id: r.n for r in text.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n")).collect()}
    assert n[10] == next(r.taken for r in got if r.doc_id == 10)


@pytest.mark.parametrize("block", [7, 1024])
def test_embedding_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 64))
    rows = [(i, [float(x) for x in base[i % 30] / np.linalg.norm(base[i % 30]) + rng.standard_normal(64) * rng.uniform(0.01, 0.03)], int(i % 3)) for i in range(700)]
    rows += [(2000 + i, [1.0] * 64, 1) for i in range(40)] + [(3000, None, 1), (3001, [0.0] * 64, 1), (3002, [math.nan] * 64, 1), (3003, [1.0] * 64, None), (3004, [], 1), (3005, [1.0, 2.0], 1), (3006, [2.0, 4.0], 1), (3007, [None, 1.0], 1), (3008, [math.inf] * 64, 1)]
    good = [(i, (k, len(v)), np.array(v)) for i, v, k in rows if v and k is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = collections.Counter(), {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, k, v) in enumerate(good):
        for j, k2, u in good[a + 1 :]:
            if k == k2 and v @ u / math.sqrt((v @ v) * (u @ u)) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("n"))
    got = embedding_dedup.near_duplicates(df).collect()
    found, want = sum(r.n_links for r in got), sum(links.values())
    assert 0.99 * want <= found <= want and all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.component_id == root(r.vec_id) for r in got) >= 0.99 * len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_one_id(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0], 2)]
    got = sorted((x.vec_id or -1, x.n_links, x.component_id, x.kept) for x in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cell", F.lit(1))).collect() if x.vec_id)
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_html_extraction(spark):
    page = lambda i: f"<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class='ad'>buy {i}</div><article><h1>Head {i}</h1><p>one <b>two</b>\n {i}&amp;x<p>three<br>four</article><div id='comments'><p>bad {i}</p></div><footer>f</footer></body></html>"
    rows = [(i, "http://a.example/x", page(i)) for i in range(7)] + [(10, None, None), (11, "u", ""), (12, "http://b.example", "plain < text"), (13, "http://a.example/y", "<p>no article &lt;here")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    assert got[3][0] == "Head 3\none two 3&x\nthree four" and got[10] == got[11] == ("", 0) and got[12][0] == "plain < text" and got[13][0] == "no article <here"
    assert all(n == len(t) for t, n in got.values())


def read_alone(*pages):
    wrapper = html_extraction.decided(html_extraction.infer(list(pages)))
    return [html_extraction.read(p, wrapper) for p in pages]


def test_wrappers_are_union_free():
    a = "<body><div class=c><p>same<p>x1</div><ul><li>a</ul></body>"
    b = "<body><div class=c><p>same<p>y2</div><ul><li>a<li>b<li>c</ul><div class=z>more</div></body>"
    w = html_extraction.expression(html_extraction.infer([a, b])["root"])
    assert "|" not in w and "#" in w and ")+" in w and ")?" in w
    assert html.unescape("&amp;") == "&"


@pytest.mark.parametrize("page", ["<body class='has-sidebar'><p>a text</p>", "<article class='post category-legal'><p>a text</p></article>", '<div style="overflow: hidden"><p title="the hidden valley">a text</p></div>', "<div class='content with-sidebar'><p>a text</p></div>"])
def test_marks_that_say_nothing_drop_nothing(page):
    assert read_alone(page) == ["a text"]
    assert read_alone("<div hidden>x</div><p class=ad>y</p>" + page) == ["a text"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>\u0130\u0130stanbul</p><script>var a = '</p>';</script><article><p>The article text here.</p></article>", "The article text here."),
        ("<article><header><h1>T</h1></header><p>x</p><footer>by</footer></article>", "T\nx"),
        ("<header>site</header><main><p>x</main>", "x"),
        ("<article><p>open <b>bold<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", "open bold\none\ntwo\ndeep\nthree"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<ScRiPt>x</sCrIpT>z &lt;b&gt; &nbsp; y", "z <b> y"),
        ("", ""),
        ("<<>", "<<>"),
    ],
)
def test_reading_of_odd_pages(page, text):
    assert read_alone(page) == [text]


def test_container_holds_the_whole_article():
    own = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    pages = [f"<body><div class=content><h1>Head {i}</h1><p class=lead>lead {i}</p><div class=body><p>{own(i, 80)}</p></div></div></body>" for i in range(4)]
    assert read_alone(*pages)[1] == f"Head 1\nlead 1\n{own(1, 80)}"
    pages = [f"<body><article class=a><p>{own(i, 60)}</p></article><article class=b><p>second {i}</p></article></body>" for i in range(4)]
    assert read_alone(*pages)[1] == f"{own(1, 60)}\nsecond 1"


def test_very_deep_very_wide_and_very_long_pages():
    assert read_alone("<div>" * 20_000 + "deep" + "<p>x" * 500)[0].startswith("deep\nx")
    wide = "".join(f"<h2>h{i}</h2><p>t{i}</p>" + "<ul><li>x</ul>" * (i % 3 == 0) + "<table><tr><td>c</table>" * (i % 7 == 0) for i in range(3000))
    assert read_alone(wide)[0].count("t") == 3000
    assert len(read_alone("<article>" + "word " * 1_000_000)[0]) == 4_999_999


@pytest.mark.parametrize("layout", ["article", "named", "plain"])
def test_generated_hosts(spark, layout):
    """Pages of one host with paragraphs, lists and headings of their own, menus, template texts and comments."""
    r = random.Random(layout)
    some = lambda k: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(k))
    rows, want = [], {}
    for i in range(60):
        body, lines = [], [f"Head {some(3)}"]
        for _ in range(r.randint(2, 9)):
            kind = r.choice(["p", "p", "h2", "ul", "pre"])
            texts = [some(r.randint(5, 40)) for _ in range(r.randint(1, 4) if kind == "ul" else 1)]
            lines += texts
            body.append(f"<ul>{''.join(f'<li>{t}' for t in texts)}</ul>" if kind == "ul" else f"<{kind}>{texts[0]}</{kind}>")
        inner = f"<h1>{lines[0]}</h1>{''.join(body)}<p>Read us on paper too</p>"
        box = {"article": f"<article>{inner}</article>", "named": f"<div class=post-body>{inner}</div>", "plain": f"<div>{inner}</div>"}[layout]
        menu = "<nav><a>Home</a></nav>" if layout == "article" else "<div class=top><ul><li>Home<li>News</ul></div>"
        talk = f"<div id=comments><p>{some(50)}</p></div>" * (i % 3)
        rows.append((i, "http://h.example/x", f"<html><body>{menu}<div class=ad>{some(6)}</div>{box}{talk}<div class=site-footer>All of us {i}</div></body></html>"))
        want[i] = "\n".join(lines)
    rows += [(100 + i, "http://h.example/x", rows[0][2]) for i in range(40)]
    want |= {100 + i: want[0] for i in range(40)}
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {x.page_id: x.text for x in got} == want


def test_near_copies_are_no_template():
    own = " ".join(f"w{j}" for j in range(200))
    pages = [f"<body><div class=c><h1>T</h1><p>{own}</p><p>version {i}</p></div></body>" for i in range(9)]
    assert read_alone(*pages)[4] == f"T\n{own}\nversion 4"


def test_empty_pages_table(spark):
    assert html_extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pii(spark, frame, corpus, odd):
    def luhn(d):
        return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    def plain(text):
        out = []
        patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text or ""):
                d = re.sub("[^0-9]", "", m[0])
                if k == 0 or (k == 1 and max(map(int, m[0].split("."))) <= 255) or (k == 2 and 14 <= len(d) <= 19 and luhn(d)) or (k == 3 and 10 <= len(d) <= 15):
                    out.append((m.start(), k, m.end()))
        return sorted(out)

    extra = ["é@b.co ü a@b.c@d.e f..g@h-.i.j. x@y a@b.c_d@e.f 1.2.3.4.5.6.7.8 0256.1.1.1 001.2.3.4.", "41111111111111112 +1234567890123456 x5500005555555559 378282246310005", "1 2 3 " * 3000, "a.b-c@" * 500 + "x.y", "a" * 20000 + "@b" + ".c" * 5000, "\x01 4111\x011111 a\x01b@c.d"]
    df = frame.select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    want = {d[0]: plain(d[1]) for d in corpus} | {5000 + i: plain(t) for i, t in enumerate(extra)}
    rows = pii.find(df).select("*", pii.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()
    assert {r.doc_id: [tuple(s) for s in r.base] for r in rows} == want
    assert all({tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} for r in rows)
    assert all("@c.de" not in r.clean and "4111 1111 1111 1111" not in r.clean for r in rows)
    assert pii.find(odd).count() == 7 and pii.find(frame.limit(0)).count() == 0


def test_pii_held_out_accuracy(spark):
    fresh = pii._examples(600, seed=77)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(fresh)], "doc_id long, text string")
    hit = {r.doc_id: r.n > 0 for r in pii.find(df).select("doc_id", F.size("spans").alias("n")).collect()}
    right = sum(hit[i] == bool(y) for i, (_, y) in enumerate(fresh))
    false = sum(hit[i] and not y for i, (_, y) in enumerate(fresh))
    assert right >= 0.9 * len(fresh) and false <= 0.05 * len(fresh)


def test_pii_of_ties_and_overlaps(spark):
    """Spans that are added overlap neither strict ones nor each other, and come out the same again."""
    t = "token " + "a1" * 20 + " token " + "a1" * 20 + " ssn 123-45-6789 or 123-45-6789, call 555-123-4567 555-123-4567 mail a at b dot com dot org a at b dot com dot org key x@y.zz" + "Q9" * 30
    df = spark.createDataFrame([(1, t), (1, t), (2, t * 300), (3, "key " + "Zx9" * 400)], "doc_id long, text string").withColumn("base", F.lit("x"))
    rows = pii.find(df).collect()
    for r in rows:
        base, spans = [tuple(s) for s in r.base], [tuple(s) for s in r.spans]
        added = [s for s in spans if s not in base]
        assert added and all(a[2] <= b[0] or b[2] <= a[0] for a in added for b in added[: 400] + base[:400] if a != b)
    assert rows[0].spans == rows[1].spans and sorted(map(str, rows)) == sorted(map(str, pii.find(df.repartition(2)).collect()))
    long = next(r for r in rows if r.doc_id == 3)
    assert [(s.start, s.end) for s in long.spans] == [(4, 1204)], "a secret of any length is one span"


def similar(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = words(lower(t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("block", [4, 128])
def test_minhash_dedup(frame, corpus, odd, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(frame, 3, 85).collect()}
    assert got == similar([(d[0], d[1]) for d in corpus], 3, 85)
    if block == 4:
        rows = minhash_dedup.near_duplicates(odd, keep=("text", "lang")).collect()
        assert len(rows) >= 4 and all(r.kept for r in rows if r.doc_id is None)
        assert minhash_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_near_duplicates_of_very_long_texts(spark):
    r = random.Random(3)
    w = [f"v{r.randint(0, 30_000)}" for _ in range(150_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:140_000])), (2, " ".join(w[:140_000])), (3, " ".join(w[:90_000])), (4, "x y z")]
    got = sorted((x.doc_id, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit(1)), 3, 85).collect())
    assert got == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (4, 4, True)]


@pytest.mark.parametrize("share", [1 / 2000, 0.0])
def test_components(spark, monkeypatch, share):
    monkeypatch.setattr(_common, "HEAVY_SHARE", share)
    monkeypatch.setattr(_common, "HEAVY_ROWS", 3)
    r = random.Random(11)
    links = [(0, i) for i in range(1, 40)] + [(100 + i, 101 + i) for i in range(60)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(50)] + [(5, 5), (None, 3), (7, None), (0, 1)]
    parent = {x: x for pair in links if None not in pair for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and root(a) != root(b):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    linked = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    got = connected(spark.createDataFrame(links, "a long, b long"), _common.Scratch(spark, "test")).collect()
    assert sorted((x.node, x.label) for x in got) == sorted((x, root(x)) for x in linked)
    assert connected(spark.createDataFrame([], "a long, b long"), _common.Scratch(spark, "test")).count() == 0


def test_large_lists_lose_no_candidate_link():
    rng = np.random.default_rng(6)
    common = rng.integers(0, 1 << 16, minhash_dedup.COORDINATES)
    group = np.zeros(900, minhash_dedup.POSTING)
    group["node"], group["n"] = np.arange(900), 100
    for i in range(900):
        own = rng.integers(0, 1 << 16, minhash_dedup.COORDINATES)
        if i >= 300:
            # chains of texts that agree in part with the one before
            keep = rng.random(minhash_dedup.COORDINATES) < rng.choice([0.5, 0.62, 0.7, 0.9])
            own = np.where(keep, group["signature"][i - 100], own)
        own[rng.random(minhash_dedup.COORDINATES) < 0.4] = 7
        group["signature"][i] = np.where(np.arange(minhash_dedup.COORDINATES) < 20, common, own)
    group["n"][::9] = 150
    matches = 40

    def classes(pairs):
        parent = list(range(900))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        return {frozenset(i for i in range(900) if root(i) == x) for x in map(root, range(900))}

    n = group["n"].astype(int)
    plain = [(i, j) for i in range(900) for j in range(i) if (group["signature"][i] == group["signature"][j]).sum() >= matches and min(n[i], n[j]) >= 0.85 * max(n[i], n[j])]
    got = minhash_dedup._candidate_links(group, matches, 0.85)
    assert classes(got) == classes(plain) and set(got) | {(b, a) for a, b in got} <= {p for a, b in plain for p in ((a, b), (b, a))}


def test_families_of_many_blocks(spark, monkeypatch):
    """A large group of near copies, with some that link to few of it, and texts that only look like candidates."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    monkeypatch.setattr(minhash_dedup, "LEADERS", 2)
    r = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([1, 2, 4, 9, 14])):
            w[r.randrange(300)] = f"z{i}"
        docs.append((i, " ".join(w)))
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()}
    assert got == similar(docs, 3, 85) and len({c for _, c, _ in got.values()}) > 3


def test_hmm_lm(frame, corpus, odd):
    rows = hmm_lm.score(frame).collect()
    tokens = {d[0]: [*words(lower(d[1])), "\n"] for d in corpus}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) and r.score < 0
    twice = {(r.doc_id, r.n_tokens, round(r.base_score, 9)) for r in hmm_lm.score(odd).collect()}
    assert len(twice) == 4 and hmm_lm.score(frame.limit(0)).count() == 0


def test_forward_recursion_and_baum_welch():
    rng = np.random.default_rng(2)
    model = hmm_lm.Model(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), rng.dirichlet(np.ones(hmm_lm.SYMBOLS), 2))
    seqs = [rng.integers(0, 6, k) for k in (1, 4, 7)]

    def plain(x):
        a = model.start * model.emit[:, x[0]]
        for s in x[1:]:
            a = a @ model.move * model.emit[:, s]
        return math.log10(a.sum())

    assert hmm_lm.log10_likelihoods(model, seqs) == pytest.approx([plain(x) for x in seqs])
    long = rng.integers(0, 6, 2 * hmm_lm.STRETCH + 77)
    assert hmm_lm._long_likelihood(model, long) == pytest.approx(hmm_lm.log10_likelihoods(model, [long])[0])
    twice = hmm_lm.expected_counts(model, [seqs[1], seqs[2]], [3, 1])
    for a, b in zip(twice, hmm_lm.expected_counts(model, [seqs[1]] * 3 + [seqs[2]]), strict=True):
        assert a == pytest.approx(b, rel=1e-4)
    start, move, emit = hmm_lm.expected_counts(model, sorted(seqs, key=len, reverse=True))
    assert start.sum() == pytest.approx(3, rel=1e-4) and move.sum() == pytest.approx(9, rel=1e-4) and emit.sum() == pytest.approx(12, rel=1e-4)


def test_scores_of_very_long_texts_and_repeated_rows(spark):
    long = " ".join(f"v{i % 97}" for i in range(80_000))
    rows = [(1, long), (1, long), (3, "v1 v2 v3"), (3, "v1 v2 v3"), (9, "v1 v2 unseen"), (None, "v1"), (5, None)]
    got = hmm_lm.score(spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)), rounds=2).collect()
    by = collections.defaultdict(set)
    for x in got:
        by[x.doc_id].add((x.n_tokens, round(x.base_score, 6), round(x.score, 6)))
        assert x.score < 0 and x.n_known <= x.n_tokens
    assert len(got) == 7 and all(len(v) == 1 for v in by.values()) and next(iter(by[1]))[0] == 80_001


def test_every_training_text_is_learned_whole(spark, monkeypatch):
    """The late part of long texts, beyond any prefix or stretch, enters each round's counts."""
    rng = np.random.default_rng(4)
    model = hmm_lm.Model(np.array([0.6, 0.4]), np.array([[0.9, 0.1], [0.2, 0.8]]), rng.dirichlet(np.ones(hmm_lm.SYMBOLS), 2))
    seqs = [rng.integers(0, 30, k).astype(np.uint16) for k in (1700, 2500, 3, 40)]
    seen = []
    monkeypatch.setattr(hmm_lm, "AT_ONCE", 1000)
    rows = hmm_lm.pa.record_batch([hmm_lm.pa.array([q.tobytes() for q in seqs], hmm_lm.pa.binary())], names=["symbols"])
    parts = next(hmm_lm._expect(model)(iter([rows]))).column("counts").to_pylist()
    emit, start, move = np.array(parts[: hmm_lm.SYMBOLS]), np.array(parts[hmm_lm.SYMBOLS]), np.array(parts[hmm_lm.SYMBOLS + 1 :])
    assert start.sum() == pytest.approx(4, rel=1e-4), "a text starts once"
    assert move.sum() == pytest.approx(sum(map(len, seqs)) - 4, rel=1e-4), "no move is cut"
    assert emit.sum(axis=1)[:30] == pytest.approx(np.bincount(np.concatenate(seqs), minlength=30), rel=1e-3)

    real = hmm_lm.Model.next
    monkeypatch.setattr(hmm_lm.Model, "next", lambda self, *c: (seen.append(c[2].sum()), real(self, *c))[1])
    texts = [(1, " ".join(f"v{i % 50}" for i in range(900))), (2, "a b c"), (4, None)]
    hmm_lm.score(spark.createDataFrame(texts, "doc_id long, text string")).count()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    want = sum(len(words(t)) + 1 for (_, t), h in zip(texts, held, strict=True) if not h)
    assert len(seen) == hmm_lm.ROUNDS and seen == pytest.approx([want] * hmm_lm.ROUNDS, rel=1e-4)
