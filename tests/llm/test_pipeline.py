"""The pipeline's stages keep the columns of documents, and their decisions take effect."""

import collections
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from adjudica.llm import _common, queries

DATA = Path("/root/testdata/sf0.001")
here = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)
TOKENS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def n_tokens(text):
    return len(TOKENS.encode(text or "", add_special_tokens=False).ids) + 1


def check_packed(rows, docs):
    """Every document's ids, in whole, in sequences without gaps."""
    want = collections.Counter()
    for i, t in docs:
        want[i] += n_tokens(t)
    got, sequences = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for s in sequences.values():
        assert sorted(s)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(s), sorted(s)[1:])) and sum(n for _, n in s) <= 2048


@here
def test_stages(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    work, seen = _common.Scratch(spark, "test"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = work.write(stage(spark, docs, str(DATA)), name.replace(" ", "-"))
        assert sorted(new.columns) == sorted(docs.columns)
        assert new.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        assert new.where(F.length("text") != F.col("n_chars")).count() == 0
        seen[name], docs = new, new
    assert seen["quality rules"].where(F.size(F.split(F.trim("text"), r"\s+")) < 10).count() == 0
    near = seen["MinHash near-dedup"]
    assert near.count() == near.select("doc_id").distinct().count() < seen["quality rules"].count()
    assert seen["PII"].count() == near.count() and seen["PII"].where(F.rlike("text", F.lit(r"[a-z0-9]@[a-z0-9]+\.[a-z]"))).count() == 0
    assert seen["PII"].where(F.contains("text", F.lit("[EMAIL]"))).count() > 0
    check_packed(STAGE["packing"](spark, docs, str(DATA)).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@here
def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, str(DATA)).collect()
    again = corpus_pipeline.run(spark, str(DATA)).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert rows and sorted(map(key, rows)) == sorted(map(key, again))


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghijklm"), rng.integers(2, 9))) for _ in range(n))


A, B = prose(1, 60), prose(2, 60)
ODD = [
    (1, A, "en", "s", 0), (1, A, "en", "s", 0), (2, A + " more", "en", "s", 0), (None, A, "en", None, 0), (None, B, "en", None, 0), (None, B, "en", None, 0),
    (3, B + " x", "de", "t", 0), (4, None, "en", "t", 0), (5, "", "en", "t", 0), (6, " \n\t ", None, None, 0), (7, prose(3, 200_000), "en", "t", 0), (8, prose(4, 40), "en", "u", 0), (8, prose(5, 40), "en", "u", 0), (9, prose(6, 30) + " write to a.b@c.de", "en", "u", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Missing ids and sources, repeated rows, ties, empty and very long texts, columns of clashing names."""
    more = ["bucket", "node", "kept", "size", "seats", "target", "spans", "component_id", "keep_text", "at", "given_id"]
    return spark.createDataFrame(ODD, DOCS).select("*", *[F.lit("x").alias(c) for c in more])


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_quality_of_odd_rows(spark, odd):
    assert texts(STAGE["quality rules"](spark, odd, "")) == sorted(((r[0], r[1]) for r in ODD if r[1] and r[1].strip()), key=repr)


def test_near_dedup_of_odd_rows(spark, odd):
    got = texts(STAGE["MinHash near-dedup"](spark, odd, ""))
    # 1 stands for its repetition, 2 and the row without an id; 3 for the rows of B without one; the two texts of 8 are
    # classes of their own
    assert [x for x in got if x[0] in (1, 2)] == [(1, A)] and [x for x in got if x[0] == 3] == [(3, B + " x")]
    assert not [x for x in got if x[0] is None] and len([x for x in got if x[0] == 7]) == 1 and len([x for x in got if x[0] == 8]) == 2
    assert {x[0] for x in got} == {1, 3, 4, 5, 6, 7, 8, 9}


def test_redaction_of_odd_rows(spark, odd):
    got = texts(STAGE["PII"](spark, odd, ""))
    assert len(got) == len(ODD) and [t for i, t in got if i == 9] == [ODD[-1][1].replace("a.b@c.de", "[EMAIL]")]
    assert [t for i, t in got if i in (4, 5)] == ["", ""]


def test_mixing_of_odd_rows(spark, odd):
    got = STAGE["mixing"](spark, odd, "").collect()
    words = collections.Counter()
    for r in got:
        assert r.text.split()
        words[r.source] += len(r.text.split())
    size = collections.Counter()
    for _, t, _, source, _ in ODD:
        size[source] += len((t or "").split())
    assert all(words[s] <= 2 * size[s] for s in words) and sum(words.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.02)
    assert texts(STAGE["mixing"](spark, odd, "")) == sorted(((r.doc_id, r.text) for r in got), key=repr)


def test_packing_of_odd_rows(spark, odd):
    rows = STAGE["packing"](spark, odd, "").collect()
    check_packed(rows, [(r[0], r[1]) for r in ODD])
    one = next(r for r in rows if r.doc_id == 4)
    assert one.ids_crc32 == zlib.crc32(np.array([1], np.uint32).tobytes())


@pytest.mark.parametrize("name", list(STAGE))
def test_empty_table(spark, name):
    docs = spark.createDataFrame([], DOCS)
    out = STAGE[name](spark, docs, "")
    assert out.count() == 0 and (name == "packing" or sorted(out.columns) == sorted(docs.columns))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(queries.QUERIES) <= set(names) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "PII", "mixing", "packing"]


def test_finish_removes_what_was_written(spark, tmp_path):
    work = _common.Scratch(spark, "gone")
    table = work.write(spark.range(3), "t")
    assert table.count() == 3 and _common.finish(spark) >= 1 and _common.finish(spark) == 0
    assert not Path(work.base.removeprefix("file://")).exists()
