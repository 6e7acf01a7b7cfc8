"""Live calls whose answers are written ahead, and the workbook sink: what is lost, repeated and left behind."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adjudica.sources import calls, xlsx


def asker(folder, fatal_at=None, bad=()):
    """Counts calls in files; the process dies once, in the middle of a task, after so many."""

    def ask(round_, request):
        case = request["case_number"]
        with open(f"{folder}/calls", "a") as f:
            f.write(f"{round_} {case}\n")
        with open(f"{folder}/calls") as f:
            n = len(f.readlines())
        if fatal_at is not None and n == fatal_at and not os.path.exists(f"{folder}/died"):
            open(f"{folder}/died", "w").close()
            os._exit(1)
        if case in bad:
            raise OSError("overloaded")
        answer = {"severity": "ok", "unsupported": [], "score": 9} if round_ == "audit" else f"{round_} of {case}: {request.get('text', '')[:5]}"
        return {"answer": answer, "usage": {"input_tokens": 7}, "model": "m"}

    return ask


def asked(folder):
    return Path(folder, "calls").read_text().split("\n")[:-1]


def cases(spark, n, text="words"):
    return spark.range(n).select(F.concat(F.lit("c"), "id").alias("case_number"), F.lit(text).alias("text"), F.lit("x").alias("other"))


def test_a_lost_task_pays_for_nothing_twice(spark, tmp_path):
    made = lambda **k: calls.Calls(spark, str(tmp_path / "log"), asker(str(tmp_path), **k), at_once=1)
    rows = cases(spark, 12).coalesce(1)
    with pytest.raises(Exception, match="."):
        made(fatal_at=8).map(rows).count()
    before = asked(tmp_path)
    got = {r.case_number: (r.answer, r.usage.input_tokens, r.model, r.reason) for r in made().map(rows).collect()}
    assert got == {f"c{i}": (f"map of c{i}: words", 7, "m", None) for i in range(12)}
    after = asked(tmp_path)
    # only what was on its way when a worker died is asked twice; the tasks beside it had stored theirs
    assert len(after) - len(set(after)) <= 4 and set(after) == {f"map c{i}" for i in range(12)} and len(before) >= 1
    assert made().map(rows).count() == 12 and asked(tmp_path) == after, "a run anew asks nothing"
    # another text is another question
    assert made().map(cases(spark, 1, "other")).first().answer == "map of c0: other" and len(asked(tmp_path)) == len(after) + 1


def test_failures_are_told_and_others_go_on(spark, tmp_path):
    c = calls.Calls(spark, f"file://{tmp_path}/log", asker(str(tmp_path), bad=("c1",)), at_once=3, attempts=2, step_s=0.01)
    got = {r.case_number: (r.answer, r.reason) for r in c.structure(cases(spark, 4)).collect()}
    assert got["c1"][0] is None and "2 attempts failed, last: overloaded" in got["c1"][1]
    assert got["c0"] == ("structure of c0: words", None) and asked(tmp_path).count("structure c1") == 2
    audits = c.audit(cases(spark, 1).select("case_number", F.col("text").alias("source"), F.lit(None).cast("string").alias("summary")))
    assert [(r.answer.severity, r.answer.score) for r in audits.collect()] == [("ok", 9.0)]
    assert c.map(cases(spark, 0)).count() == 0


def test_answers_are_whole(tmp_path):
    log, key = calls.Log(str(tmp_path)), calls.request_id("map", {"case_number": "é", "text": "t"})
    assert log.get(key) is None
    log.put(key, {"answer": "ç"})
    log.put(key, {"answer": "ç"})
    assert log.get(key) == {"answer": "ç"} and [p.name for p in tmp_path.rglob("*.json*")] == [f"{key}.json"]
    assert key == calls.request_id("map", {"text": "t", "case_number": "é"}) != calls.request_id("structure", {"case_number": "é", "text": "t"})


def test_sink_commits_a_whole_copy(spark, tmp_path):
    source, target = str(tmp_path / "in.xlsx"), str(tmp_path / "out.xlsx")
    xlsx.write_workbook(source, [["Case", "Summary"], *[[f"k{i}", None] for i in range(2, 40)]])
    changes = spark.range(2, 40).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "flagged").when(F.col("id") % 3 == 1, "skippedApproved").otherwise("written").alias("action"), F.concat(F.lit("s"), "id").alias("text")).repartition(5)
    xlsx.save_copy(changes, source, target, 2)
    got = {r.r: r.text for r in xlsx.cells(spark, target).where("c = 2 and r > 1").collect() if r.text}
    assert got == {i: f"s{i}" for i in range(2, 40) if i % 3 == 2}
    assert sorted(os.listdir(tmp_path)) == ["in.xlsx", "out.xlsx"], "nothing is left beside the copy"
    xlsx.save_copy(changes.limit(0), source, target, 2)
    assert {r.text for r in xlsx.cells(spark, target).where("c = 2").collect()} <= {"Summary", None, ""}


def test_a_failing_partition_leaves_no_file(spark, tmp_path):
    source, target = str(tmp_path / "in.xlsx"), str(tmp_path / "out.xlsx")
    xlsx.write_workbook(source, [["Case", "Summary"], ["k", None]])
    bad = spark.range(2, 9).select(F.col("id").alias("row"), F.lit("written").alias("action"), F.when(F.col("id") == 5, F.raise_error(F.lit("broken row")).cast("string")).otherwise("x").alias("text")).repartition(3)
    with pytest.raises(Exception, match="broken row"):
        xlsx.save_copy(bad, source, target, 2)
    assert os.listdir(tmp_path) == ["in.xlsx"]
    with pytest.raises(Exception, match="never overwritten"):
        xlsx.save_copy(bad.limit(0), source, source, 2)
    assert json.dumps(sorted(os.listdir(tmp_path))) == '["in.xlsx"]'
