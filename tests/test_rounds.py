"""A round's batches through the runner: jobs do not grow with batches, broken runs repeat and lose nothing, what is overdue
is asked again, and failures keep their reasons."""

import json
import time

import pytest
from pyspark.sql import functions as F

from adjudica.functions import scratch
from adjudica.functions.keys import custom_id
from adjudica.plans.policy import LEGAL
from adjudica.plans.runner import MAP, STRUCTURE, Runner
from adjudica.sources.providers import USAGE

CASES = [f"10000{i:02}-{i:02}.2099.8.26.0100" for i in range(1, 9)]
ANSWER = {"outcome": "upheld", "summary": "JULGADO PROCEDENTE o pedido.", "claims": [{"rawClaim": "danos morais", "canonicalClaim": "Danos morais", "outcome": "upheld"}]}


class Queue:
    """A remote queue in memory: what was asked, answered when it is told to end."""

    def __init__(self, spark, answer):
        self.spark, self.answer, self.asked, self.ended, self.calls = spark, answer, {}, set(), 0

    def create(self, requests):
        batch = f"b{len(self.asked) + 1}"
        self.asked[batch] = [(r.case_number, r.custom_id, r.text) for r in requests.collect()]
        return batch

    def status(self, batch):
        return {"ended": batch in self.ended}

    def results_of(self, batches):
        self.calls += 1
        rows = [(i, (a := self.answer(k)) is not None, a, None if a else "errored: overloaded", (10, 5, 0, 0), "m", b) for b in batches for k, i, _ in self.asked[b]]
        return self.spark.createDataFrame(rows, f"custom_id string, ok boolean, answer string, reason string, usage {USAGE}, model string, batch string")


@pytest.fixture
def runner(spark, tmp_path):
    def make(cases, chunk=2, answer=lambda k: f"map of {k}", **more):
        r = Runner(spark, str(tmp_path / "state"), None, LEGAL.__class__(chunk=chunk), clients={MAP: Queue(spark, answer), STRUCTURE: Queue(spark, lambda k: json.dumps(ANSWER))}, **more)
        if r.table("targets").isEmpty():
            rows = spark.createDataFrame([(i, k, None) for i, k in enumerate(cases, 2)], "row int, case_number string, previous_text string")
            r._append(rows, "targets")
            r._append(rows.select("case_number", F.concat(F.lit("text of "), "case_number").alias("text")), "texts")
        return r

    return make


def jobs(spark, run):
    count = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = count()
    run()
    return count() - before


def test_jobs_do_not_grow_with_batches(spark, runner):
    """Collecting eight batches takes as many jobs as collecting one."""
    r = runner(CASES, chunk=8)
    assert r.submit(MAP) == ["b1"]
    r.clients[MAP].ended = {"b1"}
    one = jobs(spark, lambda: r.collect(MAP))
    # the same again, in eight batches, as a map round of its own
    s = Runner(spark, r.folder + "-2", None, LEGAL.__class__(chunk=1), clients={MAP: Queue(spark, r.clients[MAP].answer), STRUCTURE: r.clients[STRUCTURE]})
    s._append(r.table("targets"), "targets")
    s._append(r.table("texts"), "texts")
    assert len(s.submit(MAP)) == 8
    s.clients[MAP].ended = {f"b{i}" for i in range(1, 9)}
    out = []
    eight = jobs(spark, lambda: out.append(s.collect(MAP)))
    assert out[0]["collected"] == 8 and s.clients[MAP].calls == 1
    assert eight <= one + 4, (one, eight)
    assert scratch.clear(spark) > 0


def test_a_broken_collect_is_repeated(spark, runner, monkeypatch):
    r = runner(CASES[:4])
    r.submit(MAP)
    r.clients[MAP].ended = {"b1"}

    def lost(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Runner, "_store", lost)
        with pytest.raises(OSError, match="lost"):
            r.collect(MAP)
    assert r.table("usage").count() == 2 and r.table("maps").count() == 0
    assert r.submit(MAP) == [], "what was paid for is not asked again"
    got = r.collect(MAP)
    assert (got["collected"], got["pending"]) == (2, ["b2"]) and r.table("usage").count() == 2
    r.clients[MAP].ended.add("b2")
    assert r.collect(MAP)["collected"] == 2 and sorted(x.case_number for x in r.table("maps").collect()) == CASES[:4]
    assert r.collect(MAP)["collected"] == 0


def test_overdue_requests_are_asked_again(spark, runner):
    r = runner(CASES[:2], chunk=5, wait_seconds=1)
    queue = r.clients[MAP]
    assert r.submit(MAP) == ["b1"] and r.collect(MAP)["pending"] == ["b1"]
    time.sleep(1.2)
    assert r.collect(MAP)["expired"] == 2 and r.collect(MAP)["expired"] == 0
    assert {(x.outcome, x.reason) for x in r.table("failures").collect()} == {("expired", "no answer in time")}
    r.wait_seconds = 3600
    assert r.submit(MAP) == ["b2"] and r.collect(MAP)["pending"] == ["b2"]
    # the second answers; the first, which is not waited for, ends later and is no longer looked at
    queue.ended = {"b1", "b2"}
    got = r.collect(MAP)
    assert (got["collected"], got["skipped"]) == (2, 0) and r.table("usage").select("batch").distinct().count() == 1
    # its answers, should they come in all the same, neither add nor bill
    r._requests(MAP).put(queue.results_of(["b1"]).withColumn("kind", F.lit("result")))
    again = r.collect(MAP)
    assert (again["collected"], again["skipped"], again["cost"]) == (0, 2, 0.0) and r.table("maps").count() == 2


def test_new_rows_enter_once(spark, runner, monkeypatch):
    """A second run sees the new case alone, and what a broken submission left over."""
    r = runner(CASES[:3], chunk=2)
    queue = r.clients[MAP]
    make, made = queue.create, []

    def once(requests):
        if made:
            raise OSError("down")
        made.append(1)
        return make(requests)

    r.attempts, r.sleep = 1, lambda s: None
    with monkeypatch.context() as m:
        m.setattr(queue, "create", once)
        with pytest.raises(RuntimeError, match="down"):
            r.submit(MAP)
    assert r.submit(MAP) == ["b2"] and [k for k, _, _ in queue.asked["b2"]] == CASES[2:3]
    new = spark.createDataFrame([(CASES[3], "text of the fourth")], "case_number string, text string")
    r._append(new, "texts")
    r._append(spark.createDataFrame([(9, CASES[3], None)], "row int, case_number string, previous_text string"), "targets")
    seen = []
    entering = Runner._entering
    monkeypatch.setattr(Runner, "_entering", lambda self, round_: seen.append(entering(self, round_)) or seen[-1])
    assert r.submit(MAP) == ["b3"] and [x.case_number for x in seen[-1][0].collect()] == CASES[3:4]
    queue.answer = lambda k: " " if k == CASES[3] else f"map of {k}"
    queue.ended = {"b1", "b2", "b3"}
    assert r.collect(MAP)["collected"] == 3
    assert r.submit(MAP) == ["b4"], "a blank answer is asked again"
    assert [x.reason for x in r.table("failures").collect()] == ["empty answer"]


def test_failures_keep_their_reasons(spark, runner):
    r = runner(CASES[:3], chunk=5, answer=lambda k: None if k == CASES[0] else f"map of {k}")
    r.submit(MAP)
    r.clients[MAP].ended = {"b1"}
    unknown = spark.createDataFrame([("nobody", "result", "b1", True, "x")], "custom_id string, kind string, batch string, ok boolean, answer string")
    r._requests(MAP).put(unknown)
    got = r.collect(MAP)
    assert (got["collected"], got["failed"], got["invalid"]) == (2, 1, 1)
    r.clients[STRUCTURE].answer = lambda k: json.dumps(ANSWER if k == CASES[1] else ANSWER | {"outcome": "won", "claims": []})
    r.submit(STRUCTURE)
    r.clients[STRUCTURE].ended = {"b1"}
    got = r.collect(STRUCTURE)
    assert (got["collected"], got["invalid"]) == (1, 1)
    told = {(x.round, x.outcome, x.case_number, x.reason) for x in r.table("failures").collect()}
    assert told == {
        (MAP, "failed", CASES[0], "errored: overloaded"), (MAP, "unknown", None, "not asked for"),
        (STRUCTURE, "invalid", CASES[2], "$.outcome: not one of upheld, partly_upheld, dismissed, terminated, not_identified; $.claims: no entries"),
    }
    assert r.submit(MAP) == ["b2"], "a failed case is asked again"
    assert [k for k, _, _ in r.clients[MAP].asked["b2"]] == CASES[:1]
    assert spark.range(1).select(custom_id(F.lit(CASES[0]))).first()[0] == r.clients[MAP].asked["b2"][0][1]
