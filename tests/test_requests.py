"""The keyed stream of requests: repeats, late and failed answers, expiry, and a run that breaks between write and commit."""

import shutil
import time
from pathlib import Path

import pytest

from adjudica.streaming import requests as R

RESULT = "custom_id string, kind string, batch string, ok boolean, answer string, reason string"


def asked(spark, batch, *ids, kind=R.ASKED):
    return spark.createDataFrame([(i, kind, batch) for i in ids], "custom_id string, kind string, batch string")


def results(spark, batch, *rows):
    return spark.createDataFrame([(i, R.RESULT, batch, a is not None, a, None if a else "errored") for i, a in rows], RESULT)


def told(stream, after=-1):
    return sorted((r.custom_id, r.outcome, r.batch, r.answer) for r in stream.outcomes(after).collect())


def last(stream):
    return stream.outcomes().selectExpr("max(epoch)").first()[0]


def test_every_id_once(spark, tmp_path):
    s = R.Requests(spark, str(tmp_path), 3600)
    assert told(s) == []
    s.put(asked(spark, "b1", "a", "b", "c", "d"))
    s.put(asked(spark, "b0", "old", kind=R.DONE))
    s.put(results(spark, "b1", ("a", "1"), ("b", None), ("zz", "?"), ("old", "x"), ("a", "1")))
    s.advance()
    assert told(s) == [("a", "new", "b1", "1"), ("a", "repeat", "b1", "1"), ("b", "failed", "b1", None), ("old", "repeat", "b1", "x"), ("zz", "unknown", "b1", "?")]
    # a restart puts the same again: nothing is new, and what was open is still waited for
    s, epoch = R.Requests(spark, str(tmp_path), 3600), last(s)
    s.put(asked(spark, "b1", "a", "b", "c", "d"))
    s.put(results(spark, "b1", ("a", "1"), ("c", "3")))
    s.advance()
    assert told(s, epoch) == [("a", "repeat", "b1", "1"), ("c", "new", "b1", "3")]
    # a failed one is asked again in another batch; an answer of the first comes too late to be awaited, but counts
    epoch = last(s)
    s.put(asked(spark, "b2", "b", "d"))
    s.advance()
    s.put(results(spark, "b1", ("d", "4")))
    s.put(results(spark, "b2", ("b", "2"), ("d", "5")))
    s.advance()
    got = told(s, epoch)
    assert ("b", "new", "b2", "2") in got and sorted(x[1] for x in got if x[0] == "d")[1] == "repeat" and len(got) == 3


def test_overdue_requests_expire_and_late_answers_count(spark, tmp_path):
    s = R.Requests(spark, str(tmp_path), 1)
    s.put(asked(spark, "b1", "a", "b", "c"))
    s.put(results(spark, "b1", ("c", "3")))
    s.advance()
    epoch = last(s)
    time.sleep(1.5)
    s.advance()
    assert told(s, epoch) == [("a", "expired", "b1", None), ("b", "expired", "b1", None)]
    epoch = last(s)
    s.put(asked(spark, "b1", "a", "b"))  # said again, not asked again: waits no more
    s.put(asked(spark, "b2", "b"))
    s.advance()
    s.put(results(spark, "b1", ("a", "1")))
    s.put(results(spark, "b2", ("b", "2")))
    s.advance()
    got = told(s, epoch)
    assert ("a", "late", "b1", "1") in got and {x[1] for x in got if x[0] == "b" and x[3]} <= {"new", "late"} and sum(x[3] is not None for x in got) == 2


def test_a_broken_run_is_repeated(spark, tmp_path, monkeypatch):
    """The sink writes and then fails: the next run does the same micro-batch again, into the same folder."""
    s = R.Requests(spark, str(tmp_path), 3600)
    s.put(asked(spark, "b1", "a", "b"))
    s.advance()
    whole = R.Requests._write

    def broken(self, outcomes, epoch):
        whole(self, outcomes, epoch)
        raise OSError("lost")

    monkeypatch.setattr(R.Requests, "_write", broken)
    s.put(results(spark, "b1", ("a", "1"), ("b", "2")))
    with pytest.raises(Exception, match="lost"):
        s.advance()
    monkeypatch.setattr(R.Requests, "_write", whole)
    s.advance()
    assert told(s) == [("a", "new", "b1", "1"), ("b", "new", "b1", "2")]
    # a run that lost what it had written writes it again
    epoch = last(s)
    shutil.rmtree(Path(tmp_path, "outcomes", f"epoch={epoch}"), ignore_errors=True)
    s.put(results(spark, "b1", ("a", "1")))
    s.advance()
    assert [x[1] for x in told(s, epoch)] == ["repeat"]
