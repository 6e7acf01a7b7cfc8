"""A provider of live calls: tasks ask a function, a few requests at once, and write every answer ahead of using it.

An answer is stored under its request's id, a hash of what is asked, before the task goes on. A task that is lost and runs
again, or a run that starts anew, finds it there: what was paid for is not asked for again. Of a request that was on its way
when its task was lost nothing is known; it alone is asked twice. Leave ``spark.speculation`` off: two copies of a task
would both ask.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.sources import stores
from adjudica.sources.providers import USAGE, in_order, with_retry

#: what is asked in a round, and the form of its answer
ROUNDS = {
    "map": (("text",), None), "structure": (("text",), None),
    "audit": (("source", "summary"), "struct<severity:string,unsupported:array<string>,score:double>"),
    "compare": (("reference", "generated"), "struct<verdict:string,sameOutcome:boolean,houseStyle:boolean,score:double>"),
}
TOKENS = ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")
#: (round, request) to {"answer", "usage", "model"}: a text, or an object for the rounds whose answer is one
Ask = Callable[[str, dict[str, str]], dict]


def request_id(round_: str, request: dict[str, str]) -> str:
    """The same for the same question, whatever task or run asks it."""
    return hashlib.sha256(json.dumps([round_, request], sort_keys=True, ensure_ascii=False).encode()).hexdigest()


class Log:
    """Answers by request id in a folder that all executors share."""

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def _place(self, key: str) -> str:
        return f"{self.folder}/{key[:2]}/{key}.json"

    def get(self, key: str) -> dict | None:
        try:
            return json.loads(stores.opened(self._place(key)))
        except FileNotFoundError:
            return None

    def put(self, key: str, answer: dict) -> None:
        """Whole or not at all: written beside its place and then moved there."""
        place, body = self._place(key), json.dumps(answer, ensure_ascii=False).encode()
        scheme, colon, rest = place.partition(":")
        if not colon or "/" in scheme or scheme == "file":
            at = "/" + rest.lstrip("/") if scheme == "file" else place
            os.makedirs(os.path.dirname(at), exist_ok=True)
            beside = f"{at}.{uuid.uuid4().hex[:8]}"
            with open(beside, "wb") as f:
                f.write(body)
                f.flush()
                os.fsync(f.fileno())
            os.replace(beside, at)
            return
        from pyarrow import fs

        host, _, path = rest.lstrip("/").partition("/")
        store, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
        at = f"{base.rstrip('/')}/{path}"
        store.create_dir(os.path.dirname(at), recursive=True)
        beside = f"{at}.{uuid.uuid4().hex[:8]}"
        with store.open_output_stream(beside) as f:
            f.write(body)
        store.move(beside, at)


class Calls:
    """Rounds as tables over a function. Each takes the columns named and nothing else, and returns (case_number, answer,
    usage, model, reason); a call that fails at all attempts has a null answer, and its reason."""

    def __init__(self, spark: SparkSession, folder: str, ask: Ask, at_once: int = 2, attempts: int = 5, step_s: float = 15, most_s: float = 60) -> None:
        self.spark, self.folder, self.ask = spark, folder, ask
        self.at_once, self.attempts, self.step_s, self.most_s = max(1, at_once), attempts, step_s, most_s

    def _asked(self, rows: DataFrame, round_: str) -> DataFrame:
        columns, form = ROUNDS[round_]
        log, ask, at_once, attempts, step_s, most_s = Log(self.folder), self.ask, self.at_once, self.attempts, self.step_s, self.most_s

        def one(request: dict[str, str]) -> tuple:
            key = request_id(round_, request)
            try:
                got = log.get(key)
                if got is None:
                    got = with_retry(lambda: ask(round_, request), f"{round_} {request['case_number']}", attempts, step_s, most_s)
                    log.put(key, got)
            except Exception as e:  # noqa: BLE001  a call that fails is told, the others go on
                return None, None, None, str(e)[:500]
            answer, usage = got["answer"], got.get("usage") or {}
            text = answer if answer is None or isinstance(answer, str) else json.dumps(answer, ensure_ascii=False)
            return text, {t: int(usage.get(t) or 0) for t in TOKENS}, got.get("model"), None if text else "empty answer"

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                requests = [{k: v or "" for k, v in r.items()} for r in batch.to_pylist()]
                for k in range(0, len(requests), at_once):
                    some = requests[k : k + at_once]
                    texts, usage, models, reasons = zip(*in_order(some, one, at_once), strict=True)
                    columns = [[r["case_number"] for r in some], list(texts), list(usage), list(models), list(reasons)]
                    yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, KINDS, strict=True)], names=["case_number", "answer", "usage", "model", "reason"])

        # calls are slow and rows few: as many tasks as the session has partitions
        dealt = rows.select("case_number", *columns).repartition(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        out = dealt.mapInArrow(task, f"case_number string, answer string, usage {USAGE}, model string, reason string")
        out = out.withColumn("answer", F.when(F.col("answer") != "", F.col("answer")))
        return out.withColumn("answer", F.from_json("answer", form)) if form else out

    def map(self, cases: DataFrame) -> DataFrame:
        return self._asked(cases, "map")

    def structure(self, maps: DataFrame) -> DataFrame:
        return self._asked(maps, "structure")

    def audit(self, rows: DataFrame) -> DataFrame:
        return self._asked(rows, "audit")

    def compare(self, pairs: DataFrame) -> DataFrame:
        return self._asked(pairs, "compare")


KINDS = (pa.string(), pa.string(), pa.struct([(t, pa.int64()) for t in TOKENS]), pa.string(), pa.string())
