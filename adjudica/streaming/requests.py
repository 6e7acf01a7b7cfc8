"""Requests as a keyed stream: what was asked, what came back, and what never did, each id once.

Events of a round (asked, done, result, tick) stand in an inbox folder. A state per custom id knows the batch that asks for
it, whether it is answered, and until when an answer is waited for; a timer tells what is overdue. Outcomes are written
by micro-batch, so one that runs again after a failure writes the same folder again and nothing is lost or repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.utils import AnalysisException

from adjudica.sources.providers import USAGE

ASKED, DONE, RESULT, TICK = "asked", "done", "result", "tick"
#: a first answer; one that came when its batch no longer asked; one to an id that has an answer; one nobody asked for; a
#: call that failed; and no answer in time
NEW, LATE, REPEAT, UNKNOWN, FAILED, EXPIRED = "new", "late", "repeat", "unknown", "failed", "expired"
FIELDS = f"batch string, ok boolean, answer string, reason string, usage {USAGE}, model string"
EVENTS = f"custom_id string, kind string, {FIELDS}"
OUTCOMES = f"custom_id string, outcome string, {FIELDS}"
STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: timers run in the micro-batch of a tick; without this Spark would go on with batches without data for ever
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled", "false"


class Request(StatefulProcessor):
    """The state of one id: the batch that asked last, until when it is waited for (null: no longer), whether answered."""

    def __init__(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.request = handle.getValueState("request", "batch string, due bigint, answered boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events = [r for r in rows if r.kind != TICK]
        if not events:
            return
        known = self.request.exists()
        batch, due, answered = self.request.get() if known else (None, None, False)
        before = due
        # what was asked in the same micro-batch was asked before it was answered
        for r in sorted(events, key=lambda r: (r.kind == RESULT, not r.ok)):
            if r.kind == RESULT:
                if not known:
                    outcome = UNKNOWN
                elif answered:
                    outcome = REPEAT
                elif not r.ok:
                    outcome = FAILED
                else:
                    outcome = NEW if due is not None and r.batch == batch else LATE
                    answered = True
                if known and (answered or r.batch == batch):
                    due = None
                yield Row(custom_id=key[0], outcome=outcome, batch=r.batch, ok=r.ok, answer=r.answer, reason=r.reason, usage=r.usage, model=r.model)
            else:
                known, answered = True, answered or r.kind == DONE
                if r.batch != batch and not answered:
                    due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
                batch = r.batch
                if answered:
                    due = None
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is not None and before != due:
            self.handle.registerTimer(due)
        if known:
            self.request.update((batch, due, answered))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        batch, due, answered = self.request.get()
        if answered or due != expiredTimerInfo.getExpiryTimeInMs():
            return
        self.request.update((batch, None, False))
        yield Row(custom_id=key[0], outcome=EXPIRED, batch=batch, ok=False, answer=None, reason="no answer in time", usage=None, model=None)

    def close(self) -> None:
        pass


class Requests:
    """The stream of a round: events are put, advance() goes through all that are new, outcomes() are those of all runs."""

    def __init__(self, spark: SparkSession, folder: str, wait_s: float) -> None:
        self.spark, self.wait_ms = spark, int(wait_s * 1000)
        self.inbox, self.found, self.checkpoint = f"{folder}/inbox", f"{folder}/outcomes", f"{folder}/checkpoint"

    def put(self, events: DataFrame) -> None:
        """events(custom_id, kind and any of the other fields); the same events again change nothing."""
        names = self.spark.createDataFrame([], EVENTS).schema
        have = set(events.columns)
        events.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in names]).write.mode("append").parquet(self.inbox)

    def advance(self) -> None:
        """Go through all new events, and tell what is overdue by now."""
        self.put(self.spark.createDataFrame([(f"tick-{uuid.uuid4().hex[:8]}", TICK)], "custom_id string, kind string"))
        events = self.spark.readStream.schema(EVENTS).parquet(self.inbox)
        # all ticks are one key without a state
        keyed = events.withColumn("custom_id", F.when(F.col("kind") == TICK, "").otherwise(F.col("custom_id")))
        out = keyed.groupBy("custom_id").transformWithState(Request(self.wait_ms), OUTCOMES, "Append", "ProcessingTime")
        was = {k: self.spark.conf.get(k, None) for k, _ in (STORE, NO_DATA)}
        for k, v in (STORE, NO_DATA):
            self.spark.conf.set(k, v)
        try:
            query = out.writeStream.foreachBatch(self._write).outputMode("append").option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        finally:
            for k, v in was.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        query.awaitTermination()

    def _write(self, outcomes: DataFrame, epoch: int) -> None:
        outcomes.write.mode("overwrite").parquet(f"{self.found}/epoch={epoch}")

    def outcomes(self, after: int = -1) -> DataFrame:
        """Outcomes with the epoch of the micro-batch they are of; those after one that is done with."""
        schema = f"{OUTCOMES}, epoch bigint"
        try:
            return self.spark.read.schema(schema).parquet(self.found).where(F.col("epoch") > after)
        except AnalysisException:
            return self.spark.createDataFrame([], schema)
