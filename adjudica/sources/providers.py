"""Where answers come from: a provider protocol, one that replays recordings, and careful calling."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

USAGE = "struct<input_tokens:bigint,output_tokens:bigint,cache_creation_input_tokens:bigint,cache_read_input_tokens:bigint>"
RECORDINGS = f"model string, recordings array<struct<caseNumber:string,map:string,result:string,audit:struct<severity:string,unsupported:array<string>,score:double>,parity:struct<verdict:string,sameOutcome:boolean,houseStyle:boolean,score:double>,usage:struct<map:{USAGE},structure:{USAGE},audit:{USAGE},parity:{USAGE}>>>"


class Provider(Protocol):
    """Rounds of a model as tables. Each takes the columns named and nothing else, and returns (case_number, answer,
    usage, model), the answer null where the call failed."""

    def map(self, cases: DataFrame) -> DataFrame: ...  # case_number, text
    def structure(self, maps: DataFrame) -> DataFrame: ...  # case_number, text: the map alone
    def audit(self, rows: DataFrame) -> DataFrame: ...  # case_number, source, summary
    def compare(self, pairs: DataFrame) -> DataFrame: ...  # case_number, reference, generated


class BatchClient(Protocol):
    """A queue of requests that are answered hours later."""

    def create(self, requests: DataFrame) -> str: ...  # case_number, custom_id, text; the batch's id
    def status(self, batch: str) -> dict: ...  # ended, and how many are processing, succeeded, errored, canceled, expired
    def results(self, batch: str) -> DataFrame: ...  # custom_id, ok, answer, reason, usage, model
    # optional: results_of(batches), the same for several, with the column batch


class Store(Protocol):
    """A place documents are scanned from: what there is, without contents, and the contents of those wanted."""

    def list(self) -> DataFrame: ...  # id, name, path, bytes, kind, case_number
    def read(self, wanted: DataFrame) -> DataFrame: ...  # id, content


class Recorded:
    """Replays a file of recordings, found by a key in what is asked, else by the very text of a map or a summary."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        r = spark.read.schema(RECORDINGS).json(path, multiLine=True).select("model", F.explode("recordings").alias("r"))
        self.table = r.select("model", "r.*").withColumnRenamed("caseNumber", "case_number")

    def _answer(self, asked: DataFrame, answer: str, usage: str) -> DataFrame:
        got = self.table.select(F.col("case_number").alias("_of"), F.col(answer).alias("answer"), F.col(f"usage.{usage}").alias("usage"), "model")
        own = asked.select("case_number", F.col("case_number").alias("_of"))
        if "text" in asked.columns:
            known = self.table.select("case_number", "map", F.get_json_object("result", "$.summary").alias("summary"))
            found = find_recording(asked.select(F.col("case_number").alias("id"), "text"), known).select(F.col("id").alias("_id"), F.col("case_number").alias("_by_text"))
            own = own.join(found, F.col("case_number") == F.col("_id"), "left").select("case_number", F.coalesce("_by_text", "_of").alias("_of"))
        return own.join(got, "_of", "left").drop("_of")

    def map(self, cases: DataFrame) -> DataFrame:
        return self._answer(cases, "map", "map")

    def structure(self, maps: DataFrame) -> DataFrame:
        return self._answer(maps, "result", "structure")

    def audit(self, rows: DataFrame) -> DataFrame:
        return self._answer(rows.drop("text"), "audit", "audit")

    def compare(self, pairs: DataFrame) -> DataFrame:
        return self._answer(pairs.drop("text"), "parity", "parity")


class ProviderBatches:
    """A batch client over a provider's round: requests stand in a folder, so another process can collect them."""

    def __init__(self, spark: SparkSession, folder: str, ask: Callable[[DataFrame], DataFrame]) -> None:
        self.spark, self.folder, self.ask = spark, folder, ask

    def create(self, requests: DataFrame) -> str:
        batch = f"batch-{uuid.uuid4().hex[:12]}"
        requests.select("case_number", "custom_id", "text").write.parquet(f"{self.folder}/{batch}")
        return batch

    def status(self, batch: str) -> dict:
        state = F.when(F.col("ok"), "succeeded").otherwise("errored")
        counts = batch_counts(self.results(batch).select(F.lit(batch).alias("batch"), state.alias("state"))).first()
        return {"id": batch, "ended": True} | (counts.asDict() if counts else {})

    def results(self, batch: str) -> DataFrame:
        return self.results_of([batch]).drop("batch")

    def results_of(self, batches: list[str]) -> DataFrame:
        asked = self.spark.read.schema("case_number string, custom_id string, text string").parquet(*[f"{self.folder}/{b}" for b in batches])
        asked = asked.withColumn("batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        # a case stands in one batch, or in a later one again: the answer is the same
        got = self.ask(asked.select("case_number", "text").dropDuplicates(["case_number"])).join(asked.select("case_number", "custom_id", "batch"), "case_number")
        ok = F.col("answer").isNotNull()
        return got.select("custom_id", ok.alias("ok"), "answer", F.when(~ok, "errored").alias("reason"), "usage", "model", "batch")


#: a key or text that more than this share of the rows have is met by broadcast: there are 256 at most
OFTEN = 1 / 256


def _often(df: DataFrame, *columns: str) -> list[list[str]]:
    """Of each column the values that more than OFTEN of the rows have, and maybe others, 256 at most: one pass in which a
    task keeps so many counts."""
    found = df.stat.freqItems(columns, OFTEN).first()
    return [[v for v in found[f"{c}_freqItems"] or [] if v is not None] for c in columns]


def _looked_up(many: DataFrame, key: str, often: list[str], one: DataFrame, of: str) -> DataFrame:
    """many left joined with one, which has a row for each value of ``of``. Rows without a key are not shuffled, those of a
    frequent one meet it by broadcast; no task gets more than the share of a rarer key. What is shuffled is not broadcast,
    however small its compressed files are."""
    named, on = [c for c in one.columns if c != of], F.col(key) == F.col(of)
    frequent = F.col(key).isin(often)
    none = many.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(one.schema[c].dataType).alias(c) for c in named])
    rest = many.where(F.col(key).isNotNull() & ~frequent).join(one.hint("merge"), on, "left").drop(of)
    if not often:
        return rest.unionByName(none)
    few = many.where(frequent).join(F.broadcast(one.where(F.col(of).isin(often))), on, "left").drop(of)
    return rest.unionByName(none).unionByName(few)


def find_recording(asked: DataFrame, recordings: DataFrame) -> DataFrame:
    """asked(id, text) with the case_number of its recording: by a key in the text, else by the very text of a map, else
    by that of a summary; null where none fits. recordings(case_number, map, summary).

    Texts are compared by hash first, so two equi-joins on short keys do; of several recordings the smallest key wins.
    Texts and keys that very many rows ask for are looked for first, in a pass over asked.
    """
    from adjudica.functions import keys

    known = recordings.where(F.col("case_number").isNotNull()).select(F.col("case_number").alias("_of_key"), F.col("case_number").alias("by_key")).distinct()
    texts = [F.struct(F.sha2(c, 256).alias("_of_text"), *[(F.col("case_number") if c == d else F.lit(None)).cast("string").alias(f"by_{d}") for d in ("map", "summary")]) for c in ("map", "summary")]
    texts = recordings.select(F.explode(F.array(*texts)).alias("t")).select("t.*").where("_of_text is not null")
    texts = texts.groupBy("_of_text").agg(F.coalesce(F.min("by_map"), F.min("by_summary")).alias("by_text"))
    own = asked.withColumn("_key", keys.first_key(F.col("text"))).withColumn("_text", F.sha2("text", 256))
    often_keys, often_texts = _often(own, "_key", "_text")
    out = _looked_up(own, "_key", often_keys, known, "_of_key")
    out = _looked_up(out, "_text", often_texts, texts, "_of_text")
    return out.select(*asked.columns, F.coalesce("by_key", "by_text").alias("case_number"))


def batch_counts(requests: DataFrame) -> DataFrame:
    """batch, processing, succeeded, errored, canceled, expired from requests(batch, state)."""
    return requests.groupBy("batch").agg(*[F.count_if(F.col("state") == k).alias(k) for k in ("processing", "succeeded", "errored", "canceled", "expired")])


def with_retry(call: Callable, label: str, attempts: int = 20, step_s: float = 15, most_s: float = 60, sleep: Callable[[float], None] = time.sleep):
    """The call's result, tried again after waits that grow by a step up to a most; the last error is named."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001  any failure of a remote call may pass
            if n == attempts:
                raise RuntimeError(f"{label}: {attempts} attempts failed, last: {e}") from e
            sleep(min(most_s, n * step_s))


def in_order(items: Iterable, call: Callable, at_once: int = 2) -> list:
    """Results in the items' order, with at most so many calls open."""
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return list(pool.map(call, items))
