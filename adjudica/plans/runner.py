"""A resumable run: every stage reads tables, does what is not done yet, and appends to its own table.

Stages are extract, a map round and a structuring round (each submitted in batches and collected), audit and delivery. A
stage's table in the state folder is the cut between stages: a second run finds nothing left and pays nothing. Batch ids
are stored as soon as a batch is made, and what is in an open batch is not submitted again. Results come in through a
keyed stream that knows what was asked and what is overdue; all that is new is priced, its usage stored, then validated
and stored at once, however many batches it came in. What failed is stored with its reason.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from adjudica.functions import keys
from adjudica.functions.scratch import counted, written
from adjudica.functions.text import trim_all
from adjudica.operators import catalogue, cost, evaluate, gate, grid, planning, sampling, segmentation, state, structured
from adjudica.plans.policy import LEGAL, Policy
from adjudica.sources import providers, xlsx
from adjudica.streaming import requests as stream
from adjudica.streaming.stages import NewRows

CLAIMS = "array<struct<raw_claim:string,canonical_claim:string,outcome:string,later_decision:string,notes:string,confidence:string>>"
TOKENS = ("input_tokens", "output_tokens", "cache_write_tokens", "cache_read_tokens")
TABLES = {
    "targets": "row int, case_number string, previous_text string",
    "plans": "case_number string, strategy string, documents array<string>, skipped array<struct<name:string,why:string>>",
    "texts": "case_number string, text string",
    "batches": "round string, batch string, case_number string, custom_id string",
    "announced": "round string, batch string",
    "collected": "round string, batch string",
    "epochs": "round string, epoch bigint",
    "entered": "round string, epoch bigint",
    "failures": "round string, batch string, case_number string, custom_id string, outcome string, reason string",
    "usage": f"round string, batch string, case_number string, model string, {', '.join(f'{t} bigint' for t in TOKENS)}, cost_usd double, priced_with string",
    "maps": "case_number string, text string",
    "cases": f"case_number string, version bigint, summary string, status string, gate_reason string, outcome string, claims {CLAIMS}",
    "audits": "case_number string, version bigint, severity string, unsupported array<string>",
}
MAP, STRUCTURE, AUDIT, COMPARE = "map", "structure", "audit", "compare"
DONE = {MAP: "maps", STRUCTURE: "cases"}
#: the table whose new rows enter a round
ENTERS = {MAP: "texts", STRUCTURE: "maps"}
#: ids to (id, text, pages[, error]) of these
Reader = Callable[[DataFrame], DataFrame]


@dataclass
class Runner:
    spark: SparkSession
    folder: str
    provider: providers.Provider
    policy: Policy = LEGAL
    prices: DataFrame | None = None
    model: str | None = None  # what usage is priced as; None: what the answer names
    clients: dict[str, providers.BatchClient] = field(default_factory=dict)
    attempts: int = 20
    retry_max_s: float = 60
    poll_seconds: float = 120
    wait_seconds: float = 26 * 3600  # a request without an answer for so long is asked again
    sleep: Callable[[float], None] = time.sleep
    log: Callable[[str], None] = lambda line: None

    def __post_init__(self) -> None:
        for name in (MAP, STRUCTURE):
            if name not in self.clients:
                self.clients[name] = providers.ProviderBatches(self.spark, f"{self.folder}/requests/{name}", getattr(self.provider, name))
        if self.prices is None:
            self.prices, _ = cost.load_prices(self.spark, None)

    # --- tables -----------------------------------------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], TABLES[name])

    def _append(self, df: DataFrame, name: str, mode: str = "append") -> int:
        """Write the new rows of a stage; how many there were, counted as they are written."""
        seen = Observation()
        df.select(*self.table(name).columns).observe(seen, F.count("*").alias("n")).write.mode(mode).parquet(f"{self.folder}/{name}")
        self.spark.catalog.refreshByPath(f"{self.folder}/{name}")
        return seen.get["n"]

    def _add(self, df: DataFrame, name: str) -> None:
        """Append rows that are cheap to work out: one job, no count."""
        df.select(*self.table(name).columns).write.mode("append").parquet(f"{self.folder}/{name}")
        self.spark.catalog.refreshByPath(f"{self.folder}/{name}")

    def save_cases(self, records: DataFrame) -> int:
        """Upsert: the latest version of a case is the case."""
        version = (self.table("cases").agg(F.max("version")).first()[0] or 0) + 1
        return self._append(records.withColumn("version", F.lit(version).cast("bigint")), "cases")

    def cases(self) -> DataFrame:
        return state.latest(self.table("cases"), ["case_number"], ["version"])

    def plans(self) -> DataFrame:
        """The last plan of each case; one with documents before one without."""
        order = F.struct(F.size("documents"), "strategy")
        best = self.table("plans").groupBy("case_number").agg(F.max_by(F.struct("strategy", "documents", "skipped"), order).alias("p"))
        return best.select("case_number", "p.*")

    def targets(self) -> DataFrame:
        return state.last_row_wins(self.table("targets").withColumn("custom_id", keys.custom_id(F.col("case_number"))))

    # --- extract ----------------------------------------------------------------------------------------------------
    def extract(self, targets: DataFrame, docs: DataFrame, texts: DataFrame | Reader, limit: int | None = None) -> dict[str, int]:
        """targets(row, case_number[, existing]), docs(id, path, name, bytes, kind, case_number), texts(id, text, pages).

        texts may be a function that is given the ids to read, and reads no others: those of plans, unless they are too
        large. Counts targets, extracted, already_done, no_source and failed (cases whose documents have no text at all).
        What each case was read from, and why a document was not, is stored with its plan, an error of reading too.
        """
        previous = F.col("existing") if "existing" in targets.columns else F.lit(None).cast("string")
        rows = targets.select(F.col("row").cast("int").alias("row"), "case_number", previous.alias("previous_text"))
        n_targets = self._append(rows, "targets", "overwrite")
        wanted = state.first_n(rows, [F.col("row")], limit) if limit else rows
        wanted = state.last_row_wins(wanted.withColumn("custom_id", keys.custom_id(F.col("case_number")))).select("case_number")
        done = self.table("texts").select("case_number").union(self.table("cases").select("case_number")).distinct().withColumn("_done", F.lit(True))
        asked, n = counted(wanted.join(done, "case_number", "left"), "asked", wanted=F.count("*"), todo=F.count_if(F.col("_done").isNull()))
        todo = asked.where("_done is null").select("case_number")
        plan = planning.reading_plan(docs.where("case_number is not null").join(todo, "case_number", "left_semi"), todo, self.policy.kinds)
        plan = written(plan.join(docs.select(F.col("id").alias("_id"), "name"), F.col("id") == F.col("_id"), "left").drop("_id"), "plan")
        large = F.col("bytes") > self.policy.max_document_mb * 1024 * 1024
        if callable(texts):
            texts = written(texts(plan.where(F.col("id").isNotNull() & ~F.coalesce(large, F.lit(False))).select("id")), "texts")
        error = F.col("error") if "error" in texts.columns else F.lit(None).cast("string")
        have = texts.select("id", "text", "pages", error.alias("_error"), F.lit(True).alias("_read"))
        read = plan.join(have, "id", "left")
        unread = F.when(F.col("_error").isNotNull(), F.concat(F.lit("unread: "), F.left("_error", F.lit(200)))).when(F.col("_read").isNull(), "unread")
        why = F.when(F.col("id").isNotNull(), F.when(large, "too_large").otherwise(F.coalesce(unread, planning.skip_reason(F.col("bytes"), planning.is_scan(F.coalesce("text", F.lit("")), F.col("pages")), self.policy.max_document_mb))))
        read = written(read.withColumn("why", why), "read")
        used = F.col("id").isNotNull() & F.col("why").isNull()
        joined = planning.case_text(read.where(used).select("case_number", "pos", "kind", "name", "text")).select("case_number", "text")
        n_texts = self._append(state.non_blank(joined), "texts")
        counts = read.groupBy("case_number").agg(F.min("strategy").alias("strategy"), F.count_if(used).alias("n_used"), F.count_if(F.startswith("why", F.lit("unread"))).alias("n_unread"))
        counts, read_of = counted(counts, "counts", failed=F.count_if((F.col("n_used") == 0) & (F.col("n_unread") > 0)))
        self._append(planning.used_and_skipped(read.select("case_number", "pos", "name", "why")).join(counts, "case_number"), "plans")
        failed = read_of["failed"]
        return {"targets": n_targets, "extracted": n_texts, "already_done": n["wanted"] - n["todo"], "no_source": n["todo"] - n_texts - failed, "failed": failed}

    # --- batch rounds -----------------------------------------------------------------------------------------------
    def _retried(self, call: Callable, label: str):
        return providers.with_retry(call, label, self.attempts, most_s=self.retry_max_s, sleep=self.sleep)

    def open_batches(self, round_: str) -> DataFrame:
        """What is asked and not yet collected, without what is overdue."""
        mine = self.table("batches").where(F.col("round") == round_)
        mine = mine.join(self.table("collected").where(F.col("round") == round_).select("batch"), "batch", "left_anti")
        overdue = self.table("failures").where((F.col("round") == round_) & (F.col("outcome") == stream.EXPIRED)).select("batch", "custom_id")
        return mine.join(overdue, ["batch", "custom_id"], "left_anti")

    def _wanted(self, round_: str) -> DataFrame:
        """case_number, text of what the round has still to be asked: a map sees the reduced text, structuring the map."""
        if round_ == MAP:
            todo = state.todo(self.table("texts"), self.table("maps"), "case_number")
            return segmentation.segment(todo, policy=self.policy.segmentation).select("case_number", F.col("segmented").alias("text"))
        return state.todo(self.table("maps").select("case_number", "text"), self.table("cases"), "case_number")

    def _entering(self, round_: str) -> tuple[DataFrame, int | None]:
        """case_number, text of what is to be asked, and the epoch it is asked up to: cases that are new in the table
        before, and those that failed; neither done nor in an open batch. Old texts are not gone through."""
        name = ENTERS[round_]
        new = NewRows(self.spark, f"{self.folder}/{name}", TABLES[name], ["case_number"], f"{self.folder}/stream/{round_}-entered")
        if not self.table(name).isEmpty():
            new.advance()
        until = self.table("entered").where(F.col("round") == round_).agg(F.coalesce(F.max("epoch"), F.lit(-1))).first()[0]
        failed = self.table("failures").where((F.col("round") == round_) & F.col("case_number").isNotNull()).select("case_number")
        entered, n = counted(new.found(until), "entered", epoch=F.max("epoch"))
        cases = entered.select("case_number").unionByName(failed).distinct()
        todo = state.todo(cases, self.table(DONE[round_]), "case_number", self.open_batches(round_))
        todo, some = counted(todo, "todo", n=F.count("*"))
        texts = self.table(name).join(todo, "case_number", "left_semi").select("case_number", "text")
        if round_ == MAP:
            texts = segmentation.segment(texts, policy=self.policy.segmentation).select("case_number", F.col("segmented").alias("text"))
        return (texts if some["n"] else texts.limit(0)), n["epoch"]

    def submit(self, round_: str) -> list[str]:
        """Make batches of all that is neither done nor in an open batch; each id is stored before the next is made.

        Requests are written once, a folder for each chunk, so a batch reads its own rows only.
        """
        todo, epoch = self._entering(round_)
        numbered = sampling.chunked(todo, [F.col("case_number")], self.policy.chunk).withColumn("custom_id", keys.custom_id(F.col("case_number")))
        requests = written(numbered, "requests", by="chunk")
        chunks = sorted(r.chunk for r in requests.select("chunk").distinct().collect())
        made = []
        for k in chunks:
            part = requests.where(F.col("chunk") == k).drop("chunk")
            batch = self._retried(lambda part=part: self.clients[round_].create(part), f"{round_}-submit")
            self._add(part.select(F.lit(round_).alias("round"), F.lit(batch).alias("batch"), "case_number", "custom_id"), "batches")
            made.append(batch)
            self.log(f"  batch {len(made)}: {batch}")
        if epoch is not None:
            self._add(self.spark.createDataFrame([(round_, epoch)], TABLES["entered"]), "entered")
        return made

    def _priced(self, answers: DataFrame, discount: float) -> DataFrame:
        raw = {"input_tokens": "input_tokens", "output_tokens": "output_tokens", "cache_write_tokens": "cache_creation_input_tokens", "cache_read_tokens": "cache_read_input_tokens"}
        model = F.lit(self.model) if self.model else F.col("model")
        u = answers.select("case_number", *[c for c in ("batch",) if c in answers.columns], model.alias("model"), *[F.coalesce(F.col(f"usage.{v}"), F.lit(0)).alias(k) for k, v in raw.items()])
        return cost.priced(u, self.prices, discount)

    def _bill(self, answers: DataFrame, round_: str, discount: float) -> float | None:
        """Store the usage of answers(…, batch) once, whatever becomes of them; what they cost together."""
        usage, n = counted(self._priced(answers, discount).withColumn("round", F.lit(round_)), "usage", cost=cost.total_cost())
        known = self.table("usage").where(F.col("round") == round_).select(F.col("batch").alias("_b"), F.col("case_number").alias("_c")).distinct()
        self._append(usage.join(known, F.col("batch").eqNullSafe(F.col("_b")) & F.col("case_number").eqNullSafe(F.col("_c")), "left_anti"), "usage")
        return n["cost"]

    def _store(self, round_: str, answers: DataFrame) -> dict[str, int]:
        """answers(case_number, answer) that are new, into the round's table."""
        if round_ == MAP:
            n = self._append(state.non_blank(answers.select("case_number", F.col("answer").alias("text"))), "maps")
            if "batch" in answers.columns:
                empty = answers.where(trim_all(F.coalesce("answer", F.lit(""))) == "")
                self._fail(round_, empty.select("batch", "case_number", "custom_id", F.lit("invalid").alias("outcome"), F.lit("empty answer").alias("reason")))
            return {"collected": n}
        checked, told = counted(structured.validated(answers, "answer"), "checked", n=F.count("*"))
        got = checked.where("valid")
        names = self.spark.createDataFrame(list(enumerate(self.policy.claims)), "idx int, canonical string")
        claims = got.select("case_number", F.posexplode("result.claims").alias("i", "c")).select("case_number", "i", "c.*")
        fixed = catalogue.repair(claims, names, self.policy.not_identified, self.policy.match_threshold)
        fields = [f for f in ("raw_claim", "canonical_claim", "outcome", "later_decision", "notes", "confidence")]
        listed = fixed.groupBy("case_number").agg(F.array_sort(F.collect_list(F.struct("i", *fields))).alias("l"))
        listed = listed.select("case_number", F.transform("l", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("claims"))
        records = gate.gated(got.select("case_number", trim_all(F.col("result.summary")).alias("summary"), F.col("result.outcome").alias("outcome")), gate=self.policy.gate)
        new, of = counted(records.join(listed, "case_number"), "records", n=F.count("*"), ready=F.count_if(F.col("status") == "writeable"))
        n, ready = of["n"], of["ready"]
        if n:
            self.save_cases(new)
        invalid = told["n"] - n
        if invalid and "batch" in answers.columns:
            self._fail(round_, checked.where("not valid").select("batch", "case_number", "custom_id", F.lit("invalid").alias("outcome"), F.array_join("reasons", "; ").alias("reason")))
        return {"collected": n, "writeable": ready, "needs_review": n - ready, "invalid": invalid}

    def _requests(self, round_: str) -> stream.Requests:
        return stream.Requests(self.spark, f"{self.folder}/stream/{round_}", self.wait_seconds)

    def _announce(self, round_: str) -> None:
        """Tell the stream what batches ask for; a case that is done already is not waited for."""
        known = self.table("announced").where(F.col("round") == round_).select("batch")
        new = written(self.table("batches").where(F.col("round") == round_).join(known, "batch", "left_anti"), "announced")
        if new.isEmpty():
            return
        done = self.table(DONE[round_]).select(keys.custom_id(F.col("case_number")).alias("custom_id"), F.lit(True).alias("_done")).distinct()
        kind = F.when(F.col("_done"), stream.DONE).otherwise(stream.ASKED)
        self._requests(round_).put(new.join(done, "custom_id", "left").select("custom_id", kind.alias("kind"), "batch"))
        self._add(new.select("round", "batch").distinct(), "announced")

    def _results(self, round_: str, batches: list[str]) -> DataFrame:
        """Results of ended batches together, tagged with their batch."""
        client = self.clients[round_]
        if hasattr(client, "results_of"):
            return self._retried(lambda: client.results_of(batches), f"{round_}-results")
        parts = [self._retried(lambda b=b: client.results(b), f"{round_}-results").withColumn("batch", F.lit(b)) for b in batches]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def collect(self, round_: str) -> dict:
        """What the round's open batches that have ended hold: counts, cost, and the batches still pending.

        Batches are marked as collected last, so a run that breaks goes through them again; the stream knows what it has
        seen. Jobs are as many for one batch as for a thousand, but for the remote calls.
        """
        pending, ended = [], []
        client = self.clients[round_]
        # a batch is a remote call each, so the ids are gone through here; what they hold stays a table
        for batch in [r.batch for r in self.open_batches(round_).select("batch").distinct().orderBy("batch").collect()]:
            at_end = self._retried(lambda b=batch: client.status(b), f"{round_}-status")["ended"]
            (ended if at_end else pending).append(batch)
        requests = self._requests(round_)
        self._announce(round_)
        if ended:
            requests.put(self._results(round_, ended).withColumn("kind", F.lit(stream.RESULT)))
        requests.advance()
        until = self.table("epochs").where(F.col("round") == round_).agg(F.coalesce(F.max("epoch"), F.lit(-1))).first()[0]
        own = self.targets().select(F.col("custom_id").alias("_id"), "case_number")
        good, paid = F.col("outcome").isin(stream.NEW, stream.LATE), F.coalesce("ok", F.lit(False)) & (F.col("outcome") != stream.REPEAT)
        figures = {
            "epoch": F.max("epoch"), "skipped": F.count_if(F.col("outcome") == stream.REPEAT), "expired": F.count_if(F.col("outcome") == stream.EXPIRED), "paid": F.count_if(paid),
            "failed": F.count_if(~F.col("ok") & ~F.col("outcome").isin(stream.REPEAT, stream.EXPIRED)), "invalid": F.count_if(paid & (~good | F.col("case_number").isNull())),
        }
        fresh, n = counted(requests.outcomes(until).join(own, F.col("custom_id") == F.col("_id"), "left").drop("_id"), "outcomes", **figures)
        out = {"collected": 0, "skipped": n["skipped"], "failed": n["failed"], "invalid": n["invalid"], "expired": n["expired"], "writeable": 0, "needs_review": 0, "pending": pending, "cost": 0.0}
        if n["paid"]:
            out["cost"] = self._bill(fresh.where(paid), round_, self.policy.batch_discount)
            for k, v in self._store(round_, fresh.where(paid & good & F.col("case_number").isNotNull()).select("case_number", "answer", "batch", "custom_id")).items():
                out[k] += v
        if n["failed"] + n["expired"] + n["invalid"]:
            bad = ~F.coalesce("ok", F.lit(False)) & (F.col("outcome") != stream.REPEAT) | paid & (~good | F.col("case_number").isNull())
            self._fail(round_, fresh.where(bad).select("batch", "case_number", "custom_id", "outcome", F.coalesce("reason", F.lit("not asked for")).alias("reason")))
        if n["epoch"] is not None:
            self._add(self.spark.createDataFrame([(round_, n["epoch"])], TABLES["epochs"]), "epochs")
        if ended:
            self._add(self.spark.createDataFrame([(round_, b) for b in ended], TABLES["collected"]), "collected")
        return out

    def _fail(self, round_: str, rows: DataFrame) -> None:
        """Store failures(batch, case_number, custom_id, outcome, reason), each once."""
        known = self.table("failures").where(F.col("round") == round_).select(*[F.col(c).alias(f"_{c}") for c in ("batch", "custom_id", "outcome")]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("batch", "custom_id", "outcome")]
        self._append(rows.withColumn("round", F.lit(round_)).join(known, same[0] & same[1] & same[2], "left_anti"), "failures")

    def wait_and_collect(self, round_: str) -> dict:
        """Collect on every poll until no batch is pending; the counts of all polls together."""
        total = self.collect(round_)
        while total["pending"]:
            self.log(f"  {round_}: {len(total['pending'])} batches still processing")
            self.sleep(self.poll_seconds)
            more = self.collect(round_)
            both = None if total["cost"] is None or more["cost"] is None else total["cost"] + more["cost"]
            total = {k: v + more[k] if k not in ("pending", "cost") else more[k] for k, v in total.items()} | {"cost": both}
        return total

    def ask_now(self, round_: str) -> dict[str, int]:
        """A round without batches, at full price."""
        asked = written(self._wanted(round_), "asked")
        answers = written(getattr(self.provider, round_)(asked).where("answer is not null"), "answers")
        self._bill(answers.withColumn("batch", F.lit("now")), round_, 1.0)
        return self._store(round_, answers.select("case_number", "answer"))

    # --- audit, delivery ----------------------------------------------------------------------------------------------
    def sources(self, cases: DataFrame) -> DataFrame:
        """case_number, source of the cases asked for: the evidence a summary was made from, as the map round saw it,
        clipped for the auditor. Only their texts are segmented."""
        texts = self.table("texts").join(cases.select("case_number").distinct(), "case_number", "left_semi")
        cut = segmentation.segment(texts, policy=self.policy.segmentation)
        return cut.select("case_number", F.left("segmented", F.lit(self.policy.audit_clip)).alias("source"))

    def audit(self) -> dict:
        """Rows the gate lets through, unless they have a verdict; a failed call leaves none and is tried again. Rows
        without a source are counted and stay as they are."""
        ready = self.cases().where((F.col("status") == "writeable") & (F.col("summary") != "")).select("case_number", "version", "summary")
        todo = ready.join(self.table("audits").select("case_number", "version"), ["case_number", "version"], "left_anti")
        todo = written(todo, "unaudited")
        has_source = F.coalesce("source", F.lit("")) != ""
        todo, n = counted(todo.join(self.sources(todo), "case_number", "left"), "audited", all=F.count("*"), asked=F.count_if(has_source), version=F.max("version"))
        asked = todo.where(has_source)
        severe = F.col("answer.severity") == "severe"
        got, told = counted(self.provider.audit(asked.select("case_number", "source", "summary")), "verdicts", severe=F.count_if(severe))
        answered = got.where("answer is not null")
        version = n["version"] or 0
        spent = self._bill(answered.withColumn("batch", F.lit(f"version-{version}")), AUDIT, 1.0)
        verdicts = answered.join(todo.select("case_number", "version"), "case_number").select("case_number", "version", F.col("answer.severity").alias("severity"), F.col("answer.unsupported").alias("unsupported"))
        stored, demoted = self._append(verdicts, "audits"), told["severe"]
        return {"kept": n["asked"] - demoted, "demoted": demoted, "failed": n["asked"] - stored, "no_source": n["all"] - n["asked"], "cost": spent if stored else 0.0}

    def records(self) -> DataFrame:
        """Cases as they stand: row, strategy, documents, summary, status and reasons."""
        latest = self.cases()
        now = latest.select("case_number", "version").join(self.table("audits"), ["case_number", "version"])
        audited = gate.audited(latest, now.select("case_number", "severity", "unsupported"))
        placed = audited.join(self.targets().select("case_number", "row", "previous_text"), "case_number", "left")
        return placed.join(self.plans(), "case_number", "left")

    def deliver(self, workbook: str, output: str, header: str, column: int | None = None) -> dict:
        """Write a copy of the workbook and prove it safe: counts of actions, and the verification of every cell."""
        before = xlsx.cells(self.spark, workbook)
        column = xlsx.column_of(before, header, column)
        last_row = before.agg(F.coalesce(F.max("r"), F.lit(0))).first()[0]
        own = before.where(F.col("c") == column).select(F.col("r").alias("row"), "approved")
        actions = grid.write_actions(self.records().select("row", "status", "summary"), own, last_row)
        seen = Observation()
        kinds = ("written", "flagged", "skippedApproved", "missingRow")
        actions = actions.observe(seen, *[F.count_if(F.col("action") == k).alias(k) for k in kinds])
        xlsx.save_copy(actions.select("row", "action", F.col("summary").alias("text")), workbook, output, column)
        counts = {k: seen.get[k] for k in kinds}
        diff = grid.differences(before, xlsx.cells(self.spark, output))
        verdict = grid.verification(diff, column, last_row).first().asDict()
        return counts | verdict | {"summary_column": column, "samples": [tuple(r) for r in grid.samples(diff, column).collect()]}

    def run(self, targets: DataFrame, docs: DataFrame, texts: DataFrame | Reader, limit: int | None = None) -> dict[str, dict]:
        """All stages but delivery."""
        out = {"extract": self.extract(targets, docs, texts, limit)}
        for round_ in (MAP, STRUCTURE):
            self.submit(round_)
            out[round_] = self.wait_and_collect(round_)
        return out | {"audit": self.audit()}

    # --- measuring --------------------------------------------------------------------------------------------------
    def generate(self, gold: DataFrame, docs: DataFrame, texts: DataFrame | Reader) -> DataFrame:
        """Summaries of approved cases for comparison, in a state folder of their own: case_number, summary, error.

        gold(row, case_number). Nothing here is ever delivered; a case without text or answer keeps a row with an error.
        """
        apart = self._apart()
        apart.extract(gold, docs, texts)
        apart.ask_now(MAP)
        apart.ask_now(STRUCTURE)
        have = gold.select("case_number").distinct().join(apart.table("texts").select("case_number", F.lit(True).alias("_t")), "case_number", "left")
        out = have.join(apart.cases().select("case_number", "summary"), "case_number", "left")
        error = F.when(F.col("_t").isNull(), "no source text").when(F.col("summary").isNull(), "no valid answer")
        return out.select("case_number", F.coalesce("summary", F.lit("")).alias("summary"), error.alias("error"))

    def _apart(self) -> Runner:
        return Runner(self.spark, f"{self.folder}/generated", self.provider, self.policy, self.prices, self.model)

    def fidelity(self, size: int) -> tuple[DataFrame, DataFrame]:
        """(one row of figures, the sampled rows) of delivered summaries audited anew against what they were made from."""
        delivered = written(evaluate.delivered(self.records()).select("case_number", "summary"), "delivered")
        sample = sampling.uniform_stride(delivered.join(self.sources(delivered), "case_number").where("source <> ''"), [F.col("case_number")], size)
        sample = written(sample, "sample")
        got = written(self.provider.audit(sample), "verdicts")
        priced = self._priced(got.where("answer is not null"), 1.0)
        outcome = got.select("case_number", F.col("answer.severity").alias("severity"), F.coalesce("answer.unsupported", F.array().cast("array<string>")).alias("unsupported"), F.col("answer.score").alias("score"))
        outcome = outcome.withColumn("n_unsupported", F.size("unsupported"))
        figures = evaluate.fidelity_report(outcome).withColumn("population", F.lit(delivered.count()))
        return figures.crossJoin(F.broadcast(_spent(priced))), outcome

    def parity(self, gold: DataFrame, docs: DataFrame, texts: DataFrame | Reader, size: int) -> tuple[DataFrame, DataFrame] | None:
        """(one row of figures, the judged rows) of generated against approved summaries; None where none can be judged.

        gold(row, case_number, existing): those with a document are sampled, so that the sample is not short.
        """
        sample = written(sampling.uniform_stride(evaluate.measurable(gold, docs), [F.col("row")], size), "gold")
        made = self.generate(sample, docs, texts)
        pairs = written(evaluate.pairs(sample, made), "pairs")
        if pairs.isEmpty():
            return None
        got = written(self.provider.compare(pairs), "judged")
        a = "answer."
        outcome = got.select("case_number", F.col(a + "verdict").alias("verdict"), F.col(a + "sameOutcome").alias("same_outcome"), F.col(a + "houseStyle").alias("house_style"), F.col(a + "score").alias("score"))
        judging = _spent(self._priced(got.where("answer is not null"), 1.0))
        generating = _spent(self._apart().table("usage")).select(*[F.col(c).alias(f"generation_{c}") for c in (*TOKENS, "cost_usd")])
        figures = evaluate.parity_report(outcome).withColumn("population", F.lit(gold.count()))
        return figures.crossJoin(F.broadcast(judging)).crossJoin(F.broadcast(generating)), outcome

    def spent(self) -> DataFrame:
        """Tokens and cost of every round: those of answers that were no use as well."""
        return self.table("usage").groupBy("round").agg(*_sums())


def _sums() -> list[Column]:
    return [*[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOKENS], cost.total_cost().alias("cost_usd")]


def _spent(usage: DataFrame) -> DataFrame:
    """One row."""
    return usage.agg(*_sums())
