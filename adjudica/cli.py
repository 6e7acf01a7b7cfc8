"""Commands: inspect, coverage, style, run [--limit N], stage NAME [--limit N], eval [--size N]."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adjudica.functions import scratch
from adjudica.operators import attribution, catalogue, cost, planning, rows, survey
from adjudica.plans import config, reports
from adjudica.plans.policy import LEGAL
from adjudica.plans.runner import MAP, STRUCTURE, Reader, Runner
from adjudica.sources import stores, xlsx
from adjudica.sources.providers import Provider, Recorded

STAGES = ("extract", "map-submit", "map-collect", "structure-submit", "structure-collect", "audit", "write")


def positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise argparse.ArgumentTypeError("a positive number is needed")
    return n


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="adjudica")
    for name, what in (("workbook", "xlsx file, never written to"), ("sources", "folder of case files"), ("texts", "table of (id, text, pages)"), ("manifest", "JSON list of more documents"), ("decoder", "module:function from bytes to (text, pages)"), ("catalogue", "JSON file of the claims' names"), ("provider", "module:function that makes a provider"), ("recordings", "JSON file of recorded answers"), ("prices", "JSON file of model prices"), ("state", "folder of tables, reports and the delivered copy"), ("header", "header of the summary column")):
        p.add_argument(f"--{name}", help=what)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("inspect", "coverage", "style", "run", "stage", "eval"):
        s = sub.add_parser(name)
        if name == "stage":
            s.add_argument("name", choices=STAGES)
        if name in ("run", "stage"):
            s.add_argument("--limit", type=positive)
        if name == "eval":
            s.add_argument("--size", type=positive, default=25)
    return p


def named(path: str) -> Callable:
    """The function of a module:function."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class App:
    """One command over the settings; answers come from a provider of the caller's, else from recordings."""

    def __init__(self, spark: SparkSession, c: config.Config, provider: Provider | None, say: Callable[[str], None] = print) -> None:
        self.spark, self.c, self.say = spark, c, say
        table = xlsx.cells(spark, c.workbook)
        self.column = xlsx.column_of(table, c.header, c.column)
        self.book = rows.with_state(xlsx.workbook_rows(table, self.column, c.case_column))
        self.targets = rows.targets(self.book).select("row", "case_number", "existing")
        self.provider = provider
        claims = {"claims": tuple(r.canonical for r in catalogue.load(spark, c.catalogue).orderBy("idx").collect())} if c.catalogue else {}
        self.policy = LEGAL.__class__(chunk=c.chunk, max_document_mb=c.max_document_mb, **claims)
        folder = stores.Folder(spark, c.sources, self.policy.kinds, c.concurrency)
        self.store = stores.Composite({"folder": folder, "manifest": stores.Manifest(spark, c.manifest, c.sources, self.policy.kinds, c.concurrency)}) if c.manifest else folder

    def runner(self) -> Runner:
        prices, default = cost.load_prices(self.spark, self.c.prices, self.policy)
        model = self.c.model or default
        if warning := cost.unpriced_warning(model, prices):
            self.say(warning)
        if self.provider is None and not self.c.provider and not (self.c.demo and self.c.recordings):
            raise SystemExit("no recordings and no provider: nothing can answer")
        provider = self.provider or (named(self.c.provider)(self.spark, self.c) if self.c.provider else Recorded(self.spark, self.c.recordings))
        return Runner(self.spark, self.c.state, provider, self.policy, prices, model, attempts=self.c.retry_attempts, retry_max_s=self.c.retry_max_s, poll_seconds=self.c.poll_seconds, log=self.say)

    def documents(self, cases: DataFrame) -> DataFrame:
        """The case files, each with the first known case (in the sheet's order) that it belongs to."""
        return attribution.attribute(self.store.list().drop("case_number"), attribution.indexed(cases))

    def texts(self) -> DataFrame | Reader:
        """A table of texts, or the store read by a decoder: only what is planned."""
        if self.c.texts:
            return self.spark.read.parquet(self.c.texts)
        if not self.c.decoder:
            raise SystemExit("no texts and no decoder: documents cannot be read")
        decode = named(self.c.decoder)
        return lambda wanted: self.store.texts(wanted, decode)

    def save(self, name: str, content: str) -> None:
        self.say(f"wrote {reports.save(self.spark, self.c.state, name, content)}")

    def coverage(self) -> None:
        files = self.store.list()
        plan = planning.reading_plan(self.documents(self.targets).where("case_number is not null"), self.targets.select("case_number"))
        steps = attribution.progression(files, self.targets)
        for r in steps.orderBy("step").collect():
            self.say(f"{r.key}: {r.covered} of {r.targets}, {r.coverage_pct}%")
        self.save("coverage.md", reports.coverage(steps, attribution.covered(files, self.targets), attribution.unattributable(files, self.targets), plan))

    def style(self) -> None:
        content = reports.style(survey.approved_rows(self.book))
        self.say(content.split("\n")[2])
        self.save("house-style.md", content)

    def extract(self, runner: Runner, limit: int | None) -> dict:
        return runner.extract(self.targets, self.documents(self.targets), self.texts(), limit)

    def deliver(self, runner: Runner) -> dict:
        os.makedirs(self.c.state, exist_ok=True)
        out = runner.deliver(self.c.workbook, f"{self.c.state}/delivered.xlsx", self.c.header, self.c.column)
        self.say(f"{out['written']} written, {out['flagged']} flagged, {out['skippedApproved']} refused at the cell; verification: {'clean' if out['ok'] else 'FAILED'}")
        return out

    def stage(self, name: str, limit: int | None) -> int:
        runner = self.runner()
        if name == "extract":
            self.say(str(self.extract(runner, limit)))
        elif name == "audit":
            self.say(str(runner.audit()))
        elif name == "write":
            self.deliver(runner)
        else:
            round_, what = name.split("-")
            self.say(str(runner.submit(round_) if what == "submit" else runner.collect(round_)))
        return 0

    def run(self, limit: int | None) -> int:
        runner = self.runner()
        self.say(f"extract: {self.extract(runner, limit)}")
        for round_ in (MAP, STRUCTURE):
            runner.submit(round_)
            self.say(f"{round_}: {runner.wait_and_collect(round_)}")
        self.say(f"audit: {runner.audit()}")
        delivery = self.deliver(runner)
        self.save("approval-pack.md", reports.approval(runner, delivery, self.book.where("approved").count()))
        return 0 if delivery["ok"] else 1

    def eval(self, size: int) -> int:
        runner = self.runner()
        if runner.cases().isEmpty():
            self.say("no case records: run first")
            return 1
        self.save("fidelity.md", reports.fidelity(*runner.fidelity(size)))
        gold = rows.gold(self.book).select("row", "case_number", "existing")
        judged = runner.parity(gold, self.documents(gold), self.texts(), size)
        if judged is None:
            self.say("no approved row has a document and a summary to compare")
        else:
            self.save("parity.md", reports.parity(*judged))
        return 0


def main(argv: list[str], provider: Provider | None = None, env: dict[str, str] | None = None) -> int:
    try:
        a = _parser().parse_args(argv)
    except SystemExit as e:
        return 1 if e.code else 0
    given = {f"{config.PREFIX}{k.upper()}": v for k in ("workbook", "sources", "texts", "manifest", "decoder", "catalogue", "provider", "recordings", "prices", "state", "header") if (v := getattr(a, k))}
    spark = SparkSession.builder.appName("adjudica").getOrCreate()
    try:
        return _done(a, App(spark, config.load((os.environ if env is None else env) | given), provider))
    finally:
        scratch.clear(spark)


def _done(a: argparse.Namespace, app: App) -> int:
    if a.command == "inspect":
        app.say(reports.inspect(app.book))
    elif a.command == "coverage":
        app.coverage()
    elif a.command == "style":
        app.style()
    elif a.command == "stage":
        return app.stage(a.name, a.limit)
    elif a.command == "run":
        return app.run(a.limit)
    else:
        return app.eval(a.size)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
