"""Reports in Markdown: small aggregates on the driver, lists under stated caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.operators import cost, gate, planning, rows, survey
from adjudica.plans.runner import Runner

#: a coverage report names so many cases without documents, and documents without a case
MOST_UNCOVERED, MOST_UNATTRIBUTABLE = 40, 20
KEY_TITLES = {"filename": "file name", "path": "whole path", "digits": "digits alone"}
REASON_TITLES = {
    "audit": "taken back by the audit", "no_final_decision": "no final decision in the documents", "off_house_style": "not in house style",
    "settlement_without_terms": "settlement without its terms", "self_declared_insufficiency": "says itself that the documents do not suffice", "unknown": "reason not recorded",
}


def save(spark: SparkSession, folder: str, name: str, content: str) -> str:
    """Write a report below the state folder, wherever that is; its path."""
    path = f"{folder}/reports/{name}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content.encode()))
    out.close()
    return path


def _table(head: list[str], lines: list[list]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "-|" * len(head), *["| " + " | ".join(map(str, line)) + " |" for line in lines], ""]


def _usage(df: DataFrame, prefix: str = "") -> str:
    c = lambda name: F.col(prefix + name)
    return df.select(cost.format_usage(c("cost_usd"), c("input_tokens"), c("output_tokens"), c("cache_read_tokens")).alias("u")).first()["u"]


def _rate(df: DataFrame, name: str) -> str:
    return df.select(cost.format_rate(F.col(name)).alias("r")).first()["r"]


def _capped(df: DataFrame, column: str, n: int, most: int, order: list[Column]) -> list[str]:
    named = [f"- {r[column]}" for r in df.orderBy(*order).limit(most).collect()]
    return named + ([f"- and {n - most} more"] if n > most else []) + [""]


def inspect(table: DataFrame) -> str:
    r = rows.histogram(rows.with_state(table)).first().asDict()
    return "\n".join(f"- {k[2:].replace('_', ' ')}: {v}" for k, v in r.items())


def coverage(progression: DataFrame, covered: DataFrame, unattributable: DataFrame, plan: DataFrame) -> str:
    """progression, covered and unattributable as in operators.attribution; plan as in operators.planning."""
    steps = progression.orderBy("step").collect()
    lines = ["# Which cases have a document", "", *_table(["Key", "Covered", "Share"], [[KEY_TITLES[r.key], f"{r.covered} of {r.targets}", f"{r.coverage_pct}%"] for r in steps])]
    if len(steps) > 1:
        lines += [f"Looser keys found {steps[-1].covered - steps[0].covered} more.", ""]
    lines += ["## How they will be read", "", *_table(["Strategy", "Cases"], [[r.strategy, r.cases] for r in planning.strategies(plan).orderBy(F.col("cases").desc(), "strategy").collect()])]
    missing = covered.where("not by_digits")
    if n := missing.count():
        lines += [f"## {n} cases without any document", "", *_capped(missing, "case_number", n, MOST_UNCOVERED, [F.col("case_number")])]
    loose = unattributable.where("no_digits")
    if n := loose.count():
        lines += [f"## {n} documents of no case", "", *_capped(loose, "id", n, MOST_UNATTRIBUTABLE, [F.col("id")])]
    return "\n".join(lines)


def style(approved: DataFrame) -> str:
    """approved as in operators.survey."""
    d = survey.dominance(approved).first()
    forms = survey.ranked_forms(survey.forms(approved)).orderBy("place").collect()
    lines = ["# House style of the approved rows", "", f"{d.approved_rows} approved rows, {d.settlement_rows} of them about a settlement.", ""]
    if d.dominant_form:
        lines += [f"Most settlements open with {d.dominant_form!r}: {d.dominance_pct}%.", ""]
    lines += _table(["Form", "Rows"], [[f.form, f.n] for f in forms])
    for f in forms:
        lines += [f"## {f.form}", "", *[f"> {e}" for e in f.examples], ""]
    return "\n".join([*lines, f"{d.unrecognised} rows have no accepted opening."])


def approval(runner: Runner, delivery: dict, approved_rows: int) -> str:
    """What was written, what was refused and why, and what all rounds cost. Lists are as long as the workbook."""
    records = runner.records()
    refused = gate.refused(records).orderBy("reason", "row").collect()
    letter = runner.spark.range(1).select(_letter(delivery["summary_column"])).first()[0]
    lines = ["# Approval pack", "", *_table(["", "Rows"], [["written", delivery["written"]], ["flagged for review", delivery["flagged"]], ["approved before, refused at the cell", delivery["skippedApproved"]], ["approved before", approved_rows], ["not in the sheet", delivery["missingRow"]]])]
    lines += ["## Cost", "", *[f"- {r.round}: {_usage(runner.spent().where(F.col('round') == r.round))}" for r in runner.spent().orderBy("round").collect()], ""]
    lines += ["## Verification", "", f"Clean: {delivery['rows_compared']} rows compared, only column {letter} differs." if delivery["ok"] else f"FAILED: {delivery['unexpected_columns']} other columns differ, {delivery['approved_cells_touched']} approved cells changed. Do not deliver.", ""]
    lines += [f"## Refused: {len(refused)}", ""]
    last = None
    for r in refused:
        if r.reason != last:
            last = r.reason
            lines += [f"### {REASON_TITLES.get(last, last)}: {sum(x.reason == last for x in refused)}", ""]
        lines += [f"- {r.case_number}, row {r.row}: {r.why}; read {', '.join(r.documents or []) or 'nothing'} ({r.strategy})", "", *[f"      {line}" for line in (r.summary or "(empty)").split("\n")], ""]
    done = records.where("status = 'writeable'").select("case_number", "row", "outcome", F.size("claims").alias("n")).orderBy("row").collect()
    return "\n".join([*lines, f"## Written: {len(done)}", "", *_table(["Case", "Row", "Outcome", "Claims"], [list(r) for r in done])])


def _letter(column: int) -> Column:
    from adjudica.functions.text import column_letter

    return column_letter(F.lit(column))


def fidelity(figures: DataFrame, outcomes: DataFrame) -> str:
    r = figures.first()
    lines = ["# Fidelity of what was delivered", "", *_table(["Measure", "Value"], [["delivered", r.population], ["sampled", r.sampled], ["no unsupported assertion", _rate(figures, "clean_pct")], ["severe", _rate(figures, "severe_pct")], ["mean score", r.mean_score if r.mean_score is not None else "n/a"], ["failed calls, counted as severe", r.n_failed], ["cost", _usage(figures)]])]
    bad = outcomes.where("coalesce(severity, 'severe') <> 'ok'").orderBy("case_number").collect()
    for o in bad:
        lines += [f"- {o.case_number}: {o.severity or 'call failed'}{''.join(f'; {u}' for u in o.unsupported)}"]
    return "\n".join(lines)


def parity(figures: DataFrame, outcomes: DataFrame) -> str:
    r = figures.first()
    total = figures.select(*[(F.col(c) + F.col(f"generation_{c}")).alias(c) for c in ("input_tokens", "output_tokens", "cache_write_tokens", "cache_read_tokens", "cost_usd")])
    lines = ["# Generated against approved summaries", "", *_table(["Measure", "Value"], [["approved", r.population], ["sampled", r.sampled], ["same outcome", _rate(figures, "same_outcome_pct")], ["at least as good", _rate(figures, "at_least_as_good_pct")], ["in house style", _rate(figures, "house_style_pct")], ["mean score", r.mean_score if r.mean_score is not None else "n/a"], ["cost of judging", _usage(figures)], ["cost of generating", _usage(figures, "generation_")], ["cost in all", _usage(total)]])]
    lines += _table(["Verdict", "Rows"], [[v, r[f"n_{v}"]] for v in ("equivalent", "ours_more_complete", "ours_worse", "conflict", "error")])
    bad = outcomes.where("coalesce(verdict, 'error') in ('ours_worse', 'conflict', 'error')").orderBy("case_number").collect()
    return "\n".join([*lines, *[f"- {o.case_number}: {o.verdict or 'call failed'}" for o in bad]])
