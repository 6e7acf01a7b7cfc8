"""A small caseload end to end: a workbook of 27 rows, case files in three spellings of their keys, recorded answers."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adjudica import cli
from adjudica.operators import grid
from adjudica.plans import config
from adjudica.plans.runner import MAP, STRUCTURE, Runner
from adjudica.sources import xlsx
from adjudica.sources.providers import Recorded

HEAD = ["Processo", "Comarca", "Cliente", "Resumo Decisão", "Responsável"]
CASES = [f"10000{i:02}-{i:02}.2099.8.26.0100" for i in range(1, 12)]
GOLD = [f"200000{i}-1{i}.2099.8.26.0200" for i in range(1, 5)]
G = grid.APPROVED
STYLE = "JULGADO PROCEDENTE o pedido, com a restituição dos valores pagos."
NO_TERMS = "Acordo homologado. Os termos não constam das peças."
NO_DECISION = "Não foi possível determinar o resultado final do processo a partir das peças disponíveis"
BODY = "O autor alega atraso na entrega do imóvel e pede a rescisão do contrato com a restituição dos valores pagos. " * 4
CLAIM = {"rawClaim": "rescisão do contrato", "canonicalClaim": "Rescisao contratual", "outcome": "upheld"}


def digits(k):
    return "".join(c for c in k if c.isdigit())


FILES = {
    f"{CASES[0]} - sentenca.pdf": BODY, f"{CASES[1]}/SENTENCA (2).pdf": BODY, f"{CASES[1]}/ACORDAO.pdf": BODY,
    f"recebidos/{digits(CASES[2])}_peticao de acordo.pdf": BODY, f"recebidos/{digits(CASES[2])}_sentenca homologatoria.pdf": BODY, f"recebidos/{CASES[3]} homologacao.pdf": BODY,
    f"{CASES[4]}/peticao inicial.pdf": BODY, f"{CASES[4]}/despacho.pdf": BODY + "x", f"{CASES[5]} - volume unico.pdf": "Vistos. " + BODY * 150 + "\nAnte o exposto, julgo procedente. " + BODY,
    f"{CASES[6]} - sentenca.pdf": BODY, f"{CASES[7]} - sentenca.pdf": BODY, f"{CASES[8]}/imagens do fax.pdf": "1 2 3 4",
    **{f"revisados/{k} - sentenca.pdf": BODY for k in GOLD}, f"revisados/{GOLD[3]} - acordao.pdf": BODY, "horas de trabalho.pdf": BODY, "recebidos/agenda do mes.xlsx": "decoy",
}


def rows():
    def line(key, cell):
        return [key, "Foro", "Cliente", cell, "MD"]

    own = [line(k, None if i < 5 else "nota antiga") for i, k in enumerate(CASES[:8])]
    own += [line(CASES[8], "em andamento"), line(CASES[9], None), line(CASES[10], None)]
    own += [line(k, (STYLE, G) if i % 2 else [(STYLE[:9], G), (STYLE[9:], G)]) for i, k in enumerate(GOLD)]
    own += [line(f"300000{i}-10.2099.8.26.0300", "JULGADO EXTINTO") for i in range(3)]
    own += [line(f"310000{i}-10.2099.8.26.0300", ("ver pasta", G)) for i in range(2)]
    own += [line(f"320000{i}-10.2099.8.26.0300", ("Acordo homologado" if i < 5 else "JULGADO EXTINTO por acordo", G)) for i in range(7)]
    return [HEAD, *own]


def recording(key, summary, severity="ok", score=10.0, unsupported=(), parity=None):
    usage = {"input_tokens": 1000, "output_tokens": 100, "cache_creation_input_tokens": 0, "cache_read_input_tokens": 10}
    result = json.dumps({"caseNumber": key, "outcome": "upheld", "summary": summary, "claims": [CLAIM]})
    audit = {"severity": severity, "unsupported": list(unsupported), "score": score}
    return {"caseNumber": key, "map": f"map of {key}", "result": result, "audit": audit, "parity": parity, "usage": dict.fromkeys(("map", "structure", "audit", "parity"), usage)}


def verdict(v, same, score):
    return {"verdict": v, "sameOutcome": same, "houseStyle": True, "score": score}


RECORDINGS = [
    recording(CASES[0], STYLE), recording(CASES[1], STYLE, "minor", 8.0), recording(CASES[2], "Acordo homologado, R$ 10.000,00 em duas parcelas."), recording(CASES[3], NO_TERMS), recording(CASES[4], NO_DECISION),
    recording(CASES[5], STYLE), recording(CASES[6], STYLE, "severe", 2.0, ["20% em vez de 10%"]), recording(CASES[7], STYLE),
    recording(GOLD[0], STYLE, parity=verdict("equivalent", True, 9.0)), recording(GOLD[1], STYLE, parity=verdict("ours_more_complete", True, 9.0)), recording(GOLD[2], STYLE, parity=verdict("ours_worse", True, 5.0)), recording(GOLD[3], STYLE, parity=verdict("conflict", False, 3.0)),
]
PRICES = {"default": "m", "models": {"m": {"inputPerMTok": 3, "outputPerMTok": 13, "source": "a made-up list"}}}
#: 1000 in, 100 out, 10 from the cache at a tenth of the price of input
ONE = (1000 * 3 + 100 * 13 + 10 * 0.3) / 1e6


@pytest.fixture(scope="module")
def env(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("demo")
    xlsx.write_workbook(str(d / "in.xlsx"), rows())
    for path, text in FILES.items():
        (d / "files" / path).parent.mkdir(parents=True, exist_ok=True)
        (d / "files" / path).write_text(text)
    texts = [(p, t, 4 if "imagens do fax" in p else 1) for p, t in FILES.items() if p.endswith(".pdf")]
    spark.createDataFrame(texts, "id string, text string, pages int").write.parquet(str(d / "texts"))
    (d / "r.json").write_text(json.dumps({"model": "m", "recordings": RECORDINGS}))
    (d / "p.json").write_text(json.dumps(PRICES))
    names = {"WORKBOOK": "in.xlsx", "SOURCES": "files", "TEXTS": "texts", "RECORDINGS": "r.json", "PRICES": "p.json", "STATE": "state"}
    return {"ADJUDICA_CHUNK": "3"} | {f"ADJUDICA_{k}": str(d / v) for k, v in names.items()}


def test_caseload(spark, env, capsys):
    assert cli.main(["inspect"], env=env) == 0
    out = capsys.readouterr().out
    assert all(x in out for x in ("rows: 27", "approved: 13", "house style: 14", "off style: 6", "blank: 7", "targets: 11", "gold: 11", "drift: 2"))
    assert cli.main(["coverage"], env=env) == 0
    out = capsys.readouterr().out
    assert all(x in out for x in ("filename: 5 of 11, 45.5%", "path: 8 of 11, 72.7%", "digits: 9 of 11, 81.8%"))
    report = Path(env["ADJUDICA_STATE"], "reports", "coverage.md").read_text()
    assert "| named_decisions | 6 |" in report and "| generic | 3 |" in report and "| none | 2 |" in report and "2 cases without any document" in report and "horas de trabalho.pdf" in report
    assert cli.main(["style"], env=env) == 0 and "71.4%" in Path(env["ADJUDICA_STATE"], "reports", "house-style.md").read_text()

    assert cli.main(["run"], env=env) == 0
    out = capsys.readouterr().out
    assert "'targets': 11, 'extracted': 8, 'already_done': 0, 'no_source': 3, 'failed': 0" in out
    assert "'writeable': 6, 'needs_review': 2" in out and "'kept': 5, 'demoted': 1, 'failed': 0" in out
    assert "5 written, 3 flagged, 0 refused at the cell; verification: clean" in out
    runner = Runner(spark, env["ADJUDICA_STATE"], Recorded(spark, env["ADJUDICA_RECORDINGS"]))
    records = {r.case_number: r for r in runner.records().collect()}
    assert records[CASES[1]].documents == ["SENTENCA (2).pdf", "ACORDAO.pdf"] and records[CASES[1]].audit_severity == "minor" and records[CASES[1]].status == "writeable"
    assert records[CASES[3]].gate_reason == "settlement_without_terms" and records[CASES[4]].gate_reason == "no_final_decision"
    assert records[CASES[6]].status == "needs_review" and "20%" in records[CASES[6]].audit_reason
    assert records[CASES[0]].claims[0].canonical_claim == "Rescisão contratual" and records[CASES[5]].row == 7
    skipped = {r.case_number: r.skipped for r in runner.plans().collect()}
    assert [tuple(x) for x in skipped[CASES[8]]] == [("imagens do fax.pdf", "scanned")]
    spent = {r.round: r.cost_usd for r in runner.spent().collect()}
    assert spent == {"map": pytest.approx(8 * ONE / 2), "structure": pytest.approx(8 * ONE / 2), "audit": pytest.approx(6 * ONE)}
    pack = Path(env["ADJUDICA_STATE"], "reports", "approval-pack.md").read_text()
    assert "Refused: 3" in pack and NO_TERMS in pack and "Written: 5" in pack and "only column D differs" in pack and "in 8000 / out 800 (cache hit 80)" in pack
    after = {(r.r, r.c): r.text for r in xlsx.cells(spark, f"{env['ADJUDICA_STATE']}/delivered.xlsx").collect()}
    assert after[2, 4] == STYLE and (5, 4) not in after or after[5, 4] == ""
    assert after[13, 4] == STYLE

    assert cli.main(["run"], env=env) == 0
    out = capsys.readouterr().out
    assert "'extracted': 0, 'already_done': 8" in out and out.count("'collected': 0") == 2 and "5 written, 3 flagged" in out
    assert {r.round: r.cost_usd for r in runner.spent().collect()} == spent, "a second run pays nothing"

    assert cli.main(["eval", "--size", "25"], env=env) == 0
    fidelity = Path(env["ADJUDICA_STATE"], "reports", "fidelity.md").read_text()
    assert all(x in fidelity for x in ("| delivered | 5 |", "| no unsupported assertion | 100.0% |", "| severe | 0.0% |", "| mean score | 9.6 |"))
    parity = Path(env["ADJUDICA_STATE"], "reports", "parity.md").read_text()
    assert all(x in parity for x in ("| approved | 11 |", "| sampled | 4 |", "| same outcome | 75.0% |", "| at least as good | 50.0% |", "| in house style | 100.0% |", "| mean score | 6.5 |", "| conflict | 1 |"))
    assert f"US$ {8 * ONE:.4f}" in parity and f"US$ {12 * ONE:.4f}" in parity


class Slow:
    """A batch client that needs two polls, over another."""

    def __init__(self, client):
        self.client, self.polls, self.made = client, {}, []

    def create(self, requests):
        if len(self.made) == 1 and not self.polls:
            self.polls["broken"] = 1
            raise OSError("down")
        self.made.append(self.client.create(requests))
        return self.made[-1]

    def status(self, batch):
        self.polls[batch] = self.polls.get(batch, 0) + 1
        return self.client.status(batch) | {"ended": self.polls[batch] > 2}

    def results(self, batch):
        return self.client.results(batch)


def test_batch_rounds_by_stages(spark, env, tmp_path):
    env = env | {"ADJUDICA_STATE": str(tmp_path / "state")}
    for stage in ("extract", "map-submit", "map-collect", "structure-submit", "structure-collect", "audit", "write"):
        assert cli.main(["stage", stage, *(["--limit", "2"] if stage == "extract" else [])], env=env) == 0
    runner = Runner(spark, env["ADJUDICA_STATE"], Recorded(spark, env["ADJUDICA_RECORDINGS"]))
    assert {r.case_number for r in runner.records().collect()} == set(CASES[:2])
    assert cli.main(["stage", "extract"], env=env) == 0

    waits = []
    slow = Slow(runner.clients[MAP])
    runner = Runner(spark, runner.folder, runner.provider, cli.LEGAL.__class__(chunk=4), clients={MAP: slow}, sleep=waits.append, poll_seconds=7)
    assert len(runner.submit(MAP)) == 2 and waits == [15], "a failed call is tried again"
    assert runner.submit(MAP) == [], "what is in an open batch is not submitted again"
    first = runner.collect(MAP)
    assert first["collected"] == 0 and sorted(first["pending"]) == sorted(slow.made)
    done = runner.wait_and_collect(MAP)
    assert done["collected"] == 6 and done["pending"] == [] and waits[1:] == [7] and done["cost"] is None, "a model without a price is unpriced, not free"
    # a batch that is gone through again, as after a loss between storing and marking, neither adds nor bills
    batch = slow.made[0]
    runner._append(spark.createDataFrame([(MAP, "again", k, k) for k in CASES[:1]], "round string, batch string, case_number string, custom_id string"), "batches")
    runner.clients[MAP] = type("Again", (), {"status": lambda s, b: {"ended": True}, "results": lambda s, b: slow.results(batch)})()
    again = runner.collect(MAP)
    assert (again["collected"], again["skipped"]) == (0, 4) and runner.table("usage").where("batch = 'again'").count() == 0


def test_invalid_answers_are_billed(spark, env, tmp_path):
    bad = recording(CASES[0], STYLE)
    bad["result"] = '{"outcome": "won"}'
    (tmp_path / "r.json").write_text(json.dumps({"model": "m", "recordings": [bad]}))
    env = env | {"ADJUDICA_STATE": str(tmp_path / "state"), "ADJUDICA_RECORDINGS": str(tmp_path / "r.json")}
    assert cli.main(["run", "--limit", "2"], env=env) == 0
    runner = Runner(spark, env["ADJUDICA_STATE"], Recorded(spark, env["ADJUDICA_RECORDINGS"]))
    assert runner.records().count() == 0 and {r.round for r in runner.spent().collect()} == {MAP, STRUCTURE}
    assert cli.main(["eval"], env=env) == 1


def test_a_record_is_replaced(spark, env, tmp_path):
    runner = Runner(spark, str(tmp_path), Recorded(spark, env["ADJUDICA_RECORDINGS"]))
    one = spark.createDataFrame([("a", "old", "writeable", None, "upheld", [])], "case_number string, summary string, status string, gate_reason string, outcome string, claims array<struct<raw_claim:string,canonical_claim:string,outcome:string,later_decision:string,notes:string,confidence:string>>")
    runner.save_cases(one)
    runner.save_cases(one.withColumn("summary", F.lit("new")))
    assert [(r.summary, r.version) for r in runner.cases().collect()] == [("new", 2)]


def test_config():
    c = config.load({})
    assert (c.demo, c.chunk, c.concurrency, c.poll_seconds, c.retry_attempts, c.retry_max_s, c.max_document_mb, c.case_column, c.column, c.state) == (True, 100, 2, 120, 20, 60, 120, 1, None, ".demo")
    c = config.load({"ADJUDICA_API_KEY": "k", "ADJUDICA_CHUNK": "-3", "ADJUDICA_POLL_SECONDS": "x", "ADJUDICA_COLUMN": "4", "ADJUDICA_RETRY_MAX_MS": "500"})
    assert (c.demo, c.chunk, c.poll_seconds, c.column, c.retry_max_s, c.state) == (False, 100, 120, 4, 0.5, "state")
    assert config.load({"ADJUDICA_API_KEY": "k", "ADJUDICA_DEMO": "true"}).demo and not config.load({"ADJUDICA_DEMO": "no"}).demo
