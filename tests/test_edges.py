import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adjudica.operators import grid, rows
from adjudica.plans.runner import Runner
from adjudica.sources import documents, providers, xlsx
from adjudica.streaming.collector import collect_available

G = grid.APPROVED
KEYS = [f"100000{i}-11.2099.8.26.0100" for i in range(1, 8)]
HEAD = ["Processo", "Cliente", "Resumo Decisão"]


@pytest.fixture
def workbook(tmp_path):
    path = str(tmp_path / "in.xlsx")
    lines = [HEAD, [KEYS[0], "x", None], [KEYS[1], "x", "nota"], [KEYS[2], "x", "JULGADO PROCEDENTE"], [KEYS[3], "x", ("Acordo homologado", G)], [KEYS[4], "x", [("JULGADO ", None), ("EXTINTO", G)]], [KEYS[5], "x", ("nota", G)], ["no key", "x", "y"], [KEYS[6], "x", (" ", G)]]
    xlsx.write_workbook(path, lines)
    return path


def test_xlsx_scan_and_states(spark, workbook):
    table = xlsx.cells(spark, workbook)
    assert xlsx.column_of(table, " resumo DECISÃO ") == 3 and xlsx.column_of(table, "?", 9) == 9
    with pytest.raises(ValueError, match="headed"):
        xlsx.column_of(table, "?")
    book = rows.with_state(xlsx.workbook_rows(table, 3))
    got = {r.row: (r.state, r.approved) for r in book.collect()}
    assert got == {2: ("blank", False), 3: ("off_style", False), 4: ("house_style", False), 5: ("house_style", True), 6: ("house_style", True), 7: ("off_style", True), 9: ("blank", False)}
    assert {r.row for r in rows.targets(book).collect()} == {2, 3, 9}


def test_guarded_copy_and_verification(spark, workbook, tmp_path):
    before = xlsx.cells(spark, workbook)
    items = spark.createDataFrame([(2, "writeable", "JULGADO EXTINTO"), (3, "needs_review", "?"), (5, "writeable", "no"), (9999, "writeable", "no")], "row int, status string, summary string")
    own = before.where("c = 3").select(F.col("r").alias("row"), "approved")
    actions = grid.write_actions(items, own, 9)
    changes = [(r.row, r.action, r.summary.strip()) for r in actions.collect()]
    assert sorted(a for _, a, _ in changes) == ["flagged", "missingRow", "skippedApproved", "written"]
    target = str(tmp_path / "out.xlsx")
    with pytest.raises(ValueError, match="never overwritten"):
        xlsx.write_copy(workbook, workbook, changes, 3)
    xlsx.write_copy(workbook, target, changes, 3)
    after = xlsx.cells(spark, target)
    diff = grid.differences(before, after)
    assert [(r.r, r.c, r.after) for r in diff.collect()] == [(2, 3, "JULGADO EXTINTO")]
    assert grid.verification(diff, 3, 9).first().ok
    assert {r.r: r.cell_argb for r in after.where("c = 3").collect()}[2] == grid.WRITTEN_FONT


def test_scans(spark, tmp_path):
    (tmp_path / "d" / "in").mkdir(parents=True)
    (tmp_path / "d" / f"{KEYS[0]} - sentenca.pdf").write_text("abc")
    (tmp_path / "d" / "in" / "lista + x.xlsx").write_text("a")
    got = {r.path: (r.bytes, r.kind, r.case_number) for r in documents.folder(spark, str(tmp_path / "d")).collect()}
    assert got == {f"{KEYS[0]} - sentenca.pdf": (3, "judgment", KEYS[0]), "in/lista + x.xlsx": (1, "not_pdf", None)}
    (tmp_path / "m.json").write_text(json.dumps([{"name": "a.pdf", "path": "p/a.pdf", "bytes": 1}, {"name": "b.pdf", "path": "p/a.pdf", "bytes": 2}]))
    entries = documents.manifest(spark, str(tmp_path / "m.json"))
    assert [(r.name, r.bytes, r.location) for r in entries.collect()] == [("a.pdf", 1, None)]
    (tmp_path / "n.json").write_text(json.dumps([{"name": "c.pdf", "path": "x", "bytes": 3, "location": f"{KEYS[0]} - sentenca.pdf"}]))
    far = documents.manifest(spark, str(tmp_path / "n.json"))
    got = documents.manifest_contents(spark, far, far, str(tmp_path / "d")).collect()
    assert [(r.id, bytes(r.content)) for r in got] == [("x", b"abc")]
    wanted = spark.createDataFrame([("in/lista + x.xlsx",)], "id string")
    assert [(r.id, bytes(r.content)) for r in documents.folder_contents(spark, str(tmp_path / "d"), wanted).collect()] == [("in/lista + x.xlsx", b"a")]
    read = documents.texts_of(documents.folder_contents(spark, str(tmp_path / "d"), wanted), lambda b: (b.decode() * 2, 1)).collect()
    assert [tuple(r) for r in read] == [("in/lista + x.xlsx", "aa", 1)]
    assert documents.folder_contents(spark, str(tmp_path / "d"), wanted.limit(0)).count() == 0
    assert [r.id for r in documents.composite({"m": entries}).collect()] == ["m:p/a.pdf"]


def test_collector_counts_every_id_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    args = (spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    (source / "a.json").write_text('{"custom_id":"a","ok":true}\n{"custom_id":"b","ok":false}\n{"custom_id":"a","ok":true}\n')
    assert sorted(r.custom_id for r in collect_available(*args).collect()) == ["a", "b"]
    (source / "b.json").write_text('{"custom_id":"b","ok":true}\n{"custom_id":"c","ok":true}\n')
    assert sorted((r.custom_id, r.ok) for r in collect_available(*args).collect()) == [("a", True), ("b", False), ("c", True)]


def test_retry_and_pool():
    waits = []

    def fails():
        raise OSError("down")

    with pytest.raises(RuntimeError, match="call: 6 attempts failed, last: down"):
        providers.with_retry(fails, "call", attempts=6, most_s=40, sleep=waits.append)
    assert waits == [15, 30, 40, 40, 40]
    assert providers.in_order(range(12), lambda x: x * x, 3) == [x * x for x in range(12)]


def test_nothing_imports_the_llm_subpackage():
    root = Path(__file__).parent.parent
    own = [p for p in (root / "adjudica").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in own if "adjudica.llm" in p.read_text()]


def test_the_rest_works_without_the_llm_subpackage(tmp_path):
    root = Path(__file__).parent.parent
    shutil.copytree(root / "adjudica", tmp_path / "adjudica", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1:] == ["True", "False"] and int(out.stdout.split()[0]) > 50


def test_cli(spark, workbook, tmp_path, capsys):
    from adjudica import cli

    assert cli.main(["nonsense"]) == 1 and cli.main(["stage", "nonsense"]) == 1 and cli.main(["run", "--limit", "0"]) == 1
    state = ["--state", str(tmp_path / "state")]
    assert cli.main(["--workbook", workbook, "inspect"]) == 0
    assert "- targets: 3" in capsys.readouterr().out
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / f"{KEYS[0]} - sentenca.pdf").write_text("x")
    assert cli.main(["--workbook", workbook, "--sources", str(tmp_path / "files"), *state, "coverage"]) == 0
    assert "33.3" in capsys.readouterr().out


def test_generated_summaries_stay_apart(spark, tmp_path):
    claim = {"rawClaim": "r", "canonicalClaim": "c", "outcome": "upheld"}
    usage = {"input_tokens": 1, "output_tokens": 0, "cache_creation_input_tokens": 0, "cache_read_input_tokens": 0}
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"model": "standard", "recordings": [{"caseNumber": KEYS[0], "map": "m", "result": json.dumps({"outcome": "upheld", "summary": "JULGADO EXTINTO", "claims": [claim]}), "usage": {"map": usage, "structure": usage}}]}))
    gold = spark.createDataFrame([(2, KEYS[0]), (3, KEYS[1]), (4, KEYS[2])], "row int, case_number string")
    docs = spark.createDataFrame([(k, k, "sentenca.pdf", 10, "judgment", k) for k in KEYS[:2]], "id string, path string, name string, bytes long, kind string, case_number string")
    texts = spark.createDataFrame([(k, "palavra " * 50, 1) for k in KEYS[:2]], "id string, text string, pages int")
    runner = Runner(spark, str(tmp_path / "state"), providers.Recorded(spark, str(path)))
    got = {r.case_number: (r.summary, r.error) for r in runner.generate(gold, docs, texts).collect()}
    assert got == {KEYS[0]: ("JULGADO EXTINTO", None), KEYS[1]: ("", "no valid answer"), KEYS[2]: ("", "no source text")}
    assert runner.records().count() == 0
