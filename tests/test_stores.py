"""Document stores: listing, contents of what is wanted alone, two stores mixed, pushed filters and columns, and extraction
through them."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adjudica import cli
from adjudica.plans import config
from adjudica.plans.policy import LEGAL
from adjudica.plans.runner import MAP, STRUCTURE, Runner
from adjudica.sources import stores, xlsx

CASES = [f"10000{i:02}-{i:02}.2099.8.26.0100" for i in range(1, 5)]
BODY = "O autor alega atraso na entrega do imóvel e pede a rescisão do contrato com a restituição dos valores. " * 4
FILES = {
    f"{CASES[0]} - sentenca.pdf": BODY, f"{CASES[0]}/peça + 50%#1?.pdf": "BOOM", f"{CASES[1]}/sentença.pdf": BODY + "2", f"{CASES[1]}/nota.txt": "BOOM",
    f"{CASES[2]}/SENTENCA (2).pdf": "BROKEN", "sem caso.pdf": "BOOM",
}


def decoder():
    """A function of its own, which workers do not have to import from here."""

    def decode(content):
        text = content.decode()
        if text in ("BOOM", "BROKEN"):
            raise ValueError(f"cannot read {text}")
        return text, 1

    return decode


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    d = tmp_path_factory.mktemp("stores")
    for path, text in FILES.items():
        (d / "files" / path).parent.mkdir(parents=True, exist_ok=True)
        (d / "files" / path).write_text(text)
    (d / "far").mkdir()
    (d / "far" / "x.bin").write_text(BODY + "far")
    entries = [
        {"name": f"{CASES[3]} acordao.pdf", "path": f"m/{CASES[3]} acordao.pdf", "bytes": 500, "location": str(d / "far" / "x.bin")},
        {"name": f"{CASES[3]} sentenca.pdf", "path": f"m/{CASES[3]} sentenca.pdf", "bytes": 500, "location": "gone/away.bin"},
        {"name": "huge.pdf", "path": f"m/{CASES[3]}/huge.pdf", "bytes": 10**12, "location": str(d / "far" / "x.bin")},
    ]
    (d / "m.json").write_text(json.dumps(entries))
    return d


@pytest.fixture(scope="module")
def both(spark, place):
    return stores.Composite({"folder": stores.Folder(spark, str(place / "files")), "manifest": stores.Manifest(spark, str(place / "m.json"), str(place / "files"))})


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_reads_what_is_wanted_from_its_owner(spark, place, both):
    listed = {r.id: (r.bytes, r.case_number) for r in both.list().collect()}
    assert len(listed) == len(FILES) + 3 and listed[f"folder:{CASES[1]}/sentença.pdf"] == (len((BODY + "2").encode()), CASES[1])
    far, odd = f"manifest:m/{CASES[3]} acordao.pdf", f"folder:{CASES[0]}/peça + 50%#1?.pdf"
    got = {r.id: (r.content and bytes(r.content).decode(), r.error) for r in both.read(ids(spark, far, odd, odd, "folder:none.pdf", "other:x", f"manifest:m/{CASES[3]} sentenca.pdf")).collect()}
    assert got.pop(f"manifest:m/{CASES[3]} sentenca.pdf")[1].startswith("FileNotFoundError")
    assert got == {far: (BODY + "far", None), odd: ("BOOM", None)}
    assert both.read(ids(spark).limit(0)).count() == 0
    texts = {r.id: (r.text, r.pages, r.error) for r in both.texts(ids(spark, far, odd), decoder()).collect()}
    assert texts == {far: (BODY + "far", 1, None), odd: (None, None, "ValueError: cannot read BOOM")}


def test_source_opens_what_passes_the_filters(spark, place):
    root = str(place / "files")
    names = stores.scan(spark, root, ("id", "bytes"))
    assert {r.id: r.bytes for r in names.collect()} == {k: len(v.encode()) for k, v in FILES.items()}
    one = stores.scan(spark, root, ("id", "content")).where(F.col("id").isin(f"{CASES[1]}/sentença.pdf", "none.pdf", "../m.json"))
    assert [(r.id, bytes(r.content).decode()) for r in one.collect()] == [(f"{CASES[1]}/sentença.pdf", BODY + "2")]
    under = stores.scan(spark, root, ("path", "name")).where(F.col("path").startswith(f"{CASES[1]}/") & (F.col("name") != "nota.txt"))
    assert [r.name for r in under.collect()] == ["sentença.pdf"]
    # the reader itself: named files are looked up, the others not even listed
    reader = stores._FilesReader(root, ["id", "content"])
    left = list(reader.pushFilters([stores.EqualTo(("id",), "sem caso.pdf"), stores.EqualTo(("bytes",), 4)]))
    assert [f.attribute for f in left] == [("bytes",)]
    assert [f[0] for p in reader.partitions() for f in p.files] == ["sem caso.pdf"]


def test_many_files_are_several_tasks(place, monkeypatch):
    monkeypatch.setattr(stores, "TASK_BYTES", 5000)
    parts = stores._FilesReader(str(place / "files"), ["id"]).partitions()
    assert len(parts) > 2 and sorted(f[0] for p in parts for f in p.files) == sorted(FILES)


def test_extract_reads_planned_documents_alone(spark, place, both, tmp_path):
    """Of two stores; one that cannot be read is told with its error, and what no plan names is not opened."""
    r = Runner(spark, str(tmp_path), None, LEGAL, clients={MAP: None, STRUCTURE: None})
    targets = spark.createDataFrame([(i, k) for i, k in enumerate(CASES, 2)], "row int, case_number string")
    asked = []

    def texts(wanted):
        asked.extend(x.id for x in wanted.collect())
        return both.texts(wanted, decoder())

    got = r.extract(targets, both.list(), texts)
    assert {k: got[k] for k in ("extracted", "no_source", "failed")} == {"extracted": 3, "no_source": 0, "failed": 1}
    assert sorted(asked) == sorted([f"folder:{CASES[0]} - sentenca.pdf", f"folder:{CASES[1]}/sentença.pdf", f"folder:{CASES[2]}/SENTENCA (2).pdf", f"manifest:m/{CASES[3]} acordao.pdf", f"manifest:m/{CASES[3]} sentenca.pdf"])
    told = {x.case_number: (x.documents, [(s.name, s.why) for s in x.skipped]) for x in r.plans().collect()}
    assert told[CASES[2]] == ([], [("SENTENCA (2).pdf", "unread: ValueError: cannot read BROKEN")])
    assert told[CASES[3]][0] == [f"{CASES[3]} acordao.pdf"] and told[CASES[3]][1][0][1].startswith("unread: FileNotFoundError")


def test_commands_read_stores_with_a_decoder(spark, place, tmp_path, monkeypatch, capsys):
    xlsx.write_workbook(str(tmp_path / "in.xlsx"), [["Processo", "Cliente", "Resumo Decisão"], *[[k, "c", None] for k in CASES]])
    (tmp_path / "r.json").write_text(json.dumps({"model": "m", "recordings": []}))
    (tmp_path / "c.json").write_text(json.dumps({"claims": ["Danos morais", "Usucapião"]}))
    monkeypatch.setattr(cli, "named", lambda path: {"a:decode": decoder()}[path])
    args = ["--workbook", str(tmp_path / "in.xlsx"), "--sources", str(place / "files"), "--manifest", str(place / "m.json"), "--decoder", "a:decode", "--recordings", str(tmp_path / "r.json"), "--state", str(tmp_path / "state"), "--catalogue", str(tmp_path / "c.json")]
    assert cli.main([*args, "stage", "extract"], env={}) == 0
    assert "'extracted': 3" in capsys.readouterr().out
    assert cli.main([*args, "coverage"], env={}) == 0 and "digits: 4 of 4" in capsys.readouterr().out
    app = cli.App(spark, config.load({"ADJUDICA_WORKBOOK": str(tmp_path / "in.xlsx"), "ADJUDICA_CATALOGUE": str(tmp_path / "c.json"), "ADJUDICA_CONCURRENCY": "3"}), None)
    assert app.policy.claims == ("Danos morais", "Usucapião") and app.store.at_once == 3
    with pytest.raises(SystemExit, match="no decoder"):
        app.texts()
    assert Path(tmp_path, "state", "texts").exists()
