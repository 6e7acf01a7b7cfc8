import json

import pytest
from pyspark.sql import functions as F

from adjudica.operators import attribution, catalogue, cost, evaluate, gate, grid, planning, segmentation, state, structured, survey
from adjudica.plans.policy import CLAIMS, LEGAL, Segmentation

A, B, C_, D = (f"100000{i}-11.2099.8.26.0100" for i in range(1, 5))


def digits(k):
    return "".join(x for x in k if x.isdigit())


@pytest.fixture(scope="module")
def tree(spark):
    rows = [(1, f"{A} - sentenca.pdf", f"{A} - sentenca.pdf"), (2, f"{B}/acordao.pdf", "acordao.pdf"), (3, f"in/{digits(C_)}_x.pdf", f"{digits(C_)}_x.pdf"), (4, "in/other.pdf", "other.pdf")]
    return spark.createDataFrame(rows, "id int, path string, name string"), spark.createDataFrame([(k, i) for i, k in enumerate((A, B, C_, D))], "case_number string, ord int")


def test_attribution_and_coverage(tree):
    docs, cases = tree
    assert {r.id: r.case_number for r in attribution.attribute(docs, cases).collect()} == {1: A, 2: B, 3: C_, 4: None}
    assert [(r.key, r.covered, r.coverage_pct) for r in attribution.progression(docs, cases).orderBy("step").collect()] == [("filename", 1, 25.0), ("path", 2, 50.0), ("digits", 3, 75.0)]
    assert {r.id: (r.no_path, r.no_digits) for r in attribution.unattributable(docs, cases).collect()} == {2: (False, False), 3: (True, False), 4: (True, True)}
    assert [r.coverage_pct for r in attribution.progression(docs, cases.limit(0)).collect()] == [0.0] * 3


def test_attribution_has_no_nested_loop(tree):
    plan = attribution.attribute(*tree)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_reading_plan(spark):
    docs = [("a", 1, "judgment", 100), ("a", 2, "judgment", 9000), ("a", 3, "judgment", 4000), ("a", 4, "settlement", 1), ("a", 5, "generic", 99999), ("b", 6, "generic", 5), ("b", 7, "generic", 8), ("b", 8, "writ", 99), ("c", 9, "writ", 2), ("d", 10, "not_pdf", 7)]
    plan = planning.reading_plan(spark.createDataFrame(docs, "case_number string, id int, kind string, bytes long"), spark.createDataFrame([(x,) for x in "abcde"], "case_number string"))
    got = {}
    for r in plan.orderBy("case_number", "pos").collect():
        got.setdefault((r.case_number, r.strategy), []).append(r.id)
    assert got == {("a", "named_decisions"): [2, 3, 4], ("b", "generic"): [7], ("c", "weak"): [9], ("d", "none"): [None], ("e", "none"): [None]}


def plain_windows(positions, n, p):
    out = []
    for x in positions:
        a, b = max(0, x - p.before), min(n, x + p.after)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    while len(out) > 1 and sum(b - a for a, b in out) > p.budget:
        out.pop(0)
    return out


def test_segmentation(spark):
    fill = "palavra " * 1500
    decision = "Vistos.\nTrata-se de ação. " + fill + "\nAnte o exposto, julgo procedente. Juiz de Direito."
    docket = ("x" * 20_000 + " pelo exposto ") * 8
    texts = ["curto", None, "y" * 20_000, decision, docket, "Ante o exposto " + "z" * 5000]
    rows = {r.i: r for r in segmentation.segment(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()}
    assert [rows[i].mode for i in range(6)] == ["none", "none", "none", "decision", "full-docket", "none"]
    assert rows[3].segmented.startswith("[CABEÇALHO]\nVistos.") is True and "[RELATÓRIO / PEDIDOS]\nTrata-se" in rows[3].segmented
    assert rows[3].segmented.endswith("Juiz de Direito.") and rows[3].found_signature and rows[3].found_windows == 1
    assert rows[4].found_windows == len(plain_windows([20_001 + i * 20_014 for i in range(8)], len(docket), LEGAL.segmentation)) and rows[4].segmented_length < len(docket)
    assert rows[5].found_operative and rows[5].found_windows == 1 and rows[5].segmented == texts[5] and rows[5].reduction_pct == 0


def test_budget_drops_the_earliest(spark):
    p = Segmentation(before=10, after=10, budget=40)
    w = spark.range(1).select(segmentation.windows(F.array(*[F.lit(x) for x in (50, 55, 200, 400)]), F.lit(1000), p)).first()[0]
    assert [[r.a, r.b] for r in w] == [[190, 210], [390, 410]] == plain_windows([50, 55, 200, 400], 1000, p)


def test_catalogue(spark):
    names = spark.createDataFrame([(n,) for n in ("Danos morais", "danos  MORAIS", "Rescisao contratual", "Danos moraiss", "nada parecido", "")], "name string")
    entries = spark.createDataFrame(list(enumerate(CLAIMS)), "idx int, canonical string")
    got = {r.name: (r.canonical, r.method) for r in catalogue.match(names, entries).collect()}
    assert got["Danos morais"] == got["danos  MORAIS"] == ("Danos morais", "exact") and got["Rescisao contratual"] == ("Rescisão contratual", "exact")
    assert got["Danos moraiss"] == ("Danos morais", "fuzzy") and got["nada parecido"] == (None, "none") and got[""] == (None, "none")
    claims = spark.createDataFrame([("a", "dano moral", "Danos moraiss"), ("b", "Danos Morais", "Não identificado"), ("c", "zzz", "Não identificado"), ("d", "x", "qqqq")], "id string, raw_claim string, canonical_claim string")
    assert {r.id: r.canonical_claim for r in catalogue.repair(claims, entries).collect()} == {"a": "Danos morais", "b": "Danos morais", "c": "Não identificado", "d": "qqqq"}


def test_cost(spark):
    usage = spark.createDataFrame([(1, "standard", 1_000_000, 100_000, 0, 0), (2, "standard", 0, 0, 1_000_000, 1_000_000), (3, "light", None, None, None, 1_000_000), (4, "other", 5, 5, 0, 0)], "i int, model string, input_tokens long, output_tokens long, cache_write_tokens long, cache_read_tokens long")
    prices = cost.price_rows(spark.createDataFrame([("standard", 3.0, 13.0, None, None), ("light", 0.8, 2.4, None, 0.03)], "model string, input double, output double, cache_write double, cache_read double"))
    assert cost.unpriced_warning("standard", prices) is None and "light, standard" in cost.unpriced_warning("other", prices)
    got = {r.i: r.cost_usd for r in cost.priced(usage, prices).collect()}
    assert got == {1: pytest.approx(4.3), 2: pytest.approx(4.05), 3: pytest.approx(0.03), 4: None}
    assert cost.priced(usage, prices, 0.5).where("i = 1").first().cost_usd == pytest.approx(2.15)
    assert cost.priced(usage, prices).agg(cost.total_cost()).first()[0] is None
    assert cost.priced(usage.limit(0), prices).agg(cost.total_cost()).first()[0] == 0


def test_price_file(spark, tmp_path):
    good = {"inputPerMTok": 0.8, "outputPerMTok": 2.4, "cacheReadPerMTok": 0.03, "source": "a list"}
    (tmp_path / "p.json").write_text(json.dumps({"default": "a", "models": {"a": good}}))
    prices, default = cost.load_prices(spark, str(tmp_path / "p.json"))
    assert default == "a" and tuple(prices.first()) == ("a", 0.8, 2.4, 1.0, 0.03)
    (tmp_path / "q.json").write_text(json.dumps({"default": "a", "models": {"a": good | {"source": ""}}}))
    with pytest.raises(ValueError, match="source: a"):
        cost.load_prices(spark, str(tmp_path / "q.json"))
    assert cost.load_prices(spark, None)[0].count() == 0


def test_catalogue_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"_comment": ["x"], "claims": ["Danos morais", "Usucapião"]}))
    entries = catalogue.load(spark, str(tmp_path / "c.json"))
    assert [tuple(r) for r in entries.orderBy("idx").collect()] == [("Danos morais", 0), ("Usucapião", 1)]
    assert catalogue.match(spark.createDataFrame([("usucapiao",)], "name string"), entries).first().canonical == "Usucapião"


def test_audit_demotes_only(spark):
    records = spark.createDataFrame([("a", "writeable", None), ("b", "writeable", None), ("c", "writeable", None), ("d", "needs_review", "off_house_style")], "case_number string, status string, gate_reason string")
    verdicts = spark.createDataFrame([("a", "minor", []), ("b", "severe", ["20% vs 10%"]), ("d", "ok", [])], "case_number string, severity string, unsupported array<string>")
    out = gate.audited(records, verdicts)
    assert {r.case_number: (r.status, r.audit_reason) for r in out.collect()} == {"a": ("writeable", None), "b": ("needs_review", "audit: 20% vs 10%"), "c": ("writeable", None), "d": ("needs_review", None)}
    assert tuple(gate.audit_report(out.where("gate_reason is null")).first()) == (2, 1, 1)


def test_evaluation(spark):
    f = evaluate.fidelity_report(spark.createDataFrame([("ok", 0, 10.0), ("minor", 0, 8.0), ("severe", 1, 2.0), (None, None, None)], "severity string, n_unsupported int, score double")).first()
    assert (f.n_severe, f.n_failed, f.clean_pct, f.severe_pct, f.mean_score) == (2, 1, 50.0, 50.0, 5.0)
    p = evaluate.parity_report(spark.createDataFrame([("equivalent", True, True, 9.0), ("ours_more_complete", True, True, 9.0), ("ours_worse", True, True, 5.0), ("conflict", False, True, 1.0), (None, None, None, None)], "verdict string, same_outcome boolean, house_style boolean, score double")).first()
    assert (p.at_least_as_good_pct, p.same_outcome_pct, p.n_error) == (40.0, 60.0, 1)
    assert evaluate.fidelity_report(spark.createDataFrame([], "severity string, n_unsupported int, score double")).first().clean_pct is None


def test_survey(spark):
    rows = [(i, True, "Acordo homologado") for i in range(5)] + [(5 + i, True, "JULGADO  EXTINTO por acordo") for i in range(2)] + [(7, True, "JULGADO PROCEDENTE"), (8, True, "nota"), (9, False, "JULGADO EXTINTO acordo"), (10, True, " ")]
    a = survey.approved_rows(spark.createDataFrame(rows, "row int, approved boolean, existing string"))
    d = survey.dominance(a).first()
    assert (d.approved_rows, d.settlement_rows, d.unrecognised, d.dominant_form, d.dominance_pct) == (9, 7, 1, "Acordo homologado", 71.4)
    assert {r.form: (r.n, len(r.examples)) for r in survey.forms(a).collect()}["Acordo homologado"] == (5, 3)


def test_grid(spark):
    before = spark.createDataFrame([(2, 4, "a ", True), (3, 4, "b", False), (3, 1, "k", False)], "r int, c int, text string, approved boolean")
    after = spark.createDataFrame([(2, 4, "x", True), (3, 4, " b", False), (4, 4, "n", False)], "r int, c int, text string, approved boolean")
    diff = grid.differences(before, after)
    v = grid.verification(diff, 4, 4).first()
    assert v.differences_by_column == {4: 2, 1: 1} and (v.unexpected_columns, v.approved_cells_touched, v.ok) == (1, 1, False)
    assert [tuple(r) for r in grid.samples(diff, 4).collect()] == [(2, "a", "x"), (4, "", "n")]
    items = spark.createDataFrame([(2, "writeable", "t"), (3, "needs_review", "t"), (5, "writeable", "t"), (6, "writeable", " \n"), (9999, "writeable", "t")], "row int, status string, summary string")
    got = {r.row: r.action for r in grid.write_actions(items, spark.createDataFrame([(5, True)], "row int, approved boolean"), 7).collect()}
    assert got == {2: "written", 3: "flagged", 5: "skippedApproved", 6: "flagged", 9999: "missingRow"}


def test_state(spark):
    done = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in state.todo(spark.createDataFrame([("a",), ("b",)], "k string"), done, "k").collect()] == ["b"]
    latest = state.latest(spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, n int, v string"), ["k"], ["n"])
    assert {r.k: r.v for r in latest.collect()} == {"a": None, "b": "y"}


def test_structured(spark):
    claim = '{"rawClaim":"r","canonicalClaim":"c","outcome":"moot"}'
    texts = [f'{{"outcome":"upheld","claims":[{claim}],"other":1}}', '{"outcome":"upheld","claims":[]}', f'{{"outcome":"won","claims":[{claim}]}}', f'{{"outcome":"upheld","judge":null,"claims":[{claim}]}}', f'{{"outcome":"upheld","appealOutcome":null,"claims":[{claim}]}}', "no json", None]
    rows = structured.validated(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).orderBy("i").collect()
    assert [r.valid for r in rows] == [True, False, False, False, True, False, False]
    nested = ['"notes":null', '"notes":3', '"confidence":"sure"', '"laterDecision":"x","confidence":"low","more":{}']
    made = [(i, f'{{"outcome":"upheld","claims":[{claim[:-1]},{n}}}]}}') for i, n in enumerate(nested)]
    got = structured.validated(spark.createDataFrame(made, "i int, text string")).orderBy("i").collect()
    assert [r.valid for r in got] == [False, False, False, True] and got[3].result.claims[0].confidence == "low"
    assert rows[0].result.judge == "Não identificado" and rows[0].result.claims[0].confidence == "medium" and rows[1].result is None


def test_reading_plan_limits_groups_before_the_shuffle(spark):
    docs = spark.createDataFrame([("a", 1, "judgment", 5)], "case_number string, id int, kind string, bytes long")
    plan = planning.reading_plan(docs, docs.select("case_number"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
