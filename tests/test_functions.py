import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adjudica.functions import keys, text
from adjudica.operators import gate, planning, sampling
from adjudica.plans.policy import UNDETERMINED

KEY = "1000001-11.2099.8.26.0100"


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_keys(spark):
    t = f"x {KEY} y 2000001-22.2099.8.26.0200 {KEY}"
    assert column(spark, [t, "none", None], keys.first_key) == [KEY, None, None]
    assert column(spark, [t], keys.all_keys) == [[KEY, "2000001-22.2099.8.26.0200"]]
    assert column(spark, [KEY], keys.digits) == ["10000011120998260100"]
    assert column(spark, [KEY], keys.custom_id) == ["1000001_11_2099_8_26_0100"]
    assert column(spark, [KEY, KEY + "x", ""], keys.check_digits) == ["91", None, None]
    assert column(spark, [KEY, "x"], keys.is_valid) == [False, False]
    assert column(spark, [KEY, "x", "1000001-91.2099.8.26.0100"], keys.is_fictional) == [True, False, False]


@pytest.mark.parametrize(("i", "name"), [(1, "A"), (3, "C"), (26, "Z"), (27, "AA"), (34, "AH"), (52, "AZ"), (53, "BA"), (702, "ZZ"), (703, "AAA")])
def test_column_letters(spark, i, name):
    assert column(spark, [i], text.column_letter, "int") == [name]


def test_document_kinds(spark):
    names = ["a - sentenca.pdf", "SENTENÇA (2).PDF", "acordao.pdf", "Acórdão.pdf", "acordo.pdf", "homologacao.pdf", "despacho.pdf", "certidao.pdf", "mandado.pdf", "voto.pdf", "x_VOTO.pdf", "peticao.pdf", "lista.xlsx"]
    kinds = ["judgment", "judgment", "appellate_ruling", "appellate_ruling", "settlement", "settlement", "order", "certificate", "writ", "opinion", "generic", "generic", "not_pdf"]
    assert column(spark, names, planning.document_kind) == kinds


def test_gate(spark):
    cases = {
        "JULGADO PROCEDENTE o pedido": None,
        "  julgado improcedente": None,
        "Acordo homologado por R$ 10": None,
        "Acordo homologado, valores não informados": "settlement_without_terms",
        "Acordo homologado por R$ 10; não foi possível identificar o prazo": "self_declared_insufficiency",
        "JULGADO EXTINTO; documento ilegível": "self_declared_insufficiency",
        UNDETERMINED + ".": "no_final_decision",
        "O pedido foi JULGADO PROCEDENTE": "off_house_style",
        "": "off_house_style",
        "\n\n": "off_house_style",
        None: "off_house_style",
    }
    assert column(spark, list(cases), gate.refusal) == list(cases.values())


def test_marker_positions(spark):
    assert column(spark, ["ab Ante o exposto xx ante  o exposto", "", None, "ante\x01o"], lambda c: text.marker_positions(c, (r"(?iu)\bante\s+o\s+exposto\b", r"(?iu)exposto")))[0] == [3, 10, 21, 29]


def test_accented_marker_is_found(spark):
    assert column(spark, ["visto. à vista do exposto"], lambda c: text.match_starts(c, r"(?iu)\b(?:à|a)\s+vista\s+do\s+exposto\b")) == [[7]]


def plain_dice(a, b):
    if a == b:
        return 1.0
    if len(a) < 2 or len(b) < 2:
        return 0.0
    x, y = [a[i : i + 2] for i in range(len(a) - 1)], [b[i : i + 2] for i in range(len(b) - 1)]
    return 2 * sum(min(x.count(g), y.count(g)) for g in set(x)) / (len(x) + len(y))


@settings(max_examples=8, deadline=None)
@given(pairs=st.lists(st.tuples(st.text("abc ", max_size=12), st.text("abc ", max_size=12)), min_size=1, max_size=20))
def test_dice_is_symmetric_and_right(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    for a, b, ab, ba in df.select("a", "b", text.dice(F.col("a"), F.col("b")), text.dice(F.col("b"), F.col("a"))).collect():
        assert ab == pytest.approx(plain_dice(a, b)) and ab == ba


def test_dice_golden_and_fold(spark):
    assert column(spark, ["rescisao contratual"], lambda c: text.dice(c, F.lit("resolucao contratual")))[0] == pytest.approx(0.7567567567567568)
    assert column(spark, ["  Rescisão—Contratual! "], text.normalise_key) == ["rescisao contratual"]


@pytest.mark.parametrize(("n", "size"), [(10, 5), (30, 22), (7, 9), (7, 0), (1, 1), (0, 3)])
def test_stride(spark, n, size):
    want = [] if size <= 0 else list(range(n)) if size >= n else sorted({min(n - 1, math.floor(i * (n / size))) for i in range(size)})
    got = sorted(r[0] for r in sampling.uniform_stride(spark.range(n), [F.col("id")], size).collect())
    assert got == want


def test_chunks(spark):
    got = sampling.chunked(spark.range(250), [F.col("id")], 100).groupBy("chunk").count().orderBy("chunk").collect()
    assert [tuple(r) for r in got] == [(0, 100), (1, 100), (2, 50)]


def test_trim_knows_every_white_space(spark):
    assert column(spark, ["\u00a0\ufeff\n a b\u2003\u3000", "\u2028", ""], text.trim_all) == ["a b", "", ""]


def test_running_sums_and_extremes(spark):
    import random

    r = random.Random(1)
    lists = [[r.randint(0, 50) for _ in range(n)] for n in (0, 1, 2, 3, 7, 10, 99, 1000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>").select("i", text.running_sums(F.col("x")).alias("s"), text.running_most(F.col("x")).alias("m"), text.running_least(F.col("x"), 99).alias("l")).collect()
    for row in rows:
        x = lists[row.i]
        assert row.s == [sum(x[:k]) for k in range(len(x))]
        assert row.m == [max([0, *x[:k]]) for k in range(len(x))] and row.l == [min([99, *x[k + 1 :]]) for k in range(len(x))]


def test_positions_of_very_many_matches(spark):
    long = "ab" * 30_000
    at = spark.createDataFrame([(long,), ("",), (None,), ("b",)], "t string").select(text.match_starts(F.col("t"), "ab").alias("at")).collect()
    assert at[0].at == list(range(0, 60_000, 2)) and not at[1].at and not at[2].at and at[3].at == []


def test_folding_by_decomposition(spark):
    names = {"Erdős": "erdos", "rescisa\u0303o": "rescisao", "ação": "acao", "Çà": "ca", "Ångström": "angstrom", "ß-x": "x", "İz": "iz", "čš": "cs", "": ""}
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", text.normalise_key(F.col("n")).alias("k")).collect()
    assert {x.n: x.k for x in got} == names


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from adjudica.functions import scratch

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch.shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))
    shared = SimpleNamespace(get=lambda key, default=None: "hdfs://x/y/")
    assert scratch.shared_dir(SimpleNamespace(conf=shared, sparkContext=SimpleNamespace(master="yarn"))) == "hdfs://x/y"
