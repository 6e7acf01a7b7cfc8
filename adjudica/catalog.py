"""The library's operators as queries over the driver's tables, each with the SQL it is compared with.

The tables hold no case files, so each query states how their columns stand in for one: orders give keys and paths,
documents are files of a case (source) of a kind (lang) and size (n_chars), conversations are summaries, and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import keys
from adjudica.functions import text as T
from adjudica.operators import attribution, catalogue, cost, evaluate, gate, grid, planning, sampling, segmentation, similarity, state, structured, survey
from adjudica.plans.policy import Gate, Kinds, Segmentation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- keys -----------------------------------------------------------------------------------------------------------
def _order_key() -> Column:
    return F.concat(F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lit("-11.2099.8.26.0100"))


KEY_SQL = "lpad(cast(o_orderkey as varchar), 7, '0') || '-11.2099.8.26.0100'"
RE_KEY = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"


@query(f"SELECT o_orderkey, k AS case_number, regexp_replace(k, '[^0-9]', '', 'g') AS digits, regexp_replace(k, '[^a-zA-Z0-9]', '_', 'g') AS custom_id FROM (SELECT o_orderkey, {KEY_SQL} AS k FROM orders)")
def case_key_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _order_key()
    return read(spark, sf_dir, "orders").select("o_orderkey", k.alias("case_number"), keys.digits(k).alias("digits"), keys.custom_id(k).alias("custom_id"))


@query(
    "SELECT o_orderkey, chk AS check_digits, chk = '11' AS valid, chk <> '11' AS fictional FROM ("
    "SELECT o_orderkey, lpad(cast(98 - cast(lpad(cast(o_orderkey as varchar), 7, '0') || '2099826010000' AS hugeint) % 97 AS varchar), 2, '0') AS chk FROM orders)"
)
def check_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _order_key()
    return read(spark, sf_dir, "orders").select("o_orderkey", keys.check_digits(k).alias("check_digits"), keys.is_valid(k).alias("valid"), keys.is_fictional(k).alias("fictional"))


KEYED_TEXT_SQL = f"SELECT o_orderkey, o_orderpriority || ' ' || {KEY_SQL} || ' e ' || lpad(cast(o_custkey as varchar), 7, '0') || '-22.2098.8.26.0200 ' || {KEY_SQL} AS t, o_orderkey % 3 AS m FROM orders"


@query(
    f"SELECT o_orderkey, nullif(regexp_extract(t, '{RE_KEY}'), '') AS first_key, cast(len(list_distinct(regexp_extract_all(t, '{RE_KEY}'))) AS int) AS n_keys, "
    f"coalesce(regexp_extract_all(t, '{RE_KEY}')[2], '') AS second_key FROM (SELECT o_orderkey, CASE WHEN m = 0 THEN replace(t, '-', '') ELSE t END AS t FROM ({KEYED_TEXT_SQL}))"
)
def key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.concat(F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.lit("-22.2098.8.26.0200"))
    t = F.concat_ws(" ", "o_orderpriority", _order_key(), F.lit("e"), other, _order_key())
    t = F.when(F.col("o_orderkey") % 3 == 0, F.replace(t, F.lit("-"), F.lit(""))).otherwise(t)
    found = keys.all_keys(t)
    return read(spark, sf_dir, "orders").select("o_orderkey", keys.first_key(t).alias("first_key"), F.size(found).alias("n_keys"), F.coalesce(F.get(found, F.lit(1)), F.lit("")).alias("second_key"))


@query(f"SELECT o.o_orderkey, k.case_number FROM (SELECT o_orderkey, regexp_replace({KEY_SQL}, '[^a-zA-Z0-9]', '_', 'g') || CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END AS id FROM orders) o LEFT JOIN (SELECT regexp_replace({KEY_SQL}, '[^a-zA-Z0-9]', '_', 'g') AS id, {KEY_SQL} AS case_number FROM orders) k USING (id)")
def custom_id_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third id is none that is known."""
    orders = read(spark, sf_dir, "orders")
    asked = orders.select("o_orderkey", F.concat(keys.custom_id(_order_key()), F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise("")).alias("id"))
    return keys.from_custom_id(asked, orders.select(_order_key().alias("case_number")), "id").select("o_orderkey", "case_number")


# --- documents, attribution, coverage -------------------------------------------------------------------------------
PART_KINDS = Kinds(must_match="STEEL|BRASS|TIN|NICKEL|COPPER", patterns=(("judgment", "PROMO"), ("appellate_ruling", "STANDARD|SMALL"), ("settlement", r"ECONOMY\s+[AB]"), ("order", "MEDIUM")))


@query(
    "SELECT p_partkey, CASE WHEN NOT regexp_matches(upper(p_type), 'STEEL|BRASS|TIN|NICKEL|COPPER') THEN 'not_pdf' WHEN regexp_matches(upper(p_type), 'PROMO') THEN 'judgment' "
    r"WHEN regexp_matches(upper(p_type), 'STANDARD|SMALL') THEN 'appellate_ruling' WHEN regexp_matches(upper(p_type), 'ECONOMY\s+[AB]') THEN 'settlement' WHEN regexp_matches(upper(p_type), 'MEDIUM') THEN 'order' ELSE 'generic' END AS kind FROM part"
)
def doc_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", planning.document_kind(F.col("p_type"), PART_KINDS).alias("kind"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files whose path spells the key in one of five ways."""
    k, m, n = _order_key(), F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    path = F.when(m == 0, F.concat(k, F.lit(" - sentenca.pdf"))).when(m == 1, F.concat(k, F.lit("/acordao.pdf"))).when(m == 2, F.concat(F.lit("in/"), keys.digits(k), F.lit("_doc.pdf"))).when(m == 3, F.concat(F.lit("in/file "), n, F.lit(".pdf"))).otherwise(F.concat(F.lit("in/ref"), n, F.lit("x"), keys.digits(k), F.lit(".pdf")))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("name"))


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as cases; every third has a key that no file spells."""
    k = F.when(F.col("o_orderkey") % 3 == 0, F.replace(_order_key(), F.lit("2099"), F.lit("2098"))).otherwise(_order_key())
    return read(spark, sf_dir, "orders").select(k.alias("case_number"), F.col("o_orderkey").alias("ord"))


FILES_SQL = (
    f"files AS (SELECT id, path, regexp_extract(path, '[^/]*$') AS name FROM (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN {KEY_SQL} || ' - sentenca.pdf' WHEN 1 THEN {KEY_SQL} || '/acordao.pdf' "
    f"WHEN 2 THEN 'in/' || regexp_replace({KEY_SQL}, '[^0-9]', '', 'g') || '_doc.pdf' WHEN 3 THEN 'in/file ' || o_orderkey || '.pdf' ELSE 'in/ref' || o_orderkey || 'x' || regexp_replace({KEY_SQL}, '[^0-9]', '', 'g') || '.pdf' END AS path FROM orders)), "
    f"cases AS (SELECT case_number, ord, regexp_replace(case_number, '[^0-9]', '', 'g') AS d FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN replace({KEY_SQL}, '2099', '2098') ELSE {KEY_SQL} END AS case_number, o_orderkey AS ord FROM orders)), "
    f"own AS (SELECT *, nullif(regexp_extract(path, '{RE_KEY}'), '') AS kp, nullif(regexp_extract(name, '{RE_KEY}'), '') AS kn, regexp_replace(path || ' ' || name, '[^0-9]', '', 'g') AS hay FROM files), "
    "runs AS (SELECT DISTINCT id, substr(hay, cast(i AS bigint), 20) AS d FROM (SELECT id, hay, unnest(range(1, greatest(length(hay) - 18, 1))) AS i FROM own) WHERE length(hay) >= 20) "
)


@query(f"WITH {FILES_SQL}, hit AS (SELECT id, arg_min(case_number, ord) AS c FROM runs JOIN cases USING (d) GROUP BY id) SELECT own.id, coalesce(kp, kn, c) AS case_number FROM own LEFT JOIN hit USING (id)")
def doc_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attribute(_files(spark, sf_dir), _cases(spark, sf_dir)).select("id", "case_number")


@query(
    f"WITH {FILES_SQL}, flags AS (SELECT c.case_number, c.case_number IN (SELECT kn FROM own WHERE kn IS NOT NULL) AS f, c.case_number IN (SELECT kn FROM own WHERE kn IS NOT NULL UNION ALL SELECT kp FROM own WHERE kp IS NOT NULL) AS p, c.d IN (SELECT d FROM runs) AS g FROM cases c), "
    "n AS (SELECT count(*) AS targets, count(*) FILTER (f) AS f, count(*) FILTER (p) AS p, count(*) FILTER (g) AS g FROM flags), r AS (SELECT 0 AS step, 'filename' AS key, targets, f AS covered FROM n UNION ALL SELECT 1, 'path', targets, p FROM n UNION ALL SELECT 2, 'digits', targets, g FROM n) "
    "SELECT step, key, targets, covered, CASE WHEN targets = 0 THEN 0.0 ELSE floor(cast(covered AS double) / targets * 1000 + 0.5) / 10 END AS coverage_pct FROM r"
)
def coverage_progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.progression(_files(spark, sf_dir), _cases(spark, sf_dir))


@query(f"WITH {FILES_SQL} SELECT id, true AS no_filename, kp IS NULL AS no_path, kp IS NULL AND id NOT IN (SELECT id FROM runs JOIN cases USING (d)) AS no_digits FROM own WHERE kn IS NULL")
def unattributable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.unattributable(_files(spark, sf_dir), _cases(spark, sf_dir))


@query("SELECT 'folder:' || o_orderkey AS id, 0 AS priority, o_orderkey AS n FROM orders UNION ALL SELECT 'manifest:' || o_orderkey, 1, o_orderkey FROM orders")
def composite_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.sources.documents import composite

    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("n"))
    return composite({"folder": o, "manifest": o}).select("id", "priority", "n")


@query("SELECT path, row_number() OVER (ORDER BY path, id) - 1 AS place FROM (SELECT o_orderkey AS id, o_orderpriority || '/' || o_orderstatus || '/' || o_orderkey AS path FROM orders)")
def sorted_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths in binary order, as the folder scan lists them."""
    paths = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat_ws("/", "o_orderpriority", "o_orderstatus", F.col("o_orderkey").cast("string")).alias("path"))
    return sampling.ranked(paths, [F.col("path"), F.col("id")], "place").select("path", "place")


# --- plans ----------------------------------------------------------------------------------------------------------
DOC_KINDS = Kinds(decisive=("en", "fr"), per_kind=2)


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files of cases: kind by language (es is no document, de is generic), some cases without decisions."""
    d = read(spark, sf_dir, "documents")
    case = F.concat(F.col("source"), F.lit("-"), (F.col("doc_id") % 7).cast("string"))
    kind = F.when(F.col("lang") == "es", "not_pdf").when(F.col("lang") == "de", "generic").when(F.col("doc_id") % 7 == 3, "writ").otherwise(F.col("lang"))
    docs = d.select(case.alias("case_number"), F.col("doc_id").alias("id"), kind.alias("kind"), F.col("n_chars").alias("bytes"))
    return planning.reading_plan(docs, docs.select("case_number"), DOC_KINDS)


PLAN_SQL = (
    "docs AS (SELECT source || '-' || (doc_id % 7) AS case_number, doc_id AS id, CASE WHEN lang = 'es' THEN 'not_pdf' WHEN lang = 'de' THEN 'generic' WHEN doc_id % 7 = 3 THEN 'writ' ELSE lang END AS kind, n_chars AS bytes FROM documents), "
    "u AS (SELECT *, CASE kind WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS kr, CASE WHEN kind IN ('en', 'fr') THEN 1 WHEN kind = 'generic' THEN 2 ELSE 3 END AS tier FROM docs WHERE kind <> 'not_pdf'), "
    "b AS (SELECT * FROM u QUALIFY tier = min(tier) OVER (PARTITION BY case_number)), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY case_number, CASE WHEN tier = 1 THEN kr ELSE -1 END ORDER BY bytes DESC, id) AS rn FROM b), "
    "p AS (SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY kr, rn) AS pos FROM r WHERE rn = 1 OR (tier = 1 AND rn <= 2)), "
    "plan AS (SELECT c.case_number, CASE tier WHEN 1 THEN 'named_decisions' WHEN 2 THEN 'generic' WHEN 3 THEN 'weak' ELSE 'none' END AS strategy, cast(pos AS int) AS pos, id, kind, bytes FROM (SELECT DISTINCT case_number FROM docs) c LEFT JOIN p USING (case_number))"
)


@query(f"WITH {PLAN_SQL} SELECT * FROM plan")
def reading_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


@query(f"WITH {PLAN_SQL} SELECT strategy, count(DISTINCT case_number) AS cases FROM plan GROUP BY strategy")
def plan_strategy_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.strategies(_plan(spark, sf_dir))


@query(
    f"WITH {PLAN_SQL}, t AS (SELECT plan.case_number, count(*) AS used, string_agg('===== ' || upper(kind) || ': ' || id || E' =====\\n' || d.text, E'\\n\\n' ORDER BY pos) AS text FROM plan JOIN documents d ON d.doc_id = plan.id WHERE regexp_matches(d.text, '\\S') GROUP BY 1) "
    "SELECT case_number, used, length(text) AS n_chars, md5(text) AS digest FROM t"
)
def case_text_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    parts = _plan(spark, sf_dir).where("id is not null").join(texts, "id").withColumn("name", F.col("id").cast("string"))
    return planning.case_text(parts).select("case_number", "used", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


PADDED_SQL = "(SELECT doc_id, repeat(chr(32) || chr(10) || chr(9), cast(doc_id % 100 AS bigint)) || text AS t FROM documents)"


@query(
    f"SELECT doc_id, a OR b AS is_scan, CASE WHEN length(t) > 1048576 THEN 'too_large' WHEN a OR b THEN 'scanned' END AS skip FROM (SELECT doc_id, t, cast(length(t) AS double) / (1 + doc_id % 40) < 60 AS a, length(regexp_replace(t, '^[\\s]+|[\\s]+$', '', 'g')) < 200 AS b FROM {PADDED_SQL})"
)
def scan_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with white space of several kinds in front, of 1 to 40 pages."""
    text = F.concat(F.expr("repeat(concat(chr(32), chr(10), chr(9)), cast(doc_id % 100 as int))"), F.col("text"))
    d = read(spark, sf_dir, "documents").select("doc_id", text.alias("t"))
    scan = planning.is_scan(F.col("t"), 1 + F.col("doc_id") % 40)
    return d.select("doc_id", scan.alias("is_scan"), planning.skip_reason(F.length("t"), scan, max_mb=1).alias("skip"))


@query(f"WITH {PLAN_SQL}, w AS (SELECT plan.case_number, pos, plan.id, CASE WHEN bytes > 1048576 THEN 'too_large' WHEN length(d.text) < 200 THEN 'scanned' END AS why FROM plan JOIN documents d ON d.doc_id = plan.id) SELECT case_number, coalesce(string_agg(id, ',' ORDER BY pos) FILTER (why IS NULL), '') AS used, coalesce(string_agg(id || ':' || why, ',' ORDER BY pos) FILTER (why IS NOT NULL), '') AS skipped FROM w GROUP BY 1")
def skip_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per case what is read and what is not, with the reason, in order of reading."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    why = planning.skip_reason(F.col("bytes"), F.length("text") < 200, max_mb=1)
    parts = _plan(spark, sf_dir).where("id is not null").join(texts, "id").select("case_number", "pos", F.col("id").cast("string").alias("name"), why.alias("why"))
    lists = planning.used_and_skipped(parts)
    return lists.select("case_number", F.array_join("documents", ",").alias("used"), F.array_join(F.transform("skipped", lambda x: F.concat_ws(":", x["name"], x["why"])), ",").alias("skipped"))


# --- segmentation ---------------------------------------------------------------------------------------------------
SMALL = Segmentation(operative=("of the ", "de la ", "(?m)^Der "), report=("(?i) la ", "(?i) in "), signature=(" und ",), min_length=300, docket_above=4000, before=150, after=250, budget=1500, header_cap=200, report_cap=300, header_label="[H]", windows_label="[W]", report_label="[R]", tail_label="[T]")
MARKED_SQL = (
    "marks AS (SELECT doc_id, text, length(text) AS n, CASE WHEN length(text) >= 300 THEN list_sort(list_distinct(flatten([starts(text, 'of the '), starts(text, 'de la '), starts(text, '(?m)^Der ')]))) ELSE [] END AS ps, "
    "CASE WHEN length(text) >= 300 THEN least(starts(text, '(?i) la ')[1], starts(text, '(?i) in ')[1]) END AS rep, CASE WHEN length(text) >= 300 THEN starts(text, ' und ')[1] END AS sig FROM documents)"
)


def _starts_sql(sql: str) -> str:
    """Spell out starts(text, regex): the starts of all matches, from the lengths of what stands between them."""
    import re

    def one(m: re.Match) -> str:
        parts = f"string_split(regexp_replace(text, '({m[1]})', chr(1) || '\\1', 'g'), chr(1))"
        return f"list_transform(range(1, len({parts})), lambda i: list_sum(list_transform({parts}[1:i], lambda p: length(p)))::int)"

    return re.sub(r"starts\(text, '([^']*)'\)", one, sql)


@query(_starts_sql(f"WITH {MARKED_SQL} SELECT doc_id, cast(len(ps) AS int) AS n_markers, coalesce(array_to_string(ps, ','), '') AS positions FROM marks"))
def marker_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    at = F.when(F.length("text") >= SMALL.min_length, T.marker_positions(F.col("text"), SMALL.operative)).otherwise(F.array().cast("array<int>"))
    return d.select("doc_id", at.alias("at")).select("doc_id", F.size("at").alias("n_markers"), F.array_join(F.col("at").cast("array<string>"), ",").alias("positions"))


SEGMENT_SQL = (
    f"WITH {MARKED_SQL}, w0 AS (SELECT doc_id, n, greatest(0, p - 150) AS a, least(n, p + 250) AS b FROM (SELECT doc_id, n, unnest(ps) AS p FROM marks WHERE n > 4000)), "
    "w1 AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM w0), "
    "w2 AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM w1), w3 AS (SELECT doc_id, island, min(a) AS a, max(b) AS b FROM w2 GROUP BY 1, 2), "
    "w4 AS (SELECT *, sum(b - a) OVER (PARTITION BY doc_id ORDER BY island DESC ROWS UNBOUNDED PRECEDING) AS total, max(island) OVER (PARTITION BY doc_id) AS last FROM w3), "
    "w5 AS (SELECT w4.doc_id, count(*) AS windows, string_agg(substr(text, cast(a + 1 AS bigint), cast(b - a AS bigint)), E'\\n\\n[...]\\n\\n' ORDER BY island) AS body FROM w4 JOIN documents USING (doc_id) WHERE total <= 1500 OR island = last GROUP BY 1), "
    "c AS (SELECT marks.*, w5.windows, CASE WHEN n > 4000 THEN E'[H]\\n' || substr(text, 1, 200) || E'\\n\\n[W]\\n' || body WHEN len(ps) > 0 THEN E'[H]\\n' || substr(text, 1, least(200, ps[1])) || E'\\n\\n' || "
    "CASE WHEN rep < ps[1] THEN E'[R]\\n' || CASE WHEN ps[1] - rep > 300 THEN substr(text, rep + 1, 300) || E'\\n[...]' ELSE substr(text, rep + 1, ps[1] - rep) END || E'\\n\\n' ELSE '' END || E'[T]\\n' || substr(text, ps[1] + 1) END AS cut FROM marks LEFT JOIN w5 USING (doc_id)), "
    "s AS (SELECT *, coalesce(cast(n - length(cut) AS double) / n >= 0.1, false) AND len(ps) > 0 AS worth FROM c), "
    "seg AS (SELECT doc_id, CASE WHEN worth THEN cut ELSE text END AS segmented, CASE WHEN NOT worth THEN 'none' WHEN n > 4000 THEN 'full-docket' ELSE 'decision' END AS mode, cast(n AS int) AS original_length, len(ps) > 0 AS found_operative, rep IS NOT NULL AS found_report, sig IS NOT NULL AS found_signature, "
    "cast(CASE WHEN len(ps) = 0 THEN 0 WHEN n > 4000 THEN windows ELSE 1 END AS int) AS found_windows FROM s) "
)
SEGMENT_SQL = _starts_sql(SEGMENT_SQL)


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.segment(read(spark, sf_dir, "documents").select("doc_id", "text"), policy=SMALL)


@query(SEGMENT_SQL + "SELECT doc_id, mode, original_length, cast(length(segmented) AS int) AS segmented_length, cast(floor(cast(original_length - length(segmented) AS double) / original_length * 100 + 0.5) AS int) AS reduction_pct, md5(segmented) AS digest FROM seg")
def segment_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmented(spark, sf_dir).select("doc_id", "mode", "original_length", "segmented_length", "reduction_pct", F.md5("segmented").alias("digest"))


@query(SEGMENT_SQL + "SELECT doc_id, found_operative, found_report, found_signature, found_windows FROM seg")
def segment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmented(spark, sf_dir).select("doc_id", "found_operative", "found_report", "found_signature", "found_windows")


@query(SEGMENT_SQL + "SELECT mode, count(*) AS n FROM seg GROUP BY mode")
def segment_mode_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmented(spark, sf_dir).groupBy("mode").agg(F.count("*").alias("n"))


# --- gate, audit ----------------------------------------------------------------------------------------------------
TURNS = Gate(undetermined="Ha", valid_opening=r"^\s*[A-T]", settlement_opening=r"^\s*Th", amount="!", terms_unavailable=r"(?i)the [a-z]+ing", self_declared=r"(?i)of the|an and")
GATE_SQL = (
    r"gated AS (SELECT conv_id, turn, text, CASE WHEN starts_with(trim(text), 'Ha') THEN 'no_final_decision' WHEN NOT regexp_matches(trim(text), '^\s*[A-T]') THEN 'off_house_style' WHEN regexp_matches(text, '^\s*Th') AND NOT regexp_matches(text, '!') AND regexp_matches(text, '(?i)the [a-z]+ing') THEN 'settlement_without_terms' "
    "WHEN regexp_matches(text, '(?i)of the|an and') THEN 'self_declared_insufficiency' END AS gate_reason FROM conversations)"
)


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gated(read(spark, sf_dir, "conversations"), "text", TURNS)


@query(f"WITH {GATE_SQL} SELECT conv_id, turn, gate_reason, CASE WHEN gate_reason IS NULL THEN 'writeable' ELSE 'needs_review' END AS status FROM gated")
def gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("conv_id", "turn", "gate_reason", "status")


@query(f"WITH {GATE_SQL} SELECT coalesce(gate_reason, 'writeable') AS reason, count(*) AS n FROM gated GROUP BY 1")
def gate_reason_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).groupBy(F.coalesce("gate_reason", F.lit("writeable")).alias("reason")).agg(F.count("*").alias("n"))


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, labels as verdicts: toxic is severe, low quality minor, unlabelled no verdict."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_number"), F.when(F.col("n_chars") < 500, "off_house_style").alias("gate_reason"))
    records = d.withColumn("status", F.when(F.col("gate_reason").isNull(), "writeable").otherwise("needs_review"))
    verdicts = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_number"), F.when(F.col("toxic") == 1, "severe").when(F.col("quality") == 0, "minor").otherwise("ok").alias("severity"), F.when((F.col("toxic") == 1) & (F.col("doc_id") % 2 == 0), F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("unsupported"))
    return gate.audited(records, verdicts)


AUDIT_SQL = (
    "rec AS (SELECT d.doc_id AS case_number, CASE WHEN n_chars < 500 THEN 'off_house_style' END AS gate_reason, CASE WHEN toxic = 1 THEN 'severe' WHEN quality = 0 THEN 'minor' WHEN quality IS NOT NULL THEN 'ok' END AS audit_severity FROM documents d LEFT JOIN labels l USING (doc_id)), "
    "aud AS (SELECT case_number, gate_reason, audit_severity, CASE WHEN gate_reason IS NULL AND audit_severity = 'severe' THEN CASE WHEN case_number % 2 = 0 THEN 'audit: a | b' ELSE 'audit: an assertion the source does not support' END END AS audit_reason, CASE WHEN gate_reason IS NOT NULL OR audit_severity = 'severe' THEN 'needs_review' ELSE 'writeable' END AS status FROM rec)"
)


@query(f"WITH {AUDIT_SQL} SELECT * FROM aud")
def audit_demote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(spark, sf_dir).select("case_number", "gate_reason", "audit_severity", "audit_reason", "status")


@query(f"WITH {AUDIT_SQL} SELECT count(*) FILTER (audit_reason IS NULL) AS kept, count(*) FILTER (audit_reason IS NOT NULL) AS demoted, count(*) FILTER (audit_severity IS NULL) AS failed FROM aud")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.audit_report(_audited(spark, sf_dir))


@query(f"WITH {AUDIT_SQL} SELECT CASE WHEN audit_reason IS NOT NULL THEN 'audit' ELSE coalesce(gate_reason, 'unknown') END AS reason, count(*) AS n FROM aud WHERE status <> 'writeable' GROUP BY 1")
def refusal_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.refusal_groups(_audited(spark, sf_dir))


# --- names and catalogue --------------------------------------------------------------------------------------------
@query("SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'), ' ')) AS key FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Erdős ação Çà ' ELSE 'resc' || 'isa' || chr(771) || 'o ' END || text AS text FROM documents)")
def normalise_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with letters that carry their accents and with accents of their own."""
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "Erdős ação Çà ").otherwise("rescisa\u0303o "), F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalise_key(text)).alias("key"))


GRAMS_SQL = "CASE WHEN length({0}) >= 2 THEN list_transform(range(1, length({0})), lambda i: substr({0}, i, 2)) ELSE [] END"
DICE_SQL = (
    "CASE WHEN {a} = {b} THEN 1.0 WHEN length({a}) < 2 OR length({b}) < 2 THEN 0.0 ELSE 2.0 * coalesce(list_sum(list_transform(list_distinct({ga}), lambda g: least(len(list_filter({ga}, lambda e: e = g)), len(list_filter({gb}, lambda f: f = g))))), 0) / (len({ga}) + len({gb})) END"
)


@query(
    "WITH p AS (SELECT p_partkey, lower(p_type) AS a, lower(substr(p_type, 3) || p_brand) AS b FROM part), g AS (SELECT *, " + GRAMS_SQL.format("a") + " AS ga, " + GRAMS_SQL.format("b") + " AS gb FROM p) "
    "SELECT p_partkey, round(" + DICE_SQL.format(a="a", b="b", ga="ga", gb="gb") + ", 9) AS dice FROM g"
)
def dice_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.lower("p_type"), F.lower(F.concat(F.expr("substring(p_type, 3)"), F.col("p_brand")))
    return read(spark, sf_dir, "part").select("p_partkey", F.round(T.dice(a, b), 9).alias("dice"))


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").groupBy(F.col("p_type").alias("canonical")).agg(F.min("p_partkey").alias("idx"))
    return p


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as names that are written in several careless ways."""
    m, t = F.col("p_partkey") % 5, F.col("p_type")
    name = F.when(m == 0, t).when(m == 1, F.lower(F.replace(t, F.lit(" "), F.lit("--")))).when(m == 2, F.concat(F.expr("substring(p_type, 2)"), F.lit("s"))).when(m == 3, F.concat(F.expr("left(p_type, 4)"), F.lit(" zz"))).otherwise(F.concat(t, F.lit(" "), F.expr("left(p_brand, 2)")))
    return read(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


NORM_SQL = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'), ' ')"
MATCH_SQL = (
    "cat AS (SELECT p_type AS canonical, min(p_partkey) AS idx, " + NORM_SQL.format("p_type") + " AS key FROM part GROUP BY p_type), ex AS (SELECT key, arg_max(canonical, idx) AS exact FROM cat GROUP BY key), "
    "claims AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_type WHEN 1 THEN lower(replace(p_type, ' ', '--')) WHEN 2 THEN substr(p_type, 2) || 's' WHEN 3 THEN left(p_type, 4) || ' zz' ELSE p_type || ' ' || left(p_brand, 2) END AS name FROM part), "
    "nm AS (SELECT name, " + NORM_SQL.format("name") + " AS k, exact FROM (SELECT DISTINCT name FROM claims) LEFT JOIN ex ON key = " + NORM_SQL.format("name") + "), "
    "pairs AS (SELECT name, canonical, idx, k, key, " + GRAMS_SQL.format("k") + " AS ga, " + GRAMS_SQL.format("key") + " AS gb FROM nm, cat WHERE exact IS NULL), scored AS (SELECT name, canonical, idx, " + DICE_SQL.format(a="k", b="key", ga="ga", gb="gb") + " AS s FROM pairs), "
    "best AS (SELECT name, canonical AS near, s FROM scored QUALIFY row_number() OVER (PARTITION BY name ORDER BY s DESC, idx) = 1), "
    "matched AS (SELECT nm.name, coalesce(exact, CASE WHEN s >= 0.82 THEN near END) AS canonical, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN s >= 0.82 THEN 'fuzzy' ELSE 'none' END AS method, round(CASE WHEN exact IS NOT NULL THEN 1.0 ELSE coalesce(s, 0.0) END, 9) AS score FROM nm LEFT JOIN best USING (name))"
)


@query(f"WITH {MATCH_SQL} SELECT * FROM matched")
def catalogue_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.match(_claims(spark, sf_dir), _catalogue(spark, sf_dir)).withColumn("score", F.round("score", 9))


@query(f"WITH {MATCH_SQL} SELECT p_partkey, name AS raw_claim, coalesce(canonical, CASE WHEN p_partkey % 2 = 0 THEN 'Não identificado' ELSE name END) AS canonical_claim FROM claims JOIN matched USING (name)")
def claim_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _claims(spark, sf_dir).select("p_partkey", F.col("name").alias("raw_claim"), F.when(F.col("p_partkey") % 2 == 0, "Não identificado").otherwise(F.col("name")).alias("canonical_claim"))
    return catalogue.repair(c, _catalogue(spark, sf_dir))


# as many entries as there are parts; careless versions are equal but for signs, near, of other order, and hardly alike
PARTS_SQL = (
    "part_entry AS (SELECT p_partkey AS idx, " + NORM_SQL.format("p_name || ' ' || p_brand || ' ' || p_size") + " AS key FROM part), "
    "careless AS (SELECT DISTINCT " + NORM_SQL.format("name") + " AS k FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN upper(p_name) || '--' || p_brand || '--' || p_size WHEN 1 THEN left(p_name, 2) || substr(p_name, 4) || ' ' || p_brand || p_size WHEN 2 THEN p_size || p_brand || p_name WHEN 3 THEN left(p_name, 4) || ' zzyyxx ' || p_size ELSE 'qq ' || p_type END AS name FROM part)), "
    "open_name AS (SELECT k FROM careless ANTI JOIN part_entry ON key = k), "
)


def _tokens_sql(table: str, key: str, own: str) -> str:
    return f"(SELECT {own}, substr({key}, i, 2) AS g, row_number() OVER (PARTITION BY {own}, substr({key}, i, 2) ORDER BY i) AS o FROM (SELECT {own}, {key}, unnest(range(1, length({key}))) AS i FROM {table}))"


@query(
    f"WITH {PARTS_SQL} x AS {_tokens_sql('open_name', 'k', 'k')}, y AS {_tokens_sql('part_entry', 'key', 'idx')}, n AS (SELECT k, count(*) AS n FROM x GROUP BY k), m AS (SELECT idx, count(*) AS m FROM y GROUP BY idx), "
    "pair AS (SELECT k, idx, count(*) AS c FROM x JOIN y USING (g, o) GROUP BY k, idx) SELECT k AS key, idx, round(2.0 * c / (n + m), 9) AS score FROM pair JOIN n USING (k) JOIN m USING (idx) QUALIFY row_number() OVER (PARTITION BY k ORDER BY 2.0 * c / (n + m) DESC, idx) = 1"
)
def similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most similar part of each careless description, exact however low the similarity."""
    p, size = read(spark, sf_dir, "part"), F.col("p_size").cast("string")
    d = F.lit(" ")
    entries = p.select(F.col("p_partkey").alias("idx"), T.normalise_key(F.concat("p_name", d, "p_brand", d, size)).alias("key"))
    m, dash = F.col("p_partkey") % 5, F.lit("--")
    name = F.when(m == 0, F.concat(F.upper("p_name"), dash, "p_brand", dash, size)).when(m == 1, F.concat(F.left("p_name", F.lit(2)), F.expr("substring(p_name, 4)"), d, "p_brand", size)).when(m == 2, F.concat(size, "p_brand", "p_name"))
    name = name.when(m == 3, F.concat(F.left("p_name", F.lit(4)), F.lit(" zzyyxx "), size)).otherwise(F.concat(F.lit("qq "), "p_type"))
    names = p.select(T.normalise_key(name).alias("key")).distinct().join(entries.select("key").distinct().hint("merge"), "key", "left_anti")
    return similarity.best(names, entries, 0.82).withColumn("score", F.round("score", 9))


# --- cost -----------------------------------------------------------------------------------------------------------
PRICE_SQL = "price(model, i, o, w, r) AS (VALUES ('light', 0.75, 2.25, 0.9375, 0.03), ('standard', 3.5, 11.5, 4.375, 0.35), ('large', 16.0, 41.0, 20.0, 2.4))"
USAGE_SQL = (
    f"{PRICE_SQL}, u AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'large' WHEN 1 THEN 'standard' WHEN 2 THEN 'light' ELSE CASE WHEN l_orderkey % 3 = 0 THEN 'unknown' ELSE 'light' END END AS model, l_partkey AS input_tokens, l_suppkey * 3 AS output_tokens, cast(l_quantity AS bigint) * 10 AS cache_write_tokens, CASE WHEN l_returnflag <> 'N' THEN l_partkey * 2 END AS cache_read_tokens FROM lineitem), "
    "c AS (SELECT u.*, price.model AS priced_with, (input_tokens / 1e6 * i + output_tokens / 1e6 * o + cache_write_tokens / 1e6 * w + coalesce(cache_read_tokens, 0) / 1e6 * r) * 0.5 AS cost_usd FROM u LEFT JOIN price USING (model))"
)


def _prices(spark: SparkSession) -> DataFrame:
    """Stands in for a price file; the figures are invented."""
    listed = [("light", 0.75, 2.25, None, 0.03), ("standard", 3.5, 11.5, None, None), ("large", 16.0, 41.0, None, 2.4)]
    return cost.price_rows(spark.createDataFrame(listed, "model string, input double, output double, cache_write double, cache_read double"))


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber") % 4
    model = F.when(n == 0, "large").when(n == 1, "standard").when(n == 2, "light").otherwise(F.when(F.col("l_orderkey") % 3 == 0, "unknown").otherwise("light"))
    u = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", model.alias("model"), F.col("l_partkey").alias("input_tokens"), (F.col("l_suppkey") * 3).alias("output_tokens"), (F.col("l_quantity").cast("long") * 10).alias("cache_write_tokens"), F.when(F.col("l_returnflag") != "N", F.col("l_partkey") * 2).alias("cache_read_tokens"))
    return cost.priced(u, _prices(spark), discount=0.5)


@query(f"WITH {USAGE_SQL} SELECT l_orderkey, l_linenumber, model, priced_with, round(cost_usd, 10) AS cost_usd FROM c")
def usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(spark, sf_dir).select("l_orderkey", "l_linenumber", "model", "priced_with", F.round("cost_usd", 10).alias("cost_usd"))


@query(f"WITH {USAGE_SQL} SELECT l_orderkey, cast(sum(input_tokens) AS bigint) AS input_tokens, cast(sum(output_tokens) AS bigint) AS output_tokens, CASE WHEN count(cost_usd) = count(*) THEN round(sum(cost_usd), 10) END AS cost_usd, arg_max(priced_with, l_linenumber) FILTER (priced_with IS NOT NULL) AS priced_with FROM c GROUP BY 1")
def usage_total_null_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost.total_usage(_usage(spark, sf_dir), ["l_orderkey"], "l_linenumber").select("l_orderkey", "input_tokens", "output_tokens", F.round("cost_usd", 10).alias("cost_usd"), "priced_with")


# --- samples, chunks, state -----------------------------------------------------------------------------------------
@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders) SELECT o_orderkey FROM r WHERE i IN (SELECT least(n - 1, cast(floor(cast(k AS double) * (cast(n AS double) / 25.0)) AS bigint)) FROM range(25) t(k), (SELECT count(*) AS n FROM orders))")
def uniform_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_stride(read(spark, sf_dir, "orders").select("o_orderkey"), [F.col("o_orderkey")], 25)


@query("WITH r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i FROM range(30) t(n)) SELECT cast(n AS bigint) AS n FROM r WHERE i IN (SELECT cast(least(29, floor(cast(k AS double) * (30.0::double / 22.0::double))) AS bigint) FROM range(22) t(k))")
def uniform_stride_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_stride(spark.range(30).withColumnRenamed("id", "n"), [F.col("n")], 22)


@query("SELECT doc_id, cast(floor((row_number() OVER (ORDER BY doc_id) - 1) / 100) AS bigint) AS chunk FROM documents")
def chunk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.chunked(read(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")], 100)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT item_id FROM benchmark)")
def todo_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.todo(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id", read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id")))


@query("SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "value")


@query("SELECT user_id AS batch, min(event_id) AS first_at, row_number() OVER (ORDER BY min(event_id)) - 1 AS place FROM events GROUP BY 1")
def batch_id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id once, in the order in which ids first came."""
    ids = state.batch_ids(read(spark, sf_dir, "events").select(F.col("user_id").alias("batch"), "event_id"), "batch", "event_id")
    return sampling.ranked(ids, [F.col("first_at")], "place").select("batch", "first_at", "place")


@query(
    "WITH r AS (SELECT doc_id AS custom_id, lang <> 'es' AS ok, CASE WHEN doc_id IN (SELECT item_id FROM benchmark) THEN 'known' WHEN doc_id NOT IN (SELECT doc_id FROM labels) OR lang = 'es' THEN 'invalid' ELSE 'new' END AS outcome, n_chars FROM documents) "
    "SELECT custom_id, outcome, CASE WHEN ok AND outcome <> 'known' THEN n_chars ELSE 0 END AS billed FROM r"
)
def collect_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a batch: what came before is not billed again, what came is, of use or not."""
    results = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("custom_id"), (F.col("lang") != "es").alias("ok"), "n_chars")
    tagged = state.collected(results, read(spark, sf_dir, "labels").select(F.col("doc_id").alias("custom_id")), read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("custom_id")))
    return tagged.select("custom_id", "outcome", F.when(state.billed(), F.col("n_chars")).otherwise(0).alias("billed"))


@query(f"WITH a AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'see ' || {KEY_SQL} WHEN 1 THEN 'map ' || (o_orderkey + 1) WHEN 2 THEN 'sum ' || o_orderkey ELSE 'none' END AS text FROM orders), r AS (SELECT {KEY_SQL} AS case_number, 'map ' || o_orderkey AS map, 'sum ' || o_orderkey AS summary FROM orders WHERE o_orderkey % 3 <> 0) "
    f"SELECT a.id, coalesce(k.case_number, m.case_number, s.case_number) AS case_number FROM a LEFT JOIN r k ON k.case_number = nullif(regexp_extract(a.text, '{RE_KEY}'), '') LEFT JOIN r m ON m.map = a.text LEFT JOIN r s ON s.summary = a.text")
def recording_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.sources.providers import find_recording

    o, n = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    m = n % 4
    asked = o.select(n.alias("id"), F.when(m == 0, F.concat(F.lit("see "), _order_key())).when(m == 1, F.concat(F.lit("map "), (n + 1).cast("string"))).when(m == 2, F.concat(F.lit("sum "), n.cast("string"))).otherwise("none").alias("text"))
    known = o.where(n % 3 != 0).select(_order_key().alias("case_number"), F.concat(F.lit("map "), n.cast("string")).alias("map"), F.concat(F.lit("sum "), n.cast("string")).alias("summary"))
    return find_recording(asked, known).select("id", "case_number")


@query("SELECT user_id AS batch, count(*) FILTER (event_id % 5 = 0) AS processing, count(*) FILTER (event_id % 5 = 1) AS succeeded, count(*) FILTER (event_id % 5 = 2) AS errored, count(*) FILTER (event_id % 5 = 3) AS canceled, count(*) FILTER (event_id % 5 = 4) AS expired FROM events GROUP BY 1")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.sources import providers

    states = F.array(*[F.lit(s) for s in ("processing", "succeeded", "errored", "canceled", "expired")])
    return providers.batch_counts(read(spark, sf_dir, "events").select(F.col("user_id").alias("batch"), F.get(states, (F.col("event_id") % 5).cast("int")).alias("state")))


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def limit_before_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = state.first_n(read(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")], 50)
    return state.todo(first, read(spark, sf_dir, "labels"), "doc_id")


@query("SELECT conv_id AS custom_id, max(turn) AS row FROM conversations GROUP BY 1")
def last_row_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.last_row_wins(read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("custom_id"), F.col("turn").alias("row")))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'peça' WHEN 'fr' THEN 'não-PDF' WHEN 'de' THEN 'sentença' ELSE lang END AS label FROM documents")
def kind_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("lang") == "en", "generic").when(F.col("lang") == "fr", "not_pdf").when(F.col("lang") == "de", "judgment").otherwise(F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", planning.kind_label(kind).alias("label"))


# --- evaluation -----------------------------------------------------------------------------------------------------
def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left")


RATE = "floor(cast(count(*) FILTER ({0}) AS double) / nullif(count(*), 0) * 1000 + 0.5) / 10"


@query(
    "SELECT count(*) AS sampled, count(*) FILTER (toxic = 0 AND quality = 1) AS n_ok, count(*) FILTER (toxic = 0 AND quality = 0) AS n_minor, count(*) FILTER (toxic = 1 OR toxic IS NULL) AS n_severe, count(*) FILTER (toxic IS NULL) AS n_failed, "
    + RATE.format("toxic IS NOT NULL AND doc_id % 4 <> 0") + " AS clean_pct, " + RATE.format("toxic = 1 OR toxic IS NULL") + " AS severe_pct, floor(avg(CASE WHEN toxic IS NULL THEN 0.0 ELSE doc_id % 11 END) * 10 + 0.5) / 10 AS mean_score FROM documents LEFT JOIN labels USING (doc_id)"
)
def fidelity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.when(F.col("toxic") == 1, "severe").when(F.col("quality") == 0, "minor").when(F.col("quality") == 1, "ok")
    return evaluate.fidelity_report(_outcomes(spark, sf_dir).select(severity.alias("severity"), F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0).alias("n_unsupported"), (F.col("doc_id") % 11).cast("double").alias("score")))


VERDICT_SQL = "CASE WHEN toxic IS NULL THEN 'error' WHEN toxic = 1 THEN 'conflict' WHEN quality = 0 THEN 'ours_worse' WHEN doc_id % 2 = 0 THEN 'equivalent' ELSE 'ours_more_complete' END"


@query(
    f"WITH v AS (SELECT *, {VERDICT_SQL} AS v FROM documents LEFT JOIN labels USING (doc_id)) SELECT count(*) AS sampled, count(*) FILTER (v = 'equivalent') AS n_equivalent, count(*) FILTER (v = 'ours_more_complete') AS n_ours_more_complete, count(*) FILTER (v = 'ours_worse') AS n_ours_worse, count(*) FILTER (v = 'conflict') AS n_conflict, count(*) FILTER (v = 'error') AS n_error, "
    + RATE.format("v <> 'error' AND toxic = 0") + " AS same_outcome_pct, " + RATE.format("v IN ('equivalent', 'ours_more_complete')") + " AS at_least_as_good_pct, " + RATE.format("v <> 'error' AND n_chars > 1000") + " AS house_style_pct, floor(avg(CASE WHEN v = 'error' THEN 0.0 ELSE doc_id % 11 END) * 10 + 0.5) / 10 AS mean_score FROM v"
)
def parity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.when(F.col("toxic") == 1, "conflict").when(F.col("quality") == 0, "ours_worse").when((F.col("quality") == 1) & (F.col("doc_id") % 2 == 0), "equivalent").when(F.col("quality") == 1, "ours_more_complete")
    return evaluate.parity_report(_outcomes(spark, sf_dir).select(verdict.alias("verdict"), (F.col("toxic") == 0).alias("same_outcome"), (F.col("n_chars") > 1000).alias("house_style"), (F.col("doc_id") % 11).cast("double").alias("score")))


# --- survey ---------------------------------------------------------------------------------------------------------
def _styled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as approved summaries, opened in one of the accepted ways or in none."""
    m = (F.col("conv_id") + F.col("turn")) % 9
    head = F.when(m < 3, "Acordo homologado. ").when(m == 3, "julgado  extinto por acordo. ").when(m == 4, "JULGADO EXTINTO. ").when(m == 5, "Julgado Parcialmente Procedente: ").when(m == 6, "  JULGADO IMPROCEDENTE. ").otherwise("")
    return read(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row"), (F.col("turn") % 4 != 3).alias("approved"), F.concat(head, F.col("text")).alias("existing"))


STYLE_SQL = (
    "st AS (SELECT conv_id * 1000 + turn AS row, turn % 4 <> 3 AS approved, CASE WHEN m < 3 THEN 'Acordo homologado. ' WHEN m = 3 THEN 'julgado  extinto por acordo. ' WHEN m = 4 THEN 'JULGADO EXTINTO. ' WHEN m = 5 THEN 'Julgado Parcialmente Procedente: ' WHEN m = 6 THEN '  JULGADO IMPROCEDENTE. ' ELSE '' END || text AS existing, m FROM (SELECT *, (conv_id + turn) % 9 AS m FROM conversations)), "
    "ap AS (SELECT row, CASE WHEN m < 3 THEN 'Acordo homologado' WHEN m = 3 THEN 'JULGADO EXTINTO (settlement)' WHEN m = 4 AND regexp_matches(existing, '(?i)acordo|homolog') THEN 'JULGADO EXTINTO (settlement)' WHEN m = 4 THEN 'JULGADO EXTINTO' WHEN m = 5 THEN 'JULGADO PARCIALMENTE PROCEDENTE' WHEN m = 6 THEN 'JULGADO IMPROCEDENTE' ELSE 'no accepted opening' END AS form, regexp_matches(existing, '(?i)acordo|homolog') AS settlement, existing FROM st WHERE approved)"
)


@query(f"WITH {STYLE_SQL} SELECT form, count(*) AS n, min(row) AS first_row, left(regexp_replace(arg_min(existing, row), '^[\\s]+|[\\s]+$', '', 'g'), 160) AS first_example FROM ap GROUP BY form")
def style_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.forms(survey.approved_rows(_styled(spark, sf_dir))).select("form", "n", "first_row", F.get("examples", F.lit(0)).alias("first_example"))


@query(
    f"WITH {STYLE_SQL}, c AS (SELECT form, count(*) AS n, min(row) AS first_row FROM ap WHERE form IN ('Acordo homologado', 'JULGADO EXTINTO (settlement)') GROUP BY 1), b AS (SELECT form, n, sum(n) OVER () AS t FROM c ORDER BY n DESC, first_row LIMIT 1) "
    "SELECT (SELECT count(*) FROM ap) AS approved_rows, (SELECT count(*) FILTER (settlement) FROM ap) AS settlement_rows, (SELECT count(*) FILTER (form = 'no accepted opening') FROM ap) AS unrecognised, form AS dominant_form, floor(cast(n AS double) / t * 1000 + 0.5) / 10 AS dominance_pct FROM b"
)
def survey_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.dominance(survey.approved_rows(_styled(spark, sf_dir)))


@query(
    f"WITH {STYLE_SQL}, s AS (SELECT approved, CASE WHEN m < 7 THEN 'house_style' ELSE 'off_style' END AS state FROM st) SELECT count(*) AS n_rows, count(*) FILTER (approved) AS n_approved, count(*) FILTER (state = 'house_style') AS n_house_style, count(*) FILTER (state = 'off_style') AS n_off_style, count(*) FILTER (state = 'blank') AS n_blank, "
    "count(*) FILTER (NOT approved AND state <> 'house_style') AS n_targets, count(*) FILTER (approved AND state = 'house_style') AS n_gold, count(*) FILTER (approved AND state = 'off_style') AS n_drift FROM s"
)
def inspect_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.operators.rows import histogram, with_state

    return histogram(with_state(_styled(spark, sf_dir)))


# --- grid -----------------------------------------------------------------------------------------------------------
def _cells(spark: SparkSession, sf_dir: str, changed: bool) -> DataFrame:
    k = F.col("c_custkey")
    name = F.when((k % 7 == 0) & F.lit(changed), F.concat(F.col("c_name"), F.lit("*"))).otherwise(F.col("c_name"))
    segment = F.when((k % 11 == 0) & F.lit(changed), F.lit(None)).otherwise(F.concat(F.col("c_mktsegment"), F.lit(" " if changed else "")))
    d = read(spark, sf_dir, "customer").where(F.lit(not changed) | (k % 50 != 0))
    cells = F.explode(F.array(F.struct(F.lit(1).alias("c"), name.alias("text")), F.struct(F.lit(2).alias("c"), segment.alias("text"))))
    return d.select((k + 1).alias("r"), cells.alias("x")).select("r", "x.c", "x.text", ((F.col("r") % 5 == 0) & (F.col("x.c") == 2)).alias("approved"))


DIFF_SQL = (
    "b AS (SELECT c_custkey + 1 AS r, 1 AS c, c_name AS text FROM customer UNION ALL SELECT c_custkey + 1, 2, c_mktsegment FROM customer), a AS (SELECT c_custkey + 1 AS r, 1 AS c, CASE WHEN c_custkey % 7 = 0 THEN c_name || '*' ELSE c_name END AS text FROM customer WHERE c_custkey % 50 <> 0 UNION ALL SELECT c_custkey + 1, 2, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END FROM customer WHERE c_custkey % 50 <> 0), "
    "diff AS (SELECT r, c, coalesce(b.text, '') AS before, coalesce(a.text, '') AS after, r % 5 = 0 AND c = 2 AS approved FROM b FULL JOIN a USING (r, c) WHERE coalesce(b.text, '') <> coalesce(a.text, ''))"
)


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.differences(_cells(spark, sf_dir, False), _cells(spark, sf_dir, True))


@query(f"WITH {DIFF_SQL} SELECT * FROM diff")
def cell_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff(spark, sf_dir)


@query(f"WITH {DIFF_SQL} SELECT * FROM diff")
def range_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same differences, by hashes of ranges."""
    return grid.differences_by_range(_cells(spark, sf_dir, False), _cells(spark, sf_dir, True))


@query(f"WITH {DIFF_SQL} SELECT c, chr(64 + c) AS letter, count(*) AS n FROM diff GROUP BY c")
def diff_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.by_column(_diff(spark, sf_dir))


@query(
    f"WITH {DIFF_SQL}, n AS (SELECT max(c_custkey) + 1 AS n FROM customer) SELECT 'changed' AS copy, count(DISTINCT c) FILTER (c <> 2) AS unexpected_columns, count(*) FILTER (c = 2 AND approved) AS approved_cells_touched, any_value(n.n) AS rows_compared, false AS ok FROM diff, n UNION ALL SELECT 'clean', 0, 0, n, true FROM n"
)
def verify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy with changes anywhere, and one where only cells of the summary column that nobody approved differ."""
    before = _cells(spark, sf_dir, False)
    clean = before.withColumn("text", F.when((F.col("c") == 2) & ~F.col("approved"), F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    n = before.agg(F.max("r")).first()[0]
    both = [grid.verification(d, 2, n).withColumn("copy", F.lit(name)) for name, d in (("changed", _diff(spark, sf_dir)), ("clean", grid.differences(before, clean)))]
    return both[0].unionByName(both[1]).select("copy", "unexpected_columns", "approved_cells_touched", F.col("rows_compared").cast("long").alias("rows_compared"), "ok")


@query(f"WITH {DIFF_SQL} SELECT r, left(before, 60) AS before, left(after, 160) AS after FROM diff WHERE c = 2 ORDER BY r LIMIT 6")
def diff_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.samples(_diff(spark, sf_dir), 2)


@query("SELECT c_custkey AS row, c_custkey % 3 = 0 OR c_custkey % 4 = 0 AS approved, (c_custkey % 3 = 0 OR c_custkey % 4 = 0) AND c_custkey % 5 <> 0 AS counted FROM customer")
def approved_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells coloured whole or in a run; a blank one is approved as a cell but not counted as a row."""
    k = F.col("c_custkey")
    runs = F.array(F.struct(F.lit("a").alias("text"), F.lit(None).cast("string").alias("argb")), F.struct(F.lit("b").alias("text"), F.when(k % 4 == 0, grid.APPROVED).otherwise("FF000000").alias("argb")))
    cell = grid.approved(F.when(k % 3 == 0, F.lit(grid.APPROVED)), runs)
    text = F.when(k % 5 == 0, " \n").otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").select(k.alias("row"), cell.alias("approved"), (cell & (T.trim_all(text) != "")).alias("counted"))


@query(
    "SELECT c_custkey AS row, CASE WHEN c_custkey < 2 OR c_custkey > 1200 THEN 'missingRow' WHEN c_custkey % 6 = 0 THEN 'skippedApproved' WHEN c_acctbal >= 0 AND c_custkey % 4 <> 0 THEN 'written' ELSE 'flagged' END AS action FROM customer"
)
def write_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    items = c.select(F.col("c_custkey").alias("row"), F.when(F.col("c_acctbal") >= 0, "writeable").otherwise("needs_review").alias("status"), F.when(F.col("c_custkey") % 4 == 0, " \n ").otherwise(F.col("c_name")).alias("summary"))
    cells = c.select(F.col("c_custkey").alias("row"), (F.col("c_custkey") % 6 == 0).alias("approved"))
    return grid.write_actions(items, cells, 1200).select("row", "action")


@query("SELECT i, CASE WHEN i <= 26 THEN chr(cast(64 + i AS int)) WHEN i <= 702 THEN chr(cast(65 + (i - 27) // 26 AS int)) || chr(cast(65 + (i - 27) % 26 AS int)) ELSE chr(cast(65 + (i - 703) // 676 AS int)) || chr(cast(65 + ((i - 703) // 26) % 26 AS int)) || chr(cast(65 + (i - 703) % 26 AS int)) END AS letter FROM (SELECT 1 + o_orderkey % 18278 AS i FROM orders)")
def column_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = 1 + F.col("o_orderkey") % 18278
    return read(spark, sf_dir, "orders").select(i.alias("i"), T.column_letter(i.cast("int")).alias("letter"))


# --- structured answers ---------------------------------------------------------------------------------------------
BAD_SQL = "(event_id % 4 = 1 OR event_id % 5 = 0 OR event_id % 6 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0)"


@query(f"SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Não identificado' WHEN event_id % 4 = 1 THEN NULL ELSE 'Judge ' || user_id END AS judge, NOT {BAD_SQL} AS valid, CASE WHEN NOT {BAD_SQL} THEN 'medium' END AS confidence FROM events")
def json_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with an absent, null or given judge; wrong outcomes, no claims, and claims with a null or a number where a
    text must be."""
    e = F.col("event_id")
    judge = F.when(e % 4 == 0, "").when(e % 4 == 1, '"judge": null, ').otherwise(F.concat(F.lit('"judge": "Judge '), F.col("user_id").cast("string"), F.lit('", ')))
    outcome = F.when(e % 5 == 0, "won").otherwise("dismissed")
    claim = F.concat(F.lit('[{"rawClaim": '), F.when(e % 7 == 0, "7").otherwise('"r"'), F.lit(', "canonicalClaim": "c", "outcome": "moot"'), F.when(e % 11 == 0, ', "notes": null').otherwise(""), F.lit("}]"))
    claims = F.when(e % 6 == 0, "[]").otherwise(claim)
    text = F.concat(F.lit("{"), judge, F.lit('"outcome": "'), outcome, F.lit('", "claims": '), claims, F.lit("}"))
    v = structured.validated(read(spark, sf_dir, "events").select("event_id", text.alias("text")))
    return v.select("event_id", structured.field(F.col("text"), "judge", "Não identificado")[0].alias("judge"), "valid", F.get(F.col("result.claims"), F.lit(0))["confidence"].alias("confidence"))


REASONS_SQL = {
    "$.outcome: missing": "event_id % 5 = 1", "$.outcome: not one of upheld, partly_upheld, dismissed, terminated, not_identified": "event_id % 5 = 0", "$.judge: null": "event_id % 4 = 1", "$.judge: not a text": "event_id % 4 = 2",
    "$.claims: missing": "event_id % 9 = 0", "$.claims: no entries": "event_id % 9 = 1", "$.claims: not a list": "event_id % 9 = 2", "$.claims: null": "event_id % 9 = 3",
    "$.claims[0].rawClaim: empty": "event_id % 9 > 3 AND event_id % 3 = 0", "$.claims[1].canonicalClaim: missing": "event_id % 9 > 3", "$.claims[1].confidence: not one of high, medium, low": "event_id % 9 > 3 AND event_id % 7 = 0",
}


@query(
    "SELECT event_id, array_to_string(CASE WHEN event_id % 13 = 0 THEN ['$: not JSON'] WHEN event_id % 17 = 0 THEN ['$: not an object'] ELSE list_filter(["
    + ", ".join(f"CASE WHEN {where} THEN '{reason}' END" for reason, where in REASONS_SQL.items())
    + "], lambda r: r IS NOT NULL) END, '; ') AS reasons FROM events"
)
def json_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where and why answers break the contract: no JSON, no object, fields that are missing, null or of another type,
    lists that are none, and claims in which several fields are wrong."""
    e = F.col("event_id")
    outcome = F.when(e % 5 == 0, '"outcome": "won", ').when(e % 5 == 1, "").otherwise('"outcome": "upheld", ')
    judge = F.when(e % 4 == 1, '"judge": null, ').when(e % 4 == 2, '"judge": {"name": "J"}, ').otherwise("")
    first = F.concat(F.lit('{"rawClaim": "'), F.when(e % 3 == 0, "").otherwise("r"), F.lit('", "canonicalClaim": "c", "outcome": "moot"}'))
    second = F.concat(F.lit('{"rawClaim": "r", "outcome": "upheld"'), F.when(e % 7 == 0, ', "confidence": "sure"').otherwise(""), F.lit("}"))
    m = e % 9
    claims = F.when(m == 0, "").when(m == 1, '"claims": [], ').when(m == 2, '"claims": 7, ').when(m == 3, '"claims": null, ').otherwise(F.concat(F.lit('"claims": ['), first, F.lit(", "), second, F.lit("], ")))
    text = F.when(e % 13 == 0, "{").when(e % 17 == 0, "[1]").otherwise(F.concat(F.lit("{"), outcome, judge, claims, F.lit('"other": 1}')))
    v = structured.validated(read(spark, sf_dir, "events").select("event_id", text.alias("text")))
    return v.select("event_id", F.array_join("reasons", "; ").alias("reasons"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type || chr(10) || user_id WHEN event_id % 3 = 1 THEN event_type ELSE '' END AS text FROM events")
def text_of_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text blocks of answers with two, one or none, among blocks of another type."""
    m = F.col("event_id") % 3
    block = lambda kind, t: F.struct(F.lit(kind).alias("type"), t.alias("text"))
    first, second = block("text", F.col("event_type")), block("text", F.col("user_id").cast("string"))
    other = block("thinking", F.lit("hidden"))
    blocks = F.when(m == 0, F.array(first, other, second)).when(m == 1, F.array(other, first)).otherwise(F.array(other))
    return read(spark, sf_dir, "events").select("event_id", structured.text_of_blocks(blocks).alias("text"))


# --- rows that reports list ------------------------------------------------------------------------------------------
@query("SELECT conv_id, turn FROM conversations WHERE turn % 3 <> 1 AND regexp_matches(text, '[^ \t\n\r]')")
def non_blank_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("turn") % 3 == 1, " \n\u00a0").otherwise(F.col("text"))
    return state.non_blank(read(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text"))).select("conv_id", "turn")


@query(f"WITH {AUDIT_SQL} SELECT case_number FROM aud WHERE status = 'writeable' AND case_number % 4 <> 0")
def delivered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _audited(spark, sf_dir).withColumn("summary", F.when(F.col("case_number") % 4 == 0, " \n").otherwise("JULGADO EXTINTO"))
    return evaluate.delivered(records).select("case_number")


@query(f"WITH {AUDIT_SQL} SELECT case_number, CASE WHEN audit_reason IS NOT NULL THEN 'audit' ELSE coalesce(gate_reason, 'unknown') END AS reason, coalesce(audit_reason, gate_reason, 'unknown') AS why FROM aud WHERE status <> 'writeable'")
def refused_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.refused(_audited(spark, sf_dir)).select("case_number", "reason", "why")


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'unpriced' ELSE 'US$ ' || printf('%.4f', p_size / 50.0::double) END || ' · in ' || p_partkey || ' / out ' || p_size || CASE WHEN p_size % 3 = 0 THEN '' ELSE ' (cache hit ' || p_size % 3 || ')' END AS usage, CASE WHEN p_size % 7 = 0 THEN 'n/a' ELSE printf('%.1f', p_size / 2.0::double) || '%' END AS rate FROM part")
def format_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    usage = cost.format_usage(F.when(n % 5 != 0, n / 50.0), F.col("p_partkey"), n, n % 3)
    return read(spark, sf_dir, "part").select("p_partkey", usage.alias("usage"), cost.format_rate(F.when(n % 7 != 0, n / 2.0)).alias("rate"))


@query("SELECT k AS case_number, max(v) AS version, arg_max(text, v) AS text FROM (SELECT o_custkey AS k, 1 AS v, min(o_orderpriority) AS text FROM orders GROUP BY 1 UNION ALL SELECT o_custkey, 2, max(o_orderpriority) FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) GROUP BY k")
def upserted_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second version of some cases over a first of all."""
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "case_number")
    first = o.groupBy("case_number").agg(F.min("o_orderpriority").alias("text")).withColumn("version", F.lit(1))
    second = o.where("o_orderstatus = 'F'").groupBy("case_number").agg(F.max("o_orderpriority").alias("text")).withColumn("version", F.lit(2))
    return state.latest(first.unionByName(second), ["case_number"], ["version"]).select("case_number", "version", "text")


@query(f"WITH {FILES_SQL}, hit AS (SELECT id, arg_min(case_number, ord) AS c FROM runs JOIN cases USING (d) GROUP BY id), att AS (SELECT coalesce(kp, kn, c) AS c FROM own LEFT JOIN hit USING (id)), gold AS (SELECT case_number, ord FROM cases WHERE case_number IN (SELECT c FROM att)) SELECT case_number, CASE WHEN ord % 4 = 0 THEN 'error' ELSE 'judged' END AS outcome FROM gold")
def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved cases that have a document (before any sample is drawn), with those whose summary could not be made."""
    cases = _cases(spark, sf_dir)
    docs = attribution.attribute(_files(spark, sf_dir), cases)
    gold = evaluate.measurable(cases, docs)
    made = gold.select("case_number", F.when(F.col("ord") % 4 == 0, " ").otherwise("JULGADO EXTINTO").alias("summary"))
    pairs = evaluate.pairs(gold.withColumn("existing", F.lit("JULGADO EXTINTO")), made).select("case_number", F.lit("judged").alias("outcome"))
    return gold.select("case_number").join(pairs, "case_number", "left").select("case_number", F.coalesce("outcome", F.lit("error")).alias("outcome"))


@query(f"WITH {FILES_SQL}, u AS (SELECT case_number, row_number() OVER (ORDER BY case_number) AS k, count(*) OVER () AS n FROM cases WHERE d NOT IN (SELECT d FROM runs)) SELECT case_number, n - 40 AS more FROM u WHERE k <= 40")
def uncovered_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a coverage report names of the cases without a document, and how many more there are."""
    missing = attribution.covered(_files(spark, sf_dir), _cases(spark, sf_dir)).where("not by_digits").select("case_number")
    return state.capped(missing, [F.col("case_number")], 40)


@query(f"WITH {PLAN_SQL}, c AS (SELECT case_number, count(d.doc_id) FILTER (length(d.text) >= 200) AS n FROM plan LEFT JOIN documents d ON d.doc_id = plan.id GROUP BY 1) SELECT CASE WHEN n > 0 THEN 'extracted' ELSE 'no_source' END AS outcome, count(*) AS n FROM c GROUP BY 1")
def extract_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each case when its documents are read: scans have no text."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    used = _plan(spark, sf_dir).join(texts, "id", "left").groupBy("case_number").agg(F.count_if(F.length("text") >= 200).alias("n"))
    return state.outcome_counts(used.select(F.when(F.col("n") > 0, "extracted").otherwise("no_source").alias("outcome")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files attributed to cases, planned and counted: how each case will be read."""
    return plan_strategy_hist(spark, sf_dir)
