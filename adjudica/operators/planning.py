"""What to read of each case: the two largest of each decisive kind, else the largest generic, else the largest of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.text import SPACE, trim_all
from adjudica.plans.policy import LEGAL, Kinds

# What reports call the kinds.
KIND_LABELS = {"judgment": "sentença", "appellate_ruling": "acórdão", "settlement": "acordo/homologação", "order": "despacho", "certificate": "certidão", "writ": "mandado", "opinion": "voto", "generic": "peça", "not_pdf": "não-PDF"}
NONE, WEAK, GENERIC, NAMED = "none", "weak", "generic", "named_decisions"


def document_kind(name: Column, kinds: Kinds = LEGAL.kinds) -> Column:
    """The kind by name: the first pattern that matches; order is part of the meaning."""
    upper = F.upper(name)
    out = F.when(~F.rlike(upper, F.lit(kinds.must_match)), "not_pdf")
    for kind, pattern in kinds.patterns:
        out = out.when(F.rlike(upper, F.lit(pattern.replace(r"\s", SPACE))), kind)
    return out.otherwise("generic")


def kind_label(kind: Column) -> Column:
    """What reports call a kind; an unknown kind is its own label."""
    pairs = [F.lit(x) for pair in KIND_LABELS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), kind)


def reading_plan(docs: DataFrame, cases: DataFrame, kinds: Kinds = LEGAL.kinds, tie: str = "id") -> DataFrame:
    """One row per case and chosen document: case_number, strategy, pos (order of reading), id, kind, bytes.

    docs(case_number, id, kind, bytes). Cases without usable documents keep one row with strategy none.
    """
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(kinds.decisive)], F.lit(len(kinds.decisive)))
    usable = docs.where("kind <> 'not_pdf'").withColumn("kind_rank", rank)
    usable = usable.withColumn("tier", F.when(F.col("kind_rank") < len(kinds.decisive), 1).when(F.col("kind") == "generic", 2).otherwise(3))
    # top files per kind first: Spark limits each group before the shuffle, so a case with very many files is no one task
    group = F.when(F.col("tier") == 1, F.col("kind_rank")).otherwise(-F.col("tier"))
    usable = usable.withColumn("group", group)
    top = Window.partitionBy("case_number", "group").orderBy(F.col("bytes").desc(), tie)
    usable = usable.withColumn("rn", F.row_number().over(top)).where(F.col("rn") <= max(1, kinds.per_kind))
    by_case = Window.partitionBy("case_number")
    usable = usable.withColumn("best", F.min("tier").over(by_case)).where("tier = best and (rn = 1 or tier = 1)")
    usable = usable.withColumn("pos", F.row_number().over(by_case.orderBy("kind_rank", "rn")))
    strategy = F.when(F.col("tier") == 1, NAMED).when(F.col("tier") == 2, GENERIC).when(F.col("tier") == 3, WEAK).otherwise(NONE)
    picked = usable.select("case_number", "tier", "pos", "id", "kind", "bytes")
    return cases.select("case_number").distinct().join(picked, "case_number", "left").select("case_number", strategy.alias("strategy"), "pos", "id", "kind", "bytes")


def strategies(plan: DataFrame) -> DataFrame:
    """Number of cases per strategy."""
    return plan.groupBy("strategy").agg(F.countDistinct("case_number").alias("cases"))


def skip_reason(size: Column, scanned: Column, max_mb: int = LEGAL.max_document_mb) -> Column:
    """Why a document is not read: too large, or a scan; null where it is read."""
    return F.when(size > max_mb * 1024 * 1024, "too_large").when(scanned, "scanned")


def is_scan(text: Column, pages: Column) -> Column:
    """Fewer than 60 characters a page, or fewer than 200 in all without white space of any kind at the ends."""
    n = F.length(trim_all(text))
    return (F.try_divide(F.length(text), F.greatest(pages, F.lit(1))) < 60) | (n < 200)


def case_text(parts: DataFrame, by: str = "case_number") -> DataFrame:
    """Texts of a case joined in order: parts(by, pos, kind, name, text); blank ones are left out."""
    some = parts.where(F.length(F.regexp_replace("text", SPACE, "")) > 0)
    head = F.concat(F.lit("===== "), F.upper("kind"), F.lit(": "), F.col("name"), F.lit(" =====\n"), F.col("text"))
    listed = some.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("pos", head.alias("t")))).alias("l"), F.count("*").alias("used"))
    return listed.select(by, "used", F.array_join(F.transform("l", lambda x: x["t"]), "\n\n").alias("text"))


def used_and_skipped(parts: DataFrame, by: str = "case_number") -> DataFrame:
    """Per case the names that were read and those that were not with the reason, in order: parts(by, pos, name, why)."""

    def listed(some: Column, value: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(some, F.struct("pos", value.alias("v"))))), lambda x: x["v"])

    read = F.col("name").isNotNull() & F.col("why").isNull()
    return parts.groupBy(by).agg(listed(read, F.col("name")).alias("documents"), listed(F.col("why").isNotNull(), F.struct("name", "why")).alias("skipped"))
