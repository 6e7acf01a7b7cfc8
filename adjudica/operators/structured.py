"""Structured answers: JSON checked against a declared contract with defaults; a missing field is not a null one.

The contract is compiled into expressions that gather the place and reason of every breach, in the contract's order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.plans.policy import NOT_IDENTIFIED

# fixed values: what the fields may hold
CASE_OUTCOMES = ("upheld", "partly_upheld", "dismissed", "terminated", "not_identified")
CLAIM_OUTCOMES = (*CASE_OUTCOMES, "moot")
APPEAL_OUTCOMES = ("allowed", "partly_allowed", "not_allowed", "not_entertained", "not_identified")
CONFIDENCE = ("high", "medium", "low")


@dataclass(frozen=True)
class Text:
    """A text field. Where it is required it must be there; null is a breach unless it is allowed; values, if any, are all
    that it may be."""

    default: str | None = None
    required: bool = False
    nullable: bool = False
    filled: bool = False  # not the empty text
    values: tuple[str, ...] = ()

    def reason(self, of: Column, name: str) -> Column:
        """Why the field breaks the contract, or null."""
        kind, text = _kind(of, name), _text(of, name)
        why = F.when(kind.isNull(), "missing" if self.required else None).when(kind == "VOID", None if self.nullable else "null").when(kind != "STRING", "not a text")
        if self.filled:
            why = why.when(F.length(text) == 0, "empty")
        if self.values:
            why = why.when(~text.isin(*self.values), f"not one of {', '.join(self.values)}")
        return why

    def value(self, of: Column, name: str) -> Column:
        return F.when(_kind(of, name).isNull(), F.lit(self.default)).otherwise(_text(of, name))


#: a claim's fields, and an answer's; an answer has a list of claims besides, with one at least
CLAIM = {
    "rawClaim": Text(required=True, filled=True), "canonicalClaim": Text(required=True, filled=True), "outcome": Text(required=True, values=CLAIM_OUTCOMES),
    "laterDecision": Text(""), "notes": Text(""), "confidence": Text("medium", values=CONFIDENCE),
}
ANSWER = {
    "caseNumber": Text(NOT_IDENTIFIED), "outcome": Text(required=True, values=CASE_OUTCOMES), "judge": Text(NOT_IDENTIFIED), "appealOutcome": Text(nullable=True, values=APPEAL_OUTCOMES),
    "reportingJudge": Text(NOT_IDENTIFIED), "summary": Text(""), "notes": Text(""),
}


def _kind(of: Column, name: str) -> Column:
    """STRING, VOID (an explicit null), another type, or null where the field is absent."""
    return F.schema_of_variant(F.try_variant_get(of, f"$.{name}", "variant"))


def _text(of: Column, name: str) -> Column:
    return F.when(_kind(of, name) == "STRING", F.try_variant_get(of, f"$.{name}", "string"))


def field(json: Column, name: str, default: str) -> tuple[Column, Column]:
    """(value, valid) of a text field with a default: absent gives the default, an explicit null is invalid."""
    v, rule = F.try_parse_json(json), Text(default)
    return rule.value(v, name), rule.reason(v, name).isNull()


def breaches(of: Column, contract: dict[str, Text], path: Column) -> Column:
    """Every breach of a contract by an object, as "path.field: reason"."""
    return F.array_compact(F.array(*[F.concat(path, F.lit(f".{name}: "), rule.reason(of, name)) for name, rule in contract.items()]))


def validated(df: DataFrame, json: str = "text") -> DataFrame:
    """df with result (null where invalid), valid, and reasons: the place and reason of every breach.

    Texts must be texts: a number, an object or a null where the contract has a text makes the answer invalid, in claims
    as well; only appealOutcome may be null. Unknown fields are dropped. What is no JSON, or no object, has that one
    breach.
    """
    d = df.withColumn("_v", F.try_parse_json(F.col(json)))
    v = F.col("_v")
    d = d.withColumn("_claims", F.try_variant_get(v, "$.claims", "array<variant>"))
    claims, kind = F.col("_claims"), _kind(v, "claims")
    listed = F.when(kind.isNull(), "missing").when(kind == "VOID", "null").when(claims.isNull(), "not a list").when(F.size(claims) == 0, "no entries")
    in_claims = F.flatten(F.transform(claims, lambda c, i: breaches(c, CLAIM, F.concat(F.lit("$.claims["), i.cast("string"), F.lit("]")))))
    all_ = F.concat(breaches(v, ANSWER, F.lit("$")), F.array_compact(F.array(F.concat(F.lit("$.claims: "), listed))), F.coalesce(in_claims, F.array().cast("array<string>")))
    whole = F.when(v.isNull(), F.array(F.lit("$: not JSON"))).when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.array(F.lit("$: not an object"))).otherwise(all_)
    d = d.withColumn("reasons", whole).withColumn("valid", F.size("reasons") == 0)

    def filled(c: Column) -> Column:
        names = {"rawClaim": "raw_claim", "canonicalClaim": "canonical_claim", "outcome": "outcome", "laterDecision": "later_decision", "notes": "notes", "confidence": "confidence"}
        return F.struct(*[CLAIM[k].value(c, k).alias(alias) for k, alias in names.items()])

    names = {"caseNumber": "case_number", "outcome": "outcome", "judge": "judge", "appealOutcome": "appeal_outcome", "reportingJudge": "reporting_judge", "summary": "summary", "notes": "notes"}
    result = F.struct(*[ANSWER[k].value(v, k).alias(alias) for k, alias in names.items()], F.transform(claims, filled).alias("claims"))
    return d.withColumn("result", F.when(F.col("valid"), result)).drop("_v", "_claims")


def text_of_blocks(blocks: Column) -> Column:
    """The text blocks of an answer, one per line."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), "\n")
