"""Row-level data-quality rules.

A rule is a name plus a boolean Column that is TRUE when the row *fails*.
Tagging adds ``rejection_reason``: the names of the failed rules, in rule
order, joined by ``"; "``; the empty string means the row is clean.

SQL three-valued logic is part of the contract: a predicate that evaluates to
NULL (e.g. ``asset <= 0`` on a NULL asset) does not fail the row. Only
``cert`` and ``name`` are checked for NULL explicitly.

Tagging is a single projection (no shuffle); the clean / quarantine split is
two filters on it, so each split keeps the input's partitioning and the whole
stage stays inside one whole-stage-codegen span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierone import config as C

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def institution_rules() -> list[Rule]:
    return [
        Rule(C.RULE_CERT_IS_NULL, F.col("cert").isNull()),
        Rule(C.RULE_ASSET_NON_POSITIVE, F.col("asset") <= F.lit(0)),
        Rule(C.RULE_NAME_EMPTY, F.col("name").isNull() | (F.trim(F.col("name")) == F.lit(""))),
        Rule(C.RULE_ACTIVE_INVALID_VALUE, ~F.col("active").isin(*C.ACTIVE_VALUES)),
    ]


def financials_rules() -> list[Rule]:
    rbct1 = F.col("rbct1")
    return [
        Rule(C.RULE_CERT_IS_NULL, F.col("cert").isNull()),
        Rule(C.RULE_ASSET_NON_POSITIVE, F.col("asset") <= F.lit(0)),
        Rule(C.RULE_DEP_NON_POSITIVE, F.col("dep") <= F.lit(0)),
        # NaN compares above every number in Spark, so NaN is out of range.
        Rule(C.RULE_RBCT1_OUT_OF_RANGE,
             (rbct1 < F.lit(C.RBCT1_MIN)) | (rbct1 > F.lit(C.RBCT1_MAX))),
        Rule(C.RULE_REPDTE_INVALID_FORMAT, F.length(F.col("repdte")) != F.lit(C.REPDTE_LENGTH)),
    ]


def reason_expr(rules: list[Rule]) -> Column:
    # concat_ws skips NULLs, so rules that pass (NULL branch) leave no trace.
    return F.concat_ws(C.REASON_SEPARATOR, *[F.when(r.fails, F.lit(r.name)) for r in rules])


def failed_mask(rules: list[Rule]) -> Column:
    """The failed rules as bits, the first rule lowest; 0 = none."""
    return sum((F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)),
               F.lit(0)).cast("bigint")


def rule_counts(masks: DataFrame, names: list[str]) -> DataFrame:
    """``rule, with_rule, failures``: rows failing each rule (``with_rule`` NULL) and each pair of rules.

    ``masks`` has ``rule_mask`` and ``n_rows``, counted beforehand: at most one
    row for each combination of rules that occurs.
    """
    bits = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << i).alias("bit")) for i, n in enumerate(names)])
    failed = F.filter(bits, lambda b: F.col("rule_mask").bitwiseAND(b["bit"]) != 0)
    alone = F.transform("_failed", lambda a: F.struct(
        a["rule"].alias("rule"), F.lit(None).cast("string").alias("with_rule")))
    pairs = F.flatten(F.transform("_failed", lambda a: F.transform(
        F.filter("_failed", lambda b: b["bit"] > a["bit"]),
        lambda b: F.struct(a["rule"].alias("rule"), b["rule"].alias("with_rule")))))
    return (masks.select("n_rows", failed.alias("_failed"))
            .select("n_rows", F.explode(F.concat(alone, pairs)).alias("f"))
            .groupBy("f.rule", "f.with_rule").agg(F.sum("n_rows").alias("failures")))


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn(REASON, reason_expr(rules))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON) == F.lit("")).drop(REASON)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON) != F.lit(""))


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    tagged = tag(df, rules)
    return clean_rows(tagged), quarantined_rows(tagged)
