"""Row constraints: a table of rules compiled into one projection that names every rule a row breaks.

Rows that break a rule go to ``quarantine.<table>`` with the names of the rules; the others go on. Rules are SQL
conditions that must be true: a condition that is NULL counts as broken unless the rule allows NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN = "_broken_rules"


@dataclass(frozen=True)
class Rule:
    """``holds``: SQL condition over the row's columns."""

    name: str
    holds: str
    allow_null: bool = False


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", f"{c} IS NOT NULL") for c in columns]


def filled(*columns: str) -> list[Rule]:
    """Not empty and not blank, if not NULL."""
    return [Rule(f"{c}_filled", f"length(trim({c})) > 0", True) for c in columns]


def no_delimiter(*columns: str) -> list[Rule]:
    """No comma and no space inside, as a list of codes in one field would have."""
    return [Rule(f"{c}_single", f"{c} NOT LIKE '%,%' AND {c} NOT LIKE '% %'", True) for c in columns]


ENCOUNTER_RULES = [*not_null("pat_id", "encounter_id"), *filled("pat_id", "encounter_id"), *no_delimiter("encounter_id"),
                   Rule("encounter_dttm_not_null", "encounter_dttm IS NOT NULL")]
CHARGE_RULES = [*not_null("encounter_id", "charge_id"), *filled("encounter_id", "charge_id", "cpt_code"),
                *no_delimiter("cpt_code"), Rule("cpt_code_length", "length(cpt_code) >= 4", True),
                Rule("amounts_not_negative", "least(billed_amt, allowed_amt, paid_amt) >= 0", True)]
CODE_RULES = [*not_null("measure_id", "code_type", "code_value"), *filled("measure_id", "code_type", "code_value"),
              *no_delimiter("code_value")]


def broken_rules(rules: list[Rule]) -> Column:
    """The names of the rules that a row breaks, in the rules' order."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(r.holds), F.lit(r.allow_null)), F.lit(r.name)) for r in rules]))


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn(BROKEN, broken_rules(rules))


def quarantine(store, table: str, df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Append the rows of ``df`` that break a rule to ``quarantine.<table>``; returns those that break none.
    Each row is judged once: the judged rows are staged, and both parts are read from there."""
    judged = store.stage(f"judged_{table}", check(df, rules))
    store.append(f"quarantine.{table}", judged.where(F.size(BROKEN) > 0))
    return judged.where(F.size(BROKEN) == 0).drop(BROKEN)


def rule_report(kept: DataFrame, quarantined: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: how many rows broke it, and how many the table kept and lost in all."""
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("rows_broken")) for i, r in enumerate(rules)])
    hits = [F.count_if(F.array_contains(BROKEN, r.name)).alias(f"_r{i}") for i, r in enumerate(rules)]
    lost = quarantined.agg(F.count(F.lit(1)).alias("rows_quarantined"), *hits)
    # counts of both parts meet in one aggregate of two rows
    none = [F.lit(None).cast("bigint").alias(c) for c in lost.columns]
    counted = lost.withColumn("rows_kept", F.lit(None).cast("bigint")).unionByName(
        kept.agg(F.count(F.lit(1)).alias("rows_kept")).select(*none, "rows_kept"))
    one = counted.agg(*[F.max(c).alias(c) for c in counted.columns])
    return one.select(F.lit(table).alias("table_name"), F.inline(each), "rows_kept", "rows_quarantined")
