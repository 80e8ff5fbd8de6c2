"""Bad records: kept beside the result as ``(source, stage, reason)``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import settle_counted

REASON = "__reason"
_OUTCOME = "__outcome"


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the first broken rule; a rule is true for good rows, NULL counts as broken."""
    reason = F.lit(None).cast("string")
    for text, rule in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(rule, F.lit(False)), F.lit(text)).otherwise(reason)
    return df.withColumn(REASON, reason)


def good(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def quarantine(checked: DataFrame, stage: str, source: str = "source") -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull()).select(
        F.col(source).cast("string").alias("source"), F.lit(stage).alias("stage"), F.col(REASON).alias("reason")
    )


def unit_errors(errors: DataFrame) -> DataFrame:
    """One error row per file or sheet: a bad row spoils its whole unit."""
    return errors.groupBy("source", "stage").agg(F.min("reason").alias("reason"), F.count(F.lit(1)).alias("n_rows"))


def quarantine_units(checked: DataFrame, stage: str, source: str = "source") -> DataFrame:
    return unit_errors(quarantine(checked, stage, source))


@dataclass(frozen=True)
class Outcome:
    """Good rows, error rows ``(source, stage, reason)``, and how many there are of each."""

    good: DataFrame
    errors: DataFrame
    n_good: int
    n_bad: int


def tee(checked: DataFrame, stage: str, source: str = "source") -> Outcome:
    """Good and bad rows apart, after one pass over the input.

    One job writes both, in a folder per outcome, and counts them meanwhile; each side then reads its own folder only.
    """
    bad = F.col(REASON).isNotNull()
    written, seen = settle_counted(checked.withColumn(_OUTCOME, bad.cast("int")), (_OUTCOME,), n_bad=F.count(F.when(F.col(REASON).isNotNull(), 1)))
    return Outcome(
        written.filter(F.col(_OUTCOME) == 0).drop(REASON, _OUTCOME),
        quarantine(written.filter(F.col(_OUTCOME) == 1), stage, source),
        seen["n"] - seen["n_bad"],
        seen["n_bad"],
    )
