"""Choosing the public record (F)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class SelectionConfig:
    cutoff_year: int = 2005
    historic: str = "historic"
    primary: str = "primary"
    secondary: str = "secondary"
    unmatched_secondary: bool = True
    exclude_ambiguous: bool = True


def secondary_reason(status: Column, cfg: SelectionConfig) -> Column:
    """why a secondary provider's poll is not public; null if it is."""
    out = F.when(status == "no_match", F.lit(None) if cfg.unmatched_secondary else F.lit("unmatched_secondary_disabled"))
    out = out.when(status == "multiple_matches", F.lit("ambiguous_secondary_match") if cfg.exclude_ambiguous else F.lit(None))
    return out.when(status == "matched", "matched_secondary_provider").otherwise("secondary_match_not_resolved")


def select_public(polls: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """adds is_public and reason by provider priority and year."""
    name = F.lower(F.trim("provider"))
    before = F.year("publish_date") < cfg.cutoff_year
    reason = (
        F.when(F.col("publish_date").isNull(), "missing_publish_date").when(F.coalesce(name, F.lit("")) == "", "missing_provider")
        .when(before, F.when(name != cfg.historic.lower(), "non_primary_provider_before_cutoff")).when(name == cfg.primary.lower(), F.lit(None))
        .when(name == cfg.secondary.lower(), secondary_reason(F.coalesce("status", F.lit("")), cfg)).otherwise("non_public_provider_after_cutoff")
    )
    return polls.withColumn("reason", reason).withColumn("is_public", F.col("reason").isNull())


def selection_counts(selected: DataFrame) -> DataFrame:
    """polls by reason, public ones as ``public``."""
    return selected.groupBy(F.coalesce("reason", F.lit("public")).alias("reason")).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class GatePolicy:
    require_validation: bool = True
    include_valid: bool = True
    include_warnings: bool = True
    required_checks: tuple[str, ...] = ()
    cutoff_year: int = 2005
    historic: str = "historic"


def serving_gate(polls: DataFrame, validations: DataFrame, policy: GatePolicy) -> DataFrame:
    """public polls that are valid, or of the historic provider before the cutoff year (prevalidated).

    Without require_validation polls that were never validated pass too.  With
    include_valid=False only invalid ones do.  Polls with warnings, and those that fail a
    required check, go if the policy says so, prevalidated ones excepted.
    """
    v = validations.withColumnRenamed("poll_id", "__poll")
    rows = polls.join(v, polls["id"] == v["__poll"], "left")
    early = F.coalesce((F.lower("provider") == policy.historic.lower()) & (F.year("publish_date") < policy.cutoff_year), F.lit(False))
    true = lambda c: F.coalesce(c, F.lit(False))
    if policy.include_valid:
        ok = early | true(F.col("valid")) | (F.lit(False) if policy.require_validation else F.col("__poll").isNull())
    else:
        ok = true(~F.col("valid"))
    if not policy.include_warnings:
        ok = ok & (early | true(F.col("warning_count") == 0))
    for c in policy.required_checks:
        ok = ok & (early | true(F.col(c)))
    return rows.filter(F.col("is_public") & ok).select(*polls.columns)
