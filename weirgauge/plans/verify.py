"""Verification jobs: reports about a flow table that fail when a rule is broken."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ContractError, FlowContract, require_columns
from ..functions.cells import ref
from ..operators import clean, examples, profile, quality


def verify_cleaning(raw: DataFrame, contract: FlowContract) -> dict:
    """Clean a table and check what must hold afterwards; returns the counts."""
    require_columns(raw, contract.columns)
    cleaned = clean.clean(raw, contract, labelled=True, vector=False)
    known = raw.where(F.upper(F.trim(ref(contract.label))).isin(list(contract.dictionary)))
    bare = clean.clean(known, contract, labelled=False, vector=False)
    report = quality.clean_report(cleaned, bare, contract).first().asDict()
    broken = sorted(k for k, v in report.items() if v is False)
    if broken:
        raise ContractError("after cleaning: " + ", ".join(broken))
    if not report["rows"]:
        raise ContractError("no row is left after cleaning")
    return report


def verify_labels(raw: DataFrame, contract: FlowContract) -> dict:
    """Every label that occurs is listed; returns the labels that are listed only."""
    listed = raw.sparkSession.createDataFrame([(n,) for n in contract.dictionary], "label string")
    # Distinct labels: those that are not listed are an error as soon as there is one.
    sides = examples.dictionary_coverage(raw, contract.label, listed)
    strange = sides.where("side = 'seen_not_listed'").orderBy(F.desc("rows"), "label").limit(10).collect()
    if strange:
        raise ContractError("labels not listed: " + ", ".join(f"{r.label} ({r.rows})" for r in strange))
    return {"unseen": sorted(r.label for r in sides.collect())}


def verify_splits(rows: DataFrame, key: str, split: str) -> dict:
    """No key lies in two splits; returns how many pairs of splits were compared."""
    pairs = examples.leakage_report(rows, key, split).collect()
    shared = [f"{r.left_split}/{r.right_split}: {r.shared_keys}" for r in pairs if r.shared_keys]
    if shared:
        raise ContractError("keys in several splits: " + ", ".join(shared))
    return {"pairs": len(pairs)}


def profile_job(raw: DataFrame, contract: FlowContract) -> DataFrame:
    """One row per column: nulls, distinct estimate, and how the contract sees it.

    A table without the contract's columns, or without rows, is an error.
    """
    require_columns(raw, contract.columns)
    found = profile.distinct_estimates(raw, contract.columns)
    kind = F.when(F.col("column_name") == contract.label, "label").when(
        F.col("column_name").isin(list(contract.features)), "feature"
    )
    if not found.agg(F.max("rows")).first()[0]:
        raise ContractError("the table has no rows")
    return found.withColumn("role", F.coalesce(kind, F.lit("other")))
