"""Label text: tidying, dictionary checks, binary target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import CRITICAL_RATE, NORMAL_LIKE, WARNING_RATE, FlowContract
from .cells import ref


def tidy_label(label: Column) -> Column:
    return F.upper(F.trim(label.cast("string")))


def label_is_known(contract: FlowContract) -> Column:
    """NULL, blank and unlisted labels are unknown, never silently an attack.

    The dictionary is a contract constant of a few dozen names, so it is an
    IN-list inside the plan and not a join.
    """
    tidy = tidy_label(ref(contract.label))
    return F.coalesce(tidy.isin(list(contract.dictionary)), F.lit(False))


def binary_target(contract: FlowContract) -> Column:
    tidy = tidy_label(ref(contract.label))
    return (
        F.when(tidy == contract.normal, 0.0)
        .when(tidy.isin(list(contract.attacks)), 1.0)
        .cast("double")
    )


def fold_label(label: Column) -> Column:
    """Lower case letters and digits only, for comparing label spellings."""
    return F.regexp_replace(F.lower(label), "[^a-z0-9]", "")


def is_normal_like(label: Column) -> Column:
    return F.coalesce(fold_label(label).isin(list(NORMAL_LIKE)), F.lit(False))


def status_band(rate: Column) -> Column:
    """Traffic status of a window; a missing rate counts as Critical."""
    return (
        F.when(rate < WARNING_RATE, "Normal")
        .when(rate < CRITICAL_RATE, "Warning")
        .otherwise("Critical")
    )


def class_name(prediction: Column) -> Column:
    """Display name of a binary prediction; any other value fails the job."""
    complaint = F.concat(
        F.lit("not a binary prediction: "), F.coalesce(prediction.cast("string"), F.lit("NULL"))
    )
    return (
        F.when(prediction == 0.0, "Normal")
        .when(prediction == 1.0, "Attack")
        .otherwise(F.raise_error(complaint))
    )
