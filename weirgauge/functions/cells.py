"""Judging one raw cell that should hold a number."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PROBLEMS

INFINITY = float("inf")
#: Columns or names that are tested one by one.
FEW = 8


def ref(name: str) -> Column:
    """Column by exact name, whatever blanks or dots the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_number(cell: Column) -> Column:
    """Cast that yields NULL instead of failing, also with ANSI mode on."""
    return cell.try_cast("double")


def cell_problem(cell: Column) -> Column:
    """Name of the one problem a cell has, NULL for a finite number.

    The five problems exclude each other, so one CASE decides all of them.  The
    common case, a good cell, is decided first and parses its text once.
    """
    number = as_number(cell)
    tests = {
        "missing": cell.isNull() | (F.trim(cell.cast("string")) == ""),
        "invalid_cast": number.isNull(),
        "nan": F.isnan(number),
        "positive_inf": number == INFINITY,
        "negative_inf": number == -INFINITY,
    }
    verdict = F.when(is_finite_cell(cell), F.lit(None).cast("string"))
    for name in PROBLEMS:
        verdict = verdict.when(tests[name], F.lit(name))
    return verdict


def is_finite_cell(cell: Column) -> Column:
    """True exactly when ``cell_problem`` is NULL, in one comparison.

    NaN orders above every number in Spark, so NaN, both infinities, NULL,
    blanks and text all fail the same test; this keeps a filter over dozens of
    columns short enough for the optimizer.
    """
    return F.coalesce(F.abs(as_number(cell)) < INFINITY, F.lit(False))


def all_finite(names) -> Column:
    """Every one of the columns holds a finite number.

    A FEW are compared one by one, in code that Spark generates for the whole
    step.  More are tested as one array: dozens of comparisons one by one would
    make the generated code too long for the JVM to compile.
    """
    cells = [as_number(ref(n)) for n in names]
    if len(cells) <= FEW:
        return F.coalesce(reduce(and_, (F.abs(c) < INFINITY for c in cells), F.lit(True)), F.lit(False))
    numbers = F.array(*cells).cast("array<double>")
    return F.coalesce(F.forall(numbers, lambda n: F.abs(n) < INFINITY), F.lit(False))


def settle(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a computed column that later filters use as it is.

    A filter on an ordinary computed column is moved below the projection, which
    evaluates the expression again there and lets the optimizer derive a new
    constraint for every combination of the columns it mentions: hopeless for a
    verdict over dozens of columns.  Filters do not move below a generator, so
    the value is taken out of an array of one.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def ratio(part: Column, whole: Column) -> Column:
    """Share that is 0.0 where the whole is zero or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
