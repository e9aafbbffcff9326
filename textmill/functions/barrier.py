"""Evaluate an expensive expression exactly once.

Catalyst freely substitutes a projected expression wherever its alias is
used: a later ``filter(length(text) >= 50)`` is pushed below the projection
with the whole cleaner inlined (so the cleaner runs twice), and a column
used inside a lambda is re-evaluated per array element.  Neither rule has a
cost check.  Emitting the value through a one-element ``explode_outer``
creates a ``Generate`` node: predicates on its output cannot be pushed below
it and later projections cannot inline it, so the expression runs once per
row.  (``explode_outer`` does not trigger the inferred ``size(...) > 0``
filter that a plain ``explode`` adds.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df.withColumn(name, expr)`` with ``expr`` computed once per row and
    shielded from predicate push-down and projection inlining."""
    cols = [F.col(f"`{c}`") for c in df.columns if c != name]
    out = df.select(*cols, F.explode_outer(F.array(expr)).alias(name))
    order = list(df.columns) + ([] if name in df.columns else [name])
    return out.select(*[F.col(f"`{c}`") for c in order])
