"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: str) -> DataFrame:
    """Add SQL columns that are computed once per row.

    A generator over one row keeps the optimiser from copying the expressions into later filters and projections.
    """
    made = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.expr(f"named_struct({made})"))))
