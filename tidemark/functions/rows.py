"""Rows that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def emit(df: DataFrame, columns: list[Column], when: Column | None = None) -> DataFrame:
    """``df.filter(when).select(columns)`` for columns that are costly and that ``when`` depends on.

    Spark copies a filter's expressions below the projection that computes them, so a filter on
    parsed text parses it again, once per mention. A generator is not passed by filters: columns
    and condition are computed once, whatever is filtered later.
    """
    row = F.array(F.struct(*columns))
    return df.select(F.inline(row if when is None else F.when(when, row)))
