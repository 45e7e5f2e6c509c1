"""Change messages made from table rows: the full load of a table, and single changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import model as M


def envelope(
    op: str,
    owner: str,
    table: str,
    scn: Column,
    *,
    before: Column | None = None,
    after: Column | None = None,
    sql: Column | None = None,
    rid: Column | None = None,
    tms: Column | None = None,
    xid: Column | None = None,
) -> Column:
    """One change message as text; images are struct columns. Absent parts are left out."""
    parts = [
        F.lit(op).alias("op"),
        F.struct(F.lit(owner).alias("owner"), F.lit(table).alias("table")).alias("schema"),
        F.lit(1).alias("row"),
    ]
    for name, part in (("rid", rid), ("before", before), ("after", after), ("sql", sql)):
        if part is not None:
            parts.append(part.alias(name))
    top = [scn.alias("scn")]
    for name, part in (("tms", tms), ("xid", xid)):
        if part is not None:
            top.append(part.alias(name))
    payload = F.struct(*parts).alias("payload")
    return F.to_json(F.struct(*top, payload), {"ignoreNullFields": "false"})


def row_image(df: DataFrame, columns: Sequence[str] | None = None, **replaced: Column) -> Column:
    """A row as an image struct with upper-case names; ``replaced`` overrides columns by name."""
    names = columns or df.columns
    return F.struct(*[replaced.get(c, F.col(c)).alias(c.upper()) for c in names])


def full_load(
    df: DataFrame, owner: str, table: str, scn: Column, pos: Column, *, image: Column | None = None
) -> DataFrame:
    """Every row of a table as an insert message."""
    after = row_image(df) if image is None else image
    return df.select(
        envelope(M.INSERT, owner, table, scn, after=after).alias("value"), pos.alias("pos")
    )
