"""Which tables take part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import model as M


def source_topic(database: Column, owner: Column, table: Column) -> Column:
    """``<database>-<owner>-<table>`` in lower case."""
    return F.lower(F.concat_ws("-", database, owner, table))


def target_topic(database: Column, owner: Column, table: Column) -> Column:
    """The topic that the normalised changes of a table go to."""
    return F.concat_ws("-", F.lit(M.TARGET_PREFIX), source_topic(database, owner, table))


def table_name(prefix: str, database: Column, owner: Column, table: Column) -> Column:
    """``<prefix>_<database>_<owner>_<table>`` in lower case."""
    return F.lower(F.concat_ws("_", F.lit(prefix), database, owner, table))


def allowed(df: DataFrame, name: str, names: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows whose ``name`` column is on a list, letter case aside. No list, or an empty one, allows all.

    The list may be a one-column frame. Spark broadcasts it when its measured size allows and
    shuffles otherwise. An empty frame allows nothing: whether it is empty is only known at run time.
    """
    if names is None:
        return df
    if isinstance(names, DataFrame):
        listed = names.select(F.lower(names.columns[0]).alias("_listed"))
        return df.join(listed, F.lower(df[name]) == listed["_listed"], "left_semi")
    if not names:
        return df
    return df.filter(F.lower(name).isin(*sorted({n.lower() for n in names})))


def allowed_topics(
    df: DataFrame, topic: str, database: str, owner_tables: dict[str, Sequence[str]] | None
) -> DataFrame:
    """Messages of the listed topics. Every owner has its own list; an empty one allows all of that owner.

    No owner with a list allows all.
    """
    if not owner_tables or not any(owner_tables.values()):
        return df
    topics = {
        f"{database}-{owner}-{table}".lower()
        for owner, tables in owner_tables.items()
        for table in tables
    }
    allowed_here = F.col(topic).isin(*sorted(topics))
    for owner in sorted(o for o, tables in owner_tables.items() if not tables):
        allowed_here = allowed_here | F.startswith(F.col(topic), F.lit(f"{database}-{owner}-".lower()))
    return df.filter(allowed_here)
