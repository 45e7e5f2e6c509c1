"""Row ids on change messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import model as M
from tidemark.functions import images


def add_row_ids(changes: DataFrame) -> DataFrame:
    """Put a content-hash id on the images each operation uses: after, before or both.

    Adds ``before_id`` and ``after_id``. Operation codes are matched without regard to case; other
    operations pass unchanged, as do stand-in rows for unreadable messages.
    """
    real = "not is_dummy and " if "is_dummy" in changes.columns else ""
    before, after = (M.UPDATE, M.DELETE), (M.INSERT, M.UPDATE)
    changes = images.add_row_id(changes, "before", f"{real}lower(op) in {before}")
    return images.add_row_id(changes, "after", f"{real}lower(op) in {after}")
