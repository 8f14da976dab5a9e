"""Document identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(path: Column, length: Column) -> Column:
    """Stable id of a file: the same file gets the same id on every retry."""
    return F.sha2(F.concat_ws("|", path, length.cast("string")), 256)


def visit_id(mrn: Column, visit_date: Column) -> Column:
    """``mrn_visitdate``; a missing part is written as the word ``None``."""
    missing = F.lit("None")
    return F.concat_ws(
        "_",
        F.coalesce(mrn.cast("string"), missing),
        F.coalesce(visit_date.cast("string"), missing),
    )
