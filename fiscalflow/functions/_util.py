from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def column(name: str) -> Column:
    """The column of exactly this name, whatever signs it holds (a dot is no path into a struct)."""
    return F.col("`" + name.replace("`", "``") + "`")
