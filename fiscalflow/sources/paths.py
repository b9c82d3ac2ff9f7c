"""Spark's file URIs and plain paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_path(p: str) -> str:
    """Plain path of a Spark file URI (``file:/a`` / ``file:///a`` -> ``/a``)."""
    if p.startswith("file:"):
        p = p[5:]
        while p.startswith("//"):
            p = p[1:]
    return p


def plain_path(uri: Column) -> Column:
    """Plain path of a scan's ``_metadata.file_path``: ``%XX`` decoded (a plus sign stands for itself)."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), r"^file:/*", "/")
