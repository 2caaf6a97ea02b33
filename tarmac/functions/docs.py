"""JSON-document and object-URI helpers (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_PATTERN = r"^s3://([^/]+)/(.*)$"


def split_object_uri(uri) -> tuple[Column, Column]:
    """``s3://bucket/key`` → (bucket, key); non-matching → ('', '')."""
    u = F.col(uri) if isinstance(uri, str) else uri
    return F.regexp_extract(u, URI_PATTERN, 1), F.regexp_extract(u, URI_PATTERN, 2)


def json_path_double(doc, path: str) -> Column:
    """Read a numeric JSON path (e.g. ``$.metrics.challenger_beats_champion.value``)."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.get_json_object(d, path).try_cast("double")
