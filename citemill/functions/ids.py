"""Repeatable ids: the same name always gives the same id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Ids are the first hex digits of an MD5 digest.
ID_HEX_DIGITS = 16
POINT_ID_HEX_DIGITS = 15


def name_id(name: Column) -> Column:
    """Document id from a name (source, file name or full path)."""
    return F.substring(F.md5(F.encode(name, "UTF-8")), 1, ID_HEX_DIGITS)


def chunk_id(doc_id: Column, index: Column) -> Column:
    return name_id(F.concat_ws("-", doc_id.cast("string"), index.cast("string")))


def point_id(chunk: Column) -> Column:
    """Integer id of a vector, taken from its chunk id, so a rerun gives the same."""
    return F.conv(F.substring(chunk, 1, POINT_ID_HEX_DIGITS), 16, 10).cast("bigint")
