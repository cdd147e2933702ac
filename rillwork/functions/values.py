"""Null-safe copies and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def copy_block(present: Column, names: list[str]) -> list[Column]:
    """Copy ``names`` when ``present`` is not NULL, else leave the whole block NULL."""
    return [F.when(present.isNotNull(), F.col(n)).alias(n) for n in names]


def to_json_text(*cols: Column | str, pretty: bool = False) -> Column:
    return F.to_json(F.struct(*cols), {"pretty": "true"} if pretty else None)
