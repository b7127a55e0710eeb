"""Checks on column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rescuelens import lexicons as lx


def clean_names(names: Iterable[str]) -> list[str]:
    """Names without surrounding white space and byte-order mark."""
    return [n.strip().lstrip("﻿").strip() for n in names]


def require(names: Iterable[str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValueError(f"Missing columns: {missing}")


def present(names: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """Wanted columns that exist, in the wanted order."""
    names = set(names)
    return [c for c in wanted if c in names]


def text_column(df: DataFrame, name: str | None = None) -> str:
    """The text column: the named one, else a well-known name, else the first string."""
    if name and name in df.columns:
        return name
    for c in df.columns:
        if c.lower() in lx.TEXT_COLUMN_NAMES:
            return c
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            return f.name
    raise ValueError("no text column found; name one")
