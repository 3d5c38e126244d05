"""Columns by their literal name, whatever characters it has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of this name; a dot in it does not mean a field of a struct."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: Iterable[str]) -> list[Column]:
    return [column(name) for name in names]
