"""Texts built from templates."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **parts: Column) -> Column:
    """``concat`` of a template whose ``{name}`` marks stand for columns."""
    pieces: list[Column] = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if name:
            pieces.append(parts[name])
    return F.concat(*pieces)
