"""Text formats for figures shown to people; apply them last."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def percent(share: Column) -> Column:
    return F.concat(F.format_number(share * 100, 0), F.lit("%"))


def reais(value: Column) -> Column:
    return F.concat(F.lit("R$"), F.format_number(value, 0))
