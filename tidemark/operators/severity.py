"""Severity and regrowth after breaks: the index drop across a break, and what follows it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..keys import Series
from .changes import break_pairs, latest_breaks, trajectories


def severity(breaks: DataFrame, monthly: DataFrame, nbr: str, s: Series) -> DataFrame:
    """keys, t_break, dnbr: fall of the burn ratio from the month of the latest break to the next month."""
    last = latest_breaks(breaks, s, [])
    return break_pairs(last, monthly, nbr, s).withColumnRenamed("difference", "dnbr").drop("before", "after")


def regrowth(breaks: DataFrame, monthly: DataFrame, ndvi: str, s: Series) -> DataFrame:
    """One row for each month from the latest break on."""
    return trajectories(latest_breaks(breaks, s, []), monthly, ndvi, s)
