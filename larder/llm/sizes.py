"""Broadcasts behind a check of the size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 24 << 20


def small(table: DataFrame, row_bytes: Column | int = 16) -> DataFrame:
    """The table, marked for broadcast if its rows add up to little; a shuffle join takes it otherwise.

    Meant for settled tables, as it is counted here; ``row_bytes`` is the size of a row.
    """
    width = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    return F.broadcast(table) if (table.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES else table
