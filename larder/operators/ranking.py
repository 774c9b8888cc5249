"""Global ranks and exact quantiles without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import settle


def global_row_number(frame: DataFrame, order_by: list[str], out: str = "row_number") -> DataFrame:
    """Number all rows 1..n in the given order.

    Spark's range sort spreads the rows, and the sorted rows are written with their position in their partition. A
    partition's start is the row count of the partitions before it: one number per partition is counted and put into
    the plan as a literal array, so the written rows are numbered where they lie and not shuffled again. Ties on the
    leading columns spread too, as long as ``order_by`` ends in a unique column.
    """
    # monotonically_increasing_id: partition index in the upper bits, position in the lower 33
    placed = settle(frame.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).cast("int")
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())  # a row per partition of the sort
    starts = [0]
    for k in range(max(sizes, default=0)):
        starts.append(starts[-1] + sizes.get(k, 0))
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(out, F.get(F.array(*[F.lit(n).cast("long") for n in starts]), part) + position + 1).drop("_id")


def rank_bounds(frame: DataFrame, value: str, key: str, shares: list[float]) -> list[Column]:
    """For each share the last row, as a struct (value, key), whose position from 0 among n sorted rows is at most
    share * (n - 1). Rows are compared with these structs instead of being numbered; only the two columns are sorted."""
    numbered = global_row_number(frame.select(value, key), [value, key], "_rank")
    n = numbered.count()
    at = [int(share * (n - 1)) + 1 for share in shares]
    rows = {r["_rank"]: r for r in numbered.filter(F.col("_rank").isin(at)).collect()}  # a row per share
    kinds = [numbered.schema[c].dataType for c in (value, key)]
    return [F.struct(F.lit(rows[k][0]).cast(kinds[0]).alias(value), F.lit(rows[k][1]).cast(kinds[1]).alias(key)) for k in at] if n else []


def quantiles_of_ranked(ranked: DataFrame, value: str, row_number: str, shares: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles from a column that is already numbered by its own order."""
    total = ranked.agg(F.count(F.lit(1)).alias("value")).scalar()
    picks = []
    for name, share in shares.items():
        position = (total - 1) * F.lit(share)
        low = F.floor(position)
        at_low = F.max(F.when(F.col(row_number) == low + 1, F.col(value)))
        at_high = F.max(F.when(F.col(row_number) == F.ceil(position) + 1, F.col(value)))
        picks.append((at_low + (at_high - at_low) * F.any_value(position - low)).alias(name))
    return ranked.agg(*picks)


def value_ranks(frame: DataFrame, values: list[str]) -> dict[str, DataFrame]:
    """Per column: its distinct non-null values with rows ``below`` and rows ``ties`` at the value.

    Meant for columns with few distinct values: rounded ratios and ratings, day counts, or
    whole-number totals (n distinct positive totals need a sum of at least n * n / 2). All
    columns are counted in one pass, so the windows see the values and not the rows.
    """
    entries = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values])
    counts = (frame.select(F.inline(entries)).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("ties")))
    below = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranks = settle(counts.withColumn("below", F.coalesce(F.sum("ties").over(below), F.lit(0))))
    return {v: ranks.filter(F.col("column") == v).select("value", "below", "ties") for v in values}


BROADCAST_VALUES = 500_000  # distinct values, of 16 bytes each, that are sent to every executor


def rows_below(frame: DataFrame, column: str, ranks: DataFrame, out: str) -> DataFrame:
    """``frame`` with ``out``, the number of ranked rows below its value (null if the value was not ranked).

    The values of a rounded column are few and are broadcast, after a count, so that a hot value moves no row.
    """
    ranks = ranks.select(F.col("value").alias("_value"), F.col("below").alias(out))
    if ranks.count() <= BROADCAST_VALUES:
        ranks = F.broadcast(ranks)
    return frame.join(ranks, F.col(column).cast("double") == F.col("_value"), "left").drop("_value")
