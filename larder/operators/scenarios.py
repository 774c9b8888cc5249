"""What-if estimates for every item: change of price, discount or preparation.

A grid frame holds the assumptions, one row per scenario. It is a parameter list written by
a person, and is turned into an array column, so every item row expands to its scenarios
without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import safe_ratio


def _expand(items: DataFrame, grid: list[dict[str, float]]) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in row.items()]) for row in grid])
    kept = [c for c in items.columns]
    return items.select(*kept, F.inline(rows))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _report(frame: DataFrame, parameters: list[str]) -> DataFrame:
    margin = _or_zero(safe_ratio(F.col("new_profit"), F.col("new_revenue")))
    return frame.withColumn("new_margin", margin).select(
        "item_id", "item_name", *parameters, "new_quantity", "new_revenue", "new_profit", "new_margin",
        (F.col("new_revenue") - F.col("net_revenue")).alias("revenue_change"),
        (F.col("new_profit") - F.col("total_profit")).alias("profit_change"),
        (F.col("new_margin") - F.col("profit_margin")).alias("margin_change"))


def _sold(frame: DataFrame, demand_pct: Column, price_factor: Column) -> DataFrame:
    units = F.col("total_quantity_sold")
    average = _or_zero(safe_ratio(F.col("net_revenue"), units))
    quantity = F.greatest(F.lit(0.0), units * (1 + demand_pct / 100))
    return (frame.withColumn("new_quantity", quantity)
            .withColumn("new_revenue", average * price_factor * F.col("new_quantity"))
            .withColumn("new_profit", F.col("new_revenue") - F.col("base_cost") * F.col("new_quantity")))


def price_scenarios(items: DataFrame, grid: list[dict[str, float]]) -> DataFrame:
    """``price_change_pct`` and ``elasticity``: each percent of price costs elasticity percent of units."""
    rows = _expand(items, grid)
    change = F.col("price_change_pct")
    return _report(_sold(rows, -F.col("elasticity") * change, 1 + change / 100),
                   ["price_change_pct", "elasticity"])


def discount_scenarios(items: DataFrame, grid: list[dict[str, float]]) -> DataFrame:
    """``discount_change`` in points and ``lift_per_point`` in percent of units."""
    rows = _expand(items, grid)
    change = F.col("discount_change")
    return _report(_sold(rows, F.col("lift_per_point") * change, 1 - change / 100),
                   ["discount_change", "lift_per_point"])


def preparation_scenarios(items: DataFrame, grid: list[dict[str, float]]) -> DataFrame:
    """``prep_change_pct`` moves the wasted units; sales stay as they are."""
    share = F.col("wastage_percent")
    wasted = F.when(share < 1, F.col("total_quantity_sold") * share / (1 - share)).otherwise(F.lit(0.0))
    rows = (_expand(items, grid).withColumn("_wasted", wasted)
            .withColumn("_new_wasted", F.greatest(
                F.lit(0.0), F.col("_wasted") * (1 + F.col("prep_change_pct") / 100)))
            .withColumns({
                "new_quantity": F.col("total_quantity_sold").cast("double"), "new_revenue": F.col("net_revenue"),
                "new_profit": F.col("total_profit") - (F.col("_new_wasted") - F.col("_wasted")) * F.col("base_cost")}))
    return _report(rows, ["prep_change_pct"])
