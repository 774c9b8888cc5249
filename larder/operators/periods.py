"""Sales by week and day: the series of items, categories and locations, from one pass over the lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import money_sum

#: The grouping sets of the pass, by the name of the table they become.
SERIES = {
    "weekly_item": ["item_id", "week_start"], "weekly_category": ["category_id", "week_start"],
    "weekly_location": ["location_id", "week_start"],
    "daily_location": ["location_id", "order_date"], "daily_item": ["item_id", "order_date"],
}
_KEYS = ["item_id", "category_id", "location_id", "week_start", "order_date"]


def period_totals(lines: DataFrame, names: Sequence[str] = tuple(SERIES)) -> DataFrame:
    """Completed lines summed over the named SERIES at once, ``series`` naming the table a row belongs to.

    Lines are first summed per order and the keys of these series, which is as fine as the count of orders needs. With
    several series these sums, not the lines, are expanded to the grouping sets; a single one needs no expansion, and its
    orders are its rows of sums, so that no order is kept a second time to be told apart. Weeks start on Monday.
    """
    done = lines.filter(F.col("is_completed") == 1).withColumn("week_start", F.date_trunc("week", "order_date").cast("date"))
    used = [k for k in _KEYS if any(k in SERIES[name] for name in names)]
    fine = done.groupBy("order_id", *used).agg(
        F.sum("quantity").alias("units"), money_sum(F.col("net_revenue")).alias("net"), money_sum(F.col("line_profit")).alias("gain"),
        F.sum(F.when(F.col("promo_id").isNotNull(), F.col("quantity")).otherwise(0)).alias("promo"))
    sums = [F.sum("units").alias("units"), F.round(F.sum("net"), 2).cast("double").alias("net_revenue"),
            F.round(F.sum("gain"), 2).cast("double").alias("profit"), F.sum("promo").alias("promo_units")]
    if len(names) == 1:
        return fine.groupBy(*used).agg(*sums, F.count("order_id").alias("orders")).withColumn("series", F.lit(names[0]))
    # bits of the keys a set leaves out, the last key the lowest; a null key is a group of its own, not one left out
    number = {sum(1 << (len(used) - 1 - i) for i, k in enumerate(used) if k not in SERIES[name]): name for name in names}
    label = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    totals = fine.groupingSets([[F.col(k) for k in SERIES[name]] for name in names], *used).agg(
        F.grouping_id().cast("int").alias("_set"), *sums, F.count_distinct("order_id").alias("orders"))
    return totals.withColumn("series", label[F.col("_set")]).drop("_set")


def weekly_series(totals: DataFrame, name: str, names: DataFrame) -> DataFrame:
    """One weekly table; ``names`` gives the entity_name of each entity_id. An entity without a name keeps its sums."""
    entity = SERIES[name][0]
    named = totals.filter(F.col("series") == name).withColumn("entity_id", F.col(entity).cast("string"))
    return named.join(names.select(F.col("entity_id").cast("string").alias("entity_id"), "entity_name"), "entity_id", "left").select(
        "entity_id", "entity_name", "week_start", "units", "net_revenue", "orders", "promo_units")


def daily_location(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("series") == "daily_location").select("order_date", "location_id", "orders", "units", "net_revenue", "profit")


def daily_item(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("series") == "daily_item").select("order_date", "item_id", "units", "net_revenue")
