"""Business queries: filters, key figures, rankings and distributions with parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import money_sum, rounded, safe_ratio
from larder.functions.fixed import CANCELLED
from larder.sources.io import union_all

ALL = "All"


def filter_lines(lines: DataFrame, start: str | None = None, end: str | None = None, location: str = ALL,
                 category: str = ALL, channel: str = ALL) -> DataFrame:
    """Lines in an inclusive date range at a location, of a category and channel; 'All' does not filter."""
    if start is not None:
        lines = lines.filter(F.col("order_date") >= F.lit(start).cast("date"))
    if end is not None:
        lines = lines.filter(F.col("order_date") <= F.lit(end).cast("date"))
    for column, wanted in (("location_id", location), ("category_name", category), ("channel", channel)):
        if wanted != ALL:
            lines = lines.filter(F.col(column) == wanted)
    return lines


def location_dimension(locations: DataFrame) -> DataFrame:
    return locations.dropDuplicates(["location_id"])


def filter_options(lines: DataFrame, locations: DataFrame) -> DataFrame:
    """Values to choose from: locations with a label, categories, channels, and the date range."""
    place = (lines.select("location_id").distinct().filter(F.col("location_id").isNotNull())
             .join(location_dimension(locations).select("location_id", "restaurant_name"), "location_id", "left")
             .select(F.lit("location").alias("filter"), F.col("location_id").alias("value"),
                     F.concat("location_id", F.lit(" - "), F.coalesce("restaurant_name", "location_id")).alias("label")))

    def choices(name: str, column: str) -> DataFrame:
        return (lines.select(column).distinct().filter(F.col(column).isNotNull())
                .select(F.lit(name).alias("filter"), F.col(column).alias("value"), F.col(column).alias("label")))
    span = lines.agg(F.min("order_date").cast("string").alias("a"), F.max("order_date").cast("string").alias("b"))
    dates = span.select(F.inline(F.array(*[
        F.struct(F.lit("date").alias("filter"), F.col(c).alias("value"), F.lit(label).alias("label"))
        for c, label in (("a", "first"), ("b", "last"))])))
    return union_all([place, choices("category", "category_name"), choices("channel", "channel"), dates])


def key_figures(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue, profit, orders, average order value, customers, cancelled orders and live items.

    Lines are reduced to orders first, which turns the distinct order counts into plain sums.
    """
    done = F.col("is_completed") == 1
    per_order = lines.groupBy("order_id", "customer_id").agg(
        money_sum(F.when(done, F.col("net_revenue"))).alias("revenue"),
        money_sum(F.when(done, F.col("line_profit"))).alias("profit"),
        F.max(done).alias("completed"), F.max(F.col("status") == CANCELLED).alias("cancelled"))
    totals = per_order.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.count_if("completed").alias("orders"), F.count_if("cancelled").alias("cancelled"),
    ).agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
          F.coalesce(F.sum("profit"), F.lit(0)).alias("profit"),
          F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
          F.count_if((F.col("orders") > 0) & F.col("customer_id").isNotNull()).alias("active_customers"),
          F.count_if((F.col("orders") > 1) & F.col("customer_id").isNotNull()).alias("repeat_customers"),
          F.coalesce(F.sum("cancelled"), F.lit(0)).alias("cancelled_orders"))
    live = items.agg(F.count_distinct("item_id").alias("value")).scalar()
    return totals.select(
        F.round("revenue", 2).cast("double").alias("total_revenue"),
        F.round("profit", 2).cast("double").alias("total_profit"), "total_orders",
        F.coalesce(rounded(safe_ratio(F.col("revenue"), F.col("total_orders")), 2), F.lit(0.0)).alias("avg_order_value"),
        "active_customers", "repeat_customers", "cancelled_orders", live.alias("live_items"))


def repeat_customers(lines: DataFrame) -> DataFrame:
    """Customers with more than one completed order."""
    return (lines.filter(F.col("is_completed") == 1).filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(F.count_distinct("order_id").alias("n_orders"))
            .filter(F.col("n_orders") > 1))


def revenue_by(lines: DataFrame, key: str) -> DataFrame:
    return lines.filter(F.col("is_completed") == 1).groupBy(key).agg(
        F.round(money_sum(F.col("net_revenue")), 2).cast("double").alias("net_revenue"))


def daily_revenue(lines: DataFrame) -> DataFrame:
    return revenue_by(lines, "order_date").orderBy("order_date")


def revenue_by_category(lines: DataFrame) -> DataFrame:
    return revenue_by(lines, "category_name").orderBy(F.desc("net_revenue"), "category_name")


def menu_view(items: DataFrame, labels: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """Classified items of the chosen labels and categories."""
    if labels is not None:
        items = items.filter(F.col("python_label").isin(labels))
    if categories is not None:
        items = items.filter(F.col("category_name").isin(categories))
    return items


def menu_figures(shown: DataFrame) -> DataFrame:
    return shown.agg(F.count(F.lit(1)).alias("n_items"), rounded(F.avg("profit_margin"), 4).alias("avg_margin"),
                     rounded(F.avg("avg_rating"), 3).alias("avg_rating"),
                     rounded(F.avg("wastage_percent"), 4).alias("avg_wastage"))


def slow_movers(shown: DataFrame, n: int = 10) -> DataFrame:
    return (shown.select("item_id", "item_name", "category_name", "total_quantity_sold", "profit_margin",
                         "avg_rating", "wastage_percent", "python_label")
            .orderBy("total_quantity_sold", "item_id").limit(n))


def menu_table(shown: DataFrame) -> DataFrame:
    return (shown.select("item_id", "item_name", "category_name", "profit_margin", "total_quantity_sold",
                         "avg_rating", "avg_discount_pct", "wastage_percent", "python_label")
            .orderBy(F.desc("profit_margin"), "item_id"))


def menu_scatter(shown: DataFrame) -> DataFrame:
    return shown.select("item_name", "total_quantity_sold", "profit_margin", "python_label", "net_revenue")


def segment_view(segmented: DataFrame, segments: list[str] | None = None) -> DataFrame:
    shown = segmented if segments is None else segmented.filter(F.col("segment").isin(segments))
    return (shown.select("customer_id", "recency_days", "frequency", "monetary", "rfm_score", "segment")
            .orderBy(F.desc("monetary"), "customer_id"))


def score_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_score").agg(F.count(F.lit(1)).alias("n_customers")).orderBy("rfm_score")


def stable_sample(frame: DataFrame, key: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most n rows: the smallest hashes of key and seed."""
    hashed = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return frame.withColumn("_h", hashed).orderBy("_h", key).limit(n).drop("_h")


def waste_figures(scored: DataFrame) -> DataFrame:
    """Mean waste share and the worst items; equal values go to the smaller item id."""
    def worst(column: str):
        return F.min_by("item_name", F.struct(-F.col(column), F.col("item_id")))
    return scored.filter(F.col("wastage_percent").isNotNull()).agg(
        rounded(F.avg("wastage_percent"), 4).alias("avg_wastage"),
        worst("wastage_percent").alias("highest_wastage_item"),
        worst("predicted_wastage_risk").alias("highest_risk_item"))


def top_waste(scored: DataFrame, by: str = "wastage_percent", n: int | None = 10) -> DataFrame:
    """Items by actual or predicted waste; all of them where n is None."""
    columns = [c for c in ("item_id", "item_name", "category_name", "wastage_percent", "predicted_wastage_risk",
                           "total_quantity_sold", "avg_rating") if c in scored.columns]
    ordered = scored.select(*columns).orderBy(F.desc(by), "item_id")
    return ordered if n is None else ordered.limit(n)


def waste_by_category(items: DataFrame) -> DataFrame:
    return (items.groupBy("category_name").agg(rounded(F.avg("wastage_percent"), 4).alias("avg_wastage"))
            .orderBy(F.desc("avg_wastage"), "category_name"))


def metric_lookup(metrics: DataFrame, category: str) -> DataFrame:
    return metrics.filter(F.col("category_name") == category).select(
        "category_name", "mae_baseline", "mae_model", (F.col("mae_model") - F.col("mae_baseline")).alias("mae_delta"),
        "rmse_model", "beats_baseline")
