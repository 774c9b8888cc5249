"""Line, customer and item features, and the stock and order checks next to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import money_sum, one_row, rounded, safe_ratio
from larder.functions.fixed import COMPLETED, ITEM_FEATURE_COLUMNS, LINE_FEATURE_COLUMNS
from larder.session import settle
from larder.sources.io import union_all


def net_amount() -> Column:
    return F.col("unit_price") * F.col("quantity") * (1 - F.col("discount_pct") / 100)


def status_histogram(lines: DataFrame) -> DataFrame:
    return lines.groupBy("status").agg(F.count(F.lit(1)).alias("n_lines")).orderBy(F.desc("n_lines"), "status")


def with_line_amounts(wide: DataFrame) -> DataFrame:
    """Money, completion and calendar columns of an order line. Cancelled lines stay."""
    return (wide
            .withColumn("order_date", F.to_date("order_date"))
            .withColumns({
                "net_revenue": net_amount(),
                "line_cost": F.col("base_cost") * F.col("quantity"),
                "is_completed": (F.col("status") == COMPLETED).cast("int"),
                "day_of_week": F.dayofweek("order_date")})
            .withColumns({
                "line_profit": F.col("net_revenue") - F.col("line_cost"),
                "is_weekend": F.col("day_of_week").isin(1, 7).cast("int")}))


def line_features(wide: DataFrame) -> DataFrame:
    return with_line_amounts(wide).select(*LINE_FEATURE_COLUMNS)


def sales_lines(lines: DataFrame, orders: DataFrame, ratings: DataFrame | None = None) -> DataFrame:
    """The line features that need no dimension table: order columns, net revenue, calendar, rating.

    Aggregations per customer, item or day start here and join names afterwards.
    """
    side = orders.select("order_id", "customer_id", "location_id", "order_date", "channel", "status", "promo_id")
    if ratings is not None:
        lines = lines.join(ratings.select("order_id", "item_id", "avg_rating"), ["order_id", "item_id"], "left")
    return lines.join(side, "order_id", "left").withColumns({
        "net_revenue": net_amount(),
        "is_completed": (F.col("status") == COMPLETED).cast("int"),
        "is_weekend": F.dayofweek("order_date").isin(1, 7).cast("int")})


def completed_only(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("is_completed") == 1)


def customer_rfm(lines: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Recency, frequency and money of customers with a completed order.

    Lines are summed per order first, which makes the order count a plain count. Recency
    counts back from the newest completed order of the data unless ``as_of`` is given.
    """
    per_order = completed_only(lines).groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("order_date"), money_sum(F.col("net_revenue")).alias("net"))
    customers = per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("net"), 2).cast("double").alias("monetary"),
        F.max("order_date").alias("last_order_date"))
    if as_of is None:
        # the newest day comes from the customer rows, so the lines are read once
        customers = settle(customers)
        as_of = one_row(customers, F.max("last_order_date").alias("day"))["day"]
    return customers.select("customer_id", "frequency", "monetary",
                            F.datediff(as_of, "last_order_date").alias("recency_days"))


def item_sales(lines: DataFrame) -> DataFrame:
    """Totals per item over completed lines; the rating only where the lines carry one."""
    rating = [rounded(F.avg("avg_rating"), 3).alias("avg_rating")] if "avg_rating" in lines.columns else []
    weekend = F.col("is_weekend").cast("double")
    return completed_only(lines).groupBy("item_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.count_distinct("order_id").alias("n_orders"),
        money_sum(F.col("net_revenue")).alias("net_exact"),
        *rating,
        rounded(safe_ratio(money_sum(F.col("discount_pct")), F.count("discount_pct")), 2)
        .alias("avg_discount_pct"),
        rounded(F.avg(weekend), 3).alias("weekend_share"))


def waste_ratio(prepared: DataFrame, wasted: DataFrame, key: str) -> DataFrame:
    """Wasted over prepared units. A key without waste has ratio 0, without preparation none."""
    p = prepared.groupBy(key).agg(F.sum("prepared_qty").alias("total_prepared"))
    w = wasted.groupBy(key).agg(F.sum("quantity_wasted").alias("total_wasted"))
    ratio = safe_ratio(F.coalesce("total_wasted", F.lit(0)), F.col("total_prepared"))
    return p.join(w, key, "left").select(
        key, F.when(F.col("total_prepared") > 0, rounded(ratio, 4)).alias("wastage_percent"))


def item_features(lines: DataFrame, items: DataFrame, categories: DataFrame, prepared: DataFrame,
                  wasted: DataFrame) -> DataFrame:
    """Fifteen columns per item with a completed sale.

    Lines are aggregated before item names are joined: the cost of an item is its unit cost
    times the units sold, so no item column travels with the lines.
    """
    dim = items.select("item_id", "item_name", "category_id", "base_cost").join(
        categories.select("category_id", "category_name"), "category_id", "left")
    cost = F.col("base_cost").cast("decimal(18,6)") * F.col("total_quantity_sold").cast("decimal(18,0)")
    sold = (item_sales(lines).join(dim, "item_id", "left")
            .withColumns({
                "net_revenue": F.round("net_exact", 2).cast("double"),
                "total_cost": F.round(cost, 2).cast("double"),
                "total_profit": F.round(F.col("net_exact") - cost, 2).cast("double")})
            .withColumn("profit_margin", rounded(F.try_divide("total_profit", "net_revenue"), 4)))
    return sold.join(waste_ratio(prepared, wasted, "item_id"), "item_id", "left").select(*ITEM_FEATURE_COLUMNS)


def coverage(rfm: DataFrame, customers: DataFrame, features: DataFrame, items: DataFrame) -> DataFrame:
    """How many customers and items got a feature row, of how many."""
    def row(grain: str, part: DataFrame, whole: DataFrame) -> DataFrame:
        total = whole.agg(F.count(F.lit(1)).alias("value")).scalar()
        return part.agg(F.count(F.lit(1)).alias("n_featured")).select(
            F.lit(grain).alias("grain"), "n_featured", total.alias("n_total"))
    return union_all([row("customers", rfm, customers), row("items", features, items)])


def observed_waste(prepared: DataFrame, wasted: DataFrame, key: str) -> DataFrame:
    """Wasted over prepared units for keys that occur in both tables, to six places."""
    p = prepared.groupBy(key).agg(F.sum("prepared_qty").alias("made"))
    w = wasted.groupBy(key).agg(F.sum("quantity_wasted").alias("lost"))
    return w.join(p, key).select(key, rounded(safe_ratio(F.col("lost"), F.col("made")), 6).alias("waste_ratio"))


def line_total_mismatches(lines: DataFrame) -> DataFrame:
    """Lines whose stored total differs from quantity x price x (1 - discount)."""
    expected = rounded(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100), 2)
    return (lines.withColumn("expected_total", expected)
            .filter(F.abs(F.col("line_total") - F.col("expected_total")) > 0.005))


def merged_lines(lines: DataFrame) -> DataFrame:
    """One line per order and item, repeated lines summed."""
    return lines.groupBy("order_id", "item_id").agg(
        F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines"))


def weekly_consumption(lines: DataFrame, start_date: str) -> DataFrame:
    """Completed units per week, location and item; weeks count from ``start_date``."""
    days = F.datediff("order_date", F.lit(start_date).cast("date"))
    return (completed_only(lines).withColumn("week_no", F.floor(days / 7))
            .groupBy("week_no", "location_id", "item_id").agg(F.sum("quantity").alias("units")))


def stock_roll_forward(moves: DataFrame, opening: int = 30) -> DataFrame:
    """Opening and closing stock per location and item by week.

    Closing stock is the running balance floored at zero; the floor is applied to the running
    sum, not carried on. A group holds one row per week.
    """
    series = Window.partitionBy("location_id", "item_id").orderBy("week_start")
    balance = F.sum(F.col("replenished_qty") - F.col("prepared_qty")).over(
        series.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (moves.withColumn("closing_stock", F.greatest(F.lit(0), F.lit(opening) + balance).cast("bigint"))
            .withColumn("opening_stock",
                        F.coalesce(F.lag("closing_stock").over(series), F.lit(opening)).cast("bigint")))


def near_duplicate_orders(orders: DataFrame, lines: DataFrame, minutes: int = 3) -> DataFrame:
    """Orders that repeat an earlier one: same customer, place and basket within ``minutes``.

    The basket is compared through an order-independent fingerprint built by aggregation.
    Orders are reduced to one row per distinct moment, and moments are compared inside time
    slots and across the border to the previous slot, so a flood of copies in one group is
    neither collected nor paired: a moment has at most one predecessor.
    """
    basket = lines.groupBy("order_id", "item_id").agg(F.sum("quantity").alias("quantity")).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.bit_xor(F.xxhash64("item_id", "quantity")).alias("fingerprint"),
        F.bit_xor(F.xxhash64("quantity", "item_id")).alias("fingerprint2"))
    same = ["customer_id", "location_id", "n_items", "fingerprint", "fingerprint2"]
    placed = (orders.select("order_id", "customer_id", "location_id", "order_datetime").join(basket, "order_id")
              .withColumn("second", F.unix_timestamp("order_datetime")))
    moments = placed.groupBy(*same, "second").agg(F.min("order_id").alias("first_order"),
                                                  F.max("order_id").alias("last_order"))
    moments = moments.withColumn("slot", F.floor(F.col("second") / (minutes * 60)))
    in_slot = Window.partitionBy(*same, "slot").orderBy("second")
    slot_end = moments.groupBy(*same, (F.col("slot") + 1).alias("slot")).agg(
        F.max(F.struct("second", "first_order")).alias("border"))
    before = F.struct("second", "first_order")
    moments = (moments.withColumn("inside", F.lag(before).over(in_slot))
               .join(slot_end, [*same, "slot"], "left")
               .withColumn("earlier", F.coalesce("inside", "border"))
               .select(*same, "second", "first_order", "earlier"))
    gap = F.when(F.col("order_id") > F.col("first_order"), F.lit(0).cast("bigint")).otherwise(
        F.col("second") - F.col("earlier.second"))
    partner = F.when(F.col("order_id") > F.col("first_order"), F.col("first_order")).otherwise(
        F.col("earlier.first_order"))
    return (placed.join(moments, [*same, "second"])
            .select("order_id", "customer_id", "location_id", partner.alias("repeats_order"),
                    gap.alias("seconds_apart"))
            .filter(F.col("seconds_apart") <= minutes * 60))
