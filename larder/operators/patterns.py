"""Pattern and anomaly checks. Each check reports its number, name, two measured values and a verdict.

Checks that look at the same grain share one aggregation (items, places, calendar, ratings),
so the order lines are read a few times for all checks and not once per check.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import money_sum, rounded, safe_ratio
from larder.functions.fixed import COMPLETED
from larder.operators.features import observed_waste
from larder.operators.ranking import value_ranks
from larder.session import settle
from larder.sources.io import union_all


@dataclass(frozen=True)
class PatternSettings:
    """What to look for. Thresholds have the usual values; ids and dates depend on the data."""

    start: str
    end: str
    cases: dict[str, int | str]
    promo_traps: list[str]
    new_since: str
    churned_before: str
    customers_new_since: str
    collapse_location: str
    collapse_window: tuple[str, str]
    collapse_reference: tuple[str, str]
    rating_drop_prefix: str
    rating_drop_window: tuple[str, str]
    burst_item_name: str
    burst_window: tuple[str, str]
    waste_location: str
    price_sensitive: list[int | str] = field(default_factory=list)
    min_price_rise: float = 0.12
    study_days: int = 42
    min_units_before: int = 30
    bulk_lines: int = 30
    odd_discounts: tuple[float, float] = (50.0, 70.0)


def valid_orders(orders: DataFrame, locations: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct orders with a readable date in the window and a known location; status tidied.

    Unlike the cleaning rules this keeps orders without a customer.
    """
    day = F.try_to_date(F.col("order_date").cast("string"), "yyyy-MM-dd")
    return (orders.dropDuplicates()
            .withColumns({"status": F.initcap(F.trim("status")), "day": day})
            .filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .join(locations.select("location_id"), "location_id", "left_semi"))


def valid_lines(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    return (lines.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0)).dropDuplicates()
            .join(items.select("item_id"), "item_id", "left_semi")
            .join(orders.select("order_id"), "order_id", "left_semi"))


def checked_lines(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed valid lines with net amount (discount held to 0-100), cost and profit."""
    done = orders.filter(F.col("status") == COMPLETED).select(
        "order_id", "day", "location_id", "promo_id", "customer_id")
    return _with_profit(lines.join(done, "order_id").join(items.select("item_id", "base_cost"), "item_id"))


def _with_profit(lines: DataFrame) -> DataFrame:
    discount = F.least(F.greatest(F.col("discount_pct"), F.lit(0.0)), F.lit(100.0))
    return (lines.withColumn("net", F.col("quantity") * F.col("unit_price") * (1 - discount / 100))
            .withColumn("profit", F.col("net") - F.col("quantity") * F.col("base_cost")))


def ordered_lines(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """The valid lines with what the checks need of their order and item, for ``completed`` and ``once_each``.

    Lines meet their orders once. An order id of several orders gives a line for each; ``lead`` marks the first.
    """
    lead = F.row_number().over(Window.partitionBy("order_id").orderBy("day", F.xxhash64(*orders.columns))) == 1
    valid = lines.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0)).dropDuplicates()
    return (valid.select("order_id", "item_id", "quantity", "unit_price", "discount_pct")
            .join(items.select("item_id", "base_cost"), "item_id")
            .join(orders.withColumn("lead", lead).select("order_id", "status", "day", "location_id", "promo_id", "lead"), "order_id"))


def completed(ordered: DataFrame) -> DataFrame:
    """What ``checked_lines`` gives, from ordered lines."""
    return _with_profit(ordered.filter(F.col("status") == COMPLETED))


def once_each(ordered: DataFrame) -> DataFrame:
    """Each valid line once, from ordered lines."""
    return ordered.filter("lead")


def item_profile(lines: DataFrame, ratings: DataFrame, prepared: DataFrame, wasted: DataFrame) -> DataFrame:
    """Everything the item checks look at, one row per sold item."""
    on_promo = (F.col("promo_id").isNotNull() & (F.col("promo_id") != "")).cast("double")
    sold = lines.groupBy("item_id").agg(
        F.sum("quantity").alias("units"), money_sum(F.col("net")).alias("net"),
        money_sum(F.col("profit")).alias("profit"),
        F.avg(on_promo).alias("promo_share"),
        F.avg((F.weekday("day") >= 5).cast("double")).alias("weekend_share"),
        F.avg((F.month("day") == 12).cast("double")).alias("december_share"),
        F.min("day").alias("first_sale"))
    rated = (ratings.filter(F.col("rating_value").between(1, 5)).groupBy("item_id")
             .agg(F.avg("rating_value").alias("rating")))
    waste = observed_waste(prepared, wasted, "item_id")
    sold = settle(sold)
    n = sold.agg(F.count(F.lit(1)).alias("value")).scalar()
    ranks = value_ranks(sold, ["units"])["units"].select(F.col("value").cast("bigint").alias("units"), "below", "ties")
    # average position counted from the best seller
    rank = n - F.col("below") - F.col("ties") + (F.col("ties") + 1) / 2
    return (sold.join(ranks, "units").join(rated, "item_id", "left").join(waste, "item_id", "left")
            .select("item_id", "units", safe_ratio(F.col("profit"), F.col("net")).alias("margin"), "promo_share",
                    "weekend_share", "december_share", "first_sale", "rating", "waste_ratio",
                    rank.alias("sales_rank"), n.alias("n_items")))


def _check(no: int, name: str, passed: Column, a: Column, b: Column | None = None) -> Column:
    nothing = F.lit(None).cast("double")
    return F.struct(
        F.lit(no).alias("check_no"), F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"), rounded(a.cast("double"), 4).alias("measured"),
        (nothing if b is None else rounded(b.cast("double"), 4)).alias("compared"))


def _rows(frame: DataFrame, checks: list[Column]) -> DataFrame:
    return frame.select(F.inline(F.array(*checks)))


def item_checks(profile: DataFrame, waste: DataFrame, s: PatternSettings) -> DataFrame:
    """Checks 1-9 on the named items."""
    names = ["margin", "sales_rank", "promo_share", "weekend_share", "december_share", "first_sale", "rating",
             "waste_ratio", "units"]

    def of(case: str) -> Column:
        return F.max(F.when(F.col("item_id") == s.cases[case], F.struct(*names))).alias(case)
    p95 = waste.agg(F.percentile("waste_ratio", F.lit(0.95)).alias("value")).scalar()
    one = profile.agg(F.max("n_items").alias("n_items"), *[of(c) for c in s.cases])

    def v(case: str, name: str) -> Column:
        return F.col(f"{case}.{name}")
    new_since = F.lit(s.new_since).cast("date")
    return _rows(one, [
        _check(1, "High-selling but LOSS-MAKING dish",
               (v("loss_making_popular", "margin") < 0) & (v("loss_making_popular", "sales_rank") <= 10),
               v("loss_making_popular", "margin"), v("loss_making_popular", "sales_rank")),
        _check(2, "Highly profitable but RARELY bought dish",
               (v("hidden_high_margin", "margin") > 0.55)
               & (v("hidden_high_margin", "sales_rank") > F.col("n_items") * 0.5),
               v("hidden_high_margin", "margin"), v("hidden_high_margin", "sales_rank")),
        _check(3, "Popular dish with EXCESSIVE WASTAGE",
               (F.coalesce(v("popular_high_wastage", "waste_ratio"), F.lit(0.0)) > p95)
               & (v("popular_high_wastage", "sales_rank") <= 15),
               F.coalesce(v("popular_high_wastage", "waste_ratio"), F.lit(0.0)),
               v("popular_high_wastage", "sales_rank")),
        _check(4, "Highly RATED dish with POOR profitability",
               (v("highly_rated_low_margin", "rating") >= 4.5) & (v("highly_rated_low_margin", "margin") < 0.2),
               v("highly_rated_low_margin", "rating"), v("highly_rated_low_margin", "margin")),
        _check(5, "Low-RATED dish with HIGH SALES",
               (v("low_rated_high_sales", "rating") < 3.2) & (v("low_rated_high_sales", "sales_rank") <= 10),
               v("low_rated_high_sales", "rating"), v("low_rated_high_sales", "sales_rank")),
        _check(6, "PROMOTION-DEPENDENT dish", v("promo_dependent", "promo_share") > 0.6,
               v("promo_dependent", "promo_share")),
        _check(7, "Dish that sells only at WEEKENDS", v("weekend_only", "weekend_share") > 0.7,
               v("weekend_only", "weekend_share")),
        _check(8, "SEASONAL dish", v("seasonal", "december_share") > 0.6, v("seasonal", "december_share")),
        _check(9, "NEW item with little history", v("new_item", "first_sale") > new_since,
               F.datediff(v("new_item", "first_sale"), new_since), v("new_item", "units")),
    ])


def place_checks(lines: DataFrame, locations: DataFrame, item_id) -> DataFrame:
    """Checks 10-11: units share of an item by region, and revenue by location."""
    per_location = lines.groupBy("location_id").agg(
        F.sum("quantity").alias("units"),
        F.sum(F.when(F.col("item_id") == item_id, F.col("quantity"))).alias("item_units"),
        money_sum(F.col("net")).alias("net"))
    shares = (per_location.join(locations.select("location_id", "region"), "location_id").groupBy("region")
              .agg(F.sum("units").alias("units"), F.sum("item_units").alias("item_units"))
              .select(safe_ratio(F.col("item_units"), F.col("units")).alias("share"))
              .agg(F.max("share").alias("top"), F.median("share").alias("mid")))
    spread = per_location.agg(F.max("net").cast("double").alias("best"), F.min("net").cast("double").alias("worst"))
    return union_all([
        _rows(shares, [_check(10, "Dish performing DIFFERENTLY across locations",
                              F.col("top") > 2.5 * F.col("mid"), F.col("top"), F.col("mid"))]),
        _rows(spread, [_check(11, "MULTI-LOCATION differences", F.col("best") > 2 * F.col("worst"),
                              F.col("best"), F.col("worst"))])])


def hour_check(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Check 12: share of units sold at noon (12-14) and in the evening (18-21)."""
    hour = F.hour("order_datetime")
    sums = lines.groupBy("order_id").agg(F.sum("quantity").alias("quantity"))
    timed = sums.join(orders.select("order_id", "order_datetime"), "order_id")
    total = timed.filter(F.col("order_datetime").isNotNull()).agg(
        F.sum("quantity").alias("units"),
        F.sum(F.when(hour.between(12, 14) | hour.between(18, 21), F.col("quantity"))).alias("peak"))
    share = safe_ratio(F.coalesce("peak", F.lit(0)), F.col("units"))
    return _rows(total, [_check(12, "PEAK-HOUR pattern", share > 0.45, share)])


def calendar_checks(orders: DataFrame, s: PatternSettings) -> DataFrame:
    """Checks 13, 14, 17 and 18 on completed orders."""
    done = orders.filter(F.col("status") == COMPLETED)
    months = done.groupBy(F.month("day").alias("month")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max(F.when(F.col("month") == 12, F.col("n"))).alias("december"), F.avg("n").alias("mean"))
    december = F.coalesce(safe_ratio(F.col("december"), F.col("mean")), F.lit(0.0))
    days = done.groupBy(F.weekday("day").alias("weekday")).agg(F.count(F.lit(1)).alias("n")).agg(
        (F.sum(F.when(F.col("weekday") >= 5, F.col("n"))) / 2).alias("weekend"),
        F.avg(F.when(F.col("weekday") <= 3, F.col("n"))).alias("workday"))
    stay = done.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.count(F.lit(1)).alias("n"))
    moves = stay.agg(
        F.count_if((F.col("last") < F.lit(s.churned_before).cast("date")) & (F.col("n") >= 3)).alias("churned"),
        F.count_if(F.col("first") > F.lit(s.customers_new_since).cast("date")).alias("new"))
    collapse = window_vs_reference(done.filter(F.col("location_id") == s.collapse_location), "day",
                                   s.collapse_window, s.collapse_reference)
    return union_all([
        _rows(months, [_check(13, "SEASONAL demand (December)", december > 1.2, december)]),
        _rows(days, [_check(14, "WEEKEND pattern", F.col("weekend") > 1.3 * F.col("workday"),
                            F.col("weekend"), F.col("workday"))]),
        _rows(moves, [_check(17, "CHURNED and NEW customers", (F.col("churned") > 0) & (F.col("new") > 0),
                             F.col("churned"), F.col("new"))]),
        _rows(collapse, [_check(18, "SALES anomaly (location collapse)",
                                F.col("per_day") < 0.6 * F.col("reference_per_day"),
                                F.col("per_day"), F.col("reference_per_day"))])])


def _between(day: str, window: tuple[str, str]) -> Column:
    return F.col(day).between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date"))


def _length(window: tuple[str, str]) -> Column:
    return F.datediff(F.lit(window[1]).cast("date"), F.lit(window[0]).cast("date")) + 1


def window_vs_reference(rows: DataFrame, day: str, window: tuple[str, str], reference: tuple[str, str],
                        by: list[str] | None = None) -> DataFrame:
    """Rows per day inside a window and inside a reference window, optionally per group."""
    grouped = rows.groupBy(*(by or []))
    return grouped.agg(
        (F.count_if(_between(day, window)) / _length(window)).alias("per_day"),
        (F.count_if(_between(day, reference)) / _length(reference)).alias("reference_per_day"))


def mean_shift(rows: DataFrame, value: str, day: str, window: tuple[str, str],
               by: list[str] | None = None) -> DataFrame:
    """Mean of a value inside a window against its overall mean."""
    return rows.groupBy(*(by or [])).agg(
        F.avg(F.when(_between(day, window), F.col(value))).alias("mean_in_window"), F.avg(value).alias("mean"))


def burst(rows: DataFrame, day: str, window: tuple[str, str], total_days: int,
          by: list[str] | None = None) -> DataFrame:
    """Rows inside a window against the number expected from the whole period."""
    return rows.groupBy(*(by or [])).agg(
        F.count_if(_between(day, window)).alias("in_window"),
        (F.count(F.lit(1)) * _length(window) / total_days).alias("expected"))


def price_events(prices: DataFrame, min_rise: float = 0.12, items: list | None = None) -> DataFrame:
    """Price rises above ``min_rise`` against the previous positive price of the item, of all or the named items."""
    prices = prices if items is None else prices.filter(F.col("item_id").isin(items))
    history = Window.partitionBy("item_id").orderBy("effective_from")
    return (prices.filter(F.col("price") > 0)
            .withColumn("rise", F.col("price") / F.lag("price").over(history) - 1)
            .filter(F.col("rise") > min_rise).select("item_id", "effective_from", "rise"))


def event_study(events: DataFrame, lines: DataFrame, days: int = 42, min_before: int = 30) -> DataFrame:
    """Units in the days before and after each event, for events with enough units before.

    Lines are summed per item and day first, so an item brings at most one row per day into
    the interval join.
    """
    daily = lines.groupBy("item_id", "day").agg(F.sum("quantity").alias("units"))
    offset = F.datediff("day", "effective_from")
    near = events.join(daily, "item_id").filter(
        (F.col("day") >= F.date_sub("effective_from", days)) & (F.col("day") < F.date_add("effective_from", days)))
    return (near.groupBy("item_id", "effective_from", "rise").agg(
        F.coalesce(F.sum(F.when(offset < 0, F.col("units"))), F.lit(0)).alias("units_before"),
        F.coalesce(F.sum(F.when(offset >= 0, F.col("units"))), F.lit(0)).alias("units_after"))
        .filter(F.col("units_before") > min_before)
        .withColumn("change", F.col("units_after") / F.col("units_before") - 1))


def price_check(study: DataFrame) -> DataFrame:
    """Check 15: median reaction to price rises. Changes are ratios of counts."""
    summary = study.agg(F.median(rounded(F.col("change"), 6)).alias("mid"), F.count(F.lit(1)).alias("n"))
    return _rows(summary, [_check(15, "PRICE-SENSITIVE items", (F.col("n") > 0) & (F.col("mid") < -0.15),
                                  F.col("mid"), F.col("n"))])


def promo_trap_check(lines: DataFrame, item_id, promo_ids: list[str]) -> DataFrame:
    """Check 16: the item sold on the trap promotions, at a loss."""
    on = lines.filter((F.col("item_id") == item_id) & F.col("promo_id").isin(promo_ids)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"), money_sum(F.col("profit")).alias("profit"))
    return _rows(on, [_check(16, "MISLEADING promotion (sales up, profit down)",
                             (F.col("n") > 0) & (F.col("profit") < 0), F.col("profit"), F.col("units"))])


def rating_checks(ratings: DataFrame, items: DataFrame, s: PatternSettings, total_days: int = 730) -> DataFrame:
    """Checks 19 and 20: a sudden drop and a burst of ratings."""
    valid = ratings.filter(F.col("rating_value").between(1, 5))
    dropped = valid.join(items.filter(F.col("item_name").startswith(s.rating_drop_prefix)).select("item_id"),
                         "item_id", "left_semi")
    drop = mean_shift(dropped, "rating_value", "rating_date", s.rating_drop_window)
    named = ratings.join(items.filter(F.col("item_name") == s.burst_item_name).select("item_id"),
                         "item_id", "left_semi")
    flood = burst(named, "rating_date", s.burst_window, total_days)
    return union_all([
        _rows(drop, [_check(19, "RATING anomaly (sudden drop)", F.col("mean_in_window") < F.col("mean") - 1,
                            F.col("mean_in_window"), F.col("mean"))]),
        _rows(flood, [_check(20, "RATING anomaly (5-star burst)", F.col("in_window") > 4 * F.col("expected"),
                             F.col("in_window"), F.col("expected"))])])


def waste_location_check(prepared: DataFrame, wasted: DataFrame, location: str) -> DataFrame:
    """Check 21: the location with the highest waste ratio is the expected one and far above the median."""
    ratios = observed_waste(prepared, wasted, "location_id")
    top = ratios.agg(F.max_by("location_id", "waste_ratio").alias("worst"),
                     F.max("waste_ratio").alias("top"), F.median("waste_ratio").alias("mid"))
    return _rows(top, [_check(21, "EXTREME wastage location",
                              (F.col("worst") == location) & (F.col("top") > 1.8 * F.col("mid")),
                              F.col("top"), F.col("mid"))])


def order_size_checks(lines: DataFrame, s: PatternSettings) -> DataFrame:
    """Checks 22 and 23: very large orders, and discounts in the unusual range."""
    low, high = s.odd_discounts
    sizes = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if(F.col("discount_pct").between(low, high)).alias("odd"))
    totals = sizes.agg(F.count_if(F.col("n") > s.bulk_lines).alias("bulk"), F.max("n").alias("largest"),
                       F.coalesce(F.sum("odd"), F.lit(0)).alias("odd"))
    return _rows(totals, [
        _check(22, "Very large / bulk orders", F.col("bulk") > 0, F.col("bulk"), F.col("largest")),
        _check(23, "UNUSUAL discounts outside promotions", F.col("odd") > 0, F.col("odd"))])


def defect_check(summary: DataFrame) -> DataFrame:
    """Check 24: every kind of defect occurs."""
    worst = summary.agg(F.min("n_rows").alias("least"), F.count(F.lit(1)).alias("kinds"))
    return _rows(worst, [_check(24, "DATA-QUALITY defects planted", F.col("least") > 0,
                                F.col("least"), F.col("kinds"))])
