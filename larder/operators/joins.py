"""The wide order-line table, its join audit, and interval joins on prices and promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import settle
from larder.sources.io import union_all


def price_rollup(prices: DataFrame) -> DataFrame:
    """One row per item: latest and first price, and how often the price changed.

    Equal dates are ordered by price, so the choice does not depend on row order.
    """
    dated = F.struct("effective_from", "price")
    return prices.groupBy("item_id").agg(
        F.max(dated)["price"].alias("current_price"),
        F.min(dated)["price"].alias("first_price"),
        (F.count(F.lit(1)) - 1).alias("price_changes"))


def rating_rollup(ratings: DataFrame) -> DataFrame:
    """Average rating per order and item, rounded to two places, and the number of ratings."""
    return ratings.groupBy("order_id", "item_id").agg(
        F.round(F.avg("rating_value"), 2).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"))


def wide_lines(lines: DataFrame, orders: DataFrame, items: DataFrame, categories: DataFrame,
               customers: DataFrame, locations: DataFrame, prices: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every order line with everything known about it; no line is lost.

    Small sides are joined to each other first (orders with customers and locations, items
    with categories), so the line table is shuffled once per large key and while narrow.
    Join strategies are left to Spark, which broadcasts a side only when its size allows.
    """
    order_side = (
        orders.select("order_id", "customer_id", "location_id", "order_datetime", "order_date", "channel",
                      "payment_method", "status")
        .join(customers.select("customer_id", F.col("home_city").alias("customer_city"), "age_bracket",
                               "signup_date"), "customer_id", "left")
        .join(locations.select("location_id", "restaurant_name", F.col("city").alias("location_city"), "area"),
              "location_id", "left"))
    item_side = (
        items.select("item_id", "item_name", "category_id", "base_cost", "is_active", "introduced_date")
        .join(categories.select("category_id", "category_name"), "category_id", "left"))
    return (lines
            .join(rating_rollup(ratings), ["order_id", "item_id"], "left")
            .join(item_side, "item_id", "left")
            .join(price_rollup(prices), "item_id", "left")
            .join(order_side, "order_id", "left")
            .select(*lines.columns,
                    "customer_id", "location_id", "order_datetime", "order_date", "channel", "payment_method",
                    "status", "item_name", "category_id", "base_cost", "is_active", "introduced_date",
                    "category_name", "customer_city", "age_bracket", "signup_date", "restaurant_name",
                    "location_city", "area", "current_price", "first_price", "price_changes", "avg_rating",
                    "n_ratings"))


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values that occur on more than one row."""
    return (frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("n_duplicate_keys")))


def audit_step(step: str, step_no: int, left: DataFrame, right: DataFrame, keys: list[str],
               full_match: bool = True) -> DataFrame:
    """Row counts a left join would give, without running it on the rows.

    Both sides are counted per key first; the joined key counts give rows before and after,
    unmatched rows and duplicate keys. A hot key is one row here.
    """
    n_left = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    n_right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    # keys with a NULL part never match, but their rows count
    joined = n_left.join(n_right, keys, "left")
    matched = F.coalesce(F.col("n_right"), F.lit(1))
    totals = joined.agg(
        _count(F.col("n_left")).alias("rows_before"), _count(F.col("n_left") * matched).alias("rows_after"),
        _count(F.when(F.col("n_right").isNull(), F.col("n_left"))).alias("unmatched"))
    return _audit_row(totals, step, step_no, keys, duplicate_keys(right, keys).scalar(), full_match)


def _count(rows: Column) -> Column:
    return F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")


def _audit_row(totals: DataFrame, step: str, step_no: int, keys: list[str], duplicates: Column, full_match: bool) -> DataFrame:
    """The report of one step from its row counts and the number of keys its right side has more than once."""
    grown = F.col("rows_after") - F.col("rows_before")
    flags = [F.when(grown > 0, F.format_string("BALLOON (+%,d rows)", grown))]
    if full_match:
        flags.append(F.when(F.col("unmatched") > 0,
                            F.format_string("UNMATCHED (%,d rows found no partner)", F.col("unmatched"))))
    text = F.concat_ws(", ", *flags)
    return totals.select(
        F.lit(step_no).alias("step_no"), F.lit(step).alias("step"), F.lit(", ".join(keys)).alias("join_key"),
        "rows_before", "rows_after", duplicates.cast("bigint").alias("duplicate_keys"), "unmatched",
        F.when(text == "", F.lit("ok")).otherwise(text).alias("result"))


def _partners(frame: DataFrame, key: str, name: str) -> DataFrame:
    """How many rows each value of the key has."""
    return frame.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _met(count: str) -> Column:
    """What a left join multiplies a row by, given the number of its partners."""
    return F.coalesce(F.col(count), F.lit(1))


def join_audit(lines: DataFrame, orders: DataFrame, items: DataFrame, categories: DataFrame,
               customers: DataFrame, locations: DataFrame, prices: DataFrame, ratings: DataFrame) -> DataFrame:
    """One audit row per step of the wide join, from counts that multiply instead of rows that are joined.

    After any step, the rows that come from one line are a product: what its item brings (items, their categories,
    prices) times what its order brings (orders, their customers and locations) times its ratings. So the lines are
    read once and counted per order and item, weighed by their item, summed per order, and weighed by their order. A key
    that is missing on the right, or NULL, keeps its row with weight one and counts as unmatched.
    """
    by_category = _partners(categories, "category_id", "n")
    by_customer, by_location = _partners(customers, "customer_id", "n_customers"), _partners(locations, "location_id", "n_locations")
    # per item: rows of the item, rows once categories are met, those that met none, and whether a price is known
    per_item = (items.select("item_id", "category_id").join(by_category, "category_id", "left").groupBy("item_id")
                .agg(F.count(F.lit(1)).alias("n_items"), F.sum(_met("n")).alias("n_categories"), F.count_if(F.col("n").isNull()).alias("no_category"))
                .join(prices.select("item_id").distinct().withColumn("priced", F.lit(1)), "item_id", "full"))
    met_both = _met("n_customers") * _met("n_locations")
    per_order = (orders.select("order_id", "customer_id", "location_id").join(by_customer, "customer_id", "left")
                 .join(by_location, "location_id", "left").groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(_met("n_customers")).alias("to_customers"),
                      F.count_if(F.col("n_customers").isNull()).alias("no_customer"), F.sum(met_both).alias("to_locations"),
                      F.sum(F.when(F.col("n_locations").isNull(), _met("n_customers")).otherwise(0)).alias("no_location")))
    rated = ratings.select("order_id", "item_id").distinct().withColumn("rated", F.lit(1))
    counted = lines.groupBy("order_id", "item_id").agg(F.count(F.lit(1)).alias("n")).join(rated, ["order_id", "item_id"], "left")
    named = F.col("n") * _met("n_categories")  # an item without a row in ``items`` has no counts, so its weight is one
    sums = counted.join(per_item, "item_id", "left").groupBy("order_id").agg(
        F.sum("n").alias("lines"), F.sum(F.col("n") * _met("n_items")).alias("itemed"), F.sum(named).alias("named"),
        F.sum(F.when(F.col("n_items").isNull(), F.col("n")).otherwise(0)).alias("no_item"),
        F.sum(F.col("n") * F.coalesce(F.col("no_category"), F.lit(1))).alias("no_category"),
        F.sum(F.when(F.col("priced").isNull(), named).otherwise(0)).alias("no_price"),
        F.sum(F.when(F.col("rated").isNull(), named).otherwise(0)).alias("no_rating"))
    one = lambda name: F.coalesce(F.col(name), F.lit(1))
    ordered, to_customers, to_locations = one("n_orders"), one("to_customers"), one("to_locations")
    after = [F.col("lines"), F.col("lines") * ordered, F.col("itemed") * ordered, F.col("named") * ordered,
             F.col("named") * to_customers, *[F.col("named") * to_locations] * 3]  # prices and ratings have one row a key
    unmatched = [F.when(F.col("n_orders").isNull(), F.col("lines")).otherwise(0), F.col("no_item") * ordered,
                 F.col("no_category") * ordered, F.col("named") * one("no_customer"), F.col("named") * one("no_location"),
                 F.col("no_price") * to_locations, F.col("no_rating") * to_locations]
    joined = sums.join(per_order, "order_id", "left")
    totals = settle(joined.agg(*[_count(c).alias(f"after{i}") for i, c in enumerate(after)],
                               *[_count(c).alias(f"unmatched{i}") for i, c in enumerate(unmatched, 1)]), "audit-totals")

    def repeated(frame: DataFrame, key: str) -> Column:
        return duplicate_keys(frame, [key]).scalar()

    steps = [("orders", ["order_id"], repeated(orders, "order_id"), True), ("menu_items", ["item_id"], repeated(items, "item_id"), True),
             ("menu_categories", ["category_id"], repeated(categories, "category_id"), True),
             ("customers", ["customer_id"], repeated(customers, "customer_id"), True),
             ("restaurants", ["location_id"], repeated(locations, "location_id"), True),
             ("pricing", ["item_id"], F.lit(0), True), ("ratings", ["order_id", "item_id"], F.lit(0), False)]
    return union_all([
        _audit_row(totals.select(F.col(f"after{i - 1}").alias("rows_before"), F.col(f"after{i}").alias("rows_after"),
                                 F.col(f"unmatched{i}").alias("unmatched")), step, i, keys, duplicates, full_match)
        for i, (step, keys, duplicates, full_match) in enumerate(steps, 1)])


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in against rows out."""
    n_after = after.agg(F.count(F.lit(1)).alias("value")).scalar()
    return before.agg(F.count(F.lit(1)).alias("rows_in")).select(
        "rows_in", n_after.alias("rows_out"), (F.col("rows_in") == n_after).alias("unchanged"))


def rows_with_partner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_semi")


def rows_without_partner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")


def price_as_of(dated_lines: DataFrame, prices: DataFrame, date_column: str = "order_date") -> DataFrame:
    """Each line with the listed price valid on its date and whether the charged price equals it.

    Price intervals are cut into the months they touch, so that the lookup is an equality join on item and month
    over the distinct days an item was sold. An interval without end is open; where intervals overlap, the one that
    started last applies (of equal starts, the higher price); one that ends before it starts never applies.
    """
    date = F.col(date_column)
    month = F.trunc(date, "month").alias("_month")
    days = dated_lines.select("item_id", date).distinct()
    last = days.agg(F.max(date).alias("value")).scalar()
    until = F.coalesce("effective_to", F.greatest(last, F.col("effective_from")))
    months = prices.filter(F.col("effective_from") <= until).select(
        "item_id", "price", "effective_from", until.alias("_until"),
        F.explode(F.sequence(F.trunc("effective_from", "month"), until, F.expr("interval 1 month"))).alias("_month"))
    listed = (days.withColumn("_month", month).join(months, ["item_id", "_month"])
              .filter((F.col("effective_from") <= date) & (date <= F.col("_until")))
              .groupBy("item_id", date).agg(F.max_by("price", F.struct("effective_from", "price")).alias("listed_price")))
    return (dated_lines.join(listed, ["item_id", date_column], "left").select(*dated_lines.columns, "listed_price")
            .withColumn("price_matches", F.col("unit_price") == F.col("listed_price")))


def _promotion_days(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Promotions with a row per day they run. Without an end they run until the last order, and those that end
    before they start never run."""
    last = orders.agg(F.max("order_date").alias("value")).scalar()
    until = F.coalesce("end_date", F.greatest(last, F.col("start_date")))
    return (promotions.filter(F.col("start_date") <= until).withColumnRenamed("location_id", "promo_location")
            .withColumn("order_date", F.explode(F.sequence("start_date", until))))


def active_promotions(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Promotions running on the day and at the place of each order.

    A promotion is expanded to its days, which turns the date interval into an equality.
    """
    days = _promotion_days(orders, promotions).select("promo_id", "discount_pct", "promo_location", "order_date")
    here = F.col("promo_location").isin("ALL") | (F.col("promo_location") == F.col("location_id"))
    return (orders.select("order_id", "location_id", "order_date").join(days, "order_date")
            .filter(here).select("order_id", "location_id", "order_date", "promo_id", "discount_pct"))


def active_promotion_items(lines: DataFrame, orders: DataFrame, items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Lines with every promotion that runs on their day, at their place, and covers their item, whether used or not."""
    terms = promotions.select("promo_id", "scope", "applicable_items", F.col("category_id").alias("promo_category"))
    running = active_promotions(orders, promotions).join(terms, "promo_id")
    return (lines.select("order_id", "item_id", "line_no").join(items.select("item_id", "category_id"), "item_id", "left")
            .join(running, "order_id")
            .filter(F.coalesce(_covers(), F.lit(False)))
            .select("order_id", "item_id", "line_no", "promo_id", "scope", "discount_pct"))


def promotion_items(promotions: DataFrame) -> DataFrame:
    """The item list of item-scoped promotions, one row per promotion and item id (as text)."""
    return (promotions.filter(F.col("scope") == "ITEM")
            .select("promo_id", F.explode(F.split("applicable_items", r"\|")).alias("item_id")))


def _covers() -> Column:
    listed = F.array_contains(F.split("applicable_items", r"\|"), F.col("item_id").cast("string"))
    return (F.when(F.col("scope") == "ITEM", listed)
            .when(F.col("scope") == "CATEGORY", F.col("category_id") == F.col("promo_category"))
            .otherwise(F.lit(True)))


def promotion_coverage(lines: DataFrame, orders: DataFrame, items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Lines of promotion orders, whether the promotion covers the item, and the discount it grants."""
    terms = promotions.select("promo_id", "scope", "applicable_items",
                              F.col("category_id").alias("promo_category"),
                              F.col("discount_pct").alias("promo_discount"))
    used = orders.filter(F.col("promo_id").isNotNull()).select("order_id", "promo_id").join(terms, "promo_id")
    covered = F.coalesce(_covers(), F.lit(False))
    return (lines.join(used, "order_id").join(items.select("item_id", "category_id"), "item_id", "left")
            .select("order_id", "item_id", "line_no", "promo_id", covered.alias("covered"),
                    F.when(covered, F.col("promo_discount")).otherwise(F.lit(0.0)).alias("granted_discount")))
