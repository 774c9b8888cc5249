"""The sales tables of one folder with the derived tables the queries build on."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import basket, classify, features, forecast, joins, patterns, periods, recommend, segments
from larder.operators.cleaning import SalesCleaning
from larder.session import bound_tasks, configure, settle
from larder.sources.fixtures import SalesTables

# Parameters of the pattern checks on the synthetic tables (dates 1995-2001).
SETTINGS = patterns.PatternSettings(
    start="1995-02-01", end="2001-06-30",
    cases={"loss_making_popular": 0, "hidden_high_margin": 12, "popular_high_wastage": 25,
           "highly_rated_low_margin": 38, "low_rated_high_sales": 51, "promo_dependent": 64,
           "weekend_only": 77, "seasonal": 90, "new_item": 103},
    promo_traps=["P001", "P003", "P005"], new_since="1995-03-01", churned_before="2001-01-01",
    customers_new_since="1996-01-01", collapse_location="L19",
    collapse_window=("1998-11-03", "1998-11-23"), collapse_reference=("1998-10-06", "1998-10-26"),
    rating_drop_prefix="small", rating_drop_window=("1998-08-04", "1998-08-17"),
    burst_item_name="small ring", burst_window=("1998-05-11", "1998-05-16"), waste_location="L15",
    min_units_before=10,
    price_sensitive=[5, 18, 31, 44, 57, 70, 83, 96, 109, 122])


class Sales:
    """The tables and what is derived from them.

    Frames are lazy. The feature tables that later steps read several times (``item_table``,
    ``rfm``, the weekly series, the inputs of the pattern checks) are settled in the
    checkpoint folder first, as a batch chain would write them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = SalesTables(configure(spark), sf_dir)
        self.view = self.tables.view
        bound_tasks(spark, self.tables.base("lineitem").count())  # read from the files' footers

    # --- clean tables
    @cached_property
    def orders(self) -> DataFrame:
        return self.view("fx_orders")

    @cached_property
    def order_items(self) -> DataFrame:
        return self.view("fx_order_items")

    @cached_property
    def items(self) -> DataFrame:
        return self.view("fx_menu_items")

    @cached_property
    def categories(self) -> DataFrame:
        return self.view("fx_menu_categories")

    @cached_property
    def customers(self) -> DataFrame:
        return self.view("fx_customers")

    @cached_property
    def locations(self) -> DataFrame:
        return self.view("fx_restaurants")

    @cached_property
    def ratings(self) -> DataFrame:
        return self.view("fx_ratings")

    @cached_property
    def wastage(self) -> DataFrame:
        return self.view("fx_wastage")

    @cached_property
    def stock_moves(self) -> DataFrame:
        return self.view("fx_stock_moves")

    @cached_property
    def prices(self) -> DataFrame:
        return self.view("fx_pricing_history")

    @cached_property
    def promotions(self) -> DataFrame:
        return self.view("fx_promotions")

    @cached_property
    def cleaning(self) -> SalesCleaning:
        return SalesCleaning(self.tables.raw(), first_date="1990-01-01", last_date="2026-09-28")

    # --- joined and feature tables
    def join_sides(self) -> list[DataFrame]:
        return [self.order_items, self.orders, self.items, self.categories, self.customers, self.locations,
                self.prices, self.ratings]

    @cached_property
    def wide(self) -> DataFrame:
        return joins.wide_lines(*self.join_sides())

    @cached_property
    def line_features(self) -> DataFrame:
        return features.line_features(self.wide)

    @cached_property
    def sales_lines(self) -> DataFrame:
        return features.sales_lines(self.order_items, self.orders)

    @cached_property
    def item_dim(self) -> DataFrame:
        return self.items.select("item_id", "item_name", "brand", "category_id", "base_cost").join(
            self.categories, "category_id", "left")

    @cached_property
    def named_lines(self) -> DataFrame:
        """Sales lines with the item columns that business queries filter and group by."""
        return (self.sales_lines.join(self.item_dim, "item_id", "left")
                .withColumn("line_profit", F.col("net_revenue") - F.col("base_cost") * F.col("quantity")))

    @cached_property
    def item_features(self) -> DataFrame:
        rated = features.sales_lines(self.order_items, self.orders, joins.rating_rollup(self.ratings))
        return features.item_features(rated, self.items, self.categories, self.stock_moves, self.wastage)

    @cached_property
    def item_table(self) -> DataFrame:
        return settle(self.item_features)

    @cached_property
    def rfm(self) -> DataFrame:
        return features.customer_rfm(self.sales_lines)

    # --- labels, segments, models
    @cached_property
    def labelled(self) -> DataFrame:
        return classify.classify_exact(self.item_table)

    @cached_property
    def compared(self) -> DataFrame:
        return classify.compare_labels(classify.classify_approx(self.item_table), self.labelled)

    @cached_property
    def scored(self) -> DataFrame:
        return segments.rfm_scores(self.rfm)

    @cached_property
    def segmented(self) -> DataFrame:
        return segments.rfm_segments(self.scored)

    @cached_property
    def brand_lines(self) -> DataFrame:
        """Lines with the brand as the item of the basket."""
        brand = self.items.select("item_id", "brand")
        return (self.sales_lines.join(brand, "item_id", "left")
                .select("order_id", F.col("brand").alias("item_id"), "is_completed"))

    @cached_property
    def itemsets(self) -> DataFrame:
        return basket.frequent_itemsets(self.brand_lines, min_support=0.01)

    @cached_property
    def rules(self) -> DataFrame:
        names = self.items.select(F.col("brand").alias("item_id"), F.concat(F.lit("Brand "), F.split_part(
            "brand", F.lit("#"), F.lit(2))).alias("item_name")).distinct()
        return basket.name_rules(basket.association_rules(self.itemsets, min_lift=1.0), names)

    @cached_property
    def weekly(self) -> DataFrame:
        return forecast.weekly_demand(self.named_lines)

    def period_table(self, name: str) -> DataFrame:
        """One of the weekly and daily tables, summed by its own keys only."""
        totals = periods.period_totals(self.named_lines, [name])
        names = {"weekly_item": (self.items, "item_id", "item_name"), "weekly_category": (self.categories, "category_id", "category_name"),
                 "weekly_location": (self.locations, "location_id", "restaurant_name")}
        if name not in names:
            return {"daily_location": periods.daily_location, "daily_item": periods.daily_item}[name](totals)
        table, key, text = names[name]
        return periods.weekly_series(totals, name, table.select(F.col(key).alias("entity_id"), F.col(text).alias("entity_name")))

    @cached_property
    def series(self) -> DataFrame:
        return forecast.split_series(settle(self.weekly))

    @cached_property
    def metrics(self) -> DataFrame:
        return forecast.forecast_metrics(self.series)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.forecast_rows(self.series)

    def recommendations(self, risk: DataFrame | None = None) -> DataFrame:
        return recommend.combine([
            *recommend.item_rules(self.labelled, risk), recommend.bundle_rule(self.rules),
            recommend.stock_rule(self.forecast), recommend.segment_rules(self.segmented)])

    # --- inputs of the pattern checks, measured on the raw tables
    @cached_property
    def checked_orders(self) -> DataFrame:
        return settle(patterns.valid_orders(
            self.view("raw_orders"), self.locations, SETTINGS.start, SETTINGS.end))

    @property
    def read_lines(self) -> DataFrame:
        return patterns.valid_lines(self.view("raw_order_items"), self.checked_orders, self.items)

    @property
    def study_lines(self) -> DataFrame:
        """The checked lines for a query that reads them once."""
        return patterns.checked_lines(self.read_lines, self.checked_orders, self.items)

    @cached_property
    def ordered_lines(self) -> DataFrame:
        """The valid lines with their orders, written once for the checks on all lines and those on completed ones."""
        return settle(patterns.ordered_lines(self.view("raw_order_items"), self.checked_orders, self.items), "ordered-lines")

    @property
    def valid_lines(self) -> DataFrame:
        return patterns.once_each(self.ordered_lines)

    @property
    def checked_lines(self) -> DataFrame:
        return patterns.completed(self.ordered_lines)

    @cached_property
    def checked_waste(self) -> DataFrame:
        """Valid wasted units per item and location; the checks only sum them further."""
        valid = (self.view("raw_wastage").filter(F.col("quantity_wasted").between(1, 1000))
                 .join(self.locations.select("location_id"), "location_id", "left_semi")
                 .join(self.items.select("item_id"), "item_id", "left_semi"))
        return settle(valid.groupBy("item_id", "location_id").agg(F.sum("quantity_wasted").alias("quantity_wasted")))

    @cached_property
    def checked_stock(self) -> DataFrame:
        """Prepared units per item and known location."""
        valid = self.view("raw_inventory").join(self.locations.select("location_id"), "location_id", "left_semi")
        return settle(valid.groupBy("item_id", "location_id").agg(F.sum("prepared_qty").alias("prepared_qty")))


class CleanedSales(Sales):
    """The same results from eleven raw tables, whatever source they come from: cleaned, joined, then aggregated.

    ``raw`` maps the table names to frames, read by ``larder.sources.io.read_all_raw`` from CSV or from anywhere
    else. Dates may be text. The cleaned orders and lines are settled, as every later step reads them.
    """

    def __init__(self, raw: dict[str, DataFrame], **dates: str):
        self.cleaning = SalesCleaning(raw, **dates)

    def _dated(self, table: str, *columns: str) -> DataFrame:
        frame = self.cleaning.clean(table)
        return frame.withColumns({c: F.to_date(c) for c in columns if c in frame.columns})

    @cached_property
    def orders(self) -> DataFrame:
        return settle(self._dated("orders", "order_date"), "clean-orders")

    @cached_property
    def order_items(self) -> DataFrame:
        return settle(self.cleaning.clean("order_items"), "clean-lines")

    @cached_property
    def items(self) -> DataFrame:
        return self._dated("menu_items", "introduced_date")

    @cached_property
    def categories(self) -> DataFrame:
        return self.cleaning.clean("menu_categories")

    @cached_property
    def customers(self) -> DataFrame:
        return self._dated("customers", "signup_date")

    @cached_property
    def locations(self) -> DataFrame:
        return self.cleaning.clean("restaurants")

    @cached_property
    def ratings(self) -> DataFrame:
        return self._dated("ratings", "rating_date")

    @cached_property
    def wastage(self) -> DataFrame:
        return self._dated("wastage", "waste_date")

    @cached_property
    def stock_moves(self) -> DataFrame:
        return self._dated("inventory", "week_start")

    @cached_property
    def prices(self) -> DataFrame:
        return self._dated("pricing_history", "effective_from", "effective_to")

    @cached_property
    def promotions(self) -> DataFrame:
        return self._dated("promotions", "start_date", "end_date")
