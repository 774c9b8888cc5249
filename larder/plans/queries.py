"""The query registry: every operator on the tables of one folder.

Each entry takes (spark, folder) and returns a lazy frame with a fixed schema. Dates are
rendered as ISO text at this border so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import rounded
from larder.functions.fixed import CONTRACTS, Q_ORPHAN_LINE, Q_ORPHAN_RATING, Q_UNKNOWN_ITEM, RAW_SCHEMAS
from larder.operators import (
    basket, business, classify, cleaning, features, forecast, joins, patterns, periods, quality, recommend, risk, scenarios,
    segments,
)
from larder.plans.sales import SETTINGS, CleanedSales, Sales
from larder.session import scratch_root, settle
from larder.sources import io
from larder.sources.io import union_all

MINIMUMS = {"menu_items": 150, "restaurants": 20, "customers": 1000, "orders": 10000, "order_items": 50000,
            "ratings": 10000, "inventory": 20000, "wastage": 5000}
PRICE_GRID = [{"price_change_pct": p, "elasticity": e} for p in (-10, 10, 25) for e in (0.5, 1.5, 3.0)]
DISCOUNT_GRID = [{"discount_change": d, "lift_per_point": e} for d in (-10, 5, 15) for e in (0.5, 1.5)]
PREP_GRID = [{"prep_change_pct": p} for p in (-50, -20, 20)]

REGISTRY: dict[str, Callable[[Sales], DataFrame]] = {}


def query(build: Callable[[Sales], DataFrame]) -> Callable[[Sales], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def presentable(frame: DataFrame) -> DataFrame:
    """Dates as ISO text."""
    return frame.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in frame.schema])


def to_places(frame: DataFrame, places: int, *names: str) -> DataFrame:
    return frame.withColumns({n: rounded(F.col(n), places) for n in names})


def _scratch(s: Sales, name: str) -> str:
    spark = s.tables.spark
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks

@query
def ingest_profile(s):
    return io.ingest_profile(s.tables.raw())


@query
def row_minimums(s):
    return io.row_minimums(s.tables.raw(), MINIMUMS)


@query
def write_and_verify(s):
    return union_all([
        io.write_and_verify(s.item_features, _scratch(s, "items"), "item_features"),
        io.write_and_verify(s.rfm, _scratch(s, "rfm"), "customer_rfm")])


def _csv_columns(frame: DataFrame, table: str, **changed: Column) -> DataFrame:
    """The declared columns of a raw table; those the frame lacks are empty."""
    names = [f.name for f in T.StructType.fromDDL(RAW_SCHEMAS[table])]
    return frame.select(*[changed.get(n, F.col(n) if n in frame.columns else F.lit(None).cast("string")).alias(n) for n in names])


def _line_id() -> Column:
    return F.concat_ws("-", F.lit("L"), "order_id", "line_no")


@query
def csv_rescan(s):
    """Order lines written as monthly CSV folders and scanned back together with the declared schema."""
    root = _scratch(s, "csv")
    month = F.date_format("order_date", "yyyy_MM")
    lines = s.order_items.join(s.orders.select("order_id", month.alias("month")), "order_id")
    columns = [f.name for f in T.StructType.fromDDL(RAW_SCHEMAS["order_items"])]
    io.write_csv(lines.withColumn("order_item_id", _line_id()).select(*columns, "month"), io.raw_path(root, "order_items"), ["month"])
    back = io.read_raw(s.tables.spark, root, "order_items")
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity"),
                    F.round(F.sum(F.col("line_total").cast("decimal(18,2)")), 2).cast("double").alias("line_total"))


@query
def quarantine(s):
    """Raw lines and ratings written as CSV, some numbers with a unit, scanned back, cleaned, and the rejects kept."""
    root, kept, spark = _scratch(s, "raw"), _scratch(s, "quarantine"), s.tables.spark
    raw = s.tables.raw()

    def with_unit(name: str, unit: str, when: Column) -> Column:
        return F.concat(F.col(name).cast("string"), F.when(when, unit).otherwise(""))

    spoilt = {"order_items": {"order_item_id": _line_id(), "quantity": with_unit("quantity", " pcs", F.col("order_id") % 97 == 5)},
              "ratings": {"rating_value": with_unit("rating_value", " stars", F.col("order_id") % 89 == 3)}}
    for table, changed in spoilt.items():
        io.write_csv(_csv_columns(raw[table], table, **changed), io.raw_path(root, table))
    cleaner = cleaning.SalesCleaning(raw | {t: io.read_raw(spark, root, t, io.MALFORMED) for t in spoilt},
                                     first_date="1990-01-01", last_date="2026-09-28")
    for table in spoilt:
        io.write_quarantine(cleaning.rejected(cleaner.audit(table)), kept, table)
    return io.read_quarantine(spark, kept).groupBy("table_name", "rule").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_copies").alias("n_copies"))


# --- quality

@query
def dq_row_counts(s):
    return quality.row_counts(s.tables.raw())


@query
def dq_duplicates(s):
    return quality.duplicate_counts(s.tables.raw())


@query
def dq_nulls(s):
    return quality.null_profiles(s.tables.raw())


@query
def dq_rules(s):
    return quality.quality_rules(s.tables.raw(), as_of=F.lit("2026-12-31").cast("date"), first_date="1990-01-01")


@query
def dq_referential(s):
    lines, ratings, orders = s.view("raw_order_items"), s.view("raw_ratings"), s.view("raw_orders")
    return union_all([
        quality.unmatched_rows(lines, s.items, "item_id", Q_UNKNOWN_ITEM, "order_items", skip_null=True),
        quality.unmatched_rows(lines, orders, "order_id", Q_ORPHAN_LINE, "order_items"),
        quality.unmatched_rows(ratings, orders, "order_id", Q_ORPHAN_RATING, "ratings")])


@query
def dq_defect_summary(s):
    return quality.defect_summary(s.view("raw_orders"), s.view("raw_order_items"), s.view("raw_ratings"),
                                  s.view("raw_wastage"))


# --- cleaning

def _clean(table: str):
    def build(s: Sales) -> DataFrame:
        return s.cleaning.clean(table)
    REGISTRY[f"clean_{table}"] = build


for _table in ("orders", "order_items", "ratings", "wastage", "inventory", "customers"):
    _clean(_table)


@query
def clean_summary(s):
    return s.cleaning.summary().select("table_name", "rule_no", "rule", "removed")


@query
def clean_row_counts(s):
    return s.cleaning.row_counts()


@query
def clean_rejects_orders(s):
    return cleaning.rejected(s.cleaning.audit("orders")).select("order_id", "first_failed_rule", "n_copies")


@query
def clean_rejects_order_items(s):
    return cleaning.rejected(s.cleaning.audit("order_items")).select(
        "order_id", "item_id", "line_no", "first_failed_rule", "n_copies")


@query
def clean_rejects_ratings(s):
    return cleaning.rejected(s.cleaning.audit("ratings")).select("order_id", "item_id", "first_failed_rule", "n_copies")


@query
def clean_rejects_wastage(s):
    return cleaning.rejected(s.cleaning.audit("wastage")).select(
        "item_id", "location_id", "waste_date", "first_failed_rule", "n_copies")


@query
def clean_rejects_inventory(s):
    return cleaning.rejected(s.cleaning.audit("inventory")).select(
        "item_id", "location_id", "week_start", "first_failed_rule", "n_copies")


@query
def cleaned_item_revenue(s):
    """From raw tables through cleaning and joining to revenue per item."""
    lines = features.sales_lines(s.cleaning.clean("order_items"), s.cleaning.clean("orders").withColumn(
        "order_date", F.to_date("order_date")))
    return (features.item_sales(lines).withColumn("net_revenue", F.round("net_exact", 2).cast("double"))
            .select("item_id", "total_quantity_sold", "n_orders", "net_revenue", "avg_discount_pct",
                    "weekend_share"))


def _chain(s: Sales) -> CleanedSales:
    return CleanedSales(s.tables.raw(), first_date="1990-01-01", last_date="2026-09-28")


@query
def chain_item_features(s):
    """Item features from raw tables through cleaning and joining."""
    return io.require_contract(_chain(s).item_features, "item_features")


@query
def chain_customer_rfm(s):
    return io.require_contract(_chain(s).rfm, "customer_rfm")


@query
def chain_labels(s):
    """Exact-median labels of the items, from raw tables."""
    return _chain(s).labelled.select("item_id", "total_quantity_sold", "profit_margin", "python_label")


# --- joins

@query
def join_wide(s):
    return s.wide.withColumn("order_datetime", F.col("order_datetime").cast("string"))


@query
def join_audit(s):
    return joins.join_audit(*s.join_sides())


@query
def join_audit_raw(s):
    """The audit on uncleaned tables, where steps grow and rows stay without a partner."""
    raw = s.tables.raw()
    return joins.join_audit(raw["order_items"], raw["orders"], raw["menu_items"], raw["menu_categories"],
                            raw["customers"], raw["restaurants"], raw["pricing_history"], raw["ratings"])


@query
def join_reconcile(s):
    return joins.reconcile(s.order_items, s.wide)


@query
def duplicate_keys(s):
    def row(name, frame, keys):
        return joins.duplicate_keys(frame, keys).select(F.lit(name).alias("table_name"), "n_duplicate_keys")
    return union_all([row("pricing_history", s.prices, ["item_id"]),
                      row("ratings", s.ratings, ["order_id", "item_id"])])


@query
def price_rollup(s):
    return joins.price_rollup(s.prices)


@query
def rating_rollup(s):
    return joins.rating_rollup(s.ratings)


@query
def semi_anti(s):
    """Customers with and without an order."""
    def row(name, frame):
        return frame.agg(F.count(F.lit(1)).alias("n_customers")).select(F.lit(name).alias("kind"), "n_customers")
    return union_all([row("with order", joins.rows_with_partner(s.customers, s.orders, ["customer_id"])),
                      row("without order", joins.rows_without_partner(s.customers, s.orders, ["customer_id"]))])


@query
def price_as_of(s):
    dated = s.order_items.select("order_id", "item_id", "line_no", "unit_price").join(
        s.orders.select("order_id", "order_date"), "order_id")
    return joins.price_as_of(dated, s.prices)


@query
def promo_active(s):
    return joins.active_promotions(s.orders, s.promotions)


@query
def promo_active_items(s):
    return joins.active_promotion_items(s.order_items, s.orders, s.items, s.promotions)


@query
def promo_coverage(s):
    return joins.promotion_coverage(s.order_items, s.orders, s.items, s.promotions)


@query
def promo_items(s):
    """Item-scoped promotions with the lines that sold their items."""
    listed = joins.promotion_items(s.promotions)
    sold = s.order_items.select(F.col("item_id").cast("string").alias("item_id"), "quantity")
    return listed.join(sold, "item_id").groupBy("promo_id", "item_id").agg(F.sum("quantity").alias("units"))


# --- features

@query
def line_features(s):
    return to_places(s.line_features, 6, "net_revenue", "line_cost", "line_profit")


@query
def status_histogram(s):
    return features.status_histogram(s.orders)


@query
def item_features(s):
    return s.item_features


@query
def customer_rfm(s):
    return s.rfm


@query
def coverage(s):
    return features.coverage(s.rfm, s.customers, s.item_features, s.items)


@query
def null_sanity(s):
    return quality.null_profile(s.item_features, "item_features", complete=True)


@query
def waste_ratio_item(s):
    return features.waste_ratio(s.stock_moves, s.wastage, "item_id")


@query
def waste_ratio_location(s):
    return features.observed_waste(s.stock_moves, s.wastage, "location_id")


@query
def line_total_check(s):
    return features.line_total_mismatches(s.order_items).select(
        "order_id", "item_id", "line_no", "line_total", "expected_total")


@query
def merged_lines(s):
    return features.merged_lines(s.order_items)


@query
def weekly_consumption(s):
    return features.weekly_consumption(s.sales_lines, "1995-01-01")


@query
def stock_roll_forward(s):
    return features.stock_roll_forward(s.stock_moves).select(
        "item_id", "location_id", "week_start", "opening_stock", "closing_stock")


@query
def near_duplicate_orders(s):
    return features.near_duplicate_orders(s.view("fx_orders_repeated"), s.view("fx_order_items_repeated"))


# --- classification

@query
def classify_approx(s):
    return classify.classify_approx(s.item_table)


@query
def classify_exact(s):
    return s.labelled


@query
def thresholds_approx(s):
    return classify.approx_medians(s.item_features)


@query
def thresholds_exact(s):
    return to_places(classify.exact_medians(s.item_features), 6, "median_margin", "median_units")


@query
def label_counts(s):
    return classify.label_counts(s.labelled, "python_label")


@query
def label_comparison(s):
    return s.compared


@query
def label_agreement(s):
    return classify.agreement(s.compared)


@query
def label_disagreements(s):
    return classify.disagreements(s.compared)


@query
def label_distribution(s):
    return classify.label_distribution(s.compared)


@query
def named_cases(s):
    return classify.named_cases(s.view("fx_cases"), s.compared)


def _places(s: Sales) -> DataFrame:
    rated = features.sales_lines(s.order_items, s.orders, joins.rating_rollup(s.ratings))
    lines = rated.join(s.items.select("item_id", "base_cost"), "item_id", "left").withColumn(
        "line_profit", F.col("net_revenue") - F.col("base_cost") * F.col("quantity"))
    return classify.item_location_features(lines, s.stock_moves, s.wastage)


@query
def item_location_features(s):
    return _places(s)


@query
def multi_indicator_label(s):
    return classify.multi_indicator_label(_places(s)).select("item_id", "location_id", "rule_label")


@query
def split_bucket(s):
    return classify.split_bucket(s.stock_moves.select("item_id", "location_id").distinct(), ["item_id", "location_id"])


@query
def label_confusion(s):
    return classify.confusion_counts(s.compared, "python_label", "spark_label")


@query
def label_metrics(s):
    """Metrics of a label by margin alone against the exact label."""
    guess = s.labelled.withColumn("guess", F.when(F.col("profit_margin") >= 0.3, F.lit("Profit Driver"))
                                  .otherwise(F.lit("Low Performer")))
    return classify.classification_metrics(guess, "python_label", "guess")


@query
def regression_metrics(s):
    """Test weeks of the demand forecast: units against the trend."""
    tested = s.forecast.filter(F.col("row_type") == "test")
    return classify.regression_metrics(tested, "actual_quantity", "forecast_quantity")


# --- customers

@query
def recency_profile(s):
    return segments.recency_profile(s.rfm)


@query
def rfm_scores(s):
    return s.scored


@query
def rfm_segments(s):
    return s.segmented.select("customer_id", "segment")


@query
def segment_counts(s):
    return segments.segment_counts(s.segmented)


@query
def customer_profile(s):
    return segments.customer_profile(s.sales_lines, s.rfm, s.orders)


@query
def population_quantiles(s):
    profile = settle(segments.customer_profile(s.sales_lines, s.rfm, s.orders))
    q = segments.population_quantiles(profile)
    return to_places(q, 4, *q.columns)


@query
def named_segments(s):
    profile = settle(segments.customer_profile(s.sales_lines, s.rfm, s.orders))
    return segments.named_segments(profile).select("customer_id", "segment_name")


# --- baskets

def _joined(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.concat_ws(",", n) for n in names})


@query
def basket_split(s):
    return basket.basket_split(s.brand_lines)


@query
def baskets(s):
    return _joined(basket.baskets(basket.basket_items(s.brand_lines)), "items")


@query
def frequent_itemsets(s):
    return to_places(_joined(s.itemsets, "items"), 6, "support")


@query
def association_rules(s):
    return to_places(_joined(s.rules, "antecedents", "consequents"), 6, "support", "confidence", "lift")


@query
def top_rules(s):
    return to_places(_joined(basket.top_rules(s.rules), "antecedents", "consequents"),
                     6, "support", "confidence", "lift")


# --- waste risk

def _risk(s: Sales):
    return risk.score_waste_risk(s.labelled, risk.fit_waste_risk(s.item_table))


@query
def waste_risk_dropped(s):
    return risk.dropped_without_target(s.item_features)


@query
def waste_risk_scores(s):
    return to_places(risk.top_predicted(_risk(s)), 6, "predicted_wastage_risk")


@query
def waste_risk_importance(s):
    return risk.importances(s.item_table, risk.fit_waste_risk(s.item_table))


# --- forecast

@query
def weekly_demand(s):
    return s.weekly


@query
def weekly_demand_location(s):
    return forecast.weekly_demand(s.named_lines, "location_id")


@query
def forecast_metrics_location(s):
    weekly = settle(forecast.weekly_demand(s.named_lines, "location_id"))
    return to_places(forecast.forecast_metrics(forecast.split_series(weekly, "location_id"), "location_id"), 4, *METRIC_COLUMNS)


def _period_query(name: str) -> None:
    def build(s):
        return io.require_contract(s.period_table(name), name)

    build.__name__ = name
    query(build)


for _name in periods.SERIES:
    _period_query(_name)


@query
def contract_fill(s):
    """How well the columns that the contracts demand are filled."""
    return union_all([quality.null_profile(io.require_contract(t, n).select(*CONTRACTS[n]), n, complete=True)
                      for n, t in (("item_features", s.item_features), ("customer_rfm", s.rfm))])


@query
def demand_extent(s):
    return forecast.demand_extent(s.weekly)


@query
def forecast_series_split(s):
    return s.series


METRIC_COLUMNS = ("mae_baseline", "mae_model", "rmse_model", "mape_model_pct")


@query
def forecast_metrics(s):
    return to_places(s.metrics, 4, *METRIC_COLUMNS)


@query
def forecast_wins(s):
    return forecast.forecast_wins(s.metrics)


@query
def forecast_bands(s):
    return forecast.forecast_bands(s.metrics).select("category_name", "usefulness")


@query
def forecast_rows(s):
    return to_places(s.forecast, 4, "forecast_quantity")


@query
def forecast_series(s):
    return to_places(forecast.forecast_series(s.forecast, "Promo"), 4, "quantity")


@query
def forecast_metric_lookup(s):
    return to_places(business.metric_lookup(s.metrics, "Promo"), 4,
                     "mae_baseline", "mae_model", "mae_delta", "rmse_model")


# --- recommendations

@query
def recommendation_thresholds(s):
    t = recommend.thresholds(s.labelled)
    return to_places(t, 6, *t.columns)


@query
def recommendations(s):
    """All rules without the model score, which SQL cannot reproduce."""
    return s.recommendations()


@query
def recommendations_with_risk(s):
    return s.recommendations(_risk(s))


@query
def recommendation_counts(s):
    return recommend.recommendation_counts(s.recommendations())


@query
def recommendation_evidence(s):
    return recommend.evidence(s.recommendations())


@query
def urgent_recommendations(s):
    return recommend.urgent(s.recommendations())


@query
def recommendations_by_priority(s):
    chosen = recommend.by_priority(s.recommendations(), ["Critical", "Medium"])
    return recommend.recommendation_counts(chosen)


# --- business queries

@query
def filtered_lines(s):
    chosen = business.filter_lines(s.named_lines, "1996-01-01", "1999-12-31", "L05", "Promo", "Dine-in")
    return to_places(chosen.select("order_id", "item_id", "line_no", "order_date", "quantity", "net_revenue"),
                     4, "net_revenue")


@query
def filter_options(s):
    return business.filter_options(s.named_lines, s.locations)


@query
def location_dimension(s):
    """Branches and the lines sold there."""
    sold = s.sales_lines.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return (business.location_dimension(s.locations).select("location_id", "restaurant_name", "city", "area", "region")
            .join(sold, "location_id", "left"))


@query
def key_figures(s):
    return business.key_figures(s.named_lines, s.items)


@query
def key_figures_filtered(s):
    return business.key_figures(
        business.filter_lines(s.named_lines, "1997-01-01", "1998-12-31", channel="Takeaway"), s.items)


@query
def repeat_customers(s):
    return business.repeat_customers(s.sales_lines)


@query
def daily_revenue(s):
    return business.daily_revenue(s.sales_lines)


@query
def revenue_by_category(s):
    return business.revenue_by_category(s.named_lines)


@query
def menu_view(s):
    return business.menu_figures(business.menu_view(
        s.labelled, ["Profit Driver", "Volume Driver"], ["Promo", "Small", "Large"]))


@query
def menu_table(s):
    return business.menu_table(s.labelled)


@query
def menu_scatter(s):
    return business.menu_scatter(s.labelled)


@query
def slow_movers(s):
    return business.slow_movers(s.labelled)


@query
def segment_view(s):
    return business.segment_view(s.segmented, ["Loyal High Spender", "At Risk"])


@query
def score_histogram(s):
    return business.score_histogram(s.scored)


@query
def customer_sample(s):
    return business.stable_sample(s.rfm.select("customer_id", "recency_days", "monetary"), "customer_id", 500)


@query
def waste_figures(s):
    """The waste share itself stands in for the model score."""
    return business.waste_figures(s.item_features.withColumn("predicted_wastage_risk", F.col("wastage_percent")))


@query
def waste_figures_with_risk(s):
    return business.waste_figures(_risk(s))


@query
def top_waste(s):
    return business.top_waste(s.item_features)


@query
def waste_table(s):
    return business.top_waste(s.item_features, n=None)


@query
def waste_by_category(s):
    return business.waste_by_category(s.item_features)


# --- scenarios

CHANGED = ("new_quantity", "new_revenue", "new_profit", "new_margin", "revenue_change", "profit_change",
           "margin_change")


@query
def scenario_price(s):
    return to_places(scenarios.price_scenarios(s.item_features, PRICE_GRID), 4, *CHANGED)


@query
def scenario_discount(s):
    return to_places(scenarios.discount_scenarios(s.item_features, DISCOUNT_GRID), 4, *CHANGED)


@query
def scenario_preparation(s):
    return to_places(scenarios.preparation_scenarios(s.item_features, PREP_GRID), 4, *CHANGED)


# --- patterns

@query
def pattern_item_profile(s):
    profile = patterns.item_profile(s.checked_lines, s.view("raw_ratings"), s.checked_stock, s.checked_waste)
    return to_places(profile, 4, "margin", "promo_share", "weekend_share", "december_share", "rating")


def _pattern_groups(s: Sales) -> list[DataFrame]:
    profile = patterns.item_profile(s.checked_lines, s.view("raw_ratings"), s.checked_stock, s.checked_waste)
    waste = features.observed_waste(s.checked_stock, s.checked_waste, "item_id")
    study = patterns.event_study(patterns.price_events(
        s.prices, SETTINGS.min_price_rise, SETTINGS.price_sensitive), s.checked_lines,
                                 SETTINGS.study_days, SETTINGS.min_units_before)
    defects = quality.defect_summary(s.view("raw_orders"), s.view("raw_order_items"), s.view("raw_ratings"),
                                     s.view("raw_wastage"))
    return [
        patterns.item_checks(profile, waste, SETTINGS),
        patterns.place_checks(s.checked_lines, s.locations, SETTINGS.cases["weekend_only"]),
        patterns.hour_check(s.checked_lines, s.orders),
        patterns.calendar_checks(s.checked_orders, SETTINGS),
        patterns.price_check(study),
        patterns.promo_trap_check(s.checked_lines, SETTINGS.cases["loss_making_popular"], SETTINGS.promo_traps),
        patterns.rating_checks(s.view("raw_ratings"), s.items, SETTINGS, 2500),
        patterns.waste_location_check(s.checked_stock, s.checked_waste, SETTINGS.waste_location),
        patterns.order_size_checks(s.valid_lines, SETTINGS),
        patterns.defect_check(defects),
    ]


@query
def pattern_checks(s):
    return union_all(_pattern_groups(s))


@query
def event_study(s):
    events = patterns.price_events(s.prices, SETTINGS.min_price_rise)
    study = patterns.event_study(events, s.study_lines, SETTINGS.study_days, SETTINGS.min_units_before)
    return to_places(study, 6, "rise", "change")


@query
def window_vs_reference(s):
    done = s.checked_orders.filter(F.col("status") == "Completed")
    return to_places(patterns.window_vs_reference(
        done, "day", SETTINGS.collapse_window, SETTINGS.collapse_reference, ["location_id"]),
        6, "per_day", "reference_per_day")


@query
def rating_shift(s):
    rated = s.ratings.join(s.items.select("item_id", "item_name"), "item_id")
    return to_places(patterns.mean_shift(rated, "rating_value", "rating_date", SETTINGS.rating_drop_window,
                                         ["item_name"]), 4, "mean_in_window", "mean")


@query
def rating_burst(s):
    rated = s.ratings.join(s.items.select("item_id", "item_name"), "item_id")
    return to_places(patterns.burst(rated, "rating_date", SETTINGS.burst_window, 2500, ["item_name"]), 6, "expected")


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(REGISTRY[name](Sales(spark, sf_dir)))
