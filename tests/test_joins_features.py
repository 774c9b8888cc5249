import datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import features, joins

D = datetime.date


def test_audit_reports_growth_and_unmatched_rows(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    row = joins.audit_step("s", 1, left, right, ["k"]).first()
    joined = left.join(right, "k", "left").count()
    assert (row.rows_before, row.rows_after, row.unmatched, row.duplicate_keys) == (5, joined, 2, 1)
    assert row.result == "BALLOON (+2 rows), UNMATCHED (2 rows found no partner)"
    quiet = joins.audit_step("s", 1, left.filter("k = 2 OR k = 3"), right, ["k"], full_match=False).first()
    assert quiet.result == "ok"


def test_price_rollup_breaks_date_ties_by_price(spark):
    prices = spark.createDataFrame([("a", 0.0, D(2024, 1, 1)), ("a", 5.0, D(2024, 1, 1)), ("a", 9.0, D(2025, 1, 1))],
                                   "item_id string, price double, effective_from date")
    row = joins.price_rollup(prices).first()
    assert (row.current_price, row.first_price, row.price_changes) == (9.0, 0.0, 2)


def test_price_as_of_uses_the_interval_and_keeps_every_line(spark):
    prices = spark.createDataFrame([
        ("a", 10.0, D(2024, 1, 1), D(2024, 6, 30)), ("a", 12.0, D(2024, 7, 1), None)],
        "item_id string, price double, effective_from date, effective_to date")
    lines = spark.createDataFrame([
        ("a", 10.0, D(2024, 6, 30)), ("a", 12.0, D(2030, 1, 1)), ("a", 1.0, D(2023, 1, 1)), ("b", 1.0, D(2024, 1, 1))],
        "item_id string, unit_price double, order_date date")
    out = {(r.item_id, r.order_date): (r.listed_price, r.price_matches) for r in
           joins.price_as_of(lines, prices).collect()}
    assert out == {("a", D(2024, 6, 30)): (10.0, True), ("a", D(2030, 1, 1)): (12.0, True),
                   ("a", D(2023, 1, 1)): (None, None), ("b", D(2024, 1, 1)): (None, None)}


def test_promotions_by_day_place_and_scope(spark, rows):
    promos = spark.createDataFrame([
        ("P1", 10.0, D(2024, 1, 1), D(2024, 1, 3), "ITEM", "7|8", None, "ALL"),
        ("P2", 20.0, D(2024, 1, 2), D(2024, 1, 2), "CATEGORY", None, "C1", "L01"),
        ("P3", 30.0, D(2024, 1, 2), D(2024, 1, 2), "ALL", None, None, "L02")],
        "promo_id string, discount_pct double, start_date date, end_date date, scope string, applicable_items string,"
        "category_id string, location_id string")
    orders = spark.createDataFrame([(1, "L01", D(2024, 1, 2), "P1"), (2, "L02", D(2024, 1, 4), "P2")],
                                   "order_id int, location_id string, order_date date, promo_id string")
    assert rows(joins.active_promotions(orders, promos), "order_id", "promo_id") == [(1, "P1"), (1, "P2")]
    lines = spark.createDataFrame([(1, 7, 1), (1, 9, 2), (2, 9, 1)], "order_id int, item_id int, line_no int")
    items = spark.createDataFrame([(7, "C1"), (9, "C1")], "item_id int, category_id string")
    out = joins.promotion_coverage(lines, orders, items, promos)
    assert rows(out, "order_id", "item_id", "covered", "granted_discount") == [
        (1, 7, True, 10.0), (1, 9, False, 0.0), (2, 9, True, 20.0)]
    assert rows(joins.promotion_items(promos)) == [("P1", "7"), ("P1", "8")]


def test_item_features_survive_a_full_discount_and_average_ratings_twice(spark):
    lines = spark.createDataFrame([
        (1, "a", 2, 10.0, 100.0, "Completed", D(2024, 1, 6), 4.67),
        (2, "a", 1, 10.0, 100.0, "Completed", D(2024, 1, 8), None),
        (3, "b", 3, 10.0, 0.0, "Completed", D(2024, 1, 8), 3.0),
        (4, "b", 3, 10.0, 0.0, "Cancelled", D(2024, 1, 8), 1.0)],
        "order_id int, item_id string, quantity int, unit_price double, discount_pct double, status string,"
        "order_date date, avg_rating double")
    lines = lines.withColumns({
        "net_revenue": features.net_amount(), "is_completed": (F.col("status") == "Completed").cast("int"),
        "is_weekend": F.dayofweek("order_date").isin(1, 7).cast("int")})
    items = spark.createDataFrame([("a", "A", "c", 4.0), ("b", "B", "c", 4.0)],
                                  "item_id string, item_name string, category_id string, base_cost double")
    categories = spark.createDataFrame([("c", "Cat")], "category_id string, category_name string")
    prepared = spark.createDataFrame([("a", 10), ("b", 0)], "item_id string, prepared_qty int")
    wasted = spark.createDataFrame([("b", 3)], "item_id string, quantity_wasted int")
    out = {r.item_id: r for r in features.item_features(lines, items, categories, prepared, wasted).collect()}
    assert out["a"].profit_margin is None and out["a"].total_profit == -12.0
    assert out["a"].avg_rating == 4.67 and out["a"].weekend_share == 0.5
    assert out["a"].wastage_percent == 0.0 and out["b"].wastage_percent is None
    assert out["b"].total_quantity_sold == 3 and out["b"].profit_margin == 0.6


def test_rfm_counts_back_from_the_newest_completed_order(spark):
    lines = spark.createDataFrame([
        (1, "x", D(2024, 1, 1), 10.0, 1), (1, "x", D(2024, 1, 1), 5.5, 1), (2, "x", D(2024, 1, 11), 1.0, 1),
        (3, "y", D(2024, 1, 1), 2.0, 1), (4, "y", D(2024, 2, 1), 2.0, 0), (5, "z", D(2024, 2, 1), 2.0, 0)],
        "order_id int, customer_id string, order_date date, net_revenue double, is_completed int")
    out = {r.customer_id: tuple(r)[1:] for r in features.customer_rfm(lines).collect()}
    assert out == {"x": (2, 16.5, 0), "y": (1, 2.0, 10)}


def test_stock_floor_is_not_carried_on(spark):
    moves = spark.createDataFrame([("L", "i", D(2024, 1, 1), 0, 40), ("L", "i", D(2024, 1, 8), 15, 0)],
                                  "location_id string, item_id string, week_start date, replenished_qty int, prepared_qty int")
    out = features.stock_roll_forward(moves).orderBy("week_start").collect()
    assert [(r.opening_stock, r.closing_stock) for r in out] == [(30, 0), (0, 5)]


def test_near_duplicates_cross_slot_borders_and_equal_moments(spark, rows):
    at = datetime.datetime(2024, 1, 1, 12, 2, 59)
    step = datetime.timedelta
    orders = spark.createDataFrame([
        (1, "c", "L", at), (2, "c", "L", at + step(seconds=100)), (3, "c", "L", at + step(seconds=100)),
        (4, "c", "L", at + step(seconds=281)), (5, "d", "L", at), (6, "c", "L", at + step(hours=1))],
        "order_id int, customer_id string, location_id string, order_datetime timestamp")
    lines = spark.createDataFrame([(o, i, 1) for o in range(1, 7) for i in ((1, 2) if o != 6 else (2, 1))],
                                  "order_id int, item_id int, quantity int")
    out = features.near_duplicate_orders(orders, lines)
    assert rows(out, "order_id", "repeats_order", "seconds_apart") == [(2, 1, 100), (3, 2, 0)]


def test_line_totals_and_merged_lines(spark, rows):
    lines = spark.createDataFrame([(1, 1, 2, 10.0, 5.0, 19.0), (1, 1, 1, 10.0, 0.0, 10.5)],
                                  "order_id int, item_id int, quantity int, unit_price double, discount_pct double,"
                                  "line_total double")
    assert rows(features.line_total_mismatches(lines), "line_total", "expected_total") == [(10.5, 10.0)]
    assert rows(features.merged_lines(lines)) == [(1, 1, 3, 2)]
