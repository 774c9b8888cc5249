import datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import business, patterns, recommend, scenarios

D = datetime.date
LINES = ("order_id int, customer_id string, order_date date, location_id string, category_name string, channel string,"
         "status string, is_completed int, net_revenue double, line_profit double, item_id int")


def sales(spark):
    return spark.createDataFrame([
        (1, "x", D(2024, 1, 1), "L01", "A", "Web", "Completed", 1, 10.0, 4.0, 1),
        (1, "x", D(2024, 1, 1), "L01", "B", "Web", "Completed", 1, 5.0, 1.0, 2),
        (2, "x", D(2024, 1, 2), "L02", "A", "Dine", "Completed", 1, 3.0, -1.0, 1),
        (3, "y", D(2024, 1, 3), "L02", None, "Dine", "Cancelled", 0, 7.0, 2.0, 1)], LINES)


def test_filters_are_inclusive_and_all_does_not_filter(spark, rows):
    frame = sales(spark)
    assert business.filter_lines(frame).count() == 4
    assert rows(business.filter_lines(frame, "2024-01-01", "2024-01-02", category="A"), "order_id") == [(1,), (2,)]
    assert business.filter_lines(frame, location="L02", channel="Web").count() == 0


def test_key_figures(spark):
    items = spark.createDataFrame([(1,), (2,), (2,)], "item_id int")
    row = business.key_figures(sales(spark), items).first()
    assert tuple(row) == (18.0, 4.0, 2, 9.0, 1, 1, 1, 2)
    empty = business.key_figures(sales(spark).filter("order_id = 99"), items).first()
    assert tuple(empty) == (0.0, 0.0, 0, 0.0, 0, 0, 0, 2)


def test_options_revenue_and_repeat_customers(spark, rows):
    places = spark.createDataFrame([("L01", "One"), ("L01", "One")], "location_id string, restaurant_name string")
    options = rows(business.filter_options(sales(spark), places))
    assert ("location", "L01", "L01 - One") in options and ("location", "L02", "L02 - L02") in options
    assert ("date", "2024-01-01", "first") in options and len(options) == 8
    assert [tuple(r) for r in business.revenue_by_category(sales(spark)).collect()] == [("A", 13.0), ("B", 5.0)]
    assert rows(business.repeat_customers(sales(spark))) == [("x", 2)]


def test_sample_is_repeatable_and_bounded(spark, rows):
    frame = spark.range(300).repartition(5)
    first = rows(business.stable_sample(frame, "id", 40))
    assert len(first) == 40 and first == rows(business.stable_sample(frame.repartition(2), "id", 40))
    assert rows(business.stable_sample(frame, "id", 40, seed=1)) != first


def test_scenarios(spark):
    items = spark.createDataFrame([(1, "a", 100, 1000.0, 400.0, 0.4, 6.0, 0.2), (2, "b", 10, 0.0, 0.0, None, 6.0, 1.0)],
                                  "item_id int, item_name string, total_quantity_sold bigint, net_revenue double,"
                                  "total_profit double, profit_margin double, base_cost double, wastage_percent double")
    price = scenarios.price_scenarios(items, [{"price_change_pct": 10, "elasticity": 1.0}]).collect()[0]
    assert (price.new_quantity, round(price.new_revenue, 6), round(price.new_profit, 6)) == (90.0, 990.0, 450.0)
    floor = scenarios.price_scenarios(items, [{"price_change_pct": 50, "elasticity": 3.0}]).collect()[0]
    assert (floor.new_quantity, floor.new_margin) == (0.0, 0.0)
    cut = scenarios.discount_scenarios(items, [{"discount_change": 5, "lift_per_point": 2.0}]).collect()[0]
    assert (round(cut.new_quantity, 6), round(cut.new_revenue, 6)) == (110.0, 1045.0)
    prep = scenarios.preparation_scenarios(items, [{"prep_change_pct": -20}]).collect()
    assert round(prep[0].new_profit, 6) == 430.0  # 25 wasted units become 20
    assert prep[1].new_profit == 0.0 and prep[1].new_margin == 0.0


def test_recommendation_rules_and_order(spark):
    items = spark.createDataFrame([
        (1, "Soup", "Hidden Opportunity", 0.61, 1200, 4.26, 0.0, 0.01),
        (2, "Rice", "Low Performer", 0.10, 10, 2.0, 9.0, 0.20),
        (3, "Tea", "Profit Driver", 0.50, 5000, 4.0, 1.0, 0.02)],
        "item_id int, item_name string, python_label string, profit_margin double, total_quantity_sold bigint,"
        "avg_rating double, avg_discount_pct double, wastage_percent double")
    segments = spark.createDataFrame([("At Risk",)] * 2 + [("Loyal High Spender",)] * 3, "segment string")
    forecast = spark.createDataFrame([("A", "actual", 10, None), ("A", "forecast", None, 13.0), ("A", "test", 99, 1.0),
                                      ("B", "actual", 10, None), ("B", "forecast", None, 10.4)],
                                     "category_name string, row_type string, actual_quantity int, forecast_quantity double")
    out = recommend.combine([*recommend.item_rules(items), recommend.stock_rule(forecast),
                             recommend.segment_rules(segments)])
    got = [(r.priority, r.rule_no, r.item_name) for r in out.collect()]
    assert got == [("Critical", 2, "Rice"), ("High", 1, "Soup"), ("High", 6, "A"), ("High", 7, "At Risk customers"),
                   ("Medium", 3, "Rice"), ("Medium", 4, "Rice"), ("Medium", 7, "Loyal High Spenders")]
    reasons = {(r.rule_no, r.item_name): r.reason for r in out.collect()}
    assert reasons[1, "Soup"] == ("61.0% profit margin (dataset median is 50.0%) | only 1,200 units sold in the period -- "
                                  "under-ordered for how profitable it is | 4.3/5 average rating")
    assert reasons[6, "A"].startswith("forecast demand is +30% vs.")
    evidence = recommend.evidence(out)
    assert evidence.filter("rule_no = 1").count() == 3
    assert recommend.urgent(out, 2).count() == 2
    assert {r.priority: r.n for r in recommend.recommendation_counts(out).collect()} == {"Critical": 1, "High": 3, "Medium": 3}
    scored = recommend.item_rules(items, items.select("item_id", F.lit(0.1286).alias("predicted_wastage_risk")))[1].first()
    assert scored.reason == "20.0% of prepared units go to waste | model-predicted wastage risk score 0.129"


def test_event_study_counts_units_around_a_rise(spark):
    prices = spark.createDataFrame([("a", 10.0, D(2024, 1, 1)), ("a", 0.0, D(2024, 2, 1)), ("a", 12.0, D(2024, 3, 1)),
                                    ("a", 12.5, D(2024, 4, 1))], "item_id string, price double, effective_from date")
    events = patterns.price_events(prices)
    assert [(r.effective_from, round(r.rise, 3)) for r in events.collect()] == [(D(2024, 3, 1), 0.2)]
    lines = spark.createDataFrame([("a", D(2024, 2, 29), 40), ("a", D(2024, 3, 1), 10), ("a", D(2024, 3, 1), 10),
                                   ("a", D(2024, 1, 18), 99), ("a", D(2024, 4, 12), 99), ("a", D(2024, 4, 11), 10)],
                                  "item_id string, day date, quantity int")
    row = patterns.event_study(events, lines).first()
    assert (row.units_before, row.units_after, row.change) == (40, 30, -0.25)
    check = patterns.price_check(patterns.event_study(events, lines)).first()
    assert (check.passed, check.measured, check.compared) == (True, -0.25, 1.0)


def test_windows_bursts_and_shifts(spark):
    days = spark.createDataFrame([(D(2024, 1, d), float(d)) for d in range(1, 11)], "day date, v double")
    row = patterns.window_vs_reference(days, "day", ("2024-01-01", "2024-01-04"), ("2024-01-08", "2024-01-15")).first()
    assert (row.per_day, row.reference_per_day) == (1.0, 3 / 8)
    assert tuple(patterns.mean_shift(days, "v", "day", ("2024-01-01", "2024-01-02")).first()) == (1.5, 5.5)
    assert tuple(patterns.burst(days, "day", ("2024-01-01", "2024-01-02"), 40).first()) == (2, 0.5)


def test_sales_rank_averages_ties(spark):
    lines = spark.createDataFrame([(i, u, 1.0, 1.0, None, D(2024, 1, 6)) for i, u in ((1, 5), (2, 9), (3, 5), (4, 1))],
                                  "item_id int, quantity int, net double, profit double, promo_id string, day date")
    ratings = spark.createDataFrame([(1, 9), (1, 4)], "item_id int, rating_value int")
    stock = spark.createDataFrame([(1, 10)], "item_id int, prepared_qty int")
    waste = spark.createDataFrame([(1, 1), (2, 1)], "item_id int, quantity_wasted int")
    out = {r.item_id: r for r in patterns.item_profile(lines, ratings, stock, waste).collect()}
    assert {i: r.sales_rank for i, r in out.items()} == {2: 1.0, 1: 2.5, 3: 2.5, 4: 4.0}
    assert (out[1].rating, out[1].waste_ratio, out[2].waste_ratio, out[1].weekend_share) == (4.0, 0.1, None, 1.0)


def test_lines_are_written_once_for_all_pattern_checks(spark, rows):
    from larder.operators import patterns
    from larder.plans import queries
    from larder.session import settled

    items = spark.createDataFrame([(1, 2.0), (2, 1.0)], "item_id long, base_cost double")
    orders = spark.createDataFrame(
        [(1, "Completed", "2020-01-01", "L1", None, 5), (1, "Completed", "2020-01-02", "L1", "P1", 5), (2, "Cancelled", "2020-01-01", "L2", None, 6)],
        "order_id long, status string, day string, location_id string, promo_id string, customer_id long")
    lines = spark.createDataFrame(
        [(1, 1, 1, 2, 3.0, 10.0), (1, 1, 1, 2, 3.0, 10.0), (1, 1, 2, 2, 3.0, 10.0), (1, 2, 3, 1, 4.0, None), (2, 1, 1, 1, 3.0, 60.0),
         (3, 1, 1, 1, 3.0, 0.0), (1, 9, 4, 1, 3.0, 0.0), (1, 1, 5, 0, 3.0, 0.0)],
        "order_id long, item_id long, line_no long, quantity long, unit_price double, discount_pct double")
    valid = patterns.valid_lines(lines, orders, items)
    ordered = patterns.ordered_lines(lines, orders, items)
    columns = ["order_id", "item_id", "quantity", "unit_price", "discount_pct"]
    assert rows(patterns.once_each(ordered), *columns) == rows(valid, *columns)
    columns += ["day", "location_id", "promo_id", "net", "profit"]
    assert rows(patterns.completed(ordered), *columns) == rows(patterns.checked_lines(valid, orders, items), *columns)
    start = len(settled)
    queries.run("pattern_checks", spark, "/root/testdata/sf0.001")
    assert len([p for p in settled[start:] if "-lines-" in p]) == 1
