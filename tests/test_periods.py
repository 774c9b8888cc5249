"""Weekly and daily series from one pass, with null keys apart from keys left out."""

from datetime import date

from larder import session
from larder.functions.fixed import CONTRACTS
from larder.operators import periods

LINES = [  # order, item, category, location, day, quantity, net, profit, promotion, completed
    (1, 10, "a", "L1", date(2024, 1, 1), 2, 20.0, 5.0, "P", 1), (1, 11, None, "L1", date(2024, 1, 1), 1, 3.5, 1.0, "P", 1),
    (2, 10, "a", "L1", date(2024, 1, 7), 4, 40.0, 10.0, None, 1), (3, 10, "a", None, date(2024, 1, 8), 1, 10.0, 2.5, None, 1),
    (3, 10, "a", None, date(2024, 1, 8), 1, 10.0, 2.5, None, 1), (4, 11, None, "L2", None, 5, 1.0, -1.0, None, 1), (5, 10, "a", "L1", date(2024, 1, 1), 9, 90.0, 9.0, "P", 0)]
SCHEMA = ("order_id int, item_id int, category_id string, location_id string, order_date date, quantity int, net_revenue double,"
          "line_profit double, promo_id string, is_completed int")


def test_series_equal_separate_groupings(spark, rows):
    totals = periods.period_totals(spark.createDataFrame(LINES, SCHEMA)).cache()
    names = spark.createDataFrame([("10", "ten"), ("a", "first"), ("L1", "one")], "entity_id string, entity_name string")
    weekly = {n: rows(periods.weekly_series(totals, n, names)) for n in periods.SERIES if n.startswith("weekly")}
    monday, next_monday = date(2024, 1, 1), date(2024, 1, 8)
    assert weekly["weekly_item"] == sorted([("10", "ten", monday, 6, 60.0, 2, 2), ("10", "ten", next_monday, 2, 20.0, 1, 0),
                                            ("11", None, monday, 1, 3.5, 1, 1), ("11", None, None, 5, 1.0, 1, 0)], key=repr)
    assert weekly["weekly_category"] == sorted([("a", "first", monday, 6, 60.0, 2, 2), ("a", "first", next_monday, 2, 20.0, 1, 0),
                                                (None, None, monday, 1, 3.5, 1, 1), (None, None, None, 5, 1.0, 1, 0)], key=repr)
    assert weekly["weekly_location"] == sorted([("L1", "one", monday, 7, 63.5, 2, 3), (None, None, next_monday, 2, 20.0, 1, 0),
                                                ("L2", None, None, 5, 1.0, 1, 0)], key=repr)
    assert rows(periods.daily_location(totals)) == sorted([
        (date(2024, 1, 1), "L1", 1, 3, 23.5, 6.0), (date(2024, 1, 7), "L1", 1, 4, 40.0, 10.0), (date(2024, 1, 8), None, 1, 2, 20.0, 5.0),
        (None, "L2", 1, 5, 1.0, -1.0)], key=repr)
    assert len(rows(periods.daily_item(totals))) == 5
    for name in ("daily_location", "daily_item"):
        assert getattr(periods, name)(totals).columns == CONTRACTS[name]


def test_no_lines_give_no_rows(spark):
    assert periods.period_totals(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_single_series_equals_its_part_and_expands_nothing(spark, rows, capsys):
    lines = spark.createDataFrame([*LINES, (None, 10, "a", "L1", date(2024, 1, 1), 1, 1.0, 0.5, None, 1)], SCHEMA)
    every = periods.period_totals(lines).cache()
    for name, keys in periods.SERIES.items():
        columns = [*keys, "units", "net_revenue", "profit", "orders", "promo_units", "series"]
        single = periods.period_totals(lines, [name])
        assert rows(single, *columns) == rows(every.filter(f"series = '{name}'"), *columns)
        single.explain()
        assert "Expand" not in capsys.readouterr().out


def test_tasks_grow_in_number_with_the_rows(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    kept = {k: spark.conf.get(k, None) for k in (name, "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows_, want in ((0, least), (10, least), (216_000_000, 864)):
        session.bound_tasks(spark, rows_)
        assert int(spark.conf.get(name)) == max(least, want)
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
