"""Raw tables as CSV files, read with their declared schemas, through cleaning and joining to the results."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import joins
from larder.plans.sales import CleanedSales, Sales
from larder.session import settle
from larder.sources import io

FOLDER = "/root/testdata/sf0.001"


def test_csv_files_give_the_same_results_as_the_tables(spark, rows, tmp_path):
    raw = Sales(spark, FOLDER).tables.raw()
    for name, ddl in io.RAW_SCHEMAS.items():
        columns = T.StructType.fromDDL(ddl).names
        table = raw[name].select(*[F.col(c) if c in raw[name].columns else F.lit(None).cast("string").alias(c) for c in columns])
        io.write_csv(table, str(tmp_path / ("order_items/all.csv" if name == "order_items" else f"{name}.csv")))
    dates = {"first_date": "1990-01-01", "last_date": "2026-09-28"}
    of_csv = CleanedSales(io.read_all_raw(spark, str(tmp_path)), **dates)
    of_tables = CleanedSales(raw, **dates)
    for result, columns in (("item_features", ["total_quantity_sold", "net_revenue", "avg_rating", "profit_margin", "wastage_percent"]),
                            ("rfm", ["frequency", "monetary", "recency_days"])):
        key = "item_id" if result == "item_features" else "customer_id"
        got, want = (rows(getattr(s, result).select(F.col(key).cast("string"), *columns)) for s in (of_csv, of_tables))
        assert got == want and got
    assert of_csv.labelled.select("python_label").distinct().count() > 1


def test_promotions_without_end_and_with_reversed_dates(spark, rows):
    orders = spark.createDataFrame([(1, "L1", "2024-01-05"), (2, "L2", "2024-03-01"), (3, "L1", "2024-03-01")],
                                   "order_id int, location_id string, order_date string").withColumn("order_date", F.to_date("order_date"))
    promos = spark.createDataFrame(
        [("open", 5.0, "2024-01-01", None, "ALL", None, None, "ALL"), ("reversed", 5.0, "2024-03-05", "2024-02-01", "ALL", None, None, "ALL"),
         ("item", 7.0, "2024-02-20", "2024-03-01", "ITEM", "7|9", None, "L1"), ("late", 1.0, "2025-01-01", None, "ALL", None, None, "ALL"),
         ("class", 3.0, "2024-03-01", "2024-03-01", "CATEGORY", None, "C", "ALL")],
        "promo_id string, discount_pct double, start_date string, end_date string, scope string, applicable_items string, "
        "category_id string, location_id string").withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    assert rows(joins.active_promotions(orders, promos), "order_id", "promo_id") == [
        (1, "open"), (2, "class"), (2, "open"), (3, "class"), (3, "item"), (3, "open")]
    lines = spark.createDataFrame([(1, 7, 1), (3, 7, 1), (3, 8, 2), (2, 9, 1)], "order_id int, item_id int, line_no int")
    items = spark.createDataFrame([(7, "C"), (8, "D")], "item_id int, category_id string")
    assert rows(joins.active_promotion_items(lines, orders, items, promos), "order_id", "item_id", "promo_id") == [
        (1, 7, "open"), (2, 9, "open"), (3, 7, "class"), (3, 7, "item"), (3, 7, "open"), (3, 8, "open")]


def test_prices_in_overlapping_open_and_reversed_intervals(spark, rows):
    prices = spark.createDataFrame([(1, 5.0, "2024-01-10", "2024-06-30"), (1, 6.0, "2024-03-31", None), (1, 9.0, "2024-05-01", "2024-04-01"),
                                    (2, 3.0, "2024-02-01", "2024-02-29")], "item_id int, price double, effective_from string, effective_to string")
    prices = prices.withColumns({c: F.to_date(c) for c in ("effective_from", "effective_to")})
    lines = spark.createDataFrame([(1, "2024-01-09", 5.0), (1, "2024-01-10", 5.0), (1, "2024-03-30", 4.0), (1, "2024-05-02", 6.0), (2, "2024-02-29", 3.0),
                                   (2, "2024-03-01", 3.0), (3, "2024-02-02", 1.0)], "item_id int, order_date string, unit_price double")
    lines = lines.withColumn("order_date", F.to_date("order_date"))
    found = joins.price_as_of(lines, prices).select(F.col("order_date").cast("string"), "listed_price", "price_matches")
    assert rows(found) == sorted([("2024-01-09", None, None), ("2024-01-10", 5.0, True), ("2024-03-30", 5.0, False), ("2024-05-02", 6.0, True),
                                  ("2024-02-29", 3.0, True), ("2024-03-01", None, None), ("2024-02-02", None, None)], key=repr)


def test_rules_of_a_large_itemset_come_level_by_level(spark):
    from larder.operators import basket
    size = 22
    sets = [(list(range(size)), 0.1)]
    for k in range(1, size):  # a chain of subsets and what is left of each
        sets += [(list(range(k)), 0.2), (list(range(k, size)), 0.2 if k != 5 else 0.9)]
    itemsets = spark.createDataFrame(sets, "items array<int>, support double")
    found = basket.association_rules(itemsets.filter(F.size("items") == size).unionAll(itemsets.filter(F.size("items") < size)), 1.2)
    whole = found.filter(F.size("antecedents") + F.size("consequents") == size)
    got = {(tuple(r.antecedents), tuple(r.consequents)) for r in whole.collect()}
    splits = {(tuple(range(k)), tuple(range(k, size))) for k in range(1, size) if k != 5}
    assert got == splits | {(b, a) for a, b in splits}


def test_settling_deletes_its_shuffle_files_and_restores_the_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    table = settle(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    assert {r["count"] for r in table.collect()} == {142, 143} and spark.conf.get(name) == before
