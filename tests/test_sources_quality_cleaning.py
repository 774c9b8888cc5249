import datetime
import json

import pytest
from pyspark.sql import functions as F

from larder.functions.fixed import (
    BAD_PRICE, BAD_QUANTITY, EXACT_DUPLICATES, IMPLAUSIBLE_DATE, INVALID_BRANCH, MISSING_CUSTOMER, UNPARSEABLE_DATE,
)
from larder.operators import quality
from larder.operators.cleaning import Rule, SalesCleaning, audit_rows, clean_rows, rejected, removal_summary, standardise
from larder.sources import io

ORDERS = "order_id string, customer_id string, location_id string, order_date string, channel string, status string"


def orders_frame(spark):
    return spark.createDataFrame([
        ("o1", "c1", "L01", "2025-01-05", "Website/App", "Completed"),
        ("o1", "c1", "L01", "2025-01-05", "Website/App", "Completed"),
        ("o2", None, "L99", "2025-13-45", "dine-in", "CANCELLED "),
        ("o3", "c1", "L99", "2025-01-05", None, "Completed"),
        ("o4", "c1", None, "2025-01-05", "Takeaway", "Completed"),
        ("o5", "c1", "L02", "2025-13-45", "Takeaway", "Completed"),
        ("o6", "c1", "L02", "1970-01-01", "Takeaway", "Completed"),
        ("o7", "c1", "L02", None, "Takeaway", "Completed"),
    ], ORDERS)


def test_first_broken_rule_is_charged_and_null_conditions_fail(spark):
    cleaning = SalesCleaning({"orders": orders_frame(spark)})
    audited = {r.order_id: r.first_failed_rule for r in cleaning.audit("orders").collect()}
    assert audited == {"o1": None, "o2": MISSING_CUSTOMER, "o3": INVALID_BRANCH, "o4": INVALID_BRANCH,
                       "o5": UNPARSEABLE_DATE, "o6": IMPLAUSIBLE_DATE, "o7": UNPARSEABLE_DATE}


def test_summary_lists_every_rule_in_order_with_zeros(spark):
    frame = spark.createDataFrame([(1, 5), (1, 5), (2, 0)], "id int, quantity int")
    rules = [Rule(BAD_QUANTITY, F.col("quantity") > 0), Rule(BAD_PRICE, F.col("quantity") > -1)]
    out = removal_summary(audit_rows(frame, rules), "t", rules).orderBy("rule_no").collect()
    assert [(r.rule, r.removed) for r in out] == [(EXACT_DUPLICATES, 1), (BAD_QUANTITY, 1), (BAD_PRICE, 0)]


def test_known_key_rule_and_clean_rows_agree(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (1, "a")], "id int, item string")
    known = spark.createDataFrame([("a",), ("a",)], "item string")
    rules = [Rule("unknown", key="item", known=known)]
    assert rows(clean_rows(frame, rules)) == [(1, "a")]
    kept = audit_rows(frame, rules).filter("first_failed_rule IS NULL")
    assert rows(kept, "id", "item", "n_copies") == [(1, "a", 2)]


def test_standardise_keeps_the_initcap_quirk(spark):
    out = {r.order_id: (r.channel, r.status) for r in standardise(orders_frame(spark), "orders").collect()}
    assert out["o1"] == ("Website/app", "Completed")
    assert out["o2"] == ("Dine-in", "Cancelled")
    assert out["o3"][0] is None


def test_quality_counts_ignore_null_conditions(spark):
    rules = quality.order_rules(as_of=F.lit("2026-01-01").cast("date"))
    out = {r.rule: r.n_rows for r in quality.rule_counts(orders_frame(spark), "orders", rules).collect()}
    assert out[INVALID_BRANCH] == 2  # the missing location is not counted
    assert out["order_date cannot be parsed as a date"] == 2
    assert out["channel needs standardising (case/spacing)"] == 3


def test_null_profile_duplicates_and_orphans(spark, rows):
    frame = orders_frame(spark)
    missing = {r.column_name: r.n_missing for r in quality.null_profile(frame, "orders").collect()}
    assert missing == {"customer_id": 1, "location_id": 1, "order_date": 1, "channel": 1}
    assert quality.exact_duplicates(frame).first().n_duplicates == 1
    lines = spark.createDataFrame([("x",), (None,), ("o1",), ("x",)], "order_id string")
    keep = quality.unmatched_rows(lines, frame, "order_id", "r", "t")
    skip = quality.unmatched_rows(lines, frame, "order_id", "r", "t", skip_null=True)
    assert (keep.first().n_rows, skip.first().n_rows) == (3, 2)


def test_monthly_csv_files_read_as_one_table(spark, tmp_path):
    folder = tmp_path / "order_items"
    folder.mkdir()
    head = "order_item_id,order_id,item_id,quantity,unit_price,discount_pct,line_total\n"
    (folder / "order_items_2024_07.csv").write_text(head + "a,o1,i1,2,10.5,0,21\n")
    (folder / "order_items_2024_08.csv").write_text(head + "b,o2,,1,3,150,3\n")
    frame = io.read_raw(spark, str(tmp_path), "order_items")
    assert frame.count() == 2
    assert dict(frame.dtypes)["quantity"] == "int"
    assert frame.filter("item_id IS NULL").count() == 1
    profile = io.ingest_profile({"order_items": frame})
    assert profile.count() == 7 and profile.first().n_rows == 2


def test_write_reload_export_and_checks(spark, tmp_path):
    frame = spark.range(25).withColumn("k", F.col("id") % 3)
    assert tuple(io.write_and_verify(frame, str(tmp_path / "t"), "t").first()) == ("t", 25, 25, True)
    io.write_parquet(frame, str(tmp_path / "p"), ["k"])
    assert io.read_parquet(spark, str(tmp_path / "p")).count() == 25
    io.write_csv(frame, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 25
    minimum = io.row_minimums({"t": frame}, {"t": 26}).first()
    assert (minimum.n_rows, minimum.passed) == (25, False)
    with pytest.raises(ValueError, match="missing columns .*'nope'"):
        io.require_columns(frame, ["id", "nope"])
    with pytest.raises(ValueError):
        io.require_contract(frame, "customer_rfm")


def test_truth_file_keeps_text_entries_that_are_item_ids(spark, tmp_path, rows):
    path = tmp_path / "truth.json"
    path.write_text(json.dumps({"popular": "M001", "other": "X1", "many": ["M002"], "nested": {"a": "M003"}}, indent=1))
    assert rows(io.read_cases(spark, str(path))) == [("popular", "M001")]


def test_malformed_lines_are_rejected_first_and_quarantined_by_table_and_rule(spark, tmp_path, rows):
    (tmp_path / "order_items").mkdir()
    file = tmp_path / "order_items" / "2024_07.csv"
    head = "order_item_id,order_id,item_id,quantity,unit_price,discount_pct,line_total\n"
    bad = ["b,o1,i1,two,10.5,0,21", "c,o1,i1,2", "d,o1,i1,2,10.5,0,21,9"]
    file.write_text(head + "\n".join(["a,o1,i1,2,10.5,0,21", *bad, "e,o1,i1,0,10.5,0,0", "e,o1,i1,0,10.5,0,0", "f,o1,,1,1,0,1"]) + "\n")
    plain = io.read_raw(spark, str(tmp_path), "order_items")
    assert io.MALFORMED not in plain.columns and plain.count() == 7
    raw = {"order_items": io.read_raw(spark, str(tmp_path), "order_items", io.MALFORMED),
           "orders": spark.createDataFrame([("o1", "c1", "L01", "2024-07-01")], "order_id string, customer_id string, location_id string, order_date string"),
           "menu_items": spark.createDataFrame([("i1",)], "item_id string")}
    cleaner = SalesCleaning(raw, locations=["L01"], first_date="2020-01-01", last_date="2025-01-01")
    kept = cleaner.clean("order_items")
    assert rows(kept, "order_item_id") == [("a",)] and kept.columns == plain.columns
    path = str(tmp_path / "quarantine")
    io.write_quarantine(rejected(cleaner.audit("order_items")), path, "order_items")
    held = io.read_quarantine(spark, path)
    assert sorted(r.record for r in held.filter("rule = 'malformed record'").collect()) == bad
    other = held.filter("rule <> 'malformed record'")
    assert sorted((json.loads(r.record)["order_item_id"], r.n_copies) for r in other.collect()) == [("e", 2), ("f", 1)]
    # another table is added, and a table that is written again leaves nothing of its rows before
    io.write_quarantine(spark.createDataFrame([("r1", "x", 1)], "rating_id string, first_failed_rule string, n_copies bigint"), path, "ratings")
    one = cleaner.audit("order_items").filter("order_item_id = 'f'")
    io.write_quarantine(rejected(one), path, "order_items")
    assert rows(io.read_quarantine(spark, path), "table_name", "n_copies") == [("order_items", 1), ("ratings", 1)]
    io.write_quarantine(rejected(one).limit(0), path, "ratings")
    assert io.read_quarantine(spark, path).filter("table_name = 'ratings'").count() == 0


def test_duplicates_are_counted_where_fingerprints_repeat(spark):
    frame = spark.createDataFrame([(1, None), (None, 1), (1, None), (1, None), (2, 2), (None, None), (None, None)], "a int, b int")
    assert quality.exact_duplicates(frame).first().n_duplicates == 3 and quality.exact_duplicates(frame.limit(0)).first().n_duplicates == 0
    marks = frame.distinct().select(quality.fingerprint(frame).alias("f"))
    assert marks.distinct().count() == 4  # a missing value is not stepped over
    # rows that share a fingerprint without being equal are told apart
    every = frame.distinct().select(F.lit("t").alias("table_name"), quality.fingerprint(frame).alias("fingerprint"))
    assert quality._surplus(quality.suspects(frame, every, "t")).first().n_duplicates == 3


def test_tables_without_repeated_fingerprints_are_not_read_again(spark, rows, tmp_path):
    for name, data in (("once", [(1, None), (None, 1)]), ("twice", [(1, 1), (1, 1), (1, None)])):
        spark.createDataFrame(data, "a int, b int").write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("once", "twice")}
    counted = quality.duplicate_counts(tables)
    assert rows(counted) == [("once", 0), ("twice", 1)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/twice" in plan and f"{tmp_path}/once" not in plan


def test_missing_columns_beyond_one_word_of_bits_are_told_apart(spark):
    n = 40
    wide = spark.range(n).select(*[F.when(F.col("id") != i, 1).alias(f"c{i}") for i in range(n)])
    assert wide.select(quality.fingerprint(wide).alias("f")).distinct().count() == n
