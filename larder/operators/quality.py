"""Read-only data-quality profiling: one output row per measured number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import count_true
from larder.functions.fixed import (
    BAD_DISCOUNT, BAD_PRICE, BAD_QUANTITY, BAD_RATING, INVALID_BRANCH, LOCATIONS, Q_CHANNEL, Q_FUTURE, Q_OLD,
    Q_STATUS, Q_STOCK, Q_UNIT, Q_UNPARSEABLE, Q_WASTE,
)
from larder.session import settle
from larder.sources.io import union_all


def as_rows(measured: DataFrame, name_column: str, names: list[str], value_column: str) -> DataFrame:
    """Turn the one-row frame with columns m0, m1, ... into one row per name."""
    entries = F.array(*[
        F.struct(F.lit(n).alias(name_column), F.col(f"m{i}").alias(value_column)) for i, n in enumerate(names)])
    return measured.select(F.inline(entries))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        f.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, f in tables.items()])


def fingerprint(frame: DataFrame) -> Column:
    """A 64-bit hash of a row. Which columns are NULL is hashed too, as bits, as the hash itself steps over them."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i % 31)).otherwise(F.lit(0)) for i, c in enumerate(frame.columns)]
    missing = [reduce(Column.bitwiseOR, bits[i:i + 31]) for i in range(0, len(bits), 31)]
    return F.xxhash64(*frame.columns, *missing)


def repeated_fingerprints(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (table_name, fingerprint) of the fingerprints that occur more than once, written as a table.

    Sixteen bytes a row are shuffled, whatever the row's width, and copies are counted before that.
    """
    marks = union_all([f.select(F.lit(n).alias("table_name"), fingerprint(f).alias("fingerprint")) for n, f in tables.items()])
    counts = marks.groupBy("table_name", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
    return settle(counts.filter("n > 1").select("table_name", "fingerprint"), "repeated")


def suspects(frame: DataFrame, repeated: DataFrame, table_name: str, how: str = "left_semi") -> DataFrame:
    """The rows whose fingerprint is repeated, or with ``left_anti`` the others, which can have no copy."""
    keys = repeated.filter(F.col("table_name") == table_name).select(F.col("fingerprint").alias("_fingerprint"))
    return frame.withColumn("_fingerprint", fingerprint(frame)).join(keys, "_fingerprint", how).select(*frame.columns)


def _surplus(rows: DataFrame) -> DataFrame:
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def duplicate_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of surplus copies per table. Only rows whose fingerprint is repeated are compared as a whole, so rows
    that merely share a fingerprint are told apart and all others are never shuffled. A table without a repeated
    fingerprint has no copies and is not read again."""
    repeated = repeated_fingerprints(tables)
    again = {r["table_name"] for r in repeated.select("table_name").distinct().collect()}  # names of tables only
    none = repeated.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("n_duplicates"))
    return union_all([
        (_surplus(suspects(f, repeated, n)) if n in again else none).select(F.lit(n).alias("table_name"), "n_duplicates")
        for n, f in tables.items()])


def exact_duplicates(frame: DataFrame) -> DataFrame:
    """Number of surplus copies of one table."""
    return duplicate_counts({"": frame}).select("n_duplicates")


def null_profile(frame: DataFrame, table_name: str, complete: bool = False) -> DataFrame:
    """Columns with missing values: count and share of rows in percent. One pass for all columns.

    With ``complete`` columns without missing values are listed too.
    """
    measured = frame.agg(
        F.count(F.lit(1)).alias("total"),
        *[count_true(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(frame.columns)])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing"))
        for i, c in enumerate(frame.columns)])
    return (measured.select(F.lit(table_name).alias("table_name"), "total", F.inline(entries))
            .filter(F.lit(complete) | (F.col("n_missing") > 0))
            .select("table_name", "column_name", "n_missing",
                    F.round(F.col("n_missing") * F.lit(100).cast("decimal(3,0)") / F.col("total"), 2)
                    .cast("double").alias("pct_missing")))


def null_profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([null_profile(f, n) for n, f in tables.items()])


def rule_counts(frame: DataFrame, table_name: str, rules: dict[str, Column]) -> DataFrame:
    """How many rows meet each condition, all in one pass. A NULL condition does not count."""
    measured = frame.agg(*[count_true(c).alias(f"m{i}") for i, c in enumerate(rules.values())])
    return as_rows(measured, "rule", list(rules), "n_rows").select(F.lit(table_name).alias("table_name"), "*")


def _tidy(text: Column) -> Column:
    return F.initcap(F.trim(text))


def order_rules(as_of: Column | None = None, first_date: str = "2015-01-01",
                locations: list[str] = LOCATIONS) -> dict[str, Column]:
    date = F.try_to_date(F.col("order_date").cast("string"), "yyyy-MM-dd")
    return {
        Q_UNPARSEABLE: date.isNull() & F.col("order_date").isNotNull(),
        Q_FUTURE: date > (F.current_date() if as_of is None else as_of),
        Q_OLD: date < F.lit(first_date).cast("date"),
        INVALID_BRANCH: ~F.col("location_id").isin(locations),
        Q_CHANNEL: F.col("channel") != _tidy(F.col("channel")),
        Q_STATUS: F.col("status") != _tidy(F.lower("status")),
    }


def table_rules(**order_options) -> dict[str, dict[str, Column]]:
    """The bad-record conditions of every table that has any."""
    waste, rating, discount = F.col("quantity_wasted"), F.col("rating_value"), F.col("discount_pct")
    return {
        "orders": order_rules(**order_options),
        "order_items": {BAD_QUANTITY: F.col("quantity") <= 0, BAD_PRICE: F.col("unit_price") <= 0,
                        BAD_DISCOUNT: ~discount.between(0, 100)},
        "ratings": {BAD_RATING: ~rating.between(1, 5)},
        "wastage": {Q_WASTE: ~((waste > 0) & (waste <= 1000))},
        "inventory": {Q_STOCK: F.col("closing_stock") < 0, Q_UNIT: F.col("unit") != F.lower("unit")},
    }


def quality_rules(tables: dict[str, DataFrame], **order_options) -> DataFrame:
    return union_all([rule_counts(tables[n], n, r) for n, r in table_rules(**order_options).items()])


def unmatched_rows(frame: DataFrame, keys: DataFrame, key: str, rule: str, table_name: str,
                   skip_null: bool = False) -> DataFrame:
    """Rows whose key is absent from ``keys``.

    Rows are counted per key first, so a hot key costs one row in the anti join.
    """
    rows = frame.filter(F.col(key).isNotNull()) if skip_null else frame
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(keys.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows")).select(
        F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"), "n_rows")


def defect_summary(orders: DataFrame, lines: DataFrame, ratings: DataFrame, wastage: DataFrame,
                   locations: list[str] = LOCATIONS) -> DataFrame:
    """The ten planted kinds of defect, counted on the raw tables."""
    def counted(frame: DataFrame, conditions: dict[str, Column]) -> DataFrame:
        measured = frame.agg(*[count_true(c).alias(f"m{i}") for i, c in enumerate(conditions.values())])
        return as_rows(measured, "defect", list(conditions), "n_rows")
    duplicates = exact_duplicates(orders).select(
        F.lit("duplicate orders").alias("defect"), F.col("n_duplicates").alias("n_rows"))
    return union_all([
        duplicates,
        counted(orders, {
            "missing customer_id": F.col("customer_id").isNull(),
            "invalid location_id": ~F.coalesce(F.col("location_id").isin(locations), F.lit(False)),
            "cancelled orders": F.lower(F.trim("status")) == "cancelled"}),
        counted(lines, {
            "negative/zero quantity": F.col("quantity") <= 0,
            "price <= 0": F.col("unit_price") <= 0,
            "missing item_id": F.col("item_id").isNull(),
            "invalid discount": (F.col("discount_pct") < 0) | (F.col("discount_pct") > 100)}),
        counted(ratings, {"ratings outside 1-5": ~F.coalesce(F.col("rating_value").between(1, 5), F.lit(False))}),
        counted(wastage, {
            "impossible wastage qty": (F.col("quantity_wasted") < 0) | (F.col("quantity_wasted") > 1000)}),
    ])
