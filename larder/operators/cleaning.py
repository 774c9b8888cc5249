"""Rule-based cleaning with an account of every removed row.

A table has an ordered list of rules. A row is charged to the first rule it breaks, after
exact copies were collapsed; a NULL condition counts as broken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import count_true
from larder.functions.fixed import (
    BAD_DISCOUNT, BAD_PRICE, BAD_QUANTITY, BAD_RATING, EXACT_DUPLICATES, FIRST_PLAUSIBLE_DATE, IMPLAUSIBLE_DATE,
    IMPOSSIBLE_WASTE, INVALID_BRANCH, INVALID_LOCATION, LAST_PLAUSIBLE_DATE, LOCATIONS, MISSING_CUSTOMER,
    MISSING_ITEM, NEGATIVE_STOCK, ORPHAN_LINES, ORPHAN_RATING, UNKNOWN_ITEM, UNPARSEABLE_DATE,
)
from larder.session import settle
from larder.sources.io import MALFORMED, union_all

MALFORMED_RECORD = "malformed record"


@dataclass(frozen=True)
class Rule:
    """Rows are kept where ``keep`` holds, or where ``key`` occurs in ``known``."""

    name: str
    keep: Column | None = None
    key: str | None = None
    known: DataFrame | None = None


def surviving_rows(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that break no rule, copies included. Row conditions run first, next to the scan."""
    conditions = [r.keep for r in rules if r.keep is not None]
    kept = frame.filter(reduce(lambda a, b: a & b, conditions)) if conditions else frame
    for rule in rules:
        if rule.known is not None:
            kept = kept.join(rule.known.select(rule.key), rule.key, "left_semi").select(*frame.columns)
    return kept


def clean_rows(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """The surviving rows, one copy of each."""
    return surviving_rows(frame, rules).dropDuplicates()


def audit_rows(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct rows with ``n_copies`` and ``first_failed_rule`` (NULL for survivors)."""
    rows = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("n_copies"))
    checks = []
    for i, rule in enumerate(rules):
        keep = rule.keep
        if rule.known is not None:
            keys = rule.known.select(F.col(rule.key), F.lit(True).alias(f"_known{i}")).distinct()
            rows = rows.join(keys, rule.key, "left")
            keep = F.col(f"_known{i}")
        checks.append(F.when(~F.coalesce(keep, F.lit(False)), F.lit(rule.name)))
    failed = F.coalesce(*checks) if checks else F.lit(None).cast("string")
    return rows.select(*frame.columns, "n_copies", failed.alias("first_failed_rule"))


def removal_summary(audited: DataFrame, table_name: str, rules: list[Rule]) -> DataFrame:
    """Rows removed per rule, in rule order; rules that removed nothing report zero."""
    names = [r.name for r in rules]
    measured = audited.agg(
        F.coalesce(F.sum(F.col("n_copies") - 1), F.lit(0)).cast("bigint").alias("m0"),
        *[count_true(F.col("first_failed_rule") == n).alias(f"m{i}") for i, n in enumerate(names, 1)])
    entries = F.array(*[
        F.struct(F.lit(i).alias("rule_no"), F.lit(n).alias("rule"), F.col(f"m{i}").alias("removed"))
        for i, n in enumerate([EXACT_DUPLICATES, *names])])
    return measured.select(F.lit(table_name).alias("table_name"), F.inline(entries))


def before_and_after(audited: DataFrame, table_name: str) -> DataFrame:
    return audited.agg(
        F.coalesce(F.sum("n_copies"), F.lit(0)).cast("bigint").alias("n_raw"),
        count_true(F.col("first_failed_rule").isNull()).alias("n_clean"),
    ).select(F.lit(table_name).alias("table_name"), "n_raw", "n_clean")


def rejected(audited: DataFrame) -> DataFrame:
    """The rejected rows, each with the rule that rejected it."""
    return audited.filter(F.col("first_failed_rule").isNotNull())


class SalesCleaning:
    """The rules of the eleven sales tables, bound to a set of raw tables."""

    def __init__(self, raw: dict[str, DataFrame], locations: list[str] = LOCATIONS,
                 first_date: str = FIRST_PLAUSIBLE_DATE, last_date: str = LAST_PLAUSIBLE_DATE):
        self.raw = raw
        self.locations = locations
        self.first_date = first_date
        self.last_date = last_date

    def _located(self, name: str) -> Rule:
        return Rule(name, F.col("location_id").isin(self.locations))

    def rules(self, table: str) -> list[Rule]:
        """The rules of a table; one scanned with malformed lines kept has them rejected first, under a rule of their own."""
        malformed = [Rule(MALFORMED_RECORD, F.col(MALFORMED).isNull())] if MALFORMED in self.raw[table].columns else []
        return malformed + self._rules(table)

    def _rules(self, table: str) -> list[Rule]:
        date = F.try_to_date(F.col("order_date").cast("string"), "yyyy-MM-dd")
        if table == "orders":
            return [
                Rule(MISSING_CUSTOMER, F.col("customer_id").isNotNull()),
                self._located(INVALID_BRANCH),
                Rule(UNPARSEABLE_DATE, date.isNotNull()),
                Rule(IMPLAUSIBLE_DATE, date.between(F.lit(self.first_date).cast("date"),
                                                    F.lit(self.last_date).cast("date"))),
            ]
        if table == "order_items":
            return [
                Rule(MISSING_ITEM, F.col("item_id").isNotNull()),
                Rule(UNKNOWN_ITEM, key="item_id", known=self.surviving("menu_items")),
                Rule(BAD_QUANTITY, F.col("quantity") > 0),
                Rule(BAD_PRICE, F.col("unit_price") > 0),
                Rule(BAD_DISCOUNT, F.col("discount_pct").between(0, 100)),
                Rule(ORPHAN_LINES, key="order_id", known=self.order_keys),
            ]
        if table == "ratings":
            return [
                Rule(BAD_RATING, F.col("rating_value").between(1, 5)),
                Rule(ORPHAN_RATING, key="order_id", known=self.order_keys),
            ]
        if table == "wastage":
            return [
                Rule(IMPOSSIBLE_WASTE, F.col("quantity_wasted").between(1, 1000)),
                self._located(INVALID_LOCATION),
                Rule(MISSING_ITEM, F.col("item_id").isNotNull()),
                Rule(UNKNOWN_ITEM, key="item_id", known=self.surviving("menu_items")),
            ]
        if table == "inventory":
            return [Rule(NEGATIVE_STOCK, F.col("closing_stock") >= 0), self._located(INVALID_LOCATION)]
        return []

    @cached_property
    def order_keys(self) -> DataFrame:
        """The ids of the orders that break no rule, written once, as several tables are held against them."""
        return settle(self.surviving("orders").select("order_id").distinct(), "order-keys")

    def surviving(self, table: str) -> DataFrame:
        """Rows for key lookups, where copies do not matter and a dedupe would cost a shuffle."""
        return surviving_rows(self.raw[table], self.rules(table))

    def clean(self, table: str) -> DataFrame:
        return standardise(clean_rows(self.raw[table], self.rules(table)).drop(MALFORMED), table)

    def audit(self, table: str) -> DataFrame:
        return audit_rows(self.raw[table], self.rules(table))

    def summary(self) -> DataFrame:
        return union_all([removal_summary(self.audit(t), t, self.rules(t)) for t in self.raw])

    def row_counts(self) -> DataFrame:
        return union_all([before_and_after(self.audit(t), t) for t in self.raw])


def standardise(frame: DataFrame, table: str) -> DataFrame:
    """One spelling for text codes. Missing values stay missing."""
    if table == "orders":
        return frame.withColumns({
            "channel": F.initcap(F.trim("channel")), "status": F.initcap(F.trim(F.lower("status")))})
    if table == "customers":
        return frame.withColumn("home_city", F.initcap(F.trim("home_city")))
    if table == "inventory":
        return frame.withColumn("unit", F.lower(F.trim("unit")))
    return frame
