"""Customer segmentation from recency, frequency and money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import rounded, safe_ratio
from larder.functions.fixed import (
    AT_RISK, AT_RISK_NAMED, FREQUENT, HIGH_VALUE_LOYAL, LOYAL, NEW_CUSTOMER, NEW_CUSTOMERS, OCCASIONAL,
    PROMOTION_DRIVEN, REGULAR,
)
from larder.operators.ranking import global_row_number, quantiles_of_ranked, rank_bounds
from larder.session import settle


def recency_profile(rfm: DataFrame) -> DataFrame:
    return rfm.agg(F.min("recency_days").alias("min_days"), F.max("recency_days").alias("max_days"),
                   F.median("recency_days").alias("median_days"))


def _fifth(rfm: DataFrame, measure: str) -> Column:
    """Fifth (1..5) of a row by its place in the order of a measure, edges right-closed as in a quantile cut."""
    place, score = F.struct(measure, "customer_id"), F.lit(5)
    for fifth, last in reversed(list(enumerate(rank_bounds(rfm, measure, "customer_id", [k / 5 for k in (1, 2, 3, 4)]), 1))):
        score = F.when(place <= last, F.lit(fifth)).otherwise(score)
    return score


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Scores 1..5 for recency, frequency and money and their sum.

    Recency is cut at its exact quantiles, so equal day counts share a score. Frequency and
    money are cut by rank with ties broken by customer: the last customers of the fifths are looked
    up in a sort of two columns, and rows are compared with them where they lie.
    """
    edges = rfm.agg(F.percentile("recency_days", F.array(*[F.lit(s) for s in (0.2, 0.4, 0.6, 0.8)]))
                    .alias("value")).scalar()
    recency = F.lit(1)
    for i, score in ((3, 2), (2, 3), (1, 4), (0, 5)):
        recency = F.when(F.col("recency_days") <= edges[i], F.lit(score)).otherwise(recency)
    rfm = settle(rfm, "rfm")  # read by three rankings and by the result
    return (rfm.withColumns({"r_score": recency, "f_score": _fifth(rfm, "frequency"), "m_score": _fifth(rfm, "monetary")})
            .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .select(*rfm.columns, "r_score", "f_score", "m_score", "rfm_score"))


def rfm_segments(scored: DataFrame) -> DataFrame:
    """The first segment whose condition holds."""
    r, f = F.col("r_score"), F.col("f_score")
    return scored.withColumn(
        "segment", F.when(F.col("rfm_score") >= 12, F.lit(LOYAL)).when((r <= 2) & (f >= 3), F.lit(AT_RISK))
        .when((f <= 2) & (r >= 4), F.lit(NEW_CUSTOMER)).otherwise(F.lit(REGULAR)))


def segment_counts(segmented: DataFrame) -> DataFrame:
    return (segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("n_customers"))
            .orderBy(F.desc("n_customers"), "segment"))


def customer_profile(lines: DataFrame, rfm: DataFrame, orders: DataFrame) -> DataFrame:
    """RFM with tenure (first to last completed order) and the share of orders on a promotion."""
    per_order = (lines.filter(F.col("is_completed") == 1)
                 .groupBy("customer_id", "order_id").agg(F.max("order_date").alias("day")))
    promo = orders.select("order_id", F.col("promo_id").isNotNull().cast("int").alias("on_promo"))
    history = per_order.join(promo, "order_id").groupBy("customer_id").agg(
        F.datediff(F.max("day"), F.min("day")).alias("tenure_days"),
        rounded(F.avg("on_promo"), 4).alias("promo_order_share"))
    return rfm.join(history, "customer_id")


def population_quantiles(profile: DataFrame) -> DataFrame:
    """The eight quantiles the named segments compare against.

    Spending has about as many values as customers and goes through the ranked form; counts
    and days have few values.
    """
    ranked = global_row_number(profile.select("monetary", "customer_id"), ["monetary", "customer_id"])
    money = quantiles_of_ranked(ranked, "monetary", "row_number", {"monetary_75": 0.75, "monetary_50": 0.5})
    money = money.select(F.struct("*").alias("value")).scalar()
    picks = [("frequency", "frequency_75", 0.75), ("frequency", "frequency_66", 0.66),
             ("frequency", "frequency_50", 0.5), ("recency_days", "recency_50", 0.5),
             ("recency_days", "recency_66", 0.66), ("tenure_days", "tenure_20", 0.2)]
    few_valued = profile.agg(*[F.percentile(c, F.lit(s)).alias(n) for c, n, s in picks])
    return few_valued.select(money["monetary_75"].alias("monetary_75"), money["monetary_50"].alias("monetary_50"),
                             *[n for _, n, _ in picks])


def named_segments(profile: DataFrame) -> DataFrame:
    """Six named segments; the first condition that holds wins."""
    q = population_quantiles(profile).select(F.struct("*").alias("value")).scalar()
    money, freq, recency = F.col("monetary"), F.col("frequency"), F.col("recency_days")
    name = (F.when((money >= q["monetary_75"]) & (freq >= q["frequency_75"]) & (recency <= q["recency_50"]),
                   F.lit(HIGH_VALUE_LOYAL))
            .when(F.col("tenure_days") <= q["tenure_20"], F.lit(NEW_CUSTOMERS))
            .when((recency >= q["recency_66"]) & ((freq >= q["frequency_50"]) | (money >= q["monetary_50"])),
                  F.lit(AT_RISK_NAMED))
            .when(F.col("promo_order_share") >= 0.5, F.lit(PROMOTION_DRIVEN))
            .when(freq >= q["frequency_66"], F.lit(FREQUENT))
            .otherwise(F.lit(OCCASIONAL)))
    return profile.withColumn("segment_name", name)
