"""Evidence-backed recommendations: seven rule families over the model outputs.

Every rule yields the same columns: rule_no, sort_key (larger first), item_id, item_name,
recommended_action, reason and priority.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import decimal_text, percent_text
from larder.functions.fixed import AT_RISK, HIDDEN_OPPORTUNITY, LOW_PERFORMER, LOYAL, PRIORITIES
from larder.operators.basket import top_rules
from larder.sources.io import union_all


def thresholds(items: DataFrame) -> DataFrame:
    """Quantiles the rules compare against, over rounded columns with few distinct values."""
    def quantile(column: str, share: float, name: str) -> Column:
        return F.percentile(column, F.lit(share)).alias(name)
    return items.agg(
        quantile("profit_margin", 0.5, "margin_median"), quantile("profit_margin", 0.9, "margin_p90"),
        quantile("wastage_percent", 0.85, "wastage_p85"), quantile("wastage_percent", 0.95, "wastage_p95"),
        quantile("avg_discount_pct", 0.5, "discount_median"), quantile("avg_rating", 0.5, "rating_median"))


def _top(frame: DataFrame, key: Column, n: int) -> DataFrame:
    return frame.withColumn("sort_key", key.cast("double")).orderBy(F.desc("sort_key"), "item_id").limit(n)


def _rule(frame: DataFrame, rule_no: int, action: Column, reasons: list[Column], priority: Column) -> DataFrame:
    return frame.select(
        F.lit(rule_no).alias("rule_no"), "sort_key", F.col("item_id").cast("string").alias("item_id"), "item_name",
        action.alias("recommended_action"), F.concat_ws(" | ", *reasons).alias("reason"),
        priority.alias("priority"))


def _say(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _either(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def item_rules(items: DataFrame, risk: DataFrame | None = None) -> list[DataFrame]:
    """Promote, prepare less, review pricing, redesign. ``risk`` adds the model score to the evidence."""
    cut = thresholds(items).select(F.struct("*").alias("value")).scalar()
    name = F.col("item_name")
    low = items.filter(F.col("python_label") == LOW_PERFORMER)

    promote = _top(items.filter(F.col("python_label") == HIDDEN_OPPORTUNITY), F.col("profit_margin"), 15)
    rules = [_rule(promote, 1, _say("Promote ", name), [
        _say(percent_text(F.col("profit_margin")), " profit margin (dataset median is ",
             percent_text(cut["margin_median"]), ")"),
        _say("only ", F.format_number("total_quantity_sold", 0),
             " units sold in the period -- under-ordered for how profitable it is"),
        _say(decimal_text(F.col("avg_rating"), 1), "/5 average rating"),
    ], _either(F.col("profit_margin") >= cut["margin_p90"], "High", "Medium"))]

    wasteful = items.filter(F.col("wastage_percent") >= cut["wastage_p85"])
    wasteful = _top(wasteful, F.col("wastage_percent"), 15)
    evidence = [_say(percent_text(F.col("wastage_percent")), " of prepared units go to waste")]
    if risk is not None:
        wasteful = wasteful.join(risk.select("item_id", "predicted_wastage_risk"), "item_id", "left")
        evidence.append(_say("model-predicted wastage risk score ",
                             decimal_text(F.col("predicted_wastage_risk"), 3)))
    rules.append(_rule(wasteful, 2, _say("Reduce preparation quantity of ", name), evidence,
                       _either(F.col("wastage_percent") >= cut["wastage_p95"], "Critical", "High")))

    discounted = _top(low.filter(F.col("avg_discount_pct") > cut["discount_median"]), F.col("avg_discount_pct"), 15)
    rules.append(_rule(discounted, 3, _say("Review pricing or positioning of ", name), [
        F.lit("Low Performer on both volume and margin"),
        _say("already discounted ", decimal_text(F.col("avg_discount_pct"), 1),
             "% on average with no volume payoff to show for it"),
    ], F.lit("Medium")))

    disliked = _top(low.filter(F.col("avg_rating") < cut["rating_median"]), -F.col("avg_rating"), 10)
    rules.append(_rule(disliked, 4, _say("Consider removing or redesigning ", name), [
        F.lit("Low Performer on volume and margin"),
        _say(decimal_text(F.col("avg_rating"), 1), "/5 average rating -- below the ",
             decimal_text(cut["rating_median"], 1),
             " median, so this isn't a hidden gem being underpriced, it's a dish people don't like"),
    ], F.lit("Medium")))
    return rules


def bundle_rule(named_rules: DataFrame, n: int = 10) -> DataFrame:
    a, c, lift = F.col("antecedent_names"), F.col("consequent_names"), F.col("lift")
    best = top_rules(named_rules, n).withColumns({
        "sort_key": lift, "item_id": F.lit("BUNDLE"), "item_name": _say(a, " + ", c)})
    return _rule(best, 5, _say("Bundle ", a, " with ", c), [
        _say("lift ", decimal_text(lift, 2), " (bought together ", decimal_text(lift, 1),
             "x more often than chance would predict)"),
        _say("confidence ", percent_text(F.col("confidence"))),
        _say("support ", percent_text(F.col("support")), " of all multi-item orders"),
    ], F.lit("Medium"))


def stock_rule(forecast: DataFrame, n: int = 5, least: float = 0.05, much: float = 0.20) -> DataFrame:
    """The five fastest-rising categories, of those the ones above five percent.

    History is the mean of the training weeks; test weeks are not part of it.
    """
    ahead = F.avg(F.when(F.col("row_type") == "forecast", F.col("forecast_quantity")))
    past = F.avg(F.when(F.col("row_type") == "actual", F.col("actual_quantity")))
    rise = (forecast.groupBy("category_name").agg((F.try_divide(ahead, past) - 1).alias("sort_key"))
            .filter(F.col("sort_key").isNotNull()).orderBy(F.desc("sort_key"), "category_name").limit(n)
            .filter(F.col("sort_key") > least)
            .select("sort_key", F.lit("CATEGORY").alias("item_id"), F.col("category_name").alias("item_name")))
    sign = F.when(F.col("sort_key") >= 0, F.lit("+")).otherwise(F.lit(""))
    return _rule(rise, 6, _say("Increase stock/prep for ", F.col("item_name"), " ahead of forecast demand"), [
        _say("forecast demand is ", sign, percent_text(F.col("sort_key"), 0),
             " vs. this category's historical weekly average"),
    ], _either(F.col("sort_key") > much, "High", "Medium"))


def segment_rules(segmented: DataFrame, alarm: float = 0.15) -> DataFrame:
    """Two rows, whatever the counts are."""
    counts = segmented.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("segment") == AT_RISK).alias("at_risk"),
                           F.count_if(F.col("segment") == LOYAL).alias("loyal"))
    share = F.coalesce(F.try_divide("loyal", "n"), F.lit(0.0))

    def row(key: float, name: str, action: str, reason: Column, priority: Column) -> Column:
        return F.struct(F.lit(key).alias("sort_key"), F.lit(name).alias("item_name"), F.lit(action).alias("action"),
                        reason.alias("text"), priority.alias("level"))
    rows = F.array(
        row(2.0, "At Risk customers", "Launch a win-back campaign for At Risk customers",
            _say(F.format_number("at_risk", 0),
                 " customers scored 'At Risk' -- ordered often before but haven't recently"),
            _either(F.col("at_risk") > alarm * F.col("n"), "High", "Medium")),
        row(1.0, "Loyal High Spenders", "Build a loyalty/rewards tier for Loyal High Spenders",
            _say(F.format_number("loyal", 0), " customers (", percent_text(share),
                 " of the base) already score as loyal, high-value"), F.lit("Medium")))
    expanded = counts.select(F.inline(rows)).withColumn("item_id", F.lit("SEGMENT"))
    return _rule(expanded, 7, F.col("action"), [F.col("text")], F.col("level"))


def priority_rank(priority: str = "priority") -> Column:
    return F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), F.col(priority))


def combine(rules: list[DataFrame]) -> DataFrame:
    """All recommendations, most urgent first; inside a priority by rule, strength and item."""
    return (union_all(rules).orderBy(priority_rank(), "rule_no", F.desc("sort_key"), "item_id", "item_name")
            .drop("sort_key"))


def recommendation_counts(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("priority").agg(F.count(F.lit(1)).alias("n")).orderBy(priority_rank())


def evidence(recommendations: DataFrame) -> DataFrame:
    """One row per piece of evidence."""
    return recommendations.select("rule_no", "item_id", "item_name", "priority",
                                  F.posexplode(F.split("reason", r" \| ")).alias("evidence_no", "evidence"))


def urgent(recommendations: DataFrame, n: int = 8) -> DataFrame:
    """The first rows that are critical or high."""
    return (recommendations.filter(F.col("priority").isin("Critical", "High"))
            .orderBy(priority_rank(), "rule_no", "item_id", "item_name").limit(n))


def by_priority(recommendations: DataFrame, priorities: list[str]) -> DataFrame:
    return recommendations.filter(F.col("priority").isin(priorities))
