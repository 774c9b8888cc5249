"""Weekly demand per category: linear trend against a naive forecast, and a look ahead.

All categories are fitted in one grouped aggregation. After the weekly sum a category is a
short series (one row per week), so the windows below stay small at any data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.io import union_all


def week_start(day: str) -> Column:
    """First day of the week that ends on Monday, i.e. the Tuesday on or before the day."""
    return F.date_add(F.date_trunc("week", F.date_sub(day, 1)).cast("date"), 1)


def weekly_demand(lines: DataFrame, group: str = "category_name") -> DataFrame:
    return (lines.filter(F.col("is_completed") == 1)
            .groupBy(group, week_start("order_date").alias("week_start"))
            .agg(F.sum("quantity").alias("quantity")))


def demand_extent(weekly: DataFrame, group: str = "category_name") -> DataFrame:
    return weekly.agg(F.count_distinct(group).alias("n_categories"),
                      F.count_distinct("week_start").alias("n_weeks"))


def split_series(weekly: DataFrame, group: str = "category_name", test_share: float = 0.2,
                 min_test: int = 4) -> DataFrame:
    """Number the observed weeks of each series and mark the last fifth as test.

    Weeks without a sale are not filled in.
    """
    series = Window.partitionBy(group)
    n = F.count(F.lit(1)).over(series)
    n_test = F.greatest(F.lit(min_test), F.floor(n * F.lit(test_share)))
    return (weekly.withColumns({"t": F.row_number().over(series.orderBy("week_start")) - 1, "n_weeks": n,
                                "n_test_weeks": n_test})
            .withColumn("is_train", F.col("t") < F.col("n_weeks") - F.col("n_test_weeks")))


def fit_trends(series: DataFrame, group: str = "category_name", min_train: int = 10) -> DataFrame:
    """Least-squares trend and last value of the training weeks; short series get no model."""
    return (series.filter("is_train").groupBy(group).agg(
        F.count(F.lit(1)).alias("n_train_weeks"),
        F.max("n_weeks").alias("n_weeks"), F.max("n_test_weeks").alias("n_test_weeks"),
        F.regr_slope("quantity", "t").alias("slope"), F.regr_intercept("quantity", "t").alias("intercept"),
        F.max_by("quantity", "t").alias("naive"))
        .filter(F.col("n_train_weeks") >= min_train))


def _trend(t: Column) -> Column:
    """Trend value; demand is never negative."""
    return F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * t)


def _scored_test(series: DataFrame, models: DataFrame, group: str) -> DataFrame:
    return (series.filter(~F.col("is_train")).select(group, "week_start", "quantity", "t")
            .join(models, group).withColumn("prediction", _trend(F.col("t"))))


def forecast_metrics(series: DataFrame, group: str = "category_name") -> DataFrame:
    """Errors on the test weeks. Weeks without demand do not enter the percentage error."""
    error = F.abs(F.col("quantity") - F.col("prediction"))
    mae_model, mae_naive = F.avg(error), F.avg(F.abs(F.col("quantity") - F.col("naive")))
    return (_scored_test(series, fit_trends(series, group), group).groupBy(group).agg(
        F.max("n_train_weeks").alias("n_train_weeks"), F.max("n_test_weeks").alias("n_test_weeks"),
        mae_naive.alias("mae_baseline"), mae_model.alias("mae_model"),
        F.sqrt(F.avg(error * error)).alias("rmse_model"),
        (F.avg(error / F.nullif(F.col("quantity"), F.lit(0))) * 100).alias("mape_model_pct"))
        .withColumn("beats_baseline", F.col("mae_model") < F.col("mae_baseline")))


def forecast_wins(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count_if("beats_baseline").alias("n_wins"), F.count(F.lit(1)).alias("n_categories"))


def forecast_bands(metrics: DataFrame, good_mape: float = 20.0) -> DataFrame:
    band = (F.when(F.col("beats_baseline") & (F.col("mape_model_pct") < good_mape), F.lit("useful"))
            .when(F.col("beats_baseline"), F.lit("only moderately useful")).otherwise(F.lit("not useful")))
    return metrics.withColumn("usefulness", band)


def forecast_rows(series: DataFrame, group: str = "category_name", weeks_ahead: int = 4) -> DataFrame:
    """Training weeks (actual), test weeks (actual and prediction) and the weeks ahead (forecast).

    The look-ahead continues the training trend; the model is not refitted on the test weeks.
    """
    models = fit_trends(series, group)
    none = F.lit(None).cast("double")
    actual = (series.filter("is_train").join(models.select(group), group, "left_semi")
              .select(group, "week_start", F.col("quantity").alias("actual_quantity"),
                      none.alias("forecast_quantity"), F.lit("actual").alias("row_type")))
    tested = _scored_test(series, models, group).select(
        group, "week_start", F.col("quantity").alias("actual_quantity"),
        F.col("prediction").alias("forecast_quantity"), F.lit("test").alias("row_type"))
    last = series.groupBy(group).agg(F.max("week_start").alias("last_week"))
    ahead = (models.join(last, group)
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(weeks_ahead))))
             .select(group, F.date_add("last_week", F.col("step") * 7).alias("week_start"),
                     F.lit(None).cast("bigint").alias("actual_quantity"),
                     _trend(F.col("n_weeks") + F.col("step") - 1).alias("forecast_quantity"),
                     F.lit("forecast").alias("row_type")))
    return union_all([actual, tested, ahead])


def forecast_series(rows: DataFrame, category: str, group: str = "category_name") -> DataFrame:
    """The chart series of one category: demand, test prediction and look-ahead by week."""
    line = (F.when(F.col("row_type") == "forecast", F.array(F.struct(
        F.lit("future").alias("series"), F.col("forecast_quantity").alias("quantity"))))
        .when(F.col("row_type") == "test", F.array(
            F.struct(F.lit("demand").alias("series"), F.col("actual_quantity").cast("double").alias("quantity")),
            F.struct(F.lit("prediction").alias("series"), F.col("forecast_quantity").alias("quantity"))))
        .otherwise(F.array(F.struct(
            F.lit("demand").alias("series"), F.col("actual_quantity").cast("double").alias("quantity")))))
    return (rows.filter(F.col(group) == category).select("week_start", F.inline(line))
            .orderBy("series", "week_start"))
