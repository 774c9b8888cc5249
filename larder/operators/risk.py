"""Waste-risk model: which items are likely to be wasted, ranked by a random forest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import rounded
from larder.operators import forest

NUMBERS, CATEGORY = ["units_in", "rating_in"], "category_in"
NAMES = ["total_quantity_sold", "avg_rating"]


def with_target(items: DataFrame) -> DataFrame:
    """Items with a known waste share."""
    return items.filter(F.col("wastage_percent").isNotNull())


def dropped_without_target(items: DataFrame) -> DataFrame:
    missing = F.col("wastage_percent").isNull()
    return items.agg(F.count(F.lit(1)).alias("n_items"), F.count_if(missing).alias("n_dropped"))


def _inputs(items: DataFrame) -> DataFrame:
    # ratings run from 1 to 5, so 0 lets a split set unrated items apart
    return items.withColumns({
        "units_in": F.coalesce(F.col("total_quantity_sold").cast("double"), F.lit(0.0)),
        "rating_in": F.coalesce("avg_rating", F.lit(0.0)),
        "category_in": F.coalesce("category_name", F.lit(""))})


def fit_waste_risk(items: DataFrame, trees: int = 200, sample_rows: int | None = None, seed: int = 42) -> DataFrame:
    """The node table of a forest on units sold, rating and category, all features per split, grown to pure leaves."""
    rows = _inputs(with_target(items)).select("item_id", *NUMBERS, CATEGORY, "wastage_percent")
    return forest.fit_forest(rows, "item_id", NUMBERS, CATEGORY, "wastage_percent", trees, sample_rows, seed)


def score_waste_risk(items: DataFrame, model: DataFrame) -> DataFrame:
    """The rows the model was trained on with their in-sample prediction."""
    scored = forest.score_forest(_inputs(with_target(items)), model, NUMBERS, CATEGORY, "predicted_wastage_risk")
    return scored.select(*items.columns, "predicted_wastage_risk")


def importances(items: DataFrame, model: DataFrame, n: int = 10) -> DataFrame:
    """Importances of all features of the training items, largest first; a feature that never cuts has 0."""
    categories = _inputs(with_target(items)).select(F.concat(F.lit("category_name_"), CATEGORY).alias("feature")).distinct()
    features = categories.unionAll(items.sparkSession.createDataFrame([(name,) for name in NAMES], "feature string"))
    found = forest.feature_weights(model, NAMES, "category_name")
    return (features.join(found, "feature", "left")
            .select("feature", rounded(F.coalesce("importance", F.lit(0.0)), 6).alias("importance"))
            .orderBy(F.desc("importance"), "feature").limit(n))


def top_predicted(scored: DataFrame, n: int = 10) -> DataFrame:
    return (scored.select("item_id", "item_name", "wastage_percent", "predicted_wastage_risk")
            .orderBy(F.desc("predicted_wastage_risk"), "item_id").limit(n))
