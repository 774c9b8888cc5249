"""Frequent itemsets and association rules over order baskets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import one_row
from larder.session import settle


def basket_sizes(lines: DataFrame) -> DataFrame:
    """Completed lines per order."""
    return (lines.filter(F.col("is_completed") == 1).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def basket_split(lines: DataFrame) -> DataFrame:
    """Orders with several lines (used) and with one line (dropped)."""
    return basket_sizes(lines).agg(F.count_if(F.col("n_lines") > 1).alias("multi_line_orders"),
                                   F.count_if(F.col("n_lines") == 1).alias("single_line_orders"))


def basket_items(lines: DataFrame) -> DataFrame:
    """Distinct (order, item) pairs of orders with more than one line.

    The test is on lines, not on distinct items. The lines are read once: pairs are counted, and an order's lines
    are the sum over its pairs, whose rows lie together already.
    """
    counted = (lines.filter((F.col("is_completed") == 1) & F.col("order_id").isNotNull())
               .groupBy("order_id", "item_id").agg(F.count(F.lit(1)).alias("n")))
    of_order = F.sum("n").over(Window.partitionBy("order_id"))
    return counted.withColumn("n_lines", of_order).filter(F.col("n_lines") > 1).select("order_id", "item_id")


def frequent_items(pairs: DataFrame, n_baskets, min_support: float) -> DataFrame:
    return (pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= F.lit(min_support) * n_baskets).select("item_id"))


def baskets(pairs: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """One set of items per order.

    With ``keep`` only frequent items enter a set. There are at most (mean basket size /
    support) of those, which bounds every set even if one order holds most lines; orders
    left empty stay, because they count in the denominator.
    """
    if keep is None:
        return pairs.groupBy("order_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    marked = pairs.join(keep.withColumn("frequent", F.lit(True)), "item_id", "left")
    return marked.groupBy("order_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("frequent"), F.col("item_id")))).alias("items"))


def frequent_itemsets(lines: DataFrame, min_support: float = 0.01, fallback: float | None = 0.005) -> DataFrame:
    """Itemsets of any size with at least ``min_support``, or ``fallback`` where nothing reaches it."""
    pairs = settle(basket_items(lines))
    n_baskets = one_row(pairs, F.count_distinct("order_id").alias("n"))["n"]
    found = _mine(pairs, n_baskets, min_support)
    if fallback is not None and found.isEmpty():
        found = _mine(pairs, n_baskets, fallback)
    return found


def _mine(pairs: DataFrame, n_baskets: Column, support: float) -> DataFrame:
    # the miner reads the sets several times, so they are written once
    sets = settle(baskets(pairs, frequent_items(pairs, n_baskets, support)).select("items"), "sets")
    # small baskets arrive in few partitions; mining is spread over all cores all the same
    cores = pairs.sparkSession.sparkContext.defaultParallelism
    model = FPGrowth(itemsCol="items", minSupport=support, numPartitions=cores).fit(sets)
    # the model is lazy and its rows are read several times, so mining is settled once
    return settle(model.freqItemsets.select(
        F.array_sort("items").alias("items"), F.col("freq"), (F.col("freq") / n_baskets).alias("support")))


def association_rules(itemsets: DataFrame, min_lift: float = 1.2) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, with support, confidence, lift.

    Splits are made level by level: each level takes one item out of the antecedents of the level before and keeps
    what is a known itemset, as every subset of a frequent itemset is. Itemsets may be of any size; a row holds one
    split. Lift does not fall steadily along the levels, so it only filters the finished rules.
    """
    known = itemsets.select("items", "support")
    sides = known.select(F.col("items").alias("antecedents"), F.col("support").alias("s_a"))
    level = itemsets.filter(F.size("items") > 1).select("items", "support", F.col("items").alias("antecedents"))
    splits = None
    while True:
        smaller = (level.filter(F.size("antecedents") > 1)
                   .select("items", "support", F.explode(F.transform("antecedents", lambda x: F.array_remove("antecedents", x)))
                           .alias("antecedents")).distinct())
        level = settle(smaller.join(sides, "antecedents").select("items", "support", "antecedents", "s_a"), "splits")
        splits = level if splits is None else splits.unionAll(level)
        if level.isEmpty():
            break
    return (splits.withColumn("consequents", F.array_except("items", "antecedents"))
            .join(known.select(F.col("items").alias("consequents"), F.col("support").alias("s_c")), "consequents")
            .select("antecedents", "consequents", "support",
                    (F.col("support") / F.col("s_a")).alias("confidence"),
                    (F.col("support") / F.col("s_a") / F.col("s_c")).alias("lift"))
            .filter(F.col("lift") >= min_lift))


def name_rules(rules: DataFrame, names: DataFrame) -> DataFrame:
    """Add the item names of both sides, joined by ', '. An item without a name keeps its id.

    ``names`` has item_id and item_name. Items of a rule are few, so a side is regrouped whole.
    """
    result = rules
    for side, out in (("antecedents", "antecedent_names"), ("consequents", "consequent_names")):
        texts = (rules.select(side).distinct()
                 .select(side, F.posexplode(side).alias("pos", "item_id"))
                 .join(names, "item_id", "left")
                 .groupBy(side).agg(F.array_sort(F.collect_list(F.struct(
                     "pos", F.coalesce("item_name", F.col("item_id").cast("string")).alias("text")))).alias("t"))
                 .select(side, F.concat_ws(", ", F.transform("t", lambda e: e["text"])).alias(out)))
        result = result.join(texts, side)
    return result.select("antecedents", "consequents", "antecedent_names", "consequent_names", "support",
                         "confidence", "lift")


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """The strongest rules; equal lifts are ordered by confidence, then by items."""
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), "antecedents", "consequents").limit(n)
