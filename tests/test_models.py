import datetime
import itertools
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.operators import basket, classify, forecast, ranking, segments


def test_global_row_number_spreads_ties(spark):
    random.seed(1)
    data = [(i, random.choice([1, 1, 1, 2, 9])) for i in range(500)]
    random.shuffle(data)
    out = ranking.global_row_number(spark.createDataFrame(data, "id int, v int").repartition(7), ["v", "id"])
    want = {i: n for n, (v, i) in enumerate(sorted((v, i) for i, v in data), 1)}
    assert {r.id: r.row_number for r in out.collect()} == want
    q = ranking.quantiles_of_ranked(out, "v", "row_number", {"a": 0.5, "b": 0.87, "c": 1.0}).first()
    assert (q.a, q.b, q.c) == pytest.approx(tuple(np.quantile([v for _, v in data], [0.5, 0.87, 1.0])))


@pytest.mark.parametrize("n", [5, 7, 23, 101])
def test_rfm_scores_equal_quantile_cuts(spark, n):
    rng = np.random.default_rng(n)
    frame = pd.DataFrame({"customer_id": range(n), "frequency": rng.integers(1, 6, n),
                          "monetary": rng.uniform(1, 99, n).round(2), "recency_days": rng.permutation(n * 3)[:n]})
    out = segments.rfm_scores(spark.createDataFrame(frame)).toPandas().sort_values("customer_id")
    ids = frame.sort_values("customer_id")
    r = pd.qcut(ids.recency_days, 5, labels=[5, 4, 3, 2, 1]).astype(int)
    f = pd.qcut(ids.frequency.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    m = pd.qcut(ids.monetary.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert list(out.r_score) == list(r) and list(out.f_score) == list(f) and list(out.m_score) == list(m)


def test_segments_first_match_wins(spark):
    scored = spark.createDataFrame([(5, 4, 12), (2, 3, 9), (4, 2, 9), (3, 3, 9), (2, 5, 12)],
                                   "r_score int, f_score int, rfm_score int")
    assert [r.segment for r in segments.rfm_segments(scored).collect()] == [
        "Loyal High Spender", "At Risk", "New Customer", "Regular", "Loyal High Spender"]


# Even counts: the sketch takes the lower middle value. Margins rise and units fall with the id here,
# so one middle item passes the margin cut and the other the units cut of the sketch only.
@pytest.mark.parametrize("n, disagreements", [(161, 0), (162, 2)])
def test_medians_agree_only_for_odd_counts(spark, n, disagreements):
    items = spark.createDataFrame([(i, f"n{i}", i / 100, 1000 - i) for i in range(n)],
                                  "item_id int, item_name string, profit_margin double, total_quantity_sold int")
    compared = classify.compare_labels(classify.classify_approx(items), classify.classify_exact(items))
    row = classify.agreement(compared).first()
    assert row.n_disagree == classify.disagreements(compared).count() == disagreements
    assert row.n_items == n


def test_lower_middle_of_more_values_than_a_sketch_keeps(spark):
    n = 60_000
    items = spark.range(n, numPartitions=6).selectExpr("cast((id * 7919) % 60000 as double) / 10000 as profit_margin", "(id * 104729) % 60000 as total_quantity_sold")
    row = classify.approx_medians(items).first()
    assert (row.median_margin, row.median_units) == ((n // 2 - 1) / 10_000, n // 2 - 1)
    assert dict(classify.approx_medians(items).dtypes) == {"median_margin": "double", "median_units": "bigint"}


def test_missing_margin_is_a_low_performer(spark):
    items = spark.createDataFrame([(1, None, 10), (2, 0.5, 1), (3, 0.2, 20)],
                                  "item_id int, profit_margin double, total_quantity_sold int")
    out = {r.item_id: r.python_label for r in classify.classify_exact(items).collect()}
    assert out[1] == "Low Performer"


def test_multi_indicator_label_follows_percent_ranks(spark):
    rng = np.random.default_rng(3)
    n = 60
    frame = pd.DataFrame({
        "item_id": range(n), "units": rng.integers(1, 40, n), "profit_margin": rng.uniform(-1, 1, n).round(2),
        "avg_rating": rng.uniform(1, 5, n).round(1), "repeat_purchase_rate": rng.uniform(0, 1, n).round(1),
        "wastage_percent": rng.uniform(0, 0.3, n).round(2), "insufficient_history": rng.random(n) < 0.2})
    out = classify.multi_indicator_label(spark.createDataFrame(frame)).toPandas().set_index("item_id").rule_label
    d = frame[~frame.insufficient_history]
    share = {c: (d[c].rank(method="min") - 1) / (len(d) - 1) for c in d.columns if c not in ("item_id", "insufficient_history")}
    quality = 0.5 * share["avg_rating"] + 0.25 * share["repeat_purchase_rate"] + 0.25 * (1 - share["wastage_percent"])
    for i, row in frame.iterrows():
        if row.insufficient_history:
            want = "Insufficient History"
        else:
            v, m, w = share["units"][i] >= 0.5, share["profit_margin"][i] >= 0.5, row.wastage_percent <= 0.12
            want = ("Profit Driver" if v and m and w and quality[i] >= 0.4 else "Volume Driver" if v and not (m and w)
                    else "Hidden Opportunity" if not v and m and quality[i] >= 0.55 else "Low Performer")
        assert out[row.item_id] == want, row.item_id


def test_split_bucket_is_crc32(spark):
    out = classify.split_bucket(spark.createDataFrame([("M001", "L01"), ("M002", "L20")], "a string, b string"), ["a", "b"])
    for r in out.collect():
        assert r.bucket == zlib.crc32(f"{r.a}|{r.b}".encode()) % 100
        assert r.split == ("train" if r.bucket < 60 else "validation" if r.bucket < 80 else "test")


def test_metrics(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    row = classify.classification_metrics(spark.createDataFrame(pairs, "t string, p string"), "t", "p").first()
    # f1: a = 2/4, b = 4/5, c = 0
    assert (row.n, row.accuracy, row.macro_f1, row.weighted_f1) == (5, 0.6, round((0.5 + 0.8) / 3, 4), 0.52)
    y, p = np.array([10.0, 4.0, 6.0, 20.0]), np.array([8.0, 5.0, 6.0, 25.0])
    row = classify.regression_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    assert row.mae == 2.0 and row.rmse == round(float(np.sqrt(7.5)), 3)
    assert row.mape == round(float(np.mean([0.2, 0.0, 0.25]) * 100), 2)
    assert row.r2 == round(1 - 30 / float(((y - y.mean()) ** 2).sum()), 4)


def test_rules_equal_brute_force(spark):
    rng = random.Random(5)
    baskets = [(o, sorted(rng.sample("abcdef", rng.randint(1, 4)))) for o in range(200)]
    lines = spark.createDataFrame([(o, i, 1) for o, items in baskets for i in items] + [(999, "a", 0)],
                                  "order_id int, item_id string, is_completed int")
    used = [set(items) for _, items in baskets if len(items) > 1]
    support = {}
    for k in range(1, 5):
        for s in itertools.combinations("abcdef", k):
            share = sum(set(s) <= b for b in used) / len(used)
            if share >= 0.05:
                support[s] = share
    sets = basket.frequent_itemsets(lines, 0.05, None)
    assert {tuple(r["items"]): round(r.support, 9) for r in sets.collect()} == {s: round(v, 9) for s, v in support.items()}
    want = {}
    for s, v in support.items():
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                c = tuple(x for x in s if x not in a)
                if v / support[a] / support[c] >= 1.1:
                    want[a, c] = round(v / support[a] / support[c], 9)
    rules = basket.association_rules(sets, 1.1)
    assert {(tuple(r.antecedents), tuple(r.consequents)): round(r.lift, 9) for r in rules.collect()} == want
    assert any(len(c) > 1 for _, c in want)
    names = spark.createDataFrame([("a", "Apple")], "item_id string, item_name string")
    named = {tuple(r.antecedents): r.antecedent_names for r in basket.name_rules(rules, names).collect()}
    assert all(text == ", ".join("Apple" if i == "a" else i for i in a) for a, text in named.items())


def test_basket_items_read_lines_once(spark, rows, tmp_path):
    data = [(1, "a", 1), (1, "a", 1), (2, "a", 1), (2, "b", 0), (3, "b", 1), (3, None, 1), (None, "a", 1), (None, "b", 1)]
    spark.createDataFrame(data, "order_id int, item_id string, is_completed int").write.parquet(f"{tmp_path}/lines")
    pairs = basket.basket_items(spark.read.parquet(f"{tmp_path}/lines"))
    assert rows(pairs) == [(1, "a"), (3, "b"), (3, None)]  # lines count, not items; lines without an order are no basket
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_basket_filter_counts_lines_and_fallback_support_applies(spark, rows):
    lines = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", 1)], "order_id int, item_id string, is_completed int")
    assert tuple(basket.basket_split(lines).first()) == (1, 1)
    assert rows(basket.frequent_itemsets(lines, 0.9), "freq") == [(1,)]
    wide = spark.createDataFrame([(o, f"i{o}{k}", 1) for o in range(150) for k in (1, 2)],
                                 "order_id int, item_id string, is_completed int")
    assert basket.frequent_itemsets(wide, 0.01, None).count() == 0
    assert basket.frequent_itemsets(wide, 0.01, 0.005).count() == 150 * 3


def test_weeks_start_on_tuesday(spark):
    first = datetime.date(2024, 7, 1)
    days = spark.createDataFrame([(first + datetime.timedelta(i),) for i in range(730)], "day date")
    out = days.select("day", forecast.week_start("day").alias("w")).collect()
    assert all(r.w == pd.Timestamp(r.day).to_period("W-MON").start_time.date() for r in out)
    assert len({r.w for r in out}) == 106


def test_forecast_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    start = datetime.date(2024, 1, 2)
    data = [("c", start + datetime.timedelta(7 * i), int(q)) for i, q in enumerate(rng.integers(5, 60, 33))]
    data += [("short", start + datetime.timedelta(7 * i), 5) for i in range(12)]
    series = forecast.split_series(spark.createDataFrame(data, "category_name string, week_start date, quantity bigint"))
    q = np.array([d[2] for d in data if d[0] == "c"], float)
    slope, cut = np.polyfit(np.arange(27), q[:27], 1)
    predicted = np.clip(cut + slope * np.arange(27, 33), 0, None)
    rows = forecast.forecast_metrics(series).collect()
    assert len(rows) == 1  # eight training weeks are too few
    m = rows[0]
    assert (m.n_train_weeks, m.n_test_weeks) == (27, 6)
    assert m.mae_model == pytest.approx(np.abs(q[27:] - predicted).mean())
    assert m.mae_baseline == pytest.approx(np.abs(q[27:] - q[26]).mean())
    assert m.rmse_model == pytest.approx(np.sqrt(((q[27:] - predicted) ** 2).mean()))
    out = forecast.forecast_rows(series)
    assert {r.row_type: r["count"] for r in out.groupBy("row_type").count().collect()} == {"actual": 27, "test": 6, "forecast": 4}
    ahead = [r.forecast_quantity for r in out.filter("row_type = 'forecast'").orderBy("week_start").collect()]
    assert ahead == pytest.approx(list(np.clip(cut + slope * np.arange(33, 37), 0, None)))


def test_ranks_need_no_second_shuffle_and_bounds_equal_numbering(spark):
    data = [(k, (k * 37) % 11) for k in range(101)]
    frame = spark.createDataFrame(data, "customer_id int, v int").repartition(5)
    plan = ranking.global_row_number(frame, ["v", "customer_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    order = sorted((v, k) for k, v in data)
    shares = [0.0, 0.2, 0.5, 0.999, 1.0]
    bounds = ranking.rank_bounds(frame, "v", "customer_id", shares)
    assert [tuple(r) for r in frame.limit(1).select(*[b.alias(f"b{i}") for i, b in enumerate(bounds)]).first()] == [order[int(s * 100)] for s in shares]
    assert ranking.rank_bounds(frame.limit(0), "v", "customer_id", shares) == []


def test_rows_below_come_without_a_shuffle(spark):
    frame = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, None), (4, 0.1)], "id int, x double")
    out = ranking.rows_below(frame, "x", ranking.value_ranks(frame, ["x"])["x"], "n")
    assert sorted((r.id, r.n) for r in out.collect() if r.n is not None) == [(1, 1), (2, 1), (4, 0)] and out.count() == 4
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
