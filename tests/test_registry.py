"""Registered queries against their SQL on a small data set, and plan checks."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from larder.operators import risk  # noqa: E402
from larder.plans import oracles, queries  # noqa: E402
from larder.plans.sales import Sales  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
NO_SQL: set[str] = set()
CHECKED = ["classify_exact", "clean_summary", "join_audit_raw", "item_features", "rfm_scores", "association_rules",
           "forecast_rows", "recommendations", "near_duplicate_orders", "pattern_checks", "named_segments",
           "price_as_of", "scenario_price", "promo_active_items", "null_sanity", "split_bucket",
           "chain_item_features", "chain_customer_rfm", "chain_labels"]


@pytest.fixture
def base():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(queries.REGISTRY) - set(oracles.build()) == NO_SQL
    assert set(oracles.build()) <= set(queries.REGISTRY)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, base, name):
    frame = queries.run(name, spark, FOLDER)
    columns = sorted(frame.columns)
    result = base.execute(oracles.build()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    assert len(got) == len(want) and got == [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in want]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_prune_the_scan(spark):
    sales = Sales(spark, FOLDER)
    for frame in (sales.item_features, sales.rfm, sales.wide, sales.weekly):
        plan = plan_of(frame)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rfm = plan_of(sales.rfm)
    assert "l_shipdate" not in rfm and "l_tax" not in rfm and "p_name" not in rfm


def test_waste_risk_learns_the_target(spark):
    rows = [(i, f"n{i}", 10 * (i % 40), None if i % 9 == 0 else 1.0 + i % 5, "AB"[i % 2],
             None if i % 25 == 3 else (0.3 if i % 40 < 10 else 0.05) + (0.1 if i % 2 else 0.0)) for i in range(240)]
    items = spark.createDataFrame(rows, "item_id int, item_name string, total_quantity_sold int, avg_rating double,"
                                        "category_name string, wastage_percent double")
    known = [r for r in rows if r[5] is not None]
    assert tuple(risk.dropped_without_target(items).first()) == (240, 240 - len(known))
    model = risk.fit_waste_risk(items, trees=20)
    scored = risk.score_waste_risk(items, model)
    assert scored.count() == len(known)
    assert scored.stat.corr("wastage_percent", "predicted_wastage_risk") > 0.95
    weights = risk.importances(items, model).collect()
    assert abs(sum(r.importance for r in weights) - 1) < 1e-5
    assert weights[0].feature == "total_quantity_sold"
    assert {r.wastage_percent for r in risk.top_predicted(scored).collect()} == {0.4}


def test_feature_table_invariants(spark):
    sales = Sales(spark, FOLDER)
    items, rfm, lines = sales.item_table, sales.rfm, sales.line_features
    assert items.count() == items.select("item_id").distinct().count()
    assert rfm.count() == rfm.select("customer_id").distinct().count()
    assert rfm.filter("recency_days < 0 OR frequency < 1").count() == 0
    assert lines.filter("is_completed NOT IN (0, 1) OR (is_completed = 1 AND net_revenue < 0)").count() == 0
    assert lines.count() == sales.order_items.count()
