from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from helpers import dicts, one, purchases, sale
from pyspark.sql import functions as F

from tallycart.operators import products as p
from tallycart.operators import promotions as pm
from tallycart.schema import PROMOTION


@pytest.fixture(scope="module")
def goods(spark):
    rnd = random.Random(9)
    rows = [sale("2019-10-01", 1, f"s{i}", float(rnd.choice([1, 2, 2, 50])), product_id=1 if rnd.random() < 0.33 else rnd.randint(2, 40)) for i in range(300)]
    return p.products_from(purchases(spark, *rows))


def test_abc_against_brute_force(goods):
    rows = sorted(dicts(p.product_abc(goods)), key=lambda r: (-r["revenue"], r["product_id"]))
    total, run = sum(r["revenue"] for r in rows), 0.0
    for row in rows:
        run += row["revenue"]
        assert row["cumulative_share_pct"] == pytest.approx(run / total * 100, abs=0.0051)
        cum = row["cumulative_share_pct"]
        assert row["abc_class"] == ("Hero SKU" if cum <= 30 else "Core" if cum <= 80 else "Long Tail")
    assert rows[-1]["cumulative_share_pct"] == 100.0


def test_ranges_equal_one_task(goods):
    assert sorted(map(str, p.product_abc(goods, 7).collect())) == sorted(map(str, p.product_abc(goods).collect()))
    assert one(p.pareto_summary(goods, 7)) == one(p.pareto_summary(goods))


def test_pareto(goods):
    rows = sorted((r["revenue"] for r in dicts(p.product_abc(goods))), reverse=True)
    run, k = 0.0, 0
    while run < 0.8 * sum(rows) - 1e-9:
        run += rows[k]
        k += 1
    out = one(p.pareto_summary(goods))
    assert out["top_products_for_80pct"] == k and out["product_count"] == len(rows)
    assert out["top_20pct_product_count"] == -(-len(rows) // 5)


def test_top_lists_and_labels(spark, goods):
    top = dicts(p.top_by_revenue(goods, 3))
    full = {r["product_id"]: r for r in dicts(p.product_abc(goods))}
    for row in top:
        assert row["cumulative_share_pct"] == full[row["product_id"]]["cumulative_share_pct"]
    names = spark.createDataFrame([(1, "Kettle"), (999, "Other")], "product_id bigint, product_name string")
    labels = {r["product_id"]: r["product_name"] for r in dicts(p.product_filter_list(goods, names, 5))}
    assert labels[1] == "Kettle" and all(v == f"SKU {k}" for k, v in labels.items() if k != 1) and len(labels) == 5


@pytest.fixture(scope="module")
def campaign(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        day = dt.date(2019, 10, 1) + dt.timedelta(days=rnd.randint(0, 40))
        category = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c"])
        rows.append(sale(str(day), rnd.randint(1, 30), f"s{rnd.randint(1, 200)}", float(rnd.randint(1, 9)), category_code=f"{category}.x"))
    promos = [
        ("P1", 10.0, dt.date(2019, 10, 10), dt.date(2019, 10, 20), ["hot", "a"]),
        ("P2", 30.0, dt.date(2019, 10, 15), dt.date(2019, 10, 15), ["hot", "hot"]),
        ("P3", 50.0, dt.date(2020, 1, 1), dt.date(2020, 1, 5), ["a"]),
        ("P4", 50.0, dt.date(2019, 10, 5), dt.date(2019, 10, 1), ["a"]),
    ]
    return purchases(spark, *rows), spark.createDataFrame(promos, PROMOTION), promos


def test_promotion_performance_against_brute_force(campaign):
    events, promotions, promos = campaign
    got = {r["promotion_id"]: r for r in dicts(pm.promotion_performance(events, promotions))}
    rows = dicts(events)
    for pid, _, start, end, cats in promos:
        length = (end - start).days + 1
        inside = [r for r in rows if start <= r["event_date"] <= end and r["category"] in cats]
        before = [r for r in rows if start - dt.timedelta(days=length) <= r["event_date"] < start and r["category"] in cats]
        orders, old = {r["order_id"] for r in inside}, {r["order_id"] for r in before}
        per_user = defaultdict(set)
        for r in inside:
            per_user[r["user_id"]].add(r["order_id"])
        again = sum(len(s) >= 2 for s in per_user.values())
        row = got[pid]
        assert row["orders_generated"] == len(orders) and row["total_participants"] == len(per_user)
        assert row["revenue_generated"] == pytest.approx(sum(r["revenue_e4"] for r in inside) / 1e4)
        assert row["repeat_purchase_rate_pct"] == pytest.approx(100 * again / len(per_user) if per_user else 0, abs=0.0051)
        lift = 100 * (len(orders) - len(old)) / len(old) if old else None
        assert row["order_lift_pct"] == (pytest.approx(lift, abs=0.0051) if lift is not None else None)


def test_promotion_share_counts_overlaps_once(campaign):
    events, promotions, promos = campaign
    got = {r["category"]: r for r in dicts(pm.promotion_share(events, promotions, F.col("category")))}
    for category in ("hot", "a", "b", "c"):
        rows = [r for r in dicts(events) if r["category"] == category]
        hit = [r for r in rows if any(s <= r["event_date"] <= e and category in cats for _, _, s, e, cats in promos)]
        revenue = 100 * sum(r["revenue_e4"] for r in hit) / sum(r["revenue_e4"] for r in rows)
        orders = 100 * len({r["order_id"] for r in hit}) / len({r["order_id"] for r in rows})
        assert got[category]["promotion_contribution_pct"] == pytest.approx(revenue, abs=0.0051)
        assert got[category]["promotion_orders_pct"] == pytest.approx(orders, abs=0.0051)


def test_mean_discount(campaign):
    events, promotions, promos = campaign
    hits = [d for r in dicts(events) for _, d, s, e, cats in promos if s <= r["event_date"] <= e and r["category"] in cats]
    got = one(pm.promotion_discount(events, promotions))["avg_promotion_discount_pct"]
    assert got == pytest.approx(sum(hits) / len(hits), abs=0.0051)
    assert one(pm.promotion_discount(events.filter("user_id < 0"), promotions))["avg_promotion_discount_pct"] == 0.0
