from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from helpers import dicts
from pyspark.sql import functions as F

from tallycart.operators.ranking import bucket_starts, first_rows, quantile_buckets, with_running


@pytest.mark.parametrize("n", list(range(1, 61)) + [1000, 1001])
def test_bucket_starts_follow_quantile_cut(n):
    starts = bucket_starts(n)
    ours = [1 + sum(r >= s for s in starts) for r in range(1, n + 1)]
    cut = pd.qcut(pd.Series(range(1, n + 1)), q=min(5, n), labels=False, duplicates="drop")
    assert ours == [int(v) + 1 for v in cut.fillna(0)]


def people(spark, n, seed=3):
    rnd = random.Random(seed)
    # a third of all rows share one value of each metric
    rows = [(i * 7 % 1009, 1 if rnd.random() < 0.34 else rnd.randint(0, 50), rnd.choice([5, 5, rnd.randint(0, 10**12)])) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, a bigint, b bigint"), rows


def expected(rows, column, n):
    order = sorted(rows, key=lambda r: (r[column], r[0]))
    q = min(5, n)
    return {r[0]: 1 if n == 1 else max(1, math.ceil(i * q / (n - 1))) for i, r in enumerate(order)}


@pytest.mark.parametrize(
    "n, rows_per_task", [(n, None) for n in (1, 2, 6, 7, 8, 9, 12, 120)] + [(n, 5) for n in (7, 12, 120)]
)
def test_quantile_buckets(spark, n, rows_per_task):
    df, rows = people(spark, n)
    out = dicts(quantile_buckets(df, "id", {"qa": F.col("a"), "qb": F.col("b")}, 5, rows_per_task))
    assert {r["id"]: r["qa"] for r in out} == expected(rows, 1, n)
    assert {r["id"]: r["qb"] for r in out} == expected(rows, 2, n)


@pytest.mark.parametrize("rows_per_task", [1000, 100, 40])
def test_running_equals_plain_order(spark, rows_per_task):
    df, rows = people(spark, 300)
    out = dicts(with_running(df, [F.col("a").desc(), F.col("id")], "b", rows_per_task))
    order, total, want = sorted(rows, key=lambda r: (-r[1], r[0])), 0, {}
    for i, row in enumerate(order, 1):
        total += row[2]
        want[row[0]] = (i, total)
    assert {r["id"]: (r["row_no"], r["running"]) for r in out} == want


def test_first_rows_both_ways(spark, monkeypatch):
    df, rows = people(spark, 300)
    order = [F.col("a"), F.col("id")]
    few = {r["id"] for r in dicts(first_rows(df, order, 50))}
    monkeypatch.setattr("tallycart.operators.ranking.TOP_ROWS", 10)
    monkeypatch.setattr("tallycart.operators.ranking.ROWS_PER_TASK", 70)
    many = {r["id"] for r in dicts(first_rows(df, order, 50))}
    assert few == many == {r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))[:50]}


def test_first_rows_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr("tallycart.operators.ranking.TOP_ROWS", 10)
    monkeypatch.setattr("tallycart.operators.ranking.ROWS_PER_TASK", 30)
    alike = spark.range(200).select(F.lit(1).alias("a"))
    assert first_rows(alike, [F.col("a")], 90).count() == 90
