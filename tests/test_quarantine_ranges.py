"""Rows put aside by a checked conversion, and exact counts of ranges from bitmaps."""

from __future__ import annotations

import random
from datetime import date

import pytest
from helpers import dicts, one, purchases, sale
from pyspark.sql import Observation
from test_refresh import HEADER, event

from tallycart.operators import grain, range_counts, views
from tallycart.operators.clean import clean_events
from tallycart.plans import pipeline
from tallycart.plans.cubes import build_cubes, read_cubes, write_cubes
from tallycart.plans.view import view
from tallycart.sources import files

GOOD = [event("2019-10-01", 1, "s1"), event("2019-10-02", 2, "s2", code="")]
BAD = {
    "no time": ",purchase,1,,a.x,,2.5,1,s",
    "bad time": "first of May,purchase,1,,a.x,,2.5,1,s",
    "no user": "2019-10-01 09:00:00 UTC,purchase,1,,a.x,,2.5,,s",
    "bad user": "2019-10-01 09:00:00 UTC,purchase,1,,a.x,,2.5,someone,s",
}
REPAIRED = ["2019-10-03 09:00:00 UTC,purchase,1,,a.x,,cheap,3,s3", "2019-10-04 09:00:00 UTC,purchase,1", "2019-10-05 09:00:00 UTC,view,x,,,,1,4,s,extra"]


def test_quarantine(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("\n".join([HEADER, *GOOD, *BAD.values(), *REPAIRED]) + "\n")
    seen = Observation("rows")
    events, aside = files.csv_to_checked_parquet(spark, [str(path)], str(tmp_path / "out"), seen=seen)
    kept, put = dicts(events), {r["reason"]: r["record"] for r in dicts(aside)}
    # the record of two fields has no user
    assert len(kept) == 4 and aside.count() == 5 and seen.get["rows"] == 9
    assert put["bad time"] == BAD["bad time"] and "someone" in put["bad user"] and set(put) == set(BAD)
    report = {r["outcome"]: r["rows"] for r in dicts(files.quarantine_report(spark, str(tmp_path / "out")))}
    assert report == {"kept": 4, "repaired": 2, "no time": 1, "bad time": 1, "no user": 2, "bad user": 1}
    # what is kept is what cleaning keeps of a plain read
    plain = clean_events(files.read_events_csv(spark, [str(path)]))
    order = lambda rows: sorted(map(str, rows))
    assert order(clean_events(events).collect()) == order(plain.collect())


def test_quarantine_of_nothing_and_of_all(spark, tmp_path):
    for name, rows in (("good", GOOD), ("bad", list(BAD.values())), ("empty", [])):
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([HEADER, *rows]) + "\n")
        events, aside = files.csv_to_checked_parquet(spark, [str(path)], str(tmp_path / name))
        assert events.count() == (2 if name == "good" else 0) and aside.count() == (4 if name == "bad" else 0)


def test_run_reports_quarantined_rows(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("\n".join([HEADER, *GOOD, *BAD.values()]) + "\n")
    row = one(pipeline.run(spark, [str(path)], str(tmp_path / "out"), run_id="r"))
    text = spark.read.parquet(f"{tmp_path}/out/document/runs/r/document").first()[0]
    assert row["total_events"] == 2 and '"quarantined_rows":4' in text and '"csv_rows":6' in text


@pytest.fixture(scope="module")
def bought(spark):
    rnd = random.Random(3)
    days = [f"2019-{m:02d}-{d:02d}" for m in (9, 10, 11) for d in range(1, 29, 3)]
    rows = [sale(rnd.choice(days), rnd.randint(1, 40), f"s{rnd.randint(1, 60)}" if rnd.random() < 0.7 else None, 1.5, category_code=rnd.choice(["a.x", "b.y", "c"])) for _ in range(400)]
    return purchases(spark, *rows)


def test_exact_ranges(spark, bought, tmp_path):
    cubes = {
        "range_bitmaps": range_counts.range_bitmaps(grain.order_grain(bought), grain.buyer_grain(bought)),
        "category_daily": grain.figures(grain.order_grain(bought), grain.buyer_grain(bought), "event_date", "category"),
    }
    write_cubes(cubes, str(tmp_path))
    bitmaps, days = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("range_bitmaps", "category_daily"))
    for start, end, category in ((None, None, None), ("2019-10-01", "2019-10-20", None), ("2019-11-30", "2019-09-10", "b"), ("2019-10-01", None, "nope"), ("2030-01-01", None, None)):
        low, high = (end, start) if start and end and start > end else (start, end)
        assert one(range_counts.exact_view(bitmaps, days, start, end, category)) == one(views.exact_range(bought, low, high, category)), (start, end, category)
    plan = range_counts.distinct_in_range(bitmaps, "2019-10-01", "2019-10-20")._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan and "order_id" not in plan


def test_bitmaps_are_made_once_from_numbers_dealt_to_them(spark, bought):
    """Each bitmap is one row, holds the numbers of its day, category and block, and was not moved in parts."""
    orders, buyers = grain.order_grain(bought), grain.buyer_grain(bought)
    made = range_counts.range_bitmaps(orders, buyers)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("bitmap_construct_agg") < plan.index("RepartitionByExpression [event_date"), plan
    physical = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in physical[: physical.rindex("bitmap_construct_agg")], physical
    want = set()
    for kind, table in (("order", orders), ("user", buyers)):
        key = range_counts.KINDS[kind]
        numbers = {r[key]: r["number"] for r in dicts(range_counts.numbered(table, key))}
        want |= {(r["event_date"], r["category"], kind, numbers[r[key]]) for r in dicts(table)}
    rows = dicts(made)
    assert len({(r["event_date"], r["category"], r["kind"], r["block"]) for r in rows}) == len(rows)
    got = {
        (r["event_date"], r["category"], r["kind"], (r["block"] - 1) * 32768 + i * 8 + bit + 1)
        for r in rows for i, byte in enumerate(r["bits"]) for bit in range(8) if byte >> bit & 1
    }
    assert got == want


def test_numbers_have_no_gap_and_follow_first_days(spark, bought):
    rows = sorted(dicts(range_counts.numbered(grain.buyer_grain(bought), "user_id")), key=lambda r: r["number"])
    assert [r["number"] for r in rows] == list(range(1, len(rows) + 1))
    first = {r["user_id"]: r["d"] for r in dicts(bought.groupBy("user_id").agg({"event_date": "min"}).toDF("user_id", "d"))}
    days = [first[r["user_id"]] for r in rows]
    assert days == sorted(days) and isinstance(days[0], date)


def test_figures_equal_distinct_counts(bought):
    from tallycart.operators.series import totals_by

    for keys in (("event_date",), ("category",), ("event_date", "category")):
        mine = grain.figures(grain.order_grain(bought), grain.buyer_grain(bought), *keys)
        columns = [*keys, "revenue_e4", "orders", "buyers"]
        order = lambda t: sorted(map(str, t.select(*columns).collect()))
        assert order(mine) == order(totals_by(bought, *keys)), keys


def test_no_cube_expands_rows(spark, bought):
    events = bought
    for name, cube in build_cubes(events).items():
        assert "Expand" not in cube._jdf.queryExecution().executedPlan().toString(), name


def test_grouping_a_stored_grain_by_its_key_moves_nothing(spark, bought):
    plan = grain.stored_orders(bought).groupBy("order_id", "event_date").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_view_counts_exactly_where_bitmaps_are_staged(spark, bought, tmp_path):
    write_cubes(build_cubes(bought, exact_ranges=True), str(tmp_path))
    cubes = read_cubes(spark, str(tmp_path))
    exact = one(view(cubes, "2019-10-01", "2019-10-31", "a")["exact"])
    assert exact == one(views.exact_range(bought, "2019-10-01", "2019-10-31", "a"))


def test_local_warehouse_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from tallycart.sources.scratch import scratch_root

    def session(master: str, folder: str) -> SimpleNamespace:
        conf = SimpleNamespace(get=lambda name, default=None: {"spark.sql.warehouse.dir": folder}.get(name, default))
        context = SimpleNamespace(master=master, applicationId="app", getConf=lambda: SimpleNamespace(get=lambda name: None))
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert scratch_root(session("local[2]", "file:/w")) == "file:/w/_scratch/tallycart/app"
    assert scratch_root(session("spark://h:1", "hdfs://h/w")) == "hdfs://h/w/_scratch/tallycart/app"
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(session("spark://h:1", "file:/w"))
