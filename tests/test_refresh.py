"""Incremental refresh against a rebuild, commits of several writers, the event store."""

from __future__ import annotations

import glob
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import dicts, one
from pyspark.sql import functions as F
from test_files_pipeline import write_month

from tallycart.operators.clean import clean_events
from tallycart.plans import document as doc
from tallycart.plans import pipeline
from tallycart.plans import state as states
from tallycart.plans.cubes import build_cubes, read_cubes, write_cubes
from tallycart.sources import commits
from tallycart.streaming.refresh import ingest_new_files, stored_events

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def lines(path, *rows: str) -> None:
    path.write_text("\n".join([HEADER, *rows]) + "\n")


def event(day: str, user: int, session: str, kind: str = "purchase", product: int = 1, price: float = 2.5, code: str = "a.x", hour: int = 9) -> str:
    return f"{day} {hour:02d}:00:00 UTC,{kind},{product},,{code},,{price},{user},{session}"


def same(left, right) -> None:
    """Tables of equal names and rows, whatever the order of columns."""
    for name in right:
        columns = sorted(c for c in right[name].columns if c != "month" or name == "monthly")
        key = lambda r: str(r)
        a, b = (sorted(map(tuple, t.select(*columns).collect()), key=key) for t in (left[name], right[name]))
        assert a == b, name


def refreshed(spark, base) -> str:
    ingest_new_files(spark, f"{base}/in", f"{base}/events", f"{base}/offsets")
    return states.refresh_state(spark, f"{base}/events", f"{base}/state")


def rebuilt(spark, base) -> dict:
    write_cubes(build_cubes(clean_events(stored_events(spark, f"{base}/events").drop("batch", "month"))), f"{base}/rebuilt")
    return read_cubes(spark, f"{base}/rebuilt")


def test_refreshes_equal_a_rebuild(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_month(inbox / "a.csv", 10, 200, 4)
    # an order and a buyer that come back in a later month and in a new category, a session of views
    lines(inbox / "b.csv", event("2019-10-05", 1, "s1"), event("2019-10-05", 1, "s2", "view"), event("2019-10-06", 2, "", code="b.y"))
    refreshed(spark, tmp_path)
    write_month(inbox / "c.csv", 11, 150, 5)
    lines(
        inbox / "d.csv",
        event("2019-11-05", 1, "s1", code="c.z"),
        event("2019-10-05", 1, "s1", price=1.25),  # late, of an order already counted
        event("2019-10-01", 2, "s3", "cart"),  # an earlier first day
        event("2019-11-05", 2, "", code="b.y"),
        "not a time,purchase,1,,a.x,,3.0,5,s9",
    )
    refreshed(spark, tmp_path)
    lines(inbox / "e.csv", event("2019-09-30", 1, "s4", "view", hour=0), event("2019-11-05", 3, "s1", hour=23, product=9, code=""))
    folder = refreshed(spark, tmp_path)
    same(read_cubes(spark, folder), rebuilt(spark, tmp_path))
    assert refreshed(spark, tmp_path) == folder  # nothing new, no new version


def test_untouched_days_are_not_read(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines(inbox / "a.csv", *[event(f"2019-{m}-0{d}", 10 * m + d, f"s{m}{d}") for m in (10, 11) for d in range(1, 6)])
    refreshed(spark, tmp_path)
    old = glob.glob(f"{tmp_path}/events/batch=0/month=2019-10/*.parquet")
    assert old
    for path in old:  # reading them again would fail
        open(path, "wb").write(b"x" * os.path.getsize(path))
        for crc in glob.glob(f"{os.path.dirname(path)}/.*.crc"):
            os.remove(crc)
    lines(inbox / "b.csv", event("2019-11-03", 7, "t"), event("2019-12-01", 101, "s101"))
    cubes = read_cubes(spark, refreshed(spark, tmp_path))
    days = {str(r["event_date"]): (r["orders"], r["buyers"]) for r in dicts(cubes["daily"])}
    assert days["2019-11-03"] == (2, 2) and days["2019-10-01"] == (1, 1) and len(days) == 11
    plan = states.on_days(stored_events(spark, f"{tmp_path}/events"), [r["event_date"] for r in dicts(cubes["daily"])][:1])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*month", text) and "GreaterThanOrEqual(event_time" in text


def test_appended_parts_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(states, "COMPACT", 2)
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in range(4):
        lines(inbox / f"{n}.csv", event(f"2019-10-0{n + 1}", n % 2, f"s{n % 3}"))
        folder = refreshed(spark, tmp_path)
    assert len(states.State(spark, f"{tmp_path}/state").record["seen"]) == 2
    same(read_cubes(spark, folder), rebuilt(spark, tmp_path))


def test_refresh_takes_a_cap_and_a_range(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    write_month(inbox / "a.csv", 10, 80, 4)
    write_month(inbox / "b.csv", 11, 40, 5)
    row = one(pipeline.refresh(spark, str(inbox), out, start="2019-11-01", end="2019-11-30"))
    assert row["total_events"] == 40 and row["source"] == str(inbox)
    assert one(pipeline.refresh(spark, str(inbox), out))["total_events"] == 120
    with pytest.raises(ValueError, match="rows per file"):
        pipeline.refresh(spark, str(inbox), out, rows_per_file=5)
    capped = ingest_new_files(spark, str(inbox), str(tmp_path / "capped"), str(tmp_path / "o2"), rows_per_file=30)
    assert capped.count() == 60
    first = capped.filter(F.month("event_time") == 10).agg(F.max("event_time")).first()[0]
    rest = ingest_new_files(spark, str(inbox), str(tmp_path / "all"), str(tmp_path / "o3")).filter(F.month("event_time") == 10)
    assert rest.filter(F.col("event_time") < first).count() < 30


def test_refresh_with_promotions_and_names(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    lines(inbox / "a.csv", event("2019-10-05", 1, "s1"))
    promoted = spark.sql("SELECT 'P' AS promotion_id, 10.0D AS discount_pct, DATE'2019-10-01' AS start_date, DATE'2019-10-31' AS end_date, array('a') AS categories")
    pipeline.refresh(spark, str(inbox), out, promotions=promoted)
    text = one(doc.read_document(spark, f"{out}/document"))["document"]
    assert '"promotions_available":true' in text and '"promotion_id":"P"' in text


def test_empty_inbox(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert one(pipeline.refresh(spark, str(tmp_path / "in"), str(tmp_path / "out")))["total_orders"] == 0


def test_records_have_one_writer(spark, tmp_path):
    folder = str(tmp_path / "records")
    assert commits.newest(spark, folder) == (0, None)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: commits.claim(spark, folder, 1, f"writer {i}"), range(8)))
        numbers = list(pool.map(lambda i: commits.append(spark, folder, f"later {i}"), range(8)))
    assert won.count(True) == 1 and commits.read(spark, f"{folder}/{1:012d}") == f"writer {won.index(True)}"
    assert sorted(numbers) == list(range(2, 10)) and commits.names(spark, folder) == [f"{n:012d}" for n in range(1, 10)]


def test_two_publishers_at_once(spark, tmp_path):
    path = str(tmp_path / "doc")
    texts = {f"run-{i}": doc.Publication(spark.createDataFrame([(f'{{"n":{i}}}',)], "document string")) for i in range(2)}
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda run: doc.publish(texts[run], path, run), texts))
    assert len(commits.names(spark, f"{path}/published")) == 2
    assert one(doc.read_document(spark, path))["document"] == f'{{"n":{doc.newest_run(spark, path)[-1]}}}'


def test_refresh_that_loses_its_number_starts_again(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines(inbox / "a.csv", event("2019-10-05", 1, "s1"))
    real, calls = commits.claim, []

    def once(spark_, folder, number, text):
        calls.append(number)
        return False if len(calls) == 1 else real(spark_, folder, number, text)

    monkeypatch.setattr(commits, "claim", once)
    folder = refreshed(spark, tmp_path)
    assert len(calls) == 2 and one(read_cubes(spark, folder)["totals"])["total_orders"] == 1
    assert len([n for n in os.listdir(tmp_path / "state") if n.startswith("v")]) == 1
