from __future__ import annotations

import glob
import json
import os
import random
from datetime import date, datetime

import pytest
from helpers import dicts, one, raw
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallycart.operators.clean import between_days, clean_events
from tallycart.operators.filters import filter_rows, filter_view
from tallycart.operators.funnel import event_counts
from tallycart.plans import document as doc
from tallycart.plans import pipeline
from tallycart.plans.cubes import build_cubes, read_cubes, write_cubes
from tallycart.plans.view import view
from tallycart.schema import CUBES, PROMOTION, RAW_EVENT
from tallycart.sources import files
from tallycart.sources.scratch import materialize, scratch_scope
from tallycart.streaming.refresh import ingest_new_files

HEADER = ",".join(RAW_EVENT.fieldNames())


def write_month(path, month: int, rows: int, seed: int) -> None:
    rnd = random.Random(seed)
    lines = [HEADER]
    for _ in range(rows):
        kind = rnd.choice(["view", "view", "view", "cart", "purchase"])
        time = f"2019-{month}-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00 UTC"
        code = rnd.choice(["electronics.phone", "sport.ball", ""])
        lines.append(f"{time},{kind},{rnd.randint(1, 30)},77,{code},,{rnd.randint(1, 9)}.{rnd.randint(10, 99)},{rnd.randint(1, 40)},u{rnd.randint(1, 120)}")
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def months(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    write_month(folder / "oct.csv", 10, 300, 1)
    write_month(folder / "nov.csv", 11, 200, 2)
    return [str(folder / "oct.csv"), str(folder / "nov.csv")]


def test_several_files_and_cap(spark, months):
    assert files.read_events_csv(spark, months).count() == 500
    capped = files.read_events_csv(spark, months, rows_per_file=50)
    assert capped.count() == 100
    per_month = {r["m"]: r["n"] for r in dicts(capped.groupBy(F.substring("event_time", 1, 7).alias("m")).agg(F.count("*").alias("n")))}
    assert per_month == {"2019-10": 50, "2019-11": 50}
    latest = capped.filter("event_time < '2019-11'").agg(F.max("event_time")).first()[0]
    early = files.read_events_csv(spark, months[:1]).filter(F.col("event_time") < latest).count()
    assert early <= 50


def test_a_file_per_event_type_is_written_by_its_own_task(spark, tmp_path, monkeypatch):
    """Types travel to several tasks, none of which sorts; null and empty types share a file, as folders have it."""
    from checks import queries

    kinds = ["view", "click", "purchase", "signup", "error", None, ""]
    rows = [(i, datetime(2024, 1, 1 + i % 9), i % 11, kinds[i % 7], 1.5, '{"k": %d}' % i) for i in range(7 * 8)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    setting, coalesce = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.coalescePartitions.enabled"
    seen, read, conf = {}, files.read_events_csv, type(spark.conf)
    put = conf.set

    def reading(session, paths, **more):
        seen["files"] = glob.glob(f"{paths[0]}/*.csv")
        return read(session, paths, **more)

    def setting_conf(self, key, value):
        seen.setdefault(key, []).append(value)
        put(self, key, value)

    monkeypatch.setattr(files, "read_events_csv", reading)
    monkeypatch.setattr(queries, "FILE_ROWS", 6)
    before = spark.conf.get(setting)
    put(spark.conf, coalesce, "false")
    monkeypatch.setattr(conf, "set", setting_conf)
    try:
        counts = {r["event_type"]: r["count"] for r in dicts(queries.row_cap_files(spark, str(tmp_path)))}
    finally:
        put(spark.conf, coalesce, "true")
    assert len(seen["files"]) == 6 and len({os.path.dirname(f) for f in seen["files"]}) == 6
    assert len({os.path.basename(f)[:10] for f in seen["files"]}) > 1  # tasks that wrote them
    assert int(seen[setting][0]) >= 6 and spark.conf.get(setting) == before
    assert sum(counts.values()) == 36 and all(counts[k] == 6 for k in ("view", "cart", "purchase", "signup", "error"))


def test_cap_bounds():
    assert files.checked_rows_per_file(0) == 0 and files.checked_rows_per_file(10_000) == 10_000
    for bad in (9_999, 25_000_001):
        with pytest.raises(ValueError):
            files.checked_rows_per_file(bad)


def test_conversion_report(spark, months, tmp_path):
    seen = Observation("csv")
    parquet = files.csv_to_parquet(spark, months, str(tmp_path / "pq"), batch_rows=120, seen=seen)
    assert seen.get["rows"] == 500
    row = one(files.conversion_report(files.read_events_csv(spark, months), parquet, 120))
    assert (row["csv_rows"], row["parquet_rows"], row["num_batches"]) == (500, 500, 5)
    assert row["max_rows_in_file"] <= 120 and row["num_parquet_files"] >= 5
    assert one(files.conversion_report(parquet, parquet, 0))["num_batches"] == 0


def test_scan_comparison():
    assert files.compare_scan_times(10.0, 0.0)["speedup_csv_vs_parquet"] == 10000.0
    assert files.compare_scan_times(1.0, 1.0)["winner"] == "csv"  # a tie is not faster


def test_missing_table_is_empty(spark, tmp_path):
    empty = files.read_or_empty(spark, str(tmp_path / "none"), CUBES["daily"])
    assert empty.count() == 0 and empty.columns == ["event_date", "revenue_e4", "orders", "buyers"]


def test_union_of_unequal_tables(spark):
    a = spark.createDataFrame([(1, "x")], "user_id bigint, brand string")
    b = spark.createDataFrame([(2,)], "user_id bigint")
    assert {(r["user_id"], r["brand"]) for r in dicts(files.union_tables([a, b]))} == {(1, "x"), (2, None)}


def test_csv_export(spark, tmp_path):
    daily = spark.createDataFrame([("2019-10-02", 2.5, 1, 1), ("2019-10-01", 1.5, 3, 2)], "event_date string, revenue double, orders bigint, dau bigint")
    files.export_daily_csv(daily, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    assert text.splitlines()[0] == "Date,Revenue,Orders,Buyers" and "2019-10-01,1.5,3,2" in text


@pytest.fixture(scope="module")
def cubes(spark, months, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cubes"))
    write_cubes(build_cubes(clean_events(files.read_events_csv(spark, months))), folder)
    return read_cubes(spark, folder)


def test_cubes_agree_with_each_other(cubes):
    total = sum(r["revenue_e4"] for r in dicts(cubes["daily"]))
    for name in ("monthly", "users", "categories", "category_daily", "heatmap", "heatmap_daily", "products"):
        assert sum(r["revenue_e4"] for r in dicts(cubes[name])) == total, name
    assert sum(r["count"] for r in dicts(cubes["event_counts"])) == 500


def test_document(spark, cubes, tmp_path):
    path = str(tmp_path / "doc")
    first = doc.build_document(cubes, "2020-01-01T00:00:00Z", ["oct", "nov"])
    doc.publish(first, path, "20200101")
    doc.publish(doc.build_document(cubes, "2020-01-02T00:00:00Z"), path, "20200102")
    doc.publish(doc.build_document(cubes, "2020-01-02T00:00:00Z"), path, "20200102")  # a retry
    read = doc.read_document(spark, path)
    text = one(read)["document"]
    assert "NaN" not in text
    body = json.loads(text)
    assert body["meta"]["generated_at"] == "2020-01-02T00:00:00Z"
    assert set(doc.REQUIRED) <= set(body)
    assert body["revenue"]["daily"][0]["prev_revenue"] is None  # null, not left out
    assert [d["event_date"] for d in body["revenue"]["daily"]] == sorted(d["event_date"] for d in body["revenue"]["daily"])
    kpis = body["dashboard"]["kpis"]
    assert kpis["total_revenue"] == pytest.approx(sum(d["revenue"] for d in body["revenue"]["daily"]))
    assert body["categories"] == {"tables": ["categories", "categories_daily"]}
    assert doc.read_table(spark, path, "categories").count() == 3
    days = [r["event_date"] for r in dicts(doc.read_table(spark, path, "categories_daily"))]
    assert len(days) > 3 and days == sorted(days)
    doc.publish(doc.build_document(cubes, "later"), path, "10")
    assert json.loads(one(doc.read_document(spark, path))["document"])["meta"]["generated_at"] == "later"
    doc.publish(doc.build_document(cubes, "2020-01-02T00:00:00Z"), path, "9")
    assert body["segments"]["segment_summary"] and body["products"]["pareto"]["product_count"] == cubes["products"].count()
    assert one(doc.verify(spark, path))["total_orders"] == kpis["total_orders"]
    assert one(doc.health(spark, path))["status"] == "ok"


def _keys(value, path=""):
    """Names of nested objects; what a list holds depends on its rows."""
    if isinstance(value, dict):
        return {f"{path}/{k}" for k in value} | {x for k, v in value.items() for x in _keys(v, f"{path}/{k}")}
    return set()


def test_larger_input_changes_no_key(spark, cubes, tmp_path):
    write_month(tmp_path / "big.csv", 10, 4000, 9)
    events = clean_events(files.read_events_csv(spark, [str(tmp_path / "big.csv")]))
    small, large = doc.build_document(cubes, "x", staged_at="/t"), doc.build_document(build_cubes(events), "x", staged_at="/t")
    bodies = [json.loads(one(p.document)["document"]) for p in (small, large)]
    assert _keys(bodies[0]) == _keys(bodies[1]) and set(small.tables) == set(large.tables) == set(doc.TABLES)
    assert bodies[0]["meta"]["staged_at"] == "/t" and dicts(doc.missing_sections(small.document)) == []


def test_missing_section_is_reported(spark, tmp_path):
    broken = spark.createDataFrame([('{"meta":{},"funnel":{}}',)], "document string")
    doc.publish(doc.Publication(broken), str(tmp_path / "doc"), "1")
    present = {r["section"]: r["present"] for r in dicts(doc.document_sections(broken))}
    assert present["meta"] and not present["revenue"]
    with pytest.raises(ValueError, match="revenue"):
        doc.verify(spark, str(tmp_path / "doc"))


def test_sections(cubes):
    revenue = doc.section(cubes, "revenue", start="2019-11-01", end=None)
    assert {r["event_date"][:7] for r in dicts(revenue["daily"])} == {"2019-11"}
    by_category = doc.section(cubes, "products", category="sport", start="2030-01-01")
    assert {r["category"] for r in dicts(by_category["top_by_revenue"])} <= {"sport"}
    with pytest.raises(KeyError):
        doc.section(cubes, "nope")
    worst = max(dicts(cubes["products"]), key=lambda r: (-r["revenue_e4"], r["product_id"]))["product_id"]
    assert cubes["products"].count() > 10
    for part in ("top_by_revenue", "top_by_quantity"):
        assert [r["product_id"] for r in dicts(doc.section(cubes, "products", product_id=worst)[part])] == [worst]
    every = {r["product_id"] for r in dicts(doc.section(cubes, "products")["pareto_products"])}
    assert len(every) == one(doc.section(cubes, "products")["pareto"])["top_products_for_80pct"]
    ranged = dicts(doc.section(cubes, "customers", start="2019-11-01")["new_vs_returning"])
    assert ranged and sum(r["new"] for r in ranged) < sum(r["active_users"] for r in ranged)


def test_section_starts_no_job_while_it_is_planned(spark, cubes):
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("section-plan", "")
    doc.section(cubes, "funnel")
    assert list(status.getJobIdsForGroup("section-plan")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_view_composes_all_tabs(spark, cubes):
    parts = view(cubes, "2019-11-30", "2019-11-01", "sport")
    assert {r["event_date"][:7] for r in dicts(parts["daily"])} == {"2019-11"} and one(parts["kpis"])["is_filtered"]
    for name, part in parts.items():
        assert part.count() >= (0 if name == "month_delta" else 1), name
    assert {r["category"] for r in dicts(parts["products"])} == {"sport"}


def test_rows_without_a_day_survive_staging(spark, tmp_path):
    cube = spark.createDataFrame(
        [(None, "a", 5, 1, 1), (date(2019, 10, 2), "a", 7, 1, 1)], "event_date date, category string, revenue_e4 bigint, orders bigint, buyers bigint"
    )
    write_cubes({"category_daily": cube}, str(tmp_path))
    staged = files.read_or_empty(spark, f"{tmp_path}/category_daily", CUBES["category_daily"])
    for frame in (cube, staged):
        assert filter_view(frame, "2019-10-01", "2019-10-31").count() == 2
        assert filter_rows(frame, "2019-10-01", "2019-10-31").count() == 1
        assert filter_rows(frame, None, "2019-10-31").count() == 2


def test_promotions_reach_the_document(spark, months, tmp_path):
    promoted = spark.createDataFrame([("P", 10.0, date(2019, 10, 1), date(2019, 11, 30), ["sport"])], PROMOTION)
    pipeline.run(spark, months, str(tmp_path / "out"), promotions=promoted)
    body = json.loads(one(doc.read_document(spark, f"{tmp_path}/out/document"))["document"])
    assert body["meta"]["capabilities"]["promotions_available"] is True
    assert body["promotions"]["performance"][0]["orders_generated"] > 0
    assert set(body["promotions"]) == {"performance", "discount", "by_month", "by_weekday", "by_hour", "by_category"}


def test_event_store_is_typed_and_bounded(spark, months, tmp_path):
    table = files.csv_to_parquet(spark, months, str(tmp_path / "pq"))
    assert dict(table.dtypes)["event_time"] == "timestamp"
    plan = between_days(clean_events(table), "2019-11-01", "2019-11-30")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time" in plan


def test_cap_holds_for_every_file_of_a_folder(spark, months):
    folder = months[0].rsplit("/", 1)[0]
    assert files.read_events_csv(spark, [f"{folder}/*.csv"], rows_per_file=40).count() == 80


def test_scope_leaves_nothing(spark):
    with scratch_scope(spark) as folder:
        materialize(spark.range(5), "some")
        inside = os.path.isdir(folder)
    assert inside and not os.path.exists(folder)


def test_refresh_publishes_what_arrived(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_month(inbox / "a.csv", 10, 60, 4)
    assert one(pipeline.refresh(spark, str(inbox), str(tmp_path / "out")))["total_events"] == 60
    write_month(inbox / "b.csv", 11, 40, 5)
    assert one(pipeline.refresh(spark, str(inbox), str(tmp_path / "out")))["total_events"] == 100


def test_run_end_to_end(spark, months, tmp_path):
    row = one(pipeline.run(spark, months, str(tmp_path / "out"), batch_rows=200))
    assert row["total_events"] == 500 and row["engine"] == "tallycart"
    later = one(pipeline.run(spark, months, str(tmp_path / "out"), start="2019-11-01", end="2019-11-30"))
    assert later["total_events"] == 200 and later["start"] >= "2019-11-01"
    assert one(pipeline.latest_summary(spark, str(tmp_path / "out"))) == later


def test_refresh_reads_each_file_once(spark, months, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_month(inbox / "a.csv", 10, 30, 4)
    args = (str(inbox), str(tmp_path / "table"), str(tmp_path / "offsets"))
    assert ingest_new_files(spark, *args).count() == 30
    write_month(inbox / "b.csv", 11, 20, 5)
    assert ingest_new_files(spark, *args).count() == 50
    counts = event_counts(clean_events(ingest_new_files(spark, *args)))
    assert sum(r["count"] for r in dicts(counts)) == 50


def test_empty_input_builds_a_document(spark):
    events = clean_events(raw(spark, dict(event_time="2019-10-01", event_type="view", user_id=1))).filter("user_id = 0")
    body = json.loads(one(doc.build_document(build_cubes(events), "x").document)["document"])
    assert body["revenue"]["daily"] == [] and body["segments"]["segment_summary"] == []
    assert body["dashboard"]["kpis"]["total_revenue"] == 0.0 and body["time_behavior"]["peak_window"] == {}
    assert body["funnel"]["available"] is False
