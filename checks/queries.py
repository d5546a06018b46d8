"""The registered queries: name -> callable(spark, folder) -> DataFrame.

``sales`` carries money, months, customers and products; ``clicks`` carries the
funnel, hours and events of every type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallycart.functions import money, month_text
from tallycart.operators import categories, customers, filters, funnel, grain, heatmap, kpi, products, promotions, range_counts, series, views
from tallycart.operators.clean import between_days, clean_events, event_report, purchases_of
from tallycart.plans import cubes as cube_plans
from tallycart.plans import document, snapshot
from tallycart.plans.state import refresh_state
from tallycart.plans import view as view_plans
from tallycart.schema import CUBES
from tallycart.sources import files, tables
from tallycart.sources.scratch import materialize, scratch_path, scratch_scope
from tallycart.streaming.refresh import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

START, END, CATEGORY = "1997-03-01", "1998-08-31", "economy"
CLICK_START, CLICK_END, CLICK_CATEGORY = "2024-01-06", "2024-01-21", "cat2"
REFRESH_FROM, REFRESH_LATE = "2024-01-15", "2024-01-06"
ROW_CAP = 4_000
FILE_ROWS = 300
PRODUCT_ID = 7
BATCH = 2_500
TRAILING_DAYS = 90

SALE_PROMOTIONS = """
  ('SPRING97', 20.0D, DATE'1997-03-01', DATE'1997-03-31', array('economy', 'small')),
  ('SUMMER97', 35.0D, DATE'1997-07-01', DATE'1997-08-15', array('large', 'medium', 'promo')),
  ('AUGUST97', 10.0D, DATE'1997-08-01', DATE'1997-08-31', array('large')),
  ('YEAREND99', 15.5D, DATE'1999-11-20', DATE'1999-12-31', array('standard', 'economy')),
  ('LATER', 50.0D, DATE'2010-01-01', DATE'2010-01-31', array('economy'))
"""
CLICK_PROMOTIONS = """
  ('JAN-A', 25.0D, DATE'2024-01-05', DATE'2024-01-10', array('cat0', 'cat1')),
  ('JAN-B', 40.0D, DATE'2024-01-08', DATE'2024-01-20', array('cat1', 'unknown'))
"""


def _promotions(spark: SparkSession, values: str) -> DataFrame:
    columns = "promotion_id, discount_pct, start_date, end_date, categories"
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def _sales(spark: SparkSession, folder: str, with_part: bool = True) -> DataFrame:
    return tables.sale_purchases(spark, folder, with_part)


def _money(spark: SparkSession, folder: str) -> DataFrame:
    """Sales without the part join, for metrics that need no category."""
    return tables.sale_purchases(spark, folder, with_part=False)


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return tables.click_purchases(spark, folder)


def _sale_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Days written once, for metrics that read them several times."""
    return materialize(series.daily_cube(_money(spark, folder)), "daily")


def _on(source, cube, report) -> Query:
    return lambda spark, folder: report(cube(source(spark, folder)))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return customers.scored_from(_money(spark, folder))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return products.products_from(_sales(spark, folder))


def _ranged(spark: SparkSession, folder: str) -> DataFrame:
    return between_days(_sales(spark, folder), START, END)


def _kpi_totals(spark: SparkSession, events: DataFrame) -> DataFrame:
    bought = cube_plans.stored_purchases(purchases_of(events))
    return kpi.kpi_totals(
        materialize(funnel.event_counts(events), "event-counts"),
        bought,
        materialize(series.daily_cube(bought), "daily"),
        customers.user_cube(bought),
    )


def kpi_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _kpi_totals(spark, tables.click_events(spark, folder))


def kpi_totals_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _kpi_totals(spark, clean_events(tables.sales(spark, folder, with_part=False)))


def month_delta_view(spark: SparkSession, folder: str) -> DataFrame:
    """Month delta of a filtered range."""
    return series.month_delta(series.daily_cube(between_days(_money(spark, folder), START, END)))


def customer_cards(spark: SparkSession, folder: str) -> DataFrame:
    bought = cube_plans.stored_purchases(_money(spark, folder))
    users = materialize(customers.user_cube(bought), "users")
    return customers.customer_cards(customers.score_users(users), series.daily_cube(bought))


def _staged(spark: SparkSession, cubes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cubes written as the pipeline stages them, and read back."""
    path = scratch_path(spark, "staged")
    cube_plans.write_cubes(cubes, path)
    return {n: spark.read.schema(CUBES[n]).parquet(f"{path}/{n}") if n in CUBES else spark.read.parquet(f"{path}/{n}") for n in cubes}


def _view_kpis(spark: SparkSession, folder: str, start, end, category) -> DataFrame:
    bought = _sales(spark, folder)
    staged = _staged(
        spark,
        {
            "totals": kpi.purchase_totals(bought),
            "daily": series.daily_cube(bought),
            "category_daily": categories.category_daily_cube(bought),
        },
    )
    return views.view_kpis(staged["totals"], staged["daily"], staged["category_daily"], start, end, category)


def view_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return _view_kpis(spark, folder, START, END, CATEGORY)


def view_kpis_swapped_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _view_kpis(spark, folder, END, START, None)


def view_kpis_unfiltered(spark: SparkSession, folder: str) -> DataFrame:
    return _view_kpis(spark, folder, None, None, None)


def view_categories(spark: SparkSession, folder: str) -> DataFrame:
    return views.view_categories(categories.category_daily_cube(_ranged(spark, folder)), START, END)


def view_donut(spark: SparkSession, folder: str) -> DataFrame:
    return views.category_donut(view_categories(spark, folder))


def view_categories_staged(spark: SparkSession, folder: str) -> DataFrame:
    """The same view over the staged, month-partitioned cube."""
    path = scratch_path(spark, "staged")
    cube_plans.write_cubes({"category_daily": categories.category_daily_cube(_sales(spark, folder))}, path)
    staged = files.read_or_empty(spark, f"{path}/category_daily", CUBES["category_daily"])
    return views.view_categories(staged, START, END)


def view_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    ranged = between_days(_clicks(spark, folder), CLICK_START, CLICK_END)
    return views.view_heatmap(heatmap.heatmap_daily_cube(ranged), CLICK_START, CLICK_END)


def view_heatmap_allocated(spark: SparkSession, folder: str) -> DataFrame:
    bought = cube_plans.stored_purchases(between_days(_clicks(spark, folder), CLICK_START, CLICK_END))
    return views.view_heatmap_allocated(
        heatmap.heatmap_daily_cube(bought),
        categories.category_daily_cube(bought),
        CLICK_START,
        CLICK_END,
        CLICK_CATEGORY,
    )


def view_allocation(spark: SparkSession, folder: str) -> DataFrame:
    bought = cube_plans.stored_purchases(_ranged(spark, folder))
    return views.view_allocation(
        series.daily_cube(bought), categories.category_daily_cube(bought), START, END, CATEGORY
    )


def view_funnel(spark: SparkSession, folder: str) -> DataFrame:
    counts = funnel.event_counts(tables.click_events(spark, folder))
    ranged = between_days(_clicks(spark, folder), CLICK_START, CLICK_END)
    return views.view_funnel(
        funnel.funnel(counts), categories.category_daily_cube(ranged), CLICK_START, CLICK_END, CLICK_CATEGORY
    )


def view_last_n_days(spark: SparkSession, folder: str) -> DataFrame:
    daily = _sale_daily(spark, folder)
    return series.daily_series(filters.last_days(daily, daily, TRAILING_DAYS))


def view_exact_range(spark: SparkSession, folder: str) -> DataFrame:
    return views.exact_range(_sales(spark, folder), START, END, CATEGORY)


def view_buyers_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Exact buyers and orders of a range, and whether the sketches come within five percent."""
    bought = between_days(_money(spark, folder), START, END)
    estimate = views.estimated_range(views.daily_sketches(bought), START, END)
    exact = views.exact_range(bought)
    near = lambda name: F.abs(estimate.select(f"{name}_estimate").scalar() - F.col(name)) <= 0.05 * F.col(name)
    return exact.select("buyers", "orders", near("buyers").alias("buyers_near"), near("orders").alias("orders_near"))


def daily_signals(spark: SparkSession, folder: str) -> DataFrame:
    bought = cube_plans.stored_purchases(_clicks(spark, folder))
    return views.daily_signals(series.daily_cube(bought), heatmap.peak_window(heatmap.heatmap_cube(bought)))


def promotion_performance(spark: SparkSession, folder: str) -> DataFrame:
    return promotions.promotion_performance(_sales(spark, folder), _promotions(spark, SALE_PROMOTIONS))


def _promotion_share(grain) -> Query:
    return lambda spark, folder: promotions.promotion_share(
        _sales(spark, folder), _promotions(spark, SALE_PROMOTIONS), grain()
    )


def promotion_share_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    return promotions.promotion_share(_clicks(spark, folder), _promotions(spark, CLICK_PROMOTIONS), F.col("hour"))


def promotion_discount(spark: SparkSession, folder: str) -> DataFrame:
    return promotions.promotion_discount(_sales(spark, folder), _promotions(spark, SALE_PROMOTIONS))


def _section(spark: SparkSession, folder: str, cubes: dict[str, DataFrame], name: str, part: str, **chosen) -> DataFrame:
    return document.section(_staged(spark, cubes), name, **chosen)[part]


def section_revenue(spark: SparkSession, folder: str) -> DataFrame:
    bought = _money(spark, folder)
    cubes = {"daily": series.daily_cube(bought), "monthly": series.monthly_cube(bought)}
    return _section(spark, folder, cubes, "revenue", "daily", start=START, end=END)


def _product_section(part: str, **chosen) -> Query:
    return lambda spark, folder: _section(
        spark, folder, {"products": products.product_cube(_sales(spark, folder))}, "products", part, **chosen
    )


def section_customers(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.click_events(spark, folder)
    bought = _clicks(spark, folder)
    cubes = {
        "daily": series.daily_cube(bought),
        "users": customers.user_cube(bought),
        "user_days": customers.user_day_cube(events),
    }
    return _section(spark, folder, cubes, "customers", "new_vs_returning", start=CLICK_START, end=CLICK_END)


def view_snapshot_filtered(spark: SparkSession, folder: str) -> DataFrame:
    cubes = _staged_click_cubes(spark, folder)
    scored = materialize(customers.score_users(cubes["users"]), "scored")
    return view_plans.view_snapshot(cubes, scored, CLICK_START, CLICK_END, CLICK_CATEGORY)


def view_new_vs_returning(spark: SparkSession, folder: str) -> DataFrame:
    return view_plans.view(_staged_click_cubes(spark, folder), CLICK_END, CLICK_START)["new_vs_returning"]


def product_filter_list(spark: SparkSession, folder: str) -> DataFrame:
    return products.product_filter_list(_products(spark, folder), tables.product_names(spark, folder))


def row_cap(spark: SparkSession, folder: str) -> DataFrame:
    """The earliest rows of the event source, cleaned."""
    return event_report(clean_events(files.cap_rows(tables.clicks(spark, folder), ROW_CAP)))


def row_cap_files(spark: SparkSession, folder: str) -> DataFrame:
    """The earliest rows of every file of a folder of one file per event type."""
    path = scratch_path(spark, "csv-files")
    files.write_csv_per_value(_events_text(spark, folder), "event_type", path)
    capped = files.read_events_csv(spark, [f"{path}/*"], rows_per_file=FILE_ROWS)
    return funnel.event_counts(clean_events(capped))


def empty_table(spark: SparkSession, folder: str) -> DataFrame:
    """A staged table that is not there beside one that is, as row counts."""
    staged = _staged(spark, {"daily": series.daily_cube(_money(spark, folder))})
    missing = files.read_or_empty(spark, scratch_path(spark, "no-such-table"), CUBES["daily"])
    counts = staged["daily"].agg(F.count(F.lit(1)).alias("present_rows"))
    return counts.select("present_rows", missing.agg(F.count(F.lit(1))).scalar().alias("missing_rows"))


def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    return files.count_rows(tables.clicks(spark, folder))


def union_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources of unequal columns as one table."""
    both = files.union_tables([tables.sales(spark, folder), tables.clicks(spark, folder, ["purchase"])])
    return series.monthly_summary(series.monthly_cube(purchases_of(clean_events(both))))


def _events_text(spark: SparkSession, folder: str) -> DataFrame:
    """The click events in the layout of the event files."""
    return tables.clicks(spark, folder).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        "event_type",
        "product_id",
        F.lit(None).cast("bigint").alias("category_id"),
        "category_code",
        F.lit(None).cast("string").alias("brand"),
        "price",
        "user_id",
        "user_session",
    )


def _events_as_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "csv")
    _events_text(spark, folder).write.option("header", True).csv(path)
    return path


def csv_daily(spark: SparkSession, folder: str) -> DataFrame:
    """CSV read with the declared schema, cleaned, by day."""
    raw = files.read_events_csv(spark, [_events_as_csv(spark, folder)])
    return series.daily_series(series.daily_cube(purchases_of(clean_events(raw))))


def conversion_report(spark: SparkSession, folder: str) -> DataFrame:
    """CSV -> Parquet in batches; the file count depends on the tasks, its bound does not."""
    csv = _events_as_csv(spark, folder)
    seen = Observation("csv")
    parquet = files.csv_to_parquet(spark, [csv], scratch_path(spark, "parquet"), batch_rows=BATCH, seen=seen)
    report = files.conversion_report(seen.get["rows"], parquet, BATCH)
    return report.select(
        "csv_rows",
        "parquet_rows",
        "batch_size",
        "num_batches",
        (F.col("num_parquet_files") >= F.col("num_batches")).alias("enough_files"),
        (F.col("max_rows_in_file") <= BATCH).alias("files_within_batch"),
    )


def export_daily_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "export")
    files.export_daily_csv(series.daily_series(series.daily_cube(_money(spark, folder))), path)
    return spark.read.schema("Date string, Revenue double, Orders bigint, Buyers bigint").csv(path, header=True)


def incremental_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Event files picked up by the file stream, then counted."""
    csv = _events_as_csv(spark, folder)
    table = ingest_new_files(spark, csv, scratch_path(spark, "stream"), scratch_path(spark, "offsets"))
    return funnel.event_counts(clean_events(table))


def refresh_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Cubes after two refreshes: early days, then later days with late rows of early ones."""
    text, base = _events_text(spark, folder), scratch_path(spark, "refresh")
    day = F.substring("event_time", 1, 10)
    late = ((day == REFRESH_LATE) & (F.col("user_id") % 3 == 0)) | (F.col("event_type") == "signup")
    for number in range(2):
        arrived = (day < REFRESH_FROM) & ~late
        text.filter(arrived if number == 0 else ~arrived).write.mode("append").option("header", True).csv(f"{base}/inbox")
        ingest_new_files(spark, f"{base}/inbox", f"{base}/events", f"{base}/offsets")
        cubes = refresh_state(spark, f"{base}/events", f"{base}/state")

    def rows(name: str, first: Column, second: Column, orders: Column, buyers: Column, revenue: Column | None = None) -> DataFrame:
        table = spark.read.parquet(f"{cubes}/{name}")
        money_ = money("revenue_e4", 2) if revenue is None else revenue
        return table.select(
            F.lit(name).alias("cube"),
            first.cast("string").alias("first_key"),
            second.cast("string").alias("second_key"),
            money_.alias("revenue"),
            orders.cast("bigint").alias("orders"),
            buyers.cast("bigint").alias("buyers"),
        )

    none, col = F.lit(None), F.col
    return files.union_tables(
        [
            rows("daily", col("event_date"), none, col("orders"), col("buyers")),
            rows("monthly", col("month"), none, col("orders"), col("buyers")),
            rows("categories", col("category"), none, col("orders"), col("buyers")),
            rows("category_daily", col("event_date"), col("category"), col("orders"), col("buyers")),
            rows("heatmap", col("weekday"), col("hour"), col("orders"), none),
            rows("heatmap_daily", col("event_date"), col("hour"), col("orders"), none),
            rows("users", col("user_id"), F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"), col("orders"), none),
            rows("products", col("product_id"), col("category_code"), col("quantity"), none),
            rows("event_counts", col("event_type"), none, col("count"), none, F.lit(None).cast("double")),
            rows("user_days", col("event_date"), none, col("active_users"), col("new"), F.lit(None).cast("double")),
            rows("totals", none, none, col("total_orders"), none, col("total_revenue")),
            rows("capabilities", none, none, col("total_sessions"), none, F.lit(None).cast("double")),
        ]
    )


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per outcome where some have no readable time, user or price."""
    path, out = scratch_path(spark, "csv"), scratch_path(spark, "checked")
    user, product = F.col("user_id"), F.col("product_id")
    broken = {
        "event_time": F.when(product % 17 == 3, "yesterday").when(product % 17 != 5, F.col("event_time")),
        "user_id": F.when(user % 13 == 5, F.concat(F.lit("u"), user.cast("string"))).when(user % 13 != 7, user.cast("string")),
        "price": F.when(product % 10 == 1, "12 dollars").otherwise(F.col("price").cast("string")),
    }
    _events_text(spark, folder).withColumns(broken).write.option("header", True).csv(path)
    files.csv_to_checked_parquet(spark, [path], out)
    return files.quarantine_report(spark, out)


def view_exact_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Exact figures of a range and a category from staged tables alone."""
    bought = cube_plans.stored_purchases(_sales(spark, folder))
    orders, buyers = grain.stored_orders(bought), grain.stored_buyers(bought)
    staged = _staged(
        spark,
        {
            "range_bitmaps": range_counts.range_bitmaps(orders, buyers),
            "category_daily": grain.figures(orders, buyers, "event_date", "category"),
        },
    )
    return range_counts.exact_view(staged["range_bitmaps"], staged["category_daily"], START, END, CATEGORY)


def _staged_click_cubes(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    path = scratch_path(spark, "cubes")
    cube_plans.write_cubes(cube_plans.build_cubes(tables.click_events(spark, folder)), path)
    return cube_plans.read_cubes(spark, path)


def _publish(spark: SparkSession, folder: str, path: str, run: str, at: str, promoted: DataFrame | None = None) -> str:
    """Cubes staged and a document published; all but the run is removed again."""
    with scratch_scope(spark) as scope:
        events = tables.click_events(spark, folder)
        cube_plans.write_cubes(cube_plans.build_cubes(events, promoted), f"{scope}/cubes")
        document.publish(document.build_document(cube_plans.read_cubes(spark, f"{scope}/cubes"), at), path, run)
    return path


def _published(spark: SparkSession, folder: str) -> str:
    return _publish(spark, folder, scratch_path(spark, "document"), "run-1", "2024-02-01T00:00:00Z")


def document_sections(spark: SparkSession, folder: str) -> DataFrame:
    return document.document_sections(document.read_document(spark, _published(spark, folder)))


def document_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Required sections that a document of the events lacks when only some are published, with the events it was built from."""
    path = scratch_path(spark, "document")
    cubes = _staged_click_cubes(spark, folder)
    document.publish(document.build_document(cubes, "x", only=("meta", "funnel", "segments")), path, "run-1")
    published = document.read_document(spark, path)
    total = F.get_json_object("document", "$.meta.total_events").cast("bigint")
    return document.missing_sections(published).withColumn("total_events", published.select(total).scalar())


def document_summary(spark: SparkSession, folder: str) -> DataFrame:
    return document.document_summary(document.read_document(spark, _published(spark, folder)))


def document_daily(spark: SparkSession, folder: str) -> DataFrame:
    return document.document_daily(document.read_document(spark, _published(spark, folder)))


def document_categories_daily(spark: SparkSession, folder: str) -> DataFrame:
    return document.read_table(spark, _published(spark, folder), "categories_daily")


def document_heatmap_daily(spark: SparkSession, folder: str) -> DataFrame:
    return document.read_table(spark, _published(spark, folder), "heatmap_daily")


def document_republished(spark: SparkSession, folder: str) -> DataFrame:
    """One run twice, then run-10 after run-9: the summary of the last one, as one row."""
    path = scratch_path(spark, "document")
    with scratch_scope(spark) as scope:
        cube_plans.write_cubes(cube_plans.build_cubes(tables.click_events(spark, folder)), f"{scope}/cubes")
        cubes = cube_plans.read_cubes(spark, f"{scope}/cubes")
        for run, at in (("run-9", "1"), ("run-9", "2"), ("run-10", "3")):
            document.publish(document.build_document(cubes, at), path, run)
    return document.document_summary(document.read_document(spark, path))


def document_promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Promotion performance parsed back out of a published document, with the computed flag."""
    path = _publish(spark, folder, scratch_path(spark, "document"), "run-1", "x", _promotions(spark, CLICK_PROMOTIONS))
    text = document.read_document(spark, path)
    rows = "array<struct<promotion_id:string,orders_generated:bigint,revenue_generated:double,total_participants:bigint>>"
    flag = F.get_json_object("document", "$.meta.capabilities.promotions_available").cast("boolean")
    discount = F.get_json_object("document", "$.promotions.discount.avg_promotion_discount_pct").cast("double")
    listed = F.inline(F.from_json(F.get_json_object("document", "$.promotions.performance"), rows))
    return text.select(flag.alias("promotions_available"), discount.alias("avg_discount_pct"), listed)


def insights(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.click_events(spark, folder)
    bought = cube_plans.stored_purchases(_clicks(spark, folder))
    return snapshot.insights(
        products.pareto_summary(products.products_from(_clicks(spark, folder))),
        heatmap.peak_window(heatmap.heatmap_cube(bought)),
        funnel.funnel(funnel.event_counts(events)),
        categories.category_summary(categories.category_cube(bought)),
        funnel.capabilities(events),
    )


def dashboard_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    cubes = _staged_click_cubes(spark, folder)
    scored = customers.score_users(cubes["users"])
    return snapshot.dashboard_snapshot(
        document.kpi_row(cubes),
        customers.customer_cards(scored),
        series.month_delta(cubes["daily"]),
        categories.category_summary(cubes["categories"]),
        products.top_by_revenue(cubes["products"]),
        funnel.funnel(cubes["event_counts"]),
        customers.segment_summary(scored),
        heatmap.peak_window(cubes["heatmap"]),
    )


def queries() -> dict[str, Query]:
    day, month, cat = series.daily_cube, series.monthly_cube, categories.category_cube
    cells = heatmap.heatmap_cube
    return {
        # days and months
        "daily_revenue": _on(_money, day, series.daily_series),
        "daily_revenue_clicks": _on(_clicks, day, series.daily_series),
        "daily_chart": lambda s, d: series.daily_chart(_sale_daily(s, d)),
        "day_growth": _on(_money, day, series.day_growth),
        "revenue_growth": _on(_money, day, series.revenue_growth),
        "monthly_summary": _on(_money, month, series.monthly_summary),
        "monthly_summary_clicks": _on(_clicks, month, series.monthly_summary),
        "month_totals_additive": _on(_money, day, series.month_totals_additive),
        "month_delta_last_two": _on(_money, day, series.month_delta),
        "month_delta_one_month": _on(_clicks, day, series.month_delta),
        "seasonality": _on(_money, day, series.seasonality),
        "date_range": _on(_money, day, series.date_range),
        # events and totals
        "clean_events": lambda s, d: event_report(tables.click_events(s, d)),
        "clean_sales": lambda s, d: event_report(_sales(s, d)),
        "event_counts": _on(tables.click_events, funnel.event_counts, lambda x: x),
        "funnel": _on(tables.click_events, funnel.event_counts, funnel.funnel),
        "funnel_orders_only": _on(_money, funnel.event_counts, funnel.funnel),
        "funnel_steps": lambda s, d: funnel.funnel_steps(
            funnel.funnel(funnel.event_counts(tables.click_events(s, d)))
        ),
        "capabilities": lambda s, d: funnel.capabilities(tables.click_events(s, d)),
        "kpi_totals": kpi_totals,
        "kpi_totals_sales": kpi_totals_sales,
        # categories
        "category_summary": _on(_sales, cat, categories.category_summary),
        "category_summary_clicks": _on(_clicks, cat, categories.category_summary),
        "category_daily": _on(_sales, categories.category_daily_cube, categories.category_daily),
        "category_share": lambda s, d: categories.category_share(materialize(cat(_sales(s, d)), "categories")),
        "category_growth": lambda s, d: categories.category_growth(_sales(s, d)),
        "category_filter_list": _on(_sales, cat, categories.category_filter_list),
        "category_pareto": _on(_sales, cat, categories.category_pareto),
        # hours
        "heatmap": _on(_clicks, cells, heatmap.heatmap),
        "heatmap_daily": _on(_clicks, heatmap.heatmap_daily_cube, heatmap.heatmap_daily),
        "heatmap_intensity": lambda s, d: heatmap.heatmap_intensity(materialize(cells(_clicks(s, d)), "heatmap")),
        "peak_window": _on(_clicks, cells, heatmap.peak_window),
        "hourly_pattern": lambda s, d: heatmap.hourly_pattern(_clicks(s, d)),
        # customers
        "user_summary": _on(_money, customers.user_cube, customers.user_summary),
        "top_customers": _on(_money, customers.user_cube, customers.top_customers),
        "rfm_scores": lambda s, d: customers.rfm_report(_scored(s, d)),
        "rfm_scores_clicks": lambda s, d: customers.rfm_report(customers.scored_from(_clicks(s, d))),
        "rfm_top": lambda s, d: customers.rfm_top(_scored(s, d)),
        "segment_summary": lambda s, d: customers.segment_summary(_scored(s, d)),
        "segment_bars": lambda s, d: customers.segment_bars(_scored(s, d)),
        "churn_risk": lambda s, d: customers.churn_risk(_scored(s, d)),
        "customer_cards": customer_cards,
        "customer_mix": _on(_money, customers.user_cube, customers.customer_mix),
        "new_vs_returning": lambda s, d: customers.new_vs_returning(tables.click_events(s, d)),
        "active_users": lambda s, d: customers.active_users(tables.click_events(s, d)),
        # products
        "top_products_revenue": lambda s, d: products.top_by_revenue(_products(s, d)),
        "top_products_quantity": _on(_sales, products.product_cube, products.top_by_quantity),
        "product_abc": lambda s, d: products.product_abc(_products(s, d)),
        "pareto_summary": lambda s, d: products.pareto_summary(_products(s, d)),
        "product_filter_list": product_filter_list,
        "product_bars": _on(_sales, products.product_cube, products.product_bars),
        # filtered views
        "view_kpis": view_kpis,
        "view_kpis_swapped_bounds": view_kpis_swapped_bounds,
        "view_kpis_unfiltered": view_kpis_unfiltered,
        "view_categories": view_categories,
        "view_categories_staged": view_categories_staged,
        "view_donut": view_donut,
        "view_heatmap": view_heatmap,
        "view_heatmap_allocated": view_heatmap_allocated,
        "view_allocation": view_allocation,
        "view_funnel": view_funnel,
        "view_last_n_days": view_last_n_days,
        "view_month_delta": month_delta_view,
        "view_exact_range": view_exact_range,
        "view_exact_bitmap": view_exact_bitmap,
        "view_buyers_approx": view_buyers_approx,
        "daily_signals": daily_signals,
        # promotions
        "promotion_performance": promotion_performance,
        "promotion_share_by_month": _promotion_share(lambda: month_text("event_date").alias("month")),
        "promotion_share_by_weekday": _promotion_share(lambda: F.dayofweek("event_date").alias("weekday")),
        "promotion_share_by_category": _promotion_share(lambda: F.col("category")),
        "promotion_share_by_hour": promotion_share_by_hour,
        "promotion_discount": promotion_discount,
        # sources, sinks, document
        "source_rows": source_rows,
        "row_cap": row_cap,
        "union_monthly": union_monthly,
        "csv_daily": csv_daily,
        "csv_quarantine": csv_quarantine,
        "conversion_report": conversion_report,
        "export_daily_csv": export_daily_csv,
        "incremental_refresh": incremental_refresh,
        "refresh_incremental": refresh_incremental,
        "section_revenue": section_revenue,
        "section_products": _product_section("pareto_products", category=CATEGORY),
        "section_products_top": _product_section("top_by_revenue", category=CATEGORY),
        "section_product_id": _product_section("top_by_quantity", product_id=PRODUCT_ID),
        "section_customers": section_customers,
        "view_snapshot_filtered": view_snapshot_filtered,
        "view_new_vs_returning": view_new_vs_returning,
        "row_cap_files": row_cap_files,
        "empty_table": empty_table,
        "document_missing": document_missing,
        "document_categories_daily": document_categories_daily,
        "document_heatmap_daily": document_heatmap_daily,
        "document_republished": document_republished,
        "document_promotions": document_promotions,
        "document_sections": document_sections,
        "document_summary": document_summary,
        "document_daily": document_daily,
        "insights": insights,
        "dashboard_snapshot": dashboard_snapshot,
    }
