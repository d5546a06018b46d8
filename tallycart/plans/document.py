"""The nested dashboard document: build, publish, verify, read sections.

A published run is a folder of its own. Sections bounded by the calendar or by a
top-k limit are assembled into one nested JSON text. Categories, days by
category and days by hour grow with the data; whatever their size, they are
tables of the same run, written in parallel in display order, and the document
names them. A pointer row, added last, makes a run the newest one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import avg_ratio, ratio
from ..operators import categories, customers, funnel, heatmap, kpi, products, series
from ..operators.filters import filter_rows
from ..sources import commits
from ..sources.scratch import materialize
from . import snapshot

ENGINE = "tallycart"
# The sections a published document must have.
REQUIRED = (
    "meta",
    "filters",
    "dashboard",
    "revenue",
    "funnel",
    "categories",
    "time_behavior",
    "customers",
    "segments",
)
# Tables of a run beside the nested text: section and display order of each.
TABLES = {
    "categories": ("categories", ("-revenue", "category")),
    "categories_daily": ("categories", ("event_date", "category")),
    "heatmap_daily": ("time_behavior", ("event_date", "weekday", "hour")),
    "new_vs_returning": ("customers", ("event_date",)),
}
_KEEP_NULLS = {"ignoreNullFields": "false"}


def _json_row(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), _KEEP_NULLS)


def _records(df: DataFrame, *order: Column) -> DataFrame:
    """One row: the frame as a JSON array in ``order``."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, _json_row(df).alias("json"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(rows, lambda r: r["json"]), ","), F.lit("]"))
    return df.agg(body.alias("body"))


def _object(df: DataFrame) -> DataFrame:
    """One row: a one-row frame as a JSON object, ``{}`` when it has no row."""
    return df.agg(F.coalesce(F.max(_json_row(df)), F.lit("{}")).alias("body"))


def _values(df: DataFrame, column: str, *order: Column) -> DataFrame:
    """One row: one column as a JSON array."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, F.col(column).alias("v"))))
    return df.agg(F.to_json(F.transform(rows, lambda r: r["v"])).alias("body"))


def _part(section: str, name: str | None, body: DataFrame) -> DataFrame:
    return body.select(F.lit(section).alias("section"), F.lit(name).cast("string").alias("name"), "body")


class Reports:
    """Every published table by name, made when it is first asked for.

    Scored buyers and the product table are stored once and shared by what reads them.
    """

    def __init__(self, cubes: dict[str, DataFrame]) -> None:
        self.cubes, self.made = cubes, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = getattr(self, f"_{name}")() if hasattr(self, f"_{name}") else _PLAIN[name](self.cubes)
        return self.made[name]

    def _scored(self) -> DataFrame:
        return materialize(customers.score_users(self.cubes["users"]), "scored")

    def _insights(self) -> DataFrame:
        return snapshot.insights(
            self["pareto"], self["peak_window"], self["funnel"], self["categories"], self.cubes["capabilities"]
        )

    def _segments(self) -> DataFrame:
        return customers.rfm_top(self["scored"])

    def _segment_summary(self) -> DataFrame:
        return customers.segment_summary(self["scored"])

    def _churn_risk(self) -> DataFrame:
        return customers.churn_risk(self["scored"])

    def _customer_cards(self) -> DataFrame:
        return customers.customer_cards(self["scored"], self.cubes["daily"])

    def _daily_active_users(self) -> DataFrame:
        return self["daily"].select("event_date", "dau")


# Reports made of cubes alone.
_PLAIN: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "kpis": lambda c: kpi_row(c),
    "mix": lambda c: customers.customer_mix(c["users"]),
    "date_range": lambda c: series.date_range(c["daily"]),
    "filter_categories": lambda c: categories.category_filter_list(c["categories"]),
    "filter_products": lambda c: products.product_filter_list(c["products"], c.get("product_names")),
    "daily": lambda c: series.daily_series(c["daily"]),
    "monthly": lambda c: series.monthly_summary(c["monthly"]),
    "seasonality": lambda c: series.seasonality(c["daily"]),
    "funnel": lambda c: funnel.funnel(c["event_counts"]),
    "categories": lambda c: categories.category_share(c["categories"]),
    "categories_daily": lambda c: categories.category_daily(c["category_daily"]),
    "heatmap": lambda c: heatmap.heatmap(c["heatmap"]),
    "heatmap_daily": lambda c: heatmap.heatmap_daily(c["heatmap_daily"]),
    "hourly_pattern": lambda c: heatmap.hourly_cells(c["heatmap"]),
    "peak_window": lambda c: heatmap.peak_window(c["heatmap"]),
    "top_customers": lambda c: customers.top_customers(c["users"]),
    "new_vs_returning": lambda c: customers.new_vs_returning_report(c["user_days"]),
    "top_by_revenue": lambda c: products.top_by_revenue(c["products"]),
    "top_by_quantity": lambda c: products.top_by_quantity(c["products"]),
    "pareto": lambda c: products.pareto_summary(c["products"]),
    "pareto_products": lambda c: products.pareto_products(c["products"]),
    "month_delta": lambda c: series.month_delta(c["daily"]),
    "capabilities": lambda c: c["capabilities"],
}


def kpi_row(cubes: dict[str, DataFrame]) -> DataFrame:
    """Headline figures from the cubes."""
    rates = funnel.funnel(cubes["event_counts"])
    steps = funnel.step_totals(cubes["event_counts"])
    return cubes["totals"].select(
        "total_revenue",
        "total_orders",
        "average_order_value",
        series.revenue_growth(cubes["daily"]).scalar().alias("revenue_growth_pct"),
        rates.select("cart_to_purchase_pct").scalar().alias("conversion_rate_pct"),
        steps.select(ratio("purchase", "view", 100, default=0)).scalar().alias("overall_conversion_pct"),
        cubes["daily"].agg(avg_ratio("buyers")).scalar().alias("daily_active_users_avg"),
        kpi.mean_clv(cubes["users"]).scalar().alias("estimated_clv"),
    )


@dataclass
class Publication:
    """What one run publishes: the nested text (one row ``document``) and its tables."""

    document: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def _order(names: Sequence[str]) -> list[Column]:
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc_nulls_first() for n in names]


def build_document(
    cubes: dict[str, DataFrame],
    generated_at: str,
    sources: Sequence[str] = (),
    staged_at: str | None = None,
    conversion: DataFrame | None = None,
    only: Sequence[str] | None = None,
) -> Publication:
    """The nested text of the bounded sections, and the tables that grow with the data.

    ``only`` leaves out all sections but those named, and their tables.
    """
    r = Reports(cubes)
    steps = funnel.step_totals(cubes["event_counts"])
    meta = cubes["capabilities"].select(
        F.lit(ENGINE).alias("engine"),
        F.array(*[F.lit(s) for s in sources]).cast("array<string>").alias("sources"),
        F.lit(generated_at).alias("generated_at"),
        steps.select(F.col("view") + F.col("cart") + F.col("purchase")).scalar().alias("total_events"),
        "total_sessions",
        F.struct(
            "funnel_available", "traffic_events_available", "orders_available", "promotions_available"
        ).alias("capabilities"),
        F.lit(staged_at).cast("string").alias("staged_at"),
    )
    cell = (F.col("weekday"), F.col("hour"))
    mix = r["mix"]
    published = {n: t for n, t in TABLES.items() if n != "new_vs_returning" or "user_days" in cubes}

    def named(section: str) -> DataFrame:
        names = [n for n, (owner, _) in published.items() if owner == section]
        return meta.select(F.lit(json.dumps(names)).alias("body"))

    parts = [
        _part("meta", None, _object(meta)),
        _part("filters", "date_range", _object(r["date_range"])),
        _part("filters", "categories", _values(r["filter_categories"], "category", F.col("position"))),
        _part("filters", "products", _records(r["filter_products"], F.col("product_id"))),
        _part("dashboard", "kpis", _object(r["kpis"].select("*", *[mix.select(c).scalar().alias(c) for c in mix.columns]))),
        _part("revenue", "daily", _records(r["daily"], F.col("event_date"))),
        _part("revenue", "monthly", _records(r["monthly"], F.col("month"))),
        _part("revenue", "seasonality", _records(r["seasonality"], F.col("day_of_week"))),
        _part("funnel", None, _object(r["funnel"])),
        _part("categories", "tables", named("categories")),
        _part("time_behavior", "heatmap", _records(r["heatmap"], *cell)),
        _part("time_behavior", "hourly_pattern", _records(r["hourly_pattern"], F.col("hour"))),
        _part("time_behavior", "peak_window", _object(r["peak_window"])),
        _part("time_behavior", "tables", named("time_behavior")),
        _part("customers", "daily_active_users", _records(r["daily_active_users"], F.col("event_date"))),
        _part("customers", "top_customers", _records(r["top_customers"], -F.col("customer_revenue"), F.col("user_id"))),
        _part("customers", "tables", named("customers")),
        _part("segments", "segments", _records(r["segments"], -F.col("rfm_score"), F.col("user_id"))),
        _part("segments", "segment_summary", _records(r["segment_summary"], -F.col("revenue"), F.col("segment"))),
        _part(
            "segments",
            "churn_risk",
            _records(r["churn_risk"], -F.col("recency"), -F.col("monetary"), F.col("user_id")),
        ),
        _part("products", "top_by_revenue", _records(r["top_by_revenue"], -F.col("revenue"), F.col("product_id"))),
        _part("products", "top_by_quantity", _records(r["top_by_quantity"], -F.col("quantity"), F.col("product_id"))),
        _part("products", "pareto", _object(r["pareto"])),
        _part("insights", None, _records(r["insights"], F.col("position"))),
    ]
    if "promotion_performance" in cubes:
        parts += [
            _part("promotions", "performance", _records(cubes["promotion_performance"], F.col("promotion_id"))),
            _part("promotions", "discount", _object(cubes["promotion_discount"])),
        ]
        parts += [
            _part("promotions", name.removeprefix("promotion_"), _records(cubes[name], F.col("grain")))
            for name in sorted(cubes)
            if name.startswith("promotion_by_")
        ]
    if conversion is not None:
        parts.append(_part("conversion", None, _object(conversion)))

    rows = reduce(DataFrame.unionByName, parts)
    if only is not None:
        rows = rows.filter(F.col("section").isin(list(only)))
        published = {n: t for n, t in published.items() if t[0] in only}
    pair = F.concat(F.lit('"'), F.col("name"), F.lit('":'), F.col("body"))
    sections = rows.groupBy("section").agg(
        F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("named"), F.max("body").alias("body")
    )
    text = F.when(F.col("named") != "", F.concat(F.lit("{"), F.col("named"), F.lit("}"))).otherwise(F.col("body"))
    entries = F.array_sort(F.collect_list(F.concat(F.lit('"'), F.col("section"), F.lit('":'), text)))
    nested = sections.agg(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")).alias("document"))
    return Publication(nested, {n: r[n].orderBy(*_order(order)) for n, (_, order) in published.items()})


def _run_folder(path: str, run_id: str) -> str:
    return f"{path}/runs/{run_id}"


def newest_run(spark: SparkSession, path: str) -> str:
    """The run published last, from the numbered pointers alone."""
    run = commits.newest(spark, f"{path}/published")[1]
    if run is None:
        raise ValueError(f"nothing is published at {path}")
    return run


def publish(publication: Publication, path: str, run_id: str) -> None:
    """Write a run and make it the newest one.

    A run's own folder is overwritten, so a retry leaves one document. The pointer comes last: readers see the run
    before or this one. Its number is one above all earlier ones, so neither names nor clocks decide; of two
    publishers at once each gets a number of its own.
    """
    spark, folder = publication.document.sparkSession, _run_folder(path, run_id)

    def write(name: str | None) -> None:
        if name is None:
            publication.document.coalesce(1).write.mode("overwrite").parquet(f"{folder}/document")
        else:
            publication.tables[name].write.mode("overwrite").parquet(f"{folder}/tables/{name}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), [None, *publication.tables]))
    commits.append(spark, f"{path}/published", run_id)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The nested text of the newest run, as one row ``document``."""
    return spark.read.schema("document string").parquet(f"{_run_folder(path, newest_run(spark, path))}/document")


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the newest run."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; one of {sorted(TABLES)}")
    return spark.read.parquet(f"{_run_folder(path, newest_run(spark, path))}/tables/{name}")


def document_sections(document: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Required sections and whether the document has each."""
    keys = F.coalesce(F.json_object_keys("document"), F.array().cast("array<string>"))
    wanted = F.explode(F.array(*[F.lit(s) for s in required])).alias("section")
    return document.select(keys.alias("keys"), wanted).select(
        "section", F.array_contains("keys", F.col("section")).alias("present")
    )


def missing_sections(document: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    found = document.select(F.explode(F.json_object_keys("document")).alias("section"))
    wanted = document.select(F.explode(F.array(*[F.lit(s) for s in required])).alias("section"))
    return wanted.join(found, "section", "left_anti")


def document_summary(document: DataFrame) -> DataFrame:
    """The figures a publishing job reports about a document."""
    at = lambda path: F.get_json_object("document", path)
    return document.select(
        at("$.meta.engine").alias("engine"),
        at("$.meta.generated_at").alias("generated_at"),
        at("$.meta.total_events").cast("bigint").alias("total_events"),
        at("$.dashboard.kpis.total_revenue").cast("double").alias("total_revenue"),
        at("$.dashboard.kpis.total_orders").cast("bigint").alias("total_orders"),
        at("$.filters.date_range.start").alias("start"),
        at("$.filters.date_range.end").alias("end"),
    )


def verify(spark: SparkSession, path: str) -> DataFrame:
    """Summary of the newest document; raises when a required section is missing."""
    document = read_document(spark, path)
    missing = [row["section"] for row in missing_sections(document).collect()]  # at most len(REQUIRED)
    if missing:
        raise ValueError(f"document lacks sections: {missing}")
    return document_summary(document)


def health(spark: SparkSession, path: str) -> DataFrame:
    """Status row of the newest document."""
    return document_summary(read_document(spark, path)).select(
        F.lit("ok").alias("status"), "engine", "generated_at", "total_events"
    )


def document_daily(document: DataFrame) -> DataFrame:
    """The daily series parsed back out of a published document."""
    schema = (
        "array<struct<event_date:string,revenue:double,orders:bigint,dau:bigint,rolling_7d:double,prev_revenue:double>>"
    )
    daily = F.from_json(F.get_json_object("document", "$.revenue.daily"), schema)
    return document.select(F.inline(daily))


# Which report answers which section read, and the filters it accepts. Product filters choose
# among all products, before a list is cut to its length.
SECTIONS = {
    "revenue": {"daily": ("start", "end"), "monthly": (), "seasonality": ()},
    "funnel": {"funnel": ()},
    "products": {
        "top_by_revenue": ("category", "product_id"),
        "top_by_quantity": ("category", "product_id"),
        "pareto": (),
        "pareto_products": ("category", "product_id"),
    },
    "customers": {
        "daily": ("start", "end"),
        "daily_active_users": ("start", "end"),
        "new_vs_returning": ("start", "end"),
        "top_customers": (),
    },
    "segments": {"segments": (), "segment_summary": (), "churn_risk": ()},
    "categories": {"categories": (), "categories_daily": ()},
    "time_behavior": {"heatmap": (), "heatmap_daily": (), "hourly_pattern": (), "peak_window": ()},
    "dashboard": {"kpis": (), "date_range": (), "insights": ()},
}
_CHOSEN = {"top_by_revenue": products.top_by_revenue, "top_by_quantity": products.top_by_quantity}


def section(cubes: dict[str, DataFrame], name: str, **filters) -> dict[str, DataFrame]:
    """The tables of one section, filtered the way the section allows; no other report is made."""
    if name not in SECTIONS:
        raise KeyError(f"unknown section {name!r}; one of {json.dumps(sorted(SECTIONS))}")
    reports, out = Reports(cubes), {}
    for part, allowed in SECTIONS[name].items():
        if part == "new_vs_returning" and "user_days" not in cubes:
            continue
        chosen = {k: v for k, v in filters.items() if k in allowed and v is not None}
        if part in _CHOSEN and chosen:
            out[part] = _CHOSEN[part](filter_rows(cubes["products"], **chosen), whole=cubes["products"])
        else:
            out[part] = filter_rows(reports[part], **chosen)
    return out
