"""Cubes kept up to date from new events alone.

A refresh reads the micro-batches the state has not taken in, and of the event store the days that they
touch. What it merges:

* **Day tables** (daily, day by category, day by hour, active users): touched days are computed again, other days
  carried over.
* **Sums** (revenue, quantities, event counts): old plus new.
* **Distinct counts across days** (orders and buyers of a month, category, weekday and hour; orders of a
  buyer; sessions): old plus the pairs (key, value) not seen before. Pairs seen are state, one
  narrow row each; the few pairs of a refresh are looked up in them by a semi-join whose small side is the new
  pairs, so the seen ones are scanned but not exchanged where the new ones can be broadcast.
* **First days**: a visitor's first day is state; a new one counts on it, an earlier one moves the count.
* **Buyers and products**: totals per id, merged with those of the new events.

Every version is a folder of its own, made known by a numbered record that only one writer can create. A
refresh that fails leaves no record; one that finds its number taken starts again from the new record. Seen
pairs and first days are appended; after ``COMPACT`` versions they are written together.

Day tables and totals are rewritten, so a refresh costs the new events, the touched days, the cubes
(days x categories), the buyers and products, and one scan of the pairs; never the history of events.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import customers, funnel, grain, kpi, products
from ..operators.clean import clean_events, purchases_of
from ..sources import commits
from ..sources.scratch import materialize, remove, scratch_scope
from ..streaming.refresh import stored_batches, stored_events
from .cubes import stored_purchases, write_cubes

#: Versions whose appended parts are kept apart.
COMPACT = 16

_SEEN = "kind string, key string, value string"
_FIRST = "user_id bigint, first_day date"
_DAY, _HOUR, _CATEGORY = "event_date", "hour", "category"


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _cell() -> Column:
    return F.concat_ws("-", F.dayofweek(_DAY), _HOUR)


def _month() -> Column:
    return F.trunc(_DAY, "MM")


def distinct_pairs(events: DataFrame, purchases: DataFrame) -> DataFrame:
    """(kind, key, value), each once: what the distinct counts across days count."""
    order, user, none = F.col("order_id"), _text("user_id"), F.lit("")
    kinds = {
        "order": (order, none),
        "order_month": (order, _text(_month())),
        "order_category": (order, F.col(_CATEGORY)),
        "order_cell": (order, _cell()),
        "user_month": (user, _text(_month())),
        "user_category": (user, F.col(_CATEGORY)),
        "user_order": (user, order),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("key"), b.alias("value")) for k, (a, b) in kinds.items()])
    sessions = events.select(F.lit("session").alias("kind"), order.alias("key"), none.alias("value"))
    return purchases.select(F.inline(rows)).unionByName(sessions).distinct()


def unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs that ``seen`` does not hold; ``pairs`` are few and stored."""
    names = ["kind", "key", "value"]
    known = seen.join(pairs, names, "left_semi")
    return pairs.join(known, names, "left_anti")


def _counted(fresh: DataFrame, kind: str, value: Column, name: str) -> DataFrame:
    return fresh.filter(F.col("kind") == kind).groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def _added(old: DataFrame | None, rows: Sequence[DataFrame], keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums per key over old and new rows; a column that a part lacks adds nothing."""
    parts = [p for p in (old, *rows) if p is not None]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy(*keys).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sums])


def _across(old: DataFrame | None, purchases: DataFrame, fresh: DataFrame, keys: dict[str, Column], kinds: dict[str, tuple[str, Column]]) -> DataFrame:
    """A table of sums and distinct counts per key: ``kinds`` names the pairs that each count takes."""
    rows = [purchases.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.sum("revenue_e4").alias("revenue_e4"))]
    for count, (kind, value) in kinds.items():
        found = _counted(fresh, kind, value, "value")
        names = [F.col("value").alias(next(iter(keys)))] if len(keys) == 1 else [F.col(f"value.{k}").alias(k) for k in keys]
        rows.append(found.select(*names, F.col("n").alias(count)))
    return _added(old, rows, list(keys), ["revenue_e4", *kinds])


def first_days(old: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New or earlier first days of visitors, and what they change in the number of new users per day."""
    here = materialize(events.groupBy("user_id").agg(F.min(_DAY).alias("first_day")), "first-here")
    known = old.join(here.select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(F.min("first_day").alias("known"))
    met = here.join(known, "user_id", "left").filter(F.col("known").isNull() | (F.col("first_day") < F.col("known")))
    moved = materialize(met, "first-moved")
    one = F.lit(1).cast("bigint")
    more = moved.select(F.col("first_day").alias(_DAY), one.alias("new"))
    less = moved.filter("known is not null").select(F.col("known").alias(_DAY), (-one).alias("new"))
    return moved.select("user_id", "first_day"), more.unionByName(less).groupBy(_DAY).agg(F.sum("new").alias("new"))


def _ranges(days: Sequence[date]) -> list[tuple[date, date]]:
    """Days as ranges (first, day after the last)."""
    out: list[tuple[date, date]] = []
    for day in sorted(days):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + timedelta(days=1))
        else:
            out.append((day, day + timedelta(days=1)))
    return out


def on_days(events: DataFrame, days: Sequence[date]) -> DataFrame:
    """Raw stored events of these days: their months choose the folders, their times the row groups."""
    if not days:
        return events.filter(F.lit(False))
    months = sorted({f"{d:%Y-%m}" for d in days})
    times = reduce(
        Column.__or__,
        [(F.col("event_time") >= F.lit(a).cast("timestamp")) & (F.col("event_time") < F.lit(b).cast("timestamp")) for a, b in _ranges(days)],
    )
    return events.filter(F.col("month").isin(months) & times)


class State:
    """The committed versions below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.number, text = commits.newest(spark, f"{folder}/commits")
        self.record = json.loads(text) if text else {"batch": -1, "cubes": None, "seen": [], "first": []}

    @property
    def cubes(self) -> str | None:
        """Folder of the newest cubes, relative names resolved."""
        return self.record["cubes"] and f"{self.folder}/{self.record['cubes']}"

    def old(self, name: str) -> DataFrame | None:
        return None if self.cubes is None else self.spark.read.parquet(f"{self.cubes}/{name}")

    def parts(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{p}" for p in self.record[name]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def _day_tables(touched: DataFrame, days: Sequence[date], state: State) -> dict[str, DataFrame]:
    """Day tables with the touched days computed again; ``touched`` are all events of those days."""
    bought = stored_purchases(purchases_of(touched))
    orders, buyers = grain.stored_orders(bought), grain.stored_buyers(bought)
    active = touched.select("user_id", _DAY).distinct().groupBy(_DAY).agg(F.count(F.lit(1)).alias("active_users"))
    fresh = {
        "daily": grain.figures(orders, buyers, _DAY),
        "category_daily": grain.figures(orders, buyers, _DAY, _CATEGORY),
        "heatmap_daily": grain.order_figures(orders, _DAY, _HOUR).select(
            _DAY, F.dayofweek(_DAY).alias("weekday"), _HOUR, "revenue_e4", "orders"
        ),
        "active": active,
    }

    def merged(name: str, new: DataFrame) -> DataFrame:
        old = state.old(name)
        if old is None:
            return new
        kept = old.filter(~F.col(_DAY).isin(list(days))) if days else old
        return kept.select(*new.columns).unionByName(new)

    return {name: merged(name, new) for name, new in fresh.items()}


def merged_cubes(new: DataFrame, touched: DataFrame, days: Sequence[date], state: State) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """All cubes with the new events in, the pairs seen for the first time, and the first days that are new."""
    bought = materialize(purchases_of(new), "new-purchases")
    pairs = materialize(distinct_pairs(new, bought), "new-pairs")
    fresh = materialize(unseen(pairs, state.parts("seen", _SEEN)), "fresh-pairs")
    firsts, moves = first_days(state.parts("first", _FIRST), new)
    tables = _day_tables(touched, days, state)

    value = F.col("value")
    month, category = {"month": _month()}, {_CATEGORY: F.col(_CATEGORY)}
    cell = {"weekday": F.dayofweek(_DAY), _HOUR: F.col(_HOUR)}
    at = F.split(value, "-")
    place = F.struct(at[0].cast("int").alias("weekday"), at[1].cast("int").alias(_HOUR))
    tables["monthly"] = _across(
        state.old("monthly"), bought, fresh, month, {"orders": ("order_month", value.cast("date")), "buyers": ("user_month", value.cast("date"))}
    )
    tables["categories"] = _across(state.old("categories"), bought, fresh, category, {"orders": ("order_category", value), "buyers": ("user_category", value)})
    tables["heatmap"] = _across(state.old("heatmap"), bought, fresh, cell, {"orders": ("order_cell", place)})

    tables["new_users"] = _added(state.old("new_users"), [moves], [_DAY], ["new"])
    tables["event_counts"] = _added(state.old("event_counts"), [funnel.event_counts(new)], ["event_type"], ["count"])
    parts = products.product_parts(bought)
    old_parts = state.old("product_parts")
    tables["product_parts"] = parts if old_parts is None else products.merged_parts(old_parts.unionByName(parts))
    tables["users"] = _users(state.old("users"), bought, fresh)

    sums = bought.agg(F.coalesce(F.sum("revenue_e4"), F.lit(0)).alias("revenue_e4"))
    counts = fresh.agg(F.count_if(F.col("kind") == "order").alias("orders"), F.count_if(F.col("kind") == "session").alias("sessions"))
    tables["sums"] = _added(state.old("sums"), [sums, counts], [], ["revenue_e4", "orders", "sessions"])
    return tables, fresh, firsts


def _users(old: DataFrame | None, bought: DataFrame, fresh: DataFrame) -> DataFrame:
    """Buyers' totals; an order counts where its pair with the buyer is new."""
    sums = bought.groupBy("user_id").agg(
        F.sum("revenue_e4").alias("revenue_e4"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen")
    )
    orders = _counted(fresh, "user_order", F.col("key").cast("bigint"), "user_id").withColumnRenamed("n", "orders")
    parts = [sums, orders] if old is None else [old, sums, orders]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy("user_id").agg(
        F.coalesce(F.sum("revenue_e4"), F.lit(0)).alias("revenue_e4"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def _served(spark: SparkSession, folder: str, promoted: DataFrame | None) -> dict[str, DataFrame]:
    """The tables a document needs that follow from the merged ones."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    none = F.lit(0).cast("bigint")
    days = read("active").withColumn("new", none).unionByName(read("new_users").withColumn("active_users", none))
    sums, counts = read("sums"), read("event_counts")
    return {
        "user_days": days.groupBy(_DAY).agg(F.sum("active_users").alias("active_users"), F.sum("new").alias("new")),
        "products": products.products_of(read("product_parts")),
        "totals": kpi.totals_row(sums.select("revenue_e4", F.col("orders").alias("total_orders"))),
        "capabilities": funnel.capabilities_of(counts, sums.select("sessions").scalar(), promoted),
    }


def refresh_state(spark: SparkSession, store: str, folder: str, promoted: DataFrame | None = None) -> str | None:
    """Take the store's new micro-batches into the state; the folder of the newest cubes, None before the first batch."""
    while True:
        state = State(spark, folder)
        waiting = [b for b in stored_batches(spark, store) if b > state.record["batch"]]
        if not waiting:
            return state.cubes
        name = f"v{state.number + 1}-{uuid.uuid4().hex[:8]}"
        path = f"{folder}/{name}"
        with scratch_scope(spark):
            events = stored_events(spark, store)
            new = materialize(clean_events(events.filter(F.col("batch").isin(waiting))), "new-events")
            days = [r[0] for r in new.select(_DAY).distinct().collect()]  # days of the new events
            # at the first refresh nothing lies around the new events
            around = new if state.cubes is None else clean_events(on_days(events, days))
            tables, fresh, firsts = merged_cubes(new, around, days, state)
            write_cubes(tables, f"{path}/cubes")
            write_cubes(_served(spark, f"{path}/cubes", promoted), f"{path}/cubes")
            record = {"batch": max(waiting), "cubes": f"{name}/cubes"}
            for part, rows, schema in (("seen", fresh, _SEEN), ("first", firsts, _FIRST)):
                before = state.record[part]
                if len(before) >= COMPACT:
                    rows, before = state.parts(part, schema).unionByName(rows), []
                rows.write.mode("overwrite").parquet(f"{path}/{part}")
                record[part] = [*before, f"{name}/{part}"]
        if commits.claim(spark, f"{folder}/commits", state.number + 1, json.dumps(record)):
            return f"{folder}/{record['cubes']}"
        remove(spark, path)
