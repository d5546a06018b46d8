"""The end-to-end job: files in, cubes and a published document out.

Every step restarts from the tables of the one before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import between_days, clean_events, purchases_of
from ..sources.files import (
    BATCH_ROWS,
    checked_rows_per_file,
    conversion_report,
    count_rows,
    csv_to_checked_parquet,
    csv_to_parquet,
)
from ..sources.scratch import scratch_scope
from ..streaming.refresh import ingest_new_files
from .cubes import build_cubes, promotion_cubes, read_cubes, write_cubes
from .document import build_document, document_summary, publish, read_document, verify
from .state import refresh_state


def new_run_id() -> str:
    """Sorts by time; unique per attempt."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def run(
    spark: SparkSession,
    csv_paths: Sequence[str],
    out: str,
    rows_per_file: int = 0,
    batch_rows: int = BATCH_ROWS,
    start: str | None = None,
    end: str | None = None,
    run_id: str | None = None,
    promotions: DataFrame | None = None,
    product_names: DataFrame | None = None,
) -> DataFrame:
    """CSV -> Parquet -> cubes -> document; returns the verified summary row.

    Staged tables live under ``out/runs/<run id>``, documents under
    ``out/document``. Rows without a usable time or user are put aside under the run's
    events, with the reason and their text, and counted in the report; a run capped by rows drops them instead.
    """
    run_id = run_id or new_run_id()
    staging = f"{out}/runs/{run_id}"
    rows_per_file = checked_rows_per_file(rows_per_file)
    seen = Observation("csv")
    if rows_per_file > 0:
        raw = csv_to_parquet(spark, csv_paths, f"{staging}/events", rows_per_file, batch_rows, seen=seen)
        report = conversion_report(seen.get["rows"], raw, batch_rows)
    else:
        raw, aside = csv_to_checked_parquet(spark, csv_paths, f"{staging}/events", batch_rows, seen)
        report = conversion_report(seen.get["rows"], raw, batch_rows).withColumn("quarantined_rows", count_rows(aside).scalar())
    _publish_events(spark, clean_events(raw), out, run_id, csv_paths, start, end, promotions, product_names, report)
    return verify(spark, f"{out}/document")


def _publish_events(
    spark: SparkSession,
    events: DataFrame,
    out: str,
    run_id: str,
    sources: Sequence[str],
    start: str | None = None,
    end: str | None = None,
    promotions: DataFrame | None = None,
    product_names: DataFrame | None = None,
    report: DataFrame | None = None,
) -> None:
    """Events -> staged cubes -> published run. Scratch tables go once the run is written."""
    folder = f"{out}/runs/{run_id}/cubes"
    with scratch_scope(spark):
        write_cubes(build_cubes(between_days(events, start, end), promotions, product_names), folder)
        now = datetime.now(timezone.utc).isoformat()
        publish(build_document(read_cubes(spark, folder), now, sources, folder, report), f"{out}/document", run_id)


def refresh(
    spark: SparkSession,
    inbox: str,
    out: str,
    run_id: str | None = None,
    promotions: DataFrame | None = None,
    product_names: DataFrame | None = None,
    rows_per_file: int = 0,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Take in the event files that arrived in ``inbox`` and publish a run over all events so far.

    Files are read once, or the first ``rows_per_file`` rows of each. The cubes below ``out/state`` are brought up to
    date from the new events and the days they touch. A range of days is published from the
    events of the range in the store, and leaves the state as it is. The row returned names its source.
    """
    run_id, store = run_id or new_run_id(), f"{out}/events"
    stored = ingest_new_files(spark, inbox, store, f"{out}/offsets", checked_rows_per_file(rows_per_file))
    if start or end:
        _publish_events(spark, clean_events(stored), out, run_id, [inbox], start, end, promotions, product_names)
    else:
        folder = refresh_state(spark, store, f"{out}/state", promotions)
        if folder is None:
            _publish_events(spark, clean_events(stored), out, run_id, [inbox], None, None, promotions, product_names)
        else:
            _publish_state(spark, folder, clean_events(stored), out, run_id, [inbox], promotions, product_names)
    return verify(spark, f"{out}/document").withColumn("source", F.lit(inbox))


def _publish_state(
    spark: SparkSession,
    folder: str,
    events: DataFrame,
    out: str,
    run_id: str,
    sources: Sequence[str],
    promotions: DataFrame | None,
    product_names: DataFrame | None,
) -> None:
    """A run from merged cubes; promotions, which are not state, read the purchases of their days."""
    cubes = read_cubes(spark, folder)
    with scratch_scope(spark) as scope:
        if promotions is not None:
            more = promotion_cubes(purchases_of(events), promotions)
            write_cubes(more, f"{scope}/promotions")
            cubes |= {name: spark.read.parquet(f"{scope}/promotions/{name}") for name in more}
        if product_names is not None:
            cubes["product_names"] = product_names
        now = datetime.now(timezone.utc).isoformat()
        publish(build_document(cubes, now, sources, folder), f"{out}/document", run_id)


def latest_summary(spark: SparkSession, out: str) -> DataFrame:
    return document_summary(read_document(spark, f"{out}/document"))
