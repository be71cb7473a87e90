"""Feed streams: file source -> feed transform -> checkpointed append sink.

Each feed has its own input, output and checkpoint folder under one root.
Streams are map-only (no state), so a restart on the same checkpoint
resumes after the last committed file and never duplicates rows.  A run that
was stopped while its first batch was being planned can be started again: the
half-written offset file that it left is removed (``clear_unplanned``).
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.feeds import TRANSFORMS
from ..session import Profile, fs_delete, fs_list, get_profile
from ..sources import files
from ..sources.schemas import CALENDAR_SCHEMA, PRICES_SCHEMA
from . import sinks

FEEDS = ("calendar", "sales", "prices")


@dataclass(frozen=True)
class FeedPaths:
    input: str
    output: str
    checkpoint: str


def feed_paths(root: str, feed: str) -> FeedPaths:
    return FeedPaths(
        os.path.join(root, "input", feed),
        os.path.join(root, "output", feed),
        os.path.join(root, "checkpoints", feed),
    )


def feed_stream(spark: SparkSession, feed: str, input_path: str, fmt: str = "csv",
                max_files_per_trigger: int | None = None, with_time: bool = True) -> DataFrame:
    """The transformed, unstarted stream of one feed."""
    if feed == "sales":
        raw = files.open_sales_stream(spark, input_path, fmt, max_files_per_trigger)
    elif feed in ("calendar", "prices"):
        schema = CALENDAR_SCHEMA if feed == "calendar" else PRICES_SCHEMA
        raw = files.open_stream(spark, input_path, schema, fmt, max_files_per_trigger)
    else:
        raise ValueError(f"unknown feed {feed}")
    return TRANSFORMS[feed](raw, with_time=with_time)


def trigger_of(profile: Profile, available_now: bool = False) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": profile.trigger_interval}


def start_feed(spark: SparkSession, feed: str, root: str, profile: Profile | str = "development",
               fmt: str = "csv", sink_format: str | None = None, available_now: bool = False,
               with_time: bool = True, table: str | None = None):
    """Start one feed stream; returns the ``StreamingQuery``.

    With ``table`` the rows go to that named table (its files under the feed's
    output folder), else to the output folder alone.
    """
    prof = profile if isinstance(profile, Profile) else get_profile(profile)
    df = feed_stream(spark, feed, feed_paths(root, feed).input, fmt, prof.max_files_per_trigger, with_time)
    return _start(spark, feed, df, root, prof, sink_format, available_now, table)


def clear_unplanned(spark: SparkSession, checkpoint: str) -> list[str]:
    """Remove what an interrupted start left in a checkpoint that has no batch yet; returns the names.

    A query that is stopped while it plans its first batch leaves only a
    hidden temporary file among the offsets, and Spark refuses to start
    batch 0 beside it.  No sink can have written anything before the first
    offset file is complete, so nothing is lost.  A checkpoint with a planned
    batch is left as it is: Spark repeats that batch.
    """
    offsets = os.path.join(checkpoint, "offsets")
    names = fs_list(spark, offsets)
    if not names or not all(n.startswith(".") for n in names):
        return []
    for n in names:
        fs_delete(spark, os.path.join(offsets, n))
    return names


def _start(spark, feed, df, root, prof, sink_format, available_now, table):
    p = feed_paths(root, feed)
    clear_unplanned(spark, p.checkpoint)
    sink_format = sink_format or sinks.table_format(spark)
    trigger, name = trigger_of(prof, available_now), f"{feed}_feed"
    if table:
        return sinks.start_to_table(df, table, p.checkpoint, trigger, p.output, sink_format, name)
    return sinks.append_to_table(df, p.output, p.checkpoint, sink_format, trigger, query_name=name).start()


def run_streams(spark: SparkSession, root: str, profile: Profile | str = "development",
                feeds=FEEDS, fmt: str = "csv", available_now: bool = False, timeout_s: float | None = None,
                tables: dict[str, str] | None = None, on_progress=None):
    """Start the chosen feeds of a profile and wait until all end (or time out).

    Every feed is opened and checked before the first one starts, so a missing
    drop starts nothing.  All streams are watched together: the first failure is raised, and
    whatever ends the wait, every stream that was started is stopped.  Where
    the profile monitors, ``on_progress`` gets the progress table at its
    interval.  Returns the (stopped) queries.
    """
    prof = profile if isinstance(profile, Profile) else get_profile(profile)
    deadline = time.monotonic() + timeout_s if timeout_s else None
    due = time.monotonic() + prof.monitoring_interval_s
    queries = []
    try:
        opened = {f: feed_stream(spark, f, feed_paths(root, f).input, fmt, prof.max_files_per_trigger) for f in feeds}
        for f, df in opened.items():
            queries.append(_start(spark, f, df, root, prof, None, available_now, (tables or {}).get(f)))
        while active := [q for q in queries if q.isActive]:
            raise_failure(queries)
            if deadline is not None and time.monotonic() >= deadline:
                break
            active[0].awaitTermination(0.2)  # a short wait on one, then all are looked at
            if prof.monitoring and on_progress and time.monotonic() >= due:
                on_progress(progress_table(spark, queries))
                due = time.monotonic() + prof.monitoring_interval_s
        raise_failure(queries)
    finally:
        stop_all(queries)
    return queries


def raise_failure(queries) -> None:
    """Raise the failure of the first query that has one."""
    for q in queries:
        if not q.isActive and (failure := q.exception()):
            raise failure


def stop_all(queries, grace_s: float = 30.0) -> None:
    """Stop every query; one whose first batch is under way may finish that batch first (``grace_s`` at most)."""
    deadline = time.monotonic() + grace_s
    for q in queries:
        while q.isActive and q.lastProgress is None and time.monotonic() < deadline:
            status = q.status
            if not status["isTriggerActive"] and not status["message"].startswith("Initializing"):
                break
            time.sleep(0.05)
        if q.isActive:
            q.stop()


def progress_table(spark: SparkSession, queries=None) -> DataFrame:
    """One row per stream query: name, id, active, status message, last batch and rows."""
    queries = spark.streams.active if queries is None else queries
    rows = []
    for q in queries:
        last = q.lastProgress or {}
        status = q.status or {}
        rows.append((
            q.name, str(q.id), bool(q.isActive), status.get("message"),
            int(last.get("batchId", -1)) if last else -1,
            int(last.get("numInputRows", 0)) if last else 0,
        ))
    return spark.createDataFrame(
        rows, "name string, id string, is_active boolean, message string, last_batch_id long, last_input_rows long"
    )


def monitor_union(outputs: dict[str, DataFrame]) -> DataFrame:
    """Source and processing time of every row of the feed outputs."""
    parts = [df.select("data_source", F.col("processed_timestamp")) for df in outputs.values()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


def monitor_view(spark: SparkSession, outputs: dict[str, DataFrame], view: str = "monitoring_view") -> str:
    """Register the union of feed outputs as a global temp view; returns its name."""
    monitor_union(outputs).createOrReplaceGlobalTempView(view)
    return f"global_temp.{view}"


def summary(seen: DataFrame) -> DataFrame:
    """Rows and the span of processing times of each source."""
    at = F.col("processed_timestamp")
    return (
        seen.groupBy("data_source")
        .agg(F.count(F.lit(1)).alias("record_count"), F.max(at).alias("last_processed"), F.min(at).alias("first_processed"))
        .orderBy("data_source")
    )


def dashboard(spark: SparkSession, view: str = "global_temp.monitoring_view") -> DataFrame:
    """The summary of a registered monitoring view."""
    return summary(spark.table(view))
