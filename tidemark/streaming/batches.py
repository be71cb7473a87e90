"""Feed tables written batch by batch: repeatable, with bad records set aside, and monitored from their commits.

A table is a folder with ``rows/batch_id=N`` (Parquet, split into good and
set-aside rows) and ``commits/batch_id=N``, one row with the batch's figures.
A batch is part of the table once its commit is there.  A batch that was ended
between its rows and its commit is written again over its own folder, a
committed one isn't written twice, so every record is in the table once.

Good and set-aside rows are written in one pass.  The figures (rows, span of
processing times) are observed while the rows are written, so a monitor reads
one small row a batch and no data.

Set aside are records that don't fit the feed's schema, and calendar records
whose date can't be read; they keep the file they came from, the reason and
the record.  ``good + set aside`` is the number of input records.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..operators.feeds import TRANSFORMS
from ..session import Profile, fs_list, get_profile
from ..sources import files
from ..sources.schemas import CALENDAR_SCHEMA, PRICES_SCHEMA

SCHEMAS = {"calendar": CALENDAR_SCHEMA, "prices": PRICES_SCHEMA}
RECORD = "__tm_record"
#: Columns of a row that was set aside, beside the feed's own.
ASIDE = ("source_file", "reason", "record")
COMMIT_SCHEMA = (
    "batch_id long, data_source string, good_rows long, set_aside_rows long, "
    "first_processed timestamp, last_processed timestamp, committed_at timestamp"
)


def _schema(feed: str) -> T.StructType:
    if feed not in SCHEMAS:
        raise ValueError(f"feed {feed} has no record schema; calendar or prices")
    return SCHEMAS[feed]


def checked_stream(spark: SparkSession, feed: str, path: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed's raw stream with each record's file and, where it doesn't fit the schema, the record as text."""
    schema = _schema(feed)
    if fmt != "parquet":  # the readers put a record that doesn't fit into this column
        schema = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    raw = files.open_stream(spark, path, schema, fmt, max_files_per_trigger, **({} if fmt == "parquet" else {"columnNameOfCorruptRecord": RECORD, "mode": "PERMISSIVE"}))
    if fmt == "parquet":
        raw = raw.withColumn(RECORD, F.lit(None).cast("string"))
    return raw.withColumn("source_file", F.col("_metadata.file_path"))


def _reason(feed: str) -> Column:
    reason = F.when(F.col(RECORD).isNotNull(), F.lit("record doesn't fit the schema"))
    if feed == "calendar":
        reason = reason.when((F.trim("date") != "") & tc.parse_date("date").isNull(), F.lit("date can't be read"))
    return reason


def judged(raw: DataFrame, feed: str) -> DataFrame:
    """The feed's columns, then ``source_file``, ``reason`` (NULL for a good row) and ``record`` (NULL too)."""
    own = [F.col(f.name) for f in _schema(feed).fields]
    with_reason = raw.withColumn("reason", _reason(feed))
    record = F.when(F.col("reason").isNotNull(), F.coalesce(RECORD, F.to_json(F.struct(*own))))
    return TRANSFORMS[feed](with_reason.withColumn("record", record), keep=ASIDE)


def batch_writer(path: str, feed: str):
    """The ``foreachBatch`` function of a feed table at ``path``."""
    rows_at, commits_at = os.path.join(path, "rows"), os.path.join(path, "commits")

    def write(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        if is_committed(spark, path, batch_id):
            return
        seen = Observation()
        bad, at = F.col("set_aside"), F.col("processed_timestamp")
        rows = judged(raw, feed).withColumn("set_aside", F.col("reason").isNotNull())
        rows = rows.observe(
            seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("aside"),
            F.min(F.when(~bad, at)).alias("first"), F.max(F.when(~bad, at)).alias("last"),
        )
        rows.write.mode("overwrite").partitionBy("set_aside").parquet(os.path.join(rows_at, f"batch_id={batch_id}"))
        got = seen.get
        figures = spark.range(1).select(
            F.lit(feed).alias("data_source"), F.lit(got.get("good") or 0).cast("long").alias("good_rows"), F.lit(got.get("aside") or 0).cast("long").alias("set_aside_rows"),
            F.lit(got.get("first")).cast("timestamp").alias("first_processed"), F.lit(got.get("last")).cast("timestamp").alias("last_processed"),
            F.current_timestamp().alias("committed_at"),
        )
        figures.coalesce(1).write.mode("overwrite").parquet(os.path.join(commits_at, f"batch_id={batch_id}"))

    return write


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    """A commit is one file that its task moves into place, or nothing."""
    return any(n.startswith("part-") for n in fs_list(spark, os.path.join(path, "commits", f"batch_id={batch_id}")))


def start_batches(spark: SparkSession, feed: str, input_path: str, path: str, checkpoint: str, profile: Profile | str = "development",
                  fmt: str = "csv", available_now: bool = False):
    """Start a feed into the batch table at ``path``; returns the query."""
    prof = profile if isinstance(profile, Profile) else get_profile(profile)
    trigger = {"availableNow": True} if available_now else {"processingTime": prof.trigger_interval}
    raw = checked_stream(spark, feed, input_path, fmt, prof.max_files_per_trigger)
    return raw.writeStream.foreachBatch(batch_writer(path, feed)).option("checkpointLocation", checkpoint).queryName(f"{feed}_batches").trigger(**trigger).start()


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch; none where nothing was written yet."""
    at = os.path.join(path, "commits")
    return spark.read.schema(COMMIT_SCHEMA).parquet(at) if fs_list(spark, at) else spark.createDataFrame([], COMMIT_SCHEMA)


def _stored(spark: SparkSession, path: str, feed: str, aside: bool) -> DataFrame:
    at = os.path.join(path, "rows")
    empty = spark.createDataFrame([], _schema(feed)).withColumns({RECORD: F.lit(None).cast("string"), "source_file": F.lit(None).cast("string")})
    shape = judged(empty, feed).withColumns({"batch_id": F.lit(0).cast("long"), "set_aside": F.lit(False)})
    rows = spark.read.schema(shape.schema).parquet(at) if fs_list(spark, at) else shape
    return rows.where(F.col("set_aside") == aside).join(commits(spark, path).select("batch_id"), "batch_id", "left_semi")


def read_rows(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """The good rows of all committed batches."""
    return _stored(spark, path, feed, False).drop("batch_id", "set_aside", *ASIDE)


def read_set_aside(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """``batch_id, source_file, reason, record`` of all records that were set aside."""
    return _stored(spark, path, feed, True).select("batch_id", *ASIDE)


def monitor(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, rows set aside and the span of processing times of each source, from the commits alone."""
    every = None
    for path in paths.values():
        one = commits(spark, path)
        every = one if every is None else every.unionByName(one)
    return every.groupBy("data_source").agg(
        F.sum("good_rows").alias("record_count"), F.sum("set_aside_rows").alias("set_aside"),
        F.max("last_processed").alias("last_processed"), F.min("first_processed").alias("first_processed"),
    )
