"""Series state: features and scores of new rows without the full history, and a feature store that is brought up to date.

``series_tails`` keeps the last buckets of each series, as many as the longest
lag or frame reaches back.  A later batch is featurised over the tails and its own
buckets alone, and ``updated_tails`` moves the state on.

``FeatureStore`` keeps raw rows, rollups and features in time chunks.  A refresh
appends rows, rolls up the chunks that they fall into, finds per series which
chunks lie within reach of a changed one (by row positions, so gaps of any
length count right), and writes just these anew, from their own rows and
the halo rows around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..session import fs_exists, scratch_dir
from .features import LAG_PERIODS, ROLLING_WINDOWS, TIME_COL, features_of_rollup
from .rollup import SERIES_KEYS, rollup_15min

#: Rows that the default lags and frames reach back.
REACH = max([*LAG_PERIODS, *[w - 1 for w in ROLLING_WINDOWS]])
_DAY_US = 86_400_000_000


def _last_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(TIME_COL).desc_nulls_last())
    return df.withColumn("__tm_rank", F.row_number().over(w)).where(F.col("__tm_rank") <= n).drop("__tm_rank")


def _chunk(df: DataFrame, days: int):
    return F.coalesce(F.floor(tc.epoch_micros(TIME_COL, df.schema[TIME_COL].dataType) / F.lit(days * _DAY_US)).cast("long"), F.lit(-1))


def series_tails(rollup: DataFrame, rows: int = REACH, days: int = 28) -> DataFrame:
    """The last ``rows`` buckets of each series, first within time chunks, so that no task ranks a whole series."""
    marked = rollup.withColumn("__tm_chunk", _chunk(rollup, days))
    return _last_rows(_last_rows(marked, [*SERIES_KEYS, "__tm_chunk"], rows).drop("__tm_chunk"), SERIES_KEYS, rows)


def updated_tails(tails: DataFrame, rollup: DataFrame, rows: int = REACH) -> DataFrame:
    """The state after a batch of new buckets (``rollup``)."""
    return series_tails(tails.unionByName(rollup), rows)


def features_from_state(tails: DataFrame, rollup: DataFrame, **kw) -> DataFrame:
    """Features of new buckets over the tails and the buckets alone.

    Equal to those over the full history for buckets later than their series'
    tail.  A bucket that is not later can't be placed and is left out (see ``late_buckets``).
    """
    new = rollup.withColumn("__tm_new", F.lit(True)).join(late_buckets(tails, rollup).withColumn("__tm_late", F.lit(True)), [*SERIES_KEYS, TIME_COL], "left")
    new = new.where(F.col("__tm_late").isNull()).drop("__tm_late")
    both = tails.withColumn("__tm_new", F.lit(False)).unionByName(new)
    return features_of_rollup(both, **kw).where("__tm_new").drop("__tm_new")


def late_buckets(tails: DataFrame, rollup: DataFrame) -> DataFrame:
    """``(item_id, store_id, time)`` of the buckets that are not later than the tail of their series."""
    ends = tails.groupBy(*[F.col(k).alias(f"__tm_{k}") for k in SERIES_KEYS]).agg(F.max(TIME_COL).alias("__tm_end"))
    same = None
    for k in SERIES_KEYS:
        c = F.col(k).eqNullSafe(F.col(f"__tm_{k}"))
        same = c if same is None else same & c
    return rollup.join(ends, same).where(F.col(TIME_COL) <= F.col("__tm_end")).select(*SERIES_KEYS, TIME_COL).distinct()


class FeatureStore:
    """Raw rows, rollups and features under one folder, each partitioned by time chunk."""

    def __init__(self, spark: SparkSession, path: str, days: int = 7, **features_kw):
        self.spark, self.path, self.days, self.kw = spark, path.rstrip("/"), days, features_kw
        self.behind = max([0, *features_kw.get("lags", LAG_PERIODS), *[w - 1 for w in features_kw.get("windows", ROLLING_WINDOWS)]])
        self.ahead = max([0, *features_kw.get("horizons", (1,))])

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _write(self, df: DataFrame, name: str, mode: str) -> None:
        # overwriting replaces only the partitions that ``df`` has rows in
        df.hint("rebalance", "chunk").write.option("partitionOverwriteMode", "dynamic").mode(mode).partitionBy("chunk").parquet(f"{self.path}/{name}")

    def features(self) -> DataFrame:
        return self._read("features").drop("chunk")

    def refresh(self, demand: DataFrame, value: str = "demand_5min") -> list[int]:
        """Add raw rows (in any time order) and bring rollups and features up to date; returns the chunks written anew."""
        at = tc.bucket_start("timestamp", "15 minutes", demand.schema["timestamp"].dataType)
        rows = demand.withColumn(TIME_COL, at)
        batch = scratch_dir(self.spark, "store-batch")
        rows = rows.withColumn("chunk", _chunk(rows, self.days).cast("int")).drop(TIME_COL)
        rows.write.mode("overwrite").partitionBy("chunk").parquet(batch)
        new = self.spark.read.schema(rows.schema).parquet(batch)
        touched = sorted(r.chunk for r in new.select("chunk").distinct().collect())  # bounded by the time span of the batch
        if not touched:
            return []
        self._write(new, "raw", "append")
        raw = self._read("raw").where(F.col("chunk").isin(touched))
        self._write(rollup_15min(raw.drop("chunk"), value).withColumn("chunk", self._chunk_of(raw)), "rollup", "overwrite")
        whole = self._read("rollup")
        places = self._places(whole)
        hit = F.col("chunk").isin(touched)
        up = Window.partitionBy(*SERIES_KEYS).orderBy("chunk")  # one row a series and chunk
        down = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        changed = places.withColumn("from_", F.max(F.when(hit, F.col("end"))).over(up)).withColumn("to_", F.min(F.when(hit, F.col("start"))).over(down))
        stale = changed.where(hit | (F.col("start") < F.col("from_") + self.behind) | (F.col("to_") < F.col("end") + self.ahead))
        chunks = sorted(r.chunk for r in stale.select("chunk").distinct().collect())
        redo = F.col("chunk").isin(chunks)
        after = F.min(F.when(redo, F.col("start"))).over(down)  # the next chunk to be redone needs rows behind it
        before = F.max(F.when(redo, F.col("end"))).over(up)
        needed = places.withColumn("next_", after).withColumn("last_", before).where(
            redo | (F.col("next_") < F.col("end") + self.behind) | (F.col("start") < F.col("last_") + self.ahead)).select(*[F.col(k).alias(f"n_{k}") for k in SERIES_KEYS], F.col("chunk").alias("n_chunk"))
        same = F.col("chunk") == F.col("n_chunk")
        for k in SERIES_KEYS:
            same = same & F.col(k).eqNullSafe(F.col(f"n_{k}"))
        feats = features_of_rollup(whole.join(needed, same, "left_semi"), **self.kw)
        self._write(feats.where(redo), "features", "overwrite")
        return chunks

    def _chunk_of(self, df: DataFrame):
        return F.coalesce(F.floor(tc.epoch_micros(TIME_COL, df.schema["timestamp"].dataType) / F.lit(self.days * _DAY_US)).cast("long"), F.lit(-1))

    def _places(self, rollup: DataFrame) -> DataFrame:
        """Row positions ``[start, end)`` of every (series, chunk) in its series."""
        w = Window.partitionBy(*SERIES_KEYS).orderBy("chunk")
        per = rollup.groupBy(*SERIES_KEYS, "chunk").agg(F.count("*").alias("n"))
        return per.withColumn("end", F.sum("n").over(w)).withColumn("start", F.col("end") - F.col("n"))

    def exists(self) -> bool:
        return fs_exists(self.spark, f"{self.path}/features")
