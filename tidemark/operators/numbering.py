"""Global row numbers and category indexes without one task or the driver.

``Window.orderBy`` alone sends all rows to one task, and an indexer keeps all
labels on the driver.  Here rows are range-partitioned by their order, written
once (so that both uses see the same ranges), numbered inside each partition,
and shifted by the sizes of the partitions before: one row a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

PART = "__tm_part"


def numbered(df: DataFrame, by: list[Column | str], name: str = "n", start: int = 0, partitions: int | None = None) -> DataFrame:
    """``df`` with its row number (from ``start``) in the order of ``by``.

    Rows that tie in ``by`` go to one partition and are numbered in any order:
    add columns that tell rows apart.  NULL orders as in Spark (first, or last
    in a descending order).  An empty table stays empty.
    """
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = scratch_dir(spark, "numbered")
    df.repartitionByRange(n, *by).withColumn(PART, F.spark_partition_id()).write.mode("overwrite").parquet(path)
    placed = spark.read.parquet(path)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # over at most ``n`` rows
    sizes = placed.groupBy(PART).count().select(PART, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__tm_before"))
    inside = F.row_number().over(Window.partitionBy(PART).orderBy(*by)) - 1
    return placed.join(F.broadcast(sizes), PART).withColumn(name, (F.col("__tm_before") + inside + start).cast("long")).drop(PART, "__tm_before")


def category_dictionary(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """``label, rows, index``: most frequent label first, equal ones in the order of their text; no NULL.

    The index is that of the frequency-ordered string indexer, for any number of labels.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return numbered(counts, [F.desc("rows"), F.asc("label")], "index", partitions=partitions)


def with_category_index(df: DataFrame, column: str, dictionary: DataFrame, name: str | None = None) -> DataFrame:
    """``df`` with the label's index; a NULL or unknown label has the number of labels, one index beyond the last.

    The dictionary has a label once, so its join adds no row, and the runtime splits a label that many rows have.
    """
    name = name or f"{column}_idx"
    unknown = dictionary.agg(F.count(F.lit(1)).cast("double")).first()[0]
    known = dictionary.select(F.col("label").alias("__tm_label"), F.col("index").cast("double").alias("__tm_index"))
    cols = [c for c in df.columns if c != name]
    both = df.select(*cols).join(known, F.col(column).cast("string") == F.col("__tm_label"), "left")
    return both.select(*cols, F.coalesce("__tm_index", F.lit(unknown)).alias(name))
