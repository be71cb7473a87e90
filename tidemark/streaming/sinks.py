"""Stream sinks: checkpointed table/file append, console and in-memory."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def table_format(spark: SparkSession, preferred: str = "delta") -> str:
    """``delta`` when its data source is on the classpath, else ``parquet``.

    Resolving a reader for a path that does not exist says so
    (PATH_NOT_FOUND) where the format is there, and DATA_SOURCE_NOT_FOUND
    where it isn't; any other error is raised.
    """
    try:
        spark.read.format(preferred).load("/__tidemark_probe_missing__")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "DELTA_TABLE_NOT_FOUND" not in str(e) and "DATA_SOURCE_NOT_FOUND" not in str(e):
            raise
        return preferred if "DATA_SOURCE_NOT_FOUND" not in str(e) else "parquet"
    except Exception as e:  # noqa: BLE001  Spark wraps a missing class in its own runtime error
        if "DATA_SOURCE_NOT_FOUND" not in str(e):
            raise
        return "parquet"
    return preferred


def append_to_table(
    df: DataFrame,
    output_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> DataStreamWriter:
    """Append-mode file sink with its own checkpoint (exactly-once on restart)."""
    w = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .option("path", output_path)
    )
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w


def start_to_table(df: DataFrame, table_name: str, checkpoint_path: str, trigger: dict | None = None,
                   output_path: str | None = None, fmt: str | None = None, query_name: str | None = None):
    """Append into a named table; starts the query."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
    if fmt:
        w = w.format(fmt)
    if query_name:
        w = w.queryName(query_name)
    if output_path:
        w = w.option("path", output_path)
    if trigger:
        w = w.trigger(**trigger)
    return w.toTable(table_name)


def to_console(df: DataFrame, truncate: bool = False, num_rows: int = 20) -> DataStreamWriter:
    return df.writeStream.outputMode("append").format("console").option("truncate", truncate).option(
        "numRows", num_rows
    )


def to_memory(df: DataFrame, query_name: str) -> DataStreamWriter:
    """In-memory table for interactive SQL (driver memory: small streams only)."""
    return df.writeStream.queryName(query_name).outputMode("append").format("memory")
