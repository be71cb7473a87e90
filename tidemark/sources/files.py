"""Batch and streaming readers for feed drops (CSV with header, JSON, Parquet).

Calendar and price feeds have declared schemas.  Sales drops don't: their day
columns differ from drop to drop, so ``read_sales`` and ``open_sales_stream``
find the columns in the data and lose none:

* CSV: the schema is the header, all columns in its order; files with different
  headers are read apart and united by name (batch), or refused (stream).
* JSON: each record is read as a string map, so a column that only one record
  has is kept, also when it first appears in a late file of a stream.
* Parquet: the merged schema of all footers.

CSV readers check every file's header against the schema (``enforceSchema``
off): a column out of place fails loudly instead of shifting cells.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SALES_KEYS, check_sales_columns, day_columns, sales_schema

FORMATS = ("csv", "json", "parquet")
CELLS = "cells"  # map of day column -> cell, the shape of JSON sales


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported feed format {fmt!r}; one of {', '.join(FORMATS)} is needed")


def _load(reader, path, fmt: str):
    if fmt == "csv":
        return reader.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    return reader.json(path) if fmt == "json" else reader.parquet(path)


def read_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Batch read of a feed with its declared schema (no inference pass)."""
    _check(fmt)
    return _load(spark.read.schema(schema), path, fmt)


def open_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """File stream with a fixed schema; ``max_files_per_trigger`` throttles a backlog; further reader options."""
    _check(fmt)
    return _load(_throttled(spark, max_files_per_trigger).options(**options).schema(schema), path, fmt)


def _throttled(spark: SparkSession, max_files_per_trigger: int | None):
    r = spark.readStream
    return r.option("maxFilesPerTrigger", int(max_files_per_trigger)) if max_files_per_trigger else r


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Distinct header lines of a CSV sales drop, each with its files.

    A header is the line that names every key column; one pass over the text,
    and as many rows come back as there are files.
    """
    line = F.col("value")
    cells = F.transform(F.split(line, ","), lambda c: F.trim(F.regexp_replace(c, '["\ufeff]', "")))
    named = F.array_size(F.array_intersect(cells, F.array(*[F.lit(k) for k in SALES_KEYS]))) == len(SALES_KEYS)
    rows = spark.read.text(path).select(line, F.col("_metadata.file_path").alias("file")).where(named)
    found: dict[str, list[str]] = {}
    for r in rows.distinct().orderBy("file").collect():
        found.setdefault(r["value"], []).append(r["file"])
    return found


def _columns(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]))]


def _json_cells(df: DataFrame) -> DataFrame:
    """Text lines -> the keys and the map of day cells of each record."""
    record = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    wide = df.where(F.trim("value") != "").select(record.alias("r"))
    cells = F.map_filter("r", lambda k, _: k.startswith("d_"))
    return wide.select(*[F.col("r")[k].alias(k) for k in SALES_KEYS], cells.alias(CELLS))


def _json_days(spark: SparkSession, path: str) -> list[str]:
    keys = _json_cells(spark.read.text(path)).select(F.explode(F.map_keys(CELLS)).alias("d")).distinct()
    return sorted((r["d"] for r in keys.collect()), key=lambda d: (len(d), d))


def with_all_days(df: DataFrame, days: list[str]) -> DataFrame:
    """Every record's cells, with an empty cell for each of ``days`` that it lacks (as in CSV and Parquet)."""
    keys = F.array_union(F.array(*[F.lit(d) for d in days]), F.map_keys(CELLS))
    return df.withColumn(CELLS, F.map_from_arrays(keys, F.transform(keys, lambda k: F.col(CELLS)[k])))


def read_sales(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Batch read of a wide sales drop; every day column of every file."""
    _check(fmt)
    if fmt == "json":
        days = _json_days(spark, path)
        if not days:
            raise ValueError("sales input has no d_* day columns")
        return with_all_days(_json_cells(spark.read.text(path)), days)
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(path)
        check_sales_columns(df.columns)
        return df
    headers = csv_headers(spark, path)
    if not headers:
        raise ValueError(f"sales input lacks key columns: {SALES_KEYS}")
    out = None
    for header, names in headers.items():
        cols = _columns(header)
        part = read_feed(spark, path if len(headers) == 1 else names, sales_schema(cols), fmt)
        part = part.select(*SALES_KEYS, *day_columns(cols))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def open_sales_stream(spark: SparkSession, path: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a wide sales drop, by the columns of the files that are there at the start.

    CSV with more than one header is refused; a later file with another header
    fails the query.  JSON records bring day columns of their own.
    """
    _check(fmt)
    if fmt == "json":
        days = _json_days(spark, path)
        return with_all_days(_json_cells(_throttled(spark, max_files_per_trigger).text(path)), days)
    if fmt == "parquet":
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
        check_sales_columns(schema.names)
        return open_stream(spark, path, schema, fmt, max_files_per_trigger)
    headers = list(csv_headers(spark, path))
    if len(headers) != 1:
        raise ValueError(f"a CSV sales stream needs one header, found {len(headers)}")
    return open_stream(spark, path, sales_schema(_columns(headers[0])), fmt, max_files_per_trigger)
