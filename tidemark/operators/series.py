"""Row-based window features over keyed time series, safe for hot series.

Lags, leads and rolling frames count rows, not time.  A plain
``Window.partitionBy(keys)`` sends a whole series to one task, which breaks
when one series holds a large share of the data.  ``over_series`` instead
partitions by (keys, time chunk) and repairs only the rows near chunk edges:

1. Number the rows of every (series, chunk) and compute all features
   inside the chunk.  Rows at least ``behind`` rows from the chunk start
   and ``ahead`` rows from its end ("interior") are already exact.
2. The first and last ``behind + ahead`` rows of every chunk ("halo") are
   collected; in series order they contain the full neighbourhood of each
   edge row, so recomputing the features over the halo rows alone is exact
   for the edge rows.  The halo is a small fraction of the data and is
   solved the same way with coarser chunks, down to ``levels`` deep; the
   last level is one window per series over its halo rows only, at most
   ``2 * (behind + ahead)`` rows per chunk (about 13k rows for ten years of
   a series with the default 28-day chunk and 49-row reach).
3. Interior rows and repaired edge rows are unioned.  Both branches read
   the same shuffle (Spark reuses the exchange), so the data moves once.

The result equals the single-window result row for row.  This is the one plan
at every size (``plain=True`` asks for the single window instead, to compare
with).  Every window order ends in a full tie-break over the input's other
columns, so rows with equal order keys are numbered alike in all branches.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc

_FAR_PAST_CHUNK = -(1 << 62)


@dataclass(frozen=True)
class SeriesExpr:
    """A window expression with its reach in rows behind and ahead."""

    name: str
    build: Callable[[WindowSpec], Column]
    behind: int = 0
    ahead: int = 0


def lag_expr(value: str, k: int, name: str) -> SeriesExpr:
    return SeriesExpr(name, lambda w: F.lag(F.col(value), k).over(w), behind=k)


def lead_expr(value: str, h: int, name: str) -> SeriesExpr:
    return SeriesExpr(name, lambda w: F.lead(F.col(value), h).over(w), ahead=h)


def rolling_expr(fn: Callable[[Column], Column], value: str, n: int, name: str, cast_to=None) -> SeriesExpr:
    """Aggregate over the current row and the ``n - 1`` rows before it."""

    def build(w: WindowSpec) -> Column:
        out = fn(F.col(value)).over(w.rowsBetween(-n + 1, 0))
        return out.cast(cast_to) if cast_to is not None else out

    return SeriesExpr(name, build, behind=n - 1)


def _chunk_of(df: DataFrame, order: str, width: float) -> Column:
    """Chunk number of each row: ``width`` days for a date/timestamp order
    column (fractions allowed: 0.25 = 6 hours), ``width`` units for a numeric one.
    Monotone in the order column, independent of the session time zone."""
    dtype = df.schema[order].dataType
    c = F.col(order)
    if isinstance(dtype, T.DateType):
        chunk = F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / F.lit(float(width)))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        chunk = F.floor(tc.epoch_micros(c, dtype) / F.lit(float(width) * 86_400_000_000))
    elif isinstance(dtype, T.NumericType):
        chunk = F.floor(c / F.lit(float(width)))
    else:
        raise TypeError(f"order column {order} must be temporal or numeric, not {dtype}")
    return F.coalesce(chunk.cast("long"), F.lit(_FAR_PAST_CHUNK))


def _order_of(df: DataFrame, keys: list[str], order: str, names: list[str]) -> list[str]:
    """The order column, then every other sortable input column as tie-break."""
    rest = [
        f.name for f in df.schema.fields
        if f.name not in (*keys, order, *names) and not f.name.startswith("__tm_")
        and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [order, *rest]


def _direct(df: DataFrame, keys: list[str], by: list[str], exprs: list[SeriesExpr]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumns({e.name: e.build(w) for e in exprs})


def _chunked(df, keys, by, exprs, chunk, levels, fanout) -> DataFrame:
    behind = max(e.behind for e in exprs)
    ahead = max(e.ahead for e in exprs)
    reach = behind + ahead
    names = [e.name for e in exprs]
    cols = [c for c in df.columns if c not in names]
    ck, pos_c, n_c, inner_c = (f"__tm_{s}_{levels}" for s in ("chunk", "pos", "n", "interior"))

    wc = Window.partitionBy(*keys, ck).orderBy(*by)
    whole = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = df.withColumn(ck, _chunk_of(df, by[0], chunk)).withColumns(
        {pos_c: F.row_number().over(wc) - 1, n_c: F.count(F.lit(1)).over(whole)}
        | {e.name: e.build(wc) for e in exprs}
    )
    pos, n = F.col(pos_c), F.col(n_c)
    interior = (pos >= behind) & (pos <= n - 1 - ahead)
    halo = (pos < reach) | (pos >= n - reach)

    good = local.filter(interior).select(*cols, *names)
    edge = local.filter(halo).select(*cols, interior.alias(inner_c))
    if levels > 1:
        fixed = _chunked(edge, keys, by, exprs, chunk * fanout, levels - 1, fanout)
    else:
        fixed = _direct(edge, keys, by, exprs)
    fixed = fixed.filter(~F.col(inner_c)).select(*cols, *names)
    return good.unionByName(fixed)


def over_series(
    df: DataFrame,
    keys: list[str],
    order: str,
    exprs: list[SeriesExpr],
    plain: bool = False,
    chunk: float = 28,
    levels: int = 1,
    fanout: int = 16,
) -> DataFrame:
    """Add every expression in ``exprs`` as a column, computed per series.

    ``chunk`` is the first-level chunk width: days (fractions allowed) for a
    date/timestamp ``order`` column, units for a numeric one.  Pick it so a
    (series, chunk) holds a few thousand rows: 28 days of 15-minute buckets
    is at most 2,688 rows; raw event rows need a fraction of a day.  Rows
    tied in (keys, order) are ordered by their other columns.
    """
    if not exprs:
        return df
    by = _order_of(df, list(keys), order, [e.name for e in exprs])
    if plain or max(max(e.behind, e.ahead) for e in exprs) == 0:
        return _direct(df, list(keys), by, list(exprs))
    return _chunked(df, list(keys), by, list(exprs), chunk, max(1, levels), fanout)


@dataclass(frozen=True)
class SpanExpr:
    """An aggregate over the ``span_us`` microseconds that end with the row (the start excluded)."""

    name: str
    agg: Callable[[], Column]
    span_us: int


def span_expr(fn: Callable[[Column], Column], value: str, span: str | int, name: str, cast_to=None) -> SpanExpr:
    """``fn`` of ``value`` over a span such as ``"3 hours"``."""

    def agg() -> Column:
        return fn(F.col(value))

    return SpanExpr(name, agg if cast_to is None else lambda: agg().cast(cast_to), tc.width_seconds(span) * 1_000_000)


def over_time(df: DataFrame, keys: list[str], time_col: str, exprs: list[SpanExpr], chunk: float = 28) -> DataFrame:
    """Add every expression in ``exprs`` as a column, computed per series over time spans.

    Windows are partitioned by (series, chunk of ``chunk`` days, at least
    twice the longest span), so a hot series is spread over many tasks.  Rows
    of the last span of a chunk are copied to the next, where they only fill
    frames.  Rows of one time are in each other's frames; a row without a
    time has NULL in every expression; sparse and repeated rows are exact.
    """
    if not exprs:
        return df
    reach = max(e.span_us for e in exprs)
    width = max(int(chunk * 86_400_000_000), 2 * reach)
    at, own, ck = "__tm_at", "__tm_own", "__tm_chunk"
    names = [e.name for e in exprs]
    cols = [c for c in df.columns if c not in names]
    base = df.select(*cols)
    chunk_of = lambda c: F.floor(c / F.lit(width)).cast("long")
    timed = base.where(F.col(time_col).isNotNull()).withColumn(at, tc.epoch_micros(time_col, df.schema[time_col].dataType))
    timed = timed.withColumn(own, chunk_of(F.col(at)))
    copies = timed.withColumn(ck, F.explode(F.sequence(own, chunk_of(F.col(at) + F.lit(reach - 1)))))
    w = Window.partitionBy(*keys, ck).orderBy(at)
    out = copies.withColumns({e.name: e.agg().over(w.rangeBetween(-(e.span_us - 1), 0)) for e in exprs})
    out = out.where(F.col(own) == F.col(ck)).select(*cols, *names)
    untimed = base.where(F.col(time_col).isNull()).select(*cols, *[F.lit(None).cast(out.schema[n].dataType).alias(n) for n in names])
    return out.unionByName(untimed)
