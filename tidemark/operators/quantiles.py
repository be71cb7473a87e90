"""Exact quantiles in fixed memory.

An exact percentile aggregate holds every distinct value in one buffer.  Here
each wanted rank has a bracket of values that narrows: a sketch of the bracket
proposes a closer one, a counting pass says on which side of it the rank lies,
and the last bracket, of at most ``limit`` values or one value, is read off.
Each pass is one aggregation with partial sums and one row of result; all
columns and ranks share it.  The sketch only proposes: the counts decide, so
the result doesn't depend on its error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import nan_to_null

PROBS = (0.25, 0.5, 0.75)


@dataclass
class _Bracket:
    """The value of ``rank`` lies in ``low..high``; ``below`` values are smaller than ``low``, ``size`` inside."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    size: int
    accuracy: int = 10_000

    def inside(self, x: Column) -> Column:
        return F.when((x >= F.lit(self.low)) & (x <= F.lit(self.high)), x)

    def settled(self, limit: int) -> bool:
        return self.low == self.high or self.size <= limit


def _value(column: str) -> Column:
    return nan_to_null(F.col(f"`{column}`").cast("double"))


def _narrowed(df: DataFrame, found: list[_Bracket]) -> None:
    cuts = []
    for i, b in enumerate(found):
        at, margin = (b.rank - b.below + 0.5) / b.size, 2 / b.accuracy
        share = [max(at - margin, 0.0), min(at + margin, 1.0)]
        cuts.append(F.percentile_approx(b.inside(_value(b.column)), share, b.accuracy).alias(f"q{i}"))
    proposed = df.agg(*cuts).first()
    counts = []
    for i, b in enumerate(found):
        x, (low, high) = _value(b.column), map(F.lit, proposed[i])
        counts += [F.count_if(x < low), F.count_if(x <= low), F.count_if(x < high), F.count_if(x <= high)]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for i, b in enumerate(found):
        (low, high), (l0, l1, h0, h1), end = proposed[i], row[4 * i : 4 * i + 4], b.below + b.size
        if l0 <= b.rank < l1:
            new = (low, low, l0, l1)
        elif h0 <= b.rank < h1:
            new = (high, high, h0, h1)
        elif b.rank < l0:
            new = (b.low, low, b.below, l1)
        elif b.rank >= h1:
            new = (high, b.high, h0, end)
        else:
            new = (low, high, l0, h1)
        if new[3] - new[2] >= b.size:
            b.accuracy *= 10  # nothing was gained: look closer
        b.low, b.high, b.below, b.size = new[0], new[1], new[2], new[3] - new[2]


def exact_quantiles(df: DataFrame, columns: list[str], probs=PROBS, limit: int = 100_000) -> DataFrame:
    """``column, prob, value`` for each column and probability, interpolated between neighbours.

    NULL and NaN count as missing; a column without a value has NULL.
    """
    spark = df.sparkSession
    limits = df.agg(*[f(_value(c)) for c in columns for f in (F.count, F.min, F.max)]).first() if columns else []
    brackets: dict[tuple[str, int], _Bracket] = {}
    wanted = []
    for i, c in enumerate(columns):
        n, low, high = limits[3 * i : 3 * i + 3]
        for p in probs:
            at = p * (n - 1)
            ranks = (math.floor(at), math.ceil(at)) if n else ()
            wanted.append((c, float(p), at, ranks))
            for r in ranks:
                brackets.setdefault((c, r), _Bracket(c, r, low, high, 0, n))
    while found := [b for b in brackets.values() if not b.settled(limit)]:
        _narrowed(df, found)
    values = {k: b.low for k, b in brackets.items() if b.low == b.high}
    rest = [(k, b) for k, b in brackets.items() if b.low != b.high]
    if rest:
        spans: dict[tuple, str] = {}
        for _, b in rest:  # ranks of one bracket read one list
            spans.setdefault((b.column, b.low, b.high), f"v{len(spans)}")
        lists = {}
        for _, b in rest:
            lists[spans[b.column, b.low, b.high]] = F.sort_array(F.collect_list(b.inside(_value(b.column))))
        row = df.agg(*[v.alias(k) for k, v in lists.items()]).select(
            *[F.get(spans[b.column, b.low, b.high], F.lit(b.rank - b.below)).alias(f"r{i}") for i, (_, b) in enumerate(rest)]).first()
        values |= {k: row[i] for i, (k, _) in enumerate(rest)}
    rows = []
    for c, p, at, ranks in wanted:
        value = None
        if ranks:
            a, b = values[c, ranks[0]], values[c, ranks[1]]
            value = a if a == b else a + (b - a) * (at - ranks[0])
        rows.append((c, p, value))
    return spark.createDataFrame(rows, "column string, prob double, value double")
