"""Quantiles of one numeric column and the outlier fence built on them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import stage, work_folder

QUARTILES = (0.25, 0.75)
FENCE_WIDTH = 1.5
RELATIVE_ERROR = 0.01


def approx_quantiles(df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES,
                     relative_error: float = RELATIVE_ERROR) -> list[float]:
    """Mergeable sketch with a rank error of at most ``relative_error``."""
    return df.approxQuantile(column, list(probabilities), relative_error)


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES,
                    direct_rows: int = 1_000_000, narrowing_error: float = 1e-3) -> list[float]:
    """Exact quantiles with linear interpolation; nulls and NaN are ignored.

    Up to ``direct_rows`` values the built-in aggregate sees them all. Beyond
    that its one merging task would have to hold every distinct value. Both ways
    give the same bits, so the size only decides about the plan. For many rows the
    wanted ranks are bracketed by a sketch, the rows around each bracket are
    counted, and only values inside a bracket are looked at again, with the
    bracket as a filter on the scan. The column is read a few times: hand in a
    stored table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    rows = values.count()
    if rows == 0:
        return [None for _ in probabilities]
    if rows <= direct_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        return list(values.agg(F.percentile("v", wanted)).first()[0])
    positions = [p * (rows - 1) for p in probabilities]
    ranks = [(math.floor(x), min(math.floor(x) + 1, rows - 1)) for x in positions]
    neighbours = _values_at(values, rows, ranks, direct_rows, narrowing_error)
    return [interpolated(low, high, x) for (low, high), x in zip(neighbours, positions)]


def interpolated(low: float, high: float, position: float) -> float:
    """Value at a position between two neighbouring ranks, by the rule of the built-in aggregate."""
    if position == math.floor(position) or low == high:
        return low
    return (math.ceil(position) - position) * low + (position - math.floor(position)) * high


def _values_at(values: DataFrame, rows: int, targets: Sequence[tuple[int, ...]],
               direct_rows: int, error: float) -> list[list[float]]:
    """Values at 0-based ranks; each target is a tuple of neighbouring ranks.

    Rows equal to a bracket end are counted, not carried on, so however many rows
    share one value the open interior is at most about six times ``error`` of the
    rows. Interiors still too large for one task are stored and narrowed again.
    """
    around = [p for ranks in targets for p in (max(0.0, ranks[0] / rows - 2 * error),
                                               min(1.0, ranks[-1] / rows + 2 * error))]
    ends = (values.approxQuantile("v", around, error) if error < 0.25 else
            [end for _ in targets for end in values.agg(F.min("v"), F.max("v")).first()])
    brackets = list(zip(ends[::2], ends[1::2]))
    v = F.col("v")
    counts = list(values.agg(*[F.count_if(condition) for low, high in brackets for condition in (
        v < low, v == low, (v > low) & (v < high), (v == high) & (v > low))]).first())
    found: list[dict[int, float]] = []
    inner: list[tuple[int, ...]] = []
    sizes: list[int] = []
    for (low, high), ranks, start in zip(brackets, targets, range(0, len(counts), 4)):
        below, at_low, inside, at_high = counts[start:start + 4]
        first_inside, first_high = below + at_low, below + at_low + inside
        if ranks[0] < below or ranks[-1] >= first_high + at_high:
            # The sketch was off by more than promised: look again with brackets twice as wide.
            return _values_at(values, rows, targets, direct_rows, 2 * error)
        found.append({r: low if r < first_inside else high for r in ranks if not first_inside <= r < first_high})
        inner.append(tuple(r - first_inside for r in ranks if first_inside <= r < first_high))
        sizes.append(inside)
    small = [i for i, ranks in enumerate(inner) if ranks and sizes[i] <= direct_rows]
    large = [i for i, ranks in enumerate(inner) if ranks and sizes[i] > direct_rows]
    solved: dict[int, list[float]] = {}
    if small:
        columns = [F.when((v > brackets[i][0]) & (v < brackets[i][1]), v).alias(f"b{i}") for i in small]
        picks = [_value_at_rank(f"b{i}", rank, sizes[i]) for i in small for rank in inner[i]]
        row = list(_inside(values, [brackets[i] for i in small]).select(*columns).agg(*picks).first())
        for i in small:
            solved[i], row = row[:len(inner[i])], row[len(inner[i]):]
    if large:
        with work_folder(values.sparkSession, "quantile") as folder:
            stored = stage(_inside(values, [brackets[i] for i in large]), "interior", folder)
            for i in large:
                solved[i] = _values_at(_inside(stored, [brackets[i]]), sizes[i], [inner[i]],
                                       direct_rows, error)[0]
    result = []
    for i, ranks in enumerate(targets):
        rest = iter(solved.get(i, ()))
        result.append([found[i][r] if r in found[i] else next(rest) for r in ranks])
    return result


def _inside(values: DataFrame, brackets: Sequence[tuple[float, float]]) -> DataFrame:
    v = F.col("v")
    return values.where(reduce(or_, [(v > low) & (v < high) for low, high in brackets]))


def _value_at_rank(column: str, rank: int, size: int) -> Column:
    """The value at a 0-based rank among ``size`` non-null values."""
    return F.expr(f"percentile_disc({(rank + 0.5) / size!r}D) WITHIN GROUP (ORDER BY {column})")


def fence(q1: float, q3: float, width: float = FENCE_WIDTH) -> tuple[float, float]:
    """Lower and upper outlier bound from the quartiles."""
    reach = width * (q3 - q1)
    return q1 - reach, q3 + reach


def price_fence(df: DataFrame, column: str = "price", method: str = "approx",
                relative_error: float = RELATIVE_ERROR, head: int | None = None,
                head_order: str | None = None) -> tuple[float, float]:
    """Outlier fence of a frame.

    Two scalars come back to the driver, so that the fence is a literal in the
    plan that uses it and reaches the scan. ``head`` takes the quartiles from the
    first rows only.
    """
    if head is not None:
        df = df.select(*dict.fromkeys([column, *([head_order] if head_order else [])]))
        df = df.orderBy(head_order).limit(head) if head_order else df.limit(head)
    if method == "approx":
        quartiles = approx_quantiles(df, column, QUARTILES, relative_error)
    elif method == "exact":
        quartiles = exact_quantiles(df, column, QUARTILES)
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    if len(quartiles) != 2 or None in quartiles:
        raise ValueError(f"column {column} holds no value to take quartiles of")
    return fence(*quartiles)
