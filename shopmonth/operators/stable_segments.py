"""K-means in whole numbers: segments that depend on rows and seed, never on partitions.

Features are taken in whole units, their moments are summed exactly, and standardised
values are rounded to 1 / ``SCALE`` deviations. From there on all sums are sums of whole
numbers, which come out the same in any order, so a second run on repartitioned or
re-landed rows gives the same centres, labels and costs.

Seeds are drawn by squared distance with a race of exponential draws, each a hash of
seed, round and key: the winner is a minimum over all rows, one aggregate a round. The
first k seeds serve a run with k centres, so the runs for all k share the draws and every
round of Lloyd's algorithm: each task sums its rows for all runs at once, and a round
shuffles a few numbers for each centre and task.

Defined results: nulls count as 0; a constant column is 0 everywhere; values beyond 2^27
units are cut there (1,342 deviations); nearest centres of equal distance, the lower id;
a centre without rows stays; with fewer different rows than centres there are fewer.
An empty table has no centres.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import FEATURE_COLUMNS

SCALE = 100_000
LARGEST = 1 << 27
ROUNDS = 20
UNITS = {"total_spent": 100}  # whole units in one; columns that are not named hold whole numbers


@dataclass(frozen=True)
class Scaling:
    """Mean and sample deviation of each column, in whole units."""

    columns: tuple[str, ...]
    units: tuple[int, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def vector(self):
        """The rounded standardised values, as an array column."""
        return F.array(*[_rounded(_in_units(c, u), m, d) for c, u, m, d in zip(self.columns, self.units, self.means, self.deviations)])


def _in_units(column: str, unit: int):
    return F.floor(F.coalesce(F.col(column).cast("double"), F.lit(0.0)) * F.lit(float(unit)) + F.lit(0.5)).cast("long")


def _rounded(value, mean: float, deviation: float):
    if not deviation:
        return F.lit(0).cast("long")
    scaled = (value.cast("double") - F.lit(mean)) / F.lit(deviation) * F.lit(float(SCALE))
    return F.least(F.greatest(F.floor(scaled + F.lit(0.5)), F.lit(-LARGEST)), F.lit(LARGEST)).cast("long")


def fit_scaling(features: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, units: Mapping[str, int] = UNITS) -> Scaling:
    """Moments from exact sums, in one job."""
    factors = [units.get(c, 1) for c in columns]
    exact = [_in_units(c, u).cast("decimal(19,0)") for c, u in zip(columns, factors)]
    row = features.agg(F.count(F.lit(1)), *[F.sum(x) for x in exact],
                       *[F.sum((x * x).cast("decimal(38,0)")) for x in exact]).first()
    n, size = row[0], len(factors)
    sums, squares = ([int(v or 0) for v in row[1 + k * size:1 + (k + 1) * size]] for k in range(2))
    means = [float(s) / n if n else 0.0 for s in sums]
    spread = [math.sqrt(float(n * q - s * s) / float(n * (n - 1))) if n > 1 else 0.0 for s, q in zip(sums, squares)]
    return Scaling(tuple(columns), tuple(factors), tuple(means), tuple(spread))


def points(features: DataFrame, scaling: Scaling, key: str = "user_id") -> DataFrame:
    """``key, z``: hand in and store as a table, since every round reads it."""
    return features.select(F.col(key).alias("key"), scaling.vector().alias("z"))


def _hash(seed: int, number: int):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(number)), F.coalesce(F.col("key").cast("string"), F.lit(""))))


def _squared(centre: Sequence[int]):
    return sum(((F.col("z")[k] - F.lit(c)) * (F.col("z")[k] - F.lit(c)) for k, c in enumerate(centre)), F.lit(0).cast("long"))


def draw_seeds(rows: DataFrame, k: int, seed: int = 42) -> list[tuple[int, ...]]:
    """Up to ``k`` centres: the first by hash alone, the next ones by squared distance to those before."""
    first = rows.agg(F.min_by("z", F.struct(_hash(seed, 0), "key", "z"))).first()[0]
    seeds = [tuple(first)] if first is not None else []
    while seeds and len(seeds) < k:
        near = F.least(*map(_squared, seeds)) if len(seeds) > 1 else _squared(seeds[0])
        luck = (F.conv(F.substring(_hash(seed, len(seeds)), 1, 15), 16, 10).cast("long") + F.lit(1)).cast("double") / F.lit(float(1 << 60))
        race = F.struct((-F.log(luck) / F.col("near").cast("double")).alias("time"), "key", "z")
        found = rows.withColumn("near", near).where("near > 0").agg(F.min_by("z", race)).first()[0]
        if found is None:
            break
        seeds.append(tuple(found))
    return seeds


@dataclass(frozen=True)
class Run:
    """Centres of one k-means run and the sum of squared distances to them, in squared units."""

    centres: tuple[tuple[int, ...], ...]
    cost: int


def lloyd(rows: DataFrame, starts: Mapping[int, Sequence[Sequence[int]]], rounds: int = ROUNDS) -> dict[int, Run]:
    """All runs at once: every round one job, until no centre moves or ``rounds`` are over; costs are those of the last centres."""
    now = {run: [tuple(c) for c in centres] for run, centres in starts.items() if centres}
    for number in range(rounds + 1):
        sums = _sums(rows, now) if now else {}
        if number == rounds:
            break
        moved = {run: [tuple(math.floor(float(s) / float(sums[run, k][0]) + 0.5) for s in sums[run, k][1]) if (run, k) in sums else centre
                       for k, centre in enumerate(centres)] for run, centres in now.items()}
        if moved == now:
            break
        now = moved
    return {run: Run(tuple(centres), sum(sums[run, k][2] for k in range(len(centres)) if (run, k) in sums)) for run, centres in now.items()}


def _sums(rows: DataFrame, runs: Mapping[int, list[tuple[int, ...]]]) -> dict[tuple[int, int], tuple[int, list[int], int]]:
    """Rows, sum of each column and sum of squared distances of every centre of every run."""
    centres = {run: np.array(c, dtype=np.int64) for run, c in runs.items()}
    width = len(next(iter(runs.values()))[0])
    names = ["run", "centre", "n", "high", "low", *[f"s{k}" for k in range(width)]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            out = []
            for run, places in centres.items():
                distances = np.stack([((z - c) ** 2).sum(1) for c in places])
                nearest = distances.argmin(0)
                d = distances[nearest, np.arange(len(z))]
                for k in np.unique(nearest).tolist():
                    mine = nearest == k
                    # A sum of distances may need more than 64 bits, so halves are summed.
                    out.append([run, k, int(mine.sum()), int((d[mine] >> 32).sum()), int((d[mine] & 0xFFFFFFFF).sum()), *z[mine].sum(0).tolist()])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    partial = rows.select("z").mapInArrow(add, ", ".join(f"{n} long" for n in names))
    total = partial.groupBy("run", "centre").agg(*[F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names[2:]])
    return {(r.run, r.centre): (int(r.n), [int(r[f"s{k}"]) for k in range(width)], (int(r.high) << 32) + int(r.low))
            for r in total.collect()}  # one row for each centre


def elbow(rows: DataFrame, max_k: int = 10, seed: int = 42, rounds: int = ROUNDS) -> DataFrame:
    """``k, inertia`` for k = 2 … ``max_k``, in squared deviations, from one set of rounds for all k."""
    seeds = draw_seeds(rows, max_k, seed)
    runs = lloyd(rows, {k: seeds[:k] for k in range(2, max_k + 1)}, rounds)
    return rows.sparkSession.createDataFrame([(k, run.cost / SCALE ** 2) for k, run in sorted(runs.items())], "k int, inertia double")


@dataclass(frozen=True)
class StableSegments:
    """A fitted model: scoring is one column expression, without any data beside the row."""

    scaling: Scaling
    centres: tuple[tuple[int, ...], ...]

    def cluster(self):
        """Id of the nearest centre, from the feature columns."""
        z, none = self.scaling.vector(), F.lit(0).cast("long")
        distances = F.array(*[sum(((z[k] - F.lit(v)) * (z[k] - F.lit(v)) for k, v in enumerate(c)), none) for c in self.centres])
        return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")

    def assign(self, features: DataFrame, key: str = "user_id") -> DataFrame:
        return features.select(key, self.cluster().alias("cluster"))


def fit_stable(features: DataFrame, stored, k: int = 4, seed: int = 42, columns: Sequence[str] = FEATURE_COLUMNS,
               units: Mapping[str, int] = UNITS, order_by: str = "total_spent", key: str = "user_id") -> StableSegments:
    """Scaling and centres, numbered by the rising centre of ``order_by``; ``stored`` writes a frame and reads it back."""
    scaling = fit_scaling(features, columns, units)
    rows = stored(points(features, scaling, key))
    run = lloyd(rows, {k: draw_seeds(rows, k, seed)}).get(k)
    if run is None:
        raise ValueError("no rows to fit on")
    place = list(columns).index(order_by)
    return StableSegments(scaling, tuple(sorted(run.centres, key=lambda c: (c[place], c))))
