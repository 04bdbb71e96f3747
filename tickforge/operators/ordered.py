"""Total order without a single task, and sequential rules without a group in memory.

Rows are dealt by ranges of a whole-number order. Up to ``ROWS`` rows are one range; more are cut at quantiles into
``SEGMENTS`` segments and these into equal widths, so that a value far off widens only its own segment's ranges. What a row
needs of the ranges before (or behind) its own is an aggregate of them, carried over by a window on one row a range.
Rows without an order come first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS, RANGES, SEGMENTS = 65_536, 4096, 32


@dataclass(frozen=True)
class Ranges:
    """cuts: where the segments begin, the first left out; base, width and parts of each segment's ranges."""

    cuts: list[int] = field(default_factory=list)
    base: list[int] = field(default_factory=lambda: [0])
    width: list[int] = field(default_factory=lambda: [1])
    parts: int = 1

    @property
    def one(self) -> bool:
        return self.parts * len(self.base) == 1

    def put(self, df: DataFrame, order: str) -> DataFrame:
        """df with __range, which is not null."""
        if self.one:
            return df.withColumn("__range", F.lit(0))
        c = F.col(order)

        def segment(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(c < self.cuts[mid], segment(lo, mid)).otherwise(segment(mid + 1, hi))

        at = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("__segment"))
        inside = F.least(F.lit(self.parts - 1), F.greatest(F.lit(0), F.floor((c - at(self.base)) / at(self.width)))).cast("int")
        out = df.withColumn("__segment", segment(0, len(self.base) - 1))
        return out.withColumn("__range", F.when(c.isNull(), -1).otherwise(F.col("__segment") * self.parts + inside)).drop("__segment")


def ranges_of(df: DataFrame, order: str, rows: int = ROWS) -> Ranges:
    """Ranges of df's rows, from one row of its figures."""
    points = [k / SEGMENTS for k in range(1, SEGMENTS)]
    n, lo, hi, cuts = df.agg(F.count(order), F.min(order), F.max(order), F.percentile_approx(order, points, 1000)).first()
    wanted = min(RANGES, -(-n // rows))
    if wanted <= 1:
        return Ranges()
    cuts = sorted({int(x) for x in cuts if lo < x <= hi})
    ends = [int(lo), *cuts, int(hi) + 1]
    parts = -(-wanted // SEGMENTS)
    return Ranges(cuts, ends[:-1], [(b - a - 1) // parts + 1 for a, b in zip(ends[:-1], ends[1:], strict=True)], parts)


def sequenced(df: DataFrame, order: str, base: int = 0, name: str = "seq", like: DataFrame | None = None) -> DataFrame:
    """Gap-free numbers from base + 1 on in the total order of a whole-number column, nulls first; ties go by all other
    columns. like: a table with the same orders that is cheaper to read, for the ranges."""
    rest = [c for c in df.columns if c != order]
    found = ranges_of(df if like is None else like, order)
    inside = F.row_number().over(W.partitionBy("__range").orderBy(order, *rest)).cast("long")
    r = found.put(df, order)
    if found.one:
        return r.select(*df.columns, (F.lit(base) + inside).cast("long").alias(name))
    before = F.sum("__v").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))  # a row a range
    offset = r.groupBy("__range").agg(F.count(F.lit(1)).alias("__v")).select("__range", before.alias("__before"))
    out = r.withColumn("__n", inside).join(F.broadcast(offset), "__range")
    return out.select(*df.columns, (F.lit(base) + F.coalesce("__before", F.lit(0)) + F.col("__n")).cast("long").alias(name))


HOW = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True), "first": lambda c: F.last(c, ignorenulls=True)}  # backwards


def carried(df: DataFrame, keys: list[str], order: str, before: dict[str, tuple[str, Column]] | None = None, upto: dict[str, tuple[str, Column]] | None = None, after: dict[str, tuple[str, Column]] | None = None, ties: tuple[str, ...] = (), found: Ranges | None = None, like: DataFrame | None = None) -> DataFrame:
    """df with, for each name, an aggregate of the key's rows before the row, up to it, or after it in ``order`` (then
    ``ties``). Aggregates: sum, max, min, last (value before that is not null), first (value after that is not null).

    Each key's rows are dealt by ranges of the order, so that a hot key has as many tasks as ranges; one row of each range
    carries the rest."""
    found = found or ranges_of(df if like is None else like, order)
    rows = found.put(df, order)
    # what comes after is what comes before in the other direction: frames that end at the last row are read anew for each
    back = [F.desc(c) for c in (order, *ties)]
    line = {"before": W.partitionBy(*keys, "__range").orderBy(order, *ties), "after": W.partitionBy(*keys, "__range").orderBy(*back)}
    todo = [(kind, name, how, c) for kind, x in (("before", before), ("upto", upto), ("after", after)) for name, (how, c) in (x or {}).items()]
    out = rows.select("*", *[HOW[how](c).over(line["after" if kind == "after" else "before"].rowsBetween(W.unboundedPreceding, -int(kind != "upto"))).alias(f"__in_{name}") for kind, name, how, c in todo])
    if found.one:
        return out.select(*df.columns, *[F.col(f"__in_{name}").alias(name) for _, name, _, _ in todo])
    place = F.struct(order, *ties)
    whole = {"last": lambda c: F.max_by(c, F.when(c.isNotNull(), place)), "first": lambda c: F.min_by(c, F.when(c.isNotNull(), place))}
    per = rows.groupBy(*keys, "__range").agg(*[whole.get(how, HOW.get(how))(c).alias(f"__of_{name}") for _, name, how, c in todo])
    of_key = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))  # a row a range
    side = lambda kind: of_key.orderBy(F.desc("__range") if kind == "after" else "__range").rowsBetween(W.unboundedPreceding, -1)
    slices = per.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"), *[HOW[how](F.col(f"__of_{name}")).over(side(kind)).alias(f"__far_{name}") for kind, name, how, _ in todo])
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = out.join(slices, same)

    def both(name: str, how: str) -> Column:
        near, far = F.col(f"__in_{name}"), F.col(f"__far_{name}")
        if how == "sum":
            return F.when(near.isNotNull() | far.isNotNull(), F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0)))
        return {"max": F.greatest, "min": F.least}.get(how, F.coalesce)(near, far)

    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[both(name, how).alias(name) for _, name, how, _ in todo])


def increasing(df: DataFrame, order: str, seq: str, start: int = 0, like: DataFrame | None = None) -> DataFrame:
    """Rows whose seq is at least start and above that of every earlier row that is at least start."""
    rows = carried(df.filter(F.col(seq) >= start), [], order, before={"__most": ("max", F.col(seq))}, like=like)
    return rows.filter(F.col("__most").isNull() | (F.col(seq) > F.col("__most"))).select(*df.columns)


def stepwise(df: DataFrame, key: str, order: list[str], schema: str, start: Callable[[], object], step: Callable[[object, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Run step(state, rows) over pieces of each key's rows, in order. Rows stream through sorted partitions, so only a
    key's state is held, never its rows; a key is one task's, as its rule asks for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = object(), None
        for pdf in frames:
            k = pdf[key].to_numpy()
            cut = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                if i < j:
                    if k[i] != at:
                        at, state = k[i], start()
                    yield step(state, pdf.iloc[i:j])

    return df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)
