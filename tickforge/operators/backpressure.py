"""A bounded queue's behaviour, replayed over arrivals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LIMITS
from .ordered import carried, stepwise


def _ranked(ticks: DataFrame, capacity: int, order: str, last: bool) -> DataFrame:
    """Ticks of which fewer than capacity of their symbol are later (or earlier): counted by ranges, so that a symbol's ticks
    are many tasks'."""
    side = {"after" if last else "before": {"__n": ("sum", F.lit(1).cast("long"))}}
    return carried(ticks, ["inst_id"], order, **side).filter(F.coalesce("__n", F.lit(0)) < capacity).drop("__n")


def drop_oldest(ticks: DataFrame, capacity: int = LIMITS.queue_capacity, order: str = "arrival") -> DataFrame:
    """What an undrained queue of each symbol holds when the oldest make room: the last by arrival."""
    return _ranked(ticks, capacity, order, True)


def drop_newest(ticks: DataFrame, capacity: int = LIMITS.queue_capacity, order: str = "arrival") -> DataFrame:
    return _ranked(ticks, capacity, order, False)


def drop_counts(ticks: DataFrame, capacity: int = LIMITS.queue_capacity) -> DataFrame:
    n = ticks.groupBy("inst_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("inst_id", "n", F.greatest(F.col("n") - capacity, F.lit(0)).cast("long").alias("dropped"))


def throttled(events: DataFrame, key: str, time: str, order: list[str], every: int = LIMITS.drop_log_ms) -> DataFrame:
    """Greedy: an event is logged if none was, or the last logged is at least ``every`` back. events' key, time and
    order columns (time first), and n: how many events the log line stands for (those since the last, itself included).
    Each step goes from one logged event to the next. A key's events are one task's: the next depends on the last."""
    if order[0] != time:
        raise ValueError("events must be ordered by their time")
    slim = events.select(*dict.fromkeys([key, time, *order]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)

    def step(state: dict, rows: pd.DataFrame) -> pd.DataFrame:
        t, at, found, counts = rows[time].to_numpy(), 0, [], []
        while at < len(t):
            k = at if state["last"] is None else max(at, int(np.searchsorted(t, state["last"] + every)))
            if k >= len(t):
                break
            found.append(k), counts.append(state["n"] + k - at + 1)
            state["last"], state["n"], at = t[k], 0, k + 1
        state["n"] += len(t) - at
        return rows.iloc[found].assign(n=counts).astype({"n": "int64"})

    return stepwise(slim, key, order, f"{kinds}, n long", lambda: {"last": None, "n": 0}, step)


def lag_logs(polls: DataFrame, key: str = "reader", every_ms: int = LIMITS.lag_log_ms) -> DataFrame:
    """polls(key, ts, n_read): when a reader that waits says so: ``every_ms`` after its first empty poll, then not before
    every_ms after it last did; a poll that reads something begins anew. key, ts and waited_ms."""
    slim = polls.select(key, "ts", "n_read")
    kinds = f"`{key}` {slim.schema[key].dataType.simpleString()}, ts long, waited_ms long"

    def step(state: dict, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for ts, n in zip(rows["ts"].tolist(), rows["n_read"].tolist(), strict=True):
            if n:
                state["since"] = state["said"] = None
            elif state["since"] is None:
                state["since"] = ts
            elif ts - state["since"] >= every_ms and (state["said"] is None or ts - state["said"] >= every_ms):
                state["said"] = ts
                out.append((ts, ts - state["since"]))
        found = pd.DataFrame(out, columns=["ts", "waited_ms"], dtype="int64")
        found.insert(0, key, rows[key].iloc[0])
        return found

    return stepwise(slim, key, ["ts"], kinds, lambda: {"since": None, "said": None}, step)


def escalated(df: DataFrame, drops: int = LIMITS.drops_to_error, saturated_ms: int = LIMITS.saturated_to_error_ms) -> DataFrame:
    """df(dropped_total, saturated_ms) with level."""
    return df.withColumn("level", F.when((F.col("dropped_total") >= drops) | (F.col("saturated_ms") >= saturated_ms), "ERROR").otherwise("WARNING"))


def saturation_episodes(puts: DataFrame, key: str = "inst_id", order: str = "arrival", time: str = "ts") -> DataFrame:
    """puts(put_ok): an episode begins with the first overflow after a success and ends with the next success."""
    rows = carried(puts.select(key, order, time, "put_ok"), [key], order, upto={"g": ("sum", F.col("put_ok").cast("long"))}, after={"e": ("first", F.when(F.col("put_ok"), F.col(time)))})
    return rows.filter(~F.col("put_ok")).groupBy(key, "g").agg(F.min(order).alias("first_arrival"), F.count(F.lit(1)).alias("drops"), (F.coalesce(F.max("e"), F.max(time)) - F.min(time)).alias("duration_ms")).drop("g")
