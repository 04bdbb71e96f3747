"""Bounded first-in-first-out dedup: an id is a duplicate if it is among its symbol's last ``window`` accepted ids."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import symbol_key
from .ordered import stepwise


class Bucket:
    """Accepted ids of one symbol, oldest first. A rejected id keeps its place."""

    def __init__(self, window: int, ids: Iterable[str] = ()):
        self.window = window
        self.ids: OrderedDict[str, None] = OrderedDict()
        for x in ids:
            self.accept(x)

    def accept(self, trade_id: str) -> bool:
        if trade_id in self.ids:
            return False
        self.ids[trade_id] = None
        if len(self.ids) > self.window:
            self.ids.popitem(last=False)
        return True


def fifo_dedup(ticks: DataFrame, window: int, order: str = "arrival") -> DataFrame:
    """Accepted ticks, in exact arrival semantics; symbols are told apart in upper case. A symbol's ticks are one task's: what
    is accepted depends on all that was accepted before."""
    keyed = ticks.withColumn("__key", symbol_key(F.col("inst_id")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
    return stepwise(keyed, "__key", [order], kinds, lambda: Bucket(window), lambda s, rows: rows[[s.accept(x) for x in rows["trade_id"].tolist()]]).drop("__key")


def first_seen(ticks: DataFrame, order: str = "arrival") -> DataFrame:
    """The same where no symbol has more distinct ids than the window: an aggregate, without sorting a symbol's rows."""
    rest = [c for c in ticks.columns]
    return ticks.groupBy(symbol_key(F.col("inst_id")).alias("__key"), F.col("trade_id").alias("__id")).agg(F.min_by(F.struct(*rest), order).alias("x")).select("x.*")


def windowed(ticks: DataFrame, window: int, order: str = "arrival") -> DataFrame:
    """fifo_dedup, by the aggregate where it gives the same: no symbol has more distinct ids than the window, counted here."""
    ids = ticks.select(symbol_key(F.col("inst_id")).alias("__key"), "trade_id").distinct().groupBy("__key").count()
    return fifo_dedup(ticks, window, order) if ids.filter(F.col("count") > window).take(1) else first_seen(ticks, order)
