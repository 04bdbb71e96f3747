"""Sinks of a stream, as foreachBatch functions (batch, batch id). A batch that comes again after a failure writes its own
folders anew, so each of its rows counts once."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Writer = Callable[[DataFrame, int], None]
log = logging.getLogger(__name__)


def tee(*writers: Writer) -> Writer:
    """Each writer in turn gets the whole batch; a later one only if those before it did not fail."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for w in writers:
                w(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def to_folder(path: str) -> Writer:
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/part={batch_id}")


def dead_letters(path: str, bad: Callable[[DataFrame], DataFrame]) -> Writer:
    """bad(batch) goes to the dead letters; that they cannot be written is logged and stops nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        try:
            bad(batch).write.mode("overwrite").json(f"{path}/part={batch_id}")
        except Exception:
            log.warning("dead letters of batch %s were not written", batch_id, exc_info=True)

    return write


def observed(*observers: Callable[[DataFrame, int], None]) -> Writer:
    """Observers, the same one once; the failure of one is logged and keeps nothing from the others."""
    once = list(dict.fromkeys(observers))

    def write(batch: DataFrame, batch_id: int) -> None:
        for f in once:
            try:
                f(batch, batch_id)
            except Exception:
                log.warning("an observer failed on batch %s", batch_id, exc_info=True)

    return write


class Counting:
    """A null sink: counts what it is given and keeps nothing; there is nothing to read from it."""

    def __init__(self) -> None:
        self.batches: dict[int, int] = {}

    @property
    def accepted(self) -> int:
        return sum(self.batches.values())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.batches[batch_id] = batch.count()

    def read(self) -> None:
        raise NotImplementedError("a null sink keeps nothing")


class Limited:
    """Passes the first ``most`` rows by ``order`` in all (0: no end) to a writer; ``done`` tells when the stream may stop."""

    def __init__(self, most: int, writer: Writer, order: str = "seq"):
        if most < 0:
            raise ValueError("most must not be below 0")
        self.most, self.writer, self.order, self.batches = most, writer, order, {}

    @property
    def done(self) -> bool:
        return bool(self.most) and sum(self.batches.values()) >= self.most

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        left = self.most - sum(n for k, n in self.batches.items() if k < batch_id)
        part = batch.orderBy(self.order).limit(max(0, left)) if self.most else batch
        self.writer(part, batch_id)
        self.batches[batch_id] = part.count() if self.most else 0


def for_symbols(symbols: Sequence[str], writer: Writer) -> Writer:
    """Only ticks of the symbols, by exact name; none means all."""
    return lambda batch, batch_id: writer(batch.filter(F.col("inst_id").isin(list(symbols))) if symbols else batch, batch_id)
