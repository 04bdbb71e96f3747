"""Ticks under Structured Streaming: exact FIFO dedup in keyed state, sequencing and append in each micro-batch."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.ticks import symbol_key
from ..operators import journal
from ..operators.dedup import Bucket, first_seen
from ..operators.ordered import sequenced
from ..schemas import LIMITS, ticks_of_events
from ..sources.journal import journal_stream, segment_lines


def deduplicated(ticks: DataFrame, window: int) -> DataFrame:
    """ticks (a stream) without duplicates; a micro-batch's rows of a symbol are taken by arrival. What a micro-batch holds is
    bounded by the source (maxFilesPerTrigger, maxBytesPerTrigger), which stands for the queue's capacity."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ticks.schema.fields)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bucket = Bucket(window, state.get[0] if state.exists else ())
        rows = pd.concat(list(frames)).sort_values("arrival")
        keep = [bucket.accept(x) for x in rows["trade_id"]]
        state.update((list(bucket.ids),))
        yield rows[keep].drop(columns="__key", errors="ignore")

    return ticks.withColumn("__key", symbol_key(F.col("inst_id"))).groupBy("__key").applyInPandasWithState(run, kinds, "ids array<string>", "append", GroupStateTimeout.NoTimeout)


def unseen(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The first tick of each id that no batch before this one has put into the journal at path."""
    rows = first_seen(batch)
    if not batch_id:
        return rows
    journal_rows = batch.sparkSession.read.schema("inst_id string, trade_id string, part long").parquet(path).filter(F.col("part") < batch_id)
    held = journal_rows.select(symbol_key(F.col("inst_id")).alias("__key"), F.col("trade_id").alias("__id")).distinct()
    return rows.join(held, symbol_key(F.col("inst_id")).eqNullSafe(F.col("__key")) & F.col("trade_id").eqNullSafe(F.col("__id")), "left_anti")


def append_batch(path: str, once: bool = False):
    """A foreachBatch writer: sequence numbers follow the tip that the batch before left in its own small table; a repeated
    batch replaces its own folders. once: ids that are in the journal already are left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = unseen(batch, path, batch_id) if once else batch
        base = spark.read.parquet(f"{path}-tips/part={batch_id - 1}").first()["seq"] if batch_id else 0
        rows = sequenced(batch, "arrival", base).withColumn("batch", F.lit(batch_id))
        rows.write.mode("overwrite").parquet(f"{path}/part={batch_id}")
        tip = spark.read.schema(rows.schema).parquet(f"{path}/part={batch_id}").agg(F.coalesce(F.max("seq"), F.lit(base)).cast("long").alias("seq"))
        tip.write.mode("overwrite").parquet(f"{path}-tips/part={batch_id}")

    return write


def state_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset and the driver is the one executor, a folder of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"{tempfile.gettempdir()}/tickforge-streams"
    return found.rstrip("/")


def ingest_available(spark: SparkSession, sf_dir: str, window: int | None = LIMITS.dedup_window) -> DataFrame:
    """All events now there, through the stream into a journal in the shared folder, which is returned. window None: an id
    never comes again; what was seen is the journal itself, not keyed state."""
    base = f"{state_dir(spark)}/{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # as a pattern it may be a file or a folder
    ticks = ticks_of_events(events)
    stream = ticks if window is None else deduplicated(ticks, window)
    q = stream.writeStream.foreachBatch(append_batch(f"{base}/journal", window is None)).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/journal")


class Follower:
    """A tail: journal lines of a folder's segments as they come, good records of them in order to a writer, bad lines to the
    dead letters. Segments go by name: the source hands over all that are new, since those it would choose itself are the ones
    written first, and segments that are written side by side or copied have times in any order. They are taken
    files_per_trigger at a time, each such part with its own number for the writer. The cursor is the highest seq passed on,
    kept in a small table of each batch, so a restart goes on behind it and a repeated batch gives the same parts and rows."""

    def __init__(self, spark: SparkSession, folder: str, base: str, writer: Callable[[DataFrame, int], None], start_seq: int = 0, files_per_trigger: int = 16):
        self.spark, self.folder, self.base, self.writer, self.start_seq, self.files = spark, folder, base, writer, start_seq, files_per_trigger

    def _left_by(self, batch_id: int):
        return self.spark.read.parquet(f"{self.base}/cursor/part={batch_id}").first()

    def cursor_before(self, batch_id: int) -> int:
        return self._left_by(batch_id - 1)["last_processed_seq"] if batch_id else self.start_seq - 1

    def parts_before(self, batch_id: int) -> int:
        """The number of the batch's first part; a cursor that names none was left by batches of one part."""
        left = self._left_by(batch_id - 1) if batch_id else ()
        return left["parts"] if "parts" in left else batch_id

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        at, part = self.cursor_before(batch_id), self.parts_before(batch_id)
        names = sorted((r["file"] for r in batch.select("file").distinct().collect()), key=unquote)  # a row a segment
        for k in range(0, max(1, len(names)), self.files):
            some = names[k : k + self.files]
            at, part = self._part(batch if len(names) <= self.files else segment_lines(self.spark, some), some, at, part), part + 1
        cursor = self.spark.range(1).select(F.lit(at).cast("long").alias("last_processed_seq"), F.lit(part).cast("long").alias("parts"))
        cursor.write.mode("overwrite").parquet(f"{self.base}/cursor/part={batch_id}")

    def _part(self, rows: DataFrame, names: list[str], before: int, part: int) -> int:
        """Lines of the segments of these names through to the writer; the cursor behind them."""
        numbered = rows.select("line", "file", F.monotonically_increasing_id().alias("__id"))
        rank = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(names) for x in (name, k)]), F.col("file")) if names else F.lit(0)
        lines = numbered.select("line", (rank.cast("long") * (1 << 56) + F.col("__id")).alias("line_no"), F.lit(True).alias("complete"))
        journal.dead_letters(lines, F.unix_millis(F.current_timestamp())).write.mode("overwrite").json(f"{self.base}/quarantine/part={part}")
        good = journal.replay(lines, before + 1)
        good.write.mode("overwrite").parquet(f"{self.base}/passed/part={part}")
        passed = self.spark.read.schema(good.schema).parquet(f"{self.base}/passed/part={part}")
        self.writer(passed, part)
        return passed.agg(F.coalesce(F.max("seq"), F.lit(before)).cast("long")).first()[0]

    def start(self, **trigger):
        stream = journal_stream(self.spark, self.folder, None)
        return stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", f"{self.base}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def run(self, most_errors: int = LIMITS.poll_errors, poll_ms: int = LIMITS.poll_ms, backoff_ms: int = LIMITS.poll_backoff_ms, sleep: Callable[[float], None] = time.sleep) -> None:
        """Read what is there. A failure is tried again after a pause that grows with their number; as many as most_errors in
        a row end it."""
        for n in range(1, most_errors + 1):
            try:
                self.start().awaitTermination()
                return
            except StreamingQueryException as e:
                if n == most_errors:
                    raise RuntimeError("tail_follow_exhausted") from e
                sleep(min(poll_ms * n, backoff_ms) / 1000)
