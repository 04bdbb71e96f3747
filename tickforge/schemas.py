"""The default limits of all rules, and the canonical tick view over a table: arrival, inst_id, ts (ms), price, size, side, trade_id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Default limits of journal, queue and liveness rules."""

    dedup_window: int = 10_000
    queue_capacity: int = 20_000
    tip_every: int = 50
    tip_idle_ms: int = 2_000
    index_interval: int = 500
    index_entries: int = 256
    compaction_lag: int = 5_000
    overhang: int = 50
    torn_wait_ms: int = 2_000
    silence_ms: int = 60_000
    ack_window_ms: int = 5_000
    write_window_ms: int = 45_000
    heal_cooldown_ms: int = 120_000
    brief_flap_ms: int = 5_000
    tip_window_ms: int = 30_000
    heartbeat_ms: int = 30_000
    max_backoff_s: int = 30
    drop_log_ms: int = 10_000
    drops_to_error: int = 1_000
    saturated_to_error_ms: int = 60_000
    preview_chars: int = 120
    log_first: int = 3
    log_at: tuple[int, ...] = (10, 50, 100)
    log_every: int = 500
    lag_log_ms: int = 5_000
    poll_errors: int = 10
    poll_ms: int = 50
    poll_backoff_ms: int = 5_000


LIMITS = Limits()


def ticks_of_events(events: DataFrame) -> DataFrame:
    """Canonical ticks of the events table, in arrival order by event_id."""
    ts = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    side = F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell")
    return events.select(F.col("event_id").alias("arrival"), F.col("event_type").alias("inst_id"), ts.alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("size"), side.alias("side"), F.col("user_id").cast("string").alias("trade_id"))
