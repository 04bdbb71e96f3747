"""Connection and write liveness from event times alone. Rules that look back or ahead on a key are read by time ranges
(``ordered.carried``), so that a hot symbol or connection is many tasks'."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import backoff_seconds
from ..schemas import LIMITS
from .backpressure import throttled
from .ordered import carried


def silence_gaps(activity: DataFrame, key: str = "inst_id", time: str = "ts", order: str = "arrival", timeout_ms: int = LIMITS.silence_ms) -> DataFrame:
    """Activity that came more than timeout_ms after the one before (the boundary is healthy)."""
    rows = carried(activity, [key], order, before={"__last": ("last", F.col(time))})
    return rows.withColumn("gap_ms", F.col(time) - F.col("__last")).drop("__last").filter(F.col("gap_ms") > timeout_ms)


def ack_completeness(requests: DataFrame, acks: DataFrame, window_ms: int = LIMITS.ack_window_ms) -> DataFrame:
    """requests(req, ts, symbols), acks(symbol, ts): confirmed and missing symbols in [ts, ts + window). Of each request and
    symbol the next ack decides."""
    want = requests.select("req", "ts", F.explode(F.array_distinct("symbols")).alias("symbol")).select("symbol", "ts", F.lit(0).alias("o"), "req")
    got = acks.select("symbol", "ts", F.lit(1).alias("o"), F.lit(None).cast(requests.schema["req"].dataType).alias("req"))
    rows = carried(want.union(got), ["symbol"], "ts", after={"ack": ("first", F.when(F.col("o") == 1, F.col("ts")))}, ties=("o",), like=requests.select("ts").union(acks.select("ts"))).filter("o = 0")
    ok = F.coalesce(F.col("ack") < F.col("ts") + window_ms, F.lit(False))
    out = rows.groupBy("req").agg(F.count(F.lit(1)).alias("expected"), F.count_if(ok).alias("confirmed"), F.array_join(F.sort_array(F.collect_list(F.when(~ok, F.col("symbol")))), ",").alias("missing"))
    return out.withColumn("complete", F.col("expected") == F.col("confirmed"))


def stale_arms(arms: DataFrame, writes: DataFrame, key: str = "inst_id", window_ms: int = LIMITS.write_window_ms) -> DataFrame:
    """arms(key, arrival, ts) without a write(key, ts) in (ts, ts + window]; one sorted pass instead of an interval join."""
    both = arms.select(key, "arrival", "ts", F.lit(1).alias("arm")).union(writes.select(key, F.lit(None).cast("long"), "ts", F.lit(0)))
    rows = carried(both, [key], "ts", after={"w": ("first", F.when(F.col("arm") == 0, F.col("ts")))}, ties=("arm",))
    return rows.filter((F.col("arm") == 1) & (F.col("w").isNull() | (F.col("w") > F.col("ts") + window_ms))).select(key, "arrival", "ts")


def heals(stale: DataFrame, key: str = "inst_id", cooldown_ms: int = LIMITS.heal_cooldown_ms) -> DataFrame:
    """Stale detections that fire: none fired for the key within the cooldown before."""
    return throttled(stale, key, "ts", ["ts", "arrival"], cooldown_ms)


def flap_pairs(events: DataFrame, brief_ms: int = LIMITS.brief_flap_ms) -> DataFrame:
    """events(conn, pos, kind, wall_ms, mono_ms): each close_error with the connect next to it on its connection."""
    only = events.filter(F.col("kind").isin("close_error", "connect")).select("conn", "pos", "kind", "wall_ms", "mono_ms")
    nxt = carried(only, ["conn"], "pos", after={"n": ("first", F.struct("kind", "wall_ms", "mono_ms"))})
    out = nxt.filter("kind = 'close_error' and n.kind = 'connect'").select("conn", "pos", F.col("wall_ms").alias("closed_ms"), F.col("n.wall_ms").alias("restored_ms"), (F.col("n.mono_ms") - F.col("mono_ms")).alias("duration_ms"))
    return out.withColumn("brief", (F.col("duration_ms") >= 0) & (F.col("duration_ms") < brief_ms))


def stale_tips(flaps: DataFrame, writes: DataFrame, window_ms: int = LIMITS.tip_window_ms) -> DataFrame:
    """flaps with baseline (tip at close, else at restore), tip_now (window after restore) and stale. A tip at a time is the
    largest seq written on the connection at or before it; all three are read in one pass over the writes."""
    times = [F.struct(F.lit(k).alias("k"), t.cast("long").alias("t")) for k, t in enumerate((F.col("closed_ms"), F.col("restored_ms"), F.col("restored_ms") + window_ms))]
    asked = flaps.select("conn", F.struct(*flaps.columns).alias("flap"), F.inline(F.array(*times)))
    both = asked.select("conn", "t", F.lit(1).alias("o"), "k", "flap", F.lit(None).cast("long").alias("seq"))
    none = [F.lit(None).cast(both.schema[c].dataType).alias(c) for c in ("k", "flap")]
    both = both.union(writes.select("conn", F.col("ts").alias("t"), F.lit(0).alias("o"), *none, F.col("seq").cast("long").alias("seq")))
    tips = carried(both, ["conn"], "t", upto={"tip": ("max", F.col("seq"))}, ties=("o",), like=writes.select(F.col("ts").alias("t"))).filter("o = 1")
    at = tips.groupBy("flap").agg(*[F.max(F.when(F.col("k") == k, F.col("tip"))).alias(n) for k, n in enumerate(("t1", "t2", "tip_now"))])
    out = at.select("flap.*", F.coalesce("t1", "t2").alias("baseline"), "tip_now")
    return out.withColumn("stale", F.coalesce(F.col("tip_now") <= F.col("baseline"), F.lit(False)))


def generations(events: DataFrame) -> DataFrame:
    """Connects of each connection with their generation and whether it is the first."""
    rows = carried(events.filter("kind = 'connect'"), ["conn"], "pos", upto={"generation": ("sum", F.lit(1).cast("long"))})
    return rows.withColumn("first_boot", F.col("generation") <= 1)


def attempts(events: DataFrame) -> DataFrame:
    """Failed waits of each connection: attempt counts waits since the last connect, backoff_s is the wait."""
    rows = carried(events, ["conn"], "pos", upto={"__closed": ("sum", (F.col("kind") == "close_error").cast("long"))})
    rows = carried(rows, ["conn"], "pos", upto={"__before": ("max", F.when(F.col("kind") == "connect", F.col("__closed")))}).filter("kind = 'close_error'")
    rows = rows.withColumn("attempt", F.col("__closed") - F.coalesce("__before", F.lit(0)) - 1).drop("__closed", "__before")
    return rows.withColumn("backoff_s", backoff_seconds(F.col("attempt")))


def since_close(events: DataFrame) -> DataFrame:
    """Connects with the milliseconds since the last close of their connection, null before any."""
    rows = carried(events, ["conn"], "pos", before={"__close": ("last", F.when(F.col("kind") == "close_error", F.col("mono_ms")))})
    return rows.filter("kind = 'connect'").withColumn("since_close_ms", F.col("mono_ms") - F.col("__close")).drop("__close")


def states(events: DataFrame) -> DataFrame:
    """Events with log_seq (the place on their connection) and connected (after the event)."""
    flag = F.when(F.col("kind") == "connect", True).when(F.col("kind") == "close_error", False)
    rows = carried(events, ["conn"], "pos", upto={"log_seq": ("sum", F.lit(1).cast("long")), "connected": ("last", flag)})
    return rows.withColumn("connected", F.coalesce("connected", F.lit(False)))


def heartbeats(sessions: DataFrame, every_ms: int = LIMITS.heartbeat_ms) -> DataFrame:
    """sessions(conn, t0, t1): a ping each interval, the first after one whole interval."""
    due = F.when(F.col("t0") + every_ms <= F.col("t1"), F.sequence(F.col("t0") + every_ms, "t1", F.lit(every_ms).cast("long")))
    return sessions.select("conn", F.explode(due).alias("ping_ms"))
