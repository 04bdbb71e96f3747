"""Feeds made from a rule, for tests and demonstrations: the same rows for the same seed on any number of executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ticks import stripped

#: The feed's steps, sizes, first id and pace.
STEPS, FIRST_ID, EVERY_MS, SIZE = (-5.0, -1.0, 1.0, 5.0, 10.0), 1001, 500, (0.01, 2.5)
PULSE_PRICE, PULSE_SIZE = 1.0, 0.0001


def _draw(seed: int, what: str, n: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), F.col("arrival")), F.lit(n))


def feed(spark: SparkSession, n: int, prices: dict[str, float], start_ms: int = 1_700_000_000_000, seed: int = 1) -> DataFrame:
    """n ticks at a steady pace (arrival, then a tick's fields): a symbol drawn each time, whose price walks by STEPS; sizes
    with four digits; ids from TX-1001 on. Each symbol's walk is a running sum on its ticks."""
    names = sorted(prices)
    of = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))
    rows = spark.range(n).select(F.col("id").alias("arrival")).withColumn("inst_id", of(names, _draw(seed, "symbol", len(names)))).withColumn("__step", of(STEPS, _draw(seed, "step", len(STEPS))))
    walked = F.sum("__step").over(W.partitionBy("inst_id").orderBy("arrival").rowsBetween(W.unboundedPreceding, 0))
    first = F.element_at(F.create_map(*[F.lit(x) for s in names for x in (s, float(prices[s]))]), F.col("inst_id"))
    size = F.round(SIZE[0] + (SIZE[1] - SIZE[0]) * _draw(seed, "size", 1_000_003) / 1_000_002, 4)
    side = F.when(_draw(seed, "side", 2) == 0, "buy").otherwise("sell")
    return rows.select("arrival", "inst_id", (F.lit(start_ms) + F.col("arrival") * EVERY_MS).alias("ts"), (first + walked).alias("price"), size.alias("size"), side.alias("side"), F.concat(F.lit("TX-"), (F.col("arrival") + FIRST_ID).cast("string")).alias("trade_id"))


def as_messages(ticks: DataFrame, action: str = "snapshot") -> DataFrame:
    """arrival and raw: a trade message for each tick, as the exchange sends them."""
    arg = F.struct(F.lit("trade").alias("channel"), F.col("inst_id").alias("instId"))
    item = F.struct("ts", F.col("price").cast("string").alias("price"), F.col("size").cast("string").alias("size"), "side", F.col("trade_id").alias("tradeId"))
    return ticks.select("arrival", F.to_json(F.struct(F.lit(action).alias("action"), arg.alias("arg"), F.array(item).alias("data"))).alias("raw"))


def answers(requests: DataFrame, raw: str = "raw") -> DataFrame:
    """What a mock exchange sends back to requests(pos, raw): pong for ping, an acknowledgement for each symbol of a
    subscription, nothing for the end of one or for what it cannot read. pos, place and answer."""
    from ..operators.ingest import behind, decoded, text_at

    rows = decoded(requests, raw)
    rows = behind(rows, __op=text_at(F.col("v"), "$.op"), __args=F.coalesce(F.try_variant_get("v", "$.args", "array<variant>"), F.array().cast("array<variant>")))
    ack = lambda a: F.to_json(F.struct(F.lit("subscribe").alias("event"), F.struct(text_at(a, "$.instType").alias("instType"), text_at(a, "$.channel").alias("channel"), text_at(a, "$.instId").alias("instId")).alias("arg")))
    out = F.when(F.col(raw) == "ping", F.array(F.lit("pong"))).when(F.col("__op") == "subscribe", F.transform("__args", ack)).otherwise(F.array().cast("array<string>"))
    return rows.select("pos", F.posexplode(out).alias("place", "answer"))


def with_pulse(ticks: DataFrame, symbol: str, now_ms: int) -> DataFrame:
    """ticks(arrival, ...) and, behind them, the pulse by which a new collector shows itself."""
    if not symbol.strip():
        raise ValueError("symbol must not be empty")
    last = ticks.agg((F.coalesce(F.max("arrival"), F.lit(-1)) + 1).cast("long").alias("arrival"))
    name = f"LEV-HANDOFF-{now_ms}"
    pulse = last.select("arrival", F.upper(stripped(F.lit(symbol))).alias("inst_id"), F.lit(now_ms).cast("long").alias("ts"), F.lit(PULSE_PRICE).alias("price"), F.lit(PULSE_SIZE).alias("size"), F.lit("buy").alias("side"), F.lit(name).alias("trade_id"))
    return ticks.unionByName(pulse)


def is_pulse(trade_id):
    return trade_id.startswith("LEV-HANDOFF-")
