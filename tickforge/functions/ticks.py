"""Column functions on ticks, messages and journal lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LIMITS

#: The white space that strip() takes off a text.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def notional() -> Column:
    return F.col("price") * F.col("size")


def is_valid_tick(get: Callable[[str], Column] = F.col) -> Column:
    """Positive time and price (a NaN price passes), side buy or sell; nulls fail."""
    return F.coalesce((get("ts") > 0) & ~(get("price") <= 0) & get("side").isin("buy", "sell") & get("inst_id").isNotNull() & get("size").isNotNull() & get("trade_id").isNotNull(), F.lit(False))


def symbol_key(symbol: Column) -> Column:
    return F.upper(stripped(symbol))


def tick_struct() -> Column:
    return F.struct("inst_id", "ts", "price", "size", "side", "trade_id")


def record_line(seq: Column) -> Column:
    return F.to_json(F.struct(seq.alias("seq"), tick_struct().alias("tick")))


def preview(line: Column, limit: int = LIMITS.preview_chars) -> Column:
    flat = F.replace(line, F.lit("\n"), F.lit("\\n"))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit), F.lit("..."))).otherwise(flat)


def in_progress(line: Column) -> Column:
    """A torn line that may still become a record."""
    return F.ltrim(line, F.lit(SPACES)).startswith("{")


def close_diagnostic(rcvd: Column, sent: Column) -> Column:
    """rcvd and sent: structs(code, reason) of close frames. The received one, else the one sent, else its absence; reasons
    that are binary are read as UTF-8."""

    def frame(x: Column, source: str) -> Column:
        reason = F.replace(F.replace(F.coalesce(x["reason"].cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        return F.concat(F.lit("code="), F.coalesce(x["code"].cast("string"), F.lit("absent")), F.lit(", reason='"), reason, F.lit(f"', frame={source}"))

    return F.when(rcvd.isNotNull(), frame(rcvd, "rcvd")).when(sent.isNotNull(), frame(sent, "sent")).otherwise("close code/reason absent")


def tip_sample(value: Column) -> Column:
    """A tip as read: null if it is none, no whole number or below 0."""
    n = value.try_cast("bigint")
    return F.when(n >= 0, n)


def backoff_seconds(attempt: Column, most: int = LIMITS.max_backoff_s) -> Column:
    return F.least(F.pow(F.lit(2.0), F.least(attempt, F.lit(62))), F.lit(float(most)))


def can_retry(attempt: Column, max_retries: int | None) -> Column:
    return F.lit(True) if max_retries is None else attempt < max_retries


def logs_invalid_line(n: Column) -> Column:
    return (n <= LIMITS.log_first) | n.isin(*LIMITS.log_at) | (n % LIMITS.log_every == 0)
