"""The journal: records, scans with quarantine, sparse index, compaction and tips, as DataFrames over immutable files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import in_progress, is_valid_tick, record_line, stripped
from ..schemas import LIMITS
from .ingest import behind, decoded, is_object, number, text_at, whole_number
from .ordered import carried, increasing, sequenced


def append(ticks: DataFrame, base: int = 0, order: str = "arrival") -> DataFrame:
    """Records of accepted ticks: seq in arrival order after base, tick fields and the line written."""
    return sequenced(ticks, order, base).withColumn("line", record_line(F.col("seq")))


def parsed(lines: DataFrame, cold: bool = False, wait_ms: int = LIMITS.torn_wait_ms) -> DataFrame:
    """lines(line_no, line, complete, and quiet_ms: for how long a torn last line has been as it is, null or left out for
    long enough): seq, tick fields, reason (null for a good record) and waiting (a torn line that may still become a record
    and is neither good nor bad yet). Blank lines are left out. cold: the reader attaches here, and waits for nothing."""
    quiet = F.coalesce(F.col("quiet_ms"), F.lit(wait_ms)) if "quiet_ms" in lines.columns else F.lit(wait_ms)
    rows = lines.select("line_no", "line", "complete", quiet.alias("quiet_ms")).filter(stripped(F.col("line")) != "")
    rows = behind(rows, text=stripped(F.col("line")))
    rows, v = decoded(rows, "text"), F.col("v")
    get = {
        "seq": whole_number(v, "$.seq"), "inst_id": text_at(v, "$.tick.inst_id"), "ts": whole_number(v, "$.tick.ts"), "price": number(v, "$.tick.price"), "size": number(v, "$.tick.size"),
        "side": text_at(v, "$.tick.side"), "trade_id": text_at(v, "$.tick.trade_id"),
    }
    rows = behind(rows, **get)
    torn = ~F.col("complete")
    reason = (
        F.when(torn & ~in_progress(F.col("line")), "incomplete_trailing_poison").when(torn & F.lit(cold), "incomplete_trailing_cold_attach").when(torn & (F.col("quiet_ms") >= wait_ms), "incomplete_trailing_stale")
        .when(~torn & v.isNull(), "bad_json").when(~torn & ~is_object(F.col("text")), "not_object").when(~torn & (F.col("seq").isNull() | ~is_valid_tick()), "bad_record")
    )
    rows = behind(rows, reason=reason)
    return rows.withColumn("waiting", torn & F.col("reason").isNull()).drop("v", "text", "quiet_ms")


def replay(lines: DataFrame, start: int = 0, cold: bool = False) -> DataFrame:
    """Good records from start on, strictly increasing in file order."""
    good = parsed(lines, cold).filter("reason is null and not waiting").drop("reason", "waiting")
    return increasing(good, "line_no", "seq", start, like=lines)


def quarantine(lines: DataFrame, cold: bool = False) -> DataFrame:
    return parsed(lines, cold).filter("reason is not null").select("line_no", "reason", "line")


def dead_letters(lines: DataFrame, ts_ms: Column, cold: bool = False) -> DataFrame:
    """Quarantine records (ts_ms, reason, line) as they are appended to the dead letters."""
    return quarantine(lines, cold).select(ts_ms.cast("long").alias("ts_ms"), "reason", "line")


def symbols_only(ticks: DataFrame, symbols: list[str]) -> DataFrame:
    """An empty list lets all pass; otherwise exact, case-sensitive."""
    return ticks.filter(F.col("inst_id").isin(symbols)) if symbols else ticks


def byte_offsets(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """lines with byte_offset: where each begins, one byte for each line feed."""
    rows = carried(lines, [], order, before={"byte_offset": ("sum", (F.octet_length("line") + 1).cast("long"))})
    return rows.withColumn("byte_offset", F.coalesce("byte_offset", F.lit(0)).cast("long"))


def sparse_index(records: DataFrame, interval: int = LIMITS.index_interval, entries: int | None = LIMITS.index_entries) -> DataFrame:
    """The newest entries (seq, byte_offset) of seq 0 and each interval-th; a top-k. entries None: all of them."""
    rows = records.filter(F.col("seq") % interval == 0).select("seq", "byte_offset")
    return rows if entries is None else rows.orderBy(F.desc("seq")).limit(entries)


def floor_lookup(wanted: DataFrame, index: DataFrame, entries: int | None = LIMITS.index_entries) -> DataFrame:
    """wanted(start): the greatest indexed seq at or below it and its offset, else 0. The index, of ``entries`` rows at most,
    is one sorted array, in which each start is looked up by halving. entries None, an index of any size: one sorted pass
    over both sides."""
    if entries is None:
        marks = index.select(F.col("seq").cast("long").alias("start"), F.lit(0).alias("__asks"), F.col("byte_offset").cast("long").alias("__offset"))
        asked = wanted.select(F.col("start").cast("long").alias("start"), F.lit(1).alias("__asks"), F.lit(None).cast("long").alias("__offset"))
        hint = F.when(F.col("__asks") == 0, F.struct(F.col("start").alias("seq"), F.col("__offset").alias("byte_offset")))
        rows = carried(marks.union(asked), [], "start", upto={"__hit": ("last", hint)}, ties=("__asks",)).filter("__asks = 1")
        return rows.select("start", F.coalesce("__hit.seq", F.lit(0)).cast("long").alias("hint_seq"), F.coalesce("__hit.byte_offset", F.lit(0)).cast("long").alias("hint_offset"))
    one = index.agg(F.array_sort(F.collect_list(F.struct(F.col("seq").cast("long").alias("seq"), F.col("byte_offset").cast("long").alias("byte_offset")))).alias("__i"))
    steps = [1 << k for k in range(entries.bit_length() - 1, -1, -1)]
    i = F.col("__i")
    found = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, d: F.when(F.get(i, at + d - 1)["seq"] <= F.col("start"), at + d).otherwise(at))
    rows = wanted.select("start").crossJoin(F.broadcast(one)).withColumn("__hit", F.get(i, found - 1))  # one row
    return rows.select("start", F.coalesce("__hit.seq", F.lit(0)).cast("long").alias("hint_seq"), F.coalesce("__hit.byte_offset", F.lit(0)).cast("long").alias("hint_offset"))


def resolve_offset(records: DataFrame, start: int) -> DataFrame:
    """One row: where the first record with seq >= start begins (0 for start <= 1)."""
    return records.filter(F.col("seq") >= start).agg((F.lit(0) if start <= 1 else F.min("byte_offset")).cast("long").alias("byte_offset"))


def compact(records: DataFrame, min_retain: int) -> DataFrame:
    return records if min_retain <= 1 else records.filter(F.col("seq") >= min_retain)


def compact_lines(lines: DataFrame, min_retain: int) -> DataFrame:
    """lines(line_no, line) with what compaction does with each: keep, remove, skip (no seq to be read; it goes to quarantine)
    or blank (it goes). Nothing but seq is looked at. min_retain <= 1 keeps all."""
    rows = behind(lines, __text=stripped(F.col("line")))
    rows = decoded(rows, "__text", "__v")
    rows = behind(rows, seq=whole_number(F.col("__v"), "$.seq"))
    fate = F.when(F.lit(min_retain <= 1), "keep").when(F.col("__text") == "", "blank").when(F.col("seq").isNull(), "skip").when(F.col("seq") < min_retain, "remove").otherwise("keep")
    return rows.withColumn("fate", fate).drop("__text", "__v")


def compaction_report(lines: DataFrame, min_retain: int) -> DataFrame:
    """One row: kept, removed, skipped, and whether the journal is written anew (something went or could not be read)."""
    n = [F.count_if(F.col("fate") == f).alias(a) for f, a in (("keep", "kept"), ("remove", "removed"), ("skip", "skipped"))]
    return compact_lines(lines, min_retain).agg(*n).withColumn("rewritten", (F.col("removed") > 0) | (F.col("skipped") > 0))


def compaction_quarantine(lines: DataFrame, min_retain: int) -> DataFrame:
    return compact_lines(lines, min_retain).filter("fate = 'skip'").select("line_no", F.lit("compact_skip").alias("reason"), "line")


def auto_compact(records: DataFrame, last_processed: int, lag: int = LIMITS.compaction_lag) -> DataFrame:
    if lag <= 0:
        raise ValueError("lag must be above 0")
    return records if last_processed <= lag else compact(records, max(1, last_processed - lag))


def compacted_index(records: DataFrame, min_retain: int, interval: int = LIMITS.index_interval, entries: int = LIMITS.index_entries) -> DataFrame:
    """(seq, byte_offset) after compaction: [0, 0], the first retained record, then each interval-th; newest entries."""
    kept = byte_offsets(compact(records, min_retain).drop("byte_offset"), "seq")
    first = kept.agg(F.min("seq").alias("lo"))
    rows = kept.crossJoin(F.broadcast(first)).filter((F.col("seq") == F.col("lo")) | (F.col("seq") % interval == 0)).select("seq", "byte_offset")  # one row
    zero = records.sparkSession.range(1).select(F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("byte_offset"))
    return zero.union(rows).orderBy(F.desc("seq")).limit(entries)


def durable_tip(records: DataFrame, every: int = LIMITS.tip_every) -> DataFrame:
    """Per writer (inst_id): appended, the tip published at every ``every``-th append, and whether the rest is unpublished."""
    n = records.groupBy("inst_id").agg(F.count(F.lit(1)).alias("appended"))
    return n.select("inst_id", "appended", (F.col("appended") - F.col("appended") % every).alias("durable"), (F.col("appended") % every > 0).alias("dirty"))


def idle_flushes(records: DataFrame, idle_ms: int = LIMITS.tip_idle_ms) -> DataFrame:
    """Records after which a writer was quiet longer than idle_ms, so that its tip was published."""
    rows = carried(records, ["inst_id"], "arrival", after={"__next": ("first", F.col("ts"))})
    return rows.withColumn("quiet_ms", F.col("__next") - F.col("ts")).drop("__next").filter(F.col("quiet_ms").isNull() | (F.col("quiet_ms") > idle_ms))


def skip_episodes(rows: DataFrame, order: str = "line_no") -> DataFrame:
    """Runs of bad lines between good ones, from the number of good lines before each: first_line, skipped (bad lines of the
    run), skipped_total (of all up to its end) and recovered (a good line follows)."""
    good = F.col("reason").isNull()
    numbered = carried(rows.select(order, "reason"), [], order, before={"g": ("sum", good.cast("long"))}, upto={"t": ("sum", (~good).cast("long"))}, after={"n": ("sum", good.cast("long"))})
    runs = numbered.filter(~good).groupBy(F.coalesce("g", F.lit(0)).alias("g"))
    return runs.agg(F.min(order).alias("first_line"), F.count(F.lit(1)).alias("skipped"), F.max("t").alias("skipped_total"), (F.max(F.coalesce("n", F.lit(0))) > 0).alias("recovered")).drop("g")
