"""Journal state: meta, cursor, tips and progress, as functions of rows. Durable state is one small row, kept as JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LIMITS
from .ingest import decoded, is_object, kind_at, whole_number
from .ordered import carried

INDEX = "array<array<bigint>>"


def _from_zero(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def read_meta(texts: DataFrame, text: str = "json") -> DataFrame:
    """texts with latest_seq, seen_trade_ids, seq_index and ok: the journal's meta with a default for each missing key (0, none,
    [[0, 0]]); a null text is a missing file and all default. Not ok: no JSON object; then all are null."""
    cols, v, raw = texts.columns, F.col("__v"), F.col(text)
    rows = decoded(texts, text, "__v")
    ok = raw.isNull() | (v.isNotNull() & is_object(raw))
    missing = lambda path: F.try_variant_get(v, path, "variant").isNull()
    seen = F.try_variant_get(v, "$.seen_trade_ids", "map<string,variant>")
    lists = F.map_filter(F.transform_values(seen, lambda k, x: F.try_variant_get(x, "$", "array<string>")), lambda k, x: x.isNotNull())
    return rows.select(
        *cols,
        F.when(ok, F.when(missing("$.latest_seq"), 0).otherwise(whole_number(v, "$.latest_seq"))).cast("long").alias("latest_seq"),
        F.when(ok, F.coalesce(lists, F.create_map().cast("map<string,array<string>>"))).alias("seen_trade_ids"),
        F.when(ok, F.when(missing("$.seq_index"), F.array(F.array(F.lit(0), F.lit(0)).cast("array<bigint>"))).otherwise(F.coalesce(index_entries(F.try_variant_get(v, "$.seq_index", "array<variant>")), F.array().cast(INDEX)))).alias("seq_index"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def index_entries(raw: Column) -> Column:
    """Of an array of variants, the entries [seq, offset]; malformed ones go."""
    pairs = F.transform(raw, lambda x: F.try_variant_get(x, "$", "array<bigint>"))
    return F.filter(pairs, lambda x: x.isNotNull() & (F.size(x) >= 2) & x[0].isNotNull() & x[1].isNotNull())


def hydrated(seen: Column, window: int = LIMITS.dedup_window) -> Column:
    """Dedup state of meta's seen_trade_ids: symbols in upper case, the last ``window`` ids of each (as one who takes them in
    order would hold them). Of symbols that differ in case only, the last by name counts."""
    entries = F.transform(F.map_entries(seen), lambda e: F.struct(F.upper(e["key"]).alias("k"), F.slice(F.array_distinct(e["value"]), F.greatest(F.size(F.array_distinct(e["value"])) - window + 1, F.lit(1)), F.lit(window)).alias("v"), e["key"].alias("n")))
    last = F.array_sort(entries)
    return F.map_from_entries(F.filter(F.transform(last, lambda e, i: F.when(F.get(last, i + 1)["k"].eqNullSafe(e["k"]), F.lit(None)).otherwise(F.struct(e["k"].alias("key"), e["v"].alias("value")))), lambda e: e.isNotNull()))


def read_cursor(texts: DataFrame, text: str = "json") -> DataFrame:
    """texts with last_processed_seq and ok; a missing file (null) or key is 0, what is no JSON object or below 0 is not ok."""
    cols, v, raw = texts.columns, F.col("__v"), F.col(text)
    n = F.when(raw.isNull() | kind_at(v, "$.last_processed_seq").isNull(), 0).otherwise(whole_number(v, "$.last_processed_seq"))
    ok = F.coalesce((raw.isNull() | (v.isNotNull() & is_object(raw))) & (n >= 0), F.lit(False))
    return decoded(texts, text, "__v").select(*cols, F.when(ok, n).cast("long").alias("last_processed_seq"), ok.alias("ok"))


def cursor_line(seq: Column) -> Column:
    return F.to_json(F.struct(seq.cast("long").alias("last_processed_seq")))


def index_tip(index: Column) -> Column:
    """The greatest seq of an index, 0 if it has none."""
    return F.coalesce(F.array_max(F.transform(index, lambda e: F.get(e, 0))), F.lit(0))


def merged_tip(memory: Column, high_water: Column, disk: Column, index: Column) -> dict[str, Column]:
    """What is persisted and read: negatives count as 0, a null disk as unreadable (0, and its index too). A disk that is ahead
    is taken over and not written; otherwise the greatest of memory and high water is written."""
    readable = disk.isNotNull()
    durable = F.when(readable, F.greatest(_from_zero(disk), _from_zero(index))).otherwise(0)
    ours = F.greatest(_from_zero(memory), _from_zero(high_water))
    return {
        "persisted": F.greatest(durable, ours), "skipped_write": durable > ours,
        "read_back": F.when(readable, F.greatest(durable, _from_zero(high_water))).otherwise(ours),
        "reloaded": F.greatest(durable, _from_zero(high_water)),
    }


def tips(changes: DataFrame, key: str = "reader", order: str = "pos") -> DataFrame:
    """changes(key, pos, seq) of a tip that never falls: with tip after each, and advanced (whether it rose). A seq below 0 is
    refused: it changes nothing."""
    seq = F.when(F.col("seq") >= 0, F.col("seq"))
    rows = carried(changes, [key], order, before={"__was": ("max", seq)})
    was = F.coalesce("__was", F.lit(0))
    return rows.withColumn("tip", F.greatest(was, F.coalesce(seq, F.lit(0)))).withColumn("advanced", F.coalesce(seq > was, F.lit(False))).drop("__was")


def cursors(commands: DataFrame, key: str = "reader", order: str = "pos") -> DataFrame:
    """commands(key, pos, op, seq) of a cursor: 'mark' takes it forward to a processed seq only, 'set' puts it anywhere (to go
    back, or on). With cursor after each, next_seq, and saved (whether it was written). A set below 0 is refused."""
    is_set = (F.col("op") == "set") & (F.col("seq") >= 0)
    rows = carried(commands, [key], order, upto={"__sets": ("sum", is_set.cast("long"))})
    rows = carried(rows, [key, "__sets"], order, before={"__most": ("max", F.when(is_set | (F.col("op") == "mark"), F.col("seq")))})
    was = F.coalesce("__most", F.lit(0))
    now = F.when(is_set, F.col("seq")).when(F.col("op") == "mark", F.greatest(was, F.col("seq"))).otherwise(was)
    saved = is_set | F.coalesce((F.col("op") == "mark") & (F.col("seq") > was), F.lit(False))
    return rows.withColumn("cursor", now.cast("long")).withColumn("next_seq", (now + 1).cast("long")).withColumn("saved", saved).drop("__sets", "__most")


def acknowledged(steps: DataFrame, key: str = "reader", order: str = "pos") -> DataFrame:
    """steps(key, pos, op, seq): 'wait' arms a tick, 'mark' acknowledges the armed one, 'set' puts the cursor and drops what is
    armed. Outcome of each: armed, processed, set, ignored (the first mark after a set took the armed tick away) or error (a
    mark with nothing armed)."""
    last = {"__last": ("last", F.struct("op", "seq")), "__armed": ("last", F.when(F.col("op").isin("wait", "mark"), F.col("op")))}
    rows = carried(steps, [key], order, before=last)
    outcome = (
        F.when(F.col("op") == "wait", "armed").when(F.col("op") == "set", "set").when(F.col("__last.op") == "wait", "processed")
        .when((F.col("__last.op") == "set") & (F.col("__armed") == "wait"), "ignored").otherwise("error")
    )
    return rows.withColumn("outcome", outcome).withColumn("processed_seq", F.when(outcome == "processed", F.col("__last.seq"))).drop("__last", "__armed")


def progress(df: DataFrame, overhang: int = LIMITS.overhang) -> DataFrame:
    """df(read_offset, journal_size, next_seq, disk_tip, stuck) with latest_seq, lag_seq and the classes."""
    floor = F.greatest(F.lit(0), F.col("next_seq") - 1)
    ahead = floor - F.col("disk_tip") > overhang
    latest = F.when(ahead, F.col("disk_tip")).otherwise(F.greatest("disk_tip", floor))
    out = df.withColumn("cursor_ahead", ahead).withColumn("latest_seq", latest.cast("long"))
    raw = F.when(F.col("latest_seq") >= F.col("next_seq"), F.col("latest_seq") - F.col("next_seq") + 1).otherwise(0)
    out = out.withColumn("lag_seq", F.when((raw == 0) & F.col("stuck"), 1).otherwise(raw).cast("long"))
    caught = (F.col("read_offset") >= F.col("journal_size")) & (F.col("lag_seq") == 0) & ~F.col("stuck")
    trailing = ~F.col("stuck") & (F.col("read_offset") < F.col("journal_size")) & (F.col("next_seq") > F.col("latest_seq"))
    out = out.withColumn("eof_caught_up", caught).withColumn("trailing_fp", trailing).withColumn("needs_resync", ~caught & ~trailing)
    return out.withColumn("log_level", F.when(caught | trailing, "DEBUG").otherwise("WARNING"))



def checked_progress(df: DataFrame) -> DataFrame:
    """progress of snapshots that are whole; one with a missing or NaN field is an error, as it must not pass for caught up."""
    fields = ["read_offset", "journal_size", "next_seq", "disk_tip", "stuck"]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.isnan(F.col(c).cast("double")) if c != "stuck" else F.lit(False)) for c in fields])
    whole = df.withColumn("next_seq", F.when(bad, F.raise_error(F.lit("a progress snapshot lacks a field"))).otherwise(F.col("next_seq")))
    return progress(whole)
