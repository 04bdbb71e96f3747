"""Raw exchange messages to outcomes and ticks.

A text is parsed once. What is read of the parse stands behind a generator of one row (``behind``): without it the optimizer
puts a copy of the parse in the place of each mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import is_valid_tick


def behind(df: DataFrame, **cols: Column) -> DataFrame:
    """df with cols, computed once for each row whatever is made of them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in cols.items()]))))


def decoded(df: DataFrame, text: str, name: str = "v") -> DataFrame:
    """df with the variant of a text that is one JSON document, else null. The parser stops after the first value, so the
    text stands in an array before a number that it cannot know, its own hash: only one whole document leaves that number in
    the second place."""
    end = F.xxhash64(F.col(text), F.lit("end"))
    rows = behind(df, __array=F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(","), end.cast("string"), F.lit("]"))), __end=end)
    whole = F.try_variant_get("__array", "$[1]", "bigint") == F.col("__end")
    rows = behind(rows, **{name: F.when(whole, F.try_variant_get("__array", "$[0]", "variant"))})
    return rows.drop("__array", "__end")


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def kind_at(v: Column, path: str) -> Column:
    """The type at path, null where there is nothing; VOID is JSON's null."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def is_object(text: Column) -> Column:
    return F.rlike(text, F.lit(r"^[ \t\r\n]*\{"))


def whole_number(v: Column, path: str) -> Column:
    """A number's whole part or the whole number of a string, as int() takes them."""
    return F.coalesce(text_at(v, path).try_cast("bigint"), F.when(~F.coalesce(kind_at(v, path) == "STRING", F.lit(False)), F.try_variant_get(v, path, "double").try_cast("bigint")))


def number(v: Column, path: str) -> Column:
    """A number, or the number in a string, as float() takes them (without a type letter behind)."""
    return F.when(~F.rlike(text_at(v, path), F.lit("[dDfF]$")), text_at(v, path).try_cast("double"))


def ticks_of(v: Column) -> Column:
    """The valid ticks of a trade message with their places; a bad element is dropped alone, a missing size is 0."""
    inst = F.coalesce(text_at(v, "$.arg.instId"), F.lit("UNKNOWN"))

    def tick(e: Column, pos: Column) -> Column:
        size = F.when(F.try_variant_get(e, "$.size", "variant").isNull(), F.lit(0.0)).otherwise(number(e, "$.size"))
        return F.struct(pos.alias("pos"), inst.alias("inst_id"), whole_number(e, "$.ts").alias("ts"), number(e, "$.price").alias("price"), size.alias("size"), text_at(e, "$.side").alias("side"), F.coalesce(text_at(e, "$.tradeId"), F.lit("")).alias("trade_id"))

    return F.filter(F.transform(F.try_variant_get(v, "$.data", "array<variant>"), tick), lambda t: is_valid_tick(lambda c: t[c]))


def classify(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """messages with kind (trade, subscribe, error, unknown, pong, bad_json, contract), symbol, ticks (of trades) and the
    variant v. The first rule that holds wins; a trade message without a valid tick breaks the contract, as do an empty text
    and JSON that is no object. Repeated keys of an object count as bad JSON."""
    text, v = F.col(raw), F.col("v")
    rows = decoded(messages, raw)
    rows = behind(rows, __action=text_at(v, "$.action"), __event=text_at(v, "$.event"), __channel=text_at(v, "$.arg.channel"), __arg=kind_at(v, "$.arg"), __error=F.try_variant_get(v, "$.error", "variant").isNotNull(), __object=is_object(text))
    moves = F.coalesce(F.col("__action").isin("snapshot", "update"), F.lit(False))
    arg_object = F.coalesce(F.col("__arg").startswith("OBJECT"), F.lit(False))
    trade = F.coalesce(F.col("__object") & moves & arg_object & (F.col("__channel") == "trade"), F.lit(False))
    symbol = F.when(arg_object & (kind_at(v, "$.arg.instId") == "STRING"), F.nullif(text_at(v, "$.arg.instId"), F.lit("")))
    rows = behind(rows, ticks=F.when(trade, F.coalesce(ticks_of(v), F.array().cast("array<struct<pos:int,inst_id:string,ts:bigint,price:double,size:double,side:string,trade_id:string>>"))), symbol=symbol)
    kind = (
        F.when(text.isNull() | (text == ""), "contract").when(text == "pong", "pong").when(v.isNull(), "bad_json").when(~F.col("__object"), "contract")
        .when(moves & ~arg_object & F.col("__arg").isNotNull(), "unknown").when(F.size("ticks") > 0, "trade").when(F.col("ticks").isNotNull(), "contract")
        .when(F.col("__event") == "subscribe", "subscribe").when((F.col("__event") == "error") | F.col("__error"), "error").otherwise("unknown")
    )
    return rows.withColumn("kind", kind).select(*messages.columns, "v", "kind", "symbol", "ticks")


def explode_trades(classified: DataFrame, *keep: str) -> DataFrame:
    """Valid ticks of trade messages, with their place in the message."""
    return classified.filter("kind = 'trade'").select(*keep, F.inline("ticks"))


def subscription_payload(symbols: DataFrame, op: str = "subscribe", inst_type: str = "USDT-FUTURES", order: str = "pos") -> DataFrame:
    """One row: the JSON request for all symbols in order (a request's symbols are few by contract)."""
    if op not in ("subscribe", "unsubscribe"):
        raise ValueError("op must be subscribe or unsubscribe")
    arg = F.struct(F.lit(inst_type).alias("instType"), F.lit("trade").alias("channel"), F.col("symbol").alias("instId"))
    args = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), arg.alias("a")))), lambda x: x["a"])
    return symbols.agg(args.alias("args")).select(F.to_json(F.struct(F.lit(op).alias("op"), "args")).alias("payload"))


def registry(commands: DataFrame, order: str = "pos") -> DataFrame:
    """Symbols registered after commands(pos, op, symbol): the last command of a symbol decides."""
    last = commands.groupBy("symbol").agg(F.max_by("op", order).alias("op"))
    return last.filter("op = 'subscribe'").select("symbol")


def effective(commands: DataFrame, order: str = "pos") -> DataFrame:
    """The commands(pos, op, symbol) that change the registry and so are sent: a subscription of a symbol that is not there,
    the end of one that is. A symbol's first command is sent if it subscribes."""
    from .ordered import carried

    rows = carried(commands, ["symbol"], order, before={"__was": ("last", F.col("op"))})
    return rows.filter(F.col("op") != F.coalesce("__was", F.lit("unsubscribe"))).drop("__was")
