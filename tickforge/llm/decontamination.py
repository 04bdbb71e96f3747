"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions only.

A benchmark item of L words is compared with every window of L words of a text, wherever it starts (a text of fewer words is
one window). A window's and an item's likeness is the weighted Jaccard similarity of their five-word shingles with
repetitions; a shingle that n items have weighs 1000 div n, but 1 at least, and one that none has 1000.

A window can reach the similarity only if its shingles that the item has weigh as much as that share of the item: the
union weighs no less than the item. So shingles of items are found in the texts, and of each text and item the starts at
which that holds come from a running sum over the places where a window gains or loses a shingle. This bound loses
nothing. Windows that hold the same words are one. Their 64-bit SimHash is looked up in a multi-index of the items'
fingerprints: four blocks of 16 bits, in one of which fingerprints within ``radius`` bits differ in ``radius`` div 4 at most.
An item stands under all keys within three bits of its block's, a window asks for all within the bits that are left, so
every fingerprint within ``radius`` meets. Candidates are verified with the exact similarity.

The radius of 19 bits is what 64 votes need: two windows of similarity 0.8 have a cosine of about 0.89 and so differ in 9.7
bits on average with a deviation of 2.9; about 3 of 10,000 such lie beyond 19. README has the measured share.

Words are lower-cased. Items of under five words are one shingle of all their words. Null or empty texts and items match
nothing. Items of one text are compared once and all found. Repeated rows are judged each for itself; ids may be null or
repeat. Extra columns of any name are ignored, and pass in ``filter_documents``. Empty tables give no rows. What comes of the
benchmark is broadcast up to a checked size, else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import small, text_of, written
from .quality_rules import WS, words

WIDTH = 5
BLOCKS, BLOCK_BITS, ITEM_BITS = 4, 16, 3


def shingles(w: Column, width: int) -> Column:
    """Hashes of the sequences of ``width`` words, in order."""
    n = F.size(w)
    return F.when(n < width, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, width))))


def fingerprints(rows: DataFrame, key: str) -> DataFrame:
    """rows: key, s (a shingle), weight. The SimHash of each key's rows."""
    votes = [F.sum(F.when(F.call_function("shiftright", F.col("s"), F.lit(b)).bitwiseAND(F.lit(1)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"v{b}") for b in range(64)]
    bit = lambda b: F.when(F.col(f"v{b}") > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(b))).otherwise(F.lit(0).cast("long"))
    total = bit(0)
    for b in range(1, 64):
        total = total.bitwiseOR(bit(b))
    return rows.groupBy(key).agg(*votes).select(key, total.alias("print"))


def cells(prints: DataFrame) -> DataFrame:
    """prints with a row for each block of the fingerprint."""
    cut = [F.call_function("shiftright", F.col("print"), F.lit(BLOCK_BITS * b)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for b in range(BLOCKS)]
    return prints.select("*", F.posexplode(F.array(*cut)).alias("block", "cell"))


def flipped(prints: DataFrame, bits: int) -> DataFrame:
    """prints under every key within so many bits of their blocks'."""
    near = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= bits]
    return cells(prints).select("*", F.explode(F.array(*[F.lit(m) for m in near])).alias("flip")).withColumn("cell", F.col("cell").bitwiseXOR(F.col("flip"))).drop("flip")


def meetings(prints: DataFrame, others: DataFrame, on: list[str], radius: int) -> DataFrame:
    """Rows of prints and others (the fingerprint there is named other) that agree in ``on`` and differ in ``radius`` bits at
    most; pairs that meet in several blocks come several times."""
    reach = radius // BLOCKS
    index = flipped(others.withColumnRenamed("other", "print"), min(reach, ITEM_BITS)).withColumnRenamed("print", "other")
    asked = flipped(prints, reach - min(reach, ITEM_BITS))
    return asked.join(small(index), [*on, "block", "cell"]).filter(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= radius)


def starts(seeds: DataFrame, sums: DataFrame, percent: int) -> DataFrame:
    """seeds: rk, n (words of the text), pos, ik, len, width, weight of each shingle of an item found in a text. (rk, ik, len,
    width, start) of the windows whose found shingles weigh at least percent of the item's sum."""
    bound = lambda weight: F.col(weight) * 100 >= F.col("sum2") * percent
    enough = seeds.groupBy("rk", "ik").agg(F.sum("weight").alias("most")).join(small(sums), "ik").filter(bound("most")).select("rk", "ik", "sum2")
    last = F.greatest(F.lit(0), F.least(F.col("pos"), F.col("n") - F.col("len")))
    first = F.least(last, F.greatest(F.lit(0), F.col("pos") - F.col("len") + F.col("width")))
    turns = seeds.join(enough, ["rk", "ik"]).select("rk", "ik", "len", "width", "sum2", F.inline(F.array(F.struct(first.alias("at"), F.col("weight").alias("gain")), F.struct((last + 1).alias("at"), (-F.col("weight")).alias("gain")))))
    turns = turns.groupBy("rk", "ik", "len", "width", "sum2", "at").agg(F.sum("gain").alias("gain"))
    line = W.partitionBy("rk", "ik").orderBy("at")
    runs = turns.withColumn("held", F.sum("gain").over(line.rowsBetween(W.unboundedPreceding, 0))).withColumn("next", F.lead("at").over(line))
    return runs.filter(bound("held") & F.col("next").isNotNull()).select("rk", "ik", "len", "width", F.explode(F.sequence("at", F.col("next") - 1)).alias("start"))


def leaks(docs: DataFrame, bench: DataFrame, percent: int = 80, radius: int = 19, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per document row and item that is found in it: row_key (a hash of id and text), id_col, item_col, start_word (of the
    most similar window, the first of equals, from 0) and similarity."""
    items = bench.select(F.col(f"`{item_col}`").alias("item"), words(F.lower(F.col("text"))).alias("w")).filter("size(w) > 0")
    items = written(items.select(F.xxhash64("w").alias("ik"), "item", "w").distinct(), "items")
    each = items.groupBy("ik").agg(F.count(F.lit(1)).alias("n_items"), F.first("w").alias("w")).select("ik", "n_items", F.size("w").alias("len"), F.least(F.size("w"), F.lit(WIDTH)).alias("width"), "w")
    own = None
    for k in range(1, WIDTH + 1):
        part = each.filter(F.col("width") == k).select("ik", "n_items", "len", "width", F.explode(shingles(F.col("w"), k)).alias("s"))
        own = part if own is None else own.union(part)
    own = written(own.groupBy("ik", "n_items", "len", "width", "s").agg(F.count(F.lit(1)).alias("c")), "shingles")
    used = [r[0] for r in own.select("width").distinct().collect()]  # five values at most
    weights = written(own.groupBy("s").agg(F.expr("greatest(1, 1000 div sum(n_items))").cast("long").alias("weight")), "weights")
    mine = written(own.join(weights, "s").select("ik", "len", "width", "s", "c", "weight"), "weighed")
    sums = mine.groupBy("ik").agg(F.sum(F.col("weight") * F.col("c")).alias("sum2"))

    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    keyed = src.select(F.xxhash64("id", "text").alias("rk"), "id", "text")
    if not used:
        return keyed.select(F.col("rk").alias("row_key"), F.col("id").alias(id_col), F.lit(None).cast(bench.schema[item_col].dataType).alias(item_col), F.lit(0).alias("start_word"), F.lit(0.0).alias("similarity")).limit(0)
    split = keyed.select("rk", words(F.lower("text")).alias("w"))
    found = None
    for k in used:
        index = small(mine.filter(F.col("width") == k).select("s", "ik", "len", "width", "weight"))
        one = split.select("rk", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "s")).join(index, "s").drop("s")
        found = one if found is None else found.unionByName(one)
    seeds = written(found.distinct(), "seeds")
    places = written(starts(seeds, sums, percent).select("rk", "start", "len", "width").distinct(), "places")

    at = small(places.groupBy("rk").agg(F.collect_list(F.struct("start", "len", "width")).alias("at")))  # of one text
    texts = keyed.join(at, "rk").dropDuplicates(["rk"]).select("rk", "at", words(F.lower("text")).alias("w"))
    cut = texts.select("rk", "w", F.explode("at").alias("x")).select("rk", "x.start", "x.len", "x.width", F.slice("w", F.col("x.start") + 1, F.col("x.len")).alias("w"))
    cut = written(cut.select("rk", "start", "len", "width", F.xxhash64("len", "w").alias("wk"), "w"), "windows")
    made = cut.groupBy("wk").agg(F.first("len").alias("len"), F.first("width").alias("width"), F.first("w").alias("w"))
    made = made.select("wk", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("width") + 1), lambda i: F.xxhash64(F.slice("w", i, F.col("width"))))).alias("s"))
    counted = made.groupBy("wk", "len", "s").agg(F.count(F.lit(1)).alias("c")).join(small(weights), "s", "left").withColumn("weight", F.coalesce("weight", F.lit(1000)).cast("long"))
    counted = written(counted, "counted")

    heavy = lambda d: d.withColumn("weight", F.col("weight") * F.col("c"))
    prints = fingerprints(heavy(counted), "wk").join(counted.select("wk", "len").distinct(), "wk")
    item_prints = fingerprints(heavy(mine), "ik").join(mine.select("ik", "len").distinct(), "ik")
    near = meetings(prints, item_prints.withColumnRenamed("print", "other"), ["len"], radius)
    pairs = written(near.select("wk", "ik").distinct(), "candidates")

    shared = pairs.join(counted.select("wk", "s", "weight", F.col("c").alias("c1")), "wk").join(small(mine.select("ik", "s", F.col("c").alias("c2"))), ["ik", "s"])
    shared = shared.groupBy("wk", "ik").agg(F.sum(F.col("weight") * F.least("c1", "c2")).alias("both"))
    sum1 = counted.groupBy("wk").agg(F.sum(F.col("weight") * F.col("c")).alias("sum1"))
    scored = shared.join(sum1, "wk").join(small(sums), "ik").withColumn("all", F.col("sum1") + F.col("sum2") - F.col("both")).filter(F.col("both") * 100 >= F.col("all") * percent)
    scored = written(scored.select("wk", "ik", (F.col("both") / F.col("all")).alias("similarity")), "scored")
    hits = cut.select("rk", "start", "wk").join(small(scored), "wk")
    best = hits.groupBy("rk", "ik").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("x"))
    best = best.join(small(items.select("ik", "item")), "ik")
    best = written(best.groupBy("rk", "item").agg(F.max("x").alias("x")).select("rk", "item", F.col("x.similarity").alias("similarity"), (-F.col("x.start")).cast("int").alias("start_word")), "found")
    ids = keyed.select("rk", "id").join(small(best), "rk")
    return ids.select(F.col("rk").alias("row_key"), F.col("id").alias(id_col), F.col("item").alias(item_col), "start_word", "similarity")


def filter_documents(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Documents without a benchmark item in them."""
    bad = small(leaks(docs, bench).select(F.col("row_key").alias("__leaking")).distinct())
    keyed = docs.alias("d").withColumn("__leak_key", F.xxhash64(F.col("d.doc_id"), F.col("d.text").cast("string")))
    return keyed.join(bad, F.col("__leak_key") == F.col("__leaking"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op5: documents that hold a benchmark item, with the window that is most like it."""
    out = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "item_id", "start_word", "similarity")


#: Every window of an item's length that shares a shingle with it (without one the similarity is 0), without SimHash.
SQL = rf"""
WITH i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{WS}+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (SELECT row_number() OVER () AS q, item_id, len(w) AS n, least(len(w), 5) AS k, w FROM i WHERE len(w) > 0),
ip AS (SELECT q, n, k, w, unnest(range(0, n - k + 1)) AS p FROM iw),
si AS (SELECT q, n, k, p, array_to_string(w[p + 1 : p + k], ' ') AS s FROM ip),
wt AS (SELECT s, greatest(1, 1000 // count(DISTINCT q)) AS wt FROM si GROUP BY s),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{WS}+'), lambda x: x <> '') AS w FROM documents),
dk AS (SELECT r, w, k FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k),
dp AS (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM dk),
sd AS (SELECT r, len(w) AS m, k, p, array_to_string(w[p + 1 : p + k], ' ') AS s FROM dp),
e AS (SELECT DISTINCT sd.r, sd.m, sd.k, sd.p, si.q, si.n FROM sd JOIN si USING (k, s)),
c AS (SELECT DISTINCT r, q, n, k, unnest(range(greatest(0, p - n + k), greatest(0, least(p, m - n)) + 1)) AS st FROM e),
a AS (SELECT c.r, c.q, c.st, sd.s, count(*) AS c1 FROM c JOIN sd ON sd.r = c.r AND sd.k = c.k AND sd.p BETWEEN c.st AND c.st + c.n - c.k GROUP BY ALL),
b AS (SELECT q, s, count(*) AS c2 FROM si GROUP BY ALL),
t AS (SELECT a.r, a.q, a.st, sum(coalesce(wt, 1000) * c1) AS s1, sum(coalesce(wt, 1000) * least(c1, coalesce(c2, 0))) AS bt
      FROM a LEFT JOIN b ON a.q = b.q AND a.s = b.s LEFT JOIN wt ON a.s = wt.s GROUP BY ALL),
u AS (SELECT q, sum(wt * c2) AS s2 FROM b JOIN wt USING (s) GROUP BY q),
v AS (SELECT r, q, st, bt / (s1 + s2 - bt) AS sim FROM t JOIN u USING (q) WHERE bt * 100 >= (s1 + s2 - bt) * 80),
z AS (SELECT r, item_id, st, sim, row_number() OVER (PARTITION BY r, item_id ORDER BY sim DESC, st) AS g FROM v JOIN iw USING (q))
SELECT doc_id, item_id, st::INTEGER AS start_word, sim AS similarity FROM z JOIN d USING (r) WHERE g = 1
"""
