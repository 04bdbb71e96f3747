"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions only.

Leaves are (domain, lang, source). A leaf can give ``max_epochs`` times its tokens. From the top down a node's budget is
shared among its children by weight; a child whose subtree has less than its share gives all it has, and its brothers take
up the rest by their weights. A node's budget never exceeds what its subtree has, so a shortage is met by brothers first
and only then by the brothers of an ancestor. A leaf gives whole epochs, and of one more the longest prefix, in an order
seeded by epoch and id, whose tokens fit. Prefix sums go over 4,096 ranges of that order first, so that rows are put in
order only inside the one range where a leaf's prefix ends.

Null lang or source count as 'unknown'. Null and empty texts have no tokens and are never chosen. Repeated rows count each
for itself; ties in the order (equal ids) go by tokens, then by a hash of the text. Null ids are allowed. Extra columns of
any name pass in ``mix_documents``. An empty table gives an empty result. Tokens are words; sums must stay below
2**63 / 10**5. Leaves are few beside rows: the sources of one domain and language meet in one task of the plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import small, written
from .quality_rules import WS, words

LEVELS = ("domain", "lang", "source")
#: Weights in production, in relative whole numbers; names that are not listed have weight 10.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"web": 60, "curated": 40}, "lang": {"en": 50, "de": 20, "fr": 20, "es": 10}, "source": {"src0": 20}}
PERCENT, MAX_EPOCHS, SEED = 60, 3, 7


def domain_of(source: Column) -> Column:
    """The production rule: sources with short names are the web crawl's."""
    return F.when(F.length(source) <= 4, "web").otherwise("curated")


def weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(10)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def share(children: DataFrame, parents: list[str]) -> DataFrame:
    """children: parents, a name, cap, weight and budget (of the parent). Adds alloc."""
    name = children.columns[len(parents)]
    part = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    line = part.orderBy(F.col("cap") / F.col("weight"), name)
    before = F.coalesce(F.sum("cap").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(line.rowsBetween(0, W.unboundedFollowing))
    out = children.withColumn("before", before).withColumn("rest", rest)
    out = out.withColumn("sated", F.col("cap") * F.col("rest") <= (F.col("budget") - F.col("before")) * F.col("weight"))
    first_before = F.min(F.when(~F.col("sated"), F.col("before"))).over(part)
    first_rest = F.max(F.when(~F.col("sated"), F.col("rest"))).over(part)
    out = out.withColumn("p", first_before).withColumn("w", first_rest)
    alloc = F.when(F.col("p").isNull() | (F.col("sated") & (F.col("before") < F.col("p"))), F.col("cap")).otherwise(F.expr("((budget - p) * weight) div w"))
    return out.withColumn("alloc", F.least(alloc, F.col("cap"))).drop("before", "rest", "sated", "p", "w", "budget")


def budgets(leaves: DataFrame, total: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """leaves: LEVELS and tokens. Adds alloc, the tokens that a leaf is to give; total is an aggregate over leaves."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    top = caps.agg(total.alias("budget"), F.sum("cap").alias("all")).select(F.least("budget", "all").alias("budget"))
    nodes = None
    for depth, level in enumerate(LEVELS):
        kids = caps.groupBy(*LEVELS[: depth + 1]).agg(F.sum("cap").alias("cap")).withColumn("weight", weight(level, weights))
        kids = kids.crossJoin(F.broadcast(top)) if nodes is None else kids.join(nodes, list(LEVELS[:depth]))  # one row
        nodes = share(kids, list(LEVELS[:depth])).select(*LEVELS[: depth + 1], F.col("alloc").alias("budget"))
    return leaves.join(nodes.withColumnRenamed("budget", "alloc"), list(LEVELS))


def dealt(rows: DataFrame, facts: DataFrame, percent: int, max_epochs: int, seed: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """rows with epochs above 0. rows: LEVELS, id, n_tokens, tie (a hash that tells rows apart) and any more; facts: the
    same rows' LEVELS, id and n_tokens alone, kept in a table."""
    leaves = facts.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = budgets(leaves, F.expr(f"sum(tokens) * {int(percent)} div 100"), weights, max_epochs)
    plan = plan.withColumn("whole", F.expr("alloc div tokens")).withColumn("left", F.col("alloc") - F.col("whole") * F.col("tokens"))
    plan = written(plan.select(*LEVELS, "whole", "left"), "plan")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    put = lambda d, p: d.join(small(p), list(LEVELS)).withColumn("place", place).withColumn("range", F.substring("place", 1, 3))
    sums = put(facts, plan).groupBy(*LEVELS, "range", "left").agg(F.sum("n_tokens").alias("n"))
    upto = sums.withColumn("end", F.sum("n").over(W.partitionBy(*LEVELS).orderBy("range"))).withColumn("begin", F.col("end") - F.col("n"))  # 4,096 rows a leaf at most
    inside = (F.col("end") > F.col("left")) & (F.col("begin") < F.col("left"))
    ends = upto.groupBy(*LEVELS).agg(F.max(F.when(F.col("end") <= F.col("left"), F.col("range"))).alias("full"), F.min(F.when(inside, F.col("range"))).alias("cut"), F.min(F.when(inside, F.col("begin"))).alias("begin"))
    plan = written(plan.join(ends, list(LEVELS)), "ends")  # a row a leaf: the last range that is whole, and the one that is not
    met = put(rows, plan)
    whole = met.filter("cut is null or range <> cut").withColumn("epochs", F.col("whole") + (F.col("range") <= F.coalesce("full", F.lit(""))).cast("long"))
    run = F.sum("n_tokens").over(W.partitionBy(*LEVELS, "range").orderBy("place", "id", "n_tokens", "tie").rowsBetween(W.unboundedPreceding, 0))
    cut = met.filter("range = cut")
    cut = cut.withColumn("epochs", F.col("whole") + (F.col("begin") + run <= F.col("left")).cast("long"))
    return whole.unionByName(cut).filter("epochs > 0")


def _named(tokens: Column | None, id_col: str) -> list[Column]:
    named = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("unknown"))
    n = F.size(words(F.col("text"))).cast("long") if tokens is None else tokens
    return [F.col(f"`{id_col}`").alias("id"), domain_of(named("source")).alias("domain"), named("lang").alias("lang"), named("source").alias("source"), n.alias("n_tokens"), F.xxhash64("text").alias("tie")]


def choose(docs: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Mapping[str, Mapping[str, int]] | None = None, tokens: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """The rows chosen: id, domain, lang, source, n_tokens and epochs (how many times the row is used). The budget is
    ``percent`` of all tokens."""
    rows = written(docs.select(*_named(tokens, id_col)).filter("n_tokens > 0"), "tokens")
    out = dealt(rows, rows, percent, max_epochs, seed, WEIGHTS if weights is None else weights)
    return out.select(F.col("id").alias(id_col), *LEVELS, "n_tokens", "epochs")


def mix_documents(docs: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Mapping[str, Mapping[str, int]] | None = None, tokens: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """The chosen documents, all columns, and epochs (in place of a column of that name). Every row is judged as itself: the
    same rows as in ``choose``, also where rows repeat."""
    keep = [c for c in docs.columns if c != "epochs"]
    base = docs.select(*_named(tokens, id_col), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("row"))
    facts = written(base.select("id", *LEVELS, "n_tokens", "tie").filter("n_tokens > 0"), "tokens")
    out = dealt(base.filter("n_tokens > 0"), facts, percent, max_epochs, seed, WEIGHTS if weights is None else weights)
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], "epochs")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: documents chosen to meet the production weights with 60 % of all tokens."""
    return choose(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _weight_sql(level: str) -> str:
    return "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items()) + " ELSE 10 END"


def _share_sql(name: str, level: str, parents: tuple[str, ...], source: str) -> str:
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    keys = ", ".join((*parents, level))
    return f"""
{name}_o AS (SELECT *, coalesce(sum(cap) OVER ({part} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
  sum(weight) OVER ({part} ORDER BY cap / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rst FROM ({source})),
{name}_s AS (SELECT *, cap * rst <= (budget - bef) * weight AS sated FROM {name}_o),
{name}_f AS (SELECT *, min(CASE WHEN NOT sated THEN bef END) OVER ({part}) AS p, max(CASE WHEN NOT sated THEN rst END) OVER ({part}) AS w FROM {name}_s),
{name} AS (SELECT {keys}, least(cap, CASE WHEN p IS NULL OR (sated AND bef < p) THEN cap ELSE ((budget - p) * weight) // w END) AS budget FROM {name}_f)"""


SQL = rf"""
WITH rows AS (
  SELECT doc_id, CASE WHEN length(coalesce(source, 'unknown')) <= 4 THEN 'web' ELSE 'curated' END AS domain, coalesce(lang, 'unknown') AS lang,
         coalesce(source, 'unknown') AS source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{WS}+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM documents),
r AS (SELECT * FROM rows WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {MAX_EPOCHS} AS cap FROM r GROUP BY ALL),
top AS (SELECT least(sum(tokens) * {PERCENT} // 100, sum(cap)) AS budget FROM leaves),
{_share_sql("a", "domain", (), f"SELECT domain, sum(cap) AS cap, {_weight_sql('domain')} AS weight, any_value(top.budget) AS budget FROM leaves, top GROUP BY domain").lstrip()},
{_share_sql("b", "lang", ("domain",), f"SELECT domain, lang, cap, weight, budget FROM (SELECT domain, lang, sum(cap) AS cap, {_weight_sql('lang')} AS weight FROM leaves GROUP BY ALL) JOIN a USING (domain)").lstrip()},
{_share_sql("c", "source", ("domain", "lang"), f"SELECT domain, lang, source, cap, weight, budget FROM (SELECT domain, lang, source, cap, {_weight_sql('source')} AS weight FROM leaves) JOIN b USING (domain, lang)").lstrip()},
plan AS (SELECT domain, lang, source, (budget // tokens)::BIGINT AS whole, (budget - budget // tokens * tokens)::BIGINT AS lft FROM leaves JOIN c USING (domain, lang, source)),
d AS (SELECT r.*, whole, lft, md5(concat('{SEED}:', whole, ':', doc_id)) AS place FROM r JOIN plan USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= lft THEN 1 ELSE 0 END)::BIGINT AS epochs
FROM s WHERE whole > 0 OR upto <= lft
"""
