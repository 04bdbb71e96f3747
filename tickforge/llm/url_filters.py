"""URL filters with dated lists: a temporal list join.

A list's entry says that from a date on a domain (with its subdomains) or a URL prefix (host and whole path segments) is
added to or removed from the list. Entries of one list and value become validity intervals, each ending where the next
begins; a capture is evaluated against the intervals that hold its fetch date (an as-of join: equal keys, date within).
Equal captures are evaluated once, so a hot host costs its distinct URLs.

Hosts are lower-cased, in entries too, without user, port and final dot; the case of paths counts. Null or unreadable URLs,
and captures without a date, match nothing and are not blocked. Entries with a null in any column but action count for
nothing. Several entries of a list and value on one date: removal wins. Repeated captures each get their row. Extra columns
of any name pass; those named as the results give way to them. Empty tables give an empty result, empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import small, written

AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    authority = F.regexp_extract(url, AUTHORITY, 1)
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(authority, "^.*@", "")), r"(:[0-9]*)?$|\.(:[0-9]*)?$", ""), F.lit(""))


def keys_of(url: Column) -> Column:
    """The kinds and values by which an entry can match: the host and its parent domains; host and path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("domain "), F.array_join(F.slice(labels, i, n), ".")))
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.concat(F.lit("prefix "), host, F.array_join(F.transform(F.slice(steps, F.lit(1), k), lambda x: F.concat(F.lit("/"), x)), "")))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, prefixes))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """entries(list, kind, value, action, day) as (list, key, since, until) of the times a value is on a list."""
    slash = F.locate("/", F.col("value"))
    value = F.when((F.col("kind") == "prefix") & (slash > 0), F.concat(F.lower(F.substring("value", F.lit(1), slash)), F.substring("value", slash + 1, F.length("value")))).otherwise(F.lower("value"))
    day = entries.groupBy("list", "kind", value.alias("value"), "day").agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("gone"))
    until = F.lead("day").over(W.partitionBy("list", "kind", "value").orderBy("day"))
    spans = day.filter("list is not null and kind is not null and value is not null and day is not null").withColumn("until", until).filter("gone = 0")
    return spans.select("list", F.concat_ws(" ", "kind", "value").alias("key"), F.col("day").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetched") -> DataFrame:
    """captures with blocked, n_matches and matches (list and key of each active entry, sorted, joined by commas)."""
    src = captures.alias("c")
    url, day = F.col(f"c.`{url_col}`"), F.col(f"c.`{day_col}`")
    spans = written(intervals(entries), "intervals")
    listed = small(spans.select("key").distinct())  # keys that no list has (a top-level domain) go before the shuffle
    once = src.select(url.alias("u"), day.alias("d")).filter("u is not null and d is not null").distinct()
    asked = once.select("u", "d", F.explode(keys_of(F.col("u"))).alias("key")).join(listed, "key", "left_semi")
    active = asked.join(spans, "key").filter("d >= since and (until is null or d < until)")
    found = active.groupBy(F.col("u").alias("__u"), F.col("d").alias("__d")).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "list", "key"))), ",").alias("__matches"), F.countDistinct("list", "key").alias("__n"))
    out = src.join(found, (url == F.col("__u")) & (day == F.col("__d")), "left")
    keep = [F.col(f"c.`{c}`") for c in captures.columns if c not in ("blocked", "n_matches", "matches")]
    return out.select(*keep, F.col("__n").isNotNull().alias("blocked"), F.coalesce("__n", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("__matches", F.lit("")).alias("matches"))


def production_entries(pages: DataFrame) -> DataFrame:
    """The tables have no lists, so the query's come from a rule over the pages' own hosts: about a fourth of the domains
    are added to a list at a date, half of those are removed 60 days later; so are some first path segments."""
    key = pages.select(F.explode(keys_of(F.col("url"))).alias("key")).distinct()
    parts = key.select(F.substring_index("key", " ", 1).alias("kind"), F.expr("substring(key, 8)").alias("value"))
    parts = parts.filter("length(value) - length(replace(value, '/', '')) <= 1").withColumn("a", F.conv(F.substring(F.md5("value"), 1, 6), 16, 10).cast("long")).filter("a % 4 = 0 and value like '%.%.%'")
    day = lambda shift: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("a") % 200 + shift).cast("int"))
    name = F.when(F.col("a") % 3 == 0, "spam").otherwise("adult").alias("list")
    added = parts.select(name, "kind", "value", F.lit("add").alias("action"), day(0).alias("day"))
    return added.union(parts.filter("a % 8 = 0").select(name, "kind", "value", F.lit("remove").alias("action"), day(60).alias("day")))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every page's URL against the dated lists at its fetch date (which the tables lack: 2024, by page_id)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")))
    return filter_urls(captures, production_entries(pages)).withColumn("fetched", F.col("fetched").cast("string"))


SQL = r"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + (page_id * 37 % 366)::INTEGER AS fetched,
                  nullif(regexp_replace(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')), '(:[0-9]*)?$|\.(:[0-9]*)?$', ''), '') AS host,
                  list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS st
           FROM pages),
h AS (SELECT page_id, url, fetched, host, string_split(host, '.') AS lb, st FROM p WHERE host IS NOT NULL),
k AS (SELECT page_id, url, fetched, unnest(list_distinct(list_concat(
        list_transform(range(1, len(lb) + 1), lambda i: 'domain ' || array_to_string(lb[i:], '.')),
        list_transform(range(0, len(st) + 1), lambda i: 'prefix ' || host || array_to_string(list_transform(st[1:i], lambda x: '/' || x), ''))))) AS key FROM h),
v AS (SELECT DISTINCT split_part(key, ' ', 1) AS kind, key, substr(key, 8) AS value FROM k),
a AS (SELECT kind, value, ('0x' || substr(md5(value), 1, 6))::BIGINT AS a FROM v WHERE length(value) - length(replace(value, '/', '')) <= 1 AND value LIKE '%.%.%'),
e AS (SELECT CASE WHEN a % 3 = 0 THEN 'spam' ELSE 'adult' END AS list, CASE WHEN kind = 'domain' OR instr(value, '/') = 0 THEN kind || ' ' || lower(value) ELSE kind || ' ' || lower(split_part(value, '/', 1)) || substr(value, instr(value, '/')) END AS key, DATE '2024-01-01' + (a % 200)::INTEGER AS since,
             CASE WHEN a % 8 = 0 THEN DATE '2024-01-01' + (a % 200 + 60)::INTEGER END AS until FROM a WHERE a % 4 = 0),
f AS (SELECT DISTINCT page_id, url, list, k.key FROM k JOIN e ON k.key = e.key AND fetched >= since AND (until IS NULL OR fetched < until)),
g AS (SELECT page_id, url, count(*) AS n, string_agg(list || ' ' || key, ',' ORDER BY list || ' ' || key) AS matches FROM f GROUP BY ALL)
SELECT p.page_id, p.url, strftime(p.fetched, '%Y-%m-%d') AS fetched, n IS NOT NULL AS blocked, coalesce(n, 0)::BIGINT AS n_matches, coalesce(matches, '') AS matches
FROM p LEFT JOIN g ON p.page_id = g.page_id AND p.url = g.url
"""
