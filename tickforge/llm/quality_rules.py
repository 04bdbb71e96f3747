"""Line-first quality rules, in DataFrame functions only.

Each line is judged alone: navigation (few words between separators), boilerplate (a phrase of the list), punctuation
(symbols or exclamation marks in place of sentences, or no end mark). Lines that fail go; a document that loses more than
``max_lost`` of its word characters, or that fails the base rules (too few words, too many repeated words), is rejected.

Null and empty texts have no words and fail the base rules. Texts of any length are judged whole. Repeated rows are judged
each for itself; ids may be null. Extra columns of any name pass untouched in ``filter_documents``. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import text_of, written

WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Phrases of boilerplate lines, lower case, in English, German, French and Spanish.
BOILERPLATE = (
    "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "lorem ipsum", "click here", "sign up for our newsletter", "enable cookies", "skip to content",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "hier klicken", "newsletter abonnieren", "zum inhalt springen",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "cliquez ici", "aller au contenu",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "haga clic aquí", "saltar al contenido",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_lost: float = 0.5
    max_symbol_share: float = 0.1
    max_shouts: float = 0.3
    separators: int = 2
    words_a_cell: int = 3


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WS}+"), "")


def line_fails(line: Column, r: Rules) -> Column:
    n_words = F.size(F.split(F.trim(line), f"{WS}+"))
    cells = F.regexp_count(line, F.lit(r"[|»›•·] ?"))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    navigation = (cells >= r.separators) & (n_words <= (cells + 1) * (r.words_a_cell + 1))
    noise = (symbols > r.max_symbol_share * F.length(line)) | (F.regexp_count(line, F.lit("!!")) > r.max_shouts * n_words)
    no_end = (n_words > 3) & ~F.rlike(line, F.lit(r"[.!?…:;。\"'”’)\]»]\s*$"))
    return navigation | noise | no_end | F.rlike(F.lower(line), F.lit("|".join(BOILERPLATE)))


def repeat_words(hashes: Column, window: int) -> Column:
    """Words covered by windows (given by their hashes, in order) that are found twice or more."""
    n = F.size(hashes)
    place = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    dup = F.filter(place, lambda x: F.lit(True))  # placeholder of the sorted windows, bound once below

    def covered(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        at = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False))), lambda j: F.get(s, j)["i"]))
        total = lambda a: F.aggregate(F.transform(a, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(a, k + 1) - x, F.lit(window)))), F.lit(0), lambda acc, x: acc + x)
        return F.get(F.transform(F.array(at), total), F.lit(0))

    return F.when(F.size(F.array_distinct(hashes)) == n, F.lit(0)).otherwise(F.get(F.transform(F.array(dup), covered), F.lit(0))).cast("long")


def judge(docs: DataFrame, rules: Rules | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_lines_removed, lost_share and clean_text (the lines left, joined by a line feed; null where there is none)."""
    r = rules or Rules()
    src = text_of(docs, *keep, id_col=id_col, text_col=text_col)
    own = [F.col(f"`{c}`") for c in (id_col, *keep)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    one = src.select(*own, words(text).alias("__w"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(NOT_WS))).alias("__l"))
    n = F.size("__w")
    two = one.select(
        *own,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(n < r.window, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - r.window + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("__w", i, r.window)))).alias("__h"),
        F.size("__l").cast("long").alias("n_lines"),
        F.filter("__l", lambda x: ~line_fails(x, r)).alias("__k"),
    )
    three = two.select(
        *own, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat_words(F.col("__h"), r.window).alias("n_repeat_words"), "n_lines",
        (F.col("n_lines") - F.size("__k")).alias("n_lines_removed"), F.array_join("__k", "\n").alias("clean_text"),
    )
    left = F.length(F.regexp_replace("clean_text", f"{WS}+", ""))
    failed = (F.col("n_words") < r.min_words) | (100 * F.col("n_repeat_words") > r.max_repeat_percent * F.col("n_words"))
    four = three.withColumn("base_failed", failed).withColumn("lost_share", F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(1.0)))
    return four.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= r.max_lost))


def filter_documents(docs: DataFrame, rules: Rules | None = None, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents kept, with their clean text; other columns as they are, but chars_col counts the new text."""
    cols = docs.columns
    rest = [c for c in cols if c != text_col]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(rest)], F.col(f"`{text_col}`").alias("__text"), F.lit(0).alias("__id"))
    out = written(judge(inner, rules, "__id", "__text", tuple(f"__c{i}" for i in range(len(rest)))).drop("__id"), "judged").filter("kept")
    back = {c: F.col(f"__c{i}") for i, c in enumerate(rest)} | {text_col: F.col("clean_text")}
    if chars_col in back:
        back[chars_col] = F.length("clean_text").cast(docs.schema[chars_col].dataType)
    return out.select(*[back[c].alias(c) for c in cols])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: figures of the base rules and the verdict of every document."""
    out = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed")


_PHRASES = "|".join(BOILERPLATE)
_WS = r"[\x20\x09-\x0D]"
SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{NOT_WS}')) AS l
  FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
grams AS (SELECT r, i, array_to_string(w[i : i + 4], ' ') AS g FROM win),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT r, sum(least(5, coalesce(nx - i, 5)))::BIGINT AS n
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM dup) GROUP BY r),
li AS (SELECT r, unnest(l) AS x FROM d),
lj AS (SELECT r, x, len(regexp_split_to_array(trim(x), '{_WS}+')) AS n,
              len(regexp_extract_all(x, '[|»›•·] ?')) AS cells, len(regexp_extract_all(x, '{SYMBOLS}')) AS sy,
              len(regexp_extract_all(x, '!!')) AS sh FROM li),
lk AS (SELECT r, x, (cells >= 2 AND n <= (cells + 1) * 4) OR sy > 0.1 * length(x) OR sh > 0.3 * n
              OR (n > 3 AND NOT regexp_matches(x, '[.!?…:;。"''”’)\]»]\s*$')) OR regexp_matches(lower(x), '{_PHRASES}') AS bad FROM lj),
la AS (SELECT r, count(*) AS n_lines, count(*) FILTER (bad) AS gone,
              coalesce(sum(length(regexp_replace(x, '{_WS}+', '', 'g'))) FILTER (NOT bad), 0) AS left_chars FROM lk GROUP BY r),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(la.n_lines, 0)::BIGINT AS n_lines,
             coalesce(la.gone, 0)::BIGINT AS n_lines_removed, coalesce(la.left_chars, 0) AS left_chars
      FROM d LEFT JOIN rep USING (r) LEFT JOIN la USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bf AS base_failed,
       NOT bf AND word_chars > 0 AND 1 - left_chars / word_chars <= 0.5 AS kept, n_lines, n_lines_removed
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS bf FROM f)
"""
