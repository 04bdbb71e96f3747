"""Line dedup with a segment-partition edit join, in DataFrame functions only.

A line goes if an equal line stands earlier (by id, then line number), or if a line within the edits allowed does. Lines
are compared without surrounding white space, equal ones at any length. Edits are allowed by the share of the shorter
line's length: all ``edits`` from ``min_edit_chars`` code points on, in proportion fewer below, rounded down. Equal lines
meet by a 128-bit hash; only the first of them goes on. It is split into one segment more than it is allowed edits: a line
within that distance has one of them whole, at a place that the lengths and the segment's number narrow down. Keys of length, segment number and
content are joined, and pairs that meet are verified with a bit-parallel edit distance over a band of 2 * edits + 1
diagonals, kept in the bits of one integer. Counts of 24 characters are compared first: an edit changes two at most.

Null texts stay null, empty ones empty; blank lines stay. Rows that share an id are one document of which each row keeps
the line numbers kept. Null ids come before all others. Ties: of equal lines the first in order stays. Extra columns of any
name pass; those named as the results give way to them. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import small, text_of, written

TRIM = " \t\r\x0b\x0c"


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(difference of lengths, segment, shift) of the substrings that must be looked up; (0, i, 0) are the segments."""
    return [(d, i, s) for d in range(edits + 1) for i in range(edits + 1) for s in range(max(-i, d - (edits - i)), min(i, d + edits - i) + 1)]


def allowed(length: Column, edits: int, min_edit_chars: int) -> Column:
    """How many edits a pair may have whose shorter line is so long."""
    return F.greatest(F.lit(0), F.least(F.lit(edits), F.floor(length * edits / min_edit_chars).cast("int")))


def segment_key(line: Column, length: Column, most: Column, edits: int, d: int, i: int, shift: int) -> Column:
    """most: the edits allowed at the shorter line's length, length - d; null where a pair of so many has no such probe."""
    n = length - d
    fits = [k for k in range(1, edits + 1) if (d, i, shift) in probes(k)]
    base = F.floor(n / (most + 1)).cast("int")
    first_long = (most + 1) - (n - base * (most + 1))
    begin = base * i + F.greatest(F.lit(0), F.lit(i) - first_long)
    size = base + (F.lit(i) >= first_long).cast("int")
    at = begin + shift
    return F.when(most.isin(fits) & (at >= 0) & (at + size <= length), F.xxhash64(n.cast("int"), F.lit(i), F.substring(line, at + 1, size)))


def band_step(eq: int, vp: int, vn: int, edits: int) -> tuple[int, int, int]:
    """One row of the band: which cells' characters agree, and the vertical differences; the next row's differences (moved
    along the diagonal), and by how much the last diagonal's distance grows."""
    width = 2 * edits + 1
    ones = (1 << width) - 1
    d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & ones
    hp, hn = vn | (~(d0 | vp) & ones), d0 & vp
    return (hn | ~((d0 >> 1) | hp)) & ones, (d0 >> 1) & hp, int(not d0 >> (width - 1))


@lru_cache
def band_table(edits: int) -> tuple[list[int], list[tuple[int, int]]]:
    """All steps from the states that can be reached: entry state * 2**width + eq holds 2 * next state + growth. The
    first state is the one before the first row."""
    width = 2 * edits + 1
    states = [((1 << width) - (1 << edits), 0)]
    table: list[int] = []
    for vp, vn in states:  # grows meanwhile
        for eq in range(1 << width):
            *after, growth = band_step(eq, vp, vn, edits)
            if tuple(after) not in states:
                states.append(tuple(after))
            table.append(2 * states.index(tuple(after)) + growth)
    return table, states


def within(a: Column, b: Column, edits: int, most: Column) -> Column:
    """Whether strings, of which b has 0 to ``edits`` characters more than a, are within ``most`` edits, ``edits`` at most.

    Row j of the table is b's j-th character; bit x of the band is the cell of a's character j - edits + x. The steps of
    the bit-parallel recurrence come from a table by state, and what is carried is 256 * distance + state. The
    distance of the whole strings is reached by walking up the last row's vertical differences."""
    width = 2 * edits + 1
    table, states = band_table(edits)
    steps = F.array(*[F.lit(x) for x in table])
    ups = []
    for vp, vn in states:  # by how much to correct for 0 to 2 * edits cells walked up
        bits = lambda v, n: bin((v >> (width - 1 - n)) & ((1 << n) - 1)).count("1")
        ups += [bits(vn, n) - bits(vp, n) for n in range(width)]
    wide = 1 << (len(states) - 1).bit_length()

    def body(x: Column) -> Column:
        p, t = x["p"], x["t"]
        m, n = F.size(p), F.size(t)

        def step(acc: Column, j: Column) -> Column:
            eq = F.lit(0)
            for k in range(width):
                eq = eq + F.when(F.get(p, j + (k - edits)).eqNullSafe(F.get(t, j)), F.lit(1 << k)).otherwise(F.lit(0))
            move = F.get(steps, acc.bitwiseAND(F.lit(wide - 1)) * (1 << width) + eq)
            return F.get(F.transform(F.array(move), lambda y: acc - acc.bitwiseAND(F.lit(wide - 1)) + F.call_function("shiftright", y, F.lit(1)) + y.bitwiseAND(F.lit(1)) * wide), F.lit(0))

        end = F.aggregate(F.slice(F.sequence(F.lit(0), n), 1, n), F.lit(edits * wide), step)
        fix = lambda s: F.call_function("shiftright", s, F.lit((wide - 1).bit_length())) + F.get(F.array(*[F.lit(u) for u in ups]), s.bitwiseAND(F.lit(wide - 1)) * width + (F.lit(edits) + n - m))
        return F.get(F.transform(F.array(end), fix), F.lit(0))

    return most >= F.get(F.transform(F.array(F.struct(F.array_remove(F.split(a, ""), "").alias("p"), F.array_remove(F.split(b, ""), "").alias("t"))), body), F.lit(0))


def cut_ends(pairs: DataFrame, step: int = 32) -> DataFrame:
    """Pairs without the whole steps of characters that x and y share at their begins, then at their ends; what is left has
    the same edit distance."""
    same = lambda at_x, at_y: F.substring("x", at_x, F.lit(step)) == F.substring("y", at_y, F.lit(step))
    for front in (True, False):
        n, m = F.length("x"), F.length("y")
        last = F.floor(n / step).cast("int") - 1
        equal = F.transform(F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last)), lambda i: same(i * step + 1, i * step + 1) if front else same(n - (i + 1) * step + 1, m - (i + 1) * step + 1))  # noqa: B023
        found = F.array_position(equal, False)
        pairs = written(pairs.select("*", (step * F.when(found == 0, F.size(equal)).otherwise(found - 1)).cast("int").alias("cut")), "cut")
        pairs = pairs.select("h", "most", *[(F.substring(c, F.col("cut") + 1, F.length(c)) if front else F.substring(c, F.lit(1), F.length(c) - F.col("cut"))).alias(c) for c in ("x", "y")])
    return written(pairs, "cut")


def trimmed(c: Column) -> Column:
    """c without white space around it; most lines have none, which two looks at the ends tell."""
    edge = reduce(lambda x, y: x | y, [f(c, F.lit(t)) for t in TRIM for f in (F.startswith, F.endswith)])
    return F.when(edge, F.trim(c, F.lit(TRIM))).otherwise(c)


#: Letters of which a line's numbers are compared before its characters are.
LETTERS = ("abcdefgh", "iklmnopr", "stuvwy.,")


def letter_counts(line: Column, letters: str) -> Column:
    """Eight bits for each letter: how often it occurs, 255 at most. An edit changes all counts by two altogether."""
    out = F.lit(0).cast("long")
    for k, c in enumerate(letters):
        out = out + F.call_function("shiftleft", F.least(F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))), F.lit(255 if k < 7 else 127)).cast("long"), F.lit(8 * k))
    return out


def count_distance(a: str, b: str) -> Column:
    field = lambda v, k: F.call_function("shiftright", F.col(v), F.lit(8 * k)).bitwiseAND(F.lit(255))
    return reduce(lambda x, y: x + y, [F.abs(field(f"{a}.c{g}", k) - field(f"{b}.c{g}", k)) for g, of in enumerate(LETTERS) for k in range(len(of))])


def verified(pairs: DataFrame, text: DataFrame, edits: int, min_edit_chars: int) -> DataFrame:
    """Of (early, late) hashes of lines, the late ones whose line is within the edits allowed of the early one's."""
    both = pairs.join(text.select(F.col("h").alias("early"), F.col("line").alias("l")), "early").join(text.select(F.col("h").alias("late"), F.col("line").alias("r")), "late")
    longer = F.length("r") >= F.length("l")
    both = both.select(F.col("late").alias("h"), F.when(longer, F.col("l")).otherwise(F.col("r")).alias("x"), F.when(longer, F.col("r")).otherwise(F.col("l")).alias("y"))
    both = both.withColumn("most", allowed(F.length("x"), edits, min_edit_chars))
    return written(cut_ends(both).filter(within(F.col("x"), F.col("y"), edits, F.col("most"))).select("h").distinct(), "near")


def first_lines(docs: DataFrame, edits: int, min_edit_chars: int) -> tuple[DataFrame, DataFrame]:
    """(lines, near): the first of equal lines (doc, pos, h), and of them (h) those to remove.

    Of the keys, only those go on that an indexed and another line have; their lines alone are read and counted by letters.
    A group of lines that are all alike must not make a pair of every two: each line meets the first line of its keys
    before, and only those that this did not remove look for other earlier lines."""
    lines = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).select("doc", "pos", trimmed(F.col("raw")).alias("line"))
    lines = lines.withColumn("len", F.length("line")).filter(F.col("len") > 0)
    todo = probes(edits)
    # the keys stand in no condition: there, common parts would be computed anew for each, in code too long to be compiled
    lines = lines.select("*", *[allowed(F.col("len") - d, edits, min_edit_chars).alias(f"most{d}") for d in range(edits + 1)])
    keys = F.array(*[segment_key(F.col("line"), F.col("len"), F.col(f"most{x[0]}"), edits, *x) for x in todo])
    slim = lines.select("doc", "pos", "len", F.unhex(F.md5("line")).alias("h"), keys.alias("keys"))
    firsts = slim.groupBy("h").agg(F.min(F.struct("doc", "pos")).alias("at"), F.first("len").alias("len"), F.first("keys").alias("keys"))
    firsts = written(firsts.select("h", F.col("at.doc").alias("doc"), F.col("at.pos").alias("pos"), F.when(allowed(F.col("len"), edits, min_edit_chars) > 0, F.col("keys")).alias("keys")), "firsts")

    own = [k for k, x in enumerate(todo) if x[0] == 0 and x[2] == 0]
    each = firsts.filter("keys is not null").select("h", "doc", "pos", F.posexplode("keys").alias("probe", "key")).filter("key is not null").withColumn("own", F.col("probe").isin(own))
    shared = written(each.groupBy("key").agg(F.max("own").alias("own"), F.count(F.lit(1)).alias("n")).filter("own and n > 1").select("key"), "shared")
    hits = written(each.join(small(shared), "key").select("key", "h", "doc", "pos", "own"), "hits")

    mine = small(written(hits.select("h", "doc", "pos").distinct().groupBy("doc").agg(F.collect_list(F.struct("pos", "h")).alias("at")), "need").withColumnRenamed("doc", "d2"))
    text = docs.join(mine, F.col("doc").eqNullSafe(F.col("d2"))).select(F.split("text", "\n").alias("l"), "at")
    text = text.select(F.inline(F.transform("at", lambda x: F.struct(x["h"].alias("h"), F.get("l", x["pos"]).alias("line"))))).select("h", trimmed(F.col("line")).alias("line")).filter(F.unhex(F.md5("line")) == F.col("h")).dropDuplicates(["h"])
    text = written(text, "texts")
    counts = [letter_counts(F.col("line"), of).alias(f"c{g}") for g, of in enumerate(LETTERS)]
    facts = written(text.select("h", F.length("line").alias("len"), *counts), "facts")
    hits = written(hits.select("key", "own", "h", F.struct("doc", "pos", "h").alias("at")).join(small(facts), "h"), "hits")

    close = count_distance("a", "b") <= 2 * allowed(F.least("a.len", "b.len"), edits, min_edit_chars)
    heads = hits.filter("own").groupBy("key").agg(F.min_by(F.struct("at", "len", "c0", "c1", "c2"), "at").alias("head")).select("key", "head.*")
    met = hits.alias("a").join(heads.alias("b"), "key").filter((F.col("b.at") < F.col("a.at")) & close)
    near = verified(written(met.select(F.col("b.at.h").alias("early"), F.col("a.h").alias("late")).distinct(), "pairs"), text, edits, min_edit_chars)

    left = hits.join(small(near.withColumn("gone", F.lit(True))), "h", "left")
    late = F.when(F.col("a.at") < F.col("b.at"), F.col("b.gone")).otherwise(F.col("a.gone"))
    once = (F.col("a.len") != F.col("b.len")) | (F.col("a.h") < F.col("b.h"))  # lines of one length meet from both sides
    met = left.alias("a").join(left.filter("own").alias("b").hint("shuffle_hash"), "key").filter((F.col("a.h") != F.col("b.h")) & once & late.isNull() & close)
    pairs = met.select(F.least("a.at", "b.at").getField("h").alias("early"), F.greatest("a.at", "b.at").getField("h").alias("late")).distinct()
    return firsts.select("doc", "pos", "h"), near.union(verified(written(pairs, "pairs"), text, edits, min_edit_chars))


def _deduped(docs: DataFrame, edits: int, min_edit_chars: int, id_col: str, text_col: str) -> DataFrame:
    """c0, c1, ... (the columns of docs), __text (cleaned), __n (lines) and __gone (lines removed)."""
    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    firsts, near = first_lines(src, edits, min_edit_chars)
    kept = firsts.join(near, "h", "left_anti")
    kept = written(kept.groupBy("doc").agg(F.collect_set("pos").alias("__keep")), "kept").withColumnRenamed("doc", "__doc")
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    the_id, the_text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    joined = own.join(kept, the_id.eqNullSafe(F.col("__doc")), "left")
    lines = joined.select(*own.columns, F.split(the_text, "\n").alias("__l"), F.coalesce("__keep", F.array().cast("array<int>")).alias("__keep"))
    blank = F.filter(F.transform("__l", lambda x, i: F.when(trimmed(x) == "", i)), lambda i: i.isNotNull())
    lines = lines.select(*own.columns, "__l", F.sort_array(F.array_union(blank, "__keep")).alias("__at"))
    text = F.when(F.size("__at") == F.size("__l"), the_text).otherwise(F.array_join(F.filter(F.transform("__at", lambda i: F.get("__l", i)), lambda x: x.isNotNull()), "\n"))
    return lines.select(*own.columns, text.alias("__text"), F.coalesce(F.size("__l"), F.lit(0)).cast("long").alias("__n"), F.greatest(F.size("__l") - F.size("__at"), F.lit(0)).cast("long").alias("__gone"))


def dedup_lines(docs: DataFrame, edits: int = 2, min_edit_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col cleaned, and n_lines and n_lines_removed behind the columns (in place of columns of those names)."""
    out = _deduped(docs, edits, min_edit_chars, id_col, text_col)
    cols = [(F.col("__text") if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns) if c not in ("n_lines", "n_lines_removed")]
    return out.select(*cols, F.col("__n").alias("n_lines"), F.col("__gone").alias("n_lines_removed"))


def filter_documents(docs: DataFrame, most_lost: float = 0.5, min_words: int = 10, chars_col: str = "n_chars") -> DataFrame:
    """The pipeline's stage: repeated lines go. A document that would lose more than ``most_lost`` of its characters, or be
    left with fewer than ``min_words`` words, stays as it is: it is a copy of others as a whole, which a stage that compares
    documents can tell only from its whole text, and of which this stage would leave a fragment."""
    out = _deduped(docs, 2, 40, "doc_id", "text")
    text = F.col(f"c{docs.columns.index('text')}")
    n_words = F.size(F.array_remove(F.split("__text", r"[\x20\x09-\x0D]+"), ""))
    whole = (F.col("__gone") > 0) & ((F.length("__text") < (1 - most_lost) * F.length(text)) | (n_words < min_words))
    out = out.withColumn("__clean", F.when(whole, text).otherwise(F.col("__text")))
    kept = [F.length("__clean").cast(docs.schema[c].dataType).alias(c) if c == chars_col else (F.col("__clean") if c == "text" else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    return out.select(*kept)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: lines that equal an earlier one, or are within two edits of it, are removed."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_lines_removed", F.sha2("text", 256).alias("kept_sha256"))
