"""Registered queries without SQL, and the whole pipeline, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_edges import likeness, plain_mix

import corpus_pipeline
from tickforge.llm import line_dedup, ngram_jaccard, quality_rules, registry, substring_dedup

DIR = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
TRIM = " \t\r\x0b\x0c"


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def documents():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()]


def shingle_set(t):
    w = [x.translate({k: k + 32 for k in range(65, 91)}) for x in words(t)]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(sets):
    """The smallest id connected by similarity, of each id."""
    label = {k: k for k in sets}
    root = lambda k: k if label[k] == k else root(label[k])
    by = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            by[g].append(k)
    pairs = {(a, b) for ks in by.values() for i, a in enumerate(ks) for b in ks[:i] if a != b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            label[b] = a
    return {k: root(k) for k in sets}


def within(a, b, most):
    if abs(len(a) - len(b)) > most:
        return False
    if most == 0:
        return a == b
    if sum((Counter(a) - Counter(b)).values()) > most or sum((Counter(b) - Counter(a)).values()) > most:
        return False
    line = {j: j for j in range(min(len(b), most) + 1)}
    for i in range(1, len(a) + 1):
        now = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            now[j] = i if j == 0 else min(now.get(j - 1, 99) + 1, line.get(j, 99) + 1, line.get(j - 1, 99) + (a[i - 1] != b[j - 1]))
        line = now
        if min(line.values()) > most:
            return False
    return line.get(len(b), 99) <= most


def removed_lines(rows):
    """rows: (id, text). Line numbers that go, by id (repeated rows of an id have the same text)."""
    seen, by_length, gone = set(), defaultdict(list), defaultdict(set)
    done = set()
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if k in done:
            continue
        done.add(k)
        for i, raw in enumerate((t or "").split("\n") if t is not None else []):
            x = raw.strip(TRIM)
            if not x:
                continue
            if x in seen or any(within(x, y, min(2, min(len(x), len(y)) // 20)) for n in range(len(x) - 2, len(x) + 3) for y in by_length[n]):
                gone[k].add(i)
            if x not in seen:
                seen.add(x)
                by_length[len(x)].append(x)
    return gone


def test_op1_query(spark):
    sets = {k: shingle_set(t) for k, t in documents()}
    label = groups(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.queries()["op1_ngram_jaccard"](spark, DIR).collect()}
    assert got == {k: (len(s), label[k]) for k, s in sets.items()} and len(set(label.values())) < len(label)


def test_op6_query(spark):
    split = {k: words(t) for k, t in documents()}
    count = Counter(tuple(w[i : i + 35]) for w in split.values() for i in range(len(w) - 34))
    want = {}
    for k, w in split.items():
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want[k] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in registry.queries()["op6_substring_dedup"](spark, DIR).collect()}
    assert got == want and any(x[1] for x in want.values())


def test_op10_query(spark):
    rows = documents()
    gone = removed_lines(rows)
    want = {k: (0, 0, None) if t is None else (t.count("\n") + 1, len(gone[k]), hashlib.sha256("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]).encode()).hexdigest()) for k, t in rows}
    got = {r.doc_id: (r.n_lines, r.n_lines_removed, r.kept_sha256) for r in registry.queries()["op10_line_dedup"](spark, DIR).collect()}
    assert got == want


def judged(t):
    """The text that quality rules leave, or None."""
    w = words(t)
    found = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeat = {j for i in range(len(w) - 4) if found[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    if len(w) < 10 or 100 * len(repeat) > 20 * len(w):
        return None

    def fails(x):
        n, cells = len(SPACE.split(x.strip(" "))), len(re.findall("[|»›•·] ?", x))
        return (
            (cells >= 2 and n <= (cells + 1) * 4) or len(re.findall(r"[#*$%&|<>]", x)) > 0.1 * len(x) or x.count("!!") > 0.3 * n
            or (n > 3 and not re.search(r"[.!?…:;。\"'”’)\]»]\s*$", x)) or any(p in x.lower() for p in quality_rules.BOILERPLATE)
        )

    kept = [x for x in t.split("\n") if words(x) and not fails(x)]
    left = sum(len(x) for x in words("\n".join(kept)))
    return "\n".join(kept) if 1 - left / sum(map(len, w)) <= 0.5 else None


def plain_pipeline(rows, items):
    """rows: (id, text, lang, source). The result's (id, text, epochs)."""
    rows = [(k, c, *rest) for k, t, *rest in rows if (c := judged(t)) is not None]
    gone = removed_lines([r[:2] for r in rows])
    after = []
    for k, t, *rest in rows:
        clean = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k])
        whole = gone[k] and (len(clean) < 0.5 * len(t) or len(words(clean)) < 10)
        after.append((k, t if whole else clean, *rest))
    label = groups({r[0]: shingle_set(r[1]) for r in after if r[0] is not None})
    once = {r[0]: r for r in sorted((r for r in after if r[0] is not None), key=str, reverse=True) if label[r[0]] == r[0]}
    rows = [r for r in after if r[0] is None] + list(once.values())
    lower = [[w.lower() for w in words(t)] for t in items]
    owners = defaultdict(set)
    for k, w in enumerate(lower):
        for i in range(len(w) - 4):
            owners[tuple(w[i : i + 5])].add(k)
    weight = lambda g: max(1, 1000 // max(1, len(owners.get(g, ()))))

    def leaks(t):
        w = [x.lower() for x in words(t)]
        return any(every and 100 * both >= 80 * every for x in lower for s in range(max(1, len(w) - len(x) + 1)) for both, every in [likeness(w[s : s + len(x)], x, weight)])

    rows = [r for r in rows if not leaks(r[1])]
    return sorted(((rows[i][0], rows[i][1], e) for i, e in plain_mix(rows).items()), key=str)


def test_pipeline_against_a_plain_version(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdeilnorstu") for _ in range(r.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    items = [line(30), line(45).replace(".", ""), line(20)]
    common, rows = [line(12), line(6), "All rights reserved.", "home | about | contact"], []
    put = lambda t: rows.append((len(rows), t, r.choice(["en", "de", None]), r.choice(["src0", "src7", "a longer one", None])))
    texts = ["\n".join(line(r.randint(4, 25)) for _ in range(r.randint(1, 8))) for _ in range(30)]
    for t in texts:
        put(t)
        if r.random() < 0.5:
            w = t.split(" ")
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = word()
            put(" ".join(w))
        if r.random() < 0.5:
            put("\n".join([t, *r.sample(common, 2)]))
        if r.random() < 0.3:
            put("\n".join([line(15), t.split("\n")[0], line(14), line(16)]))
    for x in items:
        put(f"{line(20)}\n{x}\n{line(12)}")
        w = x.split()
        w[7] = "changed"
        put(f"{' '.join(w[1:])} {line(40)}")
    for t in (None, "", " \n ", "too short.", "no end mark here at all " * 2, "one two three four five. " * 9, "a #$% &*# | < > ### %%% line.\n" + line(11)):
        put(t)
    rows += [rows[3], rows[3], (None, line(40), "en", "src0"), (None, None, None, None)]
    assert len({r[1] for r in rows if r[0] == 3}) == 1
    docs = spark.createDataFrame([(*x, len(x[1] or ""), 1, "y") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, `a.b` long, key string")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "epochs"]
    got = out.collect()
    assert all(x.n_chars == len(x.text) and x["a.b"] == 1 and x.key == "y" and len(words(x.text)) >= 10 for x in got)
    want = plain_pipeline(rows, items)
    assert sorted(((x.doc_id, x.text, x.epochs) for x in got), key=str) == want and len(want) > 15


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_leaves_near_copies_to_their_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = quality_rules.filter_documents(docs)
    copies = lambda d: ngram_jaccard.jaccard_components(d).filter("component_id <> doc_id").select("doc_id")
    before, after = {r[0] for r in copies(clean).collect()}, {r[0] for r in copies(line_dedup.filter_documents(clean)).collect()}
    assert len(before & after) >= 0.95 * len(before), (len(before), len(after))


def test_hot_groups_of_copies(spark):
    """A third of all rows one text, a third near copies of another, and a line and a passage that all the others have."""
    base = " ".join(f"v{k}" for k in range(60)) + "."
    near = lambda k: " ".join([*[f"u{i}" for i in range(50)], f"n{k}"]) + "."
    passage = " ".join(f"p{k}" for k in range(40)) + "."
    rows = [(k, base if k % 3 == 0 else near(k) if k % 3 == 1 else f"own {k} text of {k * 7919 % 1009}.\n{passage}\n{k}end.") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    found = {r.doc_id: r.component_id for r in ngram_jaccard.jaccard_components(docs).collect()}
    assert {found[k] for k in range(0, 1500, 3)} == {0} and {found[k] for k in range(1, 1500, 3)} == {1}
    gone = substring_dedup.remove_repeated_windows(docs).groupBy((F.col("doc_id") % 3).alias("m"), "n_removed").count().collect()
    assert sorted((r.m, r.n_removed) for r in gone) == [(0, 60), (1, 50), (2, 40)]
    kept = line_dedup.dedup_lines(docs).groupBy((F.col("doc_id") % 3).alias("m")).agg(F.sum(F.col("n_lines") - F.col("n_lines_removed")).alias("n")).collect()
    assert {r.m: r.n for r in kept}[0] == 1
