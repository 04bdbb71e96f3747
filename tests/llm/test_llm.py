"""The llm operators against brute force on a small table with nulls, empty texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tickforge.llm import decontamination, html_extraction, line_dedup, mixing, ngram_jaccard, pii, quality_classifier, quality_rules, registry, substring_dedup, url_filters

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, cls string"


def corpus():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 4)))
    base = [" ".join(word() for _ in range(r.randint(1, 150))) + "." for _ in range(12)]
    texts = [None, "", " \n\t", "one two", "One two", *base]
    for b in base:
        w = b.split()
        for _ in range(4):
            v = list(w)
            v[r.randrange(len(v))] = word()
            texts.append(" ".join(v))
        texts.append(b)
        texts.append("\n".join([b, "a closing line that every one of these has, word for word.", b]))
    texts.append(" ".join(["same"] * 3000))
    return [(i, t, r.choice(["en", "de", None]), r.choice(["src0", "src1", None]), 0, 1, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_jaccard_components(docs, rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[a]] == label[a] for a in label):
            break
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(docs).collect()}
    assert got == {i: (len(s), label[i]) for i, s in sets.items()}


def test_jaccard_counts_every_link(spark, monkeypatch):
    r = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    edited = lambda k: " ".join(x if i not in at else f"n{r.random()}" for at in [r.sample(range(60), k)] for i, x in enumerate(base))
    texts = [*(edited(k % 3) for k in range(40)), *(" ".join([f"x{k}"] * (k % 3) + ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l"]) for k in range(6)), *(" ".join(f"{k}q{i}" for i in range(30)) for k in range(3)), "", "one two"]
    rows = [*enumerate(texts), *((100 + k, texts[k]) for k in range(3)), (200, texts[46]), (200, texts[46] + " end")]  # copies; an id with two near sets
    sets = {t: shingle_set(t) for _, t in rows}
    linked = lambda a, b: a and b and a != b and 100 * len(a & b) >= 80 * len(a | b)
    different = set(sets.values())
    want = {}
    for i, t in rows:
        want[i] = max(want.get(i, 0), sum(bool(linked(sets[t], x)) for x in different))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for sets_a_part in (1024, 7):
        monkeypatch.setattr(ngram_jaccard, "PART_SETS", sets_a_part)
        assert {x.doc_id: x.n_links for x in ngram_jaccard.jaccard_components(df).collect()} == want
    assert max(want.values()) > 5 and min(want.values()) == 0
    assert "n_links" not in ngram_jaccard.jaccard_components(df.limit(3), count_links=False).columns


def test_substring_dedup(docs, rows):
    count = Counter()
    split = {r[0]: (r[1] or "").encode().split() for r in rows}
    for w in split.values():
        count.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    for r in substring_dedup.remove_repeated_windows(docs).collect():
        w = split[r.doc_id]
        gone = {k for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_text.encode() == b" ".join(x for i, x in enumerate(w) if i not in gone)


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            before, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, before + (x != y))
    return line[-1]


def test_line_dedup(spark, docs):
    r = random.Random(2)
    base = ["".join(r.choice("abcdef gh") for _ in range(60)).strip() + "." for _ in range(5)]
    lines = []
    for k in range(60):
        x = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            x[r.randrange(len(x))] = r.choice("xyz")
        lines.append("".join(x))
    table = [(k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(20)]
    kept = {}
    flat = [(k, i, x) for k, t in table for i, x in enumerate(t.split("\n"))]
    for n, (k, i, x) in enumerate(flat):
        if not any(abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2 for _, _, y in flat[:n]):
            kept.setdefault(k, []).append(x)
    got = line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {k: "\n".join(kept.get(k, [])) for k, _ in table}
    assert line_dedup.dedup_lines(docs.select("doc_id", "text", "lang")).count() == docs.count()


def test_line_dedup_groups_and_shared_ids(spark):
    alike = [(k, f"{'all lines of this group differ by their number only':<60}{k:04d} end") for k in range(100, 160)]
    far = [(k, f"a line with other words before its number {k * 7919 % 9973:04d}{k * 104729 % 9973:04d}{k * 1299709 % 9973:04d}") for k in range(200, 220)]
    table = alike + far + [(None, alike[0][1]), (None, far[0][1] + "x"), (900, far[1][1]), (900, far[2][1] + "x"), (901, ""), (902, None)]
    order = sorted((x for x in table if x[1]), key=lambda x: (-1 if x[0] is None else x[0]))
    gone = {(k, x) for n, (k, x) in enumerate(order) if any(abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2 for j, y in order[:n] if j != k)}
    got = line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(k), "" if (k, x) in gone else str(x)) for k, x in table)


def test_line_dedup_short_lines(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcdef gh") for _ in range(n)).strip() + "." for n in (1, 5, 12, 18, 19, 20, 21, 30, 37, 38, 39, 40, 41, 42)]
    lines = ["}", "Of, edti oner.", "", " ", "Of, edti oner. ", "\t}"]
    for _ in range(240):
        x = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            at, kind = r.randrange(len(x)), r.randrange(3)
            x[at : at + (kind < 2)] = [r.choice("xyz")] * (kind > 0)
            x = x or ["x"]
        lines.append("".join(x))
    table = [(k, "\n".join(lines[6 * k : 6 * k + 6])) for k in range(41)]
    flat = [x.strip() for x in lines]
    may = lambda x, y: min(2, min(len(x), len(y)) // 20)
    kept = [not x or not any(x == y or abs(len(x) - len(y)) <= may(x, y) and edit_distance(x, y) <= may(x, y) for y in flat[:n]) for n, x in enumerate(flat)]
    near = [n for n, x in enumerate(flat) if not kept[n] and x not in flat[:n]]
    assert any(20 <= len(flat[n]) < 39 for n in near) and any(len(flat[n]) > 40 for n in near)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == {k: "\n".join(lines[n] for n in range(6 * k, 6 * k + 6) if kept[n]) for k, _ in table}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got, want = registry.queries()[name](spark, DIR).toPandas(), c.execute(registry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda f: sorted(map(tuple, f[cols].astype(str).to_numpy().tolist()))
    assert rows(got) == rows(want)


def test_decontamination_cut_at_the_texts_ends(spark):
    item = [f"w{k}" for k in range(40)]
    other = [f"o{k}" for k in range(60)]
    texts = [item[1:] + other, other + item[:-1], item[2:] + other, other + item[:-2], item[1:], item[:-1], item[1:-1], other + item + other, item[30:] + other, other + item[:10], item[:10]]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.start_word, r.similarity) for r in decontamination.leaks(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert got == {0: (0, 35 / 37), 1: (59, 35 / 37), 2: (0, 34 / 38), 3: (58, 34 / 38), 4: (0, 35 / 36), 5: (0, 35 / 36), 6: (0, 34 / 36), 7: (60, 1.0)}


def test_decontamination_many_items_of_one_text(spark):
    text = "one text that very many items of the benchmark have"
    bench = spark.range(1001).select(F.col("id").alias("item_id"), F.lit(text).alias("text"))
    docs = spark.createDataFrame([(1, f"before it {text} and behind"), (2, "a text without it, that is all there is to say")], "doc_id long, text string")
    got = [(r.doc_id, r.item_id, r.start_word, r.similarity) for r in decontamination.leaks(docs, bench).collect()]
    assert sorted(got) == [(1, k, 2, 1.0) for k in range(1001)]


def test_odd_rows_and_empty_tables(spark, docs):
    for d, n in ((docs, docs.count()), (docs.limit(0), 0)):
        assert quality_rules.judge(d).count() == n
        assert pii.find_pii(d).count() == n
        assert substring_dedup.remove_repeated_windows(d).count() == n
        assert ngram_jaccard.jaccard_components(d).count() == n
        assert quality_classifier.score_quality(d, spark.createDataFrame([], "doc_id long, quality int")).filter("score = 0.5").count() == n
        assert mixing.choose(d).filter("n_tokens = 0").count() == 0
        assert decontamination.leaks(d, spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")).count() == 0
    found = decontamination.leaks(docs, docs.filter("doc_id = 3").select(F.lit(7).alias("item_id"), "text"))
    assert {r.doc_id for r in found.collect()} == {3, 4}


def test_pii(spark):
    text = "mail a.b@c.org, 10.0.0.1 and 10.0.0.999; 4539 1488 0343 6467 +1 (212) 555-0100"
    base = pii.base_spans(text)
    assert [(k, text[s:e]) for k, s, e in base] == [(0, "a.b@c.org"), (1, "10.0.0.1"), (2, "4539 1488 0343 6467"), (3, "+1 (212) 555-0100")]
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(x.kind, x.start, x.end) for x in row.base] == [(pii.KINDS[k], s, e) for k, s, e in base]
    assert "a.b@c.org" not in row.masked


def test_quality_classifier_held_out(spark):
    out = quality_classifier.query(spark, "/root/testdata/sf0.01")
    both = out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out")
    assert both.filter("predicted = quality").count() / both.count() > 0.9


def test_html(spark):
    page = "<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>A title</h1><p>Text &amp; more\n text that goes on for a while.<p>Second one.</article><div class=comments><p>I disagree.</div><footer>&copy; us</footer>"
    assert html_extraction.main_text(page, html_extraction.train()) == "A title\nText & more text that goes on for a while.\nSecond one."
    rows = spark.createDataFrame([(1, None), (2, ""), (3, page), (4, "<p" + "<div>" * 2000)], "page_id long, html string")
    assert [r.text for r in html_extraction.extract(rows).orderBy("page_id").collect()][:2] == ["", ""]
    right = total = 0
    for k in range(100):
        composed, content = html_extraction.composed(7_000_000 + k)
        got = set(html_extraction.main_text(composed, html_extraction.train()).split("\n"))
        right += len(got & content)
        total += len(got | content)
    assert right / total > 0.97


HIDING = {
    "less-than in a script": "<html><head><title>T</title></head><body><script>for(var i=0;i<n;i++){f(i)}</script>@<script>a<b</script></body></html>",
    "comment mark in the head's script": "<html><head><script>var s='<!--';</script><title>a <b</title></head><body>@</body></html>",
    "tags in a script": "<html><body><script>w('<svg><noscript></head>')</script>@<noscript>no</noscript></body></html>",
    "head without end, body": "<html><head><title>T</title><meta charset=utf-8><link href=/x><body>@</body></html>",
    "head without end, element": "<html><head><title>T</title><style>p > a {}</style>@</html>",
    "closed head": "<html><head><meta charset=utf-8><noscript><link></noscript></head>@",
    "nested": "<html><body><svg><svg></svg><text>hidden</text></svg>@</body></html>",
    "hidden that crosses": "<html><body><noscript><svg></noscript>@<svg><text>hidden</text></svg></body></html>",
    **{f"unclosed {t}": f"<html><body><{t} class=x>@</body></html>" for t in ("svg", "math", "button", "select", "iframe", "noscript", "object", "template", "canvas")},
}


@pytest.mark.parametrize("name", sorted(HIDING))
def test_html_hides_no_more_than_its_elements(name):
    told = [f"A sentence of the story, number {k}, that goes on for quite a while." for k in range(3)]
    page = HIDING[name].replace("@", "<article>" + "".join(f"<p>{t}</p>" for t in told) + "</article>")
    assert html_extraction.main_text(page, html_extraction.train()) == "\n".join(told)


def test_url_intervals(spark):
    entries = spark.createDataFrame([("l", "domain", "x.org", "add", "2024-01-10"), ("l", "domain", "x.org", "remove", "2024-02-10")], "list string, kind string, value string, action string, day string").withColumn("day", F.col("day").cast("date"))
    urls = spark.createDataFrame([(u, d) for u in ("http://A.X.org:80/p", "http://x.organ/", None) for d in ("2024-01-09", "2024-01-10", "2024-02-10")], "url string, d string").withColumn("fetched", F.col("d").cast("date"))
    got = {(r.url, r.d) for r in url_filters.filter_urls(urls, entries).filter("blocked").collect()}
    assert got == {("http://A.X.org:80/p", "2024-01-10")}


def test_url_prefixes_of_mixed_case(spark):
    entries = spark.createDataFrame([("l", "prefix", "X.org/Some/Path", "add", "2024-01-10"), ("l", "prefix", "y.org/Gone", "add", "2024-01-10"), ("l", "prefix", "Y.ORG/Gone", "remove", "2024-01-20"), ("l", "prefix", "Y.ORG/gone", "add", "2024-01-20"), ("l", "domain", "Z.Org", "add", "2024-01-10"), ("l", "prefix", "W.org", "add", "2024-01-10")], "list string, kind string, value string, action string, day string").withColumn("day", F.col("day").cast("date"))
    urls = ["http://x.org/Some/Path", "http://X.org/Some/Path/More", "http://x.org/some/path", "http://y.org/Gone", "http://y.org/gone", "http://a.z.org/P", "http://w.ORG/Q"]
    captures = spark.createDataFrame([(u, d) for u in urls for d in ("2024-01-12", "2024-01-22")], "url string, d string").withColumn("fetched", F.col("d").cast("date"))
    got = {(r.url, r.d[-2:]) for r in url_filters.filter_urls(captures, entries).filter("blocked").collect()}
    assert got == {(u, d) for u in (urls[0], urls[1], urls[5], urls[6]) for d in ("12", "22")} | {(urls[3], "12"), (urls[4], "22")}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, DIR)
    rows = out.collect()
    assert out.columns == [*docs.columns, "epochs"] and rows
    assert len({r.doc_id for r in rows}) == len(rows)
    for a in rows:
        assert a.n_chars == len(a.text) and a.epochs > 0 and re.search(r"\S", a.text)
        assert hashlib.sha256(a.text.encode()).digest()
    sets = [shingle_set(r.text) for r in rows]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not (a and b and 100 * len(a & b) >= 80 * len(a | b))
