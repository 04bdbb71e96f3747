"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans (email, ip, card, phone). The field then labels the tokens of a document that carry a digit or
an at sign or stand behind a telling word (password, token, key and the like), every later token that equals one of those,
and the neighbours of all these: O, the four kinds, or secret (keys and passwords). Its factors are trained piecewise on a
bounded sample of documents: a softmax over token features (labels: base spans, and secrets behind a telling word),
transitions between neighbours, and agreement of repeated or similar tokens. Loopy sum-product over chain and skip edges
gives marginals; tokens at ``sure`` or above that no base span touches are added. A document without such tokens has no
spans; so skipping its other tokens changes nothing.

Null and empty texts have no spans. Whole texts are read, in time that grows with their length: no pattern is tried again
from within a run it has failed on. Equal rows get equal spans; ids may be null or repeat. Extra columns of any name are
ignored. An empty table gives an empty result. Training takes about ``sample`` different texts, all if there are no more,
those whose hash lies under a threshold taken from a count; without any the field adds nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import sampled, text_of

KINDS = ("email", "ip", "card", "phone", "secret")
#: The base patterns, email and ip in parts so that long runs are read once.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
NUMBERS = re.compile(r"[0-9.]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SEED = re.compile(r"(?i:password|passwd|token|secret|api_?key)\s*[=:]\s*\"?([A-Za-z0-9]{8,})|\b(AKIA[0-9A-Z]{12,})")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
TELLING = re.compile(r"[0-9@]")
LABEL = re.compile(r"(?i)(?:password|passwd|token|secret|api_?key)[\"']?\s*[=:]")
#: Without one of these, in lower case, a text has no telling word.
STEMS = ("passw", "token", "secret", "api")
SAMPLE, SURE, ROUNDS = 2000, 0.95, 12


def has_stem(text: str) -> bool:
    low = text.lower()
    return any(x in low for x in STEMS)


def can_have_spans(text: Column) -> Column:
    """What TELLING and has_stem tell, for a column."""
    low = F.lower(text)
    return F.rlike(text, F.lit(TELLING.pattern)) | reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in STEMS])


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(double[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from their at signs."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of four numbers with dots between; those with a part above 255 are dropped, and not tried again."""
    out = []
    for run in NUMBERS.finditer(text):
        part, at = run[0].split("."), run.start()
        begins = []
        for x in part:
            begins.append(at)
            at += len(x) + 1
        k = 0
        while k + 4 <= len(part):
            four = part[k : k + 4]
            if all(four):
                if all(len(y := x.lstrip("0")) <= 3 and int(y or 0) <= 255 for x in four):
                    out.append((begins[k], begins[k + 3] + len(four[3])))
                k += 4
            else:
                k += 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, *x) for x in emails(text)] if "@" in text else []
    if "." in text:
        out += [(1, *x) for x in addresses(text)]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


class Cover:
    """Which ranges meet any of some spans, in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends, most = [], [], 0
        for s, e in sorted(spans):
            most = max(most, e)
            self.starts.append(s), self.ends.append(most)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a


def features(token: str, before: str, after: str, behind: bool = False) -> np.ndarray:
    n = len(token)
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    upper = sum(c.isupper() for c in token)
    core = token.strip("\"'.,;:()#*$%&")
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:], strict=False))
    pre = before.lower()
    return np.array([
        1, "@" in token, "@" in token and "." in token.rpartition("@")[2], token.count(".") == 3 and digits >= 4 and not letters, digits >= 13 and not letters,
        4 <= digits < 13 and not letters, 0 < digits < 4 and not letters, token[:1] == "+", "(" in token and digits >= 2, n >= 12 and letters > 0 and digits > 0 and turns >= 4,
        n >= 16 and upper >= 8 and digits > 0, "=" in token, token[:1] == '"', pre in ("=", ":", "token", "password", "secret", "key"), turns >= 6, n >= 24 and letters > 0, digits == 0, before[:1] == "+", after[:1] == "(", behind,
    ], float)


def core_of(token: str) -> str:
    return token.strip("\"'.,;:()#*$%&").lower()


def graph(text: str) -> tuple[list[tuple[int, int]], np.ndarray, list[tuple[int, int]], list[tuple[int, int]], np.ndarray] | None:
    """Telling tokens and their neighbours, their features, chain edges, skip edges (from each token to the one before that
    is equal or similar, so that edges grow with tokens and not with their pairs), and which tokens are telling."""
    labelled = has_stem(text)
    if not TELLING.search(text) and not (labelled and LABEL.search(text)):
        return None
    every = [m.span() for m in TOKEN.finditer(text)]
    word = lambda j: text[slice(*every[j])] if 0 <= j < len(every) else ""
    telling = {i for i, (a, b) in enumerate(every) if TELLING.search(text, a, b)}
    begins = [a for a, _ in every]
    shared: set[str] = set()
    behind: set[int] = set()
    for m in LABEL.finditer(text) if labelled else ():  # the token that holds what stands behind the sign
        i = bisect_left(begins, m.end() + 1) - 1
        if i >= 0 and every[i][1] <= m.end():
            i += 1
        if 0 <= i < len(every) and len(core := core_of(word(i)).rpartition("=")[2]) >= 6:
            telling.add(i), behind.add(i), shared.add(core)
    if shared:
        telling.update(i for i in range(len(every)) if core_of(word(i)).rpartition("=")[2] in shared)
    if not telling:
        return None
    picked = sorted({j for i in telling for j in (i - 1, i, i + 1) if 0 <= j < len(every)})
    x = np.stack([features(word(j), word(j - 1), word(j + 1), j in behind) for j in picked])
    chain = [(k, k + 1) for k in range(len(picked) - 1) if picked[k] + 1 == picked[k + 1]]
    skip, last = [], {}
    for k, j in enumerate(picked):
        core = core_of(word(j))
        for key in {core.rpartition("=")[2], re.sub(r"[^0-9]", "", core)} - {""}:
            if len(key) >= 4:
                if key in last and last[key] != k:
                    skip.append((last[key], k))
                last[key] = k
    return [every[j] for j in picked], x, chain, skip, np.array([j in telling for j in picked])


def marked(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    """Training labels: 0 for O, else 1 + kind. A secret is one wherever it stands again."""
    spans = base_spans(text) + [(4, *m.span(1 if m[1] else 2)) for m in SEED.finditer(text)]
    out = np.zeros(len(tokens), int)
    for kind in range(len(KINDS)):
        cover = Cover([x[1:] for x in spans if x[0] == kind])
        out[[i for i, (a, b) in enumerate(tokens) if cover.meets(a, b)]] = 1 + kind
    known = {text[s:e].lower() for kind, s, e in spans if kind == 4}
    if known:
        out[[i for i, (a, b) in enumerate(tokens) if not out[i] and core_of(text[a:b]).rpartition("=")[2] in known]] = 5
    return out


def train(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log potentials: feature weights by label, transitions, agreement of skip edges."""
    k = len(KINDS) + 1
    xs, ys, step, agree = [], [], np.ones((k, k)), np.ones((k, k))
    for t in texts:
        if g := graph(t):
            y = marked(t, g[0])
            xs.append(g[1]), ys.append(y)
            for edges, table in ((g[2], step), (g[3], agree)):
                for a, b in edges:
                    table[y[a], y[b]] += 1
                    table[y[b], y[a]] += table is agree
    w = np.zeros((len(features("", "", "")), k))
    if not xs:
        w[0, 0] = 10
        return w, np.zeros((k, k)), np.zeros((k, k))
    x, y = np.concatenate(xs), np.concatenate(ys)
    one = np.eye(k)[y]
    weight = 1 / np.sqrt(np.maximum(one.sum(axis=0), 1))[y]
    weight /= weight.sum()
    speed = np.zeros_like(w)
    for _ in range(400):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + x.T @ ((p - one) * weight[:, None]) + 1e-4 * w
        w = w - 0.5 * speed
    prior = lambda t: np.log(t / t.sum()) - np.log(t.sum(axis=1, keepdims=True) / t.sum()) - np.log(t.sum(axis=0, keepdims=True) / t.sum())
    return w, np.clip(prior(step), -3, 3), np.clip(prior(agree), -3, 3)


def marginals(unary: np.ndarray, edges: list[tuple[int, int]], tables: list[np.ndarray]) -> np.ndarray:
    """Loopy sum-product, damped by half, in log space."""
    log_sum = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
    if edges:
        a, b = (np.array(x) for x in zip(*edges, strict=True))
        pot = np.stack(tables)
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        pots = np.concatenate([pot, pot.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        msg = np.zeros((len(src), unary.shape[1]))
        for _ in range(ROUNDS):
            total = unary.copy()
            np.add.at(total, dst, msg)
            new = log_sum((total[src] - msg[back])[:, :, None] + pots, 1)
            msg = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
        unary = unary.copy()
        np.add.at(unary, dst, msg)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def all_spans(text: str, model: tuple[np.ndarray, np.ndarray, np.ndarray], sure: float = SURE) -> tuple[list, list]:
    base = base_spans(text)
    more = []
    if g := graph(text):
        tokens, x, chain, skip, telling = g
        cover = Cover([y[1:] for y in base])
        p = marginals(x @ model[0], chain + skip, [model[1]] * len(chain) + [model[2]] * len(skip))
        for (a, b), q, own in zip(tokens, p, telling.tolist(), strict=True):
            kind = int(q.argmax())
            if kind and q[kind] >= sure and own and not cover.meets(a, b):
                part = text[a:b]
                cut = part.rfind("=", 0, len(part) - 1) + 1 if kind == 5 else 0
                core = part[cut:].strip("\"'.,;:()#*$%&")
                if core:
                    s = a + cut + part[cut:].index(core)
                    more.append((kind - 1, s, s + len(core)))
    return base, sorted(base + more)


def find_pii(docs: DataFrame, sample: int = SAMPLE, sure: float = SURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, base and spans (both arrays of kind, start, end), masked (the text with spans
    replaced by their kind in brackets)."""
    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    some = src.select("__text").filter(can_have_spans(F.col("__text")))
    some = sampled(some, F.col("__text"), sample).groupBy(F.xxhash64("__text").alias("h")).agg(F.min("__text").alias("t"))
    model = train([r[0] for r in some.orderBy("h").select("t").collect()])  # about ``sample`` texts, whatever the input
    span = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        named = lambda x: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in x]
        for batch in batches:
            base, spans, masked = [], [], []
            for t in batch.column(1):
                text = t.as_py()
                b, s = all_spans(text, model, sure) if text and (TELLING.search(text) or has_stem(text)) else ([], [])
                base.append(named(b)), spans.append(named(s))
                if s:
                    parts, at = [], 0
                    for k, x, y in sorted(s, key=lambda v: v[1]):
                        if x >= at:
                            parts += [text[at:x], f"[{KINDS[k]}]"]
                        at = max(at, y)
                    text = "".join(parts) + text[at:]
                masked.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(spans, kind), pa.array(masked, pa.string())], ["__id", "__base", "__spans", "__masked"])

    out = src.mapInArrow(run, f"__id {src.schema['__id'].dataType.simpleString()}, __base {span}, __spans {span}, __masked string")
    return out.select(F.col("__id").alias(id_col), F.col("__base").alias("base"), F.col("__spans").alias("spans"), F.col("__masked").alias("masked"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: base spans' counts and digest, all spans and their number, and the number of secrets, of every document."""
    out = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS[:4]]  # noqa: B023
    secrets = F.size(F.filter("spans", lambda x: x["kind"] == "secret")).cast("long").alias("n_secret")
    return out.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), secrets, F.size("spans").cast("long").alias("n_spans"))
