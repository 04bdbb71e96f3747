"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the text alone, by vectorised counts over bytes and words. Training takes about ``sample`` labelled
documents whose crc32(doc_id as text) mod 4 is not 2, all if there are no more: those whose id's hash lies under a threshold
taken from a count, so that nothing else goes to the driver. Trees are complete and flattened into arrays, so scoring walks
all documents down level by level in numpy.

Null and empty texts get statistics of zero and a score like any other. Whole texts count. Repeated rows are scored each
for itself; of rows that share an id one is learnt from (the least in statistics), and of several labels of an id the
greatest counts; labels other than 0 and 1 do not. Null ids are never held out nor learnt from. Extra columns of any name
are ignored. An empty table gives an empty result; without labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._store import sampled, small, text_of, written

SAMPLE = 20_000
CUT = 0.7
_byte = np.arange(256)
CLASSES = {
    "upper": (_byte >= 65) & (_byte <= 90), "digit": (_byte >= 48) & (_byte <= 57), "wide": _byte >= 128, "symbol": np.isin(_byte, list(b"#*$%&|<>")),
    "bang": _byte == 33, "stop": _byte == 46, "comma": _byte == 44, "bar": _byte == 124, "line": _byte == 10, "quote": np.isin(_byte, list(b"\"'")), "other": np.isin(_byte, list(b"{}[]()=_/\\@+~^")),
}
NAMES = ["words", "chars", "mean_word", "long_words", "short_words", "distinct", "top_word", "capital_words", "words_a_line", *CLASSES]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of NAMES for each document."""
    d = len(offsets) - 1
    w = W.words(data, offsets, True)
    n, size = w.counts.astype(float), np.diff(offsets).astype(float)
    doc = W.owners(w.first)
    length = w.ends - w.starts
    per = lambda x: np.bincount(doc, x, d) / np.maximum(n, 1)
    distinct, top = np.zeros(d), np.zeros(d)
    for k in range(d):
        a, b = w.first[k], w.first[k + 1]
        if b > a:
            s = np.sort(w.hashes[a:b])
            runs = np.diff(np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]])))
            distinct[k], top[k] = len(runs) / (b - a), runs.max() / (b - a)
    first = data[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    of_byte = W.owners(offsets)
    shares = {c: np.bincount(of_byte, hit[data], d) / np.maximum(size, 1) for c, hit in CLASSES.items()}
    lines = shares["line"] * size + 1
    return np.stack([np.log1p(n), np.log1p(size), per(length), per(length > 12), per(length < 3), distinct, top, per(CLASSES["upper"][first]), n / lines, *shares.values()], axis=1)


@dataclass
class Forest:
    """Complete trees of one depth: node i of a tree has children 2 i + 1 and 2 i + 2."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += leaf[node - (2**self.depth - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss over quantile histograms."""
    inner = 2**depth - 1
    if not len(x):
        return Forest(0.0, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate0 / (1 - rate0)))
    margin = np.full(len(y), base)
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            start, width = 2**level - 1, 2**level
            at = node - start
            total_g, total_h = np.bincount(at, g, width), np.bincount(at, h, width)
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                k = len(e) + 1
                if k == 1:
                    continue
                key = at * k + code[:, f]
                lg = np.bincount(key, g, width * k).reshape(width, k).cumsum(axis=1)[:, :-1]
                lh = np.bincount(key, h, width * k).reshape(width, k).cumsum(axis=1)[:, :-1]
                rg, rh = total_g[:, None] - lg, total_h[:, None] - lh
                gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - (total_g**2 / (total_h + ridge))[:, None]
                gain[(lh < least) | (rh < least)] = -1
                j = gain.argmax(axis=1)
                better = gain[np.arange(width), j] > best
                best[better] = gain[np.arange(width), j][better]
                feature[start : start + width][better] = f
                cut[start : start + width][better] = e[j[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        margin += leaf[at]
        features.append(feature), cuts.append(cut), leaves.append(leaf)
    return Forest(base, depth, np.stack(features), np.stack(cuts), np.stack(leaves))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in W.chunks(batch.column(1)):
            x = statistics(data, offsets)
            flat = pa.array(np.ascontiguousarray(x).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), flat)], ["id", "x"])


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, held_out, score and predicted."""
    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    rows = written(src.mapInArrow(_measured, f"id {kind}, x array<double>"), "statistics")
    held = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) == 2
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("quality").alias("y")).filter("y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    known = sampled(marks.filter(~held), F.col("id"), sample)
    once = rows.join(small(known), "id").groupBy("id").agg(F.min("x").alias("x"), F.max("y").alias("y"))
    learn = once.orderBy("id").select("x", "y").toPandas()  # about ``sample`` rows, whatever the input
    forest = fit(np.stack(learn["x"]) if len(learn) else np.zeros((0, len(NAMES))), learn["y"].to_numpy(float))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            s = forest.score(np.stack(pdf["x"])) if len(pdf) else np.zeros(0)
            yield pd.DataFrame({"id": pdf["id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= cut).astype(np.int32)})

    out = rows.select("id", F.coalesce(held, F.lit(False)).alias("held_out"), "x").mapInPandas(run, f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: a quality score for every document."""
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
