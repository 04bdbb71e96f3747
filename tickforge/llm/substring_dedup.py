"""Substring dedup with a count-min prefilter.

A window is ``width`` consecutive words. Its anchor is the smallest hash of the ``width - span + 1`` word sequences of
``span`` words in it, at the leftmost place that has it; equal windows have equal anchors at equal places. First pass: each
partition sketches how often anchors occur (two rows of counters that stop at two, kept as sparse cells), partial sketches
are merged by cell range, and only the bits "twice or more" are gathered and broadcast; their number is bounded by
``max_bits``. Counters overestimate, so a window that occurs twice always passes. Second pass: windows whose anchor may
repeat are grouped exactly by two independent 64-bit hashes (of anchor and window). Windows that repeat inside a task's
batch are settled there, one of them goes on, so a hot passage sends a row per batch only.

Null and empty texts: no words, nothing removed, the text stays empty. Fewer than ``width`` words: nothing removed.
Repeated rows are documents of their own, so the windows of both repeat each other and go. Rows are told apart by a hash
of id and text, so ids may repeat, be null or be of any type. Extra columns are ignored. An empty table gives an empty
result. All of a passage's places go, the first too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _words as W
from ._store import parts_for, text_of, written

U = np.uint64
RANGE_BITS = 22
FLUSH = 2_000_000


def anchors(w: W.Words, width: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: document, first word (from the document's first), its anchor and the anchor's place."""
    count = np.maximum(w.counts - width + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    doc = W.owners(first)
    pos = np.arange(first[-1]) - first[doc]
    if not len(pos):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U), z
    at = w.first[doc] + pos
    grams = W.rolling(w.hashes, np.arange(len(w.hashes) - span + 1), span)
    low = np.lib.stride_tricks.sliding_window_view(grams, width - span + 1)
    place = at + low[at].argmin(axis=1)
    return doc, pos, grams[place], place


def _cuts(new: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Ranges of n things that begin where new is set; none if there is nothing."""
    at = np.flatnonzero(new).tolist()
    return list(zip(at, [*at[1:], n], strict=True)) if at else []


def _cells(span: int, width: int, bits: int):
    """Sparse counters of a task's anchors: cells by range, and which of them have been met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            v = np.concatenate(held) if held else np.zeros(0, U)
            held.clear()
            for row in range(2):
                cell, n = np.unique(W.mix(v, 61 + row) >> U(64 - bits), return_counts=True)
                part = (cell >> U(RANGE_BITS)).astype(np.int32)
                for i, j in _cuts(np.diff(part, prepend=-1), len(part)):
                    inside = (cell[i:j] & U((1 << RANGE_BITS) - 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([part[i]], pa.int32()), pa.array([inside.tobytes()]), pa.array([np.packbits(n[i:j] > 1).tobytes()])], ["row", "part", "cells", "twice"])

        total = 0
        for batch in batches:
            for _, _, data, offsets in W.chunks(batch.column(0)):
                _, _, v, place = anchors(W.words(data, offsets, False), width, span)
                new = np.ones(len(v), bool)
                new[1:] = place[1:] != place[:-1]
                held.append(v[new])
                total += int(new.sum())
                if total > FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    once = np.zeros(1 << RANGE_BITS, bool)
    twice = np.zeros(1 << RANGE_BITS, bool)
    for cells, more in zip(pdf["cells"], pdf["twice"], strict=True):
        c = np.frombuffer(cells, np.int32)
        twice[c[once[c]]] = True
        once[c] = True
        twice[c[np.unpackbits(np.frombuffer(more, np.uint8), count=len(c)).astype(bool)]] = True
    return pd.DataFrame({"row": [key[0]], "part": [key[1]], "bits": [np.packbits(twice).tobytes()]})


COVER = "kind int, bucket int, id long, v binary, wh binary, ids binary, starts binary, counts binary, spans binary"
_NAMES = [x.split()[0] for x in COVER.split(", ")]
_TYPES = {"kind": pa.int32(), "bucket": pa.int32(), "id": pa.int64()}


def _rows(**cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols.get(c, [0 if c == "id" else None] * n), _TYPES.get(c, pa.binary())) for c in _NAMES], _NAMES)


def _spans(ids: np.ndarray, starts: np.ndarray, width: int) -> tuple[list[int], list[bytes]]:
    """Windows (any order) as joined word ranges of each id."""
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + width)
    a = np.flatnonzero(new)
    b = np.concatenate([a[1:], [len(ids)]]) - 1
    ranges = np.stack([starts[a], starts[b] + width], axis=1).astype(np.int32)
    own = ids[a]
    cut = _cuts(np.concatenate([[True], own[1:] != own[:-1]]), len(own))
    return [int(own[i]) for i, _ in cut], [ranges[i:j].tobytes() for i, j in cut]


def _repeated(v: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal, and which of those are not the first."""
    g = W.mix(v * U(0x9E3779B97F4A7C15) + wh)
    order = np.argsort(g, kind="stable")
    gs, vs, ws = g[order], v[order], wh[order]
    near, equal = gs[1:] == gs[:-1], (vs[1:] == vs[:-1]) & (ws[1:] == ws[:-1])
    if (near & ~equal).any():
        order = np.lexsort((wh, v))
        vs, ws = v[order], wh[order]
        equal = (vs[1:] == vs[:-1]) & (ws[1:] == ws[:-1])
    dup, later = np.zeros(len(v), bool), np.zeros(len(v), bool)
    dup[order[1:][equal]] = True
    later[order[1:][equal]] = True
    dup[order[:-1][equal]] = True
    return dup, later


def _windows(span: int, width: int, bits: int, buckets: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.frombuffer(x, np.uint8) for x in sketch.value]
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            ids, pos, v, wh = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            dup, later = _repeated(v, wh)
            if dup.any():
                own, spans = _spans(ids[dup], pos[dup], width)
                yield _rows(kind=[1] * len(own), id=own, spans=spans)
            ids, pos, v, wh = (x[~later] for x in (ids, pos, v, wh))
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (ids[1:] != ids[:-1]) | (pos[1:] != pos[:-1] + 1)
            at = np.flatnonzero(new)
            counts = np.diff(np.concatenate([at, [len(v)]]))
            to = (v[at] % U(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            take = np.repeat(at[order] - np.concatenate([[0], np.cumsum(counts[order])[:-1]]), counts[order]) + np.arange(len(v))
            wh, at, counts, to = wh[take], at[order], counts[order].astype(np.int32), to[order]
            cut = np.searchsorted(to, np.arange(buckets + 1))
            edge = np.concatenate([[0], np.cumsum(counts)])
            out = {"kind": [], "bucket": [], "v": [], "wh": [], "ids": [], "starts": [], "counts": []}
            for b in range(buckets):
                if (i := cut[b]) < (j := cut[b + 1]):
                    for k, x in (("kind", 0), ("bucket", b), ("v", v[at[i:j]].tobytes()), ("wh", wh[edge[i] : edge[j]].tobytes()), ("ids", ids[at[i:j]].tobytes()), ("starts", pos[at[i:j]].astype(np.int32).tobytes()), ("counts", counts[i:j].tobytes())):
                        out[k].append(x)
            if out["kind"]:
                yield _rows(**out)

        total = 0
        for batch in batches:
            every = np.asarray(batch.column(0))
            for i, j, data, offsets in W.chunks(batch.column(1)):
                w = W.words(data, offsets, False)
                doc, pos, v, _ = anchors(w, width, span)
                keep = np.ones(len(v), bool)
                for row, have in enumerate(rows):
                    cell = W.mix(v, 61 + row) >> U(64 - bits)
                    keep &= (have[(cell >> U(3)).astype(np.int64)] >> (U(7) - (cell & U(7))).astype(np.uint8)) & 1 == 1
                doc, pos, v = doc[keep], pos[keep], v[keep]
                held.append((every[i:j][doc], pos, v, W.rolling(W.mix(w.hashes, 71), w.first[doc] + pos, width, 1)))
                total += len(v)
                if total > FLUSH:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    return run


def _packed(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, parts: int) -> pd.DataFrame:
    """Ranges by parts of ids: at most as many rows as parts."""
    part = (ids.view(U) % U(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    rows = [order[i:j] for i, j in _cuts(np.diff(part[order], prepend=-1), len(order))]
    cols = {"ids": ids, "starts": starts.astype(np.int32), "ends": ends.astype(np.int32)}
    return pd.DataFrame({"part": pd.Series([int(part[r[0]]) for r in rows], dtype="int32"), **{c: pd.Series([v[r].tobytes() for r in rows], dtype=object) for c, v in cols.items()}})


def _ranges(own: list[int], spans: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
    return np.repeat(np.array(own, np.int64), [len(x) // 8 for x in spans]), flat[:, 0], flat[:, 1]


def _settled(width: int, parts: int):
    """Of one bucket: ranges settled before as they are, and those of windows that repeat here."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done, rest = pdf[pdf["kind"] == 1], pdf[pdf["kind"] == 0]
        found = [_ranges(done["id"].tolist(), done["spans"].tolist())]
        if len(rest):
            cat = lambda c, t: np.frombuffer(b"".join(rest[c]), t)
            counts = cat("counts", np.int32)
            wh = cat("wh", U)
            dup, _ = _repeated(np.repeat(cat("v", U), counts), wh)
            shift = np.arange(len(wh)) - np.repeat(np.cumsum(counts) - counts, counts)
            ids, starts = np.repeat(cat("ids", np.int64), counts), np.repeat(cat("starts", np.int32), counts) + shift
            if dup.any():
                found.append(_ranges(*_spans(ids[dup], starts[dup], width)))
        return _packed(*(np.concatenate(x) for x in zip(*found, strict=True)), parts)

    return run


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one part of the ids: a row for each id with its ranges."""
    ids, starts, ends = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("ids", np.int64), ("starts", np.int32), ("ends", np.int32)))
    order = np.argsort(ids, kind="stable")
    ids, both = ids[order], np.stack([starts[order], ends[order]], axis=1)
    cut = _cuts(np.concatenate([[True], ids[1:] != ids[:-1]]), len(ids)) if len(ids) else []
    return pd.DataFrame({"id": pd.Series([int(ids[i]) for i, _ in cut], dtype="int64"), "spans": pd.Series([both[i:j].tobytes() for i, j in cut], dtype=object)})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        covers = batch.column(1)
        total, gone, texts = [], [], []
        for i, j, data, offsets in W.chunks(batch.column(0)):
            w = W.words(data, offsets, False)
            keep = np.ones(len(w.starts), bool)
            for d in range(i, j):
                if (c := covers[d].as_py()) is not None:
                    for a, b in np.frombuffer(c, np.int32).reshape(-1, 2).tolist():
                        keep[w.first[d - i] + a : w.first[d - i] + b] = False
            raw = data.tobytes()
            starts, ends = w.starts.tolist(), w.ends.tolist()
            for d in range(j - i):
                a, b = int(w.first[d]), int(w.first[d + 1])
                texts.append(b" ".join(raw[starts[k] : ends[k]] for k in (np.flatnonzero(keep[a:b]) + a).tolist()) if not keep[a:b].all() else b" ".join(raw[int(offsets[d]) : int(offsets[d + 1])].split()))
                total.append(b - a), gone.append(b - a - int(keep[a:b].sum()))
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()), *batch.columns[2:]], ["n_words", "n_removed", "kept_text", *batch.schema.names[2:]])


def remove_repeated_windows(docs: DataFrame, width: int = 35, span: int = 16, max_bits: int = 29, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_words, n_removed and kept_text (the words left, joined by one space). The sketch
    has as many bits as suit the input, 2**max_bits a row at most; beyond that it lets more windows pass, none is lost."""
    spark = docs.sparkSession
    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").alias("__own"), F.col(f"`{text_col}`").alias("__text"))
    src = src.withColumn("__id", F.xxhash64("__own", "__text"))
    size = src.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    bits = min(max_bits, max(RANGE_BITS, int(size / 60 * 16).bit_length()))
    buckets = parts_for(spark, size)
    cells = src.select("__text").mapInArrow(_cells(span, width, bits), "row int, part int, cells binary, twice binary")
    merged = cells.groupBy("row", "part").applyInPandas(_merged, "row int, part int, bits binary")
    sketch = [bytearray(1 << bits - 3), bytearray(1 << bits - 3)]
    for r in merged.toLocalIterator():  # at most 2**max_bits bits a row of the sketch
        step = 1 << RANGE_BITS - 3
        sketch[r["row"]][r["part"] * step : (r["part"] + 1) * step] = r["bits"]
    shared = spark.sparkContext.broadcast([bytes(x) for x in sketch])
    hits = src.select("__id", "__text").mapInArrow(_windows(span, width, bits, buckets, shared), COVER)
    hits = hits.withColumn("bucket", F.coalesce("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")))
    both = hits.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_settled(width, buckets), "part int, ids binary, starts binary, ends binary")
    cover = written(both.groupBy("part").applyInPandas(_joined, "id long, spans binary"), "spans")
    shared.unpersist()
    joined = src.join(cover.withColumnRenamed("id", "__id"), "__id", "left")
    out = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.BinaryType()), src.schema["__own"]])
    kept = joined.select("__text", "spans", "__own").mapInArrow(_kept, out)
    return kept.select(F.col("__own").alias(id_col), "n_words", "n_removed", F.col("kept_text").cast("string").alias("kept_text"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every window of 35 words that starts anywhere else too is removed."""
    out = remove_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
