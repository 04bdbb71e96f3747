"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct ``width``-word shingles (A-Z lower-cased). Each shingle flips one bit of a parity
sketch, so two sketches differ in at most as many bits as the symmetric difference of the sets has members. For sets of a
and b members, similarity >= t means a symmetric difference of at most D = (a + b)(1 - t) / (1 + t). Sizes fall into bands
of ratio 1 / t; in a band the sketch has more than D blocks, each bit of which belongs to one block, so similar sets agree
in at least one block (pigeonhole). Blocks are very wide and so are kept as the XOR of their shingles' codes.

Equal sets form a class first. Classes that agree in a block make a list, which holds 64 of the 128 bits of their codes;
lists are joined star by star, and what is then still apart is compared in full, so no link between different sets is lost
while members known to be connected are not compared again. A sketch of about twice as many bits as a set has members
discards most pairs by its Hamming distance, exact sets decide the rest. Stars are pairs of codes, told apart before they
meet their sketches.

Links lie within components, so their number is counted there: where the links that joined a component are not all of its
pairs, each set is compared with each other one of its component that is near enough in size, whole sets with whole sets.
Large components are dealt by pairs of their parts.

Nulls and texts without words: an empty set, linked with nothing, its own component. Fewer than ``width`` words: the whole
sequence is the one shingle. Repeated rows of one id: the id appears once in the result, with the size of its largest set,
and its rows' sets count as linked with each other. Ids are whole numbers; other types are refused by an error. Null ids are
dropped. Extra columns of any name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _words as W
from ._store import parts_for, small, text_of, written

U = np.uint64
SKETCH_BITS = (512, 1 << 16)
FLUSH = 400_000
BUCKET_BYTES = 8 << 20
LONG_LIST = 4096
LIST_ROWS = 32_768
STAR_MEMBERS = 1 << 19
PART_SETS, PART_MEMBERS = 1024, 1 << 19
KEY = np.dtype([("a", ">u8"), ("b", ">u8")])
PARTS = "bucket int, doc_id long, n long, cls binary, sketch binary, sigs binary, owners binary"


class Bands:
    """Size bands of one threshold (given in hundredths): scheme k joins sets of which the smaller has at least low[k] and
    fewer than low[k + 1] members; blocks[k] blocks, of which spare[k] may be empty without being used."""

    def __init__(self, percent: int):
        t = percent / 100
        low, top = [1], 1.0
        while low[-1] < 2**40:
            top /= t
            low.append(max(low[-1], int(np.ceil(top - 1e-9))))
        self.low = np.array(low)
        small = self.low[1:] - 1
        self.most = ((small + small * 100 // percent) * (100 - percent)) // (100 + percent)
        base = self.most + 1
        self.spare = np.ceil(base * 0.04 + 2 * np.sqrt(base * 0.04)).astype(np.int64)
        self.blocks = base + self.spare

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1


def set_codes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits for each set that depend on its members only."""
    n = np.diff(first)
    out = np.zeros(len(n), KEY)
    full = np.flatnonzero(n)
    if len(full):
        out["a"][full] = np.add.reduceat(W.mix(h, 11), first[full])
        out["b"][full] = np.add.reduceat(W.mix(h, 23), first[full])
    return out


def sketches(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parity sketches of twice as many bits as a set has members, a power of two between the limits."""
    n = np.diff(first)
    bits = np.clip(1 << np.ceil(np.log2(2 * np.maximum(n, 1))).astype(np.int64), *SKETCH_BITS)
    base = np.concatenate([[0], np.cumsum(bits)])
    doc = W.owners(first)
    odd = np.bincount(base[doc] + (h.astype(np.int64) & (bits[doc] - 1)), minlength=base[-1]) & 1
    raw = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [raw[x // 8 : y // 8] for x, y in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def folded(sketch: list[bytes]) -> np.ndarray:
    """Sketches as rows of one length: halves of longer ones are XORed, as a shorter sketch would have been made."""
    least = min(map(len, sketch))
    rows = []
    for x in sketch:
        v = np.frombuffer(x, U)
        while len(v) * 8 > least:
            v = v[: len(v) // 2] ^ v[len(v) // 2 :]
        rows.append(v)
    return np.stack(rows)


def signatures(h: np.ndarray, first: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Block signatures of sets with members, and the set each belongs to."""
    n = np.diff(first)
    own = bands.of(np.maximum(n, 1))
    sigs, sets = [], []
    codes = W.mix(h, 37)
    doc = W.owners(first)
    for shift in (0, 1):
        k = own - shift
        use = (n > 0) & (k >= 0)
        use &= bands.most[np.maximum(k, 0)] > 0
        pick = np.flatnonzero(use[doc])
        if not len(pick):
            continue
        d, m = doc[pick], bands.blocks[k]
        block = ((h[pick] >> U(32)) * m[d].astype(U)) >> U(32)
        new = np.ones(len(pick), bool)
        new[1:] = (block[1:] != block[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        place = W.mix((k[d[at]].astype(U) << U(40)) + block[at], 41)
        sigs.append(W.mix(np.bitwise_xor.reduceat(codes[pick], at) + place))
        sets.append(d[at])
        empty = np.where(use, m - np.bincount(d[at], minlength=len(n)), 0)
        for x in np.flatnonzero(empty > bands.spare[np.maximum(k, 0)]):
            rest = np.setdiff1d(np.arange(m[x]), block[at][d[at] == x].astype(np.int64))
            sigs.append(W.mix(W.mix((U(int(k[x]) << 40)) + rest.astype(U), 41), 43))
            sets.append(np.full(len(rest), x))
    return (np.concatenate(sigs), np.concatenate(sets)) if sigs else (np.zeros(0, U), np.zeros(0, np.int64))


def _batch(rows: dict, n: int) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "doc_id": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(rows.get(c, [0 if c in ("doc_id", "n") else None] * n), kinds.get(c, pa.binary())) for c in (x.split()[0] for x in PARTS.split(", "))], [x.split()[0] for x in PARTS.split(", ")])


def _dealt(percent: int, width: int, buckets: int):
    bands = Bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sigs, slots, held, base = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not keys:
                return
            key, s, slot = np.concatenate(keys), np.concatenate(sigs), np.concatenate(slots)
            only = np.zeros(len(key), bool)
            only[np.unique(key, return_index=True)[1]] = True  # of equal sets one sends its blocks
            s, slot = s[only[slot]], slot[only[slot]]
            to = (s % U(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            s, slot, to = s[order], slot[order], to[order]
            cut = np.searchsorted(to, np.arange(buckets + 1))
            rows = {"bucket": [], "sigs": [], "owners": []}
            for b in range(buckets):
                if (i := cut[b]) < (j := cut[b + 1]):
                    rows["bucket"].append(b)
                    rows["sigs"].append(s[i:j].tobytes())
                    rows["owners"].append(key[slot[i:j]].tobytes())
            keys.clear(), sigs.clear(), slots.clear()
            del key, s, slot, only, order, to
            if rows["bucket"]:
                yield _batch(rows, len(rows["bucket"]))
            rows.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in W.chunks(batch.column(1)):
                h, first = W.distinct_shingles(W.words(data, offsets, True), width)
                key = set_codes(h, first)
                raw, sk = key.tobytes(), sketches(h, first)
                yield _batch({"bucket": (key["a"] % U(buckets)).astype(np.int32), "doc_id": ids[i:j], "n": np.diff(first), "cls": [raw[16 * x : 16 * x + 16] for x in range(j - i)], "sketch": sk}, j - i)
                s, owner = signatures(h, first, bands)
                keys.append(key["a"].astype(U)), sigs.append(s), slots.append(owner + base)
                base, held = base + len(key), held + len(s) + len(key)
                if held > FLUSH:
                    yield from flush()
                    held = base = 0
        yield from flush()

    return run


LISTS = "kind int, doc_id long, n long, cls binary, sketch binary, members binary"


def _gathered(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: its documents as they are, and the lists of classes that agree in a block."""
    docs = pdf[pdf["cls"].notna()]
    short: list[bytes] = []
    parts = pdf[pdf["sigs"].notna()]
    if len(parts):
        sig, key = np.frombuffer(b"".join(parts["sigs"]), U), np.frombuffer(b"".join(parts["owners"]), U)
        order = np.argsort(sig, kind="stable")
        sig, key = sig[order], key[order]
        del order, parts
        same = np.flatnonzero(sig[1:] == sig[:-1])
        lists = set()
        if len(same):
            begin = same[np.concatenate([[True], np.diff(same) > 1])]
            end = same[np.concatenate([np.diff(same) > 1, [True]])] + 2
            for i, j in zip(begin.tolist(), end.tolist(), strict=True):
                members = np.unique(key[i:j])
                if len(members) > 1:
                    lists.add(members.astype(">u8").tobytes())
        short = [x for x in lists if len(x) <= 8 * LONG_LIST]
        for x in lists:
            if len(x) > 8 * LONG_LIST:
                step = 4 * LONG_LIST
                cut = [x[i : i + step] for i in range(0, len(x), step)]
                short += [a + b for i, a in enumerate(cut) for b in cut[i + 1 :]]
    k, none = len(docs), [None] * len(short)
    cols = {c: pd.Series([*docs[c], *none], dtype=t) for c, t in (("cls", object), ("sketch", object))} | {c: [*docs[c].tolist(), *[0] * len(short)] for c in ("doc_id", "n")}
    return pd.DataFrame({"kind": [0] * k + [1] * len(short), **cols, "members": pd.Series([None] * k + short, dtype=object)})


def _near(percent: int):
    """Of pairs with both sizes and sketches, those that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(c).to_pylist() for c in ("sa", "sb"))
            most = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()) * (100 - percent) // (100 + percent)
            ok = np.zeros(len(one), bool)
            lengths = np.array([(len(x), len(y)) for x, y in zip(one, two, strict=True)]).reshape(-1, 2)
            for pair in np.unique(lengths, axis=0):
                at = np.flatnonzero((lengths == pair).all(axis=1))
                x, y = (np.frombuffer(b"".join([side[i] for i in at]), U).reshape(len(at), -1) for side in (one, two))
                while x.shape[1] > y.shape[1]:
                    x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
                while y.shape[1] > x.shape[1]:
                    y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
                ok[at] = np.bitwise_count(x ^ y).sum(axis=1) <= most[at]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    return run


def _star(lists: DataFrame, known: DataFrame, percent: int, salt: int) -> DataFrame:
    """(rank, a, b): each list's leader with its other members, where they are in different components and may be similar."""
    leader = F.array_min(F.transform("ids", lambda x: F.struct(F.xxhash64(x, F.lit(salt)).alias("rank"), x.alias("id"))))
    led = lists.select(leader["id"].alias("ia"), "ids")  # before the rows multiply
    pairs = led.select("ia", F.explode("ids").alias("ib")).filter("ia <> ib").distinct().withColumn("part", F.pmod(F.xxhash64("ib"), F.lit(16)).cast("int"))
    side = lambda x: known.select(F.col("id").alias(f"i{x}"), F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("comp").alias(f"c{x}"))
    leaders = pairs.select("ia", "part").distinct().join(side("a"), "ia")
    both = pairs.join(side("b"), "ib").join(leaders, ["ia", "part"]).filter("ca <> cb").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    near = both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_near(percent), "a binary, b binary")
    return near.select(F.xxhash64(F.substring("a", 1, 8), F.lit(salt)).alias("rank"), "a", "b")


def _pairs(percent: int):
    """Pairs of a list's members that are in different components and may be similar."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()  # what this task has sent; forgetting some only repeats pairs
        for pdf in frames:
            left, right = [], []
            for members in pdf["m"]:
                cls = [x["cls"] for x in members]
                n = np.array([x["n"] for x in members])
                comp = np.unique([x["comp"] for x in members], return_inverse=True)[1]
                sk = folded([x["sketch"] for x in members])
                for i in range(len(cls) - 1):
                    other = np.arange(i + 1, len(cls))
                    other = other[comp[other] != comp[i]]
                    most = (n[other] + n[i]) * (100 - percent) // (100 + percent)
                    ok = (np.minimum(n[other], n[i]) * 100 >= np.maximum(n[other], n[i]) * percent) & (np.bitwise_count(sk[other] ^ sk[i]).sum(axis=1) <= most)
                    for j in other[ok].tolist():
                        pair = min(cls[i], cls[j]) + max(cls[i], cls[j])
                        if pair not in seen:
                            seen.add(pair)
                            left.append(pair[:16]), right.append(pair[16:])
            if len(seen) > 2_000_000:
                seen.clear()
            yield pd.DataFrame({"a": pd.Series(left, dtype=object), "b": pd.Series(right, dtype=object)})

    return run


def _apart(lists: DataFrame, known: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(a, b): all pairs of a list's members that are in different components and may be similar. Lists of one component go
    before the sketches come; lists that share the smallest component meet in a few tasks, more where they are many, each of
    which sends a pair once."""
    items = lists.select(F.unhex(F.sha1("members")).alias("list"), F.explode("ids").alias("id")).join(known.select("id", "cls", "comp"), "id")
    mixed = written(items.groupBy("list").agg(F.collect_list("cls").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi"), "mixed")
    parts = mixed.groupBy("lo").agg((F.sum(F.size("m")) / LIST_ROWS).cast("int").alias("more")).filter("more > 0")
    mixed = mixed.join(small(parts), "lo", "left").withColumn("part", F.pmod(F.hash("list"), F.coalesce("more", F.lit(0)) + 4))
    rows = mixed.select("list", "lo", "part", F.explode("m").alias("cls")).join(known.select("cls", "n", "sketch", "comp"), "cls").repartition(buckets, "lo", "part")
    groups = rows.groupBy("lo", "part", "list").agg(F.collect_list(F.struct("cls", "n", "sketch", "comp")).alias("m"))
    return groups.select("m").mapInPandas(_pairs(percent), "a binary, b binary")


def _sets(width: int):
    """The sets of texts whose code is the one asked for (rows of one id can have other texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in W.chunks(batch.column(1)):
                h, first = W.distinct_shingles(W.words(data, offsets, True), width)
                raw = set_codes(h, first).tobytes()
                asked = batch.column(0)[i:j].to_pylist()
                own = [x for x in range(j - i) if raw[16 * x : 16 * x + 16] == asked[x]]
                yield pa.RecordBatch.from_arrays([pa.array([asked[x] for x in own], pa.binary()), pa.array([h[first[x] : first[x + 1]].tobytes() for x in own], pa.binary())], ["cls", "members"])

    return run


def _verified(percent: int):
    """Of a leader's set (the row without b) and others', as many as have STAR_MEMBERS members or so: which are similar
    enough."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["b"].isna()
        a = np.frombuffer(pdf.loc[own, "members"].iloc[0], U)
        out = []
        for b, raw in zip(pdf.loc[~own, "b"], pdf.loc[~own, "members"], strict=True):
            x = np.frombuffer(raw, U)
            at = np.searchsorted(a, x)
            shared = int((a[np.minimum(at, len(a) - 1)] == x).sum()) if len(a) else 0
            if shared and 100 * shared >= percent * (len(a) + len(x) - shared):
                out.append(b)
        return pd.DataFrame({"a": [key[0]] * len(out), "b": out, "part": 0})[["a", "b"]]

    return run


def _counted(percent: int):
    """Of sets of some components, or of two parts of one: how many of the others each is similar enough to."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in pdf.groupby("comp", sort=False):
            rows = rows.iloc[np.argsort(rows["n"].to_numpy(), kind="stable")]
            n, side = rows["n"].to_numpy(), (rows["chunk"] == rows["hi"]).to_numpy()
            within = bool((rows["lo"] == rows["hi"]).iloc[0])
            first = np.concatenate([[0], np.cumsum(n)])
            members = np.unique(np.frombuffer(b"".join(rows["members"]), U), return_inverse=True)[1]
            held, found = np.zeros(int(members.max()) + 1, np.uint8), np.zeros(len(n), np.int64)
            end = np.searchsorted(n, n * 100 // percent, "right")
            for i in range(len(n) - 1):
                j, k = i + 1, int(end[i])
                if k <= j:
                    continue
                own = members[first[i] : first[j]]
                held[own] = 1
                shared = np.add.reduceat(held[members[first[j] : first[k]]], first[j:k] - first[j], dtype=np.int64)
                held[own] = 0
                linked = 100 * shared >= percent * (n[i] + n[j:k] - shared)
                if not within:
                    linked &= side[j:k] != side[i]
                found[i] += linked.sum()
                found[j:k] += linked
            out.append(pd.DataFrame({"cls": rows["cls"].to_numpy(), "n_links": found}))
        return pd.concat(out)

    return run


def _degrees(links: DataFrame, comp: DataFrame, classes: DataFrame, src: DataFrame, percent: int, width: int) -> DataFrame:
    """(cls, n_links): of each class that is in a component with others, how many of them it links with."""
    sets = written(comp.withColumnRenamed("id", "cls").join(classes.select("cls", "rep", "n"), "cls"), "joined")
    held = links.select(F.col("a").alias("cls")).join(sets.select("cls", "comp"), "cls").groupBy("comp").agg(F.count(F.lit(1)).alias("known"))
    sizes = sets.groupBy("comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).join(held, "comp", "left")
    sizes = sizes.filter(F.coalesce("known", F.lit(0)) < F.col("size") * (F.col("size") - 1) / 2)
    cut = F.greatest(F.ceil(F.col("size") / PART_SETS), F.ceil(F.col("total") / PART_MEMBERS)).cast("int")
    todo = written(sets.join(sizes.select("comp", cut.alias("cut")), "comp"), "open")
    ends = reduce(DataFrame.union, [links.select(F.col(c).alias("cls")) for c in ("a", "b")]).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    load = todo.filter("cut = 1").agg(F.sum("n")).first()[0] or 0
    if not todo.take(1):
        return ends
    texts = src.join(small(todo.select(F.col("cls").alias("asked"), F.col("rep").alias("doc_id"))), "doc_id").select(F.col("asked").alias("cls"), "text")
    whole = texts.mapInArrow(_sets(width), "cls binary, members binary").dropDuplicates(["cls"])
    own = F.pmod(F.xxhash64("cls", F.lit(7)), F.col("cut")).cast("int")
    rows = whole.join(todo.select("cls", "comp", "n", "cut"), "cls").withColumn("chunk", own).withColumn("other", F.explode(F.expr("sequence(0, cut - 1)")))
    rows = rows.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
    part = F.when(F.col("cut") == 1, F.pmod(F.xxhash64("comp"), F.lit(max(1, load // PART_MEMBERS)))).otherwise(F.xxhash64("comp"))
    parts = rows.select(part.alias("part"), "lo", "hi", "comp", "chunk", "cls", "n", "members").groupBy("part", "lo", "hi")
    counted = parts.applyInPandas(_counted(percent), "cls binary, n_links long").groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    return written(ends.join(todo.select("cls"), "cls", "left_anti").union(counted), "degrees")


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """nodes(id), edges(a, b): (id, comp) for the ids that have edges, comp the smallest id connected. Labels pass to
    neighbours and jump to their label's label, so rounds grow with the logarithm of a component's diameter."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("comp")), "labels")
    for _ in range(rounds):
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        step = label.join(near, "id").select("id", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        jump = step.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        step = written(step.join(jump, "comp", "left").select("id", F.least("comp", F.coalesce("far", "comp")).alias("comp"), "was"), "labels")
        label = step.select("id", "comp")
        if not step.filter(F.col("comp") != F.col("was")).take(1):
            return label
    raise RuntimeError("components did not settle")


def jaccard_components(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id (smallest id reachable by links of at least percent / 100),
    class_id (smallest id with the same set) and, if count_links, n_links (the other sets that this one links with, all of
    them, each once however many documents have it)."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be a whole number, not {docs.schema[id_col].dataType.simpleString()}")
    src = text_of(docs, id_col=id_col, text_col=text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).filter("doc_id is not null")
    buckets = parts_for(spark, src.agg(F.sum(F.octet_length("text"))).first()[0] or 0, BUCKET_BYTES)
    parts = src.mapInArrow(_dealt(percent, width, buckets), PARTS)
    found = written(parts.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_gathered, LISTS), "blocks")
    rows = found.filter("kind = 0").select("doc_id", "n", "cls", "sketch")
    classes = written(rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    classes = classes.withColumn("id", F.substring("cls", 1, 8))
    ids = F.expr("transform(sequence(0, length(members) div 8 - 1), i -> substring(members, 8 * i + 1, 8))")
    lists = written(found.filter("kind = 1").select("members").distinct().withColumn("ids", ids), "lists")
    several = written(rows.filter("n > 0").groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("doc_id", "lo"), "several")
    ties = None
    if several.take(1):  # ids whose rows have different sets
        ties = written(rows.filter("n > 0").join(small(several), "doc_id").filter("cls <> lo").select(F.col("lo").alias("a"), F.col("cls").alias("b")).distinct(), "ties")
    links, comp = None, components(classes, ties) if ties else None
    for salt in (101, 103, None):
        known = classes.withColumn("comp", F.col("cls")) if comp is None else classes.join(comp.withColumnRenamed("id", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        near = _apart(lists, known, percent, buckets) if salt is None else _star(lists, known, percent, salt)
        if salt == 101:  # at first each member meets the first of its leaders only
            near = near.groupBy("b").agg(F.min(F.struct("rank", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
        pairs = written(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        if not pairs.take(1):
            continue
        need = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        firsts = written(classes.join(need, "cls").select("cls", F.col("rep").alias("doc_id"), "n"), "need")
        texts = src.join(small(firsts.select("cls", "doc_id")), "doc_id").select("cls", "text")
        sets_of = written(texts.mapInArrow(_sets(width), "cls binary, members binary").dropDuplicates(["cls"]), "sets")
        load = pairs.join(small(firsts.select(F.col("cls").alias("b"), "n")), "b").groupBy("a").agg((F.sum("n") / STAR_MEMBERS).cast("int").alias("more")).filter("more > 0")
        slim = pairs.join(small(load), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("more", F.lit(0)) + 1).cast("int").alias("part"))
        other = slim.join(sets_of.withColumnRenamed("cls", "b"), "b").select("a", "part", "b", "members")
        own = slim.select("a", "part").distinct().join(sets_of.withColumnRenamed("cls", "a"), "a").select("a", "part", F.lit(None).cast("binary").alias("b"), "members")
        good = written(other.union(own).groupBy("a", "part").applyInPandas(_verified(percent), "a binary, b binary"), "links")
        links = good if links is None else links.union(good)
        comp = components(classes, links.union(ties) if ties else links)
    ends = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    if comp is not None and links is None:
        links = ties.limit(0)
    if comp is None:
        named = classes.select("cls", F.col("rep").alias("class_id"), F.col("rep").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    else:
        rep = classes.select("cls", "rep")
        known = comp.withColumnRenamed("id", "cls").join(rep, "cls")
        smallest = known.groupBy("comp").agg(F.min("rep").alias("component_id"))
        degree = _degrees(links, comp, classes, src, percent, width) if count_links else classes.select("cls", F.lit(None).cast("long").alias("n_links"))
        linked = known.join(smallest, "comp").join(degree, "cls", "left").select("cls", "component_id", "n_links")
        named = rep.join(linked, "cls", "left").select("cls", F.col("rep").alias("class_id"), F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = ends.join(named, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = out.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"), F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "class_id", *["n_links"] * count_links)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: components of documents whose five-word shingle sets have a Jaccard similarity of 0.8 or more."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
