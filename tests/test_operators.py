"""Operators on small tables of their own: odd orders, strict JSON, torn files, streams with restarts, sinks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tickforge.functions.ticks import stripped, symbol_key
from tickforge.operators import backpressure, dedup, ingest, journal, liveness, ordered, state
from tickforge.sources import synthetic
from tickforge.sources.journal import journal_lines
from tickforge.streaming import sinks
from tickforge.streaming.ingest import Follower


@pytest.fixture
def narrow(monkeypatch):
    """Ranges of a few rows, so that small tables are cut into many."""
    monkeypatch.setattr(ordered, "ranges_of", lambda df, order, rows=7, f=ordered.ranges_of: f(df, order, rows))


@pytest.mark.parametrize("orders", [[1, None, 3], [None, None, 5, 5, 2], [0, 1, 2, 10**15], [-(10**12), *range(50)], [7] * 20, [], list(range(300))])
def test_sequenced_is_gap_free(spark, narrow, orders):
    rows = [(x, k) for k, x in enumerate(orders)]
    random.Random(1).shuffle(rows)
    got = ordered.sequenced(spark.createDataFrame(rows, "o long, k long").repartition(3), "o", 10).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.o, r.k) for r in sorted(got, key=lambda r: r.seq)] == want
    assert sorted(r.seq for r in got) == list(range(11, 11 + len(rows)))


def test_ranges_keep_far_values_apart(spark):
    df = spark.range(40_000).select(F.when(F.col("id") == 0, F.lit(2**60)).otherwise(F.col("id")).alias("o"))
    found = ordered.ranges_of(df, "o", 100)
    counts = sorted(r["count"] for r in found.put(df, "o").groupBy("__range").count().collect())
    assert len(counts) > 300 and counts[-1] <= 2_000
    placed = found.put(df, "o").groupBy("__range").agg(F.min("o").alias("a"), F.max("o").alias("b")).orderBy("__range").collect()
    assert all(x.b < y.a for x, y in zip(placed, placed[1:], strict=False))


def test_carried_against_plain_loops(spark, narrow):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), k, r.choice([None, *range(20)]), r.random() < 0.5) for k in range(200)]
    df = spark.createDataFrame(rows, "key string, o long, v long, ok boolean").repartition(5)
    v = F.col("v")
    out = ordered.carried(df, ["key"], "o", before={"s": ("sum", v), "l": ("last", v)}, upto={"m": ("max", v), "c": ("sum", F.lit(1).cast("long"))}, after={"f": ("first", F.when(F.col("ok"), v)), "n": ("min", v)})
    for x in out.collect():
        mine = [y for y in rows if y[0] == x.key]
        before = [y[2] for y in mine if y[1] < x.o and y[2] is not None]
        upto = [y[2] for y in mine if y[1] <= x.o and y[2] is not None]
        after = [y for y in mine if y[1] > x.o and y[2] is not None]
        assert (x.s, x.l) == (sum(before) if before else None, before[-1] if before else None)
        assert (x.m, x.c) == (max(upto, default=None), sum(y[1] <= x.o for y in mine))
        assert (x.f, x.n) == (next((y[2] for y in after if y[3]), None), min((y[2] for y in after), default=None))


def test_byte_offsets_and_increasing_over_ranges(spark, narrow):
    r = random.Random(3)
    rows = [(k, "é" * r.randint(0, 9), r.randint(0, 60)) for k in range(100)]
    df = spark.createDataFrame(rows, "line_no long, line string, seq long").repartition(4)
    at, want = 0, {}
    for k, line, _ in rows:
        want[k] = at
        at += len(line.encode()) + 1
    assert {x.line_no: x.byte_offset for x in journal.byte_offsets(df).collect()} == want
    most, kept = -1, []
    for k, _, s in rows:
        if s >= 5 and s > most:
            most = s
            kept.append(k)
    assert sorted(x.line_no for x in ordered.increasing(df, "line_no", "seq", 5).collect()) == kept


STRICT = {
    '{"a":1}': True, ' {"a":[{"b":1}],"c":[[{"x":1}],[{"y":2}]]}\n': True, '{"a":1}{"a":2}': False, '{"a":1} trailing': False, '{"a":1}],[{"b":2}': False, '{"a":1}]}': False, '{"a":1}}': False,
    '{"a":1},{"b":2}': False, "{bad": False, "": False, '{"a":NaN}': False, "[1]": True, "7": True, '"x"': True, "null": True, "1,2": False, "1],[2": False,
}


def test_one_document_is_told_from_more(spark):
    rows = spark.createDataFrame([(t,) for t in STRICT] + [(None,)], "t string")
    got = {r.t: r.ok for r in ingest.decoded(rows, "t").select("t", F.col("v").isNotNull().alias("ok")).collect()}
    assert got == STRICT | {None: False}


MESSAGES = {
    '{"action":"snapshot","arg":{"channel":"trade","instId":"BTCUSDT"},"data":[{"ts":1710000000000,"price":"70000","size":"1","side":"buy","tradeId":"1"}]}': ("trade", 1),
    '{"action":"update","arg":{"channel":"trade"},"data":"not a list"}': ("contract", 0), '{"action":"update","arg":{"channel":"trade"},"data":[{"side":"invalid"}]}': ("contract", 0),
    '{"action":"update","arg":{"channel":"trade"},"data":[null]}': ("contract", 0), '{"action":"update","arg":{"channel":"trade"}}': ("contract", 0), '{"action":"update","arg":"x"}': ("unknown", -1),
    '{"action":"update","arg":{"channel":"books"}}': ("unknown", -1), '{"event":"subscribe","arg":"BTC"}': ("subscribe", -1), '{"error":null}': ("error", -1), '{"event":"error"}': ("error", -1), '{"other":"y"}': ("unknown", -1),
    '{"action":"pong"}': ("unknown", -1), "pong": ("pong", -1), "[1]": ("contract", -1), "": ("contract", -1), "{bad": ("bad_json", -1),
    '{"action":"update","arg":{"channel":"trade"},"data":[{"ts":1.9,"price":2,"side":"sell","tradeId":5},{"ts":"1d","price":"1","size":"1","side":"buy"},{"ts":3,"price":"1d","size":"1","side":"buy"},{"ts":4,"price":1,"size":null,"side":"buy"}]}': ("trade", 1),
}


def test_messages(spark):
    rows = spark.createDataFrame([(t,) for t in MESSAGES] + [(None,)], "raw string")
    out = ingest.classify(rows).cache()
    assert {r.raw: (r.kind, r.n) for r in out.select("raw", "kind", F.coalesce(F.size("ticks"), F.lit(-1)).alias("n")).collect()} == MESSAGES | {None: ("contract", -1)}
    ticks = [(r.pos, r.inst_id, r.ts, r.price, r.size, r.side, r.trade_id) for r in ingest.explode_trades(out).collect()]
    assert sorted(ticks) == [(0, "BTCUSDT", 1710000000000, 70000.0, 1.0, "buy", "1"), (0, "UNKNOWN", 1, 2.0, 0.0, "sell", "5")]


def test_a_text_is_parsed_once(spark):
    rows = spark.createDataFrame([(1, "x", True)], "line_no long, line string, complete boolean")
    for df, n in ((journal.parsed(rows), 1), (ingest.classify(rows, "line"), 1), (ingest.explode_trades(ingest.classify(rows, "line")), 1), (journal.compact_lines(rows, 5), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") + plan.count("parse_json") == n, plan


def test_white_space_and_symbols(spark):
    text = "　\t ab\x1c\xa0"
    row = spark.createDataFrame([(text,)], "t string").select(stripped(F.col("t")).alias("a"), symbol_key(F.col("t")).alias("b")).first()
    assert (row.a, row.b) == (text.strip(), text.strip().upper())


def test_journal_files(spark, tmp_path):
    r = random.Random(4)
    texts = ["".join(r.choice("aé ") for _ in range(r.randint(0, 60))) for _ in range(3000)]
    (tmp_path / "a.jsonl").write_bytes("\n".join(texts).encode() + b"\n")
    (tmp_path / "b.jsonl").write_bytes(b'{"seq":1}\n\n{"seq":2,"ti')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = journal_lines(spark, str(tmp_path)).collect()
        later = journal_lines(spark, str(tmp_path / "a.jsonl"), 1000).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    raw = "\n".join(texts).encode()
    a = sorted((x.byte_offset, x.line, x.complete) for x in got if x.file.endswith("a.jsonl"))
    assert [x[1] for x in a] == texts and all(x[2] for x in a) and all(raw[o : o + len(t.encode())].decode() == t for o, t, _ in a)
    assert later == sum(o >= 1000 for o, _, _ in a)
    assert sorted((x.byte_offset, x.line, x.complete) for x in got if x.file.endswith("b.jsonl")) == [(0, '{"seq":1}', True), (10, "", True), (11, '{"seq":2,"ti', False)]


def record(seq, **change):
    tick = {"inst_id": "BTCUSDT", "ts": 1000 + seq, "price": 1.5, "size": 1, "side": "buy", "trade_id": f"t{seq}"} | change
    return json.dumps({"seq": seq, "tick": {k: v for k, v in tick.items() if v is not None}})


def test_scan_of_records(spark):
    lines = ["", "  ", record(1), "{not-valid-json", record(2) + record(3), record(4), "[1]", record(5, trade_id=None), record(6, price="2.5", ts="7"), record(7, price=-1), '{"seq":"8"}', record(3), record(9)]
    rows = spark.createDataFrame([(k, t, True) for k, t in enumerate(lines)] + [(len(lines), 'XRP","ts":1}}', False)], "line_no long, line string, complete boolean")
    assert sorted(r.seq for r in journal.replay(rows).collect()) == [1, 4, 6, 9]
    assert sorted((r.line_no, r.reason) for r in journal.quarantine(rows).collect()) == [(3, "bad_json"), (4, "bad_json"), (6, "not_object"), (7, "bad_record"), (9, "bad_record"), (10, "bad_record"), (13, "incomplete_trailing_poison")]
    episodes = sorted((r.first_line, r.skipped, r.skipped_total, r.recovered) for r in journal.skip_episodes(journal.parsed(rows)).collect())
    assert episodes == [(3, 2, 2, True), (6, 2, 4, True), (9, 2, 6, True), (13, 1, 7, False)]
    report = journal.compaction_report(rows.filter("complete"), 4).first()
    assert (report.kept, report.removed, report.skipped, report.rewritten) == (6, 2, 3, True)
    assert journal.compaction_report(rows, 1).first().rewritten is False


@pytest.mark.parametrize(("quiet", "cold", "reason", "waiting"), [(1999, False, None, True), (2000, False, "incomplete_trailing_stale", False), (0, True, "incomplete_trailing_cold_attach", False)])
def test_torn_tip(spark, quiet, cold, reason, waiting):
    rows = spark.createDataFrame([(1, record(1), True, None), (2, record(2)[:40], False, quiet)], "line_no long, line string, complete boolean, quiet_ms long")
    last = journal.parsed(rows, cold).filter("line_no = 2").first()
    assert (last.reason, last.waiting) == (reason, waiting) and [r.seq for r in journal.replay(rows, 0, cold).collect()] == [1]


def test_floor_lookup_over_odd_indexes(spark):
    r = random.Random(5)
    for n in (0, 1, 3, 255, 256):
        index = sorted(r.sample(range(1000), n))
        df = spark.createDataFrame([(s, s * 10) for s in index], "seq long, byte_offset long")
        got = {x.start: (x.hint_seq, x.hint_offset) for x in journal.floor_lookup(spark.range(0, 1010, 3).select(F.col("id").alias("start")), df).collect()}
        for start, hint in got.items():
            below = [s for s in index if s <= start]
            assert hint == ((below[-1], below[-1] * 10) if below else (0, 0))


class Consumer:
    """The cursor rules as they would be of one reader."""

    def __init__(self):
        self.pending, self.gone = None, False

    def step(self, op, seq):
        if op == "wait":
            self.pending, self.gone = seq, False
            return "armed", None
        if op == "set":
            self.gone, self.pending = self.gone or self.pending is not None, None
            return "set", None
        if self.pending is None:
            out, self.gone = ("ignored" if self.gone else "error"), False
            return out, None
        done, self.pending, self.gone = self.pending, None, False
        return "processed", done


def test_consumption_against_a_consumer(spark, narrow):
    r = random.Random(6)
    rows = [(r.choice("ab"), k, r.choice(["wait", "mark", "set"]), k) for k in range(300)]
    one = {"a": Consumer(), "b": Consumer()}
    want = {k: one[key].step(op, s) for key, k, op, s in rows}
    got = state.acknowledged(spark.createDataFrame(rows, "reader string, pos long, op string, seq long"))
    assert {x.pos: (x.outcome, x.processed_seq) for x in got.collect()} == want


def test_progress_of_a_broken_snapshot_is_an_error(spark):
    rows = spark.createDataFrame([(1.0, 100.0, 5, 4, False), (float("nan"), 100.0, 5, 4, False)], "read_offset double, journal_size double, next_seq long, disk_tip long, stuck boolean")
    assert state.checked_progress(rows.filter("read_offset = 1.0")).first().trailing_fp
    with pytest.raises(Exception, match="lacks a field"):
        state.checked_progress(rows).collect()


def test_throttle_and_lag_against_plain_loops(spark):
    r = random.Random(7)
    rows = sorted((r.choice("ab"), r.randint(0, 500), k) for k in range(300))
    want, last, n = [], {}, {}
    for key, t, k in rows:
        n[key] = n.get(key, 0) + 1
        if key not in last or t - last[key] >= 40:
            want.append((key, t, k, n[key]))
            last[key], n[key] = t, 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = backpressure.throttled(spark.createDataFrame(rows, "key string, ts long, k long"), "key", "ts", ["ts", "k"], 40).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((x.key, x.ts, x.k, x.n) for x in got) == want
    polls = spark.createDataFrame([("r", t, n) for t, n in ((0, 0), (4, 0), (5, 0), (9, 0), (10, 0), (11, 1), (12, 0), (17, 0), (30, 0))], "reader string, ts long, n_read long")
    assert sorted((x.ts, x.waited_ms) for x in backpressure.lag_logs(polls, every_ms=5).collect()) == [(5, 5), (10, 10), (17, 5), (30, 18)]


def test_acks_at_the_windows_edges(spark, narrow):
    requests = spark.createDataFrame([(1, 100, ["a", "b", "a"]), (2, 200, ["b"]), (3, 300, [])], "req long, ts long, symbols array<string>")
    acks = spark.createDataFrame([("a", 100), ("b", 150), ("b", 99), ("b", 249)], "symbol string, ts long")
    got = {x.req: (x.expected, x.confirmed, x.missing, x.complete) for x in liveness.ack_completeness(requests, acks, 50).collect()}
    assert got == {1: (2, 1, "b", False), 2: (1, 1, "", True)}


def test_feed_is_the_same_on_any_partitions(spark):
    ticks = synthetic.feed(spark, 500, {"BTCUSDT": 67250.5, "ETHUSDT": 3480.2})
    rows = sorted(ticks.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sorted(synthetic.feed(spark, 500, {"ETHUSDT": 3480.2, "BTCUSDT": 67250.5}).collect()) == rows
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert rows[0].trade_id == "TX-1001" and all(0.01 <= x.size <= 2.5 for x in rows)
    walk = [x.price for x in rows if x.inst_id == "ETHUSDT"]
    assert all(round(b - a, 6) in synthetic.STEPS for a, b in zip(walk, walk[1:], strict=False))
    back = ingest.explode_trades(ingest.classify(synthetic.as_messages(ticks)), "arrival")
    assert sorted((x.arrival, x.ts, x.price, x.trade_id) for x in back.collect()) == [(x.arrival, x.ts, x.price, x.trade_id) for x in rows]


def test_follower_restarts_behind_its_cursor(spark, tmp_path):
    segments, seen = tmp_path / "segments", []
    segments.mkdir()
    (segments / "0001.jsonl").write_text("\n".join([record(1), "{bad", record(3), record(2)]) + "\n")
    follower = Follower(spark, str(segments), str(tmp_path / "state"), lambda batch, k: seen.extend((k, r.seq) for r in batch.orderBy("seq").collect()))
    follower.run()
    (segments / "0002.jsonl").write_text("\n".join([record(3), record(4), record(6)]) + "\n")
    failing = {"left": 2}

    def writer(batch, k):
        if failing["left"]:
            failing["left"] -= 1
            raise OSError("the sink is away")
        seen.extend((k, r.seq) for r in batch.orderBy("seq").collect())

    slept = []
    Follower(spark, str(segments), str(tmp_path / "state"), writer).run(sleep=slept.append)
    assert seen == [(0, 1), (0, 3), (1, 4), (1, 6)] and slept == [0.05, 0.1]
    bad = spark.read.json(str(tmp_path / "state" / "quarantine")).collect()
    assert [(r.reason, r.line) for r in bad] == [("bad_json", "{bad")]
    (segments / "0003.jsonl").write_text(record(7) + "\n")
    failing["left"] = 99
    with pytest.raises(RuntimeError, match="tail_follow_exhausted"):
        Follower(spark, str(segments), str(tmp_path / "state"), writer).run(most_errors=2, sleep=lambda s: None)


def test_follower_takes_segments_by_name_whenever_they_were_written(spark, tmp_path):
    segments, seen = tmp_path / "segments", []
    segments.mkdir()
    names = ["1.jsonl", "2 [a]%20{b}.jsonl", "3.jsonl", "4+é.jsonl", "5.jsonl"]
    for k, name in enumerate(names):  # the last name was written first
        (segments / name).write_text("\n".join([record(2 * k), "{bad", record(2 * k + 1)]) + "\n")
        os.utime(segments / name, (1_700_000_000 - 60 * k,) * 2)
    follow = lambda: Follower(spark, str(segments), str(tmp_path / "state"), lambda batch, k: seen.extend((k, r.seq) for r in batch.orderBy("seq").collect()), 1, files_per_trigger=2).run()
    follow()
    assert seen == [(seq // 4, seq) for seq in range(1, 10)]
    (segments / "6.jsonl").write_text("\n".join([record(9), record(10)]) + "\n")
    follow()
    assert seen[9:] == [(3, 10)]
    assert spark.read.json(str(tmp_path / "state" / "quarantine")).count() == 5


def test_sinks(spark, tmp_path):
    batch = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(10)], "seq long, inst_id string")
    null, told, kept = sinks.Counting(), [], []

    def bad(b, k):
        raise ValueError("observer")

    first = sinks.Limited(7, lambda b, k: kept.extend(r.seq for r in b.orderBy("seq").collect()))
    both = sinks.tee(null, sinks.observed(bad, lambda b, k: told.append(k), bad), sinks.for_symbols(["a"], first), sinks.dead_letters(f"{tmp_path}/dead", lambda b: b.filter("seq = 3")))
    both(batch, 0)
    assert not first.done
    both(batch.withColumn("seq", F.col("seq") + 100), 1)
    both(batch.withColumn("seq", F.col("seq") + 100), 1)  # comes again
    assert null.accepted == 20 and told == [0, 1, 1] and kept == [0, 2, 4, 6, 8, 100, 102, 100, 102] and first.done
    assert spark.read.json(f"{tmp_path}/dead").count() == 1
    sinks.dead_letters(f"{tmp_path}/dead", lambda b: b.filter("nothing = 3"))(batch, 2)  # logged only
    with pytest.raises(NotImplementedError):
        null.read()


def test_hydrated_buckets_keep_the_last_ids(spark):
    seen = spark.createDataFrame([({"btc": ["a", "b", "a", "c"], "BTC": ["x"], "eth": []},)], "seen map<string,array<string>>")
    got = seen.select(state.hydrated(F.col("seen"), 2).alias("m")).first().m
    assert got["BTC"] in (["b", "c"], ["x"]) and got["ETH"] == [] and set(got) == {"BTC", "ETH"}
    assert list(dedup.Bucket(2, ["a", "b", "a", "c"]).ids) == ["b", "c"]
