"""Every query with SQL gives DuckDB's rows on the smallest tables; the FIFO rule agrees with a plain model."""

import random

import duckdb
import pytest

from tickforge import registry
from tickforge.operators.dedup import Bucket, fifo_dedup
from tickforge.streaming.ingest import append_batch

DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DIR).toPandas()
    want = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = lambda f: sorted(map(tuple, f[cols].astype(str).to_numpy().tolist()))
    assert rows(got) == rows(want)


def same_as_sql(spark, name, folder):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = c.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, str(folder)).toPandas()
    cols = sorted(want.columns)
    rows = lambda f: sorted(map(tuple, f[cols].astype(str).to_numpy().tolist()))
    assert sorted(got.columns) == cols and rows(got) == rows(want)


def made_events(spark, folder, n, user, value):
    spark.range(n).selectExpr("id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", f"{user} AS user_id", "'a' AS event_type", f"cast({value} AS double) AS value", "'' AS props").write.parquet(f"{folder}/events.parquet")


@pytest.fixture(scope="module")
def unpriced(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("unpriced")
    made_events(spark, folder, 480, "id % 9", "CASE WHEN id % 7 = 0 THEN 0 WHEN id % 7 = 3 THEN -1 ELSE 2.25 END")
    return folder


@pytest.mark.parametrize("name", ["explode_trades", "monotone_replay", "quarantine_report", "trade_contract", "dead_letters", "skip_episodes", "stream_tail_follow", "torn_tail_reasons", "parse_classify_outcomes"])
def test_events_whose_price_no_tick_can_have(spark, unpriced, name):
    same_as_sql(spark, name, unpriced)


@pytest.fixture(scope="module")
def untimed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("untimed")
    ts = "CASE WHEN id % 7 = 0 THEN timestamp_seconds(-id) WHEN id % 7 <> 3 THEN timestamp_seconds(1704067200 + id) END"
    value = "CASE id % 11 WHEN 1 THEN 'NaN' WHEN 2 THEN 'Infinity' WHEN 3 THEN '-Infinity' WHEN 4 THEN '1E-300' WHEN 5 THEN '1E300' WHEN 6 THEN NULL ELSE '2.25' END"
    spark.range(480).selectExpr("id AS event_id", f"cast({ts} AS timestamp_ntz) AS ts", "id % 9 AS user_id", "'a' AS event_type", f"cast({value} AS double) AS value", "'' AS props").write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["monotone_replay", "stream_tail_follow", "trade_contract", "quarantine_report", "dead_letters", "parse_classify_outcomes", "skip_episodes", "torn_tail_reasons"])
def test_events_whose_time_no_tick_can_have(spark, untimed, name):
    same_as_sql(spark, name, untimed)


def test_floor_lookup_below_the_newest_256_entries(spark, tmp_path):
    made_events(spark, tmp_path, 130_500, "id % 1500", "1")
    same_as_sql(spark, "seq_floor_lookup", tmp_path)


def test_stream_ingest_of_ids_that_come_again_after_the_window(spark, tmp_path):
    made_events(spark, tmp_path, 10_503, "id % 10501", "1")
    same_as_sql(spark, "stream_journal_ingest", tmp_path)


def test_an_id_in_the_journal_stays_out_of_later_batches(spark, tmp_path):
    write, cols = append_batch(f"{tmp_path}/journal", once=True), "arrival long, inst_id string, trade_id string"
    for k, ids in ((0, "aba"), (1, "cbca"), (1, "cbca"), (2, "ad")):  # the second batch is repeated
        write(spark.createDataFrame([(10 * k + i, "s" if i % 2 else "S", x) for i, x in enumerate(ids)], cols), k)
    got = spark.read.parquet(f"{tmp_path}/journal").collect()
    assert sorted((x.seq, x.arrival, x.trade_id) for x in got) == [(1, 0, "a"), (2, 1, "b"), (3, 10, "c"), (4, 21, "d")]


def test_flagship(spark):
    assert registry.flagship(spark, DIR).count() > 0


def test_bucket_keeps_the_last_accepted():
    b = Bucket(3, ["t0", "t1", "t2", "t3"])
    assert list(b.ids) == ["t1", "t2", "t3"]
    assert b.accept("t0") and not b.accept("t2")


def test_ids_come_again_after_the_window(spark, tmp_path):
    ids = [*range(10_001), 0, 10_000, 1]  # 0 has left the window, 10,000 has not; 1 left it when 0 came again
    rows = [(k, u, "a", 5.0) for k, u in enumerate(ids)] + [(20_000 + k, 7, "b", 5.0) for k in range(2)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").selectExpr("event_id", "timestamp_seconds(1704067200 + event_id) AS ts", "user_id", "event_type", "value", "'' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    want = [("a", str(u)) for u in [*range(10_001), 0, 1]] + [("b", "7")]
    got = sorted(registry.flagship(spark, str(tmp_path)).collect(), key=lambda x: x.seq)
    assert [(x.inst_id, x.trade_id) for x in got] == want and [x.seq for x in got] == list(range(1, len(want) + 1))
    replayed = sorted(registry.queries()["replay_from_cursor_symbols"](spark, str(tmp_path)).collect(), key=lambda x: x.seq)
    assert [x.trade_id for x in replayed] == [u for s, u in want if s == "a"][100:]


def test_fifo_against_model(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["a", "A", "b"]), str(r.randint(0, 9))) for i in range(400)]
    want, seen = [], {}
    for i, s, t in rows:
        ids = seen.setdefault(s.upper(), [])
        if t not in ids:
            want.append(i)
            seen[s.upper()] = [*ids, t][-4:]
    got = fifo_dedup(spark.createDataFrame(rows, "arrival long, inst_id string, trade_id string"), 4)
    assert sorted(x.arrival for x in got.collect()) == want
