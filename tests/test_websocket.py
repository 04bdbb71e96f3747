"""The WebSocket source against a server of the test's own."""

import base64
import hashlib
import socket
import struct
import threading
import time

import pytest

from tickforge.operators import ingest
from tickforge.sources import websocket


class Server:
    """Takes one connection after the other; each has a script of texts, then is closed."""

    def __init__(self, scripts, close=struct.pack("!H", 1011) + b"gone"):
        self.scripts, self.close, self.heard, self.at = scripts, close, [], socket.create_server(("127.0.0.1", 0))
        self.url = f"ws://127.0.0.1:{self.at.getsockname()[1]}/feed"
        threading.Thread(target=self.run, daemon=True).start()

    def frame(self, data, kind=1):
        n = len(data)
        return bytes([128 | kind]) + (bytes([n]) if n < 126 else struct.pack("!BH", 126, n)) + data

    def run(self):
        for script in self.scripts:
            c, _ = self.at.accept()
            head = b""
            while b"\r\n\r\n" not in head:
                head += c.recv(4096)
            key = next(x.split(b": ")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"sec-websocket-key"))
            accept = base64.b64encode(hashlib.sha1(key + websocket.GUID.encode()).digest())
            c.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + accept + b"\r\n\r\n")
            c.settimeout(0.3)
            c.sendall(self.frame(b"hi", 9))
            for text in script:
                raw = self.frame(text.encode())
                c.sendall(raw[:3])
                c.sendall(raw[3:])
            try:
                while got := c.recv(4096):
                    self.heard.append(got)
            except TimeoutError:
                pass
            if self.close is not None:
                c.sendall(self.frame(self.close, 8))
                c.close()
        self.at.close()


def trade(k):
    return f'{{"action":"update","arg":{{"channel":"trade","instId":"BTCUSDT"}},"data":[{{"ts":{1000 + k},"price":"{k + 1}.5","size":"1","side":"buy","tradeId":"{k}"}}]}}'


def wait_for(f, seconds=20):
    end = time.time() + seconds
    while not f() and time.time() < end:
        time.sleep(0.05)
    return f()


def test_connects_again_and_keeps_order():
    server = Server([["a", "b" * 300], ["c"]])
    feed = websocket.Feed({"url": server.url, "subscribe": '{"op":"subscribe"}', "max_backoff_s": "0.1"})
    assert wait_for(lambda: feed.n == 3) and feed.connects == 2
    assert [x[2] for x in feed.between(0, 9)] == ["a", "b" * 300, "c"] and [x[0] for x in feed.between(1, 3)] == [1, 2]
    feed.forget(2)
    assert [x[0] for x in feed.between(0, 9)] == [2]
    feed.stop()
    assert len(server.heard) >= 2  # the subscription and the pong, masked


def test_gives_up_after_its_retries():
    free = socket.create_server(("127.0.0.1", 0))
    url = f"ws://127.0.0.1:{free.getsockname()[1]}"
    free.close()
    reader = websocket.Reader({"url": url, "max_retries": "2", "max_backoff_s": "0.05"})
    reader.read({"n": 0})
    assert wait_for(lambda: reader.feed.fault)
    with pytest.raises(OSError):
        reader.read({"n": 0})


def test_a_silent_connection_is_closed_and_a_full_buffer_waits():
    server = Server([["a"], ["b", "c", "d"]], close=None)
    feed = websocket.Feed({"url": server.url, "silence_s": "0.3", "max_backoff_s": "0.05", "buffer": "3"})
    assert wait_for(lambda: feed.connects == 2 and feed.n == 3)
    time.sleep(0.3)
    assert feed.n == 3 and [x[2] for x in feed.between(0, 9)] == ["a", "b", "c"]
    feed.forget(1)
    assert wait_for(lambda: feed.n == 4)
    feed.stop()


def test_no_websocket_is_an_error():
    with pytest.raises(ValueError, match="url"):
        websocket.Connection("http://127.0.0.1:1", 1)


def test_stream_of_a_feed(spark, tmp_path):
    server = Server([["pong", trade(0), trade(1)], [trade(2), "{bad"]])
    spark.dataSource.register(websocket.WebSocketSource)
    raw = spark.readStream.format("tickforge_websocket").option("url", server.url).option("max_backoff_s", "0.1").load()
    got = []
    q = raw.writeStream.foreachBatch(lambda b, k: got.extend((r.n, r.raw) for r in b.collect())).option("checkpointLocation", str(tmp_path)).start()
    try:
        assert wait_for(lambda: len(got) == 5, 60), (got, q.exception())
    finally:
        q.stop()
    rows = spark.createDataFrame(got, "n long, raw string")
    out = ingest.classify(rows).select("n", "kind").collect()
    assert sorted((r.n, r.kind) for r in out) == [(0, "pong"), (1, "trade"), (2, "trade"), (3, "trade"), (4, "bad_json")]
