"""A WebSocket feed as a streaming source: ``spark.readStream.format("tickforge_websocket")``.

A thread of the driver holds the connection: it connects within a time, subscribes, sends a ping each interval, closes a
connection that has been silent for too long, and connects again after a pause that doubles, up to a most; with
``max_retries`` it gives up after so many failed waits in a row, and the query fails. Rows: n (from 0), received_ms, raw.

What has come waits in memory, ``buffer`` messages at most; beyond that the socket is not read, so that the exchange's side
holds back. Messages are kept until their batch is committed. A feed cannot be read again: after a restart of the driver, or
of the query, it goes on with what comes then.

Options: url (ws://host:port/path), subscribe (texts to send on connect, one a line), connect_timeout_s, silence_s, ping_s,
max_retries (none: for ever), max_backoff_s, buffer, batch.
"""

from __future__ import annotations

import base64
import hashlib
import os
import socket
import struct
import threading
import time
from collections import deque
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: Fixed value of the protocol (RFC 6455).
GUID = "258EAFA5-E914-47DA-95CA-C5AB0DC85B11"
TEXT, CLOSE, PING, PONG = 1, 8, 9, 10


class Closed(ConnectionError):
    def __init__(self, code: int | None, reason: str):
        super().__init__(f"code={'absent' if code is None else code}, reason={reason!r}")
        self.code, self.reason = code, reason


class Connection:
    """One WebSocket, as a client."""

    def __init__(self, url: str, timeout: float):
        at = urlsplit(url)
        if at.scheme != "ws" or not at.hostname:
            raise ValueError("url must be ws://host:port/path")
        self.socket = socket.create_connection((at.hostname, at.port or 80), timeout)
        try:
            key = base64.b64encode(os.urandom(16)).decode()
            path = (at.path or "/") + (f"?{at.query}" if at.query else "")
            self.socket.sendall(f"GET {path} HTTP/1.1\r\nHost: {at.netloc}\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Key: {key}\r\nSec-WebSocket-Version: 13\r\n\r\n".encode())
            self.held, self.parts = b"", []
            head = self._until(b"\r\n\r\n").decode("latin-1").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
            if " 101 " not in head[0] + " " or fields.get("sec-websocket-accept") != base64.b64encode(hashlib.sha1((key + GUID).encode()).digest()).decode():
                raise ConnectionError(f"no WebSocket: {head[0]}")
        except BaseException:
            self.socket.close()
            raise

    def _more(self) -> None:
        got = self.socket.recv(65536)
        if not got:
            raise Closed(None, "")
        self.held += got

    def _until(self, mark: bytes) -> bytes:
        while mark not in self.held:
            self._more()
        out, _, self.held = self.held.partition(mark)
        return out

    def send(self, data: bytes, kind: int = TEXT) -> None:
        mask = os.urandom(4)
        n = len(data)
        size = bytes([0x80 | n]) if n < 126 else struct.pack("!BH", 0x80 | 126, n) if n < 65536 else struct.pack("!BQ", 0x80 | 127, n)
        whole = (mask * (n // 4 + 1))[:n]
        self.socket.sendall(bytes([0x80 | kind]) + size + mask + (int.from_bytes(data, "big") ^ int.from_bytes(whole, "big")).to_bytes(n, "big"))

    def _frame(self) -> tuple[bool, int, bytes] | None:
        """The next whole frame of what is held."""
        h = self.held
        if len(h) < 2:
            return None
        n, at = h[1] & 127, 2
        if n > 125:
            wide = 2 if n == 126 else 8
            if len(h) < 2 + wide:
                return None
            n, at = int.from_bytes(h[2 : 2 + wide], "big"), 2 + wide
        if h[1] & 128:
            raise ConnectionError("a server's frames are not masked")
        if len(h) < at + n:
            return None
        self.held = h[at + n :]
        return bool(h[0] & 128), h[0] & 15, h[at : at + n]

    def receive(self, wait: float) -> str | None:
        """The next text, or None if none is whole within the time."""
        self.socket.settimeout(max(wait, 0.001))
        while True:
            frame = self._frame()
            if frame is None:
                try:
                    self._more()
                except TimeoutError:
                    return None
                continue
            last, kind, data = frame
            if kind == PING:
                self.send(data, PONG)
            elif kind == CLOSE:
                raise Closed(int.from_bytes(data[:2], "big") if len(data) > 1 else None, data[2:].decode("utf-8", "replace"))
            elif kind < 3:
                self.parts.append(data)
                if last:
                    text, self.parts = b"".join(self.parts).decode("utf-8", "replace"), []
                    return text

    def close(self) -> None:
        self.socket.close()


class Feed:
    """The connection and what has come over it."""

    def __init__(self, options: dict):
        get = lambda name, default: type(default)(options.get(name, default))
        self.url, self.subscribe = options["url"], [x for x in options.get("subscribe", "").split("\n") if x]
        self.timeout, self.silence, self.ping, self.most_wait = get("connect_timeout_s", 10.0), get("silence_s", 60.0), get("ping_s", 30.0), get("max_backoff_s", 30.0)
        self.buffer, self.retries = get("buffer", 20_000), int(options["max_retries"]) if "max_retries" in options else None
        self.messages: deque[tuple[int, int, str]] = deque()
        self.lock, self.stopped, self.n, self.fault, self.connects = threading.Condition(), False, 0, None, 0
        threading.Thread(target=self._run, daemon=True).start()

    def _run(self) -> None:
        attempt = 0
        while not self.stopped:
            one = None
            try:
                one = Connection(self.url, self.timeout)
                attempt, self.connects = 0, self.connects + 1
                for x in self.subscribe:
                    one.send(x.encode())
                self._listen(one)
            except (OSError, ValueError) as e:
                if self.retries is not None and attempt >= self.retries:
                    with self.lock:
                        self.fault = e
                    return
                wait = min(2.0**attempt, self.most_wait)
                attempt += 1
                with self.lock:
                    self.lock.wait_for(lambda: self.stopped, wait)
            finally:
                if one:
                    one.close()

    def _listen(self, one: Connection) -> None:
        heard = pinged = time.monotonic()
        while not self.stopped:
            now = time.monotonic()
            if now - heard > self.silence:
                raise Closed(None, "silent")
            if now - pinged >= self.ping:
                one.send(b"ping")
                pinged = now
            text = one.receive(min(0.2, self.ping, self.silence))
            if text is not None:
                heard = time.monotonic()
                with self.lock:
                    self.lock.wait_for(lambda: self.stopped or len(self.messages) < self.buffer)
                    self.messages.append((self.n, int(time.time() * 1000), text))
                    self.n += 1

    def between(self, start: int, end: int) -> list[tuple[int, int, str]]:
        with self.lock:
            return [m for m in self.messages if start <= m[0] < end]

    def forget(self, end: int) -> None:
        with self.lock:
            while self.messages and self.messages[0][0] < end:
                self.messages.popleft()
            self.lock.notify_all()

    def stop(self) -> None:
        with self.lock:
            self.stopped = True
            self.lock.notify_all()


class Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.batch, self.feed = options, int(options.get("batch", 10_000)), None

    def _on(self) -> Feed:
        self.feed = self.feed or Feed(self.options)
        return self.feed

    def initialOffset(self) -> dict:
        return {"n": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        feed = self._on()
        if feed.fault and not feed.between(start["n"], feed.n):
            raise feed.fault
        feed.n = max(feed.n, start["n"])
        rows = feed.between(start["n"], start["n"] + self.batch)
        return iter(rows), {"n": rows[-1][0] + 1 if rows else start["n"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._on().between(start["n"], end["n"]))

    def commit(self, end: dict) -> None:
        self._on().forget(end["n"])


class WebSocketSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tickforge_websocket"

    def schema(self) -> str:
        return "n long, received_ms long, raw string"

    def simpleStreamReader(self, schema) -> Reader:
        return Reader(dict(self.options))
