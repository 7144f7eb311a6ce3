"""A gate that tasks anywhere on a cluster pass before they call a service.

The driver keeps it while judges are asked: at most so many calls are under way at a
time, and a refusal by quota makes all tasks wait.  A task takes a lease, calls, and gives
the lease back with the pause that the service asked for; a lease that isn't given back (its
executor is lost) runs out.  Only leases pass through, no prompts and no answers.
"""

from __future__ import annotations

import json
import secrets
import socket
import socketserver
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


class Gate:
    """The gate itself; ``clock`` tells seconds."""

    def __init__(self, at_once: int, lease: float, clock: Callable[[], float] = time.monotonic):
        self._at_once, self._lease, self._clock = at_once, lease, clock
        self._held: dict[int, float] = {}
        self._until, self._last = 0.0, 0
        self._lock = threading.Lock()
        self.pauses = 0

    def take(self) -> dict[str, Any]:
        """A lease, or how long to wait before asking again."""
        with self._lock:
            now = self._clock()
            self._held = {k: t for k, t in self._held.items() if t > now}
            if self._until > now:
                return {"wait": self._until - now}
            if len(self._held) >= self._at_once:
                return {"wait": 0.02}
            self._last += 1
            self._held[self._last] = now + self._lease
            return {"lease": self._last}

    def give(self, lease: int, pause: float = 0.0) -> dict[str, Any]:
        with self._lock:
            self._held.pop(lease, None)
            if pause > 0:
                self.pauses += 1
                self._until = max(self._until, self._clock() + pause)
            return {}


class _Lines(socketserver.StreamRequestHandler):
    disable_nagle_algorithm = True

    def handle(self) -> None:
        for line in self.rfile:  # a task keeps its connection
            told = json.loads(line)
            if not secrets.compare_digest(str(told.pop("key", "")), self.server.key):
                return
            does = {"take": self.server.gate.take, "give": self.server.gate.give}[told.pop("do")]
            self.wfile.write(json.dumps(does(**told)).encode() + b"\n")


class _Server(socketserver.ThreadingTCPServer):
    daemon_threads = True
    allow_reuse_address = True
    gate: Gate
    key: str


#: The connection of each thread.
_open = threading.local()


@dataclass(frozen=True)
class Pass:
    """What a task needs to pass the gate."""

    host: str
    port: int
    key: str

    def _say(self, **what: Any) -> dict[str, Any]:
        """One connection a thread, opened again if it was lost."""
        line = json.dumps(what | {"key": self.key}).encode() + b"\n"
        known: dict[Any, Any] = _open.__dict__
        f, told = known.get(self), b""
        if f is not None:
            try:
                f.write(line)
                f.flush()
                told = f.readline()
            except OSError:
                told = b""
        if not told:
            with socket.create_connection((self.host, self.port), timeout=30) as s:
                s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
                f = s.makefile("rwb")  # keeps the connection open
            f.write(line)
            f.flush()
            told = f.readline()
            known.clear()
            known[self] = f
        return json.loads(told)

    def take(self, sleep: Callable[[float], None] = time.sleep) -> int:
        """Wait for a lease."""
        while "lease" not in (got := self._say(do="take")):
            sleep(min(got["wait"], 5.0))
        return got["lease"]

    def give(self, lease: int, pause: float = 0.0) -> None:
        self._say(do="give", lease=lease, pause=pause)


class opened:
    """``with opened(spark, 4) as pass_:`` keeps a gate on the driver for a while."""

    def __init__(self, spark: SparkSession, at_once: int, lease: float = 600.0):
        self._server = _Server(("0.0.0.0", 0), _Lines)
        self._server.gate, self._server.key = Gate(at_once, lease), secrets.token_hex(16)
        self.gate = self._server.gate
        self._pass = Pass(spark.conf.get("spark.driver.host", "127.0.0.1"), self._server.server_address[1], self._server.key)

    def __enter__(self) -> Pass:
        threading.Thread(target=self._server.serve_forever, daemon=True).start()
        return self._pass

    def __exit__(self, *_: object) -> None:
        self._server.shutdown()
        self._server.server_close()
