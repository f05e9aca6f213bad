"""One writer at a time: a lease file that only one call can create.

The holder renews it while it works; a lease that was not renewed for
``LEASE_SECONDS`` belongs to a call that died and may be taken over.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from tessera import fsutil

LEASE_SECONDS = 600.0     # without a renewal


class Busy(RuntimeError):
    """Another call holds the lease."""


class Lease:
    """``with Lease(spark, path, wait): ...``; ``wait``: seconds to wait for
    another holder before ``Busy`` is raised."""

    def __init__(self, spark: SparkSession, path: str, wait: float = 0.0):
        self.spark, self.path, self.wait = spark, path, wait
        self.owner, self.ended = uuid.uuid4().hex, threading.Event()

    def _holder(self) -> tuple[str, float] | None:
        """(owner, time of the last renewal), None without a lease."""
        text = fsutil.read_text(self.spark, self.path)
        owner, _, renewed = (text or "").partition(" ")
        return (owner, float(renewed)) if renewed else None

    def _text(self) -> bytes:
        return f"{self.owner} {time.time()}".encode()

    def _try(self) -> bool:
        if fsutil.create_new(self.spark, self.path, self._text()):
            return True
        held = self._holder()
        facts = fsutil.file_facts(self.spark, self.path)
        # a lease without text is being written, or its writer died at that
        last = held[1] if held else facts[1] / 1000 if facts else time.time()
        if time.time() - last <= LEASE_SECONDS:
            return False
        # of several calls that find it expired one moves it away
        gone = f"{self.path}.{self.owner}"
        if self._holder() == held and fsutil.rename(self.spark, self.path, gone):
            fsutil.delete(self.spark, gone)
        return fsutil.create_new(self.spark, self.path, self._text())

    def _renew(self) -> None:
        while not self.ended.wait(LEASE_SECONDS / 4):
            held = self._holder()
            if held and held[0] == self.owner:
                fsutil.write_bytes(self.spark, self.path, self._text())

    def holds(self) -> bool:
        held = self._holder()
        return bool(held) and held[0] == self.owner

    def __enter__(self) -> Lease:
        until = time.time() + self.wait
        while not self._try():
            if time.time() >= until:
                raise Busy(f"{self.path} is held by a call that is still running")
            time.sleep(min(1.0, max(0.05, self.wait / 20)))
        threading.Thread(target=self._renew, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self.ended.set()
        if self.holds():
            fsutil.delete(self.spark, self.path)
