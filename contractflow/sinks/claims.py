"""Claims of runs on a table: who is at work, who has broken off.

A claim is a file below ``_claims/<table>`` that only one run can create. While the run works, a heartbeat writes the time into it.
A claim whose heart has stopped for a lease belongs to a broken run; a run that fails in an orderly way says so itself. A run that is
still at work is never taken for a broken one, however long it takes.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

#: Seconds without a heartbeat after which a run counts as broken, and seconds between two beats.
LEASE, BEAT = 120.0, 20.0
#: Name of the claim of the one run that may rewrite a table.
WRITER = "_writer"

LIVE, BROKEN = "live", "broken"


class Claims:
    def __init__(self, spark: SparkSession, root: str, *, lease: float = LEASE, beat: float = BEAT, clock: Callable[[], float] = time.time):
        self.spark, self.root, self.lease, self.beat, self.clock = spark, root.rstrip("/"), lease, beat, clock

    # -- files ---------------------------------------------------------------

    def _path(self, table: str, run: str) -> str:
        return f"{self.root}/_claims/{quote(table, safe='')}/{quote(run, safe='')}"

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _local(self, path: str) -> str | None:
        """The path for this process where the tables lie on a local disk, as on a developer machine."""
        fs, hadoop_path = self._fs(path)
        return hadoop_path.toUri().getPath() if fs.getScheme() == "file" else None

    def _create(self, path: str, content: bytes) -> bool:
        """Create a file unless it is there; of several callers one succeeds."""
        local = self._local(path)
        if local is not None:  # Hadoop's local file system looks first and creates then
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "xb") as f:
                    f.write(content)
                return True
            except FileExistsError:
                return False
        fs, hadoop_path = self._fs(path)
        try:
            stream = fs.create(hadoop_path, False)
        except Exception:  # noqa: BLE001 - each file system has its own error for a file that exists
            if fs.exists(hadoop_path):
                return False
            raise
        stream.write(bytearray(content))
        stream.close()
        return True

    def _write(self, path: str, content: bytes) -> None:
        fs, hadoop_path = self._fs(path)
        stream = fs.create(hadoop_path, True)
        stream.write(bytearray(content))
        stream.close()

    def _read(self, path: str) -> dict | None:
        """What a claim says; nothing if it is gone. One that is being written counts as live since now."""
        fs, hadoop_path = self._fs(path)
        try:
            stream = fs.open(hadoop_path)
            text = bytes(stream.readAllBytes())
            stream.close()
        except Exception:  # noqa: BLE001 - removed in between
            return None
        try:
            return json.loads(text)
        except ValueError:
            return {"state": LIVE, "beat": fs.getFileStatus(hadoop_path).getModificationTime() / 1000 if fs.exists(hadoop_path) else 0}

    def _remove(self, path: str) -> None:
        fs, hadoop_path = self._fs(path)
        fs.delete(hadoop_path, False)

    def _content(self, state: str) -> bytes:
        return json.dumps({"state": state, "beat": self.clock()}).encode()

    def _dead(self, claim: dict) -> bool:
        return claim["state"] == BROKEN or self.clock() - claim["beat"] > self.lease

    # -- runs ----------------------------------------------------------------

    def broken(self, table: str) -> list[str]:
        """Runs that began on a table and are neither at their end nor at work."""
        fs, folder = self._fs(f"{self.root}/_claims/{quote(table, safe='')}")
        if not fs.exists(folder):
            return []
        names = [unquote(s.getPath().getName()) for s in fs.listStatus(folder) if not s.getPath().getName().startswith(".")]
        return sorted(n for n in names if not n.startswith(WRITER) and (c := self._read(self._path(table, n))) and self._dead(c))

    def release(self, table: str, run: str) -> None:
        """Forget a run whose traces have been removed."""
        self._remove(self._path(table, run))

    def wait_until_free(self, table: str, run: str) -> bool:
        """Wait while a run of this name is at work elsewhere. True if one has broken off, and its traces are still there."""
        path = self._path(table, run)
        while (claim := self._read(path)) is not None:
            if self._dead(claim):
                return True
            time.sleep(min(self.beat, 1.0))
        return False

    def _bury(self, path: str) -> None:
        """Take a dead claim away. If another run has replaced it since it was read, that one is put back."""
        grave = f"{path}.{uuid.uuid4().hex}"
        (fs, old), (_, new) = self._fs(path), self._fs(grave)
        if fs.rename(old, new):
            claim = self._read(grave)
            if claim is not None and not self._dead(claim):
                self._create(path, json.dumps(claim).encode())
            self._remove(grave)

    @contextmanager
    def held(self, table: str, run: str, *, wait: float = 0.0) -> Iterator[None]:
        """Hold a claim while the body works: gone after a good end, marked as broken after an error."""
        path, until = self._path(table, run), time.monotonic() + wait
        while not self._create(path, self._content(LIVE)):
            claim = self._read(path)
            if claim is not None and self._dead(claim):
                self._bury(path)
            elif time.monotonic() > until:
                raise RuntimeError(f"{table}: claimed by another run ({run})")
            else:
                time.sleep(min(self.beat, 0.2))
        stop = threading.Event()

        def heart() -> None:
            while not stop.wait(self.beat):
                self._write(path, self._content(LIVE))

        thread = threading.Thread(target=heart, name=f"claim-{table}", daemon=True)
        thread.start()
        try:
            yield
        except BaseException:
            stop.set()
            thread.join()
            if run == WRITER:
                self._remove(path)
            else:
                self._write(path, self._content(BROKEN))
            raise
        stop.set()
        thread.join()
        self._remove(path)
