"""Who may commit to a table: numbered claims, each of which one run can make.

A run opens a chunk by making the next claim, and closes it by making the one
after that. A claim is a file that is created only if it is not there, so of two
runs that go for one number one is told that it came second, and does not commit.
This is as exclusive as the file system's create is (HDFS, object stores with
conditional writes, a local disk for tests).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

OPEN, CLOSED = "open", "closed"
# Earlier claims than so many before the last one are removed.
_KEPT = 16


class TableBusy(RuntimeError):
    """Another run is loading the table, or has loaded it meanwhile."""


@dataclass(frozen=True)
class Claim:
    version: int
    kind: str = CLOSED
    run_id: str = ""
    attempt: int = 0
    chunk: int = 0

    def of(self, run_id: str, attempt: int) -> bool:
        return (self.run_id, self.attempt) == (run_id, attempt)


class Claims:
    """The claims on one table, as files in a folder that all drivers share."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(folder)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _file(self, version: int):
        return self._path(self._folder, f"{version:020d}")

    def head(self) -> Claim:
        """The last claim; one that was not written to its end belongs to nobody known."""
        versions = self._versions()
        if not versions:
            return Claim(0)
        stream = self._files.open(self._file(versions[-1]))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Claim(**json.loads(text)) if text else Claim(versions[-1], OPEN)

    def make(self, claim: Claim) -> bool:
        """Make a claim, unless its number is taken or passed."""
        versions = self._versions()
        if versions and versions[-1] >= claim.version:
            return False
        self._files.mkdirs(self._folder)
        try:
            stream = self._files.create(self._file(claim.version), False)
        except Py4JJavaError as error:
            if self._files.exists(self._file(claim.version)):
                return False
            raise error
        try:
            stream.write(json.dumps(asdict(claim)).encode())
        finally:
            stream.close()
        for old in [v for v in versions if v <= claim.version - _KEPT]:
            self._files.delete(self._file(old), False)
        return True
