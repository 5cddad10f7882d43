"""Names of folders and small files in the file system of a path; no data passes the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _of(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._system.exists(self._of(name))

    def make(self, name: str = "") -> None:
        self._system.mkdirs(self._of(name))

    def names(self, name: str = "", pattern: str = "*") -> list[str]:
        """Names in a folder that fit a pattern, sorted; none if it is missing."""
        found = self._system.globStatus(self._of(f"{name}/{pattern}" if name else pattern))
        return sorted(status.getPath().getName() for status in found or [])

    def move(self, name: str, to: str) -> None:
        if not self._system.rename(self._of(name), self._of(to)):
            raise OSError(f"{self.root}/{name} could not be moved to {to}")

    def remove(self, name: str) -> None:
        self._system.delete(self._of(name), True)

    def write(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all: written aside, then renamed."""
        self.remove(f"{name}.part")
        stream = self._system.create(self._of(f"{name}.part"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.remove(name)
        self.move(f"{name}.part", name)

    def read(self, name: str) -> str:
        stream = self._system.open(self._of(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
