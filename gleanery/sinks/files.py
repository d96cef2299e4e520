"""Driver-side file operations through Hadoop's FileSystem, so that any storage
Spark can write to works."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = str(path).rstrip("/")
        root = self._path(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self, pattern: str) -> list[str]:
        """File names that match a glob inside the folder."""
        found = self._fs.globStatus(self._path(f"{self.path}/{pattern}"))
        return sorted(status.getPath().getName() for status in found or [])

    def move(self, name: str, target: str) -> None:
        source, goal = self._path(f"{self.path}/{name}"), self._path(target)
        if not self._fs.rename(source, goal):
            raise OSError(f"Could not move {source} to {goal}")

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._path(f"{self.path}/{name}".rstrip("/")), True)

    def make(self) -> None:
        self._fs.mkdirs(self._path(self.path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def sizes(self, pattern: str = "*") -> list[tuple[str, int, int]]:
        """Name, length and time of change of the files that match a glob."""
        found = self._fs.globStatus(self._path(f"{self.path}/{pattern}"))
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found or [])

    def read_text(self, name: str) -> str:
        path = self._path(f"{self.path}/{name}")
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(f"{self.path}/{name}"), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
