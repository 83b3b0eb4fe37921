"""Folders and small files of the store that Spark writes to, through its Hadoop client. Listings and notes, no rows."""

import uuid

from pyspark.sql import SparkSession


class Store:
    """The file system that `path` lies in, whichever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, sorted; nothing if there is none."""
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def files(self, folder: str) -> list[tuple[str, int]]:
        """Path and bytes of every data file below a folder, sorted by path. Names that begin with `_` or `.` are no data."""
        found, waiting = [], [self._at(folder)]
        while waiting:
            for status in self._fs.listStatus(waiting.pop()):
                name = status.getPath().getName()
                if status.isDirectory():
                    if not name.startswith(".") and (not name.startswith("_") or "=" in name):
                        waiting.append(status.getPath())
                elif not name.startswith(("_", ".")):
                    found.append((status.getPath().toString(), status.getLen()))
        return sorted(found)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str = "") -> None:
        """A new file that appears whole. Raises FileExistsError if there is one."""
        folder, _, name = path.rpartition("/")
        draft, final = self._at(f"{folder}/.{name}-{uuid.uuid4().hex}"), self._at(path)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        self._fs.delete(self._at(path), True)
