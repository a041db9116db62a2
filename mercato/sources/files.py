"""Small driver-side helpers on the session's file system (local, HDFS or object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """List, read, publish and delete through Spark's Hadoop configuration."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of the entries directly below a folder; empty when it is missing."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)))

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> None:
        """Write a new file so that readers see all of it or nothing."""
        fs, draft = self._fs(path), path + ".draft"
        stream = fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not fs.rename(self._path(draft), self._path(path)):
            fs.delete(self._path(draft), False)
            raise FileExistsError(path)

    def move(self, path: str, target: str, modified: int) -> bool:
        """Rename a file and date its last change (milliseconds); whether the file system keeps that date."""
        fs, new = self._fs(path), self._path(target)
        fs.mkdirs(new.getParent())
        if not fs.rename(self._path(path), new):
            raise FileExistsError(target)
        fs.setTimes(new, modified, -1)
        return fs.getFileStatus(new).getModificationTime() == modified

    def size(self, path: str) -> int:
        """Bytes below a folder."""
        return self._fs(path).getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def delete(self, path: str) -> bool:
        return self._fs(path).delete(self._path(path), True)
