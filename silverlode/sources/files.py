"""Small files and folders on the storage that Spark uses, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, place = self._at(folder)
        if not system.exists(place):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(place))

    def read(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, data: str | bytes) -> None:
        """Write a file that appears with all its data or not at all; it must not exist yet."""
        system, place = self._at(path)
        _, draft = self._at(f"{path}.{uuid.uuid4().hex}.draft")
        stream = system.create(draft, False)
        stream.write(bytearray(data.encode() if isinstance(data, str) else data))
        stream.close()
        if system.exists(place) or not system.rename(draft, place):
            system.delete(draft, False)
            raise FileExistsError(f"{path} was written by another load")

    def size(self, path: str) -> int:
        """Bytes of a file or of all files in a folder; `path` may be one of `inputFiles`."""
        place = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(path))
        return place.getFileSystem(self._conf).getContentSummary(place).getLength()

    def remove(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)
