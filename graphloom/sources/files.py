"""Small files and folders on whatever file system Spark is set up for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from graphloom.errors import GraphError


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        system, target = self._at(path)
        return system.exists(target)

    def folders(self, path: str) -> list[str]:
        system, target = self._at(path)
        if not system.exists(target):
            return []
        return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())

    def files(self, path: str) -> list[str]:
        system, target = self._at(path)
        if not system.exists(target):
            return []
        return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isFile())

    def delete(self, path: str) -> None:
        system, target = self._at(path)
        system.delete(target, True)

    def rename(self, path: str, to: str) -> None:
        system, target = self._at(path)
        if not system.rename(target, self._at(to)[1]):
            raise GraphError(f"{path} could not be renamed to {to}")

    def publish(self, path: str, text: str) -> None:
        """A new file that is there as a whole or not at all; whoever comes second to one name is refused."""
        if self.exists(path):
            raise GraphError(f"{path} exists already")
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        self.write_text(draft, text)
        self.rename(draft, path)

    def read_text(self, path: str) -> str:
        system, target = self._at(path)
        stream = system.open(target)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        system, target = self._at(path)
        stream = system.create(target, True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
