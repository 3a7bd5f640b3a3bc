"""Small files and folder listings through Hadoop, wherever the path is."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        plain = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = plain.getFileSystem(self._conf)
        self._root = plain.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory())
        self.path = self._root.toString()

    def names(self) -> list[str]:
        """What lies in the folder; nothing if it does not exist."""
        if not self._fs.exists(self._root):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._root))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put a file in place complete, or not at all if there is one of that name.

        The file is written under another name and then renamed, which fails where the new name
        is taken; on the local file system, where renaming replaces, it is linked instead.
        """
        draft = self._child(f".{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        try:
            return self._link(draft, self._child(name))
        finally:
            self._fs.delete(draft, False)

    def delete(self, name: str) -> None:
        self._fs.delete(self._child(name), True)

    def delete_all(self) -> None:
        self._fs.delete(self._root, True)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def _link(self, draft, target) -> bool:
        if draft.toUri().getScheme() == "file":
            try:
                os.link(_local(draft), _local(target))
            except FileExistsError:
                return False
            return True
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self._conf
        )
        options = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        none = self._gateway.new_array(options, 0)
        try:
            context.rename(draft, target, none)
        except Exception:
            if not self._fs.exists(target):
                raise
            return False
        return True


def _local(path) -> str:
    return unquote(urlparse(path.toString()).path)
