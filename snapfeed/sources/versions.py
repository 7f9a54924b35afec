"""A small state in numbered files: each version is put only if nobody else has put it.

The files lie in a folder that the driver reaches by Spark's file systems, so any
path that Spark reads will do. The newest file is the state; older ones are kept
for a while, for readers that have just listed them.
"""

from __future__ import annotations

import errno
import json
import os
import uuid
from collections.abc import Callable
from typing import Any
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Versions that stay behind the newest one.
KEPT = 8

_ABSENT = "java.io.FileNotFoundException"
_PRESENT = "org.apache.hadoop.fs.FileAlreadyExistsException"


class Store:
    """Small files below a folder, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._folder = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; none if it does not exist."""
        try:
            return [status.getPath().getName() for status in self._fs.listStatus(self._at(name))]
        except Py4JJavaError as error:
            if error.java_exception.getClass().getName() != _ABSENT:
                raise
            return []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> str | None:
        """Text of a file; ``None`` if there is none."""
        try:
            stream = self._fs.open(self._at(name))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getName() != _ABSENT:
                raise
            return None
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a whole file unless there is one of that name; tells if it was written.

        The text goes to a file of another name first. A store whose renames are
        atomic and refuse an existing target (HDFS and what follows it, local
        folders) lets one of several writers win.
        """
        folder, slash, last = name.rpartition("/")
        draft = f"{folder}{slash}_draft-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        uri = urlparse(self._fs.resolvePath(self._at(draft)).toString())
        if uri.scheme == "file":  # Hadoop's rename replaces local files
            source = unquote(uri.path)
            try:
                os.link(source, os.path.join(os.path.dirname(source), last))
                return True
            except FileExistsError:
                return False
            except OSError as error:
                if error.errno not in (errno.EPERM, errno.ENOTSUP):
                    raise
            finally:
                self.remove(draft)
            raise OSError(errno.ENOTSUP, "a local folder without hard links cannot refuse a second writer", source)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        refuse = self._jvm.java.lang.reflect.Array.newInstance(kind.NONE.getClass(), 1)
        refuse[0] = kind.NONE
        try:
            files.rename(self._at(draft), self._at(name), refuse)
            return True
        except Py4JJavaError as error:
            self.remove(draft)
            if error.java_exception.getClass().getName() != _PRESENT:
                raise
            return False

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class Versions:
    """A JSON state below a folder, replaced as a whole by :meth:`change`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.store = Store(spark, path)

    def _numbers(self) -> list[int]:
        names = (name.removesuffix(".json") for name in self.store.names() if name.endswith(".json"))
        return sorted(int(name) for name in names if name.isdigit())

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:020}.json"

    def read(self) -> tuple[int, Any]:
        """Number and state of the newest version; (0, ``None``) before the first."""
        while numbers := self._numbers():
            text = self.store.read(self._name(numbers[-1]))
            if text is not None:  # else a newer one has come, and this one is gone
                return numbers[-1], json.loads(text)
        return 0, None

    def change(self, new: Callable[[Any], Any]) -> bool:
        """Put ``new(state)`` as the next version; ``None`` leaves all as it is, and the answer is false.

        ``new`` is asked again if another version has come in between, so it must
        depend on the state alone.
        """
        changed = False
        while True:
            number, state = self.read()
            wanted = new(state)
            if wanted is None:
                return changed
            if not self.store.put(self._name(number + 1), json.dumps(wanted)):
                continue
            changed = True
            # a number may be free because a newer version had it removed
            if self._numbers()[-1] == number + 1:
                self.trim()
                return True

    def trim(self, kept: int = KEPT) -> None:
        """Remove versions that are not among the newest ones."""
        for number in self._numbers()[: -(kept + 1)]:
            self.store.remove(self._name(number))
