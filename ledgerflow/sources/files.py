"""The few file operations that Spark's readers and writers do not offer, on any file system Spark reaches."""

from __future__ import annotations

import hashlib
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

class Files:
    """Files below one root, through the file system that the session resolves it to."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._hadoop = spark, spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def folders(self) -> dict[str, int]:
        """Folders directly below the root, with the time of their last change in seconds."""
        if not self.exists(""):
            return {}
        listed = self._fs.listStatus(self._path(""))
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in listed if s.isDirectory()}

    def fingerprint(self, name: str) -> str:
        """Digest of the data files below a table's folder: names, lengths and times. Empty when there is none."""
        if not self.exists(name):
            return ""
        found, listed = [], self._fs.listFiles(self._path(name), True)
        while listed.hasNext():
            status = listed.next()
            path = status.getPath().toUri().getPath()
            if not path.rpartition("/")[2].startswith(("_", ".")):
                found.append((path, status.getLen(), status.getModificationTime()))
        return hashlib.sha256(repr(sorted(found)).encode()).hexdigest() if found else ""

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def create_if_absent(self, name: str, text: str) -> bool:
        """The file with all its text, unless a file of that name is there: of several callers one succeeds.

        Written under a name of its own, then given its final name in one step
        that fails if the name is taken.
        """
        folder, _, file = name.rpartition("/")
        own = f"{folder}/.{uuid.uuid4().hex}-{file}"
        stream = self._fs.create(self._path(own), False)
        stream.write(text.encode())
        stream.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                path = [self._path(n).toUri().getPath() for n in (own, name)]
                os.link(*path)
            else:
                context = self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
                rename = getattr(self._hadoop.fs, "Options$Rename")
                none = self._spark.sparkContext._gateway.new_array(rename, 0)
                context.rename(self._path(own), self._path(name), none)
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        finally:
            self._fs.delete(self._path(own), False)
        return True
