"""Numbered commit files in a shared folder, each written by exactly one writer.

A commit is a small JSON file named by its number. It is written under another
name and then renamed without overwriting, which on a distributed file system
either happens once or not at all; so of two writers that want the same
number one is told, and looks again. (A local disk checks before it renames,
which is enough for one process.) Commits lie in folders of ``PER_FOLDER``, so
the newest are found without listing them all. None is ever removed: a writer
that was held up must not find a number free again.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PER_FOLDER = 1000


class CommitLog:
    """The commits ``<path>/<folder>/<number>.json``, numbers from 1 without gaps."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self.path = path
        root = jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = root.getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at().toUri(), conf)

    def _at(self, name: str = ""):
        p = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return self._fs.makeQualified(p)

    def _names(self, folder: str = "") -> list[str]:
        at = self._at(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _file(self, number: int) -> str:
        return f"{number // PER_FOLDER}/{number}.json"

    def numbers(self, after: int = 0) -> list[int]:
        """Numbers of the commits behind ``after``, in order."""
        folders = [f for f in self._names() if f.isdigit() and int(f) >= after // PER_FOLDER]
        found = (int(n[:-5]) for f in folders for n in self._names(f) if n.endswith(".json"))
        return sorted(n for n in found if n > after)

    def last(self) -> int:
        """The highest number, 0 without commits."""
        for folder in sorted((f for f in self._names() if f.isdigit()), key=int, reverse=True):
            found = [int(n[:-5]) for n in self._names(folder) if n.endswith(".json")]
            if found:
                return max(found)
        return 0

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._at(self._file(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def put(self, number: int, commit: dict) -> bool:
        """Write commit ``number`` if there is none yet; False when there is."""
        staged, target = self._at(f"staged/{uuid.uuid4().hex}"), self._at(self._file(number))
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps(commit, sort_keys=True).encode()))
        out.close()
        self._fs.mkdirs(target.getParent())
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._files.rename(staged, target, options)
        except Py4JJavaError as e:
            self._fs.delete(staged, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True
