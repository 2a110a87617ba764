"""Numbered commits in a folder, each of which exactly one writer can make.

A commit is a file named by its number, created only if it is not there yet: of two
writers that read state n, one makes n + 1 and the other learns that it came too late.
"""

from __future__ import annotations

import json
import os
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitLog:
    """The commits below a folder that all writers can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._folder = spark._jvm, folder.rstrip("/")
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self._folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, number: int):
        # Padded, so that names are in the order of numbers.
        return self._path(f"{self._folder}/{number:020d}.json")

    def numbers(self) -> list[int]:
        folder = self._path(self._folder)
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> tuple[int, dict] | None:
        """The last commit and its content; one that is being written counts once it is whole."""
        for number in reversed(self.numbers()):
            stream = self._fs.open(self._file(number))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                return number, json.loads(text)
        return None

    def commit(self, number: int, content: dict) -> bool:
        """Make commit ``number``; False if another writer has made it."""
        text = json.dumps(content) + "\n"
        self._fs.mkdirs(self._path(self._folder))
        where = self._fs.makeQualified(self._file(number)).toString()
        if urlparse(where).scheme == "file":
            # Hadoop's local file system looks first and creates then; the operating system does both at once.
            try:
                handle = os.open(unquote(urlparse(where).path), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "w") as out:
                out.write(text)
            return True
        try:
            out = self._fs.create(self._file(number), False)
        except Py4JJavaError as e:
            if self._fs.exists(self._file(number)):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True


def log_folder(spark: SparkSession, table: str) -> str:
    """Where the commits of a table's name lie: beside its schema's tables."""
    schema, _, name = table.rpartition(".")
    schema = schema or spark.catalog.currentDatabase()
    location = spark.sql(f"DESCRIBE SCHEMA {schema}").where("info_name = 'Location'").first()["info_value"]
    return f"{location.rstrip('/')}/_commits/{name.lower()}"
