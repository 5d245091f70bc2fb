"""Versions of a table as folders, and the small files that say which folders count.

A version is written beside the current one and becomes current by one small commit file, so a run
that is lost midway leaves the previous state as it was."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Files:
    """Small files through Spark's own Hadoop file system."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, uri: str):
        return self._jvm.org.apache.hadoop.fs.Path(uri)

    def _fs(self, uri: str):
        return self._path(uri).getFileSystem(self._conf)

    def read(self, uri: str) -> str | None:
        fs, path = self._fs(uri), self._path(uri)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, uri: str) -> list[str]:
        fs, path = self._fs(uri), self._path(uri)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def largest(self, uri: str) -> int:
        """Bytes of the largest file at a path, in a folder or of a pattern."""
        fs, most = self._fs(uri), 0
        for found in fs.globStatus(self._path(uri)) or ():
            under = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
            most = max([most, *(f.getLen() for f in under)])
        return most

    def delete(self, uri: str) -> None:
        self._fs(uri).delete(self._path(uri), True)

    def create(self, uri: str, text: str) -> bool:
        """Write a new file; false, and nothing written, where it is there already."""
        fs = self._fs(uri)
        fs.mkdirs(self._path(uri).getParent())
        try:
            out = fs.create(self._path(uri), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            if fs.exists(self._path(uri)):
                return False
            raise
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return True

    def replace(self, uri: str, text: str) -> None:
        """Write beside the file, then rename over it in one step."""
        fs = self._fs(uri)
        temporary = f"{uri}.{uuid.uuid4().hex}.tmp"
        out = fs.create(self._path(temporary), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        target = fs.makeQualified(self._path(uri))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self._conf
        )
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(option.OVERWRITE.getClass(), 1)
        options[0] = option.OVERWRITE
        context.rename(fs.makeQualified(self._path(temporary)), target, options)


class StaleRun(RuntimeError):
    """Another run made a later version current while this one was at work."""


@dataclass(frozen=True)
class VersionedTable:
    """One table of one stream: a folder per version, and a commit file that says which folder counts.

    A commit file is created and never overwritten by another run, so of two runs that began from one
    version the second fails. ``current.json`` only says where to start looking for the last commit."""

    spark: SparkSession
    uri: str
    schema: str

    def _commit_file(self, version: int) -> str:
        return f"{self.uri}/commits/v{version:012d}.json"

    def _facts(self, version: int) -> dict | None:
        text = Files(self.spark).read(self._commit_file(version))
        return None if text is None else json.loads(text)

    def info(self) -> dict | None:
        """What was committed last: the version, its folder, and the facts stored with it."""
        hint = Files(self.spark).read(f"{self.uri}/current.json")
        version = json.loads(hint)["version"] if hint else 0
        found = self._facts(version) if version else None
        while (later := self._facts(version + 1)) is not None:
            version, found = version + 1, later
        return found

    def version(self) -> int:
        info = self.info()
        return 0 if info is None else info["version"]

    def new_path(self, version: int) -> str:
        """An unused folder for a version that is not committed yet."""
        # No "key=value" folder name: Spark would read it as a partition column.
        return f"{self.uri}/v{version:012d}-{uuid.uuid4().hex[:12]}"

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows, the current one by default; empty where there is none.

        A DataFrame stays bound to its version's folder, so it is a snapshot."""
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        facts = self._facts(version)
        if facts is None:
            raise ValueError(f"version {version} of {self.uri} is not there")
        return self.spark.read.schema(self.schema).parquet(facts["path"])

    def write(self, df: DataFrame, version: int) -> str:
        """Write a version without making it current; returns its folder."""
        path = self.new_path(version)
        df.write.parquet(path)
        return path

    def commit(self, version: int, path: str, replay: bool = False, **facts) -> None:
        """Make a written version current. A replay of the run that committed this version may replace
        it; any other raises StaleRun where the version is taken."""
        files, text = Files(self.spark), json.dumps({"version": version, "path": path, **facts})
        if not files.create(self._commit_file(version), text):
            if not replay:
                raise StaleRun(f"version {version} of {self.uri} was committed by another run")
            files.replace(self._commit_file(version), text)
        files.replace(f"{self.uri}/current.json", json.dumps({"version": version}))

    def retain(self, keep: int) -> None:
        """Delete what is older than the last ``keep`` versions."""
        files, version = Files(self.spark), self.version() - max(1, keep)
        while version > 0 and (facts := self._facts(version)) is not None:
            for path in (facts["path"], *facts.get("outputs", ()), self._commit_file(version)):
                files.delete(path)
            version -= 1
