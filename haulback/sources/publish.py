"""Sets of tables that are put in place together.

Tables are written beside their place, and only when all of them are there are they moved, so that a
run which fails leaves the former set as it was. The moves are written down before the first of them:
should a run end among them, the next one, or ``finish_started``, carries them out. A manifest of the
set is written last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import SparkSession

MANIFEST = "_published.json"
STARTED = "_publishing.json"


class Stage(NamedTuple):
    """Where a set is written: tables go to ``path(name)``, their place is ``name`` in the directory."""

    directory: str
    folder: str
    names: list[str]

    def path(self, name: str, *parts: str) -> str:
        """Where to write the table, of which only the ``parts`` (subfolders) are replaced, if given."""
        self.names.extend(f"{name}/{part}" for part in parts) if parts else self.names.append(name)
        return f"{self.directory}/{self.folder}/{name}"


class _Files:
    """The file system of a directory, local or shared."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.directory = directory
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(directory).getFileSystem(spark._jsc.hadoopConfiguration())
        self._streams = spark._jvm.org.apache.commons.io.IOUtils

    def at(self, name: str):
        return self._path(f"{self.directory}/{name}")

    def exists(self, name: str) -> bool:
        return self._system.exists(self.at(name))

    def delete(self, name: str) -> None:
        self._system.delete(self.at(name), True)

    def move(self, name: str, to: str) -> None:
        """Put a file or folder in place of another."""
        self.delete(to)
        self._system.mkdirs(self.at(to).getParent())
        if not self._system.rename(self.at(name), self.at(to)):
            raise OSError(f"{self.directory}: {name} could not be moved to {to}")

    def read(self, name: str) -> dict:
        stream = self._system.open(self.at(name))
        try:
            return json.loads(self._streams.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, content: dict) -> None:
        """The file is there as a whole or not at all."""
        beside = f"_{uuid.uuid4().hex}.json"
        stream = self._system.create(self.at(beside))
        try:
            stream.write(bytearray(json.dumps(content, indent=1).encode()))
        finally:
            stream.close()
        self.move(beside, name)


@contextmanager
def publication(spark: SparkSession, directory: str) -> Iterator[Stage]:
    """Write a set of tables, then put it in place of the former one.

    If the block fails, nothing in the directory has changed. Readers of the former set's files are
    cut off when the new ones come in.
    """
    finish_started(spark, directory)
    stage = Stage(directory, f"_staged-{uuid.uuid4().hex}", [])
    files = _Files(spark, directory)
    try:
        yield stage
    except BaseException:
        files.delete(stage.folder)
        raise
    there = [name for name in stage.names if files.exists(f"{stage.folder}/{name}")]
    empty = [name for name in stage.names if name not in there]
    files.write(STARTED, {"folder": stage.folder, "tables": there, "empty": empty})
    finish_started(spark, directory)


def finish_started(spark: SparkSession, directory: str) -> bool:
    """Carry out the moves of a run that ended among them; true if there was one."""
    files = _Files(spark, directory)
    if not files.exists(STARTED):
        return False
    started = files.read(STARTED)
    for name in started["tables"]:
        if files.exists(f"{started['folder']}/{name}"):  # else it has been moved before
            files.move(f"{started['folder']}/{name}", name)
    for name in started["empty"]:  # what the new set has no rows for
        files.delete(name)
    known = (set(published(spark, directory)) | set(started["tables"])) - set(started["empty"])
    files.write(MANIFEST, {"tables": sorted(known)})
    files.delete(started["folder"])
    files.delete(STARTED)
    return True


def published(spark: SparkSession, directory: str) -> list[str]:
    """The tables put in place so far; none if no run has come to its end."""
    files = _Files(spark, directory)
    return files.read(MANIFEST)["tables"] if files.exists(MANIFEST) else []
