"""Versions of a table folder: data in folders of their own, and one small record per commit.

A table's folder holds ``data-<id>`` folders, which are written once and never changed, and
``_commits/<number>.json``, one record a version. A version exists when its record does: the
record is written aside and renamed to the next free number, which fails if another writer has
taken it, and that writer then takes the one after. So a reader sees the old version or the
new one, whole, also while a write fails half-way, and a table can be rewritten from itself.

All of it goes through Hadoop's file API, as Spark's own readers and writers do; what the
driver lists and reads is one record per kept version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

RECORDS = "_commits"
#: Hours after which data that no record names counts as left by a failed write.
ORPHAN_HOURS = 24


class VersionMissing(LookupError):
    """The table has no such version, or no longer."""


@dataclass(frozen=True)
class Version:
    """One committed state of a table."""

    number: int
    folder: str
    schema: dict
    partition_by: Sequence[str] = field(default_factory=list)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(self.schema)


class TableFolder:
    """The versions of one table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _listed(self, name: str = "") -> list[tuple[str, datetime]]:
        """Names in a folder with the times of their last change."""
        if not self._files.exists(self._at(name)):
            return []
        found = self._files.listStatus(self._at(name))
        return [(s.getPath().getName(), datetime.fromtimestamp(s.getModificationTime() / 1000)) for s in found]

    def numbers(self) -> list[int]:
        """Numbers of the versions there are, ascending."""
        return sorted(int(name[:-5]) for name, _ in self._listed(RECORDS) if name.endswith(".json") and name[0].isdigit())

    def version(self, number: int | None = None) -> Version | None:
        """A version, by default the last; None if the table has none at all."""
        known = self.numbers()
        if not known:
            return None
        number = known[-1] if number is None else number
        if number not in known:
            raise VersionMissing(f"{self.path} has versions {known}, not {number}")
        stream = self._files.open(self._at(f"{RECORDS}/{number:012d}.json"))
        try:
            return Version(**json.loads(self._io.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def new_folder(self) -> str:
        """A folder for the data of the next version, relative to the table's."""
        return f"data-{uuid.uuid4().hex}"

    def commit(self, folder: str, schema: StructType, partition_by: Sequence[str] = ()) -> Version:
        """Make the data in ``folder`` the table's last version."""
        last = self.numbers()
        number = last[-1] + 1 if last else 1
        while True:
            version = Version(number, folder, schema.jsonValue(), list(partition_by))
            aside = self._at(f"{RECORDS}/.{uuid.uuid4().hex}")
            stream = self._files.create(aside, False)
            try:
                stream.write(bytearray(json.dumps(asdict(version)).encode()))
            finally:
                stream.close()
            if self._renamed(aside, self._at(f"{RECORDS}/{number:012d}.json")):
                return version
            number += 1

    def _renamed(self, source, target) -> bool:
        """False if the target is there already."""
        nothing = self._hadoop.fs.Options.Rename.NONE
        options = self._gateway_array(nothing)
        try:
            self._hadoop.fs.FileContext.getFileContext(source.toUri(), self._conf).rename(source, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self._files.delete(source, False)
            return False
        return True

    def _gateway_array(self, option):
        from pyspark import SparkContext

        options = SparkContext._gateway.new_array(self._hadoop.fs.Options.Rename, 1)
        options[0] = option
        return options

    def sweep(self, keep: int, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        """Delete all but the last ``keep`` versions, and data of failed writes that is older than
        ``orphan_hours``; returns the folders deleted. Readers of a deleted version fail, so keep
        as many as replacements can happen while a reader runs."""
        old = self.numbers()[: -max(1, keep)]
        gone = []
        for number in old:
            gone.append(self.version(number).folder)
            # the record goes first: a version never lacks its data
            self._files.delete(self._at(f"{RECORDS}/{number:012d}.json"), False)
        named = {self.version(n).folder for n in self.numbers()}
        before = datetime.now() - timedelta(hours=orphan_hours)
        gone += [name for name, changed in self._listed() if name.startswith("data-") and name not in named and changed < before]
        for folder in dict.fromkeys(gone):
            self._files.delete(self._at(folder), True)
        return list(dict.fromkeys(gone))
