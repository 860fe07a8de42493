"""Folders with versions: write, audit, publish; and logs of decisions.

A version is one small file in the folder's log that names the data folders it is
made of.  Data are written under new names first, then checked as they lie there,
and only then does a version name them.  A version's file is created at once or not at
all, under the next number: of two writers that started from the same version one is
refused, and a reader sees the old version or the new one, never a part.  Versions
name whole folders, so a partition that is no longer wanted is just not named again.

The log's entries list folders, at most one for each partition or append since the last
compaction; the driver reads entries, never rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType


class AuditFailed(ValueError):
    """Staged data did not pass; nothing was published."""


class Conflict(ValueError):
    """Another writer published first."""


@dataclass(frozen=True)
class Version:
    """What one entry of the log says."""

    number: int
    folders: dict[str, str] = field(default_factory=dict)  #: data folders by partition, or by number of an append
    schema: str | None = None


class VersionedFolder:
    """A folder whose content changes as a whole."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # -- the log

    def versions(self) -> list[int]:
        """Numbers of the versions that the log holds, ascending."""
        log = self._path(f"{self.root}/_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self, number: int | None = None) -> Version:
        """The newest version, or an older one that the log still holds; number 0 before the first."""
        known = self.versions()
        if number is None:
            number = known[-1] if known else 0
        if number == 0:
            return Version(0)
        if number not in known:
            raise KeyError(f"no version {number} in {self.root}")
        stream = self._fs.open(self._path(self._entry(number)))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, **json.loads(text))

    def _entry(self, number: int) -> str:
        return f"{self.root}/_log/{number:020d}.json"

    def _publish(self, base: Version, folders: Mapping[str, str], schema: str) -> Version:
        """The next version after base, made at once or refused."""
        new = Version(base.number + 1, dict(folders), schema)
        part = self._path(f"{self.root}/_log/.{uuid.uuid4().hex}.part")
        out = self._fs.create(part, True)
        try:
            out.write(bytearray(json.dumps({"folders": new.folders, "schema": schema}).encode()))
        finally:
            out.close()
        try:
            self._claim(part, self._path(self._entry(new.number)))
        finally:
            self._fs.delete(part, False)
        return new

    def _claim(self, part, entry) -> None:
        """Give a whole file its name unless the name is taken: a link in local folders, a rename elsewhere."""
        if self._fs.getScheme() == "file":
            try:
                os.link(part.toUri().getPath(), entry.toUri().getPath())
            except FileExistsError:
                raise Conflict(entry.getName()) from None
        elif self._fs.exists(entry) or not self._fs.rename(part, entry):
            raise Conflict(entry.getName())

    # -- data

    def _place(self) -> str:
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def _stage(self, df: DataFrame, place: str, by: str | None = None) -> dict[str, str]:
        """Folders by partition of rows written under a new name."""
        if by is None:
            df.write.parquet(place)
            return {"": place}
        df.withColumn("_part", F.coalesce(F.col(by).cast("string"), F.lit("__null__"))).write.partitionBy("_part").parquet(place)
        found = self._fs.listStatus(self._path(place))
        names = [s.getPath().getName() for s in found if s.isDirectory()]
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(n.removeprefix("_part=")): f"{place}/{n}" for n in names}

    def _load(self, folders: Sequence[str], schema: str) -> DataFrame:
        kind = StructType.fromJson(json.loads(schema))
        if not folders:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(*folders)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version."""
        found = self.current(number)
        if found.schema is None:
            raise KeyError(f"nothing published in {self.root}")
        return self._load(list(found.folders.values()), found.schema)

    def publish(self, df: DataFrame, checks: Mapping[str, Callable[[DataFrame], bool]] | None = None, by: str | None = None, expected: Sequence[str] | None = None, base: Version | None = None) -> Version:
        """A new version: rows staged, audited as staged, and named.

        With ``by`` only the partitions that df has are replaced and the others stay; of these, only the
        ``expected`` ones if given.  ``base`` is the version that the writer started from, the newest by default.
        A failed write or audit leaves the versions as they were and removes what was staged.
        """
        base, place = base or self.current(), self._place()
        try:
            staged = self._stage(df, place, by)
            whole = self._load(list(staged.values()), df.schema.json())
            failed = [name for name, check in (checks or {}).items() if not check(whole)]
            if failed:
                raise AuditFailed(", ".join(failed))
            folders = staged if by is None else {**base.folders, **staged}
            if expected is not None:
                folders = {k: v for k, v in folders.items() if k in set(expected)}
            return self._publish(base, folders, df.schema.json())
        except BaseException:
            self._fs.delete(self._path(place), True)
            raise

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes versions before the last ``keep`` and data that none of these names; readers of older versions must be done."""
        kept = self.versions()[-keep:]
        named = {f for n in kept for f in self.current(n).folders.values()}
        gone = []
        data = self._path(f"{self.root}/data")
        for top in self._fs.listStatus(data) if self._fs.exists(data) else []:
            path = f"{self.root}/data/{top.getPath().getName()}"
            inside = [f"{path}/{s.getPath().getName()}" for s in self._fs.listStatus(top.getPath()) if s.isDirectory()]
            dead = [path] if path not in named and not named.intersection(inside) else [p for p in inside if path not in named and p not in named]
            for p in dead:
                self._fs.delete(self._path(p), True)
            gone += dead
        for n in self.versions()[:-keep]:
            self._fs.delete(self._path(self._entry(n)), False)
        return gone


class DecisionLog(VersionedFolder):
    """Decisions per key, appended version by version; the last one of a key counts."""

    def __init__(self, spark: SparkSession, root: str, key: str) -> None:
        super().__init__(spark, root)
        self.key = key

    def append(self, decisions: DataFrame, base: Version | None = None) -> Version:
        """Decisions of one writer, one row per key; refused if another wrote since ``base``."""
        base = base or self.current()
        twice = lambda df: df.groupBy(self.key).count().where("count > 1").isEmpty()
        dated = decisions.withColumn("_version", F.lit(base.number + 1).cast("long"))
        if base.schema is not None and [(f.name, f.dataType) for f in StructType.fromJson(json.loads(base.schema))] != [(f.name, f.dataType) for f in dated.schema]:
            raise ValueError("decisions of other columns than those of the log")
        place = self._place()
        try:
            staged = self._stage(dated, place)
            if not twice(self._load([staged[""]], dated.schema.json())):
                raise AuditFailed(f"a {self.key} with several decisions")
            return self._publish(base, {**base.folders, str(base.number + 1): staged[""]}, dated.schema.json())
        except BaseException:
            self._fs.delete(self._path(place), True)
            raise

    def history(self, number: int | None = None) -> DataFrame:
        """All decisions since the last compaction, with their version."""
        return self.read(number)

    def state(self, number: int | None = None) -> DataFrame:
        """The last decision of each key."""
        rows = self.read(number)
        last = rows.withColumn("_r", F.row_number().over(Window.partitionBy(self.key).orderBy(F.desc("_version")))).where("_r = 1")
        return last.drop("_r")

    def compact(self) -> Version:
        """A version with the same state in one folder."""
        base = self.current()
        if len(base.folders) < 2:
            return base
        place = self._place()
        try:
            staged = self._stage(self.state(base.number), place)
            return self._publish(base, {f"to {base.number}": staged[""]}, base.schema)
        except BaseException:
            self._fs.delete(self._path(place), True)
            raise

    def merge(self, records: DataFrame, undecided: Mapping[str, Column]) -> DataFrame:
        """Records with their decision; those without one have the given values.  Fields of a record are the record's own."""
        own = [f.name for f in records.schema]
        names = [c for c in self.state().columns if c not in own and c != "_version"] if self.current().number else list(undecided)
        if not self.current().number:
            return records.withColumns(dict(undecided)).withColumn("_version", F.lit(0).cast(LongType()))
        found = self.state().select(self.key, "_version", *names, F.lit(True).alias("_found"))
        joined = records.join(found, self.key, "left")
        filled = {c: F.when(F.col("_found"), F.col(c)).otherwise(undecided.get(c, F.lit(None))) for c in names}
        return joined.withColumns(filled | {"_version": F.coalesce("_version", F.lit(0).cast("long"))}).drop("_found")
