"""Tables that are kept up: every change is a new version, and a version is there as a whole or not at all.

    <path>/data/batch=<id>/...      folders of Parquet, written first and never changed
    <path>/versions/<number>.json   what a version consists of, published last, by a rename that never overwrites

A writer that dies leaves a folder that no version names. Two writers that publish the same number can't both: the
later one is told so, reads the table again and repeats its change. Readers are pinned to a version. The reading of
a listing and the publishing are the only steps on the driver; rows are written by tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import delete


class Conflict(RuntimeError):
    """Another writer has published this version."""


class VersionedTable:
    """A table below `path`. `partition` names columns by which its files are laid out, and reads are pruned."""

    def __init__(self, spark: SparkSession, path: str, partition: tuple[str, ...] = ()):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    # the file system, as Spark sees it

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def _fs(self):
        return self._at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, at = self._fs(), self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    # versions

    def versions(self) -> list[int]:
        """The numbers published so far, ascending; `clean` removes old ones."""
        return sorted(int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def entry(self, version: int) -> dict:
        """What a version says: folders, schema, batches (the ids committed up to it)."""
        stream = self._fs().open(self._at("versions", f"{version:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version, the latest if none is named. Later versions don't change what was read."""
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version of {self.path}")
        entry = self.entry(version)
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["folders"]:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/batch={f}" for f in entry["folders"]])
        return rows.select(*schema.names)

    def write(self, rows: DataFrame) -> str:
        """Writes a folder that no version names yet, and returns its name."""
        folder = uuid.uuid4().hex
        rows.write.partitionBy(*self.partition).option("compression", "zstd").parquet(f"{self.path}/data/batch={folder}")
        return folder

    def publish(self, version: int, folders: list[str], schema: T.StructType, batches: list[str]) -> int:
        """Names folders as a version; the one step that makes them visible, and it happens once or not at all."""
        entry = json.dumps({"folders": folders, "schema": json.loads(schema.json()), "batches": batches})
        fs, draft, final = self._fs(), self._at("versions", f".draft-{uuid.uuid4().hex}"), self._at("versions", f"{version:010d}.json")
        out = fs.create(draft, True)
        out.write(entry.encode())
        out.close()
        jvm = self.spark._jvm
        once = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, final, once)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise Conflict(f"version {version} of {self.path} is there") from None
            raise
        return version

    def _change(self, make: Callable[[int | None], DataFrame | None], batch: str | None, keep: bool, attempts: int) -> int | None:
        for _ in range(attempts):
            base = self.latest()
            before = self.entry(base) if base is not None else {"folders": [], "batches": []}
            if batch is not None and batch in before["batches"]:
                return base
            rows = make(base)
            if rows is None:
                return base
            folder = self.write(rows)
            said = [*before["batches"], *([batch] if batch is not None else [])]
            try:
                return self.publish(0 if base is None else base + 1, [*(before["folders"] if keep else []), folder], rows.schema, said)
            except Conflict:
                delete(self.spark, f"{self.path}/data/batch={folder}")
        raise Conflict(f"{self.path} changed {attempts} times meanwhile")

    def update(self, change: Callable[[DataFrame | None], DataFrame], *, batch: str | None = None, attempts: int = 5) -> int:
        """Commits change(the latest rows, or None) as the next version. A batch id that is committed already does nothing."""
        return self._change(lambda base: change(None if base is None else self.read(base)), batch, False, attempts)

    def append(self, rows: DataFrame, key: str, *, batch: str | None = None, attempts: int = 5) -> int | None:
        """Commits the rows whose key the table lacks, beside the folders that are there.

        A key's rows lie in one partition (filings keep their year), so that only the partitions which the batch
        has are read for the comparison: their values, few as they are, become a predicate. Of rows that repeat a
        key within the batch one stays; rows without a key are left out.
        """
        rows = rows.filter(F.col(key).isNotNull()).dropDuplicates([key])

        def new(base: int | None) -> DataFrame:
            return rows if base is None else rows.join(self.stored_keys(rows, key, base), key, "left_anti")

        return self._change(new, batch, True, attempts)

    def stored_keys(self, rows: DataFrame, key: str, version: int) -> DataFrame:
        """The keys of a version within the partitions that `rows` have."""
        old = self.read(version)
        for column in self.partition:
            values = [r[0] for r in rows.select(column).distinct().collect()]  # partitions of one batch
            held = F.col(column).isin([v for v in values if v is not None])
            old = old.filter(held | F.col(column).isNull() if None in values else held)
        return old.select(key)

    def clean(self, keep: int = 2) -> list[str]:
        """Removes all but the last versions, and folders that none of those names: what dead writers left, too.

        Not for a time when others write: a folder that is about to be published is not named yet.
        """
        gone = self.versions()[:-keep]
        named = {f for v in self.versions()[-keep:] for f in self.entry(v)["folders"]}
        for v in gone:
            self._fs().delete(self._at("versions", f"{v:010d}.json"), False)
        lost = [n for n in self._names("data") if n.startswith("batch=") and n.removeprefix("batch=") not in named]
        for name in lost:
            delete(self.spark, f"{self.path}/data/{name}")
        return lost
