"""Columnar tables that are published as a whole, and refreshed partition by partition.

A table's folder holds ``data/<id>/``, what one publication wrote, and ``versions/<number>``,
a small file that names for every partition the folder it lies in.  Data is written
first and the version file last, by a rename: a reader sees the version before or the
version after, never half of one, and a failed write leaves nothing that is read.
Partitions that a refresh does not touch keep their files.

One writer at a time: a second one that publishes the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyspark.session import file_system

_WHOLE = ""  # the only "partition" of a table without partitions


class VersionedTable:
    """One table below ``path``, optionally split by one ``partition`` column."""

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        """The numbers of all published versions, oldest first."""
        return sorted(int(n) for n in self._names(f"{self.path}/versions") if n.isdigit())

    def _manifest(self, version: int | None = None) -> dict | None:
        known = self.versions()
        if not known:
            return None
        if version is not None and version not in known:
            raise ValueError(f"no version {version} of {self.path}")
        number = known[-1] if version is None else version
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{number:010d}")
        stream = file_system(self.spark, self.path).open(path)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {"number": number, **json.loads(text)}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest.

        The result is bound to that version: later publications do not change it.
        """
        manifest = self._manifest(version)
        if manifest is None:
            raise ValueError(f"nothing is published at {self.path}")
        schema = StructType.fromJson(manifest["schema"])
        parts = []
        for folder, names in manifest["parts"].items():
            base = f"{self.path}/data/{folder}"
            paths = [f"{base}/{n}" if n else base for n in names]
            parts.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts)

    # ------------------------------------------------------------ publication

    def publish(self, df: DataFrame) -> DataFrame:
        """Make ``df`` the whole table; it may be computed from the table itself."""
        before = self._manifest()
        folder, names = self._write(df)
        self._commit(before, df.schema, {folder: names})
        return self.read()

    def replace(self, df: DataFrame, values: Collection[object]) -> DataFrame:
        """Make ``df`` the rows of the partitions ``values``; all others stay as they are.

        A partition of ``values`` without rows in ``df`` goes.  Rows of other partitions
        are an error, found before anything is published.
        """
        if self.partition is None:
            raise ValueError("a table without partitions is published whole")
        before = self._manifest()
        if before is None:
            raise ValueError(f"nothing is published at {self.path}")
        if StructType.fromJson(before["schema"]) != _nullable(df.schema):
            raise ValueError("the columns differ from the published ones")
        replaced = {f"{self.partition}={v}" for v in values}
        folder, names = self._write(df)
        if extra := sorted(set(names) - replaced):
            raise ValueError(f"rows outside the replaced partitions: {extra[:5]}")
        parts = {f: [n for n in ns if n not in replaced] for f, ns in before["parts"].items()}
        self._commit(before, df.schema, {**{f: ns for f, ns in parts.items() if ns}, folder: names})
        return self.read()

    def _write(self, df: DataFrame) -> tuple[str, list[str]]:
        folder = uuid.uuid4().hex
        path = f"{self.path}/data/{folder}"
        if self.partition is None:
            df.write.mode("errorifexists").parquet(path)
            return folder, [_WHOLE]
        # A partition's rows together, so that it has few files; Spark splits large ones.
        df.hint("rebalance", self.partition).write.mode("errorifexists").partitionBy(self.partition).parquet(path)
        return folder, sorted(n for n in self._names(path) if "=" in n)

    def _commit(self, before: dict | None, schema: StructType, parts: dict[str, list[str]]) -> None:
        number = before["number"] + 1 if before else 1
        text = json.dumps({"schema": _nullable(schema).jsonValue(), "parts": {f: n for f, n in parts.items() if n}})
        fs, path = file_system(self.spark, self.path), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        draft, final = path(f"{self.path}/drafts/{uuid.uuid4().hex}"), path(f"{self.path}/versions/{number:010d}")
        out = fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        fs.mkdirs(final.getParent())
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {number} of {self.path} was published by someone else")

    def expire(self, keep: int = 2) -> list[int]:
        """Drop all but the newest ``keep`` versions, and the data only they name."""
        known = self.versions()
        kept = known[-keep:]
        needed = {f for v in kept for f in self._manifest(v)["parts"]}
        fs, path = file_system(self.spark, self.path), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        gone = [v for v in known if v not in kept]
        for v in gone:
            fs.delete(path(f"{self.path}/versions/{v:010d}"), False)
        for folder in self._names(f"{self.path}/data"):
            if folder not in needed:
                fs.delete(path(f"{self.path}/data/{folder}"), True)
        return gone

    def _names(self, folder: str) -> list[str]:
        fs, path = file_system(self.spark, self.path), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        if not fs.exists(path(folder)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(folder))]
        return [n for n in names if not n.startswith((".", "_"))]


def _nullable(schema: StructType) -> StructType:
    """The schema as it is read back: files do not promise that a column has no nulls."""
    out = StructType()
    for f in schema:
        out = out.add(f.name, f.dataType, True)
    return out
