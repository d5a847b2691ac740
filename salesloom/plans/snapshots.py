"""A month-partitioned table in versions: readers see the last whole one, whatever a writer does or breaks off.

Months are written to folders of their own and never changed. A manifest lists the folder of each month; a version is a manifest file, put in place by one
rename. Writing a version again under the same number fails, so of two writers one has to start anew. Old folders stay until prune() takes
those that no kept version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NONE = "none"  # the month of rows without a date


class Snapshots:
    """Versions of a table below ``path``; ``partition`` is its month column, which the stored rows don't carry."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        """Numbers of all whole versions."""
        folder = self._at("versions")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def months(self, version: int | None = None) -> dict[str, str]:
        """Folder of each month (ISO date or NONE) in a version, by default the last."""
        known = self.versions()
        if not known:
            return {}
        text = self.spark.read.text(f"{self.path}/versions/v{known[-1] if version is None else version:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, schema: T.StructType, months: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows of a version, of some months if they are named; other months are not listed or read."""
        known = self.months(version)
        folders = [f"{self.path}/{known[m]}" for m in (known if months is None else months) if m in known]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame, touched: Iterable[str]) -> int:
        """A new version in which ``rows`` (with the month column) are all rows of the months ``touched``; gives its number.

        A touched month without rows is no longer in it.
        """
        version = (self.versions() or [0])[-1] + 1
        before, folder = self.months(), f"data/{uuid.uuid4().hex}"
        month = F.coalesce(F.col(self.partition).cast("string"), F.lit(NONE))
        rows.withColumn(self.partition, month).hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/{folder}")
        made = {n.split("=", 1)[1]: f"{folder}/{n}" for n in (s.getPath().getName() for s in self._files.listStatus(self._at(folder))) if "=" in n}
        gone = set(touched)
        self._publish(version, {**{m: f for m, f in before.items() if m not in gone}, **made})
        return version

    def _publish(self, version: int, months: Mapping[str, str]) -> None:
        draft = self._at(f"drafts/{uuid.uuid4().hex}.json")
        out = self._files.create(draft)
        out.write(bytearray(json.dumps(months, sort_keys=True).encode()))
        out.close()
        self._files.mkdirs(self._at("versions"))
        target = self._at(f"versions/v{version:012d}.json")
        if self._files.exists(target) or not self._files.rename(draft, target):
            raise RuntimeError(f"version {version} of {self.path} was written by someone else")

    def prune(self, keep: int = 2) -> None:
        """Take away the versions but the last ``keep`` and the data folders that none of these names."""
        known = self.versions()
        used = {f.split("/")[1] for v in known[-keep:] for f in self.months(v).values()}
        for v in known[:-keep]:
            self._files.delete(self._at(f"versions/v{v:012d}.json"), False)
        if self._files.exists(self._at("data")):
            for s in self._files.listStatus(self._at("data")):
                if s.getPath().getName() not in used:
                    self._files.delete(s.getPath(), True)
