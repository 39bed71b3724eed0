"""A folder of tables that stays readable while it is refreshed.

Every refresh writes its tables under a folder of its own, ``runs/<run>``.  Only
when all of them are there a manifest, ``manifests/<number>.json``, names for
each table the folder that holds it; readers follow the manifest with the
highest number.  A refresh that fails midway leaves the last manifest, and with
it the old tables, as they are.  Folders that neither the new manifest nor the
one before names are removed after the swap, so a reader that has just opened
the previous tables can finish.

The folder may be on any file system Spark can reach; a manifest is written
aside and renamed into place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

#: columns that tables are laid out by where they have them, before their grain
CLUSTER_BY = ("tenant_code", "school_year")


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def _listed(self, name: str) -> list[str]:
        p = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _manifests(self) -> list[str]:
        return [n for n in self._listed("manifests") if n.endswith(".json")]

    def _read(self, manifest: str) -> dict[str, str]:
        text = self.spark.read.text(f"{self.base}/manifests/{manifest}", wholetext=True).first()[0]
        return json.loads(text)

    def tables(self) -> dict[str, str]:
        """Table name -> folder below the base, as of the last finished refresh."""
        names = self._manifests()
        return self._read(names[-1]) if names else {}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{self.tables()[name]}")

    def begin(self) -> Refresh:
        return Refresh(self, uuid.uuid4().hex)

    def swap(self, written: dict[str, str]) -> None:
        """Make the written tables, with the old ones not written anew, the
        current ones and remove what is no longer named."""
        names = self._manifests()
        before = self._read(names[-1]) if names else {}
        now = before | written
        number = int(names[-1].split(".")[0]) + 1 if names else 0
        aside, place = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/{number:09d}.json")
        out = self._fs.create(aside)
        out.write(bytearray(json.dumps(now, indent=1).encode()))
        out.close()
        if not self._fs.rename(aside, place):
            raise RuntimeError(f"another refresh made manifest {number} first")
        kept = set(now.values()) | set(before.values())
        for run in self._listed("runs"):
            for table in self._listed(f"runs/{run}"):
                if f"runs/{run}/{table}" not in kept:
                    self._fs.delete(self._path(f"runs/{run}/{table}"), True)
            if not self._listed(f"runs/{run}"):
                self._fs.delete(self._path(f"runs/{run}"), True)
        for name in names[:-1]:
            self._fs.delete(self._path(f"manifests/{name}"), False)


class Refresh:
    """One refresh: tables written aside until ``finish``."""

    def __init__(self, store: Store, run: str):
        self.store, self.run = store, run
        self.written: dict[str, str] = {}

    @property
    def root(self) -> str:
        return f"{self.store.base}/runs/{self.run}"

    def add(self, name: str) -> None:
        self.written[name] = f"runs/{self.run}/{name}"

    def finish(self) -> None:
        self.store.swap(self.written)


def layout(columns: list[str], grain: tuple[str, ...]) -> tuple[str, ...]:
    """The columns a table is range-partitioned and sorted by: tenant and
    year, then its grain, so a tenant with a third of all rows is many files."""
    first = [c for c in CLUSTER_BY if c in columns]
    return (*first, *(g for g in grain if g in columns and g not in first)) if first else ()
