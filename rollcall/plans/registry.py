"""Dataset registry and the ``Warehouse`` that resolves names to DataFrames.

A dataset is a function ``(wh) -> DataFrame`` registered with its grain and
domain.  ``Warehouse(name)`` returns a registered dataset (built once per
Warehouse and memoized as a lazy plan) or a staging relation.  A full refresh
(``build``) writes each dataset in dependency order and reads it back, which
cuts lineage at every table like the reference's table materializations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..session import size_tables_in_memory


@dataclass(frozen=True)
class Dataset:
    name: str
    fn: Callable
    grain: tuple[str, ...]
    domain: str
    kind: str  # build | dim | fct | brg | msr | qc
    materialized: str  # table | ephemeral


DATASETS: dict[str, Dataset] = {}


def dataset(name: str, grain: tuple[str, ...] = (), domain: str = "core", materialized: str | None = None):
    """Register a dataset.  Builds (``bld_*``) are ephemeral unless told
    otherwise: inlined into the one dataset that reads them."""
    kind = name.split("_", 1)[0] if name.split("_", 1)[0] in ("dim", "fct", "brg", "msr", "qc") else "build"
    materialized = materialized or ("ephemeral" if kind == "build" else "table")

    def deco(fn):
        DATASETS[name] = Dataset(name, fn, tuple(grain), domain, kind, materialized)
        return fn
    return deco


class Warehouse:
    """Resolves dataset names to DataFrames.

    With ``materialize=True`` (the default) every dataset that another dataset
    reads is written once as a parquet table under the shared table root and
    read back, exactly like the reference's table materializations: plans stay
    one model deep, lineage is cut at each table, and a shared dimension is
    computed once instead of once per reference in the plan tree.  The
    dataset asked for at the top level stays a lazy DataFrame.
    """

    def __init__(self, spark: SparkSession, sources: Callable[[str], DataFrame], config: Config,
                 materialize: bool = True, table_root: str | None = None, lay_out: bool = False):
        size_tables_in_memory(spark)
        self.spark = spark
        self.sources = sources
        self.config = config
        self.materialize = materialize
        self._root = table_root
        self._memo: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self._depth = 0
        self._force_name = None
        self._lay_out = lay_out
        #: dataset -> rows and NULLs of its grain, counted while its table was written
        self.observed: dict[str, dict] = {}

    @property
    def root(self) -> str:
        if self._root is None:
            from ..sources.sinks import table_root
            self._root = table_root(self.spark)
        return self._root

    def __call__(self, name: str) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        if name not in self._memo:
            if name in DATASETS:
                self._depth += 1
                try:
                    self._memo[name] = DATASETS[name].fn(self)
                finally:
                    self._depth -= 1
            else:
                self._memo[name] = self.sources(name)
        df = self._memo[name]
        if (self.materialize and self._depth > 0 and name in DATASETS
                and (DATASETS[name].materialized == "table" or name == self._force_name)):
            df = self._write(name, df)
            self._tables[name] = df
        return df

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a dataset as a table; with ``lay_out`` the way it is kept:
        facts and measures partitioned by school year, all clustered."""
        from ..sources.sinks import materialize, observed
        from ..sources.store import layout
        d = DATASETS[name]
        df, seen = observed(df, [g for g in d.grain if g in df.columns])
        partition, cluster = (), ()
        if self._lay_out:
            partition = ("school_year",) if d.kind in ("fct", "msr") and "school_year" in df.columns else ()
            cluster = tuple(c for c in layout(df.columns, d.grain) if c not in partition)
        out = materialize(df, f"{self.root}/{name}", partition, cluster)
        self.observed[name] = seen.get
        return out

    def table(self, name: str) -> DataFrame:
        """Full-refresh one dataset: write it (and any missing dependency) as a table."""
        if name in self._tables:
            return self._tables[name]
        forced, self._force_name = self._force_name, name
        self._depth += 1
        try:
            return self(name)
        finally:
            self._depth -= 1
            self._force_name = forced

    def bucketed(self, names, key: str) -> None:
        """Write the datasets that aren't tables yet as tables bucketed and sorted
        by ``key``, with as many buckets as shuffles have partitions: joins on the
        key then need no exchange on their side.  They don't depend on each other,
        so their jobs run side by side."""
        from concurrent.futures import ThreadPoolExecutor

        from pyspark import inheritable_thread_target

        from ..sources.sinks import materialize_bucketed
        plans = {n: self(n) for n in names if n not in self._tables}
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        write = inheritable_thread_target(self.spark)(
            lambda n: materialize_bucketed(plans[n], f"{self.root}/{n}", key, buckets))
        with ThreadPoolExecutor(min(4, max(1, len(plans)))) as pool:
            self._tables.update(zip(plans, pool.map(write, plans), strict=True))

    def build(self, names) -> dict[str, float]:
        """Full refresh of ``names`` in the given (dependency) order; seconds per dataset."""
        import time
        out = {}
        for n in names:
            t = time.perf_counter()
            self.table(n)
            out[n] = round(time.perf_counter() - t, 3)
        return out

    def override(self, name: str, df: DataFrame) -> None:
        """Replace a dataset by an already materialized table."""
        self._tables[name] = df


def load_all() -> dict[str, Dataset]:
    """Import every plan module so their datasets register."""
    from . import (  # noqa: F401
        assessments, attendance, calendar, checks, contacts, custom, discipline, epp, enrollment, finance, grades, misc, orgs,
        programs, records, sections, students, subgroups,
    )
    return DATASETS
