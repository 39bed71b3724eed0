"""Table sinks (S5 full refresh, S8 clustered layout, S9 audit rows).

Tables go under a shared folder: the session's ``spark.checkpoint.dir`` (set
by the cluster deployment) unless a warehouse path is given.  Written tables
are parquet, so downstream reads get column pruning and filter pushdown, and a
lost executor never loses a finished table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import packed, unpacked
from ..session import ensure_checkpoint_dir

# fixed value: keys are hex text, of which this codec stores half a byte a character (the default a whole one)
CODEC = "zstd"


def table_root(spark: SparkSession, base: str | None = None) -> str:
    base = base or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/rollcall-tables/{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                cluster_by: tuple[str, ...] = ()) -> None:
    """S5 full refresh; S8 clustered layout: rows are dealt by ranges of the
    columns and sorted in their files, so that the row groups of a Parquet file
    hold narrow ranges and a reader skips those its filters rule out."""
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = ()) -> DataFrame:
    """Write and read back: cuts lineage at a table boundary.  The schema read
    back is the one written, whatever is guessed from folder names."""
    write_table(df, path, partition_by, cluster_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def observed(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Rows counted on their way to a table, and the NULLs of the columns."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in columns]), seen


def dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows dealt by the hash of ``key``, text keys (``k_*``) packed on their way."""
    keys = [f.name for f in df.schema if f.name.startswith("k_") and isinstance(f.dataType, T.StringType)]
    if key not in keys:
        return df.repartition(buckets, key)
    rows = df.withColumns({k: packed(k) for k in keys}).repartition(buckets, unpacked(key))
    return rows.withColumns({k: unpacked(k) for k in keys})


def materialize_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write as a table of ``buckets`` files, each holding the rows of one hash of
    ``key`` sorted by it, and read back.  Rows are dealt by the same hash first, so
    that every task writes one file; on their way their keys (``k_*``) are packed."""
    name = f"rollcall_{uuid.uuid4().hex}"
    (dealt(df, key, buckets).write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", CODEC)
     .mode("overwrite").format("parquet").saveAsTable(name))
    # one file a bucket: its order holds for the whole bucket, and a join of many such tables needn't sort them all again
    df.sparkSession.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return df.sparkSession.table(name)


def audit(violations: DataFrame, check: str, severity: str, run_date: dt.date | None = None,
          run_id: str | None = None) -> DataFrame:
    """Violating rows tagged with the run, the check, its severity and the run date."""
    rd = F.lit(run_date) if run_date else F.current_date()
    return violations.select(F.lit(run_id).cast("string").alias("run_id"), F.lit(check).alias("check_name"),
                             F.lit(severity).alias("severity"), rd.alias("run_date"),
                             F.to_json(F.struct(*violations.columns)).alias("row_json"))


def append_audit(rows: DataFrame, path: str) -> int:
    """Append audit rows and return how many: counted in the job that writes
    them, so earlier runs in the folder are neither read nor counted."""
    rows, seen = observed(rows, [])
    rows.write.mode("append").parquet(path)
    return seen.get["rows"]
