"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: bytes.translate table that lower-cases A-Z and leaves every other byte alone
LOWER_BYTES = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
#: rows of an Arrow batch; Spark's default, ten times as many, needs much
#: memory outside the heap on both sides where texts are long
BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder (``spark.checkpoint.dir``) and read back.

    Cuts the lineage at a finished table: an executor lost later costs only
    the tasks it ran, and rows keep the ids they were written with.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def removed(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing lazy reads any more, and let
    Spark's cleaner remove the shuffle files of the finished jobs before them: it
    does so for plans that are garbage on both sides, which neither side collects
    by itself while its heap has room."""
    spark = tables[0].sparkSession
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    del tables
    gc.collect()
    spark._jvm.System.gc()


def with_row_ids(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a binary column ``name`` that tells them apart and is the
    same whenever they are read: a hash of the file they are in and their place
    there.  Rows that don't come straight from files are written first."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        docs = written(docs, "rows")
    place = F.concat(*(F.lpad(F.hex(n), 16, "0") for n in (F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index"))))
    return docs.select("*", F.unhex(place).alias(name))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure-ASCII text takes the built-in fast path,
    where both forms agree; other text must keep its accented capitals."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, ASCII_UPPER, ASCII_LOWER)))


def arrow_rows(df: DataFrame, schema: str,
               fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` where ``fn`` yields one dict of equally long columns per
    batch.  Sets the session's batch size to ``BATCH_ROWS``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name]
                 for f in arrow], schema=arrow)
        # workers are reused, so hand back what this task no longer needs
        pa.default_memory_pool().release_unused()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null is empty."""
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
