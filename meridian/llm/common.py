"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the ASCII blanks; this is the gap between words.
GAP = r"[\x20\x09-\x0D]+"
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir. A session of one machine (local master) that names none
    gets a folder of its own; on a cluster that is an error, as executors don't see each other's disks."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-meridian-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Spark's own option to delete a query's shuffle files when it ends, not when the driver happens to collect garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: later uses neither recompute nor need lost executors. The
    shuffles behind df go with the write, so that those of later steps don't pile up on them."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/meridian-{uuid.uuid4().hex}"
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete what materialise() wrote for df, once nothing reads it any more."""
    if df is not None and (where := getattr(df, "written_to", None)):
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame) -> DataFrame:
    """df as a side of a join that both sides are dealt out for. Left to itself Spark builds a side of up to 10 MB of
    compressed rows on the driver, several times that in its heap; rounds of such joins add up there."""
    return df.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    """The text column; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about max_bytes of the column at most (one longer row stands alone)."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        start, size = 0, 0
        lengths = pa.compute.binary_length(batch.column(at)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
