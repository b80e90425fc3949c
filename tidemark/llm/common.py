"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of ASCII white space, and one word, as Java and DuckDB patterns.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where the session doesn't set it, only a session in
    one process gets a folder of its own, beside the warehouse; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.checkpoint"
    return found.rstrip("/") + "/tidemark"


def written(df: DataFrame, what: str) -> DataFrame:
    """df, stored once in the shared folder and read back: lineage ends here, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a written() table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tidemark/" in path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cleaned(spark: SparkSession) -> None:
    """Delete all tables that operators wrote to the shared folder; for when no result of theirs will be read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(cycles: bool = True) -> None:
    """Gives the memory that a Python worker has freed back to the system: workers are reused, and idle ones still count.
    cycles: also look for objects that hold each other, which takes some 30 ms."""
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with every C library
        pass


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """docs' whole rows as one struct `row`, beside columns of an operator's own: so no name of docs can clash with them."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in more.items()])


def named(id_col: str) -> Column:
    """An id as text that is never null: a null id differs from every other id, the text `null` included."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("null"))


def one_of_each(docs: DataFrame, id_col: str, text_key: Column, text_col: str, keep: DataFrame) -> DataFrame:
    """docs' rows whose id and text key are in keep(k_id, k_text), one row for each, that of the smallest text.

    Rows that share a key meet on the map side first, so a key that a third of all rows carry
    reaches the shuffle as a row for each map task. The join uses the same partitioning.
    """
    rows = packed(docs, k_id=named(id_col), k_text=text_key, t=F.col(text_col))
    once = rows.groupBy("k_id", "k_text").agg(F.min_by("row", F.struct(F.col("t").isNotNull(), "t")).alias("row"))
    return once.join(keep, ["k_id", "k_text"], "left_semi").select("row.*")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; the folds of the held-out splits."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batch: pa.Array, rows: int = 500) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch as Python strings, some rows at a time: a batch may hold many megabytes."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows).to_pylist()
