"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that separates words: space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the session's checkpoint folder, or else one under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


#: The folder, in the shared one, of what the work in hand stores.
FOLDER: ContextVar[str] = ContextVar("FOLDER", default="")


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """What is ``stored`` inside goes to one folder, deleted at the end; results still to be computed from it must be stored with ``lasting`` before."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    token = FOLDER.set(folder)
    try:
        yield
    finally:
        FOLDER.reset(token)
        deleted(spark, folder)


def stored(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back; ``lasting``, outside of the folder of a ``scratch``.

    This cuts the lineage: what a lost executor held is read again from the folder, and what
    was numbered or sampled on the way keeps its values.
    """
    spark = df.sparkSession
    folder = "" if lasting else FOLDER.get()
    path = f"{folder or shared_dir(spark) + '/' + spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table that ``stored`` wrote, once nothing reads it any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        deleted(df.sparkSession, folder)


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def as_record(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` in one struct, ``record``, beside ``keys``, so that no column's name can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), *[c.alias(name) for name, c in keys.items()])


def ranked(df: DataFrame, *order: Column, rank: str = "rank") -> DataFrame:
    """Adds the position of each row in ``order``, from 0, without bringing all rows to one task.

    Rows are range-partitioned and numbered in their partition; the numbers of rows of the
    partitions before (as many as there are partitions) are added.
    """
    spark = df.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    numbered = stored(parts.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "ranked")
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return numbered.join(F.broadcast(before), "_part").withColumn(rank, F.col("_before") + F.col("_at") - 1).drop("_part", "_at", "_before")
