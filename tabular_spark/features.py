"""Category indexes, one-hot columns, assembled vectors and formula features."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabular_spark.storage import stored


def label_index(df: DataFrame, column: str, parts: int = 64) -> DataFrame:
    """(label, n, index): 0 for the most frequent label, ties in order; nulls are no label.

    The few-column table of labels is sorted by range partitions, each numbered on its own and
    shifted by the sizes of the partitions before; neither a task nor the driver holds all labels.
    The partitioned table is written first, so that both uses see the same partitions.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange(parts, F.desc("n"), F.asc("label")).withColumn("part", F.spark_partition_id())
    numbered = stored(ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "label"))), "labels")
    sizes = numbered.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.orderBy("part")) - F.col("size")).drop("size")
    return numbered.join(before, "part").select("label", "n", (F.col("before") + F.col("at") - 1).cast("double").alias("index"))


def indexed(df: DataFrame, labels: DataFrame, column: str, out: str, unseen: str = "skip") -> DataFrame:
    """``df`` with the index of its label. Rows of unseen labels and nulls go ("skip"), or get one index more than there are labels ("keep")."""
    table = labels.select(F.col("label").alias("_label"), F.col("index").alias(out))
    if unseen == "skip":
        return df.join(table, df[column] == table["_label"]).drop("_label")
    extra = labels.agg(F.count("*").cast("double")).first()[0]
    return df.join(table, df[column] == table["_label"], "left").drop("_label").withColumn(out, F.coalesce(out, F.lit(extra)))


def one_hot(df: DataFrame, columns: list[str], out: str = "slots") -> DataFrame:
    """``df`` with the sorted slots that are 1 in its one-hot vector; all others are 0.

    Each column has a slot per label, the most frequent first, but for the last one, which is all zeros. Label tables are
    joined, so no task and no driver holds all labels. Rows with a null go.
    """
    rows, slots, start = df, [], 0
    for i, c in enumerate(columns):
        labels = stored(label_index(df, c), "labels")
        width = max(0, labels.count() - 1)
        rows = indexed(rows, labels, c, f"_i{i}")
        slots.append(F.when(F.col(f"_i{i}") < width, F.col(f"_i{i}").cast("int") + start))
        start += width
    return rows.withColumn(out, F.array_compact(F.array(*slots))).drop(*[f"_i{i}" for i in range(len(columns))])


def slot_counts(df: DataFrame, slots: str = "slots") -> DataFrame:
    """(slot, total): how often each slot is 1."""
    return df.select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count("*").cast("double").alias("total"))


def ordered_bins(df: DataFrame, column: str, label: str, bins: int, parts: int = 64) -> DataFrame:
    """(label, n, mean, bin): a category's values in the order of their mean label, cut into at most ``bins`` bins of about equal weight.

    For squared error the best split of a category is among those of this order, so a tree may take the bins as a number. The
    values are sorted by range partitions and their weights summed up partition by partition.
    """
    means = df.where(F.col(column).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"), F.avg(label).alias("mean"))
    dealt = stored(means.repartitionByRange(parts, "mean", "label").withColumn("part", F.spark_partition_id()), "ordered-labels")
    sizes = dealt.groupBy("part").agg(F.sum("n").alias("size"))  # one row a partition
    ahead = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("ahead"), F.sum("size").over(Window.partitionBy()).alias("whole"))
    before = F.col("ahead") + F.sum("n").over(Window.partitionBy("part").orderBy("mean", "label")) - F.col("n")
    return dealt.join(F.broadcast(ahead), "part").withColumn("bin", F.floor(F.lit(bins) * before / F.col("whole")).cast("int")).select("label", "n", "mean", "bin")


def binned(df: DataFrame, bins: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the bin of its value; rows of unseen values and nulls go."""
    table = bins.select(F.col("label").alias("_label"), F.col("bin").alias(out))
    return df.join(table, df[column] == table["_label"]).drop("_label")


def assembler(columns: list[str], out: str = "features", nulls: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=nulls)


def slot_sums(df: DataFrame, vector: str, digits: int = 4) -> DataFrame:
    """(slot, total) of a vector column."""
    return df.select(F.posexplode(vector_to_array(vector)).alias("slot", "v")).groupBy("slot").agg(F.round(F.sum("v"), digits).alias("total"))


def approximate_imputer(columns: list[str], strategy: str = "median", relative_error: float = 0.001) -> Imputer:
    """MLlib's imputer for use inside of a pipeline; its median is approximate by ``relative_error``."""
    return Imputer(inputCols=columns, outputCols=columns, strategy=strategy, relativeError=relative_error)
