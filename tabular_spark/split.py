"""Train, validation and test sets that depend on keys alone, not on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 10_000


def slot(key: str, seed: str = "") -> Column:
    """0 to 9999 from the first eight hex digits of the key's md5."""
    return (F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary")), 1, 8), 16, 10).cast("long") % STEPS).cast("int")


def with_split(df: DataFrame, key: str, weights: dict[str, float], seed: str = "", name: str = "split") -> DataFrame:
    """A column with the name of each row's set. ``weights`` are shares; a row of a null key has a null set."""
    total, reached, choice = sum(weights.values()), 0.0, None
    at = slot(key, seed)
    for part, share in weights.items():
        reached += share / total
        test = at < round(reached * STEPS)
        choice = F.when(test, part) if choice is None else choice.when(test, part)
    return df.withColumn(name, choice)


def moved_keys(df: DataFrame, key: str, weights: dict[str, float], partitions: int) -> DataFrame:
    """(split, n_before, n_after, moved) of the same split before and after a new partitioning."""
    before = with_split(df.select(key), key, weights)
    after = with_split(df.select(key).repartition(partitions), key, weights, name="split_after")
    both = before.groupBy(key, "split").agg(F.count("*").alias("n")).join(after.groupBy(key, "split_after").agg(F.count("*").alias("m")), key)
    moved = F.count_if(F.col("split") != F.col("split_after"))
    counts = both.groupBy("split").agg(F.sum("n").alias("n_before"), moved.alias("moved"))
    return counts.join(both.groupBy(F.col("split_after").alias("split")).agg(F.sum("m").alias("n_after")), "split").select("split", "n_before", "n_after", "moved")
