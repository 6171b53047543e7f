"""Splits by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import split
from tabular_spark.queries.registry import query, table

TWO = {"train": 0.8, "test": 0.2}
THREE = {"train": 0.7, "validation": 0.15, "test": 0.15}


def slot_sql(key: str) -> str:
    return f"(('0x' || substr(md5({key}::varchar), 1, 8))::bigint % 10000)"


def choice_sql(key: str, weights: dict[str, float]) -> str:
    reached, out = 0.0, []
    for part, share in weights.items():
        reached += share
        out.append(f"WHEN {slot_sql(key)} < {round(reached * 10000)} THEN '{part}'")
    return "CASE " + " ".join(out) + " END"


@query(f"SELECT o_orderkey, {choice_sql('o_orderkey', TWO)} AS split FROM orders")
def hash_split_2(spark: SparkSession, sf: str) -> DataFrame:
    return split.with_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", TWO)


@query(f"SELECT {choice_sql('o_orderkey', THREE)} AS split, count(*) AS n, CAST(sum(o_orderkey) AS bigint) AS keys FROM orders GROUP BY 1")
def hash_split_3(spark: SparkSession, sf: str) -> DataFrame:
    return split.with_split(table(spark, sf, "orders"), "o_orderkey", THREE).groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query(f"SELECT {choice_sql('o_orderkey', THREE)} AS split, count(*) AS n_before, count(*) AS n_after, count(*) FILTER (WHERE o_orderkey IS NULL) AS moved FROM orders GROUP BY 1")
def split_stability(spark: SparkSession, sf: str) -> DataFrame:
    return split.moved_keys(table(spark, sf, "orders"), "o_orderkey", THREE, 24)
