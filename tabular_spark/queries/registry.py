"""Where queries and their SQL are kept side by side, and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, **named: str) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL that gives the same rows."""

    def keep(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: A table with text amounts, markers and nulls, derived from all orders.
OFFERS = """offers AS (SELECT o_orderkey AS id, o_orderpriority AS zone,
    CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE o_orderstatus END AS reply,
    CAST(o_custkey % 8 + 1 AS int) AS seats,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 5 + 1 AS int) END AS rooms,
    CAST(o_orderkey % 500 + 1 AS int) AS min_days,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS double) / 10 END AS rating,
    CASE WHEN o_orderkey % 997 = 0 THEN '$0.00' WHEN o_orderkey % 1009 = 0 THEN '' ELSE '$' || format('{:,.2f}', o_totalprice) END AS price_text
    FROM orders)"""
#: The same with amounts as numbers; then only what is for sale for a year at most.
PRICED = OFFERS + ", priced AS (SELECT *, try_cast(translate(price_text, '$,', '') AS double) AS price FROM offers)"
CLEAN = PRICED + ", clean AS (SELECT * FROM priced WHERE price > 0 AND min_days <= 365)"


def offers(spark: SparkSession, sf: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        key.alias("id"), F.col("o_orderpriority").alias("zone"),
        F.when(key % 11 == 0, "N/A").otherwise(F.col("o_orderstatus")).alias("reply"),
        (customer % 8 + 1).cast("int").alias("seats"),
        F.when(key % 7 != 0, (customer % 5 + 1).cast("int")).alias("rooms"),
        (key % 500 + 1).cast("int").alias("min_days"),
        F.when(key % 5 != 0, (customer % 50).cast("double") / 10).alias("rating"),
        F.when(key % 997 == 0, "$0.00").when(key % 1009 == 0, "").otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("price_text"),
    )
