"""Checks of tables: each is a row (name, passed) or more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.clean import type_table


def text_hash(column: Column) -> Column:
    """A number from 0 to 2^31 - 1 from a text: the first 31 bits of its md5."""
    return F.shiftright(F.conv(F.substring(F.md5(column.cast("binary")), 1, 8), 16, 10).cast("long"), 1)


def schema_checks(df: DataFrame, table: str, expected: dict[str, str]) -> list[tuple[str, bool]]:
    """("table.column", passed) for each expected column; a missing one fails under the same name."""
    there = dict(type_table(df))
    return [(f"{table}.{c}", there.get(c) == kind) for c, kind in expected.items()]


def answer(df: DataFrame, column: str) -> DataFrame:
    """(n, answer): a hash of a whole column that depends on neither order nor partitioning; nulls count as the text "None"."""
    form = F.coalesce(F.col(column).cast("string"), F.lit("None"))
    return df.agg(F.count("*").alias("n"), (F.sum(text_hash(form).cast("decimal(38,0)")) % F.lit(1 << 31).cast("decimal(38,0)")).cast("long").alias("answer"))


def table_checks(df: DataFrame, table: str, key: str, allowed: dict[str, list[str]]) -> DataFrame:
    """(name, passed): the key is unique, it is never null, and columns hold only the allowed values."""
    one = df.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(~F.col(c).isin(v) | F.col(c).isNull()).alias(f"bad_{c}") for c, v in allowed.items()])
    found = one.agg(
        (F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("unique"), (F.count_if(F.col(key).isNull()) == 0).alias("filled"),
        *[(F.coalesce(F.sum(f"bad_{c}"), F.lit(0)) == 0).alias(f"allowed_{c}") for c in allowed],
    )
    rows = F.array(*[F.struct(F.lit(f"{table}.{c}").alias("name"), F.col(c).alias("passed")) for c in found.columns])
    return found.select(F.explode(rows).alias("r")).select("r.*")


def open_checks(checks: DataFrame) -> DataFrame:
    """Those that have not passed."""
    return checks.where(~F.col("passed"))
