"""Type repair, filters and missing values. Columns are arguments, functions return DataFrames or Columns."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.quantile import exact_quantiles


def amount(column: str, delete: str = "$,") -> Column:
    """Text such as "$1,234.00" as a double; null where no number is left (empty or other text)."""
    return F.translate(F.col(column), delete, "").try_cast("double")


def marker_to_null(column: str, marker: str) -> Column:
    return F.nullif(F.col(column), F.lit(marker))


def with_types(df: DataFrame, of: tuple[str, ...] = ("int",), to: str = "double") -> DataFrame:
    """All columns of the types ``of`` cast to ``to``; the rest and the order stay."""
    return df.select([F.col(c).cast(to).alias(c) if t in of else F.col(c) for c, t in df.dtypes])


def columns_of(df: DataFrame, *types: str, but: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t in types and c not in but]


def missing_flags(df: DataFrame, columns: list[str], suffix: str = "_na") -> DataFrame:
    """A column of 1.0 (null) and 0.0 for each of ``columns``."""
    return df.withColumns({c + suffix: F.when(F.col(c).isNull(), 1.0).otherwise(0.0) for c in columns})


def without_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=columns)


def medians(df: DataFrame, columns: list[str]) -> dict[str, Any]:
    """The exact lower median of each column."""
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}


def means(df: DataFrame, columns: list[str]) -> dict[str, Any]:
    return df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()


def modes(df: DataFrame, columns: list[str]) -> dict[str, Any]:
    """The most frequent value of each column, of several the smallest; one small row per distinct value is compared."""
    found = {}
    for c in columns:
        counted = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
        found[c] = counted.agg(F.min_by("value", F.struct(-F.col("n"), "value"))).first()[0]
    return found


def filled(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Nulls replaced by the values, cast to their column's type; columns whose value is None stay."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in values.items() if v is not None})


def imputed_with_flags(df: DataFrame, columns: list[str], strategy=medians, suffix: str = "_na") -> DataFrame:
    """Flags first, since after the filling nothing tells which values were missing."""
    return filled(missing_flags(df, columns, suffix), strategy(df, columns))


def type_table(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_frame(df: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    """Rows about schemas (as many as there are columns) as a DataFrame."""
    return df.sparkSession.createDataFrame(rows, columns)
