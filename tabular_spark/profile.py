"""Counts, frequencies and statistics; one aggregate for all columns wherever that is enough."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.quantile import exact_quantiles, position
from tabular_spark.storage import stored


def long_form(df: DataFrame, columns: list[str], measures: dict[str, Callable[[str], Column]]) -> DataFrame:
    """(column, measure...) with one row per column, from one aggregate over the table."""
    one = df.agg(*[F.struct(*[f(c).alias(m) for m, f in measures.items()]).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("m")) for c in columns])
    return one.select(F.explode(rows).alias("r")).select("r.column", "r.m.*")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return long_form(df, columns or df.columns, {"nulls": lambda c: F.count_if(F.col(c).isNull())})


def marker_counts(df: DataFrame, marker: str) -> DataFrame:
    """(column, marked) for all columns; only text columns can hold the marker."""
    texts = {c for c, t in df.dtypes if t == "string"}
    return long_form(df, df.columns, {"marked": lambda c: F.count_if(F.col(c) == marker) if c in texts else F.sum(F.lit(0)).cast("long")})


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def cube_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(column, n, total): the total row is told from a null group by its grouping id."""
    return df.cube(column).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("total"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return frequencies(df.where(F.col(column).isNotNull()), column).orderBy(F.desc("n"), column)


def cardinality(df: DataFrame, column: str) -> DataFrame:
    """(groups): distinct values, null being one."""
    return df.select(column).distinct().agg(F.count("*").alias("groups"))


def key_uniqueness(df: DataFrame, column: str) -> DataFrame:
    """(n_rows, n_distinct, is_unique)."""
    counted = frequencies(df, column)
    return counted.agg(F.sum("n").alias("n_rows"), F.count(column).alias("n_distinct")).withColumn("is_unique", F.col("n_rows") == F.col("n_distinct"))


def describe(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """(column, n, mean, deviation, low, high) as numbers."""
    return long_form(df, columns, {
        "n": F.count, "mean": lambda c: F.round(F.avg(c), digits), "deviation": lambda c: F.round(F.stddev(c), digits),
        "low": lambda c: F.min(c).cast("double"), "high": lambda c: F.max(c).cast("double"),
    })


def describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    return long_form(df, columns, {"n": F.count, "low": F.min, "high": F.max})


def quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, q25, q50, q75), exact."""
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [(c, *[None if x is None else float(x) for x in v]) for c, v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")


def summary(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """``describe`` and the exact quartiles."""
    return describe(df, columns, digits).join(quartiles(df, columns), "column")


def profile(df: DataFrame, error: float = 0.05, digits: int = 4) -> DataFrame:
    """One row per column from a single aggregate: rows, nulls, empties (zero or empty text), mean, deviation, bounds as text, and an approximate distinct count with relative deviation ``error``."""
    numbers = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")}
    texts = {c for c, t in df.dtypes if t == "string"}
    nothing = F.lit(None).cast("double")
    return long_form(df, df.columns, {
        "n": lambda c: F.count(F.lit(1)), "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "empties": lambda c: F.count_if(F.col(c) == 0) if c in numbers else F.count_if(F.col(c) == "") if c in texts else F.count_if(F.lit(False)),
        "mean": lambda c: F.round(F.avg(c), digits) if c in numbers else F.max(nothing), "deviation": lambda c: F.round(F.stddev(c), digits) if c in numbers else F.max(nothing),
        "low": lambda c: F.min(c).cast("double") if c in numbers else F.max(nothing), "high": lambda c: F.max(c).cast("double") if c in numbers else F.max(nothing),
        "distinct_about": lambda c: F.approx_count_distinct(c, error),
    })


def profile_with_quartiles(df: DataFrame, **options) -> DataFrame:
    """``profile`` with the exact quartiles of numbers."""
    numbers = [c for c, t in df.dtypes if t in NUMBERS or t.startswith("decimal")]
    return profile(df, **options).join(quartiles(df, numbers), "column", "left")


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def sketches(df: DataFrame, k: int = 4096, tracked: int = 1024, log_size: int = 14) -> DataFrame:
    """One row per column from one aggregate: what a profile needs, in a form that merges.

    (column, kind, n, nulls, empties, total, squares, low, high, distinct, ranks, frequent): sums and bounds as
    numbers, and three sketches: distinct values (hyperloglog of 2^``log_size`` registers), ranks of numbers (KLL of size ``k``) and the most frequent
    values (at most ``tracked`` counters in all).
    """
    kinds = {c: t for c, t in df.dtypes if t in (*NUMBERS, "string", "date", "timestamp", "timestamp_ntz", "boolean") or t.startswith("decimal")}
    numbers = {c for c, t in kinds.items() if t in NUMBERS or t.startswith("decimal")}

    def at(c: str) -> Column:
        return position(c, kinds[c]) if c in numbers else F.lit(None).cast("double")

    return long_form(df, list(kinds), {
        "kind": lambda c: F.max(F.lit(kinds[c])), "n": lambda c: F.count(F.lit(1)), "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "empties": lambda c: F.count_if(F.col(c) == 0) if c in numbers else F.count_if(F.col(c) == "") if kinds[c] == "string" else F.count_if(F.lit(False)),
        "total": lambda c: F.sum(at(c)), "squares": lambda c: F.sum(at(c) * at(c)), "low": lambda c: F.min(at(c)), "high": lambda c: F.max(at(c)),
        "distinct": lambda c: F.hll_sketch_agg(F.col(c).cast("string"), log_size), "ranks": lambda c: F.kll_sketch_agg_double(at(c), F.lit(k)),
        "frequent": lambda c: F.call_function("approx_top_k_accumulate", F.col(c).cast("string"), F.lit(tracked)),
    })


def merged(states: DataFrame) -> DataFrame:
    """The sketches of a whole from those of its parts (of versions, files or days), without their rows."""
    sums = [F.sum(c).alias(c) for c in ("n", "nulls", "empties", "total", "squares")]
    return states.groupBy("column").agg(
        F.max("kind").alias("kind"), *sums, F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("ranks").alias("ranks"),
        F.call_function("approx_top_k_combine", F.col("frequent")).alias("frequent"),
    )


def profile_of(states: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 3, buckets: int = 10, digits: int = 4) -> DataFrame:
    """What merged ``sketches`` say of each column.

    (column, kind, n, nulls, empties, mean, deviation, low, high, distinct_about, quantiles, buckets, top): ``buckets`` counts the
    values up to each tenth (or so) of the way from low to high, ``top`` holds (value, count), most frequent first. Quantiles
    and buckets are off by the rank error of the sketch, and exact while it holds all values.
    """
    filled = F.col("n") - F.col("nulls")
    mean = F.col("total") / F.nullif(filled, F.lit(0))
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("squares") - F.col("total") * mean) / F.nullif(filled - 1, F.lit(0))))
    ranked = F.col("total").isNotNull()
    ranks = F.when(ranked, F.col("ranks"))  # the sketch of no numbers can't be asked
    items = F.transform(F.expr(f"approx_top_k_estimate(frequent, {top + 1})"), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("count")))
    states = stored(states, "profile-states")
    upto = F.lit(None).cast("array<long>")
    for r in states.where("total is not null").select("column", "low", "high").collect():  # one row a column
        ends = [F.kll_sketch_get_rank_double(ranks, F.lit(r["low"] + (r["high"] - r["low"]) * i / buckets)) for i in range(1, buckets + 1)]
        upto = F.when(F.col("column") == r["column"], F.array(*[F.round(e * filled).cast("long") for e in ends])).otherwise(upto)
    return states.select(
        "column", "kind", "n", "nulls", "empties", F.round(mean, digits).alias("mean"), F.when(ranked, F.round(spread, digits)).alias("deviation"), "low", "high",
        F.hll_sketch_estimate("distinct").alias("distinct_about"),
        F.when(ranked, F.array(*[F.kll_sketch_get_quantile_double(ranks, F.lit(p)) for p in shares])).alias("quantiles"),
        upto.alias("buckets"),
        F.slice(F.filter(items, lambda x: x["value"].isNotNull()), 1, top).alias("top"),
    )


def append_state(df: DataFrame, path: str, part: str, **sizes: int) -> None:
    """Adds the sketches of ``df`` to a table of states under the name ``part``; a part that is written again replaces itself."""
    sketches(df, **sizes).write.mode("overwrite").parquet(f"{path}/part={part}")


def states(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("part")


def histogram(df: DataFrame, value: Column, low: float, high: float, buckets: int) -> DataFrame:
    """(bucket, n) of equal widths on [low, high); 0 is below, ``buckets`` + 1 at or above the end; nulls are left out."""
    return df.select(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(buckets)).cast("int").alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))
