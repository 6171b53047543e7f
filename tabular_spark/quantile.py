"""Exact quantiles in three scans: sketches, exact counts around them, and the narrow intervals left."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabular_spark.storage import stored

#: Types whose every value a double holds; where a bracket is one value of these, it is the answer.
HELD = ("tinyint", "smallint", "int", "float", "double")


def position(column: str, kind: str) -> Column:
    """A double that orders like the column; several values may share one."""
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "timestamp_ntz":
        return F.col(column).cast("timestamp").cast("double")
    return F.col(column).cast("double")


def rank_error(k: int) -> float:
    """Share of ranks by which a sketch of size ``k`` is off, at 99 %."""
    return 2.446 / k**0.9433


def brackets(df: DataFrame, columns: list[str], shares: list[float], k: int) -> tuple[dict[str, int], dict[str, int], dict[tuple[str, float], tuple[float, float]]]:
    """First scan: values and NaNs of each column, and for each share two positions between which its rank lies, but for a rare miss."""
    kinds, error = dict(df.dtypes), 3 * rank_error(k)
    sketches, reads = [], []
    for i, c in enumerate(columns):
        at = position(c, kinds[c])
        sketches += [F.count(c).alias(f"n{i}"), F.count_if(F.isnan(at)).alias(f"nan{i}"), F.kll_sketch_agg_double(F.when(~F.isnan(at), at), F.lit(k)).alias(f"s{i}")]
        reads += [F.col(f"n{i}"), F.col(f"nan{i}")]
        for j, p in enumerate(shares):
            for name, q in (("low", max(0.0, p - error)), ("high", min(1.0, p + error))):
                reads.append(F.when(F.col(f"n{i}") > F.col(f"nan{i}"), F.kll_sketch_get_quantile_double(f"s{i}", F.lit(q))).alias(f"{name}{i}_{j}"))
    row = df.agg(*sketches).select(*reads).first()
    found = {(c, p): (row[f"low{i}_{j}"], row[f"high{i}_{j}"]) for i, c in enumerate(columns) for j, p in enumerate(shares)}
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}, {c: row[f"nan{i}"] for i, c in enumerate(columns)}, found


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], k: int = 4096) -> dict[str, list[Any]]:
    """For each column the values of rank ceil(share * count), nulls left out, NaN the largest; None for a column without values.

    All columns and shares are served by the same three scans of ``df``. Mergeable sketches of size ``k`` give a
    bracket of positions for each rank; exact counts below and up to the brackets follow; last,
    the distinct values inside of the brackets are counted, sorted by range and searched for the
    ranks where they lie. ``k`` changes the width of the brackets, not the result.
    """
    kinds = dict(df.dtypes)
    counts, nans, bracket = brackets(df, columns, shares, k)
    found: dict[tuple[str, float], Any] = {}
    ranks: dict[tuple[str, float], int] = {}
    for key in bracket:
        c, p = key
        rank = max(1, math.ceil(p * counts[c] - 1e-9))
        if not counts[c]:
            found[key] = None
        elif rank > counts[c] - nans[c]:
            found[key] = math.nan
        else:
            ranks[key] = rank
    below: dict[tuple[str, float], int] = {}
    left = list(ranks)
    while left:  # a second time only for a bracket that missed its rank
        bounds = {(key[0], bracket[key]): None for key in left}
        sums = []
        for i, (c, (low, high)) in enumerate(bounds):
            at = position(c, kinds[c])
            sums += [F.count_if(at < F.lit(low)).alias(f"lt{i}"), F.count_if(at <= F.lit(high)).alias(f"le{i}")]
        row = df.agg(*sums).first()
        place = {b: i for i, b in enumerate(bounds)}
        missed = []
        for key in left:
            i = place[key[0], bracket[key]]
            low, high = bracket[key]
            if row[f"lt{i}"] < ranks[key] <= row[f"le{i}"]:
                below[key] = row[f"lt{i}"]
                if low == high and kinds[key[0]] in HELD:
                    found[key] = low if kinds[key[0]] in ("float", "double") else int(low)
            else:
                bracket[key] = (-math.inf if ranks[key] <= row[f"lt{i}"] else low, math.inf if ranks[key] > row[f"le{i}"] else high)
                missed.append(key)
        left = missed
    open_ = [key for key in ranks if key not in found]
    if open_:
        found |= dict(zip(open_, searched(df, open_, kinds, bracket, ranks, below)))
    return {c: [found[c, p] for p in shares] for c in columns}


def searched(df: DataFrame, keys: list[tuple[str, float]], kinds: dict[str, str], bracket: dict, ranks: dict, below: dict) -> list[Any]:
    """The values of the ranks inside of their brackets. A value is a struct with a field for each type, so that one scan serves all."""
    types = list(dict.fromkeys(kinds[c] for c, _ in keys))

    def value(c: str) -> Column:
        return F.struct(*[(F.col(c) if kinds[c] == t else F.lit(None)).cast(t).alias(f"v{j}") for j, t in enumerate(types)])

    inside = [F.when(position(c, kinds[c]).between(*map(F.lit, bracket[c, p])), F.struct(F.lit(i).alias("key"), value(c).alias("value"))) for i, (c, p) in enumerate(keys)]
    values = df.select(F.explode(F.array_compact(F.array(*inside))).alias("r")).select("r.*").groupBy("key", "value").agg(F.count("*").alias("n"))
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(values.repartitionByRange(parts, "key", "value").withColumn("part", F.spark_partition_id()), "quantile-values")
    sizes = dealt.groupBy("key", "part").agg(F.sum("n").alias("size"))
    wanted = F.element_at(F.array(*[F.lit(ranks[key] - below[key]).cast("long") for key in keys]), F.col("key") + 1)
    ahead = F.sum("size").over(Window.partitionBy("key").orderBy("part")) - F.col("size")
    # one partition a key holds its rank
    hit = sizes.withColumn("ahead", ahead).where((F.col("ahead") < wanted) & (wanted <= F.col("ahead") + F.col("size"))).select("key", "part", "ahead")
    upto = F.col("ahead") + F.sum("n").over(Window.partitionBy("key").orderBy("value"))
    rows = dealt.join(F.broadcast(hit), ["key", "part"]).withColumn("upto", upto).where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).select("key", "value").collect()
    answer = {r["key"]: r["value"] for r in rows}  # one row a key
    return [answer[i][types.index(kinds[c])] for i, (c, _) in enumerate(keys)]


def quantile(df: DataFrame, column: str, shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """(share, value) of one approximate aggregate; a value's rank is off by at most count / ``accuracy``."""
    both = df.agg(F.percentile_approx(column, shares, accuracy).alias("v")).select(F.posexplode("v").alias("i", "value"))
    return both.select(F.element_at(F.array(*[F.lit(float(s)) for s in shares]), F.col("i") + 1).alias("share"), "value")
