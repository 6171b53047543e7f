"""Mixing sources to target weights by pivotal dependent rounding.

Sources get targets by weight, none above ``cap`` times its size. A document of a source is due
target / size copies: a whole part, and a fraction that must be rounded. Fractions are rounded in
pairs: mass, counted in words, is moved from one document to the other in a random direction until
one of the two is integral, which changes neither the source's words nor the expectation. Each
bucket of documents leaves one undecided document per source; those go up a reduction tree and
the last one of a source is rounded to the nearer side, so that a source misses its target by at
most half the words of one document. Larger documents are paired first, so that it is a small one.

Cases: a null text has no words; null sources are one source, the last in order; documents
without words take nothing; of rows that repeat id, source and number of words, as many take one
copy more than the others as their fractions add up to, and only what is left of these is rounded; sources without words have target 0; an empty table gives an empty result. Reruns agree: every
random number follows from the seed and the ids.
"""

from __future__ import annotations

import math
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabular_spark.llm.common import WORD, as_record, ranked, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source and no document is taken more than so many times.
CAP = 3.0
#: Documents in a bucket, on average; undecided documents that meet in a node of the tree, at most.
BUCKET, FAN_IN = 4096, 256


def words(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Water filling: a target is the smaller of cap x size and level x weight. The level starts at
    total / weights and rises as sources reach their cap, one small aggregate per step.
    """
    order = ranked(sizes, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    at = stored(order.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")), "mix-sources")
    total = float(at.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:
        over = F.col("most") <= F.lit(level) * F.col("weight")
        n, taken, rest = at.agg(F.coalesce(F.sum(over.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not rest:
            break
        level, full = (total - taken) / rest, n
    return at.select("source", "source_size", F.least("most", F.lit(level) * F.col("weight")).alias("target")) if rest else at.select("source", "source_size", F.col("most").alias("target"))


def pivot(sizes: list[int], shares: list[float], draw) -> tuple[list[float], int]:
    """Rounds fractions pairwise; returns them and the place of the one left undecided, or -1."""
    shares, at = list(shares), -1
    for i, (size, share) in enumerate(zip(sizes, shares)):
        if not 0.0 < share < 1.0:
            continue
        if at < 0:
            at = i
            continue
        here, there = share * size, shares[at] * sizes[at]
        up, down = min(size - here, there), min(here, sizes[at] - there)  # words that can come to i, and leave it
        move = up if draw() * (up + down) < down else -down
        # what limits the move is integral now; the other one stays undecided
        a, b = here + move, there - move
        full_i, full_at = (move > 0 and up == size - here) or (move < 0 and down == here), (move > 0 and up == there) or (move < 0 and down == sizes[at] - there)
        shares[i] = float(move > 0) if full_i else a / size
        shares[at] = float(move < 0) if full_at else b / sizes[at]
        at = i if 0.0 < shares[i] < 1.0 else at if 0.0 < shares[at] < 1.0 else -1
    return shares, at


def rounding(items: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Rounds ``share`` in each group of ``keys`` and source; ``open`` marks the undecided rows."""
    schema = items.schema

    def last_null(x):
        return x is None, x

    def run(group):  # in Arrow, as pandas has no large integers beside nulls
        import random

        import pyarrow as pa

        rows = group.to_pylist()
        rows.sort(key=lambda r: (last_null(r["source"]), -r["mass"], r["order"], last_null(r["doc_id"]), r["size"]))
        for _, part in groupby(rows, key=lambda r: r["source"]):
            part = list(part)
            shares, at = pivot([r["mass"] for r in part], [r["share"] for r in part], random.Random(f"{seed}:{part[0]['order']}:{len(part)}").random)
            for i, r in enumerate(part):
                r["share"], r["open"] = shares[i], i == at
        return pa.Table.from_pylist(rows, group.schema)

    return items.groupBy(*keys).applyInArrow(run, schema)


def copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = 42, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, whole, extra): one row per distinct id, source and size.

    Each of its rows is taken ``whole`` times, and ``extra`` of them once more.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"))
    slim = stored(slim.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "mix-items")
    aims = stored(targets(slim.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, cap), "mix-targets")
    number = slim.count()
    nodes = max(1, math.ceil(number / BUCKET))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("due") + F.lit(1e-9))
    # the fractions of all rows of an item: full copies, and less than one that is rounded
    over = F.when(F.col("size") > 0, F.greatest(F.col("due") - whole, F.lit(0.0)) * F.col("rows")).otherwise(0.0)
    aims = aims.select(F.col("source").alias("_source"), "source_size", "target")
    items = slim.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("due", due).select(
        "doc_id", "source", "size", "rows", "source_size", "target", F.col("size").alias("mass"), whole.cast("int").alias("whole"),
        F.floor(over + F.lit(1e-9)).cast("long").alias("extra"), F.greatest(over - F.floor(over + F.lit(1e-9)), F.lit(0.0)).alias("share"),
        F.xxhash64(F.lit(seed), "doc_id", "size").alias("order"), F.lit(False).alias("open"),
    ).withColumn("node", F.pmod("order", F.lit(nodes)).cast("long"))
    level = stored(rounding(items, ["node"], seed), "mix-level")
    decided = level.where(~F.col("open"))
    while nodes > 1:
        nodes = math.ceil(nodes / FAN_IN)
        above = level.where("open").withColumn("node", F.floor(F.col("node") / FAN_IN)).withColumn("open", F.lit(False))
        level = stored(rounding(above, ["source", "node"], seed + nodes), "mix-level")
        decided = decided.unionByName(level.where(~F.col("open")))
    return decided.unionByName(level.where("open")).select("doc_id", "source", "size", "rows", "source_size", "target", "whole", (F.col("extra") + F.round("share").cast("long")).alias("extra"))


def numbered(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``at``, from 1 for each key. Rows of one key are numbered where they lie, and shifted by those in the partitions before."""
    dealt = stored(rows.withColumn("_part", F.spark_partition_id()), "mix-repeats")
    inside = dealt.withColumn("_in", F.row_number().over(Window.partitionBy(*key, "_part").orderBy(F.lit(0))))
    sizes = dealt.groupBy(*key, "_part").agg(F.count("*").alias("_n"))
    ahead = sizes.withColumn("_ahead", F.sum("_n").over(Window.partitionBy(*key).orderBy("_part")) - F.col("_n"))
    ahead = ahead.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("_part").alias("_p"), "_ahead")
    same = inside["_part"] == ahead["_p"]
    for k in key:
        same = same & inside[k].eqNullSafe(ahead[f"_{k}"])
    return inside.join(ahead, same).withColumn("at", F.col("_in") + F.col("_ahead"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as many times as it is taken, all columns kept."""
    found = copies(docs, **options).where("whole + extra > 0")
    id_col, source_col, text_col = (options.get(k, v) for k, v in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text")))
    found = found.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "size", "rows", "whole", "extra")
    sized = as_record(docs, id=F.col(id_col), source=F.col(source_col), words=words(text_col))
    both = sized.join(found, sized["id"].eqNullSafe(found["_id"]) & sized["source"].eqNullSafe(found["_source"]) & (sized["words"] == found["size"]))
    both = both.select("record", "id", "source", "words", "rows", "whole", "extra")
    # rows of an item differ only where some take one copy more than others
    alike = (F.col("extra") == 0) | (F.col("extra") == F.col("rows"))
    each = both.where(alike).select("record", (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).alias("copies"))
    if not found.where(~alike).isEmpty():
        some = numbered(both.where(~alike), ["id", "source", "words"])
        each = each.unionByName(some.select("record", (F.col("whole") + F.when(F.col("at") <= F.col("extra"), 1).otherwise(0)).alias("copies")))
    return each.where("copies > 0").select("record", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("record.*")


def op10(docs: DataFrame) -> DataFrame:
    each = copies(docs).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    taken = (F.col("whole") + F.when(F.col("_row") <= F.col("extra"), 1).otherwise(0)) * F.col("size")
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
