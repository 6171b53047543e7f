"""Centroid clustering of integer vectors with JVM-native expressions only.

Vectors become integer arrays once. A round computes, for every vector, its products with the
centroids by ``zip_with`` and ``aggregate`` over literal arrays, turns them into squared
distances, and takes the least struct (distance, number) by ``array_min``. Sums of the array's
elements by cluster, partially aggregated where the rows are, give the next centroids; only k
rows of sums come to the driver, whatever the number of vectors.

The products of several centroids with a vector are computed at once: with as many bits as no
product of this table can exceed (|x| |c|, by Cauchy and Schwarz), the components of neighbouring
centroids are added up in one 64-bit number, and so are their products. Where magnitudes leave
no room, each centroid has a number of its own.

Cases: vectors that are null, of another length, or hold a null or non-finite component are left
out; components beyond 2^27 / ``scale`` in magnitude count as that bound, so that every distance
is exact in 64 bits; ids may be null or repeat: every row is a vector of its own; equal distances
go to the smaller number; fewer vectors than ``k`` give fewer centroids; equal hashes are ordered
by the vectors; a table without such vectors gives an empty result; an inertia of more than 63
bits is null.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import removed, stored

#: Largest magnitude of an integer component: 64 squared differences fit in 63 bits.
MOST = 1 << 27
#: Bits of a packed number that may be used.
ROOM = 62


def integer_vectors(table: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x, norm) of the vectors that are kept."""
    raw = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    # null | nan | infinite all fail the comparison or are null
    good = F.coalesce((F.size("v") == dims) & F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))), F.lit(False))

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(F.greatest(F.least(x, F.lit(1e30)), F.lit(-1e30)) * F.lit(float(scale))), F.lit(float(MOST))), F.lit(float(-MOST))).cast("long")

    kept = raw.where(good).select("vec_id", F.transform("v", whole).alias("x"))
    return kept.withColumn("norm", product("x", F.col("x")))


def product(x: str, c: Column) -> Column:
    return F.aggregate(F.zip_with(x, c, lambda a, b: a * b), F.lit(0).cast("long"), lambda s, v: s + v)


def literal(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{int(v)}L' for v in values)})")


def packed(centroids: list[list[int]], most_norm: int) -> tuple[int, list[list[int]]]:
    """(bits, arrays): components of as many centroids as there is room for, added up ``bits`` apart."""
    largest = max(sum(v * v for v in c) for c in centroids)
    bits = (most_norm * largest).bit_length() // 2 + 3  # |product| <= sqrt(norm x norm) < 2^(bits - 1), sign included
    together = max(1, ROOM // bits)
    return bits, [[sum(c[i] << bits * j for j, c in enumerate(group)) for i in range(len(group[0]))] for group in (centroids[at : at + together] for at in range(0, len(centroids), together))]


def nearest(vectors: DataFrame, centroids: list[list[int]], most_norm: int) -> DataFrame:
    """``vectors`` with ``best``, the struct (distance, cluster)."""
    bits, arrays = packed(centroids, most_norm)
    together = max(1, ROOM // bits)
    products = vectors.withColumn("_products", F.array(*[product("x", literal(a)) for a in arrays]))
    apart = F.col("_products")
    if together > 1:
        half, mask = 1 << bits - 1, (1 << bits) - 1
        lift = sum(half << bits * j for j in range(together))
        apart = F.flatten(F.transform("_products", lambda p: F.array(*[F.shiftright(p + F.lit(lift), bits * j).bitwiseAND(F.lit(mask)) - F.lit(half) for j in range(together)])))
    # the last array may hold fewer centroids than there is room for
    products = products.withColumn("_products", F.slice(apart, 1, len(centroids)))
    norms = literal([sum(v * v for v in c) for c in centroids])
    far = F.zip_with("_products", norms, lambda p, n: n - p - p)
    named = F.transform(far, lambda d, i: F.struct((d + F.col("norm")).alias("distance"), i.alias("cluster")))
    return products.withColumn("best", F.array_min(named)).drop("_products")


def moved(assigned: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floor of the mean of each cluster's vectors; empty clusters stay."""
    dims = range(len(centroids[0]))
    sums = assigned.groupBy(F.col("best.cluster").alias("cluster")).agg(F.count("*").alias("n"), *[F.expr(f"sum(x[{i}])").alias(f"s{i}") for i in dims])
    out = list(centroids)
    for row in sums.collect():  # one row per non-empty cluster
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in dims]
    return out


def clustered(table: DataFrame, k: int, rounds: int, dims: int = 64, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, x, cluster, distance) of every kept vector, final centroids).

    The first centroids are the ``k`` vectors with the least sha256 of ``seed`` and their id.
    """
    vectors = stored(integer_vectors(table, dims, scale, id_col, vector_col), "vectors")
    most_norm = vectors.agg(F.max("norm")).first()[0]
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    centroids = [list(r["x"]) for r in vectors.orderBy(order, "x").limit(k).select("x").collect()]
    if not centroids:
        nothing = vectors.select("vec_id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return nothing.limit(0), []
    for _ in range(rounds):
        centroids = moved(nearest(vectors, centroids, most_norm), centroids)
    last = nearest(vectors, centroids, most_norm).select("vec_id", "x", F.col("best.cluster").alias("cluster"), F.col("best.distance").alias("distance"))
    out = stored(last, "clusters")
    removed(vectors)
    return out, centroids


def inertia(rows: DataFrame) -> Column:
    return F.try_sum(F.col("distance").cast("decimal(38,0)")).try_cast("long")


def op12(embeddings: DataFrame, k: int = 40, rounds: int = 5) -> DataFrame:
    found, centroids = clustered(embeddings, k, rounds)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    # at most k rows and one row
    each = found.groupBy("cluster").agg(inertia(found).alias("cluster_inertia"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("_sum"))
    whole = found.agg(inertia(found).alias("inertia")).first()["inertia"]
    sha = F.element_at(F.array(*[F.lit(d) for d in digests]), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance").join(F.broadcast(each.select("cluster", "cluster_inertia")), "cluster").select(
        "vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), sha.alias("centroid_sha256"),
    )


def oracle(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:") -> str:
    """DuckDB SQL for ``op12``: one round of assignment and update after the other, as chained tables."""
    parts = [f"""raw AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings WHERE len(embedding) = {dims}),
        x AS MATERIALIZED (SELECT r, vec_id, list_transform(v, lambda c: floor({scale} * c)::BIGINT) AS x FROM raw WHERE len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{seed}' || vec_id::VARCHAR) NULLS LAST, x) - 1)::INT AS cluster, x AS c FROM x QUALIFY cluster < {k})"""]  # fmt: skip
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min(d) AS distance, arg_min(cluster, (d, cluster)) AS cluster FROM
            (SELECT r, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM x, c{i}) GROUP BY r)""")  # fmt: skip
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT cluster, i, sum(v) AS s, count(*) AS n FROM (SELECT a{i}.cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM x JOIN a{i} USING (r)) GROUP BY cluster, i),
                n{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM m{i} GROUP BY cluster),
                c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} USING (cluster))""")  # fmt: skip
    return f"""WITH {", ".join(parts)} SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
        (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN x USING (r) JOIN c{rounds} USING (cluster)"""
