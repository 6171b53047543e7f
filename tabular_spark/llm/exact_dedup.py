"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary of the digests names the few texts that may be very frequent. Their exact
counts and winners are verified in a second pass; being at most ``counters`` rows, they are
broadcast, so that copies of frequent texts are settled where they are read. All other digests
take the ordinary shuffle; by the summary's bound none of them holds more than about three
quarters of what a shuffle partition has on average, whatever the number of rows.

Cases: a null text counts as empty; empty texts are one group; of equal texts the row with the
largest id stays (a null id is the smallest); of repeated rows one stays; an empty table gives an
empty result; other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import as_record, stored, text_of

#: Misra-Gries counters at least, and for each shuffle partition. A text held by more than 3/(counters + 1) of all rows is always found.
COUNTERS, PER_PARTITION = 1000, 4


def counters_for(df: DataFrame) -> int:
    return max(COUNTERS, PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest): one slim row per document; ``row`` tells repeated rows apart."""
    return docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(text_of(text_col), 256)).alias("digest"))


def misra_gries(keys: DataFrame, counters: int) -> DataFrame:
    """At most ``counters`` candidates for the most frequent values of the only column of ``keys``.

    Each task keeps ``counters`` counters and merges batch by batch: when there are more, the
    first count beyond them is taken off all. It gives out those above its rows / (counters + 1).
    Any value of more than 3 n / (counters + 1) rows is among the candidates.
    """
    name = keys.columns[0]

    def summary(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: dict[bytes, int] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for x in batch.column(0).value_counts().to_pylist():
                counts[x["values"]] = counts.get(x["values"], 0) + x["counts"]
            if len(counts) > counters:
                off = sorted(counts.values(), reverse=True)[counters]
                counts = {k: v - off for k, v in counts.items() if v > off}
        kept = {k: v for k, v in counts.items() if v * (counters + 1) > rows}
        yield pa.RecordBatch.from_pydict({name: pa.array(list(kept), pa.binary()), "n": pa.array(list(kept.values()), pa.int64())})

    found = keys.mapInArrow(summary, f"{name} binary, n long").groupBy(name).agg(F.sum("n").alias("n"))
    return found.orderBy(F.desc("n"), name).limit(counters).select(name)


def groups(slim: DataFrame, counters: int | None = None) -> DataFrame:
    """``slim`` of ``digests``, stored, with keep_id, keep_row and group_size; ``counters`` are ``counters_for`` it if None."""
    counters = counters or counters_for(slim)
    candidates = stored(misra_gries(slim.select("digest"), counters), "heavy-candidates")
    best = [F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("best")]
    least = 3 * slim.count() // (counters + 1)
    exact = slim.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*best)
    winners = stored(exact.where(F.col("group_size") > least), "heavy-winners")
    heavy = slim.join(F.broadcast(winners), "digest")
    light = slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = light.join(light.groupBy("digest").agg(*best), "digest")
    columns = ["doc_id", "row", "digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")]
    return heavy.select(*columns).unionByName(rest.select(*columns))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(stored(digests(docs, id_col, text_col), "digests"), counters)
    return found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Only the rows to drop are looked up, by id and digest. Rows that repeat a kept one in id and
    text are rare; where there are any, they are reduced to one by a second step.
    """
    found = stored(groups(stored(digests(docs, id_col, text_col), "digests"), counters), "dedup-groups")
    drop = found.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    again = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).count().where("count > 1").drop("count")

    def match(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.join(keys, df["digest"].eqNullSafe(keys["_digest"]) & df["id"].eqNullSafe(keys["_id"]), how)

    keyed = as_record(docs, id=F.col(id_col), digest=F.unhex(F.sha2(text_of(text_col), 256)))
    left = match(keyed, drop, "left_anti")
    if not again.isEmpty():
        again = stored(again, "dedup-repeats")
        left = match(left, again, "left_anti").unionByName(match(left, again, "left_semi").dropDuplicates(["id", "digest"]))
    return left.select("record.*")
