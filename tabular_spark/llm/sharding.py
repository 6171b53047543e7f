"""Two-pass external shuffle into shards, with DataFrame operations only.

First pass: a seeded hash of each record scatters the records evenly into buckets that fit a
task's memory. Second pass: each bucket is put into a fixed order and then through a seeded
Fisher-Yates shuffle (what Spark's ``shuffle`` does to an array). The buckets, one after the
other, are the shuffled order; shards are runs of it whose numbers of rows differ by one at most.

The order depends on the records and the seed alone: a record's hash is of all its columns, rows
that repeat one are counted and scattered by their number, and each bucket goes to the partition
of its number and is shuffled there in turn, as ``shuffle`` draws by the partition's number. So
neither the partitions of the input nor a task run anew change it.

Cases: nulls, empty texts and repeated rows are records like any others (a null text has size 1
and the checksum of the empty text); an empty table gives an empty result; all columns are
carried in one struct, so no name can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tabular_spark.llm.common import stored

#: Bytes of records that a bucket holds on average, and partitions that buckets are dealt to; with more buckets than these, a partition holds several.
BUCKET_BYTES, PARTS = 4 << 20, 1 << 16
#: So many bucket offsets (16 bytes each) or digests of repeated records (32 bytes each) are broadcast at most; with more, they are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Rows that repeat a record are numbered in blocks of so many, each by a task of its own.
REPEATS = 1 << 16


def whole(docs: DataFrame) -> Column:
    """All columns of a record as bytes that no other record has: texts as they are, after their lengths and the other columns in JSON."""
    head, tail = [], []
    for i, field in enumerate(docs.schema.fields):
        column = F.col(f"`{field.name}`")
        text = isinstance(field.dataType, (StringType, BinaryType))
        head.append((F.octet_length(column) if text else column).alias(f"c{i}"))
        tail += [F.coalesce(column.cast("binary"), F.expr("X''"))] if text else []
    return F.concat(F.to_json(F.struct(*head), {"ignoreNullFields": "false"}).cast("binary"), *tail)


def numbered(repeated: DataFrame) -> DataFrame:
    """Each row ``n`` times, with its ``ordinal``; a row repeated very often is dealt to many tasks."""
    blocks = repeated.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(REPEATS).cast("long")))).repartition("digest", "low")
    return blocks.withColumn("ordinal", F.explode(F.sequence("low", F.least(F.col("low") + REPEATS, "n") - 1))).drop("low", "n")


def bucket_offsets(sizes: DataFrame, block: int = 1024) -> DataFrame:
    """(bucket, before): the rows in all buckets before, from (bucket, rows), block by block."""
    from pyspark.sql import Window

    sizes = sizes.withColumn("block", F.floor(F.col("bucket") / block))
    blocks = sizes.groupBy("block").agg(F.sum("rows").alias("block_rows"))
    blocks = blocks.select("block", (F.sum("block_rows").over(Window.orderBy("block")) - F.col("block_rows")).alias("block_before"))
    inner = F.sum("rows").over(Window.partitionBy("block").orderBy("bucket")) - F.col("rows")
    return sizes.withColumn("inner", inner).join(blocks, "block").select("bucket", (F.col("block_before") + F.col("inner")).alias("before"))


def shuffled(docs: DataFrame, shards: int, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(record, shard, slot): every record, whole, with its shard and its place in it."""
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    every = docs.select(record.alias("record"), F.unhex(F.sha2(whole(docs), 256)).alias("digest"), F.octet_length(whole(docs)).cast("long").alias("bytes"))
    slim = stored(every.groupBy("digest").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "shard-keys")
    rows, size, repeats = slim.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("n", "bytes")], F.count_if(F.col("n") > 1)).first()
    buckets = max(1, math.ceil(size / bucket_bytes))
    parts = min(buckets, PARTS)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "digest", "ordinal"), F.lit(buckets)).cast("int").alias("bucket")
    first = F.lit(0).cast("long").alias("ordinal")
    keys = slim.where("n = 1").select("digest", first).unionByName(numbered(slim.where("n > 1").select("digest", "n")))
    offsets = bucket_offsets(keys.select(bucket).groupBy("bucket").agg(F.count("*").alias("rows")))
    names = slim.where("n > 1").select("digest")
    names = F.broadcast(names) if repeats <= BROADCAST_ROWS else names
    once = every.join(names, "digest", "left_anti").select("record", "digest", first)
    again = numbered(every.join(names, "digest", "left_semi").groupBy("digest").agg(F.first("record").alias("record"), F.count("*").alias("n")))
    row = F.struct(F.xxhash64(F.lit(seed + 1), "digest", "ordinal").alias("order"), "digest", "ordinal", "record").alias("row")
    scattered = once.unionByName(again).select(bucket, row).withColumn("part", F.pmod("bucket", F.lit(parts))).repartitionById(parts, "part")
    by_order = "array_sort(collect_list(row), (a, b) -> CASE " + " ".join(f"WHEN a.{x} < b.{x} THEN -1 WHEN a.{x} > b.{x} THEN 1" for x in ("order", "digest", "ordinal")) + " ELSE 0 END)"
    ordered = scattered.groupBy("part", "bucket").agg(F.expr(by_order).alias("rows")).sortWithinPartitions("part", "bucket")
    mixed = ordered.select("bucket", F.shuffle("rows", seed).alias("rows"))
    placed = mixed.join(F.broadcast(offsets) if buckets <= BROADCAST_ROWS else offsets, "bucket")
    at = placed.select("before", F.posexplode("rows").alias("pos", "row")).select(F.col("row.record").alias("record"), (F.col("before") + F.col("pos")).alias("at"))
    at = at.withColumn("shard", F.expr(f"cast(({shards}L * (at + 1) - 1) div {max(1, rows)}L as int)"))
    return at.select("record", "shard", F.expr(f"at - (shard * {rows}L) div {shards}L").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Writes the shuffled records as Parquet, ``path/shard=N``: columns ``record`` (a struct, so that no name can clash) and ``slot``."""
    shuffled(docs, shards, **options).write.partitionBy("shard").parquet(path)


def op2(docs: DataFrame, shards: int = 16) -> DataFrame:
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shuffled(docs, shards).select(
        F.col("record.doc_id").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
