"""Quoted CSV with line breaks in fields, read by as many tasks as the file has blocks.

Whether a line break ends a record depends on the quotes before it, in all the file. Spark splits
the file into blocks of lines; each block reports how many lines of it hold an odd number of
quotes. A prefix scan over these few numbers tells whether a block starts inside of a quoted
field, and which block began the record that is open there. With that, each block is cut
into records on its own; the pieces of records that run over a border, two a block at most, are
put together by the block that began them. Records are written once as they are cut, and parsed
from there; types are inferred from all of them in one aggregate.

Quotes are doubled inside of quoted fields, or escaped by a backslash where that is asked for. As
in RFC 4180, a quote has no place in a field that isn't quoted. Files are UTF-8; lines end with
a line feed, with or without a carriage return; empty lines are no records. Compressed files
are one block each.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabular_spark.storage import new_folder

#: Blocks (some tens of bytes each) whose state is broadcast; beyond, it is joined by a shuffle of lines.
BROADCAST_BLOCKS = 1_000_000
#: Types from narrow to wide, and what their texts look like; a column gets the first that all its values fit.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
KINDS = (
    ("int", r"^[+-]?\d+$"), ("bigint", r"^[+-]?\d+$"), ("double", NUMBER), ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp_ntz", r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?)?$"), ("boolean", r"^(?i)(true|false)$"),
)
RECORD, PIECE = "record", "piece"


def lines(spark: SparkSession, path: str, escape: str = '"') -> DataFrame:
    """(file, block, quotes, line) in the order of the file inside of each block."""
    raw = spark.read.option("lineSep", "\n").text(path)
    plain = F.col("value") if escape == '"' else F.regexp_replace("value", r"\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), quotes.alias("quotes"), F.col("value").alias("line"))


def block_states(found: DataFrame) -> DataFrame:
    """(file, block, inside, begun): whether a block starts inside of a quoted field, and the block in which that record began."""
    odd = found.groupBy("file", "block").agg(F.sum(F.col("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = odd.withColumn("inside", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    # a block with odd lines that ends inside of a field began the record that is open there
    begins = F.when((F.col("odd") > 0) & ((F.col("inside") + F.col("odd")) % 2 == 1), F.col("block"))
    return at.withColumn("begun", F.max(begins).over(before)).select("file", "block", "inside", "begun")


def cut(batches: Iterator) -> Iterator:
    """Records, and pieces of records that run over a border, from the lines of blocks, whose states they carry."""
    import numpy as np
    import pyarrow as pa

    names, kinds = ["kind", "file", "begun", "block", "first", "record"], [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    key, inside, begun, at, opened, head, open_lines = None, 0, None, 0, 0, False, []
    out: list[tuple] = []

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def piece() -> None:
        if open_lines:
            out.append((PIECE, key[0], begun if head else key[1], key[1], not head and key[1] == opened == 0, "\n".join(open_lines)))

    for batch in batches:
        files, blocks = batch.column("file").to_numpy(zero_copy_only=False), batch.column("block").to_numpy()
        change = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for start, stop in zip([0, *change], [*change, batch.num_rows]):
            if stop == start:
                continue
            if key != (files[start], blocks[start]):
                piece()
                key, at, open_lines = (files[start], int(blocks[start])), 0, []
                inside, begun = batch.column("inside")[start].as_py(), batch.column("begun")[start].as_py()
                head = bool(inside)
            ends = (inside + np.cumsum(batch.column("quotes").to_numpy()[start:stop])) % 2
            was = np.concatenate([[inside], ends[:-1]])
            whole, texts = (ends == 0) & (was == 0), batch.column("line").slice(start, stop - start)
            if n := int(whole.sum()):
                first = (np.flatnonzero(whole) + at + key[1]) == 0
                yield batch_of([[RECORD] * n, [key[0]] * n, pa.nulls(n, pa.int64()), [key[1]] * n, pa.array(first), texts.filter(pa.array(whole))])
            for i in np.flatnonzero(~whole).tolist():
                if was[i] == 0:
                    head, opened, open_lines = False, at + i, []
                open_lines.append(texts[i].as_py())
                if ends[i] == 0:
                    out.append((PIECE if head else RECORD, key[0], begun, key[1], not head and key[1] == opened == 0, "\n".join(open_lines)))
                    head, open_lines = False, []
            inside, at = int(ends[-1]), at + stop - start
        if out:
            yield batch_of(zip(*out))
            out = []
    piece()
    if out:
        yield batch_of(zip(*out))


def records(spark: SparkSession, path: str, escape: str = '"') -> DataFrame:
    """(record, first): every record of the files as text; ``first`` marks the first one of a file."""
    found = lines(spark, path, escape)
    folder = new_folder(spark, "csv-records")
    states = block_states(found)
    states.write.parquet(f"{folder}/states")
    states = spark.read.parquet(f"{folder}/states")
    few = states.count() <= BROADCAST_BLOCKS
    if few:
        both = found.join(F.broadcast(states), ["file", "block"])  # keeps the order of lines
    else:
        numbered = found.withColumn("_at", F.monotonically_increasing_id()).join(states, ["file", "block"])
        both = numbered.repartition("file", "block").sortWithinPartitions("file", "block", "_at").drop("_at")
    schema = "kind string, file string, begun long, block long, first boolean, record string"
    both.select("file", "block", "quotes", "line", "inside", "begun").mapInArrow(cut, schema).write.partitionBy("kind").parquet(f"{folder}/records")
    kept = spark.read.schema(schema).parquet(f"{folder}/records")
    pieces = kept.where(F.col("kind") == PIECE).groupBy("file", "begun").agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("p"), F.max("first").alias("first"))
    stitched = pieces.select(F.array_join(F.col("p.record"), "\n").alias("record"), "first")
    all_records = kept.where(F.col("kind") == RECORD).select("record", "first").unionByName(stitched)
    bare = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return all_records.withColumn("record", bare).where(F.trim("record") != "")


def parsed(found: DataFrame, names: list[str], escape: str, null_value: str, sep: str) -> DataFrame:
    """Text columns of records, in the names given; what a record lacks is null."""
    options = {"sep": sep, "escape": escape, "nullValue": null_value, "multiLine": "true", "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    return found.select(F.from_csv("record", ddl, options).alias("r")).select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type that all values of a column fit, from one aggregate over all of them; "string" for one without values."""

    def misfits(name: str, kind: str, pattern: str) -> Column:
        column = F.col(f"`{name}`")
        return F.count_if(column.isNotNull() & ~(column.rlike(pattern) & column.try_cast(kind).isNotNull()))

    row = texts.agg(*[F.count(f"`{n}`").alias(f"n{i}") for i, n in enumerate(texts.columns)], *[misfits(n, k, p).alias(f"m{i}_{j}") for i, n in enumerate(texts.columns) for j, (k, p) in enumerate(KINDS)]).first()
    return {n: next((k for j, (k, _) in enumerate(KINDS) if row[f"n{i}"] and not row[f"m{i}_{j}"]), "string") for i, n in enumerate(texts.columns)}


def header_names(record: str, sep: str, escape: str, header: bool) -> list[str]:
    """The names in a header; without one, as many as the record has fields."""
    escaped = {"doublequote": True} if escape == '"' else {"doublequote": False, "escapechar": escape}
    fields = next(csv.reader(io.StringIO(record, newline=""), delimiter=sep, **escaped))
    return [name if header and name else f"_c{i}" for i, name in enumerate(fields)]


def read_csv_blocks(spark: SparkSession, path: str, ddl: str | None = None, header: bool = True, escape: str = '"', null_value: str = "\\N", sep: str = ",") -> DataFrame:
    """The table of quoted CSV files. Without ``ddl``, names come from the header (or are _c0, _c1, ...) and types from all values.

    With several files the names are those of the least header. A value that doesn't fit its type is null.
    """
    found = records(spark, path, escape)
    if ddl is not None:
        kinds = dict(spark.createDataFrame([], ddl).dtypes)
    else:
        top = (found.where("first") if header else found).agg(F.min("record")).first()[0]
        kinds = dict.fromkeys(header_names(top, sep, escape, header)) if top is not None else {}
    if not kinds:
        return spark.createDataFrame([], "_c0 string")
    texts = parsed(found.where("NOT first") if header else found, list(kinds), escape, null_value, sep)
    if ddl is None:
        kinds = infer_types(texts)
    return texts.select(*[F.col(f"`{n}`").try_cast(k).alias(n) for n, k in kinds.items()])
