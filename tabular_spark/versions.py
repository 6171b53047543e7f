"""Versioned tables: data folders, and an append-only log that alone says which of them are versions.

A write first puts its rows into a folder of its own, measuring them on the way (rows, values and
bounds of each column, by ``observe``, so in the same pass). Then it claims the next number by
creating a file that must not exist yet, and last it appends one row to the log. Readers look
at the log only: what crashed before its row was written is invisible and stands in nobody's way.
Versions keep the schema they were written with; reading several brings them to the narrowest
schema that holds all of them, and leaves out versions whose bounds rule them out.
"""

from __future__ import annotations

import datetime
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, BooleanType, DataType, StringType, StructType, VariantType

LOG = "version long, operation string, at timestamp, schema string, rows long, path string, columns array<struct<name string, filled long, low string, high string>>"
#: Bounds of texts are kept up to this length; a longer one is unknown and rules nothing out.
LONGEST_BOUND = 64
#: Types in which a narrower type is held without loss, from each type on.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"), "bigint": ("decimal(38,0)",),
    "float": ("double",), "date": ("timestamp_ntz",), "void": (),
}


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def measured(schema: StructType) -> list[Column]:
    """What the log keeps of each column, as aggregates."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(schema.fields):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        out.append(F.count(column).alias(f"n{i}"))
        if isinstance(kind, AtomicType) and not isinstance(kind, (BinaryType, BooleanType, VariantType)):
            for name, bound in (("low", F.min(column)), ("high", F.max(column))):
                text = bound.cast("string")
                out.append((F.when(F.length(text) <= LONGEST_BOUND, text) if isinstance(kind, StringType) else text).alias(f"{name}{i}"))
    return out


def claimed(spark: SparkSession, base: str, owner: str) -> int:
    """The next number that no write has claimed, claimed for ``owner``."""
    folder, files = _files(spark, f"{base}/_claims")
    files.mkdirs(folder)
    number = max((int(f.getPath().getName()) + 1 for f in files.listStatus(folder) if f.getPath().getName().isdigit()), default=0)
    while True:
        place, _ = _files(spark, f"{base}/_claims/{number:020d}")
        try:
            out = files.create(place, False)
        except Exception as e:
            if not files.exists(place):
                raise e
            number += 1  # another write was first
            continue
        out.write(bytearray(owner.encode()))
        out.close()
        return number


def write_version(df: DataFrame, base: str, operation: str = "overwrite") -> int:
    """Writes ``df`` as the next version and returns its number. Readers of other versions are not disturbed."""
    spark, owner, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    df.observe(seen, *measured(df.schema)).write.parquet(f"{base}/w-{owner}")
    found = seen.get
    columns = [(f.name, found[f"n{i}"], found.get(f"low{i}"), found.get(f"high{i}")) for i, f in enumerate(df.schema.fields)]
    number = claimed(spark, base, owner)
    row = (number, operation, datetime.datetime.now(datetime.timezone.utc), df.schema.json(), found["rows"], f"w-{owner}", columns)
    spark.createDataFrame([row], LOG).coalesce(1).write.json(f"{base}/_log/{number:020d}")
    return number


def log(spark: SparkSession, base: str) -> DataFrame:
    """One row per version, from the log alone."""
    place, files = _files(spark, f"{base}/_log")
    if not files.exists(place):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).option("recursiveFileLookup", "true").json(f"{base}/_log")


def history(spark: SparkSession, base: str) -> DataFrame:
    """(version, operation, at, n, schema, columns) of all versions; no version is opened."""
    return log(spark, base).select("version", "operation", "at", F.col("rows").alias("n"), "schema", "columns")


def values_in(column: str) -> Column:
    """The number of values that the log says a column of a version has, 0 where the version lacks it."""
    return F.coalesce(F.expr(f"get(filter(columns, c -> c.name = '{column}'), 0).filled"), F.lit(0).cast("long"))


def latest(spark: SparkSession, base: str) -> int | None:
    return log(spark, base).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A version with the schema it was written with; the latest one where none is named."""
    if version is None:
        version = latest(spark, base)
    row = log(spark, base).where(F.col("version") == F.lit(version)).first()
    if row is None:
        raise ValueError(f"{base} has no version {version}")
    return spark.read.schema(schema_of(row["schema"])).parquet(f"{base}/{row['path']}")


def schema_of(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both; text, where there is none but that."""
    if a == b or b == "void":
        return a
    if a == "void" or b in WIDER.get(a, ()):
        return b
    if a in WIDER.get(b, ()):
        return a
    return next((t for t in WIDER.get(a, ()) if t in WIDER.get(b, ())), "string")


def widened(schemas: list[StructType]) -> dict[str, DataType | str]:
    """Column names in order of appearance, each with the type that holds it in all schemas."""
    out: dict[str, str] = {}
    for schema in schemas:
        for field in schema.fields:
            kind = field.dataType.simpleString()
            out[field.name] = wider(out[field.name], kind) if field.name in out else kind
    return out


def may_hold(row, bounds: dict[str, tuple[Any, Any]], kinds: dict[str, str]) -> Column:
    """Whether a version may have rows within the bounds, as a comparison in the column's own type."""
    test = F.lit(True)
    known = {c["name"]: c for c in row["columns"]}
    for name, (low, high) in bounds.items():
        if name not in known or not known[name]["filled"]:
            return F.lit(False)  # only nulls
        for own, wanted, holds in ((known[name]["high"], low, lambda a, b: a >= b), (known[name]["low"], high, lambda a, b: a <= b)):
            if own is not None and wanted is not None:
                test &= holds(F.lit(own).cast(kinds[name]), F.lit(wanted).cast(kinds[name]))
    return test


def read_versions(spark: SparkSession, base: str, bounds: dict[str, tuple[Any, Any]] | None = None) -> DataFrame:
    """All versions with their number, in the schema that holds all of them; columns that a version lacks are null.

    ``bounds`` (column to lowest and highest value, None for open) keeps the rows within them, and opens only
    versions that may have such rows. Versions of one schema are one scan.
    """
    rows = log(spark, base).orderBy("version").collect()  # one row per version
    kinds = widened([schema_of(r["schema"]) for r in rows])
    if bounds and rows:
        kept = spark.range(1).select(*[may_hold(r, bounds, kinds).alias(f"v{i}") for i, r in enumerate(rows)]).first()
        rows = [r for i, r in enumerate(rows) if kept[i]]
    out = spark.createDataFrame([], ", ".join(["version int", *(f"`{n}` {k}" for n, k in kinds.items())]))
    by_schema: dict[str, list] = {}
    for r in rows:
        by_schema.setdefault(r["schema"], []).append(r)
    for text, group in by_schema.items():
        own = schema_of(text)
        scan = spark.read.schema(own).parquet(*[f"{base}/{r['path']}" for r in group])
        numbers = F.create_map(*[F.lit(x) for r in group for x in (r["path"], r["version"])])
        version = F.element_at(numbers, F.regexp_extract("_metadata.file_path", r"/(w-[0-9a-f]{32})/", 1)).cast("int")
        part = scan.select(version.alias("version"), *[(F.col(f"`{n}`") if n in own.names else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])
        out = out.unionByName(part)
    for name, (low, high) in (bounds or {}).items():
        if name not in kinds:
            return out.limit(0)
        out = out.where((F.col(name) >= F.lit(low) if low is not None else F.col(name).isNotNull()) & (F.col(name) <= F.lit(high) if high is not None else F.lit(True)))
    return out
