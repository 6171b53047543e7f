"""Registered models: found by name and version or stage, checked against their input, scored side by side."""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import storage, versions
from tabular_spark.model import prediction_column

ENTRY = "name string, version long, at timestamp, path string, signature string"
STAGE = "name string, version long, stage string, at timestamp, write_id string"


def signature(df: DataFrame, label: str | None = None) -> str:
    return json.dumps({n: t for n, t in df.dtypes if n != label})


def register(model: PipelineModel, name: str, base: str, inputs: DataFrame, label: str | None = None, rows: int = 5) -> int:
    """Saves a fitted pipeline as the next version of ``name``, with the names and types of its input and some rows of it.

    The entry is written last; a registration that dies before has no version.
    """
    spark, path = inputs.sparkSession, f"{base}/{name}/m-{uuid.uuid4().hex}"
    storage.save_model(model, path, inputs, rows)
    version = versions.claimed(spark, f"{base}/{name}", path)
    row = (name, version, datetime.datetime.now(datetime.timezone.utc), path, signature(inputs, label))
    spark.createDataFrame([row], ENTRY).coalesce(1).write.json(f"{base}/_entries/{name}-{version}")
    return version


def entries(spark: SparkSession, base: str) -> DataFrame:
    """(name, version, at, path, signature) of all registered versions."""
    return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(f"{base}/_entries")


def set_stage(spark: SparkSession, base: str, name: str, version: int, stage: str) -> None:
    write_id = uuid.uuid4().hex
    row = (name, version, stage, datetime.datetime.now(datetime.timezone.utc), write_id)
    spark.createDataFrame([row], STAGE).coalesce(1).write.json(f"{base}/_stages/{write_id}")


def staged(spark: SparkSession, base: str) -> DataFrame:
    """(name, version, stage): the last stage set for each version."""
    events = spark.read.schema(STAGE).option("recursiveFileLookup", "true").json(f"{base}/_stages")
    return events.groupBy("name", "version").agg(F.max_by("stage", F.struct("at", "write_id")).alias("stage"))


def found(spark: SparkSession, base: str, name: str, version: int | None = None, stage: str | None = None) -> list:
    """Entries of a name: one version, all versions in a stage, or the latest version."""
    rows = entries(spark, base).where(F.col("name") == name)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    elif stage is not None:
        rows = rows.join(staged(spark, base).where((F.col("name") == name) & (F.col("stage") == stage)).select("version"), "version", "left_semi")
    else:
        rows = rows.orderBy(F.desc("version")).limit(1)
    out = rows.orderBy("version").collect()  # one row a version
    if not out:
        raise ValueError(f"no version of {name} that fits")
    return out


def check_input(df: DataFrame, wanted: str) -> None:
    """Raises an error that names every column which is missing or of another type."""
    there = dict(df.dtypes)
    wrong = [f"{n}: {there.get(n, 'missing')} instead of {t}" for n, t in json.loads(wanted).items() if there.get(n) != t]
    if wrong:
        raise ValueError("input does not fit the model: " + "; ".join(wrong))


def scored(df: DataFrame, base: str, name: str, chosen: list[int]) -> DataFrame:
    """``df`` with a column prediction_N for each version N, all from one scan."""
    spark, out = df.sparkSession, df
    for version in chosen:
        entry = found(spark, base, name, version)[0]
        check_input(df, entry["signature"])
        model = storage.load_model(entry["path"])
        applied = model.transform(out)
        out = applied.select(*out.columns, F.col(prediction_column(model)).alias(f"prediction_{version}"))
    return out
