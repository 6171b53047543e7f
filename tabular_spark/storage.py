"""Tables and models as files: scratch tables, CSV and saved pipelines."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


#: Nulls are written as \\N, so that empty texts stay empty texts; a text of just that reads as null.
CSV = {"header": True, "nullValue": "\\N", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the store that driver and executors share: the checkpoint folder, or else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to a new folder and read back, so that all later uses see the same rows and partitions' numbers."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; quotes are doubled, so that commas, quotes and line breaks inside of fields survive."""
    df.write.mode(mode).options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """For files without line breaks in fields; ``csv_scan.read_csv_blocks`` reads those that have them, block by block."""
    return spark.read.schema(ddl).options(**CSV).csv(path)


def save_model(model: PipelineModel, path: str, example: DataFrame | None = None, rows: int = 5) -> None:
    """Saves a fitted pipeline, and a few rows of its input beside it."""
    model.write().overwrite().save(f"{path}/model")
    if example is not None:
        example.limit(rows).write.parquet(f"{path}/example")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
