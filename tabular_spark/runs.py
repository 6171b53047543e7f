"""Run records and model versions as plain tables of events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabular_spark.storage import stored

RUN_LOG = "run string, kind string, key string, text string, number double, at timestamp_ntz, write_id string"


def record(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Metrics of a frame as long rows (run_id, key, value)."""
    return df.select(F.col(id_col).alias("run_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in columns])).alias("m")).select("run_id", "m.*")


def latest(value: str, *order: str) -> Column:
    """The value of the last row by ``order``; it aggregates partially, so one busy key needs no task of its own."""
    return F.max_by(value, F.struct(*order))


def wide(df: DataFrame, run: str, key: str, value: str, keys: list[str], *order: str) -> DataFrame:
    """One row per run with its latest value of each known key, in one aggregate."""
    by = f"struct({', '.join(order)})"
    return df.groupBy(run).agg(*[F.expr(f"max_by({value}, {by}) FILTER (WHERE {key} = '{k}')").alias(k) for k in keys])


def stages(df: DataFrame, name: str, version: str, stage: str, *order: str) -> DataFrame:
    """(name, version, stage, since): the last stage of each version."""
    return df.groupBy(name, version).agg(latest(stage, *order).alias("stage"), F.max(order[0]).alias("since"))


def exclusive_stages(df: DataFrame, name: str, version: str, stage: str, promoted: str, archived: str, *order: str) -> DataFrame:
    """``stages``, where a promotion archives the versions of the same name that were promoted before."""
    newest = df.where(F.col(stage) == promoted).groupBy(F.col(name).alias("_name")).agg(F.max(order[0]).alias("newest"))
    now = stages(df, name, version, stage, *order)
    both = now.join(newest, now[name] == newest["_name"], "left")
    replaced = (F.col("stage") == promoted) & (F.col("since") < F.col("newest"))
    return both.select(name, version, F.when(replaced, archived).otherwise(F.col("stage")).alias("stage"))


def previous(df: DataFrame, key: str, value: str, at: str, tie: str, width: str = "day", out: str = "previous") -> DataFrame:
    """The value of the row before, per key by (at, tie), without one task for all rows of a key.

    Rows look back inside of buckets of time; the first of a bucket takes the last value of the
    nearest bucket before, from a table of one row per key and bucket. ``width`` (a unit of
    date_trunc) changes how the work is dealt, never the result.
    """
    bucketed = df.withColumn("_bucket", F.date_trunc(width, F.col(at)))
    ends = bucketed.groupBy(key, "_bucket").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(at, tie)).alias("_last"))
    carried = ends.select(F.col(key).alias("_key"), F.col("_bucket").alias("_at"), F.lag("_last").over(Window.partitionBy(key).orderBy("_bucket")).alias("_carried"))
    inside = bucketed.withColumn("_before", F.lag(F.struct(F.col(value).alias("v"))).over(Window.partitionBy(key, "_bucket").orderBy(at, tie)))
    both = inside.join(carried, inside[key].eqNullSafe(carried["_key"]) & inside["_bucket"].eqNullSafe(carried["_at"]))
    return both.withColumn(out, F.coalesce("_before", "_carried")["v"]).drop("_bucket", "_before", "_key", "_at", "_carried")


def logged(df: DataFrame, run: str, at: str, params: dict[str, Column], metrics: dict[str, Column]) -> DataFrame:
    """Rows of a run log: each run's params as texts and its metrics as numbers; those that are null have no row."""
    texts = [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"), v.cast("string").alias("text"), F.lit(None).cast("double").alias("number")) for k, v in params.items()]
    numbers = [F.struct(F.lit("metric").alias("kind"), F.lit(k).alias("key"), F.lit(None).cast("string").alias("text"), v.cast("double").alias("number")) for k, v in metrics.items()]
    rows = df.select(F.col(run).cast("string").alias("run"), F.col(at).cast("timestamp_ntz").alias("at"), F.explode(F.array(*texts, *numbers)).alias("r"))
    return rows.select("run", "r.*", "at").where("text IS NOT NULL OR number IS NOT NULL")


def append(rows: DataFrame, path: str, write_id: str) -> None:
    """Adds rows to a run log. A write that is repeated, because it failed or for no reason, replaces what it wrote before."""
    rows.select("run", "kind", "key", "text", "number", "at").write.mode("overwrite").parquet(f"{path}/write_id={write_id}")


def run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def run_table(log: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """One row per run with the latest value of each param and metric; of equal times the write with the larger id counts."""
    latest_of = "max_by({0}, struct(at, write_id)) FILTER (WHERE kind = '{1}' AND key = '{2}')"
    columns = [F.expr(latest_of.format(v, kind, k)).alias(k) for v, kind, keys in (("text", "param", params), ("number", "metric", metrics)) for k in keys]
    return log.groupBy("run").agg(*columns)


@dataclass
class LifeCycle:
    """What of a log of stage events must be kept to go on: the last event of each version and the newest promotion of each name.

    Both are maxima by the order of events, so that folding deltas in any order, late events included, gives what
    the whole log gives. ``last`` is (name, version, stage, order), ``promoted`` (name, newest).
    """

    last: DataFrame
    promoted: DataFrame


def fold(state: LifeCycle | None, delta: DataFrame, name: str, version: str, stage: str, promotion: str, *order: str) -> LifeCycle:
    """The state after the events of ``delta``; only the delta and the state are read."""
    events = delta.select(F.col(name).alias("name"), F.col(version).alias("version"), F.col(stage).alias("stage"), F.struct(*order).alias("order"))
    promoted = events.where(F.col("stage") == promotion).select("name", F.col("order")[order[0]].alias("newest"))
    if state is not None:
        events, promoted = state.last.unionByName(events), state.promoted.unionByName(promoted)
    last = events.groupBy("name", "version").agg(F.max_by("stage", "order").alias("stage"), F.max("order").alias("order"))
    return LifeCycle(stored(last, "life-cycle"), stored(promoted.groupBy("name").agg(F.max("newest").alias("newest")), "promotions"))


def current(state: LifeCycle, promotion: str, archived: str) -> DataFrame:
    """(name, version, stage), where a promotion archives the versions of the same name that were promoted before."""
    first = state.last.schema["order"].dataType.names[0]
    replaced = (F.col("stage") == promotion) & (F.col("order")[first] < F.col("newest"))
    return state.last.join(state.promoted, "name", "left").select("name", "version", F.when(replaced, archived).otherwise(F.col("stage")).alias("stage"))


def refreshed(answers: DataFrame | None, log: DataFrame, delta: DataFrame, key: str, answer) -> DataFrame:
    """``answer`` of the log, where only the keys of ``delta`` are answered anew; ``log`` holds the delta already.

    For answers that a late event can change, as what came before an event: those of other keys stay as they were.
    """
    touched = stored(delta.select(key).distinct(), "touched")
    new = answer(log.join(touched, key, "left_semi"))
    return stored(new if answers is None else answers.join(touched, key, "left_anti").unionByName(new), "answers")
