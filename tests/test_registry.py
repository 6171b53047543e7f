"""Registered models and the run log."""

import pytest
from pyspark.sql import functions as F

from tabular_spark import model, registry, runs


def line(spark, slope):
    return spark.createDataFrame([(float(x), slope * x + 1.0) for x in range(5)], "x double, y double")


def test_versions_stages_and_signatures(spark, tmp_path):
    base = str(tmp_path)
    for slope in (1.0, 2.0):
        train = line(spark, slope)
        registry.register(model.fit_columns(train, ["x"], "y"), "line", base, train, label="y")
    assert [r.version for r in registry.found(spark, base, "line")] == [1]
    registry.set_stage(spark, base, "line", 1, "production")
    registry.set_stage(spark, base, "line", 0, "production")
    registry.set_stage(spark, base, "line", 1, "archived")
    assert [r.version for r in registry.found(spark, base, "line", stage="production")] == [0]
    got = registry.scored(spark.createDataFrame([(10.0, "kept")], "x double, other string"), base, "line", [0, 1]).first()
    assert (got.other, round(got.prediction_0, 6), round(got.prediction_1, 6)) == ("kept", 11.0, 21.0)
    with pytest.raises(ValueError, match="x: string instead of double"):
        registry.scored(spark.createDataFrame([("a",)], "x string"), base, "line", [0])
    with pytest.raises(ValueError, match="x: missing"):
        registry.scored(spark.range(1), base, "line", [0])
    with pytest.raises(ValueError):
        registry.found(spark, base, "line", 7)


def test_repeated_appends_count_once(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([(1, "2020-01-01 00:00:00", 0.5, None)], "id int, at string, rmse double, note string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    rows = runs.logged(one, "id", "at", {"note": F.col("note"), "depth": F.lit(3)}, {"rmse": F.col("rmse")})
    for write_id in ("a", "b", "a", "b"):
        runs.append(rows, path, write_id)
    assert runs.run_log(spark, path).count() == 4
    assert runs.run_table(runs.run_log(spark, path), ["depth", "note"], ["rmse"]).collect() == [("1", "3", None, 0.5)]


def test_folding_in_any_order_gives_the_same_state(spark):
    rows = [("m", v, s, t) for t, (v, s) in enumerate([(1, "none"), (1, "prod"), (2, "prod"), (1, "prod"), (2, "none"), (3, "prod"), (3, "archived")])]
    log = spark.createDataFrame(rows, "name string, version int, stage string, t int")
    whole = sorted(map(tuple, runs.current(runs.fold(None, log, "name", "version", "stage", "prod", "t"), "prod", "archived").collect()))
    state = None
    for part in ("t > 4", "t < 2", "t BETWEEN 2 AND 4", "t > 100"):
        state = runs.fold(state, log.where(part), "name", "version", "stage", "prod", "t")
    assert sorted(map(tuple, runs.current(state, "prod", "archived").collect())) == whole == [("m", 1, "archived"), ("m", 2, "none"), ("m", 3, "archived")]
