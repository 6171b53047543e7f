"""The version log: numbering, crashes, two writers, history without data, schema changes and pruning."""

import threading

import pytest
from pyspark.sql import functions as F

from tabular_spark import versions


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_versions_number_themselves_and_stay(spark, tmp_path):
    base = str(tmp_path / "t")
    assert versions.latest(spark, base) is None
    assert versions.write_version(spark.range(3), base) == 0
    assert versions.write_version(versions.read_version(spark, base).where("id > 0"), base, "delete") == 1
    assert numbers(versions.read_version(spark, base)) == [1, 2] and numbers(versions.read_version(spark, base, 0)) == [0, 1, 2]
    with pytest.raises(ValueError):
        versions.read_version(spark, base, 7)


def test_a_crashed_write_is_invisible_and_blocks_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.write_version(spark.range(3), base)
    with pytest.raises(Exception):
        versions.write_version(spark.range(3).select(F.raise_error(F.lit("crash")).alias("id")), base)
    spark.range(5).write.parquet(f"{base}/w-{'0' * 32}")  # died before its claim
    versions.claimed(spark, base, "died after its claim")
    assert versions.write_version(spark.range(1), base) == 2
    assert sorted(r.version for r in versions.history(spark, base).collect()) == [0, 2]
    assert versions.read_versions(spark, base).count() == 4


def test_two_writers_get_two_numbers(spark, tmp_path):
    base, got = str(tmp_path / "t"), []
    threads = [threading.Thread(target=lambda i=i: got.append((versions.write_version(spark.range(i + 1), base), i + 1))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in got) == [0, 1, 2, 3]
    assert {r.version: r.n for r in versions.history(spark, base).collect()} == dict(got)


def test_history_reads_the_log_only(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([(1, "a", None), (None, "b", None)], "i int, s string, x double"), base, "first")
    row = versions.history(spark, base).first()
    assert (row.operation, row.n) == ("first", 2)
    assert [tuple(c) for c in row["columns"]] == [("i", 1, "1", "1"), ("s", 2, "a", "b"), ("x", 0, None, None)]
    assert not any("/w-" in f for f in versions.history(spark, base).inputFiles())


def test_added_dropped_and_widened_columns(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([(1, "a", 1.5)], "i int, gone string, f float"), base)
    versions.write_version(spark.createDataFrame([(1 << 40, 2.5, True)], "i long, f double, new boolean"), base)
    versions.write_version(spark.createDataFrame([("text",)], "new string"), base)
    found = versions.read_versions(spark, base)
    assert dict(found.dtypes) == {"version": "int", "i": "bigint", "gone": "string", "f": "double", "new": "string"}
    assert sorted(map(tuple, found.collect())) == [(0, 1, "a", 1.5, None), (1, 1 << 40, None, 2.5, "true"), (2, None, None, None, "text")]


@pytest.mark.parametrize("a,b,want", [("int", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "double", "string"), ("smallint", "tinyint", "smallint"), ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "int", "int"), ("boolean", "int", "string")])
def test_wider(a, b, want):
    assert versions.wider(a, b) == versions.wider(b, a) == want


def test_bounds_rule_versions_out(spark, tmp_path):
    base = str(tmp_path / "t")
    for start in (0, 100, 200):
        versions.write_version(spark.range(start, start + 100).withColumn("s", F.concat(F.lit("k"), F.col("id"))), base)
    versions.write_version(spark.createDataFrame([(None, None)], "id long, s string"), base)
    found = versions.read_versions(spark, base, {"id": (150, 205)})
    assert numbers(found.select("id")) == list(range(150, 206))
    assert len({f.rpartition("/")[0] for f in found.inputFiles()}) == 2
    assert versions.read_versions(spark, base, {"s": ("k250", "k250")}).select("id").collect()[0][0] == 250
    assert versions.read_versions(spark, base, {"id": (900, None)}).count() == 0
    assert versions.read_versions(spark, base, {"id": (None, 3)}).count() == 4


def test_long_texts_have_no_bounds(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([("x" * 100,)], "s string"), base)
    assert versions.history(spark, base).first()["columns"][0]["high"] is None
    assert versions.read_versions(spark, base, {"s": ("y", None)}).count() == 0 and versions.read_versions(spark, base, {"s": ("x", None)}).count() == 1


def test_nothing_written(spark, tmp_path):
    base = str(tmp_path / "t")
    assert versions.history(spark, base).collect() == [] and versions.read_versions(spark, base).collect() == []
    versions.write_version(spark.range(0), base)
    assert versions.read_version(spark, base).collect() == [] and versions.history(spark, base).first().n == 0
