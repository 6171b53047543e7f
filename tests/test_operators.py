"""Operators on small fixtures: nulls, ties, skew and what the plan must not hold."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabular_spark import checks, clean, csv_scan, features, model, profile, runs, split, storage, versions
from tabular_spark.quantile import exact_quantiles, quantile
from tabular_spark.queries import QUERIES


def lower_quantile(values, share):
    values = sorted(values)
    return values[max(1, math.ceil(share * len(values))) - 1]


@pytest.mark.parametrize("values", [[5.0], [1.0] * 500 + [2.0], list(range(1000)), [0] * 400 + list(range(600)), [-1.5, None, 2.5, None]])
@pytest.mark.parametrize("k", [8, 4096])
def test_exact_quantiles(spark, values, k):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    full = [float(v) for v in values if v is not None]
    assert exact_quantiles(df, ["v"], shares, k)["v"] == [lower_quantile(full, p) for p in shares]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1]}


def test_approximate_quantile_rank(spark):
    got = quantile(spark.range(10_000).select(F.col("id").cast("double").alias("v")), "v", [0.5], 100).first()
    assert abs(got["value"] - 5000) <= 100


def test_amounts(spark):
    df = spark.createDataFrame([("$1,234.50",), ("",), (None,), ("N/A",), ("$0.00",)], "p string")
    assert [r[0] for r in df.select(clean.amount("p")).collect()] == [1234.5, None, None, None, 0.0]


def test_flags_come_before_filling(spark):
    df = spark.createDataFrame([(1, 4), (2, None), (3, 4), (4, 9)], "id int, beds int")
    got = clean.imputed_with_flags(df, ["beds"]).orderBy("id").collect()
    assert [(r.beds, r.beds_na) for r in got] == [(4, 0.0), (4, 1.0), (4, 0.0), (9, 0.0)]


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 2), ("a", 2), (None, 2)], "s string, n int")
    assert clean.modes(df, ["s", "n"]) == {"s": "a", "n": 2}


def test_filled_leaves_columns_without_a_value(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert clean.imputed_with_flags(df, ["v"]).first().asDict() == {"v": None, "v_na": 1.0}


def test_label_index(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), ("c",), (None,)], "c string")
    labels = features.label_index(df, "c")
    assert {r["label"]: r["index"] for r in labels.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [r.i for r in features.indexed(new, labels, "c", "i").collect()] == [1.0]
    assert sorted(r.i for r in features.indexed(new, labels, "c", "i", unseen="keep").collect()) == [1.0, 3.0, 3.0]


def test_split_is_disjoint_complete_and_independent_of_partitions(spark):
    weights = {"a": 0.7, "b": 0.15, "c": 0.15}
    one = {r.id: r.split for r in split.with_split(spark.range(2000), "id", weights).collect()}
    two = {r.id: r.split for r in split.with_split(spark.range(2000).repartition(7), "id", weights).collect()}
    assert one == two and set(one.values()) == set(weights) and len(one) == 2000
    assert abs(sum(v == "a" for v in one.values()) - 1400) < 80


def test_split_of_a_null_key(spark):
    assert split.with_split(spark.createDataFrame([(None,)], "k long"), "k", {"a": 1.0}).first().split is None


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_ridge_equals_the_closed_form(spark, scale):
    random.seed(3)
    points = [(x * scale, 3 * x + random.random()) for x in (random.random() for _ in range(200))]
    fitted = model.fit_ridge(spark.createDataFrame(points, "x double, y double"), ["x"], "y", alpha=0.9)
    mx, my = (sum(p[i] for p in points) / len(points) for i in (0, 1))
    want = sum((x - mx) * (y - my) for x, y in points) / (sum((x - mx) ** 2 for x, _ in points) + 0.9)
    assert fitted.stages[-1].coefficients[0] == pytest.approx(want, rel=1e-9)


def test_tree_stays_in_the_range_of_its_labels(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(50)], "x double, y double")
    got = model.fit_tree(df, ["x"], "y", 2, 64).transform(df.union(spark.createDataFrame([(1e6, 0.0)], "x double, y double"))).agg(F.max("prediction")).first()[0]
    assert got <= 49**2


def test_metrics_of_a_perfect_prediction(spark):
    got = model.metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 3.0)], "y double, p double"), "y", "p").first()
    assert (got.n, got.mse, got.r2) == (2, 0.0, 1.0)


def test_profile_distinct_counts_stay_within_their_error(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("few"), F.lit(1).alias("one"), F.when(F.col("id") < 19_000, 0).otherwise(F.col("id")).alias("skewed"))
    got = {r.column: r.distinct_about for r in profile.profile(df, error=0.05).collect()}
    for column, want in {"id": 20_000, "few": 7, "one": 1, "skewed": 1001}.items():
        assert abs(got[column] - want) <= 0.15 * want


def test_cube_tells_nulls_from_the_total(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert sorted((r.c or "", r.n, r.total) for r in profile.cube_frequencies(df, "c").collect()) == [("", 1, 0), ("", 2, 1), ("a", 1, 0)]


def test_histogram_keeps_what_is_out_of_range(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (None,)], "v double")
    assert {r.bucket: r.n for r in profile.histogram(df, F.col("v"), 0.0, 10.0, 2).collect()} == {0: 1, 1: 1, 2: 1, 3: 1}


def test_key_uniqueness_with_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert tuple(profile.key_uniqueness(df, "k").first()) == (4, 2, False)


@pytest.mark.parametrize("width", ["minute", "day", "year"])
def test_previous_does_not_depend_on_the_width(spark, width):
    rows = [(i, 1 if i % 3 else 2, f"2024-01-{1 + i % 28:02d} 00:{i % 60:02d}:00", "abc"[i % 3] if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k int, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    last, want = {}, {}
    for i, k, ts, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        want[i] = last.get(k)
        last[k] = v
    got = {r.id: r.previous for r in runs.previous(df, "k", "v", "ts", "id", width).collect()}
    assert got == want


def test_a_busy_name_needs_no_window(spark):
    rows = [(0, i % 50, "up" if i % 4 else "down", i) for i in range(3000)] + [(1, 7, "down", 1)]
    df = spark.createDataFrame(rows, "name int, version int, stage string, at int")
    got = runs.exclusive_stages(df, "name", "version", "stage", "up", "gone", "at")
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    found = {(r.name, r.version): r.stage for r in got.collect()}
    newest = max(a for n, v, s, a in rows if s == "up" and n == 0)
    last = {}
    for n, v, s, a in rows:
        last[n, v] = (s, a)
    assert found == {k: "gone" if s == "up" and a < newest else s for k, (s, a) in last.items()}


def test_wide_runs_take_one_shuffle(spark, sf):
    plan = QUERIES["runs_wide"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["clean_summary", "null_counts", "freq_cube", "hash_split_2", "stage_exclusive", "delete_allowed", "range_filter"])
def test_plans_hold_no_cross_join_and_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and "SinglePartition" not in plan.replace("SinglePartition, ENSURE_REQUIREMENTS", "") and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark, sf):
    plan = QUERIES["positive_filter"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,0.0)" in plan and "c_name" not in plan


def test_csv_keeps_quotes_commas_and_line_breaks(spark):
    rows = [(1, 'a "b", c'), (2, "two\nlines, and \"quotes\""), (3, ""), (4, " edge "), (5, None)]
    path = storage.new_folder(spark, "csv")
    storage.write_csv(spark.createDataFrame(rows, "id int, t string"), path)
    assert sorted(map(tuple, csv_scan.read_csv_blocks(spark, path, "id int, t string").collect())) == rows


def test_a_version_is_never_written_twice(spark):
    base = storage.new_folder(spark, "v")
    assert versions.write_version(spark.range(3), base) == 0
    assert versions.write_version(spark.range(4), base) == 1
    assert versions.read_version(spark, base, 0).count() == 3


def test_schema_checks_fail_under_the_same_name(spark):
    assert checks.schema_checks(spark.range(1), "t", {"id": "bigint", "x": "int"}) == [("t.id", True), ("t.x", False)]


def test_answers_do_not_depend_on_order(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert checks.answer(df, "c").first() == checks.answer(df.orderBy(F.desc("c")), "c").first()


def test_table_checks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, s string")
    assert all(r.passed for r in checks.table_checks(empty, "t", "k", {"s": ["a"]}).collect())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_quantiles_of_large_values_dates_and_nan(spark):
    import datetime

    big = 1 << 60
    rows = [(big + i, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), datetime.datetime(2020, 1, 1, 0, 0, i), float("nan") if i > 50 else float(i), float("inf")) for i in range(60)]
    df = spark.createDataFrame(rows, "b long, d date, t timestamp_ntz, x double, y double").repartition(3)
    got = exact_quantiles(df, ["b", "d", "t", "x", "y"], [0.25, 0.5, 1.0], 8)
    assert got["b"] == [big + 14, big + 29, big + 59] and got["d"][1] == rows[29][1] and got["t"][0] == rows[14][2]
    assert got["x"][:2] == [14.0, 29.0] and math.isnan(got["x"][2]) and got["y"] == [float("inf")] * 3


def test_quantiles_scan_the_source_three_times(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    draw = random.Random(4)
    rows = [(draw.gauss(0, 1), draw.randrange(1 << 40), draw.randrange(3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b long, c int")
    counted = df.mapInArrow(count, df.schema)
    got = exact_quantiles(counted, ["a", "b", "c"], [0.1, 0.5, 0.9], 256)
    assert got == {c: [lower_quantile([r[i] for r in rows], p) for p in (0.1, 0.5, 0.9)] for i, c in enumerate("abc")}
    assert seen.value <= 3 * len(rows)


def test_merged_sketches_say_what_sketches_of_the_whole_say(spark):
    draw = random.Random(6)
    rows = [(draw.gauss(5, 2), draw.choice("aaabbc"), draw.randrange(10_000), None if i % 7 else i) for i in range(9000)]
    df = spark.createDataFrame(rows, "x double, s string, k int, mostly int").repartition(4)
    exact = ("column", "n", "nulls", "empties", "low", "high", "distinct_about")
    whole = profile.profile_of(profile.sketches(df, k=400))
    halves = profile.merged(profile.sketches(df.where("k % 2 = 0"), k=400).unionByName(profile.sketches(df.where("k % 2 = 1"), k=400)))
    parts = {r["column"]: r for r in profile.profile_of(halves).collect()}
    for r in whole.collect():
        assert [r[c] for c in exact] == [parts[r["column"]][c] for c in exact]
        assert r["mean"] == pytest.approx(parts[r["column"]]["mean"], abs=1e-3) if r["mean"] is not None else parts[r["column"]]["mean"] is None
    assert [(t.value, t["count"]) for t in parts["s"].top] == [(v, sum(r[1] == v for r in rows)) for v in "abc"]
    xs = sorted(r[0] for r in rows)
    for share, value in zip((0.25, 0.5, 0.75), parts["x"].quantiles):
        assert abs(sum(x <= value for x in xs) / len(xs) - share) < 0.03
    width = (xs[-1] - xs[0]) / 10
    assert all(abs(b - sum(x <= xs[0] + width * (i + 1) for x in xs)) < 0.03 * len(xs) for i, b in enumerate(parts["x"].buckets))


def test_states_of_nothing(spark, tmp_path):
    profile.append_state(spark.createDataFrame([], "x double, s string"), str(tmp_path), "a")
    profile.append_state(spark.createDataFrame([(1.0, "v")], "x double, s string"), str(tmp_path), "b")
    got = {r["column"]: r for r in profile.profile_of(profile.merged(profile.states(spark, str(tmp_path)))).collect()}
    assert (got["x"].n, got["x"]["mean"], got["x"].quantiles) == (1, 1.0, [1.0, 1.0, 1.0])


def test_one_hot_of_many_labels_holds_none_on_the_driver(spark):
    df = spark.range(200_000).select((F.col("id") % 100_000).cast("string").alias("k"), F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("s"))
    rows = features.one_hot(df, ["k", "s"])
    assert "Indexer" not in rows._jdf.queryExecution().toString()
    got = rows.agg(F.count("*"), F.max(F.array_max("slots")), F.sum(F.size("slots"))).first()
    assert got == (200_000, 99_999, 200_000 - 2 + 133_333)


def test_ordered_bins_hold_the_best_split_of_a_category(spark):
    import itertools

    draw = random.Random(9)
    rows = [(f"k{i % 8}", float((i % 8) * 7 % 5) + draw.random()) for i in range(200)]
    bins = {r["label"]: r["bin"] for r in features.ordered_bins(spark.createDataFrame(rows, "k string, y double"), "k", "y", 8).collect()}
    labels = sorted(bins)

    def error(side):
        parts = [[y for k, y in rows if (k in side) == inside] for inside in (True, False)]
        return sum(sum((y - sum(p) / len(p)) ** 2 for y in p) for p in parts if p)

    best = min(error(set(side)) for n in range(1, 8) for side in itertools.combinations(labels, n))
    assert min(error({k for k in labels if bins[k] <= cut}) for cut in range(7)) == pytest.approx(best)
