"""Fits from moments and with absorbed categories against least squares on full matrices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabular_spark import linear


def made(n, seed=1, labels=5):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c, d = draw.gauss(100, 3), draw.gauss(0, 1), f"c{draw.randrange(labels)}", f"d{draw.randrange(4)}"
        out.append((2 * a - 3 * b + int(c[1:]) + 5 * int(d[1:]) + draw.gauss(0, 1), a, b, c, d))
    return out


COLUMNS = "y double, a double, b double, c string, d string"


def full_fit(rows, categories):
    """Predictions of least squares with a column for each label."""
    x = [[r[1] for r in rows], [r[2] for r in rows]]
    for i in categories:
        x += [[float(r[i] == v) for r in rows] for v in sorted({r[i] for r in rows})]
    x, y = np.array([[1.0] * len(rows), *x]).T, np.array([r[0] for r in rows])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    return x @ beta, beta, y


def test_moments_give_every_subset_penalty_and_error(spark):
    rows = made(400)
    m = linear.moments(spark.createDataFrame(rows, COLUMNS).repartition(3), ["y", "a", "b"])
    y, x = np.array([r[0] for r in rows]), np.array([[r[1], r[2]] for r in rows])
    for features, at in ((["a"], [0]), (["b"], [1]), (["a", "b"], [0, 1]), ([], [])):
        intercept, slopes = linear.solved(m, "y", features)
        want = np.linalg.lstsq(np.c_[np.ones(len(y)), x[:, at]], y, rcond=None)[0]
        assert [intercept, *slopes.values()] == pytest.approx(want, rel=1e-7)
        left = y - np.c_[np.ones(len(y)), x[:, at]] @ want
        n, mse, r2 = linear.errors(m, "y", intercept, slopes)
        assert (n, mse, r2) == (400, pytest.approx((left**2).mean()), pytest.approx(1 - (left**2).mean() / y.var()))
    centered = x - x.mean(0)
    _, slopes = linear.solved(m, "y", ["a", "b"], alpha=50.0)
    assert list(slopes.values()) == pytest.approx(np.linalg.solve(centered.T @ centered + 50 * np.eye(2), centered.T @ (y - y.mean())))


def test_moments_merge(spark):
    df = spark.createDataFrame(made(300), COLUMNS).withColumn("part", F.when(F.col("a") > 101, "x").otherwise("y"))
    parts, whole = linear.moments_by(df, ["y", "a", "b"], "part"), linear.moments(df, ["y", "a", "b"])
    both = parts["x"].merged(parts["y"])
    assert both.n == whole.n and both.mean == pytest.approx(whole.mean) and both.cov.ravel() == pytest.approx(whole.cov.ravel())


@pytest.mark.parametrize("text,categories", [("y ~ a + b", []), ("y ~ a + b + c", [3]), ("y ~ .", [3, 4])])
def test_formula_fits_equal_fits_with_a_column_for_each_label(spark, text, categories):
    rows = made(250)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    found = linear.fit(df, text)
    predicted, beta, y = full_fit(rows, categories)
    assert list(found.slopes.values()) == pytest.approx(beta[1:3], abs=1e-7)
    assert found.mse == pytest.approx(((y - predicted) ** 2).mean()) and found.r2 == pytest.approx(1 - ((y - predicted) ** 2).mean() / y.var())
    got = {r.y: r.prediction for r in found.transform(df).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(predicted, abs=1e-6)


def test_more_labels_than_a_solver_has_slots(spark):
    df = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 5000).alias("k"), (F.col("id") / 100).alias("x"), (3 * F.col("id") / 100 + F.col("id") % 5000).alias("y"))
    found = linear.fit(df, "y ~ .")
    assert found.slopes["x"] == pytest.approx(3) and found.mse == pytest.approx(0, abs=1e-9)
    assert found.effects[0][1].count() == 5000
    plan = found.transform(df)._jdf.queryExecution().toString()
    assert "Indexer" not in plan and "UDF" not in plan


def test_formula_grammar(spark):
    df = spark.createDataFrame(made(3), COLUMNS)
    assert list(linear.formula("y ~ . - a", df).numeric) == ["b"] and linear.formula("y ~ .", df).categories == [("c",), ("d",)]
    assert list(linear.formula("y ~ a + a:b", df).numeric) == ["a", "a:b"] and linear.formula("y ~ c:d", df).categories == [("c", "d")]
    with pytest.raises(ValueError):
        linear.formula("y ~ a:c", df)
    with pytest.raises(ValueError):
        linear.formula("y ~ gone", df)


def test_nulls_and_unseen_labels_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 1.0, "u"), (2.0, 2.0, "u"), (5.0, 1.0, "v"), (6.0, 2.0, "v"), (None, 1.0, "u"), (9.0, None, "u"), (9.0, 1.0, None)], "y double, x double, k string")
    found = linear.fit(df, "y ~ x + k")
    assert found.n == 4 and found.slopes["x"] == pytest.approx(1)
    new = spark.createDataFrame([(3.0, "u"), (3.0, "w"), (None, "u"), (0.0, "v")], "x double, k string")
    assert sorted(r.prediction for r in found.transform(new).collect()) == pytest.approx([3.0, 4.0])


def test_pairs_of_labels(spark):
    rows = [(float(10 * i + j), 1.0 * k, f"a{i}", f"b{j}") for i in range(3) for j in range(3) for k in range(2)]
    found = linear.fit(spark.createDataFrame(rows, "y double, x double, i string, j string"), "y ~ x + i:j")
    assert found.slopes["x"] == pytest.approx(0, abs=1e-9) and found.mse == pytest.approx(0, abs=1e-9) and found.effects[0][1].count() == 9
