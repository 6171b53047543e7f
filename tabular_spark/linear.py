"""Least squares from moments: one scan for all fits, and categories of any width without columns for their labels.

Counts, means and covariances of the label and the numeric features, per group, hold all that any
least-squares fit on them needs: every subset of features, every ridge penalty, and the errors of
a fit on any of the groups. They merge, so parts of a table need to be read once only.

A category is absorbed (Frisch, Waugh, Lovell): the fit with a column for each label has the same
slopes as the fit of what is left when label means are taken off all columns. With one category the
covariances within its labels do; with several, means are taken off in turn until nothing moves. The
labels' own effects are tables, joined where rows are scored; the driver holds slopes only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.storage import stored

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


@dataclass
class Moments:
    """Rows, means and covariances (per row) of ``names``."""

    names: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def merged(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(self.names, n, self.mean + gap * other.n / n, (self.n * self.cov + other.n * other.cov) / n + np.outer(gap, gap) * self.n * other.n / n**2)

    def at(self, names: list[str]) -> list[int]:
        return [self.names.index(x) for x in names]


def moment_aggregates(names: list[str]) -> list[Column]:
    column = [F.col(f"`{x}`").cast("double") for x in names]
    pairs = [F.covar_pop(column[i], column[j]).alias(f"c{i}_{j}") for i in range(len(names)) for j in range(i, len(names))]
    return [F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(column)], *pairs]


def moments_of(row, names: list[str]) -> Moments:
    k = len(names)
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float) if row["n"] else np.zeros((k, k))
    return Moments(names, row["n"], np.array([row[f"m{i}"] or 0.0 for i in range(k)], float), cov)


def complete(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows without nulls in the columns that a fit uses."""
    return df.na.drop(how="any", subset=names)


def moments(df: DataFrame, names: list[str]) -> Moments:
    return moments_of(complete(df, names).agg(*moment_aggregates(names)).first(), names)


def moments_by(df: DataFrame, names: list[str], group: str) -> dict[str, Moments]:
    """Moments of each of the few values of ``group`` (the sets of a split), from one scan."""
    return {r[group]: moments_of(r, names) for r in complete(df, names).groupBy(group).agg(*moment_aggregates(names)).collect()}


def solved(m: Moments, label: str, features: list[str], alpha: float = 0.0) -> tuple[float, dict[str, float]]:
    """(intercept, slopes) of least squares with the penalty ``alpha`` times the squared slopes. Of features that say the same, each gets a share."""
    x, y = m.at(features), m.at([label])[0]
    square, cross = m.n * m.cov[np.ix_(x, x)], m.n * m.cov[x, y]
    scale = np.sqrt(np.where(np.diag(square) > 0, np.diag(square), 1.0))
    system = square / np.outer(scale, scale) + np.diag(alpha / scale**2)
    slopes = np.linalg.lstsq(system, cross / scale, rcond=1e-12)[0] / scale if x else np.zeros(0)
    return float(m.mean[y] - slopes @ m.mean[x]), dict(zip(features, map(float, slopes)))


def errors(m: Moments, label: str, intercept: float, slopes: dict[str, float]) -> tuple[int, float, float]:
    """(n, mse, r2) of a fit on the rows that ``m`` stands for, without reading them."""
    x, y, b = m.at(list(slopes)), m.at([label])[0], np.array(list(slopes.values()))
    bias = m.mean[y] - intercept - b @ m.mean[x]
    mse = float(m.cov[y, y] - 2 * b @ m.cov[x, y] + b @ m.cov[np.ix_(x, x)] @ b + bias**2)
    return m.n, mse, 1 - mse / float(m.cov[y, y]) if m.cov[y, y] else float("nan")


@dataclass
class Formula:
    """``label ~ terms``: numeric expressions by name, and categories, each of one or more columns."""

    label: str
    numeric: dict[str, Column]
    categories: list[tuple[str, ...]]


def formula(text: str, df: DataFrame) -> Formula:
    """R-style: ``.`` for all other columns, ``+`` and ``-`` to add and take away, ``a:b`` for products of numbers or for pairs of labels."""
    label, _, right = (x.strip() for x in text.partition("~"))
    kinds = {c: t for c, t in df.dtypes}
    terms: dict[tuple[str, ...], None] = {}
    for sign, term in re.findall(r"([+-]?)\s*([^+\-]+)", right):
        names = [(c,) for c in df.columns if c != label] if term.strip() == "." else [tuple(x.strip() for x in term.split(":"))]
        for name in names:
            if unknown := [c for c in name if c not in kinds]:
                raise ValueError(f"no column {unknown[0]}")
            if sign == "-":
                terms.pop(name, None)
            else:
                terms[name] = None
    out = Formula(label, {}, [])
    for name in terms:
        numbers = [kinds[c] in NUMBERS or kinds[c].startswith("decimal") or kinds[c] == "boolean" for c in name]
        if all(numbers):
            value = F.lit(1.0)
            for c in name:
                value = value * F.col(f"`{c}`").cast("double")
            out.numeric[":".join(name)] = value
        elif not any(numbers):
            out.categories.append(name)
        else:
            raise ValueError(f"{':'.join(name)}: a number by a category is not supported")
    return out


@dataclass
class Fit:
    """A fitted formula. ``effects`` are (columns, table of their values and the effect); rows of values not seen there are not scored."""

    formula: Formula
    intercept: float
    slopes: dict[str, float]
    effects: list[tuple[tuple[str, ...], DataFrame]]
    n: int
    mse: float
    r2: float

    @property
    def rmse(self) -> float:
        return self.mse**0.5

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df`` with predictions. Rows with a null in a term, or with a label that the fit hasn't seen, go."""
        rows, total = df, F.lit(self.intercept)
        for name, slope in self.slopes.items():
            total = total + F.lit(slope) * self.formula.numeric[name]
        for i, (columns, table) in enumerate(self.effects):
            keys = table.select(*[F.col(c).alias(f"_k{i}_{j}") for j, c in enumerate(table.columns[:-1])], F.col("effect").alias(f"_e{i}"))
            same = [F.col(f"`{c}`") == F.col(f"_k{i}_{j}") for j, c in enumerate(columns)]
            rows = rows.join(keys, on=same[0] if len(same) == 1 else same[0] & same[1] if len(same) == 2 else F.expr(" AND ".join(f"`{c}` = _k{i}_{j}" for j, c in enumerate(columns))))
            total = total + F.col(f"_e{i}")
        scored = rows.withColumn(prediction, total).where(F.col(prediction).isNotNull())
        return scored.select(*df.columns, prediction)


def fit(df: DataFrame, text: str, alpha: float = 0.0, tolerance: float = 1e-11, most_sweeps: int = 500) -> Fit:
    """Least squares of a formula; ``alpha`` penalises the squared slopes of numbers, never the categories.

    ``tolerance`` bounds the largest label mean that is left, in deviations of its column, where several
    categories are absorbed in turn; past ``most_sweeps`` an error is raised.
    """
    f = formula(text, df)
    names = ["_y", *[f"_x{i}" for i in range(len(f.numeric))]]
    slim = df.select(F.col(f"`{f.label}`").cast("double").alias("_y"), *[v.alias(n) for v, n in zip(f.numeric.values(), names[1:])], *[F.struct(*[F.col(f"`{c}`") for c in cs]).alias(f"_k{i}") for i, cs in enumerate(f.categories)])
    slim = slim.na.drop(subset=names)
    for i, cs in enumerate(f.categories):
        for c in cs:
            slim = slim.where(F.col(f"_k{i}")[c].isNotNull())
    if not f.categories:
        whole = moments(slim, names)
        intercept, slopes = solved(whole, "_y", names[1:], alpha)
        n, mse, r2 = errors(whole, "_y", intercept, slopes)
        return Fit(f, intercept, dict(zip(f.numeric, slopes.values())), [], n, mse, r2)
    within, tables, whole = _one_category(slim, names) if len(f.categories) == 1 else _several(slim, names, len(f.categories), tolerance, most_sweeps)
    _, slopes = solved(within, "_y", names[1:], alpha)
    n, mse, _ = errors(Moments(names, within.n, np.zeros(len(names)), within.cov), "_y", 0.0, slopes)
    effect = F.col("_y")
    for name, slope in slopes.items():
        effect = effect - F.lit(slope) * F.col(name)
    effects = [(cs, t.select("key.*", effect.alias("effect"))) for cs, t in zip(f.categories, tables)]
    spread = float(whole.cov[0, 0])
    return Fit(f, 0.0, dict(zip(f.numeric, slopes.values())), effects, n, mse, 1 - mse / spread if spread else float("nan"))


def _one_category(slim: DataFrame, names: list[str]) -> tuple[Moments, list[DataFrame], Moments]:
    """Moments within labels, the table of label means, and all moments: from one scan and one row a label."""
    k = len(names)
    labels = stored(slim.groupBy(F.col("_k0").alias("key")).agg(*moment_aggregates(names)), "label-moments")
    inside = [F.sum(F.col("n") * F.col(f"c{i}_{j}")).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    # one row: sums over labels, and the spread of label means
    row = labels.agg(F.sum("n").alias("n"), *inside, F.sum(F.col("n") * F.col("m0")).alias("sum"), F.sum(F.col("n") * F.col("m0") * F.col("m0")).alias("squares")).first()
    n = row["n"] or 0
    cov = np.array([[(row[f"c{min(i, j)}_{max(i, j)}"] or 0.0) / max(1, n) for j in range(k)] for i in range(k)])
    mean = (row["sum"] or 0.0) / max(1, n)
    between = labels.agg(F.sum(F.col("n") * F.pow(F.col("m0") - F.lit(mean), 2))).first()[0] or 0.0
    total = Moments(names, n, np.full(k, mean), np.full((k, k), cov[0, 0] + between / max(1, n)))
    return Moments(names, n, np.zeros(k), cov), [labels.select("key", *[F.col(f"m{i}").alias(c) for i, c in enumerate(names)])], total


def _several(slim: DataFrame, names: list[str], number: int, tolerance: float, most_sweeps: int) -> tuple[Moments, list[DataFrame], Moments]:
    """As ``_one_category``, by taking off the label means of each category in turn; rows and tables of means are written after each sweep."""
    rows = stored(slim, "absorb")
    whole = moments(rows, names)
    scale = np.sqrt(np.where(np.diag(whole.cov) > 0, np.diag(whole.cov), 1.0))
    taken: list[DataFrame | None] = [None] * number
    for _ in range(most_sweeps):
        largest = 0.0
        for i in range(number):
            means = stored(rows.groupBy(F.col(f"_k{i}").alias("key")).agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(names)]), "absorb-means")
            top = means.agg(*[F.max(F.abs(f"m{j}")).alias(f"m{j}") for j in range(len(names))]).first()
            largest = max([largest, *[(top[f"m{j}"] or 0.0) / scale[j] for j in range(len(names))]])
            kept = [c for c in rows.columns if c not in names]
            rows = rows.join(means, rows[f"_k{i}"] == means["key"]).select(*kept, *[(F.col(c) - F.col(f"m{j}")).alias(c) for j, c in enumerate(names)])
            now = means.select("key", *[F.col(f"m{j}").alias(c) for j, c in enumerate(names)])
            if taken[i] is not None:
                both = taken[i].unionByName(now)
                now = both.groupBy("key").agg(*[F.sum(c).alias(c) for c in names])
            taken[i] = stored(now, "absorb-taken")
        rows = stored(rows, "absorb")
        if largest < tolerance:
            left = moments(rows, names)
            return Moments(names, left.n, np.zeros(len(names)), left.cov), taken, whole
    raise ValueError(f"label means still move by {largest} deviations after {most_sweeps} sweeps")
