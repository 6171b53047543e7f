"""Linear and tree regression with MLlib, and what can be read off fitted models as tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabular_spark.features import assembler


def least_squares(label: str, features: str = "features", prediction: str = "prediction", solver: str = "normal", **options) -> LinearRegression:
    """The solver is always stated; ``normal`` refuses more features than it can take, it is never swapped silently."""
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=prediction, solver=solver, **options)


def fit_columns(df: DataFrame, columns: list[str], label: str, prediction: str = "prediction", **options) -> PipelineModel:
    return Pipeline(stages=[assembler(columns), least_squares(label, prediction=prediction, **options)]).fit(df)


def fit_ridge(df: DataFrame, columns: list[str], label: str, alpha: float) -> PipelineModel:
    """Least squares with the penalty ``alpha`` times the squared coefficients, on the raw scale of the features.

    MLlib divides the loss by the number of rows and by the label's deviation; the penalty is given to match.
    """
    n, deviation = df.where(F.col(label).isNotNull()).agg(F.count("*"), F.stddev_pop(label)).first()
    return fit_columns(df, columns, label, elasticNetParam=0.0, standardization=False, regParam=alpha * deviation / n)


def fit_tree(df: DataFrame, columns: list[str], label: str, depth: int, bins: int, seed: int = 42) -> PipelineModel:
    """A regression tree. MLlib takes candidate thresholds from a sample once there are more rows than max(bins^2, 10,000); they are midpoints of all distinct values where these are few and frequent."""
    tree = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=depth, maxBins=bins, seed=seed)
    return Pipeline(stages=[assembler(columns), tree]).fit(df)


def prediction_column(model: PipelineModel) -> str:
    """The name of the column that the last stage writes."""
    return model.stages[-1].getPredictionCol()


def coefficients(model: PipelineModel, names: list[str], digits: int = 6):
    """(term, value) pairs of the last stage, the intercept first."""
    last = model.stages[-1]
    return [("intercept", round(float(last.intercept), digits)), *[(n, round(float(v), digits)) for n, v in zip(names, last.coefficients)]]


def importances(model: PipelineModel, scored: DataFrame, features: str = "features") -> DataFrame:
    """(feature, importance); names come from the vector's metadata, so that one-hot slots have their own."""
    attributes = scored.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    values = model.stages[-1].featureImportances.toArray()
    rows = [(names[i], float(v)) for i, v in enumerate(values)]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def top(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), tie).limit(k)


def bins_needed(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """(column, groups, fits): whether a tree with ``bins`` bins can take each category column."""
    parts = [df.select(c).distinct().agg(F.lit(c).alias("column"), F.count("*").alias("groups")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("fits", F.col("groups") <= bins)


def squared_error(label: str, prediction: str):
    return F.pow(F.col(label) - F.col(prediction), 2)


def metrics(df: DataFrame, label: str, prediction: str, *groups: str, digits: int = 4, r2_digits: int = 6) -> DataFrame:
    """(groups..., n, mse, rmse, r2) in one aggregate. The total sum of squares is taken around the mean of the group, by its variance."""
    both = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    mse, spread = F.avg(squared_error(label, prediction)), F.var_pop(label)
    return both.groupBy(*groups).agg(F.count("*").alias("n"), F.round(mse, digits).alias("mse"), F.round(F.sqrt(mse), digits).alias("rmse"), F.round(1 - mse / spread, r2_digits).alias("r2"))
