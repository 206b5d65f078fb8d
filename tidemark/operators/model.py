"""Random-forest price model: features, split, fit, metrics, baseline, errors, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.parse import pow10
from tidemark.operators import forest as trees_of
from tidemark.operators.forest import Forest
from tidemark.operators.regress import encode

# Fixed values of the model.
SEED = 42
TRAIN_PERCENT = 80
TREES = 200
TOP_IMPORTANCES = 10
TOP_ERRORS = 5


def feature_matrix(
    df: DataFrame, numeric: list[str], categorical: list[str], keep: list[str] = (), leakage: Sequence[str] = (),
) -> tuple[DataFrame, list[str], list[str]]:
    """Numeric columns and a 0/1 column per category level. Missing and all-null columns are
    left out and reported; a column derived from the target is an error."""
    leaked = sorted(set(leakage) & {*numeric, *categorical})
    if leaked:
        raise ValueError(f"derived from the target: {leaked}")
    return encode(df, [*numeric, *categorical], False, keep)


def split(df: DataFrame, key: str, seed: int = SEED, train_percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a digest of key and seed, the same under any partitioning; a null key is a key."""
    text = F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
    return df.where(draw < train_percent), df.where(draw >= train_percent)


def rf_regress(
    train: DataFrame, features: list[str], target: str, trees: int = TREES, max_depth: int | None = None, seed: int = SEED,
    min_rows: int = 1, bootstrap: bool = True,
) -> Forest:
    """Bootstrapped forest over all features per split, whose trees grow until their leaves are pure or can't be split."""
    return trees_of.grow(train, features, target, trees, max_depth, seed, min_rows, bootstrap)


def predict(forest: Forest, df: DataFrame, raw: str = "raw_prediction") -> DataFrame:
    """The rows with the forest's mean prediction."""
    return trees_of.predicted(forest, df, raw)


def predict_back(df: DataFrame, log_target: bool, raw: str = "raw_prediction", name: str = "predicted") -> DataFrame:
    """Predictions on the price scale."""
    return df.withColumn(name, pow10(F.col(raw)) if log_target else F.col(raw))


def regression_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """One row: n, mean absolute error, root mean squared error and R²."""
    e = actual - predicted
    out = df.agg(
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e * e).alias("_mse"), F.var_pop(F.when(e.isNotNull(), actual)).alias("_var"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.try_divide(F.col("_mse"), F.col("_var")))
    return out.select("n", "mae", "rmse", r2.alias("r2"))


def mean_baseline(train: DataFrame, test: DataFrame, price: str) -> DataFrame:
    """Metrics of predicting the mean training price everywhere."""
    mean = train.agg(F.avg(price)).scalar()
    return regression_metrics(test.withColumn("_mean", mean), F.col(price), F.col("_mean"))


def improvement(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: by how many percent the model's errors undercut the baseline's."""
    base = baseline.select(F.struct(F.col("mae").alias("mae"), F.col("rmse").alias("rmse"))).scalar()
    out = model.withColumn("_b", base)
    gain = lambda c: (F.try_divide(F.col(f"_b.{c}") - F.col(c), F.col(f"_b.{c}")) * 100).alias(f"{c}_improvement_pct")
    return out.select("n", "mae", "rmse", F.col("_b.mae").alias("baseline_mae"), F.col("_b.rmse").alias("baseline_rmse"), gain("mae"), gain("rmse"))


def largest_errors(df: DataFrame, key: str, actual: str, predicted: str, k: int = TOP_ERRORS) -> DataFrame:
    """The k rows with the largest absolute error."""
    errors = df.select(key, actual, predicted, F.abs(F.col(actual) - F.col(predicted)).alias("abs_error"))
    return errors.orderBy(F.desc_nulls_last("abs_error"), key).limit(k)


def importance_rank(forest: Forest, k: int = TOP_IMPORTANCES) -> DataFrame:
    """Impurity importances in descending order."""
    best = trees_of.importances(forest).orderBy(F.desc("importance"), "feature").limit(k)
    return best.agg(F.collect_list(F.struct((-F.col("importance")).alias("minus"), "feature", "importance")).alias("all")).select(
        F.posexplode(F.array_sort("all")).alias("at", "r")
    ).select((F.col("at") + 1).cast("long").alias("rank"), "r.feature", "r.importance")
