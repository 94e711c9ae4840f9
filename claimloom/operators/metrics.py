"""Model quality as grouped aggregates, and the best of many tracked runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARENT_TAG = "mlflow.parentRunId"


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """mae, mse, rmse and r2 per group, over the rows that have both a label and a prediction.

    Sums keep the type of the columns, so decimal input gives the same result in any row order.
    """
    error = F.col(label) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.count(error).alias("n"),
        F.sum(F.abs(error)).cast("double").alias("_absolute"),
        F.sum(error * error).cast("double").alias("_squares"),
        F.var_pop(F.when(error.isNotNull(), F.col(label))).alias("_variance"),
    )
    mse = F.col("_squares") / F.col("n")
    r2 = F.when(F.col("_variance") > 0, 1 - mse / F.col("_variance"))
    mae = F.col("_absolute") / F.col("n")
    return sums.select(*by, "n", mae.alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), r2.alias("r2"))


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of right answers among the labelled rows; a missing answer is a wrong one."""
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    return df.groupBy(*by).agg(F.avg(F.when(F.col(label).isNotNull(), right.cast("int"))).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per true class, one column ``predicted_<class>`` per class.

    ``predicted_other`` counts missing answers and answers outside ``classes``.
    """
    counts = confusion_counts(df, label, prediction)
    columns = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{c}")
        for c in classes
    ]
    listed = F.coalesce(F.col("prediction").isin(list(classes)), F.lit(False))
    other = F.coalesce(F.sum(F.when(~listed, F.col("n"))), F.lit(0)).alias("predicted_other")
    return counts.groupBy("label").agg(*columns, other)


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, from the confusion counts.

    A missing answer counts for the support of its class and for no class's predictions; rows without
    a label are left out.
    """
    counts = confusion_counts(df.filter(F.col(label).isNotNull()), label, prediction)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).alias("predicted")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).alias("actual"), F.col("n").alias("predicted")),
            )
        ).alias("side"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    # a correct pair occurs on both sides, so its hits are halved
    sums = sides.filter(F.col("side.class").isNotNull()).groupBy("side.class").agg(
        F.sum("side.actual").alias("support"), F.sum("side.predicted").alias("_predicted"), F.sum("hit").alias("_hits")
    )
    hits = F.col("_hits") / 2
    zero = F.lit(0.0)
    precision = F.when(F.col("_predicted") > 0, hits / F.col("_predicted")).otherwise(zero)
    recall = F.when(F.col("support") > 0, hits / F.col("support")).otherwise(zero)
    f1 = 2 * hits / (F.col("_predicted") + F.col("support"))
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def last_metric(runs: DataFrame, metric: str) -> DataFrame:
    """Value of a metric per run at its last step."""
    values = runs.filter((F.col("kind") == "metrics") & (F.col("name") == metric))
    newest = F.max(F.struct("step", "ts", F.col("value").try_cast("double").alias("value")))
    return values.groupBy("experiment", "run").agg(newest.alias("_last")).select("experiment", "run", "_last.value")


def best_run(runs: DataFrame, metric: str, best: str = "min", parent_tag: str = PARENT_TAG) -> DataFrame:
    """Best child of every parent run; equal values go to the smallest run id."""
    parents = runs.filter((F.col("kind") == "tags") & (F.col("name") == parent_tag)).select(
        "experiment", "run", F.col("value").alias("parent")
    )
    scored = parents.join(last_metric(runs, metric), ["experiment", "run"])
    sign = F.col("value") if best == "min" else -F.col("value")
    top = scored.groupBy("experiment", "parent").agg(F.min(F.struct(sign.alias("key"), "run", "value")).alias("_top"))
    return top.select("experiment", "parent", F.col("_top.run").alias("run"), F.col("_top.value").alias(metric))


def pivot_runs(runs: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run with the named params and metrics as columns."""
    return runs.groupBy("experiment", "run").pivot("name", list(names)).agg(F.max("value"))
