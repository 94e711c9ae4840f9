"""Triage and demand models as Spark ML pipelines.

One pipeline holds clean-up, vocabulary, label names and trees, so that scoring can never use
another encoder than training did.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import DAY_COUNTS, confidence
from claimloom.operators.features import MISSING, row_hash
from claimloom.session import stored

# Settings of the multi-class training, and the defaults that the two-class one runs with.
BOOSTING = {"maxDepth": 3, "maxIter": 10, "stepSize": 0.3, "seed": 42}
BINARY = {"maxDepth": 6, "maxIter": 100, "stepSize": 0.3, "seed": 42}

# The search grid, 540 points.
FULL_GRID = {
    "maxDepth": [2, 3, 5, 7, 8],
    "stepSize": [0.1, 0.01, 0.001],
    "maxIter": [50, 100, 150, 200],
    "subsamplingRate": [0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.8", "0.9", "all"],
}

# The demand forest and its seven features.
FOREST = {"numTrees": 100, "maxDepth": 6, "minInstancesPerNode": 4, "seed": 888}
DEMAND_COLUMNS = [
    "average_temprature", "rainfall", "weekend", "holiday", "price_per_kg", "promo", "previous_days_demand",
]


def clean_statement(columns: Sequence[str]) -> str:
    """SQL of the clean-up stage: missing answers, day counts, special characters."""
    cleaned = []
    for c in columns:
        days = " ".join(f"when '{raw}' then '{text}'" for raw, text in DAY_COUNTS.items())
        answer = f"coalesce(`{c}`, '{MISSING}')"
        cleaned.append(f"regexp_replace(case {answer} {days} else {answer} end, '[^0-9a-zA-Z ]', ' ') as `clean_{c}`")
    return f"select *, {', '.join(cleaned)} from __THIS__"


def feature_stages(columns: Sequence[str], clean: bool = True) -> list:
    """Answers to one sparse feature vector; coded answers are used as they are (``clean=False``)."""
    statement = clean_statement(columns)
    if not clean:
        filled = ", ".join(f"coalesce(`{c}`, '{MISSING}') as `clean_{c}`" for c in columns)
        statement = f"select *, {filled} from __THIS__"
    names = [f"clean_{c}" for c in columns]
    indexed = [f"index_{c}" for c in columns]
    hot = [f"hot_{c}" for c in columns]
    return [
        SQLTransformer(statement=statement),
        StringIndexer(inputCols=names, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=hot, outputCol="features"),
    ]


PARTITIONS = 16


def training_table(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), partitions: int = PARTITIONS) -> DataFrame:
    """The columns a training needs, stored once in the partitions and the row order of their keys.

    Sampling and bagging go by partition and place, so the same rows give the same model on any
    cluster. ``partitions``: set it to a few times the cores of the cluster, and keep it for a model
    that is to be reproduced; ``keys``: a row's identity, all columns by default.
    """
    names = list(dict.fromkeys([*columns, *keys]))
    table = stored(df.select(*[F.col(f"`{c}`") for c in names]), "training")
    order = [F.col(f"`{c}`") for c in [*keys, *(c for c in names if c not in keys)]]
    spread = table.repartition(partitions, F.xxhash64(*order[: len(keys) or None]))
    return spread.sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in columns])


def train(
    df: DataFrame, columns: Sequence[str], label: str, classifier, clean: bool = True, keys: Sequence[str] = (), partitions: int = PARTITIONS
) -> PipelineModel:
    """Fit features, label names and a classifier that reads ``features`` and ``label_id``."""
    df = training_table(df, [*columns, label], keys, partitions)
    names = StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc").fit(df)
    decode = IndexToString(inputCol="prediction", outputCol="recommendedServiceCode", labels=names.labels)
    return Pipeline(stages=[*feature_stages(columns, clean), names, classifier, decode]).fit(df)


def train_multiclass(
    df: DataFrame, columns: Sequence[str], label: str, clean: bool = True, parallelism: int = 8, keys: Sequence[str] = (), **params
) -> PipelineModel:
    """Boosted trees for any number of classes: one ensemble per class, the strongest wins."""
    trees = GBTClassifier(labelCol="label_id", **{**BOOSTING, **params})
    return train(df, columns, label, OneVsRest(classifier=trees, labelCol="label_id", parallelism=parallelism), clean, keys)


def train_binary(
    df: DataFrame, columns: Sequence[str], label: str, clean: bool = True, keys: Sequence[str] = (), **params
) -> PipelineModel:
    return train(df, columns, label, GBTClassifier(labelCol="label_id", **{**BINARY, **params}), clean, keys)


def class_probabilities(model: Model) -> Column:
    """Probabilities of a fitted classifier; the margins of one-vs-rest are scaled to sum to one."""
    if model.hasParam("probabilityCol"):
        return vector_to_array("probability")
    odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    total = F.aggregate(odds, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(odds, lambda p: p / total)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """Class and confidence text of every record."""
    classifier = model.stages[-2]
    scored = model.transform(df).withColumn("_probabilities", class_probabilities(classifier))
    return scored.select(*keep, confidence(F.col("_probabilities")).alias("confidenceScore"), "recommendedServiceCode")


def param_maps(estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a grid as parameter maps of the estimator."""
    points = product(*grid.values())
    return [{estimator.getParam(name): v for name, v in zip(grid, point, strict=True)} for point in points]


def grid_search(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    keys: Sequence[str],
    grid: Mapping[str, Sequence] = FULL_GRID,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
    clean: bool = False,
) -> tuple[PipelineModel, CrossValidatorModel]:
    """Cross-validated search by accuracy; a row's fold depends on its key only.

    Features and label codes are fitted once, the folds share them.
    """
    fold = F.pmod(row_hash(keys, seed), F.lit(folds)).cast("int").alias("fold")
    df = training_table(df.withColumn("fold", fold), [*columns, label, "fold"], keys)
    names = StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc").fit(df)
    prepared = Pipeline(stages=[*feature_stages(columns, clean), names]).fit(df)
    trees = GBTClassifier(labelCol="label_id", seed=seed)
    points = prepared.transform(df).select("features", "label_id", "fold")
    search = CrossValidator(
        estimator=trees,
        estimatorParamMaps=param_maps(trees, grid),
        evaluator=MulticlassClassificationEvaluator(labelCol="label_id", metricName="accuracy"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(points)
    decode = IndexToString(inputCol="prediction", outputCol="recommendedServiceCode", labels=names.labels)
    return PipelineModel(stages=[*prepared.stages, search.bestModel, decode]), search


def grid_results(df: DataFrame, search: CrossValidatorModel, grid: Mapping[str, Sequence]) -> DataFrame:
    """One row per grid point with its mean accuracy."""
    rows = [
        (*[str(v) for v in point], float(metric))
        for point, metric in zip(product(*grid.values()), search.avgMetrics, strict=True)
    ]
    schema = ", ".join([f"{name} string" for name in grid] + ["accuracy double"])
    return df.sparkSession.createDataFrame(rows, schema)


def train_demand(df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str] = (), **params) -> PipelineModel:
    """Random-forest regression of the daily demand."""
    assemble = VectorAssembler(inputCols=list(columns), outputCol="features")
    forest = RandomForestRegressor(labelCol=label, **{**FOREST, **params})
    return Pipeline(stages=[assemble, forest]).fit(training_table(df, [*columns, label], keys))


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
