"""Abandonment model: MLlib pipeline, cross-validated training, evaluation, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.operators.risk import (
    class_balance,
    momentum_label,
    outcome,
    risk_tier,
    with_class_weight,
)
from eventmart.session import durable

IMPUTED = tuple(f"{name}_imp" for name in V.NUMERIC_FEATURES)
VECTOR_NAMES = (*IMPUTED, *V.FLAG_FEATURES)

# ---- fixed values: forest settings and tuning grid --------------------------------------
FOREST = {
    "numTrees": 100,
    "maxDepth": 8,
    "minInstancesPerNode": 5,
    "featureSubsetStrategy": "sqrt",
    "seed": 42,
}
TREE_GRID = (50, 100, 200)
DEPTH_GRID = (5, 8, 12)
FOLDS = 3


def prepare_features(features: DataFrame) -> DataFrame:
    """Doubles for the imputer, zeros and false for what is missing.

    Training and scoring both go through here, so they cannot drift apart.
    """
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in V.NUMERIC_FEATURES}
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in V.FLAG_FEATURES}
    return features.withColumns({**numbers, **flags})


def training_rows(features: DataFrame) -> DataFrame:
    """Prepared features with class weights, written out.

    Every candidate fit reads these rows many times over. The first copy keeps the count
    of the classes from going back to the events, the second one fixes the weight.
    """
    rows = durable(prepare_features(features))
    return durable(with_class_weight(rows, class_balance(rows)))


def risk_pipeline(forest: RandomForestClassifier) -> Pipeline:
    """Impute, index and one-hot encode, assemble, scale, classify."""
    index = [f"{c}_index" for c in V.CATEGORY_FEATURES]
    onehot = [f"{c}_onehot" for c in V.CATEGORY_FEATURES]
    return Pipeline(
        stages=[
            Imputer(
                inputCols=list(V.NUMERIC_FEATURES), outputCols=list(IMPUTED), strategy="median"
            ),
            StringIndexer(
                inputCols=list(V.CATEGORY_FEATURES), outputCols=index, handleInvalid="keep"
            ),
            OneHotEncoder(inputCols=index, outputCols=onehot, handleInvalid="keep"),
            VectorAssembler(
                inputCols=[*VECTOR_NAMES, *onehot],
                outputCol="features_raw",
                handleInvalid="keep",
            ),
            StandardScaler(
                inputCol="features_raw", outputCol="features", withMean=True, withStd=True
            ),
            forest,
        ]
    )


@dataclass
class Training:
    model: PipelineModel
    auc_roc: float
    f1: float
    accuracy: float
    predictions: DataFrame

    @property
    def forest(self):
        return self.model.stages[-1]


def train(
    train_rows: DataFrame,
    test_rows: DataFrame,
    trees: Sequence[int] = TREE_GRID,
    depths: Sequence[int] = DEPTH_GRID,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> Training:
    """Random forest tuned by cross-validation on the area under the ROC curve.

    Inputs come from `training_rows`. Candidates are fitted concurrently.
    """
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="class_weight", **FOREST
    )
    area = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .build()
    )
    pipeline = risk_pipeline(forest)
    if len(grid) > 1:
        tuner = CrossValidator(
            estimator=pipeline,
            estimatorParamMaps=grid,
            evaluator=area,
            numFolds=folds,
            seed=FOREST["seed"],
            parallelism=parallelism,
        )
        model = tuner.fit(train_rows).bestModel
    else:
        model = pipeline.fit(train_rows, grid[0])
    predictions = model.transform(test_rows)

    def measure(name: str) -> float:
        return MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(
            predictions
        )

    return Training(
        model, area.evaluate(predictions), measure("f1"), measure("accuracy"), predictions
    )


def _positive():
    return vector_to_array("probability")[1]


def test_predictions(predictions: DataFrame, version: str, trained_at: str) -> DataFrame:
    """Outcome of every test row."""
    return predictions.select(
        "repo_key",
        F.lit(version).alias("model_version"),
        "label",
        F.col("prediction").cast("int").alias("predicted_label"),
        F.round(_positive(), 4).alias("abandonment_probability"),
        outcome().alias("outcome"),
        F.lit(trained_at).alias("trained_at"),
    )


def feature_importance(model: PipelineModel, like: DataFrame, version: str) -> DataFrame:
    """Importance of every model input; the one-hot slots of a category are summed.

    The names come from the attributes of the assembled vector of `like`. There is one row
    per input column, so the result is small by nature.
    """
    attributes = model.transform(like).schema["features_raw"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attributes.values() for a in kind)
    weights = model.stages[-1].featureImportances.toArray()
    totals = {name: 0.0 for name in (*VECTOR_NAMES, *V.CATEGORY_FEATURES)}
    for (_, slot), weight in zip(slots, weights, strict=True):
        owner = next((c for c in V.CATEGORY_FEATURES if slot.startswith(f"{c}_onehot")), slot)
        totals[owner] += float(weight)
    rows = [(name, weight, version) for name, weight in totals.items()]
    return like.sparkSession.createDataFrame(
        rows, "feature_name string, importance double, model_version string"
    ).orderBy(F.desc("importance"))


def score(
    model: PipelineModel,
    features: DataFrame,
    repositories: DataFrame,
    version: str,
    scored_at: str | None = None,
) -> DataFrame:
    """Probability, tier and momentum label of every repository with an age."""
    ready = prepare_features(features.filter(F.col("repo_age_days").isNotNull()))
    probability = _positive()
    at = F.lit(scored_at).cast("timestamp") if scored_at else F.current_timestamp()
    archived = repositories.select("repo_key", "is_archived")
    # created_year and commit_momentum are zero-filled for the model only
    plain = features.select("repo_key", "created_year", "commit_momentum")
    scored = (
        model.transform(ready)
        .withColumn("p", probability)
        .select(
            "repo_key",
            F.lit(version).alias("model_version"),
            F.round("p", 4).alias("abandonment_probability"),
            risk_tier("p").alias("risk_tier"),
            at.alias("scored_at"),
        )
    )
    return (
        scored.join(plain, "repo_key", "left")
        .join(archived, "repo_key", "left")
        .select(
            *scored.columns[:4],
            "created_year",
            "scored_at",
            "is_archived",
            momentum_label("commit_momentum").alias("trajectory_label"),
        )
    )
