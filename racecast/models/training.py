"""Encoding, fitting, comparing and applying binary classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racecast.models.metrics import auc, class_metrics, confusion
from racecast.operators.dataset import split_share
from racecast.operators.ordered import running_total
from racecast.operators.quality import missing
from racecast.session import materialise

FEATURES, LABEL = "features", "label"
# Values that a tree's bins hold by default, and up to which a table of values is broadcast.
TREE_CATEGORIES, BROADCAST_VALUES = 32, 100_000
# Numbers of feature vectors that one task of a fit holds: 64 MB.
TASK_NUMBERS = 8_000_000

# Settings of the linear SVM and the grid of the cross-validation.
SVM_SETTINGS = {"maxIter": 10, "regParam": 0.1}
REG_PARAMS = (0.01, 0.1, 1.0)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)
FOLDS = 5


def default_classifiers() -> dict[str, Estimator]:
    return {
        "linear_svm": LinearSVC(**SVM_SETTINGS),
        "logistic_regression": LogisticRegression(),
        "decision_tree": DecisionTreeClassifier(),
    }


class CategoryIndex(Transformer):
    """Text categories as numbers, by a join with each column's table of (value, index).

    The most frequent value is 0, ties in alphabetical order; NULL and values first seen later share the
    index after the last. The tables stay distributed, however many values a column has.
    """

    def __init__(self, ranks: dict[str, DataFrame], sizes: dict[str, int], suffix: str):
        super().__init__()
        self.ranks, self.sizes, self.suffix = ranks, sizes, suffix

    def _transform(self, rows: DataFrame) -> DataFrame:
        for c, ranks in self.ranks.items():
            size, name = self.sizes[c] + 1, c + self.suffix
            near = F.broadcast(ranks) if size <= BROADCAST_VALUES else ranks
            joined = rows.join(near, F.col(c) == F.col("_value"), "left")
            index = F.coalesce("_index", F.lit(size - 1)).cast("double")
            kind = {"type": "nominal", "num_vals": size} if size <= TREE_CATEGORIES else {"type": "numeric"}
            rows = joined.withColumn(name, index.alias(name, metadata={"ml_attr": {"name": name, **kind}}))
            rows = rows.drop("_value", "_index")
        return rows


def category_ranks(train: DataFrame, category: str) -> DataFrame:
    """(_value, _index) of the known values of a column: counted, then numbered along (count, value)."""
    counts = materialise(
        train.filter(F.col(category).isNotNull())
        .groupBy(F.col(category).alias("_value"))
        .agg((-F.count(F.lit(1))).alias("_less"))
    )
    placed = running_total(counts, [], ["_less", "_value"], {"k": F.lit(1)}, counted=True)
    return materialise(placed.select("_value", (F.col("cum_k") - 1).alias("_index")))


def fit_categories(train: DataFrame, categories: Sequence[str], suffix: str = "_index") -> PipelineModel:
    """Index text categories by their counts in the rows that have all of them; see ``CategoryIndex``.

    Up to a tree's number of bins the index is marked as nominal, so that trees try sets of values; beyond
    it is a number to them.
    """
    if not categories:
        return PipelineModel(stages=[])
    known = train.na.drop("any", subset=list(categories))
    ranks = {c: category_ranks(known, c) for c in categories}
    return PipelineModel(stages=[CategoryIndex(ranks, {c: r.count() for c, r in ranks.items()}, suffix)])


def fit_features(train: DataFrame, label: str, features: Sequence[str]) -> Model:
    """Assemble ``features`` and ``label`` columns; text features are one-hot encoded.

    Fitted on training rows only. A text value first seen later has its own place in the vector. Rows with
    a NULL number stop the job, so impute first. A text feature has a coefficient for each of its values,
    which a model holds as a whole: index columns with very many values by ``fit_categories`` instead.
    """
    texts = any(isinstance(train.schema[c].dataType, T.StringType) for c in features)
    formula = f"{label} ~ {' + '.join(features)}"
    return RFormula(
        formula=formula, featuresCol=FEATURES, labelCol=LABEL, handleInvalid="keep" if texts else "error"
    ).fit(train)


def in_tasks(ready: DataFrame, features: int) -> DataFrame:
    """Rows with vectors made of so many ``features``, in as many parts that each holds a bounded number of numbers.

    Files of vectors are read in parts of a size in bytes, but are many times larger once decoded, and estimators keep
    the decoded rows of a part and read them in each iteration. Small tables stay as they are.
    """
    width = ready.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs", 2 * features)
    # A sparse vector has an entry for each feature at most, of a number and its place.
    parts = -(-ready.count() * min(width, 2 * features) // TASK_NUMBERS)
    return ready.repartition(parts) if parts > ready.rdd.getNumPartitions() else ready


def fit_models(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    categories: Sequence[str] = (),
    estimators: dict[str, Estimator] | None = None,
) -> dict[str, PipelineModel]:
    """Each estimator as a model that takes raw rows: categories, features and classifier in one.

    Encoding is fitted and its result materialised once for all estimators, which read it in parts of bounded size.
    """
    indexers = fit_categories(train, categories)
    indexed = indexers.transform(train)
    names = [f"{c}_index" if c in categories else c for c in features]
    formula = fit_features(indexed, label, names)
    ready = in_tasks(materialise(formula.transform(indexed).select(FEATURES, LABEL)), len(names))
    fitted = {name: estimator.fit(ready) for name, estimator in (estimators or default_classifiers()).items()}
    return {name: PipelineModel(stages=[indexers, formula, model]) for name, model in fitted.items()}


def _scored(models: dict[str, PipelineModel], rows: DataFrame, score: str) -> DataFrame:
    """(model, label, prediction, score) of models with the same encoding, from one pass over the rows."""
    encoding = next(iter(models.values())).stages[:-1]
    out = PipelineModel(stages=encoding).transform(rows)
    structs = []
    for name, model in models.items():
        last = model.stages[-1]
        vectors = [c for c in ("rawPrediction", "probability") if last.hasParam(f"{c}Col")]
        if score not in vectors:
            raise ValueError(f"{name} gives no {score}")
        renamed = {last.getParam(f"{c}Col"): f"{name}__{c}" for c in (*vectors, "prediction")}
        out = last.copy(renamed).transform(out)
        structs.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(LABEL).alias("label"),
                F.col(f"{name}__prediction").alias("prediction"),
                F.get(vector_to_array(F.col(f"{name}__{score}")), 1).alias("score"),
            )
        )
    return out.select(F.inline(F.array(*structs)))


def scored_counts(
    models: dict[str, PipelineModel], parts: dict[str, DataFrame], score: str = "rawPrediction"
) -> DataFrame:
    """Rows per (model, split, label, prediction, score), computed once.

    Models that share their encoding, as those of one ``fit_models`` do, are scored in one pass.
    ``score`` names the vector whose second entry orders the rows. A tree's ``rawPrediction`` holds
    the training rows in its leaf, not a share; pass ``probability`` to order by shares.
    """
    alike: dict[tuple[str, ...], dict[str, PipelineModel]] = {}
    for name, model in models.items():
        alike.setdefault(tuple(stage.uid for stage in model.stages[:-1]), {})[name] = model
    tables = [
        _scored(group, rows, score).withColumn("split", F.lit(part))
        for part, rows in parts.items()
        for group in alike.values()
    ]
    union = reduce(DataFrame.unionByName, tables)
    keys = ["model", "split", "label", "prediction", "score"]
    return materialise(union.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def compare_models(
    models: dict[str, PipelineModel],
    train: DataFrame,
    test: DataFrame,
    score: str = "rawPrediction",
) -> DataFrame:
    """(model, split, n, auc, accuracy, f1, weighted_precision, weighted_recall) per model and split."""
    keys = ["model", "split"]
    counts = scored_counts(models, {"train": train, "test": test}, score)
    classes = class_metrics(confusion(counts, keys=keys, weight=F.col("n")), keys)
    areas = auc(counts, keys=keys, weight="n")
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("n"))
    return sizes.join(areas, keys).join(classes, keys)


def best_model(report: DataFrame, metric: str = "auc", split: str = "test") -> DataFrame:
    """The report row with the highest metric; ties by model name."""
    return report.filter(F.col("split") == split).orderBy(F.desc_nulls_last(metric), "model").limit(1)


def feature_names(scored: DataFrame, features: str = FEATURES) -> list[str]:
    """Names of the vector's entries in vector order, from the column's metadata."""
    groups = scored.schema[features].metadata["ml_attr"]["attrs"]
    entries = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in entries]


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance), highest first: coefficients, or importances of a tree."""
    names = feature_names(model.transform(rows))
    last = model.stages[-1]
    values = (last.coefficients if hasattr(last, "coefficients") else last.featureImportances).toArray().tolist()
    table = rows.sparkSession.createDataFrame(
        list(zip(names, values, strict=True)), "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature")


def predict_event(
    model: PipelineModel, entries: DataFrame, keys: Sequence[str], features: Sequence[str] = ()
) -> DataFrame:
    """(keys, finish_probability, prediction) per entry of an upcoming event.

    Needs a model that gives probabilities, which a linear SVM does not. Entries with a NULL or NaN among
    the numbers in ``features`` have a NULL probability and prediction.
    """
    numbers = [c for c in features if not isinstance(entries.schema[c].dataType, T.StringType)]
    open_ = reduce(lambda a, b: a | b, (missing(entries, c) for c in numbers), F.lit(False))
    # A number in place of the gap, so that the model can be applied to every row.
    ready = entries.withColumn("_open", open_).na.fill(0, numbers)
    scored = model.transform(ready)
    if "probability" not in scored.columns:
        raise ValueError("the model gives no probabilities; use logistic regression or a tree")
    chance = F.get(vector_to_array(F.col("probability")), 1)
    known = ~F.col("_open")
    return scored.select(
        *keys, F.when(known, chance).alias("finish_probability"), F.when(known, F.col("prediction")).alias("prediction")
    )


def cross_validate(
    train: DataFrame,
    keys: Sequence[str],
    folds: int = FOLDS,
    reg_params: Sequence[float] = REG_PARAMS,
    elastic_net_params: Sequence[float] = ELASTIC_NET_PARAMS,
    seed: int = 123,
    parallelism: int = 4,
    portable: bool = False,
) -> tuple[Model, DataFrame]:
    """Grid search of a logistic model by mean AUC over folds made by key hash.

    ``train`` has ``features`` and ``label`` columns. Returns the refitted best model and the table
    (reg_param, elastic_net_param, mean_auc), best first.
    """
    # Not the hash of the train/test split, which the training rows' keys do not cover evenly.
    fold = F.floor(split_share(keys, f"fold {seed}", portable) * folds).cast("int")
    ready = materialise(train.select(FEATURES, LABEL, fold.alias("fold")))
    estimator = LogisticRegression()
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg_params))
        .addGrid(estimator.elasticNetParam, list(elastic_net_params))
        .build()
    )
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
        numFolds=folds, foldCol="fold", parallelism=parallelism,
    )
    found = search.fit(ready)
    rows = [
        (params[estimator.regParam], params[estimator.elasticNetParam], float(mean))
        for params, mean in zip(grid, found.avgMetrics, strict=True)
    ]
    table = train.sparkSession.createDataFrame(
        rows, "reg_param double, elastic_net_param double, mean_auc double"
    )
    return found.bestModel, table.orderBy(F.desc("mean_auc"), "reg_param", "elastic_net_param")
