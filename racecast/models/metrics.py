"""Classification metrics as aggregations, so they can be read off any scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.operators.ordered import DEFAULT_SPLIT, Split, running_total
from racecast.session import materialise


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    keys: Sequence[str] = (),
    weight: Column | None = None,
) -> DataFrame:
    """(keys, label, prediction, n): the one pass over the rows that all class metrics need."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(n.alias("n"))


def class_metrics(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, accuracy, f1, weighted_precision, weighted_recall) from ``confusion`` counts.

    Per-class values are weighted by the share of the true class; a class never predicted has
    precision 0.
    """
    none = F.lit(0).cast("long")
    true_side = F.struct(
        F.col("label").cast("double").alias("class"),
        F.col("n").alias("support"),
        none.alias("predicted"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none).alias("hits"),
    )
    predicted_side = F.struct(
        F.col("prediction").cast("double").alias("class"),
        none.alias("support"),
        F.col("n").alias("predicted"),
        none.alias("hits"),
    )
    per_class = (
        counts.select(*keys, F.inline(F.array(true_side, predicted_side)))
        .groupBy(*keys, "class")
        .agg(*(F.sum(c).alias(c) for c in ("support", "predicted", "hits")))
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    support = F.col("support")

    def weighted(value: Column) -> Column:
        return F.sum(support * value) / F.sum(support)

    return per_class.groupBy(*keys).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def auc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    keys: Sequence[str] = (),
    weight: str | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """(keys, auc): exact area under the ROC curve, tied scores counting half.

    Rows are counted per score first, and the counts materialised for the passes that follow. The
    running count over the ordered scores is cut into segments like any other heavy key, so there is
    no single-task sort. ``weight`` names a column with the rows each row stands for.
    """
    n = F.lit(1) if weight is None else F.col(weight)
    sides = {"pos": F.when(F.col(label) == 1, n).otherwise(0), "neg": F.when(F.col(label) == 0, n).otherwise(0)}
    per_score = df.groupBy(*keys, F.col(score).alias("score")).agg(*(F.sum(v).alias(k) for k, v in sides.items()))
    totals = running_total(
        materialise(per_score), list(keys), ["score"], {"pos": "pos", "neg": "neg"}, split, counted=True
    )
    below = (F.col("cum_neg") - F.col("neg")).cast("double") + F.col("neg") / F.lit(2)
    pairs = F.sum(F.col("pos") * below)
    possible = F.sum("pos").cast("double") * F.sum("neg")
    return totals.groupBy(*keys).agg(F.try_divide(pairs, possible).alias("auc"))
