"""How sure the coefficients of a logistic model are."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.models.training import FEATURES, feature_names

INTERCEPT = "(intercept)"
NO_DIRECTION = 1e-9


def weighted_gram(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(i, j, total): the sums of p (1 - p) x_i x_j over all rows, for i <= j; the intercept comes last.

    One aggregation. A row gives a term for each pair of its entries other than 0, summed within each task, so tasks
    send on at most one row for each pair of features.
    """
    scored = model.transform(rows)
    chance = F.get(vector_to_array(F.col("probability")), 1)
    terms = scored.select(chance.alias("p"), vector_to_array(F.col(FEATURES)).alias("x"))
    entries = "concat(filter(transform(x, (v, i) -> struct(i AS i, v AS v)), e -> e.v <> 0D), array(struct(size(x) AS i, 1D AS v)))"
    terms = terms.select("p", F.expr(entries).alias("e"))
    pairs = "flatten(transform(e, a -> transform(filter(e, b -> b.i >= a.i), b -> struct(a.i AS i, b.i AS j, a.v * b.v AS v))))"
    spread = terms.select("p", F.expr(f"inline({pairs})"))
    return spread.groupBy("i", "j").agg(F.sum(F.col("p") * (1 - F.col("p")) * F.col("v")).alias("total"))


def coefficient_table(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, coefficient, std_error, z) of a logistic model fitted on ``rows`` without a penalty.

    Errors are the roots of the diagonal of the inverse of ``weighted_gram``. A coefficient that the rows do not
    settle (a feature that is always 0, or the sum of others) has a NULL error. The matrix has one entry for each pair
    of coefficients, which the model holds on the driver already.
    """
    names = [*feature_names(model.transform(rows.limit(0))), INTERCEPT]
    last = model.stages[-1]
    values = [*last.coefficients.toArray().tolist(), float(last.intercept)]
    gram = np.zeros((len(names), len(names)))
    for i, j, total in weighted_gram(model, rows).collect():
        gram[i, j] = gram[j, i] = total
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1))
    size, direction = np.linalg.eigh(gram / np.outer(scale, scale))
    open_ = size <= NO_DIRECTION * max(1.0, size.max(initial=0.0))
    unsettled = (np.abs(direction[:, open_]) > 1e-6).any(1)
    errors = np.sqrt((direction[:, ~open_] ** 2 / size[~open_]).sum(1)) / scale
    found = [
        (name, value, None if lost else float(error), None if lost else value / float(error))
        for name, value, error, lost in zip(names, values, errors, unsettled, strict=True)
    ]
    table = rows.sparkSession.createDataFrame(found, "feature string, coefficient double, std_error double, z double")
    return table.orderBy(F.desc(F.abs("z")), "feature")
