"""Text features of any number of values in a fixed number of places, without a vocabulary.

Each value's hash says its place, so nothing is fitted, nothing reaches the driver, and a model has ``size``
coefficients for a feature however many values it has. Values that share a place are told apart no more;
``collisions`` counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.models.training import FEATURES, LABEL

PLACES = 2**16


def place_sql(column: str, size: int = PLACES, portable: bool = False) -> str:
    """SQL of a text's place from 1, 0 for NULL. ``portable`` takes MD5, which other engines compute too."""
    name = "`" + column.replace("`", "``") + "`"
    code = f"bigint(conv(substring(md5({name}), 1, 8), 16, 10))" if portable else f"xxhash64({name})"
    return f"coalesce(1 + pmod({code}, {size}L), 0L)"


def collisions(df: DataFrame, column: str, size: int = PLACES, portable: bool = False) -> DataFrame:
    """(place, n_values, n): the places that several values share, with their rows. Distinct values are counted first."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("k"))
    places = values.groupBy(F.expr(place_sql(column, size, portable)).alias("place"))
    return places.agg(F.count(F.lit(1)).alias("n_values"), F.sum("k").alias("n")).filter("n_values > 1")


def fit_hashed(
    train: DataFrame,
    label: str,
    texts: Sequence[str],
    numbers: Sequence[str],
    estimator: Estimator,
    size: int = PLACES,
    portable: bool = False,
) -> PipelineModel:
    """``estimator`` on hashed ``texts`` and ``numbers``, as a pipeline of Spark's own stages that can be saved.

    A text is one place out of ``size``, or one more for NULL. Numbers must not be NULL.
    """
    hashed = ", ".join(f"double({place_sql(c, size, portable)}) AS `{c}_place`" for c in texts)
    places = SQLTransformer(statement=f"SELECT *{', ' + hashed if hashed else ''} FROM __THIS__")
    spread = OneHotEncoder(
        inputCols=[f"{c}_place" for c in texts], outputCols=[f"{c}_places" for c in texts], handleInvalid="keep"
    )
    joined = VectorAssembler(inputCols=[*numbers, *(f"{c}_places" for c in texts)], outputCol=FEATURES)
    stages = [places, *([spread] if texts else []), joined, estimator]
    return Pipeline(stages=stages).fit(train.withColumn(LABEL, F.col(label).cast("double")))
