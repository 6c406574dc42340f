"""Feature vectors through Spark ML transformers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """One vector column; rows with a NULL feature are dropped."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip").transform(df)


def standardise(df: DataFrame, cols: list[str], with_mean: bool, out: str = "standardised") -> DataFrame:
    """Vector of ``cols`` divided by the sample deviation, centred on demand.

    Meant for numeric columns: centring a one-hot vector would make it dense.
    """
    raw = f"{out}_raw"
    stages = [
        VectorAssembler(inputCols=cols, outputCol=raw, handleInvalid="skip"),
        StandardScaler(inputCol=raw, outputCol=out, withStd=True, withMean=with_mean),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop(raw)


def one_hot_stages(cols: list[str]) -> list:
    """Index each text column by frequency and encode it sparsely; values not
    seen in training share one extra slot."""
    index = StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols], handleInvalid="keep")
    encode = OneHotEncoder(inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_ohe" for c in cols], dropLast=True)
    return [index, encode]


def one_hot(df: DataFrame, cols: list[str]) -> tuple[DataFrame, PipelineModel]:
    """Encoded frame and the fitted encoder."""
    model = Pipeline(stages=one_hot_stages(cols)).fit(df)
    return model.transform(df), model
