"""Multinomial model of the delay bin, from features of the scheduled arrival."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from punctua.functions.delays import delay_bin, delay_minutes, fallback_chance
from punctua.functions.text import short_stop_id, strip_letters
from punctua.functions.times import DAY_PATTERN, MINUTE_PATTERN, SECOND_PATTERN, calendar_features, safe_date, safe_ts
from punctua.operators.features import one_hot_stages
from punctua.sources.writers import kept

NUMERIC = ["minute", "hour", "month", "year", "week_of_year", "day_of_year", "day_of_week"]
CATEGORIES = ["transport_type", "stop_id"]


def model_rows(events: DataFrame) -> DataFrame:
    """Features and delay bin of every event with a measured arrival.

    Text times that do not parse give NULL and are dropped; copies go, too.
    """
    due, real = safe_ts("sched_arr", MINUTE_PATTERN), safe_ts("act_arr", SECOND_PATTERN)
    rows = events.select(
        F.lower("vehicle").alias("transport_type"),
        short_stop_id(strip_letters("stop_id", "Parent")).alias("stop_id"),
        due.alias("due"),
        real.alias("real"),
    ).dropna().distinct()
    late = delay_minutes(F.col("due"), F.col("real"))
    return rows.withColumns({**calendar_features("due"), "delay_minutes": late}).withColumn("delay_bin", delay_bin(F.col("delay_minutes")))


class EventFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage from raw events to ``NUMERIC`` and ``CATEGORIES``; stored and loaded with its model.

    Minute and hour are those of the scheduled arrival, the other calendar fields
    those of the operating day, or of the arrival where that is missing or bad.
    Where the arrival is missing or bad itself, fields are 0; :func:`score_events`
    gives such rows no chances.
    """

    dueCol = Param(Params._dummy(), "dueCol", "scheduled arrival, text to the minute", TypeConverters.toString)
    dayCol = Param(Params._dummy(), "dayCol", "operating day, text", TypeConverters.toString)
    vehicleCol = Param(Params._dummy(), "vehicleCol", "transport type", TypeConverters.toString)
    stopCol = Param(Params._dummy(), "stopCol", "stop number", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, dueCol: str = "sched_arr", dayCol: str = "trip_day", vehicleCol: str = "vehicle", stopCol: str = "stop_id"):
        super().__init__()
        self._setDefault(dueCol="sched_arr", dayCol="trip_day", vehicleCol="vehicle", stopCol="stop_id")
        self._set(**self._input_kwargs)

    def due(self) -> Column:
        return safe_ts(self.getOrDefault("dueCol"), MINUTE_PATTERN)

    def _transform(self, df: DataFrame) -> DataFrame:
        # Columns of their own, so that a text is parsed once and not once per field.
        due, day = F.col("__due"), F.col("__day")
        timed = df.withColumns({"__due": self.due(), "__day": safe_date(self.getOrDefault("dayCol"), DAY_PATTERN)})
        timed = timed.withColumn("__day", F.coalesce(day, due.cast("date")))
        fields = {**calendar_features("__day"), "minute": F.minute(due), "hour": F.hour(due)}
        numbers = {name: F.coalesce(F.when(due.isNotNull(), value), F.lit(0)) for name, value in fields.items()}
        return timed.withColumns({
            **numbers,
            "transport_type": F.lower(self.getOrDefault("vehicleCol")),
            "stop_id": short_stop_id(strip_letters(self.getOrDefault("stopCol"), "Parent")),
        }).drop("__due", "__day")


def labelled_events(events: DataFrame, stage: EventFeatures | None = None, actual: str = "act_arr") -> DataFrame:
    """Raw events with a measured arrival, with ``delay_bin``; copies go."""
    due, real = F.col("__due"), F.col("__real")
    timed = events.withColumns({"__due": (stage or EventFeatures()).due(), "__real": safe_ts(actual, SECOND_PATTERN)})
    rows = timed.filter(due.isNotNull() & real.isNotNull()).withColumn("delay_bin", delay_bin(delay_minutes(due, real)))
    return rows.drop("__due", "__real").distinct()


def fit_event_model(labelled: DataFrame, stage: EventFeatures | None = None, **settings) -> PipelineModel:
    """Delay model whose first stage takes raw events, so that the stored model scores them as they come."""
    with kept(labelled) as rows:
        return Pipeline(stages=[stage or EventFeatures(), *delay_pipeline(**settings).getStages()]).fit(rows)


def score_events(events: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``chances`` to raw events; NULL where the scheduled arrival is missing or bad."""
    keep = [F.col(f"`{c}`") for c in events.columns]
    held = events.withColumn("__event", F.struct(*keep))
    scored = model.transform(held)
    chances = F.when(model.stages[0].due().isNotNull(), vector_to_array("probability")).alias("chances")
    return scored.select(*[F.col(f"__event.`{c}`") for c in events.columns if c != "chances"], chances)


def delay_pipeline(
    numeric: list[str] = NUMERIC, categories: list[str] = CATEGORIES, label: str = "delay_bin",
    reg: float = 0.1, elastic: float = 0.0, max_iter: int = 100,
) -> Pipeline:
    """Scaled numbers and sparse one-hot categories into a multinomial model.

    Only the numbers are centred: the one-hot part may have as many slots as
    there are stops and must stay sparse.
    """
    logistic = LogisticRegression(
        featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=elastic,
        family="multinomial", maxIter=max_iter, probabilityCol="probability",
    )
    stages = [
        *(one_hot_stages(categories) if categories else []),
        VectorAssembler(inputCols=numeric, outputCol="__numbers"),
        StandardScaler(inputCol="__numbers", outputCol="__scaled", withStd=True, withMean=True),
        VectorAssembler(inputCols=["__scaled", *[f"{c}_ohe" for c in categories]], outputCol="features"),
        logistic,
    ]
    return Pipeline(stages=stages)


def fit_delay_model(df: DataFrame, **settings) -> PipelineModel:
    with kept(df) as rows:
        return delay_pipeline(**settings).fit(rows)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``chances``, the probability of each delay bin."""
    scored = model.transform(df)
    return scored.withColumn("chances", vector_to_array("probability")).select(*df.columns, "chances", "prediction")


def chance_from_bins(chances: Column, minutes: Column) -> Column:
    """P(delay <= minutes): the chances of all bins up to the one of ``minutes``.

    Bins the model never saw have no entry and add nothing."""
    upto = F.slice(chances, F.lit(1), F.least(delay_bin(minutes) + 1, F.size(chances)))
    total = F.aggregate(upto, F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(total, fallback_chance(minutes))


def grid_search(
    df: DataFrame, regs: tuple[float, ...] = (0.01, 0.1, 1.0), elastics: tuple[float, ...] = (0.0, 1.0), folds: int = 4, seed: int = 0, **settings
) -> DataFrame:
    """Mean accuracy of every penalty strength (``regs``) and kind (0 = L2, 1 = L1)."""
    pipeline = delay_pipeline(**settings)
    logistic = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(logistic.regParam, list(regs)).addGrid(logistic.elasticNetParam, list(elastics)).build()
    judge = MulticlassClassificationEvaluator(labelCol=settings.get("label", "delay_bin"), metricName="accuracy")
    search = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed, parallelism=4)
    with kept(df) as rows:
        found = search.fit(rows)
    scores = [
        (float(g[logistic.regParam]), float(g[logistic.elasticNetParam]), float(m)) for g, m in zip(grid, found.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(scores, "reg_param DOUBLE, elastic_net DOUBLE, accuracy DOUBLE")
