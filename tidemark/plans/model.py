"""Sampling, splitting, fitting, scoring and storing the load model."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CALENDAR_FEATURES, WEATHER_FEATURES
from ..functions import bucket_text, prediction_json
from ..operators.aggregates import combine_areas, profile_columns
from ..operators.joins import BUCKET_KEYS
from ..operators.maintenance import _fs
from ..operators.sinks import to_messages
from .features import LOAD


def sample_frame(df: DataFrame, fraction: float = 0.5, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """About a fraction of the rows: at random, or with keys by their hash, which draws the same rows in whatever order and partitions they come."""
    if keys is None:
        return df.sample(fraction=fraction, seed=seed)
    text = F.concat_ws("_", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.filter(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") < int(fraction * 2**32))


def time_split(df: DataFrame, train_end: int = 2024, val_year: int = 2025, val_end_month: int = 10, test_month: int = 11, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training years, the months of validation and the test month; 80/10/10 at random if no row is in the training years."""
    train = df.filter(F.col("year") <= train_end)
    if train.limit(1).count():
        same = F.col("year") == val_year
        return train, df.filter(same & (F.col("month") <= val_end_month)), df.filter(same & (F.col("month") == test_month))
    return tuple(df.randomSplit([0.8, 0.1, 0.1], seed))


def fraction_split(df: DataFrame, ts: str, fractions: tuple[float, float, float] = (0.70, 0.15, 0.15), error: float = 0.001) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts in order of time, cut at quantiles of ts, so without a sort of everything."""
    t = F.unix_timestamp(F.col(ts).cast("timestamp"))
    a, b = df.select(t.alias("t")).approxQuantile("t", [fractions[0], fractions[0] + fractions[1]], error) or (0.0, 0.0)
    return df.filter(t < a), df.filter((t >= a) & (t < b)), df.filter(t >= b)


def usable_features(df: DataFrame, features: list[str]) -> list[str]:
    """The features with a value somewhere; the imputer can't fit the others."""
    rows = profile_columns(df, features).filter("not all_missing").select("column").collect()  # a row for each feature
    kept = {r[0] for r in rows}
    return [f for f in features if f in kept]


def stages(features: list[str], regressor, impute: list[str]) -> Pipeline:
    filled = {f: f"{f}_imputed" for f in impute}
    return Pipeline(
        stages=[
            Imputer(inputCols=list(filled), outputCols=list(filled.values()), strategy="mean"),
            VectorAssembler(inputCols=[filled.get(f, f) for f in features], outputCol="features_raw", handleInvalid="skip"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
            regressor,
        ]
    )


def _as_doubles(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({f: F.col(f).cast("double") for f in features})


def fit_load_model(train: DataFrame, label: str = LOAD, weather: tuple[str, ...] = WEATHER_FEATURES, calendar: tuple[str, ...] = CALENDAR_FEATURES, trees: int = 20, depth: int = 6, seed: int = 42, bootstrap: bool = True) -> PipelineModel:
    """Mean imputation of the weather features, assembly, scaling and a random forest. Features without a single value are left out.

    Without bootstrap each tree sees all rows.
    """
    impute = usable_features(train, list(weather))
    features = impute + list(calendar)
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, bootstrap=bootstrap)
    return stages(features, forest, impute).fit(_as_doubles(train, features))


def tune(train: DataFrame, label: str, features: list[str], depths: tuple[int, ...] = (3, 5), rounds: tuple[int, ...] = (10, 20), seed: int = 42, by: str | None = None) -> PipelineModel:
    """Gradient boosting, its depth and rounds chosen on a fifth of the rows: at random or, with a time column by, the newest, so that no validation row lies between rows learned from."""
    impute = usable_features(train, features)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxIter, list(rounds)).build()
    pipeline, judge, train = stages(impute, gbt, impute), RegressionEvaluator(labelCol=label), _as_doubles(train, impute)
    if by is None:
        return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.8, seed=seed).fit(train).bestModel
    older, new, newest = fraction_split(train, by, (0.8, 0.1, 0.1))
    newest = new.unionByName(newest)
    errors = [judge.evaluate(pipeline.fit(older, chosen).transform(newest)) for chosen in grid]
    return pipeline.fit(train, grid[errors.index(min(errors))])


def learned(model: PipelineModel) -> DataFrame:
    """(feature, fill, mean, deviation) of a fitted pipeline: what stands for a missing value (null: nothing does), and what the scaler takes off and divides by."""
    imputer, assembler, scaler = model.stages[:3]
    names = {o: i for i, o in zip(imputer.getInputCols(), imputer.getOutputCols(), strict=True)}
    fills = imputer.surrogateDF.first().asDict()  # one row
    rows = [(names.get(c, c), fills.get(names.get(c)), float(m), float(d)) for c, m, d in zip(assembler.getInputCols(), scaler.mean, scaler.std, strict=True)]
    return imputer.surrogateDF.sparkSession.createDataFrame(rows, "feature string, fill double, mean double, deviation double")


def score(model: PipelineModel, df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The keys and the prediction of each row."""
    inputs = [c for s in model.stages if hasattr(s, "getInputCols") and s.isSet("inputCols") for c in s.getInputCols() if c in df.columns]
    return model.transform(_as_doubles(df, list(dict.fromkeys(inputs)))).select(*(keys or BUCKET_KEYS), "prediction")


def evaluate(predicted: DataFrame, label: str = LOAD) -> dict[str, float]:
    """RMSE, MAE and R2 of predictions beside their labels, from one pass; all are NaN without a row, R2 too where all labels are equal."""
    y, off = F.col(label).cast("double"), F.col(label).cast("double") - F.col("prediction")
    r = predicted.agg(F.count(off).alias("n"), F.avg(off * off).alias("mse"), F.avg(F.abs(off)).alias("mae"), F.var_pop(F.when(off.isNotNull(), y)).alias("var")).first()
    if not r["n"]:
        return dict.fromkeys(("rmse", "mae", "r2"), float("nan"))
    return {"rmse": r["mse"] ** 0.5, "mae": r["mae"], "r2": 1 - r["mse"] / r["var"] if r["var"] else float("nan")}


def prediction_messages(predicted: DataFrame, ts: str = "ts") -> DataFrame:
    """(key, value) for each time, the areas combined; production and net balance are 0. Nothing is collected."""
    both = combine_areas(predicted, ts)
    row = both.select(bucket_text(ts, iso=True).alias("timestamp"), "dk_area", prediction_json("prediction").alias("predictions"), bucket_text(ts).alias("at"))
    return to_messages(row, ["dk_area", "at"], ["timestamp", "dk_area", "predictions"])


def save_model(model: PipelineModel, root: str, name: str = "load_model", now: dt.datetime | None = None, archive: str | None = None) -> str:
    """Saves a copy under its time, one as the latest, and one in the archive if given; returns the first one's path."""
    stamp = f"{root.rstrip('/')}/{name}_{(now or dt.datetime.now()):%Y%m%d_%H%M%S}"
    targets = [stamp, f"{root.rstrip('/')}/{name}_latest"] + ([f"{archive.rstrip('/')}/{stamp.rpartition('/')[2]}"] if archive else [])
    for path in targets:
        model.write().overwrite().save(path)
    return stamp


def load_latest_model(spark: SparkSession, root: str, name: str = "load_model") -> PipelineModel:
    """The model with the latest time in its name, else the one named latest."""
    fs, p = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    stamped = sorted(n for n in names if n.startswith(f"{name}_") and n[len(name) + 1 :].replace("_", "").isdigit())
    chosen = stamped[-1] if stamped else f"{name}_latest"
    if chosen not in names:
        raise FileNotFoundError(f"no {name} in {root}")
    return PipelineModel.load(f"{root.rstrip('/')}/{chosen}")
