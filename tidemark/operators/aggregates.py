"""Roll-ups of observations and energy records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import area_of, circular_mean, date_parts
from .filters import NUMBERS, conform, known_area, missing
from .joins import HOUR_KEYS, with_area

GRAINS = {"10min": ["year", "month", "day", "hour", "minute_bucket"], "hour": ["year", "month", "day", "hour"]}


def pivot_parameters(obs: DataFrame, grain: str, params: tuple[str, ...]) -> DataFrame:
    """Means of each parameter for each station and bucket; obs(station_id, parameter_id, ts, value).

    The list of parameters is given, so no job looks for them and every column is there.
    """
    df = date_parts(obs.filter(F.col("parameter_id").isin(*params)), "ts", minutes=grain == "10min")
    return df.groupBy("station_id", *GRAINS[grain]).pivot("parameter_id", list(params)).avg("value")


def aggregate_area(wide: DataFrame, keys: list[str], params: tuple[str, ...], maxima: tuple[str, ...] = ("wind_max",), counted: str | None = "temp_dry", direction: str | None = None) -> DataFrame:
    """Means over the stations' means, maxima for some; n_stations counts the stations that report counted.

    direction, if given, is replaced by the mean sine and cosine of its degrees.
    """
    out: list[Column] = []
    for p in params:
        if p == direction:
            sin, cos = circular_mean(p)
            out += [sin.alias(f"{p}_sin"), cos.alias(f"{p}_cos")]
        else:
            out.append((F.max(p) if p in maxima else F.avg(p)).alias(p))
    stations = F.count(counted) if counted and counted in wide.columns else F.lit(0)
    return wide.groupBy(*keys).agg(*out, stations.cast("int").alias("n_stations"))


def area_buckets(obs: DataFrame, dim: DataFrame, grain: str, params: tuple[str, ...], **options) -> DataFrame:
    """Observations to area means: pivot, area of the station, roll-up."""
    return aggregate_area(with_area(pivot_parameters(obs, grain, params), dim), ["dk_area", *GRAINS[grain]], params, **options)


#: name: (aggregate, parameter)
VIEW = {
    "temp_mean_area": (F.avg, "temp_dry"),
    "temp_max_area": (F.max, "temp_dry"),
    "temp_min_area": (F.min, "temp_dry"),
    "wind_speed_mean_area": (F.avg, "wind_speed"),
    "wind_speed_max_area": (F.max, "wind_max"),
    "humidity_mean_area": (F.avg, "humidity"),
    "pressure_at_sea_mean_area": (F.avg, "pressure"),
    "cloud_cover_mean_area": (F.avg, "cloud_cover"),
    "visibility_mean_area": (F.avg, "visibility"),
}
VIEW_NULLS = (
    "temp_grass_mean_area",
    "temp_soil_mean_area",
    "wind_dir_sin_area",
    "wind_dir_cos_area",
    "wind_gust_always_past1h_max_area",
    "radia_glob_past1h_area",
    "sun_last1h_glob_area",
    "sun_last10min_glob_area",
    "precip_past1h_mean_area",
    "precip_past10min_mean_area",
)


def area_hourly_view(obs: DataFrame, measures: dict | None = None, nulls: tuple[str, ...] = VIEW_NULLS) -> DataFrame:
    """Conditional aggregates over the raw observations, so that a busy station weighs more; obs has dk_area and ts."""
    aggs = [f(F.when(F.col("parameter_id") == p, F.col("value"))).alias(name) for name, (f, p) in (measures or VIEW).items()]
    df = date_parts(obs, "ts").groupBy(*HOUR_KEYS).agg(*aggs, F.countDistinct("station_id").alias("n_stations"))
    return df.withColumns({c: F.lit(None).cast("double") for c in nulls}) if nulls else df


def to_store(wide: DataFrame, measures: tuple[str, ...], keys: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Aggregates as they are stored: the measures and n_stations (null if missing), the flag predicted, which is 0, and the keys last."""
    kinds = dict.fromkeys(measures, "double") | {"n_stations": "int", "predicted": "int"} | {k: "string" if k == "dk_area" else "int" for k in keys}
    return conform(wide.withColumn("predicted", F.lit(0)), kinds | (types or {}))


def consumption_hourly(energy: DataFrame) -> DataFrame:
    """Hourly sums of ShareMWh over connected and via areas; energy(PriceArea, ShareMWh, ts)."""
    df = known_area(energy.withColumn("dk_area", area_of("PriceArea")))
    return date_parts(df, "ts").groupBy(*HOUR_KEYS).agg(F.sum("ShareMWh").alias("consumption_mwh_area"))


def latest_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("latest"))


def has_rows(df: DataFrame, n: int = 1) -> bool:
    """Whether df has n rows; the count stops there."""
    return df.limit(n).count() >= n


def enough_data(weather: DataFrame, load: DataFrame, least_weather: int = 1000, least_load: int = 100) -> bool:
    return has_rows(weather, least_weather) and has_rows(load, least_load)


def batch_profile(obs: DataFrame) -> DataFrame:
    """Active stations and observations."""
    return obs.agg(F.countDistinct("station_id").alias("n_stations"), F.count("*").alias("n_observations"))


def profile_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """For each column the rows, the null or NaN ones, their percentage, the zeros, and whether there is nothing else; in one pass."""
    aggs, kinds = [F.count("*").alias("n")], dict(df.dtypes)
    for i, c in enumerate(cols):
        number = kinds[c] in NUMBERS or kinds[c].startswith("decimal")
        zero = F.coalesce(F.col(c) == 0, F.lit(False)) if number else F.lit(False)
        aggs += [F.sum(missing(c, kinds[c]).cast("long")).alias(f"m{i}"), F.sum(zero.cast("long")).alias(f"z{i}")]
    row = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(f"m{i}", F.lit(0)).alias("n_missing"), F.coalesce(f"z{i}", F.lit(0)).alias("n_zero")) for i, c in enumerate(cols)])
    out = row.select("n", F.explode(entries).alias("e")).select("e.column", "n", "e.n_missing", "e.n_zero")
    pct = F.when(F.col("n") > 0, F.round(100.0 * F.col("n_missing") / F.col("n"), 2))
    return out.withColumns({"missing_pct": pct, "all_missing": F.col("n_missing") == F.col("n")})


def combine_areas(predictions: DataFrame, ts: str = "ts", value: str = "prediction") -> DataFrame:
    """The areas' predictions of a time, summed under the name DK."""
    return predictions.groupBy(ts).agg(F.sum(value).alias(value)).withColumn("dk_area", F.lit("DK"))
