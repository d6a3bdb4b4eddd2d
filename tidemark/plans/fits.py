"""Registered queries of the model's stages whose results SQL can work out in full: imputation, scaling, trees of one split, boosting by two of
them and the errors of what they predict; and of the small parts of messages and stations.

A tree of one split over the hour can cut between any two hours, and takes the cut that leaves the least squares, so SQL finds the same one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as f
from .. import sources
from ..fixed import DK1_STATIONS, DK2_STATIONS
from ..operators import joins as J
from . import features, model
from .queries import HOURS_SQL, LOAD_SQL, hours, load, query, rounded, stored, table
from .roundtrips import NAMES

LAST_DAY = 20
_OTHERS = ("n_stations", "month", "hour", "day")
FRAME_SQL = f"""{HOURS_SQL}, {LOAD_SQL}, frame AS (SELECT h.*, round(l.consumption_mwh_area + 1e-9, 6) + 0.0 AS y
    FROM hours h JOIN load l ON l.dk_area = h.dk_area AND l.ts = make_timestamp(h.year, h.month, h.day, h.hour, 0, 0.0)), train AS (SELECT * FROM frame WHERE day <= {LAST_DAY})"""


def _stump(name: str, rows: str, y: str) -> str:
    """The split of rows by hour that leaves the least squares of y, as name(cut, lo, hi)."""
    return f"""{name} AS (SELECT cut, sl / nl AS lo, sr / nr AS hi FROM (
        SELECT cut, sum({y}) FILTER (hour <= cut) AS sl, count(*) FILTER (hour <= cut) AS nl, sum({y}) FILTER (hour > cut) AS sr, count(*) FILTER (hour > cut) AS nr
        FROM {rows}, (SELECT DISTINCT hour AS cut FROM train) WHERE cut < (SELECT max(hour) FROM train) GROUP BY cut
    ) ORDER BY sl * sl / nl + sr * sr / nr DESC, cut LIMIT 1)"""


_STUMP = _stump("one", "train", "y")
_PREDICTED = "CASE WHEN hour <= one.cut THEN one.lo ELSE one.hi END"
_REST = _stump("two", f"(SELECT hour, 2 * (y - {_PREDICTED}) AS e FROM train, one)", "e")
_KEYS = ", ".join(J.HOUR_KEYS)


def frame(spark: SparkSession, d: str) -> DataFrame:
    """Hours of weather and load, rounded as in SQL, with the names of the model's features."""
    return stored(J.training_frame(rounded(hours(spark, d)).withColumnsRenamed(NAMES), rounded(load(spark, d))))


def halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("day") <= LAST_DAY), df.filter(F.col("day") > LAST_DAY)


def stump(train: DataFrame):
    return model.fit_load_model(train, weather=("hour",), calendar=(), trees=1, depth=1, bootstrap=False)


@query(
    f"WITH {FRAME_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, {"CAST(NULL AS DOUBLE)" if x in _OTHERS[1:] else "round(max(m) + 1e-9, 5) + 0.0"} AS fill,
        round(avg(coalesce(x, m)) + 1e-9, 5) + 0.0 AS mean, round(stddev_samp(coalesce(x, m)) + 1e-9, 5) + 0.0 AS deviation
        FROM (SELECT CAST({x} AS DOUBLE) AS x, avg({x}) OVER () AS m FROM train)"""
        for x, name in [*NAMES.items(), *[(c, c) for c in _OTHERS]]
    )
)
def model_learned(spark, d):
    train, _ = halves(frame(spark, d))
    fitted = model.fit_load_model(train, weather=(*NAMES.values(), "n_stations"), trees=2, depth=2)
    out = model.learned(fitted)
    return out.select("feature", *[(F.round(F.col(c) + 1e-9, 5) + F.lit(0.0)).alias(c) for c in ("fill", "mean", "deviation")])


@query(f"WITH {FRAME_SQL}, {_STUMP} SELECT {_KEYS}, round({_PREDICTED} + 1e-9, 5) + 0.0 AS prediction FROM frame, one WHERE day > {LAST_DAY}")
def model_one_split(spark, d):
    train, rest = halves(frame(spark, d))
    return model.score(stump(train), rest, J.HOUR_KEYS).withColumn("prediction", F.round(F.col("prediction") + 1e-9, 5) + F.lit(0.0))


@query(f"WITH {FRAME_SQL}, {_STUMP}, {_REST} SELECT {_KEYS}, round({_PREDICTED} + 0.1 * CASE WHEN hour <= two.cut THEN two.lo ELSE two.hi END + 1e-9, 5) + 0.0 AS prediction FROM frame, one, two WHERE day > {LAST_DAY}")
def model_two_rounds(spark, d):
    """Boosted by two trees of one split: the second one learns what the first has left over, and a tenth of it counts."""
    train, rest = halves(frame(spark, d))
    best = model.tune(train.withColumn("ts", f.hour_of()), features.LOAD, ["hour"], depths=(1,), rounds=(2,), by="ts")
    return model.score(best, rest, J.HOUR_KEYS).withColumn("prediction", F.round(F.col("prediction") + 1e-9, 5) + F.lit(0.0))


@query(f"""WITH {FRAME_SQL}, {_STUMP}, p AS (SELECT y, {_PREDICTED} AS p, avg(y) OVER () AS m FROM frame, one WHERE day > {LAST_DAY})
    SELECT round(sqrt(avg((y - p) ^ 2)) + 1e-9, 5) + 0.0 AS rmse, round(avg(abs(y - p)) + 1e-9, 5) + 0.0 AS mae, round(1 - sum((y - p) ^ 2) / sum((y - m) ^ 2) + 1e-9, 5) + 0.0 AS r2 FROM p""")
def model_errors(spark, d):
    train, rest = halves(frame(spark, d))
    errors = model.evaluate(model.score(stump(train), rest, [*J.HOUR_KEYS, features.LOAD]))
    return spark.range(1).select(*[(F.round(F.lit(v) + 1e-9, 5) + F.lit(0.0)).alias(k) for k, v in errors.items()])


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, CASE WHEN event_id % 4 <> 0 THEN event_type END AS area, value AS consumption, 0.0::DOUBLE AS production, CAST(NULL AS VARCHAR) AS absent FROM events""")
def message_fields(spark, d):
    """Messages written as JSON and taken apart again, by the paths of their fields; a field that is null or not there is null."""
    e = table(spark, d, "events")
    text = F.to_json(F.struct(f.iso_text("ts").alias("timestamp"), F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("dk_area"), f.prediction_json("value").alias("predictions")))
    m = e.select("event_id", text.alias("value"))
    numbers = {"consumption": "predictions.consumption_mwh", "production": "predictions.production_mwh"}
    return m.select(
        "event_id", f.field("value", "timestamp").alias("at"), f.field("value", "dk_area").alias("area"),
        *[f.field("value", p).cast("double").alias(k) for k, p in numbers.items()], f.field("value", "predictions.price").alias("absent"),
    )


def _listed(ids, name: str) -> str:
    return f"SELECT unnest([{', '.join(repr(s) for s in sorted(ids))}]) AS station_id, '{name}' AS dk_area"


@query(f"""WITH s AS ({_listed(DK1_STATIONS, 'DK1')} UNION ALL {_listed(DK2_STATIONS, 'DK2')}), e AS (SELECT '0' || CAST(6000 + user_id % 200 AS VARCHAR) AS station_id, value FROM events)
    SELECT dk_area, count(*) AS n, count(DISTINCT station_id) AS n_stations, round(sum(value) + 1e-9, 4) + 0.0 AS total FROM e JOIN s USING (station_id) GROUP BY dk_area""")
def stations_by_area(spark, d):
    """Users played by numbers of stations, of which the dimension knows some."""
    e = table(spark, d, "events").select(F.concat(F.lit("0"), (6000 + F.col("user_id") % 200).cast("string")).alias("station_id"), "value")
    known = J.with_area(e, sources.station_dim(spark)).groupBy("dk_area")
    return known.agg(F.count("*").alias("n"), F.countDistinct("station_id").alias("n_stations"), (F.round(F.sum("value") + 1e-9, 4) + F.lit(0.0)).alias("total"))
