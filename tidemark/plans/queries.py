"""The registered queries of the time-series library, each with the SQL that says the same.

events plays the observations (a user is a station, an event type a parameter) and the measurements (an event type is a series);
lineitem and orders play longer series. Doubles are rounded to six places, as sums in another order differ beyond; 1e-9 is added before, as a
mean of a power of two of amounts in cents can lie just on the edge.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..functions import bucket10, circular_mean, date_parts, from_nanos, iso_text, time_bucket
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import maintenance as X
from ..operators import series as S
from ..operators import sinks
from ..operators import windows as W
from ..session import scratch
from ..sources import normalize_features
from . import features, model

PARAMS = ("click", "error", "purchase", "signup", "view")
START, END = datetime(2024, 1, 5), datetime(2024, 1, 20)
SPLIT_DAYS = (20, 25)
#: So that the month of hours that the tables have is several slices.
SLICE_ROWS = 250
#: A batch of a stream that is fed in order has about so many rows at most.
BATCH_ROWS = 1_000_000


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(F.col(c) + 1e-9, 6) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def area(user: str = "user_id"):
    return F.when(F.col(user) % 5 < 3, "DK1").when(F.col(user) % 5 == 3, "DK2")


def observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("station_id"), F.col("event_type").alias("parameter_id"), "ts", "value")


def stored(df: DataFrame, *keys: str) -> DataFrame:
    """df written to a new folder and read again."""
    path = scratch(df.sparkSession)
    sinks.append_table(df, path, list(keys))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, by: str, rows: int) -> list[DataFrame]:
    """df in parts of about so many rows, by ranges of a column, the least first. Parts are stored, so each is read once; rows that are equal in by may be in two."""
    n = -(-df.count() // rows)
    if n < 2:
        return [df]
    path, rest = scratch(df.sparkSession), [c for c in df.columns if c != by]
    df.repartitionByRange(n, by, *rest).write.parquet(path)
    files = sorted(df.sparkSession.read.parquet(path).inputFiles(), key=lambda f: f.rpartition("/")[2])  # the names begin with the number of the range
    return [df.sparkSession.read.schema(df.schema).parquet(f) for f in files]


def in_files(df: DataFrame, *parts: DataFrame, by: str | None = None, rows: int | None = None) -> DataFrame:
    """A stream of df, then of each part, a file to a batch. With by a part of more than so many rows becomes several batches, in order of that column: a task has its
    share of one batch, not of the table, and a stream with a watermark lets go of what is past.
    """
    path = scratch(df.sparkSession)
    for p in (df, *parts):
        for x in in_order(p, by, rows or BATCH_ROWS) if by else [p]:
            x.repartition(1).write.mode("append").option("parquet.block.size", 4 << 20).parquet(path)  # small row groups, so that tasks can share a file
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stations(spark: SparkSession, d: str) -> DataFrame:
    """The dimension of stations, stored, so that its size is known without another look at the events."""
    return stored(P.require(table(spark, d, "events").select(F.col("user_id").alias("station_id"), area().alias("dk_area")).distinct(), ["dk_area"]))


def measurements(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("ts").alias("time"), "value", F.col("event_type").alias("type"), F.col("props").alias("metadata"), "event_id")


def shipments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("value"), F.col("l_returnflag").alias("type"))


def load(spark: SparkSession, d: str) -> DataFrame:
    energy = table(spark, d, "events").select(area().alias("PriceArea"), F.col("value").alias("ShareMWh"), "ts")
    return A.consumption_hourly(energy)


def hours(spark: SparkSession, d: str) -> DataFrame:
    return A.area_buckets(observations(spark, d), stations(spark, d), "hour", PARAMS, maxima=("view",), counted="click")


def buckets(spark: SparkSession, d: str) -> DataFrame:
    return A.area_buckets(observations(spark, d), stations(spark, d), "10min", PARAMS, maxima=("view",), counted="click")


def load_ts(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import hour_of

    return load(spark, d).select("dk_area", hour_of().alias("ts"), features.LOAD)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AREA_SQL = "CASE WHEN user_id % 5 < 3 THEN 'DK1' WHEN user_id % 5 = 3 THEN 'DK2' END"
PARTS_SQL = "year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour"
MEANS_SQL = ", ".join(f"avg(value) FILTER (WHERE event_type = '{p}') AS {p}" for p in PARAMS)
ROLL_SQL = ", ".join(f"round({'max' if p == 'view' else 'avg'}({p}) + 1e-9, 6) + 0.0 AS {p}" for p in PARAMS) + ", CAST(count(click) AS INTEGER) AS n_stations"
HOURS_SQL = f"""hours AS (
    SELECT dk_area, year, month, day, hour, {ROLL_SQL} FROM (
        SELECT user_id, {AREA_SQL} AS dk_area, {PARTS_SQL}, {MEANS_SQL} FROM events GROUP BY ALL
    ) WHERE dk_area IS NOT NULL GROUP BY ALL)"""
BUCKETS_SQL = f"""buckets AS (
    SELECT dk_area, year, month, day, hour, minute_bucket, {ROLL_SQL} FROM (
        SELECT user_id, {AREA_SQL} AS dk_area, {PARTS_SQL}, CAST(minute(ts) // 10 * 10 AS INTEGER) AS minute_bucket, {MEANS_SQL} FROM events GROUP BY ALL
    ) WHERE dk_area IS NOT NULL GROUP BY ALL)"""
LOAD_SQL = f"""load AS (
    SELECT {AREA_SQL} AS dk_area, date_trunc('hour', ts) AS ts, sum(value) AS consumption_mwh_area FROM events WHERE user_id % 5 < 4 GROUP BY ALL)"""
INT_PARTS_SQL = "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"WITH {BUCKETS_SQL} SELECT * FROM buckets")
def area_bucket_means(spark, d):
    return rounded(buckets(spark, d))


@query(f"WITH {HOURS_SQL} SELECT * FROM hours")
def area_hourly_means(spark, d):
    return rounded(hours(spark, d))


@query(f"""SELECT {AREA_SQL} AS dk_area, {PARTS_SQL},
    round(avg(CASE WHEN event_type = 'click' THEN value END) + 1e-9, 6) + 0.0 AS click_mean, max(CASE WHEN event_type = 'click' THEN value END) AS click_max,
    min(CASE WHEN event_type = 'click' THEN value END) AS click_min, max(CASE WHEN event_type = 'view' THEN value END) AS view_max,
    count(DISTINCT user_id) AS n_stations, CAST(NULL AS DOUBLE) AS soil_mean
    FROM events WHERE user_id % 5 < 4 GROUP BY ALL""")
def area_hourly_view(spark, d):
    obs = observations(spark, d).withColumn("dk_area", area("station_id")).filter("dk_area is not null")
    measures = {"click_mean": (F.avg, "click"), "click_max": (F.max, "click"), "click_min": (F.min, "click"), "view_max": (F.max, "view")}
    return rounded(A.area_hourly_view(obs, measures, ("soil_mean",)))


@query(f"SELECT {AREA_SQL} AS dk_area, round(avg(sin(radians(value))) + 1e-9, 6) + 0.0 AS dir_sin, round(avg(cos(radians(value))) + 1e-9, 6) + 0.0 AS dir_cos FROM events WHERE user_id % 5 < 4 GROUP BY ALL")
def circular_components(spark, d):
    sin, cos = circular_mean("value")
    return rounded(P.known_area(table(spark, d, "events").withColumn("dk_area", area())).groupBy("dk_area").agg(sin.alias("dir_sin"), cos.alias("dir_cos")))


@query(f"WITH {LOAD_SQL} SELECT dk_area, {PARTS_SQL}, round(consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area FROM load")
def consumption_hourly(spark, d):
    return rounded(load(spark, d))


@query(f"""WITH {LOAD_SQL} SELECT dk_area, ts, round(consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area, round(lag(consumption_mwh_area, 72) OVER w + 1e-9, 6) + 0.0 AS load_lag_72,
    round(lag(consumption_mwh_area, 168) OVER w + 1e-9, 6) + 0.0 AS load_lag_168 FROM load WINDOW w AS (PARTITION BY dk_area ORDER BY ts)""")
def load_lags(spark, d):
    return rounded(W.row_lags(stored(load_ts(spark, d)), features.LOAD, [72, 168], slice_rows=SLICE_ROWS))


@query(f"""WITH {LOAD_SQL} SELECT dk_area, ts, round(consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area,
    round(avg(consumption_mwh_area) OVER (PARTITION BY dk_area ORDER BY ts ROWS BETWEEN 72 PRECEDING AND 1 PRECEDING) + 1e-9, 6) + 0.0 AS load_mean_72h,
    round(avg(consumption_mwh_area) OVER (PARTITION BY dk_area ORDER BY ts ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) + 1e-9, 6) + 0.0 AS load_mean_7d FROM load""")
def load_trailing_means(spark, d):
    return rounded(W.trailing_means(stored(load_ts(spark, d)), features.LOAD, {"load_mean_72h": 72, "load_mean_7d": 168}, slice_rows=SLICE_ROWS))


@query(f"""WITH {LOAD_SQL} SELECT a.dk_area, a.ts, round(a.consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area, round(b.consumption_mwh_area + 1e-9, 6) + 0.0 AS load_lag_72,
    round(c.consumption_mwh_area + 1e-9, 6) + 0.0 AS load_lag_168,
    round((SELECT avg(x.consumption_mwh_area) FROM load x WHERE x.dk_area = a.dk_area AND x.ts < a.ts AND x.ts >= a.ts - INTERVAL 72 HOUR) + 1e-9, 6) + 0.0 AS load_mean_72h
    FROM load a LEFT JOIN load b ON b.dk_area = a.dk_area AND b.ts = a.ts - INTERVAL 72 HOUR LEFT JOIN load c ON c.dk_area = a.dk_area AND c.ts = a.ts - INTERVAL 168 HOUR""")
def load_time_lags(spark, d):
    lagged = W.time_lags(load_ts(spark, d), features.LOAD, [72, 168])
    return rounded(W.time_trailing_mean(lagged, features.LOAD, 72, "load_mean_72h", span="10 days"))


_ROLL = ", ".join(
    f"round({f}(consumption_mwh_area) OVER (PARTITION BY dk_area ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) + 1e-9, 6) + 0.0 AS consumption_mwh_area_{name}_{n}"
    for n in (3, 24, 168) for f, name in (("avg", "mean"), ("stddev_samp", "std"))
)


@query(f"""WITH {LOAD_SQL} SELECT dk_area, ts, round(consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area,
    round(lag(consumption_mwh_area, 1) OVER w + 1e-9, 6) + 0.0 AS consumption_mwh_area_lag_1, round(lag(consumption_mwh_area, 2) OVER w + 1e-9, 6) + 0.0 AS consumption_mwh_area_lag_2,
    round(lag(consumption_mwh_area, 24) OVER w + 1e-9, 6) + 0.0 AS consumption_mwh_area_lag_24, {_ROLL} FROM load WINDOW w AS (PARTITION BY dk_area ORDER BY ts)""")
def rolling_stats(spark, d):
    return rounded(W.row_features(stored(load_ts(spark, d)), features.LOAD, slice_rows=SLICE_ROWS))


_CALENDAR = """round(sin(hour * (2 * pi() / 24)) + 1e-9, 6) + 0.0 AS hour_sin, round(cos(hour * (2 * pi() / 24)) + 1e-9, 6) + 0.0 AS hour_cos,
    round(sin(dayofyear(make_date(year, month, day)) * (2 * pi() / 365)) + 1e-9, 6) + 0.0 AS day_of_year_sin, round(cos(dayofyear(make_date(year, month, day)) * (2 * pi() / 365)) + 1e-9, 6) + 0.0 AS day_of_year_cos,
    CAST(dayofweek(make_date(year, month, day)) AS INTEGER) AS day_of_week, CASE WHEN dayofweek(make_date(year, month, day)) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""


@query(f"WITH {LOAD_SQL} SELECT dk_area, year, month, day, hour, {_CALENDAR} FROM (SELECT dk_area, {PARTS_SQL} FROM load)")
def calendar_features(spark, d):
    return rounded(features.calendar_features(load(spark, d).drop(features.LOAD)))


@query(f"""WITH {HOURS_SQL}, {LOAD_SQL} SELECT h.*, round(l.consumption_mwh_area + 1e-9, 6) + 0.0 AS consumption_mwh_area FROM hours h
    JOIN (SELECT dk_area, {PARTS_SQL}, consumption_mwh_area FROM load) l USING (dk_area, year, month, day, hour)""")
def weather_load_join(spark, d):
    return rounded(J.training_frame(hours(spark, d), load(spark, d)))


@query(f"""WITH {HOURS_SQL}, {LOAD_SQL}, lags AS (
        SELECT dk_area, {PARTS_SQL}, lag(consumption_mwh_area, 72) OVER w AS load_lag_72, lag(consumption_mwh_area, 168) OVER w AS load_lag_168,
            avg(consumption_mwh_area) OVER (PARTITION BY dk_area ORDER BY ts ROWS BETWEEN 72 PRECEDING AND 1 PRECEDING) AS load_mean_72h,
            avg(consumption_mwh_area) OVER (PARTITION BY dk_area ORDER BY ts ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS load_mean_7d
        FROM load WINDOW w AS (PARTITION BY dk_area ORDER BY ts))
    SELECT h.*, {_CALENDAR}, round(load_lag_72 + 1e-9, 6) + 0.0 AS load_lag_72, round(load_lag_168 + 1e-9, 6) + 0.0 AS load_lag_168, round(load_mean_72h + 1e-9, 6) + 0.0 AS load_mean_72h, round(load_mean_7d + 1e-9, 6) + 0.0 AS load_mean_7d
    FROM hours h LEFT JOIN lags USING (dk_area, year, month, day, hour)""")
def lag_join(spark, d):
    return rounded(features.serving_features(hours(spark, d), load(spark, d)))


@query(f"WITH {HOURS_SQL} SELECT * FROM hours WHERE NOT (day <= 15 OR hour % 3 = 0)")
def new_aggregates(spark, d):
    new = stored(hours(spark, d), *sinks.DAY)
    return rounded(J.new_only(new, new.filter("day <= 15 or hour % 3 = 0")))


@query(f"WITH {BUCKETS_SQL} SELECT * FROM buckets WHERE minute_bucket NOT IN (0, 20)")
def unpredicted_buckets(spark, d):
    weather, log = stored(buckets(spark, d), *sinks.DAY), scratch(spark)
    sinks.log_predictions(weather.filter(F.col("minute_bucket").isin(0, 20)), log)
    return rounded(J.unpredicted(weather, spark.read.parquet(log)))


def _history_sql(width: str, where: str = "", table_: str = "events", ts: str = "ts", value: str = "value", kind: str = "event_type") -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', {ts}) AS timestamp, {kind} AS type, round(avg({value}) + 1e-9, 6) + 0.0 AS value, min({value}) AS min, max({value}) AS max, count(*) AS count
        FROM {table_} {where} GROUP BY ALL"""


_IN_RANGE = f"WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"


@query(_history_sql("5 minutes", f"{_IN_RANGE} AND event_type = 'view'"))
def historical_5min(spark, d):
    return rounded(S.historical(measurements(spark, d), START, END, "view", "5 minutes"))


@query(_history_sql("1 day", _IN_RANGE))
def historical_auto(spark, d):
    return rounded(S.historical(measurements(spark, d), START, END))


@query(_history_sql("1 hour", "WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-20'"))
def historical_week(spark, d):
    return rounded(S.historical(measurements(spark, d), range="1w", now=END))


def _rollup_sql(width: str, table_: str = "events", ts: str = "ts", value: str = "value", kind: str = "event_type") -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', {ts}) AS bucket, {kind} AS type, round(sum({value}), 4) + 0.0 AS sum, count({value}) AS count,
        min({value}) AS min, max({value}) AS max, round(avg({value}) + 1e-9, 6) + 0.0 AS avg FROM {table_} GROUP BY ALL"""


def _rolled(df: DataFrame) -> DataFrame:
    return rounded(df).withColumn("sum", F.round("sum", 4) + F.lit(0.0))


@query(_rollup_sql("5 minutes"))
def rollup_5min(spark, d):
    return _rolled(S.rollup(measurements(spark, d), "5 minutes"))


@query(_rollup_sql("1 hour"))
def rollup_1h(spark, d):
    return _rolled(S.coarser(S.rollup(measurements(spark, d), "5 minutes"), "1 hour"))


@query(_rollup_sql("1 day"))
def rollup_1day(spark, d):
    fine = S.rollup(measurements(spark, d), "1 hour")
    return _rolled(S.coarser(S.refresh_rollup(fine, measurements(spark, d), START, END, "1 hour"), "1 day"))


@query(_rollup_sql("1 day", "lineitem", "l_shipdate", "l_extendedprice", "l_returnflag"))
def shipment_rollup_1day(spark, d):
    return _rolled(S.rollup(shipments(spark, d), "1 day"))


@query("""SELECT date_trunc('month', o_orderdate) AS month, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def orders_by_nation_month(spark, d):
    customers = table(spark, d, "customer").join(J.small(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    month = time_bucket("o_orderdate", "1 month").cast("timestamp_ntz").alias("month")
    joined = table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(month, "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _stats_sql(table_: str, ts: str, value: str, kind: str, where: str) -> str:
    return f"""SELECT {kind} AS type, round(avg({value}) + 1e-9, 6) + 0.0 AS avg, min({value}) AS min, max({value}) AS max, round(stddev_samp({value}) + 1e-9, 6) + 0.0 AS stddev, count(*) AS count
        FROM {table_} {where} GROUP BY ALL"""


@query(_stats_sql("events", "ts", "value", "event_type", _IN_RANGE))
def series_stats(spark, d):
    return rounded(S.stats(measurements(spark, d), START, END))


@query(_stats_sql("lineitem", "l_shipdate", "l_extendedprice", "l_returnflag", "WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'"))
def shipment_stats(spark, d):
    return rounded(S.stats(shipments(spark, d), datetime(1995, 1, 1), datetime(1997, 1, 1)))


_ALIGNED = """aligned AS (SELECT date_trunc('hour', ts) AS timestamp, avg(value) FILTER (WHERE event_type = 'purchase') AS purchase, avg(value) FILTER (WHERE event_type = 'view') AS view
    FROM events WHERE event_type IN ('purchase', 'view') GROUP BY ALL)"""


def _aligned(spark, d):
    meas = measurements(spark, d).filter(F.col("type").isin("purchase", "view"))
    return S.align_series(meas, ("purchase", "view"), time_bucket("time", "1 hour"))


@query(f"WITH {_ALIGNED} SELECT timestamp, round(purchase + 1e-9, 6) + 0.0 AS purchase, round(view + 1e-9, 6) + 0.0 AS view FROM aligned")
def aligned_series(spark, d):
    return rounded(_aligned(spark, d))


@query(f"""WITH {_ALIGNED}, k AS (SELECT avg(purchase) AS actual_mean, avg(view) AS predicted_mean, arg_max(purchase, timestamp) FILTER (WHERE purchase IS NOT NULL) AS actual_last,
    arg_max(view, timestamp) FILTER (WHERE view IS NOT NULL) AS predicted_last FROM aligned)
    SELECT round(actual_mean + 1e-9, 6) + 0.0 AS actual_mean, round(predicted_mean + 1e-9, 6) + 0.0 AS predicted_mean, round(actual_last + 1e-9, 6) + 0.0 AS actual_last, round(predicted_last + 1e-9, 6) + 0.0 AS predicted_last,
        round((nullif(predicted_last, 0) - nullif(actual_last, 0)) / nullif(actual_last, 0) * 100, 1) AS variance_pct FROM k""")
def series_kpis(spark, d):
    return rounded(S.kpis(_aligned(spark, d), "purchase", "view"))


@query("SELECT ts AS time, value, event_type AS type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 100")
def newest_points(spark, d):
    return S.newest(measurements(spark, d), ["type"], 100, ties=("event_id",)).select("time", "value", "type", "event_id")


@query("SELECT * FROM (SELECT ts AS time, value, event_type AS type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 100) WHERE time >= TIMESTAMP '2024-01-28'")
def latest_points(spark, d):
    return S.latest_points(measurements(spark, d), "error", 100, datetime(2024, 1, 30), "48 hours", ("event_id",)).select("time", "value", "type")


@query("SELECT ts, event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def top_newest(spark, d):
    return S.top_newest(table(spark, d, "events").select("ts", "event_id", "value"), ["ts", "event_id"], 5)


@query("SELECT date_trunc('hour', ts) AS ts, round(sum(value) + 1e-9, 6) + 0.0 AS prediction, 'DK' AS dk_area FROM events GROUP BY ALL")
def combined_areas(spark, d):
    rows = table(spark, d, "events").select(time_bucket("ts", "1 hour").alias("ts"), F.col("value").alias("prediction"))
    return rounded(A.combine_areas(rows))


@query("""SELECT 'DK_' || strftime(h, '%Y-%m-%d %H:%M:%S') AS key, strftime(h, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, round(v + 1e-9, 6) + 0.0 AS consumption_mwh, 0.0::DOUBLE AS production_mwh
    FROM (SELECT date_trunc('hour', ts) AS h, sum(value) AS v FROM events GROUP BY ALL)""")
def prediction_messages(spark, d):
    rows = table(spark, d, "events").select(time_bucket("ts", "1 hour").alias("ts"), F.col("value").alias("prediction"))
    m = model.prediction_messages(rows)
    f = lambda p: F.get_json_object("value", f"$.{p}")
    return rounded(m.select("key", f("timestamp").alias("timestamp"), f("predictions.consumption_mwh").cast("double").alias("consumption_mwh"), f("predictions.production_mwh").cast("double").alias("production_mwh")))


_PROFILED = ("value", "user_id", "bucket")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count(*) FILTER (WHERE x IS NULL) AS n_missing, count(*) FILTER (WHERE x = 0) AS n_zero,
        round(100.0 * count(*) FILTER (WHERE x IS NULL) / count(*), 2) AS missing_pct, count(x) = 0 AS all_missing FROM (SELECT {e} AS x FROM events)"""
    for c, e in (("value", "CASE WHEN event_id % 7 <> 0 THEN value END"), ("user_id", "user_id % 10"), ("bucket", "CAST(NULL AS DOUBLE)"))))
def column_profile(spark, d):
    df = table(spark, d, "events").select(F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"), (F.col("user_id") % 10).alias("user_id"), F.lit(None).cast("double").alias("bucket"))
    return A.profile_columns(df, list(_PROFILED))


@query(f"""WITH {LOAD_SQL} SELECT CASE WHEN year(ts) <= 2023 THEN 'train' END AS part, count(*) AS n FROM load WHERE year(ts) <= 2023 GROUP BY ALL
    UNION ALL SELECT part, count(*) FROM (SELECT CASE WHEN year(l_shipdate) <= 1995 THEN 'train' WHEN year(l_shipdate) = 1996 AND month(l_shipdate) <= 10 THEN 'val' WHEN year(l_shipdate) = 1996 AND month(l_shipdate) = 11 THEN 'test' END AS part FROM lineitem)
    WHERE part IS NOT NULL GROUP BY ALL""")
def time_split_counts(spark, d):
    df = date_parts(shipments(spark, d), "time")
    parts = model.time_split(df, 1995, 1996, 10, 11)
    named = [p.select(F.lit(n).alias("part")) for n, p in zip(("train", "val", "test"), parts, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2]).groupBy("part").agg(F.count("*").alias("n"))


@query("""SELECT CAST(user_id AS VARCHAR) AS "stationId", strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timeObserved", event_type AS "parameterId", TRY_CAST(props ->> '$.k' AS DOUBLE) AS value,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events WHERE user_id % 11 <> 0""")
def feature_normalise(spark, d):
    props = F.struct(
        F.when(F.col("user_id") % 11 != 0, F.col("user_id").cast("string")).alias("stationId"),
        iso_text("ts").alias("observed"),
        F.col("event_type").alias("parameterId"),
        F.get_json_object("props", "$.k").alias("value"),
    )
    return normalize_features(table(spark, d, "events").select(F.array(F.struct(props.alias("properties"))).alias("features")))


@query("SELECT date_trunc('hour', ts) AS time, event_type AS type, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def upsert_latest(spark, d):
    meas = measurements(spark, d).withColumn("time", time_bucket("time", "1 hour"))
    path = scratch(spark)
    sinks.upsert_measurements(meas.filter("event_id % 2 = 0"), path, ("event_id",))
    newer = meas.unionByName(spark.read.parquet(path).select(*meas.columns))
    sinks.upsert_measurements(newer, path, ("event_id",))
    return spark.read.parquet(path).select("time", "type", "value")


@query("SELECT count(DISTINCT user_id) AS n_stations, count(*) AS n_observations FROM events")
def batch_profile(spark, d):
    return A.batch_profile(observations(spark, d))


@query("SELECT min(ts) AS first, max(ts) AS latest FROM events")
def latest_time(spark, d):
    return A.latest_time(table(spark, d, "events"))


@query("SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS key, CASE WHEN event_id % 5 <> 0 THEN value END AS value, CAST(NULL AS VARCHAR) AS quality FROM events")
def replay_messages(spark, d):
    bad = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    m = sinks.replay(table(spark, d, "events").withColumn("value", bad), ["station", "time", "value", "quality"], {"user_id": "station", "ts": "time"})
    return m.select("key", F.get_json_object("value", "$.value").cast("double").alias("value"), F.get_json_object("value", "$.quality").alias("quality"))


@query("SELECT event_id, date_trunc('second', ts) AS ts, CAST(minute(ts) // 10 * 10 AS INTEGER) AS minute_bucket FROM events")
def energy_times(spark, d):
    df = table(spark, d, "events").select("event_id", (F.unix_seconds(F.col("ts").cast("timestamp")) * 1_000_000_000 + 999).alias("nanos"))
    ts = from_nanos("nanos").cast("timestamp_ntz")
    return df.select("event_id", F.date_trunc("second", ts).cast("timestamp_ntz").alias("ts"), bucket10(ts).alias("minute_bucket"))


@query("""SELECT date_trunc('hour', ts) AS timestamp, 'actual' AS type, round(sum(CASE WHEN event_id % 3 = 0 THEN coalesce(nullif(value, 0), 0) ELSE coalesce(nullif(value * 2, 0), 0) END) + 1e-9, 6) + 0.0 AS value,
    0.0::DOUBLE AS production, 0.0::DOUBLE AS net_balance, min(CASE WHEN event_id % 3 = 0 THEN 'DK1' ELSE 'DK2' END) AS dk_area FROM events GROUP BY ALL""")
def live_sums(spark, d):
    e = table(spark, d, "events").withColumn("h", iso_text(time_bucket("ts", "1 hour")))
    first = F.to_json(F.struct(F.col("h").alias("timestamp"), F.col("value").alias("total_consumption_mwh"), F.lit("DK1").alias("dk_area")))
    other = F.to_json(F.struct(F.lit("").alias("timestamp"), F.col("h").alias("HourUTC"), (F.col("value") * 2).alias("ShareMWh"), F.lit("DK2").alias("PriceArea")))
    points = streaming.message_points(e.select(F.when(F.col("event_id") % 3 == 0, first).otherwise(other).alias("value")), "actual")
    out = streaming.live_series(points, keep="24 hours", now=datetime(2024, 1, 1))
    return rounded(out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


@query(f"WITH {HOURS_SQL} SELECT year, month, day, count(*) AS n FROM hours GROUP BY ALL")
def daily_roundtrip(spark, d):
    path = scratch(spark)
    sinks.write_daily(hours(spark, d), path)
    sinks.append_new(hours(spark, d), path, J.HOUR_KEYS, sinks.DAY)
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def compact_roundtrip(spark, d):
    path = scratch(spark)
    table(spark, d, "events").repartition(24).write.parquet(path)
    X.compact(spark, path, 4)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH b AS (SELECT {AREA_SQL} AS dk_area, time_bucket(INTERVAL '10 minutes', ts) AS bucket, {ROLL_SQL} FROM (
        SELECT user_id, time_bucket(INTERVAL '10 minutes', ts) AS ts, {MEANS_SQL} FROM events GROUP BY ALL) WHERE user_id % 5 < 4 GROUP BY ALL)
    SELECT * FROM b WHERE bucket + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 20 MINUTE""")
def stream_area_buckets(spark, d):
    obs = observations(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = streaming.area_stream(in_files(obs, by="ts"), stations(spark, d), PARAMS, maxima=("view",), counted="click")
    root = scratch(spark)
    streaming.start(out.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/state", once=True).awaitTermination()
    return rounded(spark.read.schema(out.schema).parquet(f"{root}/out").withColumn("bucket", F.col("bucket").cast("timestamp_ntz")))


@query()
def sample_frame(spark, d):
    return model.sample_frame(rounded(J.training_frame(hours(spark, d), load(spark, d))), 0.5, 42)


@query()
def model_scores(spark, d):
    frame = J.training_frame(hours(spark, d), load(spark, d))
    train = frame.filter(F.col("day") <= SPLIT_DAYS[0])
    fitted = model.fit_load_model(train, weather=(*PARAMS, "n_stations"), trees=10, depth=5)
    return model.score(fitted, frame.filter(F.col("day") > SPLIT_DAYS[0]), J.HOUR_KEYS)
