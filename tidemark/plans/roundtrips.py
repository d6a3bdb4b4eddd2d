"""Registered queries that store what the events say in the layouts of the library and read it back, each with the SQL that says the same.

They cover sources, sinks, streams, maintenance and the model's storage; see queries for how events play the observations.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as f
from .. import sources, streaming
from ..streaming import ledger, state
from ..fixed import WEATHER_FEATURES
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import maintenance as X
from ..operators import rollups as R
from ..operators import series as S
from ..operators import sinks
from ..session import scratch
from . import features, model
from .queries import AREA_SQL, BATCH_ROWS, BUCKETS_SQL, END, LOAD_SQL, PARAMS, PARTS_SQL, START, area, buckets, hours, in_files, load, load_ts, measurements, query, rounded, stored, table

NOW = datetime(2024, 1, 30)
_RANGE = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
_DAYS = "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day"


def weather_documents(spark: SparkSession, d: str) -> DataFrame:
    """Each event as a document of an API; some lack their station, some their parameter."""
    properties = F.struct(
        F.when(F.col("user_id") % 11 != 0, F.col("user_id").cast("string")).alias("stationId"),
        f.iso_text("ts").alias("observed"),
        F.when(F.col("event_id") % 13 != 0, F.col("event_type")).alias("parameterId"),
        F.when(F.col("event_id") % 7 != 0, F.col("value").cast("string")).otherwise("bad").alias("value"),
    )
    return table(spark, d, "events").select(F.array(F.struct(properties.alias("properties"))).alias("features"))


def energy_documents(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    fields = {"HourUTC": f.iso_text("ts"), "HourDK": f.iso_text("ts"), "PriceArea": area(), "ConnectedArea": F.col("event_type"), "ViaArea": F.lit(None).cast("string"), "SharePPM": text("user_id"), "ShareMWh": text("value"), "Updated": F.lit(None).cast("string")}
    return table(spark, d, "events").select(F.array(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("records"))


def observed(spark: SparkSession, d: str) -> str:
    """The path of the events as stored observations, by day."""
    path = scratch(spark)
    sinks.write_daily(sources.normalize_features(weather_documents(spark, d)), path)
    return path


_OBSERVED = f"""observed AS (SELECT CAST(user_id AS VARCHAR) AS station_id, event_type AS parameter_id, date_trunc('second', ts) AS ts,
    CASE WHEN event_id % 7 <> 0 THEN value END AS value, {_DAYS} FROM events WHERE user_id % 11 <> 0 AND event_id % 13 <> 0)"""


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query(f"WITH {_OBSERVED} SELECT * FROM observed WHERE {_RANGE}")
def observations_read(spark, d):
    return ntz(sources.read_observations(spark, observed(spark, d), START, END), "ts")


@query(f"WITH {_OBSERVED} SELECT station_id, parameter_id, value, year, month, day, CAST(hour(ts) AS INTEGER) AS hour FROM observed WHERE parameter_id IN ('click', 'view') AND year >= 2024")
def history_read(spark, d):
    return sources.read_history(spark, observed(spark, d), 2024, ("click", "view"))


@query(f"WITH {_OBSERVED} SELECT station_id, parameter_id, ts, value FROM observed WHERE day = 9 AND month = 1 AND year = 2024 AND parameter_id IN ('error', 'signup')")
def observations_of_a_day(spark, d):
    day = P.prune_day(sources.read_observations(spark, observed(spark, d)), date(2024, 1, 9))
    return ntz(P.only_parameters(day, ("error", "signup")), "ts").select("station_id", "parameter_id", "ts", "value")


@query("""SELECT CAST(user_id AS VARCHAR) AS "stationId", strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timeObserved", CASE WHEN event_id % 13 <> 0 THEN event_type END AS "parameterId",
    CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events WHERE user_id % 11 <> 0""")
def features_live(spark, d):
    return sources.normalize_features(weather_documents(spark, d), strict=False).select("stationId", "timeObserved", "parameterId", "value")


_ENERGY = f"""energy AS (SELECT {AREA_SQL} AS "PriceArea", event_type AS "ConnectedArea", CAST(user_id AS DOUBLE) AS "SharePPM", value AS "ShareMWh", date_trunc('second', ts) AS ts, {_DAYS} FROM events)"""


@query(f"""WITH {_ENERGY} SELECT * FROM energy WHERE ts >= TIMESTAMP '{START}'""")
def energy_read(spark, d):
    path = scratch(spark)
    sinks.write_daily(sources.normalize_energy(energy_documents(spark, d)), path)
    out = sources.read_energy(spark, path, since=START)
    return ntz(out, "ts").select("PriceArea", "ConnectedArea", "SharePPM", "ShareMWh", "ts", "year", "month", "day")


@query(f"""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "HourDK", coalesce({AREA_SQL}, '') AS "PriceArea", '' AS "ViaArea", CAST(user_id AS BIGINT) AS "SharePPM", value AS "ShareMWh" FROM events""")
def energy_live(spark, d):
    out = sources.normalize_energy(energy_documents(spark, d), as_strings=True)
    return out.select("HourDK", "PriceArea", "ViaArea", "SharePPM", "ShareMWh")


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"SELECT CAST(user_id AS VARCHAR) AS station_id, event_type AS parameter_id, date_trunc('second', ts) AS ts, value, {_DAYS} FROM events WHERE {_RANGE}")
def landed_observations(spark, d):
    root = scratch(spark)
    rows = event_stream(spark, d).select(F.col("user_id").cast("string").alias("stationId"), f.iso_text("ts").alias("timeObserved"), F.col("event_type").alias("parameterId"), "value", "ts")
    streaming.land_observations(rows, f"{root}/out", f"{root}/state", once=True).awaitTermination()
    return ntz(sources.read_observations(spark, f"{root}/out", START, END), "ts")


@query(f"""WITH {_ENERGY} SELECT "PriceArea", "ShareMWh", ts FROM energy WHERE ts >= TIMESTAMP '{START}'""")
def landed_energy(spark, d):
    root = scratch(spark)
    nanos = (F.unix_micros(F.date_trunc("second", "ts")) * 1000).alias("HourDK")
    rows = event_stream(spark, d).select(nanos, area().alias("PriceArea"), F.col("value").alias("ShareMWh"), "ts")
    streaming.land_energy(rows, f"{root}/out", f"{root}/state", once=True).awaitTermination()
    return ntz(sources.read_energy(spark, f"{root}/out", since=START), "ts").select("PriceArea", "ShareMWh", "ts")


@query("SELECT date_trunc('hour', ts) AS timestamp, round(sum(value) + 1e-9, 6) + 0.0 AS value FROM events GROUP BY ALL")
def landed_predictions(spark, d):
    root = scratch(spark)
    rows = event_stream(spark, d).select(f.iso_text(f.time_bucket("ts", "1 hour")).alias("timestamp"), F.struct(F.col("value").alias("consumption_mwh")).alias("predictions"))
    streaming.land_predictions(rows, f"{root}/out", f"{root}/state", once=True).awaitTermination()
    points = streaming.message_points(spark.read.text(f"{root}/out"), "predicted")
    return rounded(ntz(points, "timestamp").groupBy("timestamp").agg(F.sum("value").alias("value")))


@query("SELECT event_type AS type, count(*) AS n, min(ts) AS first, max(ts) AS last FROM events GROUP BY ALL")
def measurements_read(spark, d):
    path = scratch(spark)
    measurements(spark, d).withColumn("time", F.col("time").cast("timestamp")).write.parquet(path)
    return ntz(sources.read_measurements(spark, path).groupBy("type").agg(F.count("*").alias("n"), F.min("time").alias("first"), F.max("time").alias("last")), "first", "last")


@query("SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def customers_by_dimension(spark, d):
    path = scratch(spark) + ".csv"
    table(spark, d, "nation").select("n_nationkey", "n_name").write.option("header", "true").csv(path)
    nations = sources.dimension(spark, path).withColumn("c_nationkey", F.col("n_nationkey").cast("bigint"))
    return table(spark, d, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")).join(J.small(nations), "c_nationkey").groupBy("n_name").agg(F.count("*").alias("n_customers"))


@query(f"WITH {BUCKETS_SQL} SELECT dk_area, hour, minute_bucket, click, view, CAST(NULL AS DOUBLE) AS temp_soil, n_stations, 0 AS predicted, year, month, day FROM buckets")
def stored_aggregates(spark, d):
    out = A.to_store(buckets(spark, d), ("click", "view", "temp_soil"), J.BUCKET_KEYS)
    return rounded(stored(out, *sinks.DAY))


@query(f"WITH {BUCKETS_SQL} SELECT dk_area, year, month, day, hour, minute_bucket FROM buckets WHERE minute_bucket = 0")
def prediction_log(spark, d):
    path = scratch(spark)
    sinks.log_predictions(buckets(spark, d).filter("minute_bucket = 0"), path)
    return spark.read.parquet(path).filter("predicted_at is not null").select(*J.BUCKET_KEYS)


@query(f"""WITH {LOAD_SQL} SELECT (SELECT count(*) > 0 FROM events) AS any_row, (SELECT count(*) FROM events) >= 1000 AND (SELECT count(*) FROM load) >= 100 AS enough,
    (SELECT count(*) FROM events) >= 100000000 AS huge""")
def volume_gates(spark, d):
    events = table(spark, d, "events")
    gates = {"any_row": A.has_rows(events), "enough": A.enough_data(events, load(spark, d)), "huge": A.has_rows(events, 100_000_000)}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in gates.items()])


@query(f"WITH {LOAD_SQL} SELECT dk_area, CAST(epoch(ts) AS BIGINT) AS epoch, year(ts) AS year FROM load")
def hour_epochs(spark, d):
    return load(spark, d).select("dk_area", f.hour_epoch().alias("epoch"), F.col("year").cast("bigint").alias("year"))


_HOURLY = """SELECT time_bucket(INTERVAL '{width}', ts) AS timestamp, event_type AS type, round(avg(value) + 1e-9, 6) + 0.0 AS value, min(value) AS min, max(value) AS max, count(value) AS count
    FROM events WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}' {more} GROUP BY ALL"""


def rolled_up(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    by_day = lambda df: stored(df.withColumn("day", F.to_date("bucket")).hint("rebalance", "day"), "day")
    fine = by_day(R.moments(measurements(spark, d), "5 minutes"))
    hours = by_day(R.coarser_moments(fine, "1 hour"))
    return {"5 minutes": fine, "1 hour": hours, "1 day": by_day(R.coarser_moments(hours, "1 day"))}


@query(_HOURLY.format(width="1 hour", start=START, end=END, more="AND event_type = 'view'"))
def historical_hours_rolled_up(spark, d):
    return rounded(R.from_rollups(rolled_up(spark, d), measurements(spark, d), START, END, "view", "1 hour"))


@query(_HOURLY.format(width="1 day", start=START, end=END, more=""))
def historical_days_rolled_up(spark, d):
    return rounded(R.from_rollups(rolled_up(spark, d), measurements(spark, d), START, END))


ODD_START, ODD_END = datetime(2024, 1, 5, 3, 17, 42), datetime(2024, 1, 19, 22, 41, 9)


@query(_HOURLY.format(width="1 hour", start=ODD_START, end=ODD_END, more="").replace("count(value)", "count(*)"))
def history_of_odd_hours(spark, d):
    """Edges off the grid: raw rows up to the next 5 minutes, 5 minutes up to the next hour, then hours."""
    return rounded(R.from_rollups(rolled_up(spark, d), measurements(spark, d), ODD_START, ODD_END, None, "1 hour"))


@query(_HOURLY.format(width="1 month", start=ODD_START, end="2024-02-01 00:00:00.5", more="").replace("count(value)", "count(*)"))
def history_of_odd_months(spark, d):
    return rounded(R.from_rollups(rolled_up(spark, d), measurements(spark, d), ODD_START, datetime(2024, 2, 1, 0, 0, 0, 500_000), None, "1 month"))


@query(f"""SELECT event_type AS type, round(avg(value) + 1e-9, 6) + 0.0 AS avg, min(value) AS min, max(value) AS max, round(stddev_samp(value) + 1e-9, 6) + 0.0 AS stddev, count(*) AS count
    FROM events WHERE ts >= TIMESTAMP '{ODD_START}' AND ts < TIMESTAMP '{ODD_END}' GROUP BY ALL""")
def stats_of_odd_range(spark, d):
    """Deviations from the moments of roll-ups."""
    return rounded(R.stats_from_rollups(rolled_up(spark, d), measurements(spark, d), ODD_START, ODD_END))


@query("""WITH m AS (SELECT date_trunc('second', ts) AS time, event_type AS type, max(value) AS value FROM events GROUP BY ALL)
    SELECT '{w}' AS width, time_bucket(INTERVAL '5 minutes', time) AS bucket, type, count(*) AS rows, round(sum(value), 4) + 0.0 AS sum, round(coalesce(stddev_pop(value), 0) + 1e-9, 6) + 0.0 AS std, min(value) AS min, max(value) AS max FROM m GROUP BY ALL
    UNION ALL SELECT '1 hour', date_trunc('hour', time), type, count(*), round(sum(value), 4) + 0.0, round(coalesce(stddev_pop(value), 0) + 1e-9, 6) + 0.0, min(value), max(value) FROM m GROUP BY ALL
    UNION ALL SELECT '1 day', date_trunc('day', time), type, count(*), round(sum(value), 4) + 0.0, round(coalesce(stddev_pop(value), 0) + 1e-9, 6) + 0.0, min(value), max(value) FROM m GROUP BY ALL""".replace("{w}", "5 minutes"))  # fmt: skip
def rollups_refreshed(spark, d):
    """Measurements come in two batches: the greatest values late, with rows that come again. After each the dirty buckets that are closed are made anew, in the end all."""
    rows = measurements(spark, d).select(F.date_trunc("second", F.col("time").cast("timestamp")).alias("time"), "value", "type", "event_id")
    root = scratch(spark)
    store = R.RollupStore(spark, f"{root}/rolled")
    late = F.coalesce(F.col("value") > 50, F.lit(False))
    batches = (rows.filter(~late), rows.filter(late | (F.col("event_id") % 50 == 0)))
    newest = rows.agg(F.max("time")).first()[0] or NOW
    for batch, now in zip(batches, (datetime(2024, 1, 20), max(datetime(2025, 1, 1), newest + timedelta(days=3))), strict=True):
        # of a batch and of what is stored the greatest value of a time and type counts: late rows win, and a smaller one that comes again changes nothing
        sinks.upsert_measurements(batch.drop("event_id"), f"{root}/raw", ordered=True)
        store.note(batch)
        store.refresh(sources.read_measurements(spark, f"{root}/raw"), now)
    out = [df.select(F.lit(w).alias("width"), "bucket", "type", "rows", F.round("sum", 4) + F.lit(0.0), F.round(F.sqrt(F.coalesce(F.try_divide("m2", "count"), F.lit(0.0))) + 1e-9, 6) + F.lit(0.0), "min", "max").toDF("width", "bucket", "type", "rows", "sum", "std", "min", "max") for w, df in store.rollups().items()]
    return ntz(out[0].unionByName(out[1]).unionByName(out[2]), "bucket")


@query(f"""SELECT dk_area, CAST(count(DISTINCT user_id) AS BIGINT) AS n_sources, 'odd hours' AS span FROM (SELECT *, {AREA_SQL} AS dk_area FROM events) WHERE dk_area IS NOT NULL AND ts >= TIMESTAMP '2024-01-05 03:00:00' AND ts < TIMESTAMP '2024-01-05 14:00:00' GROUP BY ALL
    UNION ALL SELECT dk_area, count(DISTINCT user_id), 'all' FROM (SELECT *, {AREA_SQL} AS dk_area FROM events) WHERE dk_area IS NOT NULL GROUP BY ALL""")
def distinct_sources_of_spans(spark, d):
    """From hourly bitmaps: a span of hours, and all, by way of days."""
    obs = table(spark, d, "events").select("user_id", "ts", area().alias("dk_area")).filter("dk_area is not null")
    bits = stored(R.source_bits(obs, "user_id", ["dk_area"], "1 hour"))
    some = R.distinct_sources(bits, ["dk_area"], datetime(2024, 1, 5, 3), datetime(2024, 1, 5, 14)).withColumn("span", F.lit("odd hours"))
    return some.unionByName(R.distinct_sources(R.coarser_bits(bits, ["dk_area"], "1 day"), ["dk_area"]).withColumn("span", F.lit("all")))


@query("""SELECT ts AS time, value, type FROM (SELECT *, CASE event_type WHEN 'error' THEN 'actual' WHEN 'view' THEN 'predicted' END AS type FROM events)
    WHERE type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY type ORDER BY ts DESC, event_id DESC) <= 100 AND ts >= TIMESTAMP '2024-01-28'""")
def hydrated(spark, d):
    kind = F.when(F.col("type") == "error", "actual").when(F.col("type") == "view", "predicted")
    return streaming.hydrate(measurements(spark, d).withColumn("type", kind), now=NOW, ties=("event_id",)).select("time", "value", "type")


@query(f"""WITH {LOAD_SQL}, j AS (SELECT consumption_mwh_area AS y, lag(consumption_mwh_area, 24) OVER (PARTITION BY dk_area ORDER BY ts) AS x FROM load)
    SELECT round(sqrt(avg((y - x) ^ 2)) + 1e-9, 6) + 0.0 AS rmse, round(avg(abs(y - x)) + 1e-9, 6) + 0.0 AS mae, round(1 - sum((y - x) ^ 2) / sum((y - m) ^ 2) + 1e-9, 6) + 0.0 AS r2
    FROM j, (SELECT avg(y) AS m FROM j WHERE x IS NOT NULL) WHERE x IS NOT NULL""")
def naive_forecast_errors(spark, d):
    from ..operators.windows import row_lags

    lagged = row_lags(load_ts(spark, d), features.LOAD, [24]).filter("load_lag_24 is not null").withColumnRenamed("load_lag_24", "prediction")
    errors = model.evaluate(stored(lagged))
    return rounded(spark.range(1).select(*[F.lit(v).alias(k) for k, v in errors.items()]))


@query("""SELECT event_id, event_type FROM events WHERE CAST('0x' || substr(md5('42_' || event_id || '_' || event_type), 1, 8) AS BIGINT) < 2147483648""")
def sample_by_hash(spark, d):
    return model.sample_frame(table(spark, d, "events"), 0.5, 42, ["event_id", "event_type"]).select("event_id", "event_type")


@query(f"WITH {LOAD_SQL} SELECT count(*) AS n, TRUE AS in_order, TRUE AS as_wanted FROM load")
def fraction_split_counts(spark, d):
    parts = model.fraction_split(stored(load_ts(spark, d)), "ts", error=0.0)
    each = [p.agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.lit(i).alias("i")) for i, p in enumerate(parts)]
    rows = each[0].unionByName(each[1]).unionByName(each[2])
    wide = rows.agg(F.sum("n").alias("n"), *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in range(3) for c in ("n", "lo", "hi")])
    wanted = [F.abs(F.col(f"n{i}") / F.col("n") - part) < 0.02 for i, part in enumerate((0.70, 0.15, 0.15))]
    return wide.select("n", ((F.col("hi0") < F.col("lo1")) & (F.col("hi1") < F.col("lo2"))).alias("in_order"), (wanted[0] & wanted[1] & wanted[2]).alias("as_wanted"))


@query(f"WITH {LOAD_SQL} SELECT count(*) AS n, TRUE AS as_wanted FROM load")
def random_split_counts(spark, d):
    frame = stored(load(spark, d).drop("day"))
    parts = model.time_split(frame, train_end=2000)  # no row is so old, so the split is at random
    each = [p.select(F.lit(i).alias("i")) for i, p in enumerate(parts)]
    rows = each[0].unionByName(each[1]).unionByName(each[2]).agg(F.count("*").alias("n"), *[F.sum((F.col("i") == i).cast("int")).alias(f"n{i}") for i in range(3)])
    near = [F.abs(F.col(f"n{i}") / F.col("n") - part) < 0.06 for i, part in enumerate((0.8, 0.1, 0.1))]
    return rows.select("n", (near[0] & near[1] & near[2]).alias("as_wanted"))


NAMES = {"click": "temp_dry", "error": "wind_speed", "purchase": "humidity", "signup": "pressure", "view": "cloud_cover"}


def training(spark: SparkSession, d: str) -> DataFrame:
    """The joined frame with the names of the model's features; those that the events don't have are null."""
    frame = J.training_frame(hours(spark, d).withColumnsRenamed(NAMES), load(spark, d))
    return stored(P.ensure_columns(frame, dict.fromkeys(WEATHER_FEATURES, "double")))


_HELD = f"""WITH {LOAD_SQL}, h AS (SELECT DISTINCT {AREA_SQL} AS dk_area, date_trunc('hour', ts) AS ts FROM events WHERE user_id % 5 < 4)
    SELECT count(*) AS n, count(*) AS n_equal, count(*) AS n_in_range FROM h JOIN load USING (dk_area, ts) WHERE day(ts) > 20"""


@query(_HELD)
def model_reload(spark, d):
    """Fitted on the model's own features, stored, loaded as the latest, and scored again; a forest's means stay within the labels it saw."""
    frame, root = training(spark, d), scratch(spark)
    train, rest = frame.filter("day <= 20"), frame.filter("day > 20")
    fitted = model.fit_load_model(train, trees=5, depth=4)
    model.save_model(fitted, root, now=datetime(2024, 1, 1))
    model.save_model(fitted, root, now=datetime(2024, 1, 2))
    again = model.score(model.load_latest_model(spark, root), rest, J.HOUR_KEYS).withColumnRenamed("prediction", "again")
    both = model.score(fitted, rest, J.HOUR_KEYS).join(again, J.HOUR_KEYS)
    bounds = train.agg(F.min(features.LOAD).alias("lo"), F.max(features.LOAD).alias("hi"))  # one row
    both = both.join(F.broadcast(bounds), F.col("prediction").between(F.col("lo"), F.col("hi")), "left")
    same = F.abs(F.col("prediction") - F.col("again")) < 1e-9
    return both.agg(F.count("*").alias("n"), F.count(F.when(same, 1)).alias("n_equal"), F.count("lo").alias("n_in_range"))


@query(_HELD)
def model_tuned(spark, d):
    frame = training(spark, d)
    best = model.tune(frame.filter("day <= 20"), features.LOAD, ["temp_dry", "wind_speed", "hour"], depths=(2,), rounds=(2, 4))
    scored = model.score(best, frame.filter("day > 20"), J.HOUR_KEYS)
    return scored.agg(F.count("*").alias("n"), F.count("prediction").alias("n_equal"), F.count(F.when(~F.isnan("prediction"), 1)).alias("n_in_range"))


@query(f"WITH {BUCKETS_SQL} SELECT dk_area, year, month, day, hour, minute_bucket, click FROM buckets WHERE make_timestamp(year, month, day, hour, minute_bucket, 0.0) >= TIMESTAMP '2024-01-20'")
def written_once(spark, d):
    path = scratch(spark)
    batch = buckets(spark, d).withColumn("bucket", F.make_timestamp("year", "month", "day", "hour", "minute_bucket", F.lit(0)))
    batch = stored(batch)
    write = streaming.write_new(path, partitions=sinks.DAY, fresh="10 days", now=NOW)
    for part in (batch.filter("minute_bucket < 30"), batch, batch):  # a batch that comes again adds nothing
        write(part, 0)
    return rounded(spark.read.parquet(path)).select(*J.BUCKET_KEYS, "click")


@query("""SELECT user_id AS station_id, event_type AS parameter_id, ts, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, ts FROM events) GROUP BY ALL""")
def stream_without_repeats(spark, d):
    root = scratch(spark)
    obs = table(spark, d, "events").select(F.col("user_id").alias("station_id"), F.col("event_type").alias("parameter_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    out = streaming.dedup_stream(in_files(obs, obs, by="ts", rows=4 * BATCH_ROWS), delay="60 days")  # each batch copies the state, so they are larger
    streaming.start(out.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/state", once=True).awaitTermination()
    return ntz(spark.read.schema(out.schema).parquet(f"{root}/out"), "ts").groupBy("station_id", "parameter_id", "ts").agg(F.count("*").alias("n"))


@query("""SELECT * FROM (SELECT user_id AS station_id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, round(avg(value) FILTER (WHERE event_type = 'click') + 1e-9, 6) + 0.0 AS click FROM events GROUP BY 1, 2)
    WHERE bucket + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 20 MINUTE""")
def stream_late_rows(spark, d):
    """Old rows that come again after their windows have closed change nothing."""
    root = scratch(spark)
    obs = table(spark, d, "events").select(F.col("user_id").alias("station_id"), F.col("event_type").alias("parameter_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    newest = S.top_newest(obs, ["ts"], 1)
    late = obs.filter(F.col("ts") < F.lit(START)).withColumn("value", F.col("value") + 1000)
    out = streaming.bucket_stream(in_files(obs, newest.withColumn("parameter_id", F.lit("view")), newest.withColumn("parameter_id", F.lit("view")), late, by="ts"), PARAMS)
    streaming.start(out.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/state", once=True).awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{root}/out").select("station_id", F.col("window.start").alias("bucket"), "click")
    return rounded(ntz(got, "bucket"))


@query("SELECT CAST(day(ts) AS INTEGER) AS day, count(*) AS n, TRUE AS compact FROM events GROUP BY ALL")
def compact_days(spark, d):
    """Many small files to each day become one, and a second run finds nothing to do."""
    path = scratch(spark)
    rows = table(spark, d, "events").withColumn("day", F.day("ts"))
    for part in range(3):
        sinks.append_table(rows.filter(F.col("event_id") % 3 == part).repartition(2), path, ["day"])
    first, second = X.compact(spark, path, keys=["day"]), X.compact(spark, path, keys=["day"])
    out = spark.read.parquet(path)
    few = first and not second and not X.needs_compaction(out, out.select("day").distinct().count())
    return out.groupBy("day").agg(F.count("*").alias("n")).withColumn("compact", F.lit(few))


@query("SELECT event_id, value, event_type FROM events")
def rewritten(spark, d):
    path = scratch(spark)
    X.rewrite_by(table(spark, d, "events").select("event_type", "event_id", "value"), ["event_type"], path)
    return spark.read.parquet(path)


def kept_after(spark: SparkSession, df: DataFrame, keys: list[str], span: str) -> DataFrame:
    path = scratch(spark)
    sinks.append_table(df, path, keys)
    X.expire(spark, path, span, NOW)
    return spark.read.parquet(path)


_KEPT = "SELECT {p} AS layout, count(*) AS n FROM {t} WHERE {w}"


@query(" UNION ALL ".join((
    _KEPT.format(p="'day'", t="events", w="CAST(ts AS DATE) >= DATE '2024-01-20'"),
    _KEPT.format(p="'parts'", t="events", w="CAST(ts AS DATE) >= DATE '2024-01-20'"),
    _KEPT.format(p="'month'", t="orders", w="o_orderdate >= TIMESTAMP '1997-02-01'"))))
def expired(spark, d):
    events = f.date_parts(table(spark, d, "events"), "ts").drop("hour")
    orders = f.date_parts(table(spark, d, "orders"), "o_orderdate").drop("hour", "day")
    kept = {
        "day": kept_after(spark, events.drop("day").withColumn("day", F.to_date("ts")), ["day"], "10 days"),
        "parts": kept_after(spark, events, sinks.DAY, "10 days"),
        "month": kept_after(spark, orders, ["year", "month"], f"{(NOW - datetime(1997, 2, 1)).days} days"),
    }
    counts = [df.agg(F.lit(k).alias("layout"), F.count("*").alias("n")) for k, df in kept.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT date_trunc('hour', ts) AS time, event_type AS type, max(value) AS value FROM events GROUP BY ALL")
def upsert_by_value(spark, d):
    """Without an order the greatest of the other columns wins; the second batch comes by a stream's sink."""
    meas = measurements(spark, d).select(f.time_bucket("time", "1 hour").alias("time"), "type", "value")
    path = scratch(spark)
    sinks.upsert_measurements(meas.filter("value < 40"), path)
    sinks.foreach_upsert(path)(meas, 1)
    return spark.read.parquet(path).select("time", "type", "value")


@query("""SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS key, value FROM events""")
def decoded_messages(spark, d):
    """Messages as bytes, keyed and decoded again."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("station"), f.iso_text("ts").alias("time"), "value")
    sent = sinks.to_messages(rows, ["station", "time"]).withColumn("value", F.col("value").cast("binary"))
    return sources.decode_value(sent, "station bigint, time string, value double").select("key", "value")


LIVE_NOW = datetime(2024, 1, 31)


@query("""WITH m AS (SELECT date_trunc('hour', ts) AS timestamp, CASE event_type WHEN 'error' THEN 'actual' ELSE 'predicted' END AS type, value, event_id,
        CASE WHEN user_id % 5 < 3 THEN 'DK1' WHEN user_id % 5 = 3 THEN 'DK2' END AS dk_area FROM events WHERE event_type IN ('error', 'view')),
    p AS (SELECT type, timestamp, round(sum(value) + 1e-9, 6) + 0.0 AS value, arg_min_null(dk_area, event_id) AS dk_area, count(*) AS n FROM m GROUP BY ALL)
    SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY type ORDER BY timestamp DESC) <= 100""")
def live_newest(spark, d):
    """A stream in several batches, by event_id, so that points change late: the newest 100 of either series, with sums over all batches and the area that came first."""
    kind = F.when(F.col("event_type") == "error", "actual").otherwise("predicted")
    rows = table(spark, d, "events").filter("event_type in ('error', 'view')").select(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"), "value", F.lit(0.0).alias("production"), F.lit(0.0).alias("net_balance"), area().alias("dk_area"), kind.alias("type"), F.col("event_id").cast("long").alias("event_id")
    )
    bounds = rows.agg(F.expr("percentile_approx(event_id, array(0.4, 0.7))")).first()[0]
    batches = rows.filter(F.col("event_id") <= bounds[0]), rows.filter(F.col("event_id").between(bounds[0] + 1, bounds[1])), rows.filter(F.col("event_id") > bounds[1])
    root = scratch(spark)
    out = state.live_points(in_files(*batches, by="event_id"), "event_id", shards=2, keep="400 days", now=LIVE_NOW)
    state.take_all(out.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("append").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/state"))
    newest = state.newest_live(spark.read.schema(out.schema).parquet(f"{root}/out"))
    return rounded(ntz(newest.select("type", "timestamp", "value", "dk_area", "n"), "timestamp"))


@query(f"WITH {BUCKETS_SQL} SELECT dk_area, year, month, day, hour, minute_bucket, click FROM buckets")
def ledger_once(spark, d):
    """A stream of batches, each with rows twice, whose checkpoint is lost: the batches come again and are known by the ledger."""
    path, rows = scratch(spark), stored(buckets(spark, d))
    batches = [rows.filter(F.col("day") % 2 == k) for k in range(2)]
    for lost in ("a", "b"):
        stream = in_files(*[b.unionByName(b) for b in batches])
        writer = stream.writeStream.foreachBatch(ledger.write_once(path, J.BUCKET_KEYS, sinks.DAY)).option("checkpointLocation", f"{path}-{lost}")
        writer.trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.parquet(path)).select(*J.BUCKET_KEYS, "click")


@query("SELECT CAST(day(ts) AS INTEGER) AS day, count(*) AS n, count(DISTINCT event_id) AS n_events, round(sum(value) + 1e-9, 4) + 0.0 AS total FROM events GROUP BY ALL")
def compact_by_size(spark, d):
    """Files of all sizes in days: the small ones are joined, each in its day, and a second run finds none."""
    path = scratch(spark)
    rows = table(spark, d, "events").withColumn("day", F.day("ts"))
    for part in range(2):
        sinks.append_table(rows.filter(F.col("event_id") % 2 == part).repartition(3), path, ["day"])
    X.compact_small(spark, path)
    if X.compact_small(spark, path):
        raise RuntimeError("small files are left")
    total = (F.round(F.sum("value") + 1e-9, 4) + F.lit(0.0)).alias("total")
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_events"), total)
