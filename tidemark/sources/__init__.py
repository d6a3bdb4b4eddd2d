"""Reading observations, energy records, API documents, topics and small dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import DK1_STATIONS, DK2_STATIONS, HOURLY_PARAMETERS, STATION_NAMES
from ..functions import date_parts, from_nanos, parse_iso, to_number
from ..operators.filters import check_range, only_parameters

TEXT, NUMBER, WHOLE, LONG, TIME = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


OBSERVATION = record(stationId=TEXT, timeObserved=TEXT, parameterId=TEXT, value=NUMBER, year=WHOLE, month=WHOLE, day=WHOLE)
ENERGY = record(
    HourUTC=TEXT, HourDK=LONG, PriceArea=TEXT, ConnectedArea=TEXT, ViaArea=TEXT, SharePPM=NUMBER, ShareMWh=NUMBER, Updated=TEXT, year=WHOLE, month=WHOLE, day=WHOLE
)
MEASUREMENT = record(time=TIME, value=NUMBER, type=TEXT, metadata=TEXT)
FEATURES = "features array<struct<properties:struct<stationId:string,observed:string,parameterId:string,value:string>>>"
RECORDS = "records array<struct<HourUTC:string,HourDK:string,PriceArea:string,ConnectedArea:string,ViaArea:string,SharePPM:string,ShareMWh:string,Updated:string>>"


def day_pruning(start: datetime | None, end: datetime | None) -> Column:
    """A condition on year, month and day that keeps the partitions of [start, end), so that Spark lists no others. Stores by year and month have no day (null)."""
    month = F.col("year") * 100 + F.col("month")
    number = month * 100 + F.col("day")
    keep = F.lit(True)
    if start:
        keep &= (F.col("year") >= start.year) & (month >= start.year * 100 + start.month)
        keep &= F.col("day").isNull() | (number >= start.year * 10000 + start.month * 100 + start.day)
    if end:
        keep &= (F.col("year") <= end.year) & (month <= end.year * 100 + end.month)
        keep &= F.col("day").isNull() | (number <= end.year * 10000 + end.month * 100 + end.day)
    return keep


def read_observations(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Long observations of [start, end), as station_id, parameter_id, ts, value, year, month, day."""
    if start and end:
        check_range(start, end)
    df = spark.read.schema(OBSERVATION).parquet(path).filter(day_pruning(start, end))
    df = df.select(F.col("stationId").alias("station_id"), F.col("parameterId").alias("parameter_id"), parse_iso("timeObserved").alias("ts"), "value", "year", "month", "day")
    if start:
        df = df.filter(F.col("ts") >= F.lit(start))
    return df.filter(F.col("ts") < F.lit(end)) if end else df


def read_history(spark: SparkSession, path: str, min_year: int = 2021, params: tuple[str, ...] = HOURLY_PARAMETERS) -> DataFrame:
    """Observations since a year of some parameters, with the hour."""
    df = only_parameters(spark.read.schema(OBSERVATION).parquet(path).filter(F.col("year") >= min_year), params, "parameterId")
    return df.select(F.col("stationId").alias("station_id"), F.col("parameterId").alias("parameter_id"), "value", "year", "month", "day", F.hour(parse_iso("timeObserved")).alias("hour"))


def read_energy(spark: SparkSession, path: str, since: datetime | None = None, local_zone: str | None = None) -> DataFrame:
    """Energy records with ts from HourDK, stored by day or by month; HourDK is taken for UTC, or converted from local_zone."""
    df = spark.read.schema(ENERGY).parquet(path).filter(day_pruning(since, None))
    df = df.withColumn("ts", from_nanos("HourDK"))
    if local_zone:
        df = df.withColumn("ts", F.to_utc_timestamp("ts", local_zone))
    return df.filter(F.col("ts") >= F.lit(since)) if since else df


def read_measurements(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """(time, value, type, metadata) from Parquet, or from a database by the options of Spark's jdbc source."""
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load().select(*MEASUREMENT.fieldNames())
    return spark.read.schema(MEASUREMENT).parquet(path)


def read_topic(spark: SparkSession, topic: str, servers: str, starting: str = "latest", **options: str) -> DataFrame:
    """A stream of key, value, topic and timestamp of a topic (needs Spark's Kafka package on the cluster)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", starting).options(**options).load().select("key", "value", "topic", "timestamp")


def decode_value(df: DataFrame, schema: str, avro_schema: str | None = None, value: str = "value") -> DataFrame:
    """Adds the fields of JSON values; with avro_schema first tries Avro behind the registry's 5-byte head (needs Spark's Avro package)."""
    decoded = F.from_json(F.col(value).cast("string"), schema)
    if avro_schema:
        from pyspark.sql.avro.functions import from_avro

        body = F.expr(f"substring({value}, 6)")
        avro = from_avro(body, avro_schema, {"mode": "PERMISSIVE"}).cast(T.StructType.fromDDL(schema))
        decoded = F.when(F.substring(value, 1, 1) == F.lit(b"\x00"), avro).otherwise(decoded)
    return df.withColumn("decoded", decoded).select(*[c for c in df.columns if c != value], "decoded.*")


def normalize_features(df: DataFrame, strict: bool = True) -> DataFrame:
    """Weather documents (features) to observation rows.

    strict drops rows that lack a station, time or parameter; else a row needs its station and time only. A value that is
    no number is null. A document without features gives no rows.
    """
    p = df.select(F.explode("features.properties").alias("p")).select("p.*")
    out = p.select("stationId", F.col("observed").alias("timeObserved"), "parameterId", to_number("value").alias("value"))
    out = out.dropna(subset=["stationId", "timeObserved"] + (["parameterId"] if strict else []))
    parts = date_parts(out.withColumn("ts", parse_iso("timeObserved")), "ts").drop("ts", "hour")
    return parts.select(*OBSERVATION.fieldNames())


def normalize_energy(df: DataFrame, as_strings: bool = False) -> DataFrame:
    """Energy documents (records) to rows.

    For batches HourDK becomes nanoseconds, with year, month and day; as_strings keeps it as text, missing texts
    empty, SharePPM whole.
    """
    r = df.select(F.explode("records").alias("r")).select("r.*")
    names = ("HourUTC", "HourDK", "PriceArea", "ConnectedArea", "ViaArea", "Updated")
    if as_strings:
        texts = {c: F.coalesce(F.col(c), F.lit("")) for c in names}
        return r.withColumns(texts | {"SharePPM": F.col("SharePPM").try_cast("double").cast("long"), "ShareMWh": to_number("ShareMWh")})
    ts = parse_iso("HourDK")
    out = r.withColumns({"SharePPM": to_number("SharePPM"), "ShareMWh": to_number("ShareMWh"), "ts": ts})
    out = date_parts(out, "ts").withColumn("HourDK", F.unix_micros("ts") * 1000)
    return out.select(*ENERGY.fieldNames())


def documents(spark: SparkSession, path: str, schema: str = FEATURES) -> DataFrame:
    """API documents, one JSON object to a file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def station_dim(spark: SparkSession) -> DataFrame:
    """(station_id, dk_area) of the stations known."""
    rows = [(s, "DK1") for s in DK1_STATIONS] + [(s, "DK2") for s in DK2_STATIONS]
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType(), False) for c in ("station_id", "dk_area")]))


def station_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATION_NAMES.items()), "station_id string, name string")


def dimension(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A small metadata file, its format by the name: .csv with a head, .json by lines, else Parquet."""
    if path.endswith(".csv"):
        return spark.read.options(header="true", **options).csv(path)
    return spark.read.options(**options).json(path) if path.endswith(".json") else spark.read.parquet(path)
