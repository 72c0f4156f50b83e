"""JSON feeds and the raw landing layer.

* ``land_*`` - keep every record as JSON text with its city and source
  (append-only; written partitioned by city by ``sinks``).
* ``normalize_trip_feed`` - decode the public trip feed's payload (all text,
  ``tpep_*`` names) into trip records: defaults for missing / empty values,
  numeric casts, rows with an unparseable number skipped.
* ``normalize_weather_feed`` - decode the nested weather payload.
* ``replay_*`` - decode landed JSON back into typed rows.

All decoding is ``from_json`` with a declared schema - JVM-side, no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import settings as S
from ..functions import columns as C

FEED_TRIP_FIELDS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid",
                    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
                    "payment_type"]
FEED_TRIP_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FEED_TRIP_FIELDS])
FEED_WEATHER_SCHEMA = T.StructType([
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType()),
                                        T.StructField("feels_like", T.DoubleType()),
                                        T.StructField("humidity", T.IntegerType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()),
                                                       T.StructField("description", T.StringType())]))),
    T.StructField("visibility", T.DoubleType()),
])
TRIP_RECORD_SCHEMA = T.StructType([
    T.StructField("trip_id", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("pickup_datetime", T.TimestampNTZType()), T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pickup_neighborhood", T.StringType()), T.StructField("dropoff_neighborhood", T.StringType()),
    T.StructField("passenger_count", T.IntegerType()), T.StructField("trip_distance_miles", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()), T.StructField("tip_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()), T.StructField("payment_type", T.StringType()),
    T.StructField("trip_duration_min", T.DoubleType()), T.StructField("speed_mph", T.DoubleType()),
    T.StructField("batch_id", T.IntegerType()),
])


def trip_feed_payload(text_trips: DataFrame) -> DataFrame:
    """Trip records (as text) in the public feed's field names, one JSON
    document per row - the raw landing form of a feed pull."""
    s = F.struct(
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("pickup_neighborhood").alias("pulocationid"),
        F.col("dropoff_neighborhood").alias("dolocationid"),
        F.col("passenger_count").cast("string").alias("passenger_count"),
        F.col("trip_distance_miles").cast("string").alias("trip_distance"),
        F.col("fare_amount").cast("string").alias("fare_amount"),
        F.col("tip_amount").cast("string").alias("tip_amount"),
        F.col("total_amount").cast("string").alias("total_amount"),
        F.col("payment_type").cast("string").alias("payment_type"))
    return text_trips.select("trip_id", "city", F.lit("feed").alias("source"), F.to_json(s).alias("raw_json"))


def _with_parsed(df: DataFrame, json, out: str) -> DataFrame:
    """``df`` with ``out``, the parsed ``json``: as a generated column, so that
    filters on its fields do not repeat the parse for each of them."""
    return df.select("*", F.explode_outer(F.array(json)).alias(out))


def _num(field: str, default: float, typ: str):
    """Python ``float(x or default)``: missing / empty -> default; a value
    that does not parse -> NULL (the caller skips the row)."""
    v = F.col(f"f.{field}")
    return F.when(v.isNull() | (v == ""), F.lit(default).cast(typ)).otherwise(v.try_cast(typ))


def normalize_trip_feed(landed: DataFrame) -> DataFrame:
    """Feed payload -> trip records; a row whose number does not parse is
    dropped, duration and speed are 0 (derived later)."""
    x = _with_parsed(landed, F.from_json("raw_json", FEED_TRIP_SCHEMA), "f")
    nums = {"passenger_count": _num("passenger_count", 1, "int"),
            "trip_distance_miles": _num("trip_distance", 0.0, "double"),
            "fare_amount": _num("fare_amount", 0.0, "double"),
            "tip_amount": _num("tip_amount", 0.0, "double"),
            "total_amount": _num("total_amount", 0.0, "double")}
    out = x.select(
        "trip_id", "city",
        F.coalesce(F.col("f.tpep_pickup_datetime"), F.lit("")).alias("pickup_datetime"),
        F.coalesce(F.col("f.tpep_dropoff_datetime"), F.lit("")).alias("dropoff_datetime"),
        F.coalesce(F.col("f.pulocationid"), F.lit("Unknown")).alias("pickup_neighborhood"),
        F.coalesce(F.col("f.dolocationid"), F.lit("Unknown")).alias("dropoff_neighborhood"),
        *[v.alias(k) for k, v in nums.items()],
        F.coalesce(F.col("f.payment_type"), F.lit("1")).alias("payment_type"),
        F.lit(0.0).alias("trip_duration_min"), F.lit(0.0).alias("speed_mph"))
    ok = None
    for k in nums:
        t = F.col(k).isNotNull()
        ok = t if ok is None else ok & t
    return out.filter(ok)


def weather_feed_payload(weather: DataFrame) -> DataFrame:
    """Weather readings in the nested payload form of the weather service
    (visibility in metres, description in lower case)."""
    s = F.struct(
        F.struct(F.col("temp_f").alias("temp"), F.col("feels_like_f").alias("feels_like"),
                 F.col("humidity_pct").alias("humidity")).alias("main"),
        F.struct(F.col("wind_speed_mph").alias("speed")).alias("wind"),
        F.array(F.struct(F.col("condition_code").alias("id"),
                         F.lower(F.col("condition")).alias("description"))).alias("weather"),
        C.rnd(F.col("visibility_mi") * S.METRES_PER_MILE, 0).alias("visibility"))
    return weather.select(F.col("weather_id").alias("id"), F.col("recorded_at").alias("ingested_at"),
                          "city", F.to_json(s).alias("raw_json"))


def _title(text):
    """Title case: a letter is upper-case after anything but a letter."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, F.initcap), "")


def normalize_weather_feed(landed: DataFrame) -> DataFrame:
    """Decoded readings; one without a weather entry is dropped."""
    x = _with_parsed(landed, F.from_json("raw_json", FEED_WEATHER_SCHEMA), "w")
    w0 = F.get(F.col("w.weather"), F.lit(0))
    code = w0.getField("id")
    vis_m = F.coalesce(F.col("w.visibility"), F.lit(float(S.DEFAULT_VISIBILITY_M)))
    x = x.where(F.size("w.weather") > 0)
    return x.select(
        F.col("id").alias("weather_id"), F.col("ingested_at").alias("recorded_at"), "city",
        F.col("w.main.temp").alias("temp_f"), F.col("w.main.feels_like").alias("feels_like_f"),
        F.col("w.main.humidity").alias("humidity_pct"), F.col("w.wind.speed").alias("wind_speed_mph"),
        _title(w0.getField("description")).alias("condition"), code.alias("condition_code"),
        C.rnd(vis_m / S.METRES_PER_MILE, 1).alias("visibility_mi"),
        ((code >= S.RAIN_CODES[0]) & (code < S.RAIN_CODES[1])).cast("int").alias("is_rain"),
        ((code >= S.SNOW_CODES[0]) & (code < S.SNOW_CODES[1])).cast("int").alias("is_snow"))


def land_trips(trips: DataFrame, source: str = "synthetic") -> DataFrame:
    """Raw landing rows: the whole record as JSON text plus city and source."""
    cols = [c for c in trips.columns]
    return trips.select("city", F.lit(source).alias("source"), F.to_json(F.struct(*cols)).alias("raw_json"))


def land_weather(weather: DataFrame, run_city: str | None = None) -> DataFrame:
    """A reading's own city wins over the run's."""
    city = F.col("city") if run_city is None else F.coalesce(F.col("city"), F.lit(run_city))
    return weather.select(city.alias("city"), F.to_json(F.struct(*weather.columns)).alias("raw_json"))


CORRUPT = "_corrupt_record"


def _decoded(landed: DataFrame) -> DataFrame:
    schema = T.StructType([*TRIP_RECORD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return _with_parsed(landed, F.from_json("raw_json", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}), "r")


def replay_trips(landed: DataFrame) -> DataFrame:
    """Landed trip JSON back to typed rows; text that is no record of the
    schema is left out (``quarantined`` has it)."""
    return _decoded(landed).where(f"r.{CORRUPT} is null and r is not null").select("r.*").drop(CORRUPT)


def quarantined(landed: DataFrame) -> DataFrame:
    """Landed rows whose text is not a record (malformed, a field of another
    type, or no text), whole: with their city, source, load and file."""
    bad = _decoded(landed).where(f"r is null or r.{CORRUPT} is not null")
    return bad.select(*[c for c in landed.columns], F.when(F.col("raw_json").isNull(), "no text").otherwise("not a record").alias("reason"))


def landed_files(spark, path: str) -> DataFrame:
    """Rows of a landing folder with the file that each one lies in."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))
