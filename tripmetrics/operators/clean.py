"""Trip extraction and enrichment: raw records -> typed, enriched rows.

Every step is a column expression over the whole DataFrame (no per-row
Python), so Catalyst fuses them into one codegen stage after the scan.
Even the airport lookup is an expression (a literal map built from the
bounded dimension), not a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import settings as S
from ..functions import columns as C
from ..sources.dims import Dims
from ..sources.tables import small_rows

NUMERIC_TRIP_COLUMNS = ["fare_amount", "tip_amount", "total_amount",
                        "trip_distance_miles", "trip_duration_min", "speed_mph"]
NUMERIC_WEATHER_COLUMNS = ["temp_f", "feels_like_f", "humidity_pct", "wind_speed_mph", "visibility_mi"]

KEEP_COLUMNS = [
    "trip_id", "city", "pickup_datetime", "dropoff_datetime", "pickup_hour",
    "pickup_weekday", "pickup_weekday_name", "pickup_date",
    "pickup_neighborhood", "dropoff_neighborhood", "passenger_count",
    "trip_distance_miles", "fare_amount", "tip_amount", "total_amount",
    "payment_type", "trip_duration_min", "speed_mph",
    "is_surge_hour", "is_weekend", "is_airport_trip",
]


def _number(c: str):
    """A field as a double; text that is no number, or NaN, becomes NULL."""
    x = F.col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def extract_trips(raw: DataFrame, default_city: str = S.DEFAULT_CITY) -> DataFrame:
    """Coerce numeric fields (bad -> 0; passenger count bad -> 1) and add a
    city when the records carry none."""
    out = raw
    for c in NUMERIC_TRIP_COLUMNS:
        if c in raw.columns:
            out = out.withColumn(c, F.coalesce(_number(c), F.lit(0.0)))
    if "passenger_count" in raw.columns:
        out = out.withColumn("passenger_count", F.coalesce(
            _number("passenger_count").try_cast("int"), F.lit(1)))
    if "city" not in raw.columns:
        out = out.withColumn("city", F.lit(default_city))
    return out


def extract_weather(raw: DataFrame) -> DataFrame:
    """Coerce numeric weather fields; unparseable values become NULL."""
    out = raw
    for c in NUMERIC_WEATHER_COLUMNS:
        if c in raw.columns:
            out = out.withColumn(c, _number(c))
    return out


def parse_times(df: DataFrame) -> DataFrame:
    """Pickup / dropoff to zone-less timestamps (bad -> NULL); rows without a
    pickup are dropped before the quality checks see them."""
    out = df
    for c in ("pickup_datetime", "dropoff_datetime"):
        if isinstance(df.schema[c].dataType, StringType):
            out = out.withColumn(c, F.col(c).try_cast("timestamp_ntz"))
        else:
            out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return out.filter(F.col("pickup_datetime").isNotNull())


def calendar_parts(df: DataFrame) -> DataFrame:
    return df.select("*", *[x.alias(c) for c, x in _calendar().items()])


def _calendar() -> dict:
    ts = F.col("pickup_datetime")
    return {"pickup_hour": C.hour_of(ts), "pickup_weekday": C.weekday_of(ts),
            "pickup_weekday_name": C.day_name_of(ts), "pickup_date": C.date_text(ts)}


def of_pickup() -> dict:
    """The columns of an enriched trip that its pickup time alone decides."""
    ts = F.col("pickup_datetime")
    return _calendar() | {"is_surge_hour": _surge(C.hour_of(ts)), "is_weekend": _weekend(C.weekday_of(ts))}


def _surge(hour):
    return hour.isin(*S.SURGE_HOURS).cast("int")


def _weekend(weekday):
    return (weekday >= 5).cast("int")


def derive_duration(df: DataFrame) -> DataFrame:
    """Duration <= 0 is replaced by dropoff - pickup in minutes, at least 0;
    a missing dropoff leaves it NULL."""
    elapsed = C.clip(C.minutes_between("pickup_datetime", "dropoff_datetime"), lo=0.0)
    dur = F.col("trip_duration_min")
    return df.withColumn("trip_duration_min", F.when(dur <= 0, elapsed).otherwise(dur))


def derive_speed(df: DataFrame) -> DataFrame:
    """Speed <= 0 with a positive duration is distance / hours (2 dp); every
    speed is then clipped to [0, 80]."""
    sp, dur = F.col("speed_mph"), F.col("trip_duration_min")
    derived = C.rnd(F.col("trip_distance_miles") / (dur / 60), 2)
    sp = F.when((sp <= 0) & (dur > 0), derived).otherwise(sp)
    return df.withColumn("speed_mph", C.clip(sp, 0.0, 80.0))


AIRPORT_MAP_MAX = 10_000


def airport_lookup(dims: Dims):
    """City -> airport names as a literal map column, built once per session
    from the (bounded, size-checked) dimensions: the per-row lookup is an
    expression, not a join.  A city without a profile gets the default
    city's airports."""
    rows = small_rows(dims.city.select("city").join(dims.airport, "city", "left")
                      .groupBy("city").agg(F.collect_set("neighborhood").alias("a")), AIRPORT_MAP_MAX)
    sets = {r["city"]: sorted(r["a"] or []) for r in rows}
    arr = lambda names: F.array(*[F.lit(a) for a in names]).cast("array<string>")
    m = F.create_map(*[x for c, names in sorted(sets.items()) for x in (F.lit(c), arr(names))])
    return lambda city: F.coalesce(F.try_element_at(m, city), arr(sets.get(dims.default_city, [])))


def trip_flags(df: DataFrame, dims: Dims) -> DataFrame:
    """Surge hour, weekend and airport flags.  The airport set is the trip
    city's (an unknown city falls back to the default city's)."""
    airports = airport_lookup(dims)(F.col("city"))
    is_airport = F.coalesce(F.array_contains(airports, F.col("pickup_neighborhood")), F.lit(False)) | \
        F.coalesce(F.array_contains(airports, F.col("dropoff_neighborhood")), F.lit(False))
    return (df.withColumn("is_surge_hour", _surge(F.col("pickup_hour")))
              .withColumn("is_weekend", _weekend(F.col("pickup_weekday")))
              .withColumn("is_airport_trip", is_airport.cast("int")))


def with_trip_id(df: DataFrame) -> DataFrame:
    """Give records without a trip id a surrogate one.

    The id hashes the record's content and, for records of a load that are
    equal in every field, which of them it is; not the load or the place in
    the input.  So a replay or another file layout gives the same ids.  Equal
    records are counted (map-side first) and laid out again, so many copies
    of one never meet in a sort.  On a stream equal records share one id.
    """
    if "trip_id" in df.columns:
        return df
    content = F.to_json(F.struct(*sorted(c for c in df.columns if c != "batch_id")))
    if df.isStreaming:
        return df.withColumn("trip_id", F.sha2(content, 256))
    laid = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
              .select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_nth")))
    nth = F.when(F.col("_nth") > 1, F.concat(F.lit("#"), F.col("_nth"))).otherwise("")
    return laid.withColumn("trip_id", F.sha2(F.concat(content, nth), 256)).drop("_nth")


def decode_and_fill(df: DataFrame) -> DataFrame:
    return (df.withColumn("payment_type", C.decode_payment("payment_type"))
              .withColumn("pickup_neighborhood", F.coalesce(F.col("pickup_neighborhood"), F.lit("Unknown")))
              .withColumn("dropoff_neighborhood", F.coalesce(F.col("dropoff_neighborhood"), F.lit("Unknown"))))


def enrich_trips(raw: DataFrame, dims: Dims) -> DataFrame:
    """id -> extract -> parse -> calendar -> duration -> speed -> flags ->
    payment / neighbourhood fill.  Input to the quality checks.  A surrogate
    id is of the record as it came, so no rule of the later steps changes it."""
    df = extract_trips(with_trip_id(raw), dims.default_city)
    df = parse_times(df)
    df = calendar_parts(df)
    df = derive_duration(df)
    df = derive_speed(df)
    df = trip_flags(df, dims)
    return decode_and_fill(df)
