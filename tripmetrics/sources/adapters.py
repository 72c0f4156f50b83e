"""Test-input adapters: map the driver's star-schema tables onto the trip and
weather record shapes the engine consumes (see FIXTURES.md).

The trip adapter is a plain join plan: lineitem with orders on the order
key (a shuffle join at scale), customers and suppliers on their keys, and
the two fixed-size dimension tables (nation, region) broadcast after a size
check.  Only division and ``floor`` are used so any SQL engine gives the
same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bounded_broadcast, read_table

# FIXED VALUES of the fixture mapping (FIXTURES.md).
TRIP_EPOCH = "2024-01-01 00:00:00"
ORDER_EPOCH = "1995-01-01"
SPAN_DAYS = 90
WEATHER_CITIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
WEATHER_BY_EVENT = {  # event_type -> (condition, code)
    "view": ("Clear", 800),
    "click": ("Light Rain", 500),
    "purchase": ("Drizzle", 300),
    "signup": ("Snow", 601),
    "error": ("Fog", 741),
}
N_BATCHES = 4  # batch_id = l_orderkey % 4
DIM_ROWS_MAX = 10_000  # nations / regions are tiny by definition
ORDERS_BROADCAST_ROWS = 2_000_000  # orders+customer rows broadcast at most

TRIP_COLUMNS = [
    "trip_id", "city", "pickup_datetime", "dropoff_datetime", "pickup_neighborhood",
    "dropoff_neighborhood", "passenger_count", "trip_distance_miles", "fare_amount",
    "tip_amount", "total_amount", "payment_type", "trip_duration_min", "speed_mph", "batch_id",
]
WEATHER_COLUMNS = [
    "weather_id", "recorded_at", "city", "temp_f", "feels_like_f", "humidity_pct",
    "wind_speed_mph", "condition", "condition_code", "visibility_mi", "is_rain", "is_snow",
]


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return bounded_broadcast(
        nation.join(bounded_broadcast(region, DIM_ROWS_MAX), nation.n_regionkey == region.r_regionkey),
        DIM_ROWS_MAX)


def trips_from_tables(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    geo = _geo(spark, sf_dir)

    cust = c.join(geo.select(F.col("n_nationkey").alias("c_nationkey"),
                             F.col("n_name").alias("c_nation"), "r_name"), "c_nationkey") \
            .select("c_custkey", "c_nation", "r_name")
    supp = s.join(geo.select(F.col("n_nationkey").alias("s_nationkey"),
                             F.col("n_name").alias("s_nation")), "s_nationkey") \
            .select("s_suppkey", "s_nation")
    # orders carry their customer's nation first (orders is far smaller than
    # lineitem), so lineitem is joined once on the order key and once on the
    # supplier key.  lineitem is hash-partitioned on the order key: the
    # partitioning that join needs at scale anyway, and it spreads a
    # single-file input over tasks when the orders side is broadcast.
    # The orders side is broadcast only after a row-count check; above the
    # bound the join is a sort-merge join by hint - without statistics the
    # estimate of a join output is the product of its inputs, which would
    # make the planner broadcast lineitem instead.  lineitem is already
    # partitioned on the key, so only the orders side moves.
    oc = o.join(cust, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    oc = bounded_broadcast(oc, ORDERS_BROADCAST_ROWS, otherwise="merge")
    x = (l.repartition("l_orderkey")
          .join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
          .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))

    day = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit(ORDER_EPOCH).cast("date")), F.lit(SPAN_DAYS))
    sec = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 31 + F.col("l_linenumber") * 10007) % 86400
    # integer seconds added to a zone-less epoch (cheap, codegen friendly)
    pickup = F.timestamp_add("SECOND", day * 86400 + sec, F.lit(TRIP_EPOCH).cast("timestamp_ntz"))
    trip_min = F.lit(5) + F.col("l_partkey") % 180
    cents = F.floor(F.col("l_extendedprice") / 10) / 100
    no_charge_terms = (F.col("l_discount") == 0) & (F.col("l_tax") == 0)

    return x.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("trip_id"),
        F.col("r_name").alias("city"),
        pickup.alias("pickup_datetime"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.timestamp_add("MINUTE", trip_min, pickup))
         .alias("dropoff_datetime"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("c_nation")).alias("pickup_neighborhood"),
        F.col("s_nation").alias("dropoff_neighborhood"),
        F.col("l_linenumber").cast("int").alias("passenger_count"),
        F.when(F.col("l_quantity") == 50, F.lit(125.0)).otherwise(F.col("l_quantity") / 2).alias("trip_distance_miles"),
        F.when(no_charge_terms & (F.col("l_returnflag") == "R"), -cents)
         .when(no_charge_terms & (F.col("l_returnflag") == "A"), F.lit(0.0))
         .otherwise(cents).alias("fare_amount"),
        (F.floor(F.col("l_extendedprice") * F.col("l_discount") / 10) / 100).alias("tip_amount"),
        (F.floor(F.col("l_extendedprice") * (1 + F.col("l_discount") + F.col("l_tax")) / 10) / 100).alias("total_amount"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        F.when(F.col("l_linestatus") == "O", F.lit(0.0)).otherwise(trip_min.cast("double")).alias("trip_duration_min"),
        F.when(F.col("l_linestatus") == "O", F.lit(0.0)).otherwise((F.lit(8) + F.col("l_suppkey") % 90).cast("double")).alias("speed_mph"),
        (F.col("l_orderkey") % 4).cast("int").alias("batch_id"),
        *([F.col("l_orderkey"), F.col("l_partkey")] if keep_keys else []),
    )


def dirty_trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip adapter as raw text with some unparseable values, the way a
    JSON feed delivers it (FIXTURES.md, dirty-text variant)."""
    t = trips_from_tables(spark, sf_dir, keep_keys=True)
    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    txt = {c: F.col(c).cast("string") for c in TRIP_COLUMNS if c not in ("batch_id",)}
    txt["fare_amount"] = F.when(pk % 211 == 0, F.lit("n/a")).otherwise(txt["fare_amount"])
    txt["passenger_count"] = F.when(pk % 223 == 0, F.lit("")).otherwise(txt["passenger_count"])
    txt["pickup_datetime"] = F.when(ok % 227 == 0, F.lit("bad")).otherwise(txt["pickup_datetime"])
    txt["payment_type"] = F.when(pk % 229 == 0, F.lit(None).cast("string")).otherwise(txt["payment_type"])
    return t.select(*[txt[c].alias(c) if c in txt else F.col(c) for c in TRIP_COLUMNS])


def weather_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    city = F.element_at(F.array(*[F.lit(c) for c in WEATHER_CITIES]), (F.col("event_id") % 5 + 1).cast("int"))
    cond_map = F.create_map(*[x for k, (n, _) in WEATHER_BY_EVENT.items() for x in (F.lit(k), F.lit(n))])
    code_map = F.create_map(*[x for k, (_, c) in WEATHER_BY_EVENT.items() for x in (F.lit(k), F.lit(c))])
    et = F.col("event_type")
    return e.select(
        F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("weather_id"),
        F.col("ts").cast("timestamp_ntz").alias("recorded_at"),
        city.alias("city"),
        (F.lit(20) + F.col("user_id") % 80).cast("double").alias("temp_f"),
        (F.lit(17) + F.col("user_id") % 80).cast("double").alias("feels_like_f"),
        (F.lit(40) + F.col("event_id") % 56).cast("int").alias("humidity_pct"),
        (F.lit(2) + F.col("event_id") % 17).cast("double").alias("wind_speed_mph"),
        cond_map[et].alias("condition"),
        code_map[et].cast("int").alias("condition_code"),
        F.when(et.isin("click", "error"), F.lit(4.0) + F.col("event_id") % 7).otherwise(F.lit(10.0)).alias("visibility_mi"),
        et.isin("click", "purchase").cast("int").alias("is_rain"),
        (et == "signup").cast("int").alias("is_snow"),
    )
