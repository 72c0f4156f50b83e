"""Staging and mart merge semantics.

* ``insert_or_ignore`` - staging load: rows breaking a NOT NULL column are
  skipped, the first row per key wins (in batch order, then by content so
  the pick is deterministic), keys already in the target are ignored.  The
  first-wins pick is a ``min_by`` aggregate, so partial aggregation handles
  a hot key map-side instead of sorting it in one task.
* ``fold`` - several loads of a mart merged by per-column rules, all
  batches in one pass.  Rules: ``+`` accumulate, ``half`` (old+new)/2,
  ``max`` greatest (NULL if any NULL), ``old`` keep first, ``new`` take
  last.  For the ``half`` rule the n values of a key in batch order fold to
  sum(w_i * v_i) with w_1 = 2^-(n-1) and w_i = 2^-(n-i+1); weights and
  values are decimals so the sum is exact in any order.
* ``merge_upsert`` - the same rules between a stored mart and one new load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import columns as C

STAGE_NOT_NULL = ["trip_id", "city", "pickup_datetime", "dropoff_datetime", "pickup_hour",
                  "pickup_weekday", "pickup_weekday_name", "pickup_date"]
WEATHER_NOT_NULL = ["weather_id", "recorded_at", "city"]
HALF_VALUE = "decimal(18,8)"
HALF_WEIGHT = "decimal(19,17)"
ADD_VALUE = "decimal(24,6)"

# Per-column rules of each mart on key conflict.
HOURLY_KEYS = ["city", "date", "hour"]
HOURLY_RULES = {
    "day_of_week": "old", "day_name": "old",
    "trip_count": "+", "total_passengers": "+", "total_revenue": "+",
    "avg_fare": "half", "avg_distance": "half", "avg_duration_min": "half", "avg_speed_mph": "half",
    "tip_rate_pct": "old", "surge_trip_pct": "old", "airport_pct": "old",
    "pulse_score": "max",
}
NEIGHBORHOOD_KEYS = ["city", "date", "neighborhood"]
NEIGHBORHOOD_RULES = {
    "trip_count": "+", "avg_fare": "half", "total_revenue": "+",
    "avg_distance": "old", "rank_by_trips": "old",
}
DAILY_KEYS = ["city", "date"]
DAILY_RULES = {
    "total_trips": "+", "total_passengers": "old", "total_revenue": "+",
    "avg_fare": "old", "avg_distance": "old", "avg_duration_min": "old",
    "busiest_hour": "old", "quietest_hour": "old", "peak_neighborhood": "old", "weekend_flag": "old",
}
WEEKLY_KEYS = ["city", "week_start"]
WEEKLY_RULES = {
    "week_end": "old", "total_trips": "new", "total_revenue": "new",
    "avg_daily_trips": "old", "peak_day": "old", "peak_hour": "old",
}


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key under ``order`` (skew-safe aggregate).  The
    row itself, with the order columns in front, is what is compared, so one
    copy of it is shuffled; the key stands beside it, not in it."""
    row = [*order, *[c for c in df.columns if c not in order]]
    return (df.groupBy(key).agg(F.min(F.struct(*[c for c in row if c != key])).alias("_r"))
              .select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns]))


def insert_or_ignore(batch: DataFrame, key: str, not_null: list[str], order: list[str],
                     target: DataFrame | None = None, derived: dict | None = None) -> DataFrame:
    """Rows of ``batch`` a keyed insert-or-ignore would add to ``target``.

    The key column of a stored table streams past a hash table of the load's
    keys (a table bucketed by the key is neither shuffled nor sorted for it),
    and the load is then anti-joined with the keys that already exist.

    ``derived`` names columns that the others decide, with their expressions:
    they are neither shuffled nor sorted, but made again of the rows that stay.
    They must follow the columns they are made of in ``order``.
    """
    derived = derived or {}
    ok = batch
    for c in not_null:
        ok = ok.filter(F.col(c).isNotNull())
    first = first_per_key(ok.drop(*derived), key, [c for c in order if c not in derived])
    if target is not None:
        # keys straight from the load: the first-wins aggregate runs once
        existing = target.select(key).join(ok.select(key).hint("shuffle_hash"), key, "left_semi")
        first = first.join(existing, key, "left_anti")
    return first.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in batch.columns]) if derived else first


def stage_trips(clean: DataFrame, target: DataFrame | None = None, derived: dict | None = None) -> DataFrame:
    order = ["batch_id"] + [c for c in clean.columns if c != "batch_id"]
    return insert_or_ignore(clean, "trip_id", STAGE_NOT_NULL, order, target, derived)


def stage_weather(weather: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return insert_or_ignore(weather, "weather_id", WEATHER_NOT_NULL, weather.columns, target)


def _rule_agg(df: DataFrame, c: str, rule: str, order: str):
    x = F.col(c)
    is_float = isinstance(df.schema[c].dataType, (DoubleType, FloatType))
    if rule == "+":
        return F.sum(x.cast(ADD_VALUE)).cast("double") if is_float else F.sum(x)
    if rule == "half":
        return F.sum(x.cast(HALF_VALUE) * F.col("_w").cast(HALF_WEIGHT))
    if rule == "max":
        return F.when(F.count(x) < F.count(F.lit(1)), F.lit(None)).otherwise(F.max(x))
    if rule == "old":
        return F.min_by(x, F.col(order))
    if rule == "new":
        return F.max_by(x, F.col(order))
    raise ValueError(f"unknown merge rule {rule!r}")


def fold(batches: DataFrame, keys: list[str], rules: dict, order: str = "batch_id",
         round_half: bool = True) -> DataFrame:
    """Merge every load of a mart in ``order`` with the column ``rules``.

    The window is per mart key, so a group holds one row per load of that
    key - bounded by the number of loads, not by the data size.
    """
    need_weight = "half" in rules.values()
    x = batches
    if need_weight:
        w = Window.partitionBy(*keys)
        i = F.row_number().over(w.orderBy(order))
        n = F.count(F.lit(1)).over(w)
        x = x.withColumn("_i", i).withColumn("_n", n).withColumn(
            "_w", F.when(F.col("_i") == 1, F.pow(F.lit(0.5), F.col("_n") - 1))
                   .otherwise(F.pow(F.lit(0.5), F.col("_n") - F.col("_i") + 1)))
    aggs = [_rule_agg(x, c, r, order).alias(c) for c, r in rules.items()]
    out = x.groupBy(*keys).agg(*aggs)
    half = [c for c, r in rules.items() if r == "half"]
    fin = (lambda c: C.rnd(c, 6)) if round_half else (lambda c: F.col(c).cast("double"))
    return out.select(*keys, *[fin(c).alias(c) if c in half else F.col(c) for c in rules])


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict) -> DataFrame:
    """One step of the merge: stored mart + one new load -> new mart.  Each
    side holds a key once; a key on both sides is combined by the rules in the
    columns' own types (sums of doubles through decimals), so any number of
    steps is what the loads in their order give."""
    both = (target.select(*keys, *rules, F.lit(0).alias("_load"))
            .unionByName(source.select(*keys, *rules, F.lit(1).alias("_load"))))
    side = lambda c, i: F.max(F.when(F.col("_load") == i, F.col(c)))
    x = both.groupBy(*keys).agg(F.min("_load").alias("_a"), F.max("_load").alias("_b"),
                                *[side(c, i).alias(f"_{i}{c}") for c in rules for i in (0, 1)])
    out = []
    for c, rule in rules.items():
        old, new, kind = F.col(f"_0{c}"), F.col(f"_1{c}"), target.schema[c].dataType
        add = old.cast(ADD_VALUE) + new.cast(ADD_VALUE) if isinstance(kind, (DoubleType, FloatType)) else old + new
        step = {"+": add, "half": (old + new) / 2, "old": old, "new": new,
                "max": F.when(old.isNotNull() & new.isNotNull(), F.greatest(old, new))}[rule]
        out.append(F.when(F.col("_b") == 0, old).when(F.col("_a") == 1, new).otherwise(step).cast(kind).alias(c))
    return x.select(*keys, *out)


TOTALS = {"raw_trips": "long", "raw_weather": "long", "clean_trips": "long", "stg_trips": "long", "weather_rows": "long",
          "revenue": "decimal(38,2)", "fare_sum": "decimal(38,6)", "fare_n": "long", "speed_sum": "decimal(38,6)", "speed_n": "long",
          "neg_fares": "long", "null_hoods": "long", "dq_checks": "long"}


def city_totals(raw: DataFrame, raw_weather: DataFrame, dq_counts: DataFrame, dq_log: DataFrame, inserted: DataFrame, readings: DataFrame) -> DataFrame:
    """What one load adds to each city's running totals (``TOTALS``), from the
    layers it wrote; sums, so the totals of all loads are kept by adding."""
    n = F.count(F.lit(1))
    fare, speed = F.col("fare_amount"), F.when(F.col("speed_mph") > 0, F.col("speed_mph"))
    parts = [raw.groupBy("city").agg(n.alias("raw_trips")), raw_weather.groupBy("city").agg(n.alias("raw_weather")),
             dq_counts.select("city", F.col("n_out").alias("clean_trips")), dq_log.groupBy("city").agg(n.alias("dq_checks")),
             inserted.groupBy("city").agg(n.alias("stg_trips"), C.money_sum("total_amount").alias("revenue"), F.sum(fare).alias("fare_sum"),
                                          F.count(fare).alias("fare_n"), F.sum(speed).alias("speed_sum"), F.count(speed).alias("speed_n"),
                                          F.count_if(fare < 0).alias("neg_fares"), F.count_if(F.col("pickup_neighborhood").isNull()).alias("null_hoods")),
             readings.groupBy("city").agg(n.alias("weather_rows"))]
    rows = parts[0].select(F.col("city").cast("string").alias("city"), *[F.col(c).cast(t) if c in parts[0].columns else F.lit(0).cast(t).alias(c) for c, t in TOTALS.items()])
    for p in parts[1:]:
        rows = rows.unionByName(p.select(F.col("city").cast("string").alias("city"), *[F.col(c).cast(t) if c in p.columns else F.lit(0).cast(t).alias(c) for c, t in TOTALS.items()]))
    return rows.groupBy("city").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in TOTALS.items()])
