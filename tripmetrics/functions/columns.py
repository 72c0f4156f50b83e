"""Column expressions shared by every operator.

All are built-in Spark functions, so they stay inside whole-stage codegen.
Rounding goes through decimals (half-up, as SQL engines do) so that the
same digits come out whatever order a sum was taken in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S

ROUND_TYPE = "decimal(30,12)"
MONEY_TYPE = "decimal(18,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """Clip that keeps NULL (``greatest``/``least`` would skip it)."""
    c = col(c)
    out = c
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def rnd(c, digits: int) -> Column:
    """Half-up rounding to ``digits`` through a decimal, returned as double."""
    return F.round(col(c).cast(ROUND_TYPE), digits).cast("double")


def money_sum(c) -> Column:
    """Exact sum of 2-dp amounts, independent of task order."""
    return F.sum(col(c).cast(MONEY_TYPE))


def ts_text(c) -> Column:
    """'yyyy-MM-dd HH:mm:ss.ffffff' of a zone-less timestamp: its cast to text,
    which leaves trailing zeros of the fraction out, filled up with them.
    ``date_format`` would pass through the session zone and move a wall-clock
    time that falls in a daylight-saving gap; ``format_string`` parses its
    pattern for every row."""
    txt = col(c).cast("string")
    dot = F.instr(txt, ".")
    return F.when(dot == 0, F.concat(txt, F.lit(".000000"))).otherwise(F.rpad(txt, dot + 6, "0"))


def date_text(c) -> Column:
    return col(c).cast("date").cast("string")


def in_range(c, lo, hi) -> Column:
    """Range test where NULL counts as out of range (pandas NaN semantics)."""
    c = col(c)
    return F.coalesce((c >= F.lit(lo)) & (c <= F.lit(hi)), F.lit(False))


def pulse_score(trip_count, avg_fare, avg_speed, surge_pct_rounded) -> Column:
    """0-100 activity score of one hour; inputs are the unrounded averages and
    the 2-dp surge percentage."""
    tc, fare, speed = col(trip_count), col(avg_fare), col(avg_speed)
    trip_score = F.least(tc / F.lit(float(S.PULSE_BASELINE_TRIPS)) * 40, F.lit(40.0))
    fare_score = F.when(fare / 25 * 20 > 20, F.lit(20.0)).otherwise(fare / 25 * 20)
    speed_score = F.when(speed > 0, F.when(speed / 20 * 20 > 20, F.lit(20.0))
                         .otherwise(speed / 20 * 20)).otherwise(F.lit(0.0))
    surge_score = col(surge_pct_rounded) / 100 * 20
    total = trip_score + fare_score + speed_score + surge_score
    return rnd(F.when(total > 100, F.lit(100.0)).otherwise(total), 2)


def hour_of(ts) -> Column:
    return F.hour(col(ts)).cast("int")


def weekday_of(ts) -> Column:
    """Monday = 0."""
    return F.weekday(col(ts)).cast("int")


def day_name_of(ts) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in S.DAY_NAMES]), weekday_of(ts) + 1)


def decode_payment(c) -> Column:
    """Feed codes "1".."4" become names; anything else passes through.
    A missing value becomes the text "None", as str(None) does."""
    m = F.create_map(*[x for k, v in S.PAYMENT_NAMES.items() for x in (F.lit(k), F.lit(v))])
    c = col(c).cast("string")
    return F.coalesce(m[c], c, F.lit("None"))


def minutes_between(start, end) -> Column:
    """Elapsed minutes between two zone-less timestamps (DST-free)."""
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end})") / F.lit(60_000_000.0)
