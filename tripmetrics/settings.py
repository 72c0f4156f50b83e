"""Fixed values and run parameters.

Everything in the FIXED VALUES block must equal the values the original
trip-metrics application uses, so results match it.  Parameters that the
original hard-wires to the wall clock (``now``) are explicit here.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original application's)
# ---------------------------------------------------------------------------

# Data-quality thresholds.
MAX_TRIP_DISTANCE_MILES = 100
MAX_FARE_AMOUNT = 5000
MAX_TRIP_DURATION_MIN = 180
MIN_PASSENGER_COUNT = 1
MAX_PASSENGER_COUNT = 6
DQ_MIN_PICKUP = "2019-01-01 00:00:00"
DQ_WARN_SHARE = 0.05
DQ_COMPLETENESS_PASS = 95

# Rush hours that set the surge flag: 7-9 and 16-19.
SURGE_HOURS = (7, 8, 9, 16, 17, 18, 19)
# Night band for the speed check: 0-4.
NIGHT_HOURS = (0, 1, 2, 3, 4)

# Payment codes of the public trip feed.
PAYMENT_NAMES = {"1": "Credit Card", "2": "Cash", "3": "No Charge", "4": "Dispute"}

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Pulse score: trips against a baseline, fare, speed and surge share.
PULSE_BASELINE_TRIPS = 500

# Demand weights by pickup hour and weekday (Mon=0).
HOUR_WEIGHTS = {
    0: 0.60, 1: 0.45, 2: 0.35, 3: 0.20, 4: 0.15, 5: 0.18,
    6: 0.40, 7: 0.85, 8: 0.95, 9: 0.90, 10: 0.75, 11: 0.70,
    12: 0.80, 13: 0.75, 14: 0.70, 15: 0.75, 16: 0.90, 17: 1.00,
    18: 0.98, 19: 0.92, 20: 0.85, 21: 0.80, 22: 0.75, 23: 0.70,
}
HOUR_WEIGHT_DEFAULT = 0.5
WEEKDAY_MULTIPLIERS = {0: 0.9, 1: 0.92, 2: 0.95, 3: 0.95, 4: 1.0, 5: 1.1, 6: 0.85}
WEEKDAY_MULTIPLIER_DEFAULT = 1.0
SEASON_TEMP_DEFAULT = 65

# Weather feed: metres per mile, default visibility in metres, code ranges.
METRES_PER_MILE = 1609.34
DEFAULT_VISIBILITY_M = 10000
RAIN_CODES = (300, 600)
SNOW_CODES = (600, 700)

DEFAULT_CITY = "New York"

# City profiles: tariff, speed bands (lo, hi mph), airports, monthly normal
# temperature (F) for months 1..12.
CITY_PROFILES = {
    "New York": dict(
        display_name="New York City", country="USA", currency="$", currency_code="USD",
        timezone="America/New_York", base_fare=3.00, per_mile_rate=2.50, per_min_rate=0.35,
        speed_day=(14, 25), speed_rush=(8, 18), speed_night=(20, 35),
        airports=("JFK Airport", "LaGuardia Airport", "Newark Airport"),
        seasonal_temps=(35, 38, 48, 60, 70, 80, 85, 83, 75, 63, 50, 40),
    ),
    "London": dict(
        display_name="London", country="UK", currency="£", currency_code="GBP",
        timezone="Europe/London", base_fare=2.60, per_mile_rate=2.00, per_min_rate=0.40,
        speed_day=(10, 20), speed_rush=(5, 12), speed_night=(18, 30),
        airports=("Heathrow Airport", "Gatwick Airport", "London City Airport"),
        seasonal_temps=(40, 42, 48, 55, 62, 68, 72, 71, 65, 56, 48, 42),
    ),
    "Mumbai": dict(
        display_name="Mumbai", country="India", currency="₹", currency_code="INR",
        timezone="Asia/Kolkata", base_fare=21.00, per_mile_rate=14.00, per_min_rate=1.50,
        speed_day=(8, 18), speed_rush=(4, 10), speed_night=(18, 30),
        airports=("Chhatrapati Shivaji Airport", "Juhu Aerodrome"),
        seasonal_temps=(75, 78, 84, 89, 91, 84, 80, 80, 81, 84, 82, 77),
    ),
    "Chicago": dict(
        display_name="Chicago", country="USA", currency="$", currency_code="USD",
        timezone="America/Chicago", base_fare=3.25, per_mile_rate=2.25, per_min_rate=0.30,
        speed_day=(14, 26), speed_rush=(8, 16), speed_night=(22, 38),
        airports=("O'Hare Airport", "Midway Airport"),
        seasonal_temps=(24, 28, 38, 50, 61, 71, 76, 75, 67, 55, 41, 29),
    ),
    "Tokyo": dict(
        display_name="Tokyo", country="Japan", currency="¥", currency_code="JPY",
        timezone="Asia/Tokyo", base_fare=410.00, per_mile_rate=300.00, per_min_rate=80.00,
        speed_day=(12, 22), speed_rush=(6, 14), speed_night=(18, 32),
        airports=("Narita Airport", "Haneda Airport"),
        seasonal_temps=(38, 40, 50, 60, 68, 74, 82, 84, 76, 65, 54, 44),
    ),
    "Dubai": dict(
        display_name="Dubai", country="UAE", currency="AED", currency_code="AED",
        timezone="Asia/Dubai", base_fare=5.00, per_mile_rate=2.80, per_min_rate=0.50,
        speed_day=(20, 40), speed_rush=(10, 22), speed_night=(35, 60),
        airports=("Dubai International Airport", "Al Maktoum Airport"),
        seasonal_temps=(65, 68, 74, 82, 92, 100, 106, 106, 100, 92, 80, 70),
    ),
    "Paris": dict(
        display_name="Paris", country="France", currency="€", currency_code="EUR",
        timezone="Europe/Paris", base_fare=2.50, per_mile_rate=1.80, per_min_rate=0.38,
        speed_day=(12, 22), speed_rush=(6, 14), speed_night=(18, 30),
        airports=("Charles de Gaulle Airport", "Orly Airport", "Beauvais Airport"),
        seasonal_temps=(38, 40, 48, 56, 64, 70, 76, 75, 67, 56, 46, 39),
    ),
    "Sydney": dict(
        display_name="Sydney", country="Australia", currency="A$", currency_code="AUD",
        timezone="Australia/Sydney", base_fare=3.60, per_mile_rate=2.20, per_min_rate=0.55,
        speed_day=(14, 26), speed_rush=(8, 16), speed_night=(22, 38),
        airports=("Sydney Airport", "Bankstown Airport"),
        seasonal_temps=(73, 73, 69, 63, 57, 52, 50, 53, 58, 64, 69, 73),
    ),
}

# ---------------------------------------------------------------------------
# Run parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Knobs the original takes from the wall clock or hard-codes per call."""

    as_of: datetime = datetime(2024, 3, 31)  # "now"
    rollup_days: int = 7                      # trailing window of the daily rollup
    recent_hourly_days: int = 30              # hourly pulse read by the page
    recent_daily_days: int = 30
    top_hours_n: int = 10
    recent_trips_n: int = 100
    recent_weather_n: int = 200
    run_history_n: int = 20
    dq_recent_n: int = 100
    top_neighborhoods_n: int = 12
    hours_covered_min: int = 20
    default_city: str = DEFAULT_CITY

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def as_of_date(self) -> str:
        return self.as_of.strftime("%Y-%m-%d")

    @property
    def as_of_ts(self) -> str:
        return self.as_of.strftime("%Y-%m-%d %H:%M:%S")
