"""Schemas and fixed vocabularies of the sensor and city-service data model.

Everything here is plain data: column names, Spark types and the small
closed vocabularies that the queries must match exactly.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the source data model exactly) -----------------
# Raw sensor file headers (Turkish, UTF-8), the English silver name and the
# silver type, in file order.
BRONZE_COLUMNS: list[tuple[str, str, str]] = [
    ("Şehir ID'si/Adı", "city_id", "string"),
    ("Sensör ID'si/Adı", "sensor_id", "string"),
    ("Enlem", "latitude", "double"),
    ("Boylam", "longitude", "double"),
    ("Tarih/Zaman", "event_timestamp", "timestamp_ntz"),
    ("Sensör Tipi", "sensor_type", "string"),
    ("Sokak Tipi", "street_type", "string"),
    ("Yakındaki Hizmetler", "nearby_services", "string"),
    ("Araç Sayısı", "vehicle_count", "int"),
    ("kWh", "energy_kwh", "double"),
    ("Doluluk Oranı", "occupancy_rate", "double"),
    ("Gürültü Seviyesi", "noise_level", "double"),
]

# Accepted sensor types.
SENSOR_TYPES: list[str] = ["Trafik Sayacı", "Enerji Metre", "Atık Sensörü", "Çevre Sensörü"]

# City services: (service, base price, base weekly demand, price elasticity).
SERVICES: list[tuple[str, float, float, float]] = [
    ("metro", 30.0, 500000.0, -1.3),
    ("bus", 10.0, 800000.0, -1.1),
    ("private_transport", 80.0, 600000.0, -0.8),
    ("water", 5.0, 1000000.0, -0.4),
]

# Demand model constants.
BASE_POPULATION = 1.1e7
BASE_CONGESTION = 0.65
SIGNAL_LOAD_PER_CONGESTION = 0.6
SCORING_SIGNAL_LOAD = 0.6
FUEL_TAX_CONGESTION = 0.3
FESTIVAL_MONTHS = [1, 10, 11, 12]
FESTIVAL_DEMAND = 1.2
HOLIDAY_TRANSIT_DEMAND = 0.9      # metro, bus
HOLIDAY_PRIVATE_DEMAND = 1.1      # private_transport
SEASON_AMPLITUDE = 0.1
SEASON_PERIOD_WEEKS = 52
WEEKLY_SPINE_START = "2023-01-01"
WEEKLY_SPINE_PERIODS = 104

# Policy slider ranges: (column, low, high).
POLICY_RANGES: list[tuple[str, float, float]] = [
    ("metro_price", 10.0, 100.0),
    ("bus_price", 5.0, 50.0),
    ("private_transport_price", 50.0, 150.0),
    ("water_price", 1.0, 20.0),
    ("fuel_tax", 0.0, 0.3),
]
DEFAULT_POLICY = {
    "metro_price": 30.0, "bus_price": 10.0, "private_transport_price": 80.0,
    "water_price": 5.0, "fuel_tax": 0.1, "festival": 0, "holiday": 0,
}

# Demand model features, in training order.
DEMAND_FEATURES: list[str] = ["price", "population", "congestion", "signal_load", "festival", "holiday"]
# Columns of the hourly and the daily gold table.
HOURLY_COLUMNS = ["city_id", "sensor_type", "event_hour", "total_vehicles", "avg_vehicles", "max_vehicles",
                  "total_energy_kwh", "avg_energy_kwh", "max_energy_kwh", "avg_occupancy_rate",
                  "max_occupancy_rate", "avg_noise_level", "max_noise_level", "record_count", "unique_sensors",
                  "period_start", "period_end"]
DAILY_COLUMNS = ["city_id", "sensor_type", "event_date", "total_vehicles", "avg_vehicles", "total_energy_kwh",
                 "avg_energy_kwh", "avg_occupancy_rate", "avg_noise_level", "record_count", "unique_sensors"]

# Quality rules of the silver sensor table: (name, predicate, whether failing rows are dropped).
SILVER_RULES: list[tuple[str, str, bool]] = [
    ("valid_sensor_id", "sensor_id IS NOT NULL", False),
    ("valid_timestamp", "event_timestamp IS NOT NULL", False),
    ("valid_coordinates", "latitude IS NOT NULL AND longitude IS NOT NULL", False),
    ("valid_latitude", "latitude BETWEEN -90 AND 90", True),
    ("valid_longitude", "longitude BETWEEN -180 AND 180", True),
    ("valid_sensor_type", "sensor_type IN ({types})", True),
]

# Table names of the data model, for SQL written against them.
VIEW_NAMES = {
    "bronze": "bronze_sensor_data",
    "silver": "silver_sensor_data",
    "gold_hour": "gold_sensor_metrics_by_city_hour",
    "gold_day": "gold_sensor_metrics_by_city_day",
}
# --- end of fixed values ------------------------------------------------------

BRONZE_HEADERS: list[str] = [h for h, _, _ in BRONZE_COLUMNS]
SILVER_NAMES: list[str] = [n for _, n, _ in BRONZE_COLUMNS]

# Raw files are read as text; silver does the typing (try_cast), so a bad
# field becomes NULL instead of failing the stream.
#: The whole line of a row whose number of fields is not the header's, and a file's further columns as JSON.
CORRUPT, EXTRA = "_corrupt_record", "_extra"
BRONZE_SCHEMA = T.StructType([T.StructField(h, T.StringType(), True) for h in BRONZE_HEADERS]
                             + [T.StructField(CORRUPT, T.StringType(), True),
                                T.StructField(EXTRA, T.StringType(), True)])

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
          "timestamp_ntz": T.TimestampNTZType()}

SILVER_SCHEMA = T.StructType(
    [T.StructField(n, _TYPES[t], True) for _, n, t in BRONZE_COLUMNS]
    + [T.StructField("processed_at", T.TimestampType(), True)]
)

POLICY_SCHEMA = T.StructType(
    [T.StructField("policy_id", T.LongType(), False)]
    + [T.StructField(c, T.DoubleType(), False) for c, _, _ in POLICY_RANGES]
    + [T.StructField("festival", T.IntegerType(), False), T.StructField("holiday", T.IntegerType(), False)]
)

SERVICE_NAMES: list[str] = [s for s, _, _, _ in SERVICES]
