"""Thresholds, column lists and bucket edges, passed to the jobs as frozen values."""

from dataclasses import dataclass, field

# --- Fixed values: column names of the trip files ---------------------------------------------
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PICKUP_ALIASES = ("lpep_pickup_datetime", "pickup_datetime")
DROPOFF_ALIASES = ("lpep_dropoff_datetime", "dropoff_datetime")

RAW_REQUIRED = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
)
FEATURE_REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
)
NUMERIC_REQUIRED = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
NON_NEGATIVE = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
)
CANONICAL_TYPES = {
    "VendorID": "bigint",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "fare_amount": "double",
    "total_amount": "double",
}
TARGET = "trip_duration_minutes"
FEATURES = (
    "VendorID",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_month",
    "pickup_day",
    "is_weekend",
    "pickup_hour_sin",
    "pickup_hour_cos",
    "is_rush_hour",
    "PU_DO_pair",
)
CATEGORICAL = ("VendorID", "PULocationID", "DOLocationID", "PU_DO_pair")
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
LOCAL_ZONE = "America/New_York"

# --- Fixed values: histogram edges and built-in reference shares ------------------------------
DISTANCE_EDGES = (0.5, 1.0, 2.0, 3.0, 5.0, 10.0, 15.0, 20.0, 30.0, 50.0)
DISTANCE_SHARES = (0.08, 0.14, 0.22, 0.18, 0.17, 0.11, 0.04, 0.03, 0.015, 0.01, 0.005)
DURATION_EDGES = (3.0, 5.0, 10.0, 15.0, 20.0, 30.0, 45.0, 60.0)
DURATION_SHARES = (0.10, 0.15, 0.25, 0.20, 0.15, 0.08, 0.05, 0.02)
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PREDICTED_MINUTES_BOUNDS = (1.0, 3.0, 5.0, 10.0, 15.0, 20.0, 30.0, 45.0, 60.0, 90.0, 120.0)
DISTANCE_BOUNDS = DISTANCE_EDGES
KNOWN_ENDPOINTS = ("/", "/health", "/metrics", "/predict", "/predict/batch", "/docs", "/openapi.json")


@dataclass(frozen=True)
class CleaningLimits:
    min_minutes: float = 1.0
    max_minutes: float = 180.0
    max_distance: float = 100.0
    min_passengers: int = 1
    max_passengers: int = 9
    max_null_pct: float = 50.0
    max_loss_pct: float = 35.0
    max_mph: float = 75.0
    min_mph: float = 1.0
    slow_trip_minutes: float = 15.0


@dataclass(frozen=True)
class RequestLimits:
    vendors: tuple[int, int] = (1, 2)
    passengers: tuple[int, int] = (1, 9)
    zones: tuple[int, int] = (1, 265)
    max_distance: float = 100.0
    min_year: int = 2020
    min_last_year: int = 2027
    default_vendor: int = 1
    default_passengers: int = 1
    default_pickup_zone: int = 161
    default_dropoff_zone: int = 236


@dataclass(frozen=True)
class DriftSettings:
    window_rows: int = 500
    min_rows: int = 100
    every: int = 10
    floor: float = 0.005
    epsilon: float = 1e-4
    smoothing: float = 1e-4
    medium: float = 0.10
    high: float = 0.20


@dataclass(frozen=True)
class QualityGate:
    max_mae: float | None = 8.0
    min_r2: float | None = 0.30


@dataclass(frozen=True)
class ModelSettings:
    name: str = "trip_duration_regressor"
    algorithm: str = "boosting"
    features: tuple[str, ...] = FEATURES
    categorical: tuple[str, ...] = CATEGORICAL
    trees: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    bins: int = 128
    max_categories: int = 255
    seed: int = 42
    subsample_rows: int | None = 2_000_000
    history_months: int = 12
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    importance_rows: int | None = None
    importance_repeats: int = 5
    gate: QualityGate = field(default_factory=QualityGate)
