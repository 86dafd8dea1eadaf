"""Fixed values that must equal the reference behaviour for right results.

Kept together, as plain text, in natural order.
"""

# --- fixed values: weather / feature contract -------------------------------
WEATHER_COLUMNS = [
    "grid_id",
    "date",
    "temperature_max",
    "temperature_min",
    "humidity_mean",
    "humidity_min",
    "precipitation_total",
    "wind_speed_max",
    "wind_direction_dominant",
]
STATIC_COLUMNS = [
    "grid_id",
    "vegetation_cover_mean",
    "fuel_model_dominant",
    "landfire_missing",
]
REFERENCE_COLUMNS = ["grid_id", "elevation", "centroid_lat", "centroid_lon"]
HISTORY_COUNT_COLUMN = "historical_firms_detection_count_2020_2023"
HISTORY_LOG_COLUMN = "historical_firms_detection_count_log"

# Past-only windows of the daily snapshot and of the training panel:
# (days or rows, source column, aggregation, minimum non-null values, output)
PAST_WINDOW_SPECS = [
    (7, "precipitation_total", "sum", 3, "rain_previous_7d"),
    (30, "precipitation_total", "sum", 7, "rain_previous_30d"),
    (3, "temperature_max", "max", 1, "temperature_max_previous_3d"),
    (3, "humidity_min", "min", 1, "humidity_min_previous_3d"),
]
# Windows that include the current day (minimum one value).
INCLUSIVE_WINDOW_SPECS = [
    (7, "precipitation_total", "sum", 1, "rain_7d"),
    (30, "precipitation_total", "sum", 1, "rain_30d"),
    (3, "temperature_max", "max", 1, "temperature_max_3d"),
    (3, "humidity_min", "min", 1, "humidity_min_3d"),
]

# Feed variable names -> model column names.
WEATHER_API_RENAMES = {
    "time": "date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "relative_humidity_2m_mean": "humidity_mean",
    "relative_humidity_2m_min": "humidity_min",
    "precipitation_sum": "precipitation_total",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_direction_10m_dominant": "wind_direction_dominant",
}

# Columns that a training table has to hold.
TRAINING_REQUIRED = [
    "date",
    "grid_id",
    "centroid_lat",
    "centroid_lon",
    "temperature_max",
    "temperature_min",
    "humidity_mean",
    "humidity_min",
    "precipitation_total",
    "rain_7d",
    "rain_30d",
    "wind_speed_max",
    "fire_today",
    "fire_next_day",
]
# Columns that tell one satellite detection from another.
DETECTION_KEY = ["latitude", "longitude", "acq_date", "acq_time", "satellite", "instrument"]
# Name and weight of the positive class that candidate models try; the second is
# the square root of the training rows' imbalance.
WEIGHT_CANDIDATES = [("unweighted", 1.0), ("sqrt_imbalance", None), ("moderate_weight", 40.0)]

# --- fixed values: publishing ------------------------------------------------
RISK_TIERS = [(99.0, "Extreme"), (95.0, "High"), (90.0, "Medium")]
RISK_TIER_DEFAULT = "Low"
EXPECTED_GRID_COUNT = 4355
CATEGORICAL_MISSING_TOKEN = "__MISSING__"
PUBLISH_AREA = "California analysis grid"
PUBLISH_TARGET = "next-day FIRMS hotspot detection"
PUBLISH_SCORE_SEMANTICS = (
    "Within-day relative risk percentile, not calibrated wildfire probability."
)
DISPLAY_COLUMNS = [
    "grid_id",
    "centroid_lat",
    "centroid_lon",
    "temperature_max",
    "humidity_min",
    "wind_speed_max",
    "precipitation_total",
    "fuel_model_dominant",
]
# Condition phrases shown for a cell, with their limits, in display order;
# at most three are joined with ", "; none -> the fallback phrase.
CONDITION_PHRASES = [
    ("temperature_max", ">=", 30.0, "high maximum temperature"),
    ("humidity_min", "<=", 30.0, "low minimum humidity"),
    ("wind_speed_max", ">=", 30.0, "strong maximum wind"),
    ("precipitation_total", "<=", 0.5, "little forecast precipitation"),
]
CONDITION_FALLBACK = "the combined weather, vegetation, and historical-fire features"
CONDITION_PREFIX = "Conditions supplied to the model include "
CONDITION_SUFFIX = ". This summary is descriptive, not a feature-attribution analysis."
MAX_CONDITION_PHRASES = 3
# Pin clustering cell size (pixels) by zoom: zoom <= 5, 6, 7, 8; none from 9.
CLUSTER_PIXELS_BY_ZOOM = [(5, 110), (6, 90), (7, 72), (8, 52)]

# --- fixed values: evaluation ------------------------------------------------
TOP_FRACTIONS = (0.01, 0.05, 0.10)
MINIMUM_RECALL = 0.70
NDCG_CUTOFF = 44
BLEND_WEIGHT_UNITS = 4
HISTORY_DAYS = 30

# Rolling-origin folds: (name, validation start, test start, test end exclusive)
BACKTEST_FOLDS = [
    ("late_fire_season_2023", "2023-08-01", "2023-09-16", "2023-10-30"),
    ("late_fire_season_2024", "2024-08-01", "2024-09-16", "2024-10-30"),
]
# Fixed single split: validation start, test start.
SINGLE_SPLIT = ("2024-08-01", "2024-09-16")

# Replacement values of the leakage audit.
PERTURBED_WEATHER = {"precipitation_total": 999999.0, "temperature_max": 999999.0, "humidity_min": -999999.0}

# Fire season used for prior-year summaries: May 1 to Oct 30 inclusive.
SEASON_START = (5, 1)
SEASON_END = (10, 30)
HISTORY_YEARS = (2020, 2023)

# --- fixed values: geometry --------------------------------------------------
# EPSG:3310 (NAD83 / California Albers), public EPSG definition, GRS80.
ALBERS = {
    "a": 6378137.0,
    "inv_f": 298.257222101,
    "lat1": 34.0,
    "lat2": 40.5,
    "lat0": 0.0,
    "lon0": -120.0,
    "false_easting": 0.0,
    "false_northing": -4000000.0,
}
GRID_CELL_METRES = 10000.0
MAX_ASSIGN_DISTANCE_METRES = 10000.0
GRID_ID_FORMAT = "CA-%05d"
