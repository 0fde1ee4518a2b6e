"""Fixed values. Results depend on these numbers and words; keep them as they are."""

# Monitored districts and their coordinates (latitude, longitude).
DISTRICTS = {
    "Bara": (27.0667, 85.0667),
    "Dhanusa": (26.8167, 86.0000),
    "Sarlahi": (26.8667, 85.5833),
    "Parsa": (27.1333, 84.8833),
    "Siraha": (26.6536, 86.2019),
}

# Cities of the payload feed and their coordinates (latitude, longitude).
CITIES = {
    "Kathmandu": (27.7172, 85.3240),
    "Pokhara": (28.2096, 83.9856),
    "Chitawan": (27.5291, 84.3542),
    "Biratnagar": (26.4525, 87.2718),
    "Lalitpur": (27.6588, 85.3247),
    "Bharatpur": (27.6833, 84.4333),
    "Birgunj": (27.0104, 84.8821),
    "Butwal": (27.7006, 83.4483),
    "Dharan": (26.8065, 87.2846),
    "Bhaktapur": (27.6710, 85.4298),
    "Janakpur": (26.7288, 85.9263),
    "Hetauda": (27.4167, 85.0333),
    "Nepalgunj": (28.0500, 81.6167),
    "Siraha": (26.6544, 86.2009),
    "Dhangadhi": (28.6833, 80.6000),
}

# Cleaning ranges (inclusive) and fill-ins.
VALID_RANGE = {"temp": (-50, 60), "humidity": (0, 100), "pressure": (800, 1100)}
FILL_WHEN_NULL = {"rain_1h": 0.0, "rain_3h": 0.0, "snow_1h": 0.0, "visibility": 10000}

# Angle constant and periods of the cyclic columns.
SHORT_PI = 3.14159
DAYS_COMMON_YEAR = 365
DAYS_JULIAN_YEAR = 365.25
HOURS_PER_DAY = 24

# Day flags, "more than".
CLOUDY_PERCENT = 50
WINDY_SPEED = 10

# Heat index of the batch profile (from 27 degrees up).
HEAT_INDEX_FROM = 27
HEAT_INDEX_TERMS = {"base": -8.785, "temp": 1.611, "humidity": 2.339, "both": -0.146}

# Risk levels of the batch profile, reached at "bound or more".
BATCH_HEAT_LEVELS = ((40, 3), (35, 2), (32, 1))
BATCH_FLOOD_LEVELS = ((50, 3), (20, 2), (5, 1))
BATCH_HUMIDITY_LEVELS = ((90, 2), (80, 1))

# Risk levels of the stream profile, reached at "more than bound".
STREAM_HEAT_LEVELS = ((40, 0.9), (35, 0.5), (30, 0.2))
STREAM_FLOOD_RAIN_LEVELS = ((50, 0.8), (20, 0.5))
STREAM_FLOOD_HUMID = (90, 0.3)
STREAM_FLOOD_FLOOR = 0.1
STREAM_HUMIDITY_LEVELS = ((90, "HIGH"), (70, "MEDIUM"))

# Versions written into the lineage column.
BATCH_VERSION = "1.0"
STREAM_VERSION = "kafka-spark-hdfs-1.0"

# Alerts ("more than bound") and their severity bound.
ALERT_LEVEL = 2
HOT_ABOVE, HOT_SEVERE_ABOVE = 40, 45
WET_ABOVE, WET_SEVERE_ABOVE = 100, 150
HOT_MESSAGE = "Extreme temperature: %.1f°C"
WET_MESSAGE = "Heavy precipitation: %.1fmm"

# Label ladders.
RISK_ABOVE = ((0.5, "HIGH"), (0.3, "MEDIUM"))
RISK_FROM = ((0.7, "HIGH"), (0.4, "MEDIUM"))
RISK_FIVE = (
    (0.8, ("EXTREME RISK", "Immediate action required!")),
    (0.6, ("HIGH RISK", "High risk - Take precautions")),
    (0.4, ("MODERATE RISK", "Moderate risk - Stay alert")),
    (0.2, ("LOW RISK", "Low risk - Normal conditions")),
)
RISK_FIVE_REST = ("MINIMAL RISK", "Minimal risk - Safe conditions")

# Display bands ("more than").
TEMP_BANDS = ((40, "red"), (35, "yellow"))
PRECIP_BANDS = ((50, "blue"), (10, "cyan"))
PROGRESS_BANDS = ((80, "red"), (50, "yellow"))

# Label quantiles and spell length.
HEAT_QUANTILE = 0.95
HEAT_MIN_RUN = 3
RAIN_1D_QUANTILE = 0.99
RAIN_3D_QUANTILE = 0.98
WET_QUANTILE = 0.90

# Rolling features.
LAG_DAYS = (1, 2, 3, 7, 14)
WETNESS_DECAY = 0.8
TIMESTEPS = 14
TEST_DAYS = 365
MISSING_MARK = -999.0

# Columns of the feature table.
FEATURE_COLUMNS = [
    "Date", "District", "Latitude", "Longitude",
    "Precip", "precip_3d", "precip_7d", "precip_lag_1", "precip_lag_3", "precip_lag_7",
    "MaxTemp_2m", "maxT_3d_mean", "maxT_lag_1", "maxT_lag_3", "anom_maxT",
    "RH_2m", "wetness_flag", "API", "TempRange_2m", "WindSpeed_10m", "WindSpeed_50m",
    "doy_sin", "doy_cos", "month", "year", "heatwave", "flood_proxy",
]
# Columns that are never model inputs.
NOT_INPUTS = ("Date", "District", "heatwave", "flood_proxy", "Latitude", "Longitude")
SEQUENCE_NOT_INPUTS = ("Date", "District", "heatwave", "flood_proxy")

# The two smaller model input lists, with the stand-in for an absent value.
STATION_INPUTS = {
    "max_temp": 25.0, "min_temp": 15.0, "precipitation": 0.0, "humidity": 50.0,
    "wind_speed": 5.0, "pressure": 1013.0, "cloudiness": 50.0,
}
REPLAY_INPUTS = ["Precip", "MaxTemp_2m", "RH_2m", "TempRange_2m", "WindSpeed_10m", "WindSpeed_50m"]
