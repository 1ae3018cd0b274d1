"""Fixed values of the sensor data set: names, label maps, bounds and window lengths."""

# Source column name -> column name used here.
SOURCE_COLUMNS = {
    "Session ID": "session_id",
    "Time of Day": "time_of_day",
    "Temperature": "temperature",
    "Humidity": "humidity",
    "CO2_InfraredSensor": "co2_infrared",
    "CO2_ElectroChemicalSensor": "co2_electrochem",
    "MetalOxideSensor_Unit1": "mox_1",
    "MetalOxideSensor_Unit2": "mox_2",
    "MetalOxideSensor_Unit3": "mox_3",
    "MetalOxideSensor_Unit4": "mox_4",
    "CO_GasSensor": "co_gas",
    "HVAC Operation Mode": "hvac_mode",
    "Ambient Light Level": "ambient_light",
    "Activity Level": "activity_level",
}

SESSION = "session_id"
TARGET = "activity_level"
ROW_ORDER = ["ts", "reading_id"]

NUMERIC = [
    "temperature", "humidity", "co2_infrared", "co2_electrochem",
    "mox_1", "mox_2", "mox_3", "mox_4", "co_gas",
]
CATEGORICAL = ["time_of_day", "hvac_mode", "ambient_light", "activity_level"]
METAL_OXIDE = ["mox_1", "mox_2", "mox_3", "mox_4"]

# Spelling found in the data -> canonical label. Anything else becomes NULL.
ACTIVITY_LABELS = {
    "Low Activity": "Low Activity",
    "Low_Activity": "Low Activity",
    "LowActivity": "Low Activity",
    "Moderate Activity": "Moderate Activity",
    "ModerateActivity": "Moderate Activity",
    "High Activity": "High Activity",
}

# Ordinal codes.
ACTIVITY_CODES = {"Low Activity": 0, "Moderate Activity": 1, "High Activity": 2}
ACTIVITY_ORDER = ["Low Activity", "Moderate Activity", "High Activity"]
LIGHT_CODES = {"very_dim": 0, "dim": 1, "moderate": 2, "bright": 3, "very_bright": 4}
LIGHT_DEFAULT = 2

# Physical bounds (inclusive; None = open) and repair lists.
TEMPERATURE_BOUNDS = (10.0, 40.0)
HUMIDITY_BOUNDS = (0.0, 100.0)
CO2_BOUNDS = (0.0, None)
MEDIAN_FILLED = ["humidity", "mox_2", "co_gas"]
NEGATIVE_REPAIRED = ["humidity", "co_gas", "co2_infrared"]
SANITISED = ["humidity", "co2_infrared", "mox_2", "co_gas"]

# Window lengths, limits, report sizes.
VOLATILITY_ROWS = 5
BASELINE_ROWS = 10
SPIKE_LIMIT = 30.0
SKEW_LIMIT = 0.5
KURTOSIS_LIMIT = 1.0
HISTOGRAM_BINS = 50
SESSION_HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
VIOLIN_POINTS = 100
VIOLIN_CUT = 2.0
WHISKER = 1.5
TOP_SESSIONS = 20
TEST_SHARE = 0.2
FOLDS = 5
SEED = 42
SMOTE_NEIGHBOURS = 5
SEARCH_DRAWS = 20
