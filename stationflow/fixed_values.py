"""Constants a result depends on. Change none of them without changing results."""

# Index breakpoints per pollutant, as
# (lowest concentration, highest concentration, lowest index, highest index).
INDEX_BREAKPOINTS = {
    "PM2.5": [
        (0.0, 12.0, 0, 50),
        (12.1, 35.4, 51, 100),
        (35.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200),
        (150.5, 250.4, 201, 300),
        (250.5, 350.4, 301, 400),
        (350.5, 500.4, 401, 500),
    ],
    "O3": [
        (0.0, 54.0, 0, 50),
        (55.0, 70.0, 51, 100),
        (71.0, 85.0, 101, 150),
        (86.0, 105.0, 151, 200),
        (106.0, 200.0, 201, 300),
    ],
    "NO2": [
        (0.0, 53.0, 0, 50),
        (54.0, 100.0, 51, 100),
        (101.0, 360.0, 101, 150),
        (361.0, 649.0, 151, 200),
        (650.0, 1249.0, 201, 300),
        (1250.0, 1649.0, 301, 400),
        (1650.0, 2049.0, 401, 500),
    ],
}
INDEX_CEILING = 500.0

# Number of decimals kept when concentrations are truncated to the tables above.
INDEX_DECIMALS = {"PM2.5": 1, "O3": 0, "NO2": 0}

# Micrograms per cubic metre in one part per billion.
UGM3_PER_PPB = {"no2": 1.88, "o3": 1.97}
PPB_PER_PPM = 1000.0
PPB_PER_FRACTION = 1.0e9

# Gas columns the model delivers as volume fractions.
FRACTION_GASES = ["co", "hcho", "no", "no2", "noy", "o3", "so2"]

# Column names that differ between model versions (old name, common name).
VERSION_NAMES = {"t10m": "t", "u10m": "u", "v10m": "v", "pm25_rh35_gcc": "pm25_rh35"}

# Pressure and gas constants of the two mole-density conversions.
MILLIBAR_PER_ATM = 1013.25
MOLAR_VOLUME_PPB = 24.45 * 1e9
GAS_CONSTANT_ATM = 0.0821
INSTRUMENT_NO2_DIVISOR = 40.0
LAPSE_K_PER_M = 0.0065
BAROMETRIC_POWER = 5.2561
KELVIN_OFFSET = 273.15

# Instrument missing-value mark and quality rules.
INSTRUMENT_MISSING = -9e99
NO2_RANGE = (0.0, 100.0)
O3_RANGE = (0.0, 500.0)
O3_GOOD_FLAGS = [0, 1, 2, 10, 11, 12]

# Zero-based positions in an instrument text row.
INSTRUMENT_TIME = 0
NO2_POSITIONS = {"conc": 55, "pressure": 13, "temperature": 14, "flag": 52}
O3_POSITIONS = {"conc": 38, "flag": 35, "aod": 27}

# Three-hour forecast slots as (hour offset, label inside the column name).
FORECAST_SLOTS = [
    (1, "130"), (4, "430"), (7, "730"), (10, "1030"),
    (13, "1330"), (16, "1630"), (19, "1930"), (22, "2230"),
]
SLOT_CONC_COLUMN = "3HR_PM_CONC_CNN({})"
SLOT_INDEX_COLUMN = "3HR_AQI({})"

# Limits of the correction factor.
RATIO_LIMITS = (0.05, 20.0)

# Earliest observation time used by default.
EARLIEST_START = "2018-01-01 00:00:00"

# Columns of one published forecast row (the observation column is added by name).
FORECAST_FIELDS = [
    "no2", "corrected", "NO2_AQI", "o3", "O3_AQI", "avg", "pm25_rh35_gcc",
    "PM25_NowCast_AQI", "rh", "t10m", "tprec", "hcho", "pm25_conc_cnn", "pm25_aqi",
]

# Columns of the reduced hourly snapshot row.
SNAPSHOT_FIELDS = [
    "no2", "no2_aqi", "o3", "o3_aqi", "pm25", "pm25_aqi", "t10m", "rh", "wind_speed",
]
DEFAULT_SPECIES = "no2"

# Feature columns of the pooled trainer.
POOLED_FEATURES = [
    "no2", "o3", "co", "hcho", "no", "noy", "so2",
    "pm25_rh35", "pm25_rh35_gcc", "pm10_rh35",
    "pm25bc_rh35", "pm25du_rh35", "pm25nh4_rh35", "pm25nit_rh35",
    "pm25oc_rh35", "pm25soa_rh35", "pm25ss_rh35", "pm25su_rh35",
    "aod550_bc", "aod550_dust", "aod550_oc", "aod550_sala", "aod550_salc",
    "aod550_sulfate", "aod550_psc", "aod550_sla", "aod550_sna", "aod550_ss",
    "cldtt", "lev", "ps", "rh", "t10m", "tprec", "zpbl",
]

# Columns that never become features.
NEVER_FEATURES = ["time", "location", "lat", "lon", "value", "bias_ratio", "_site"]

# Map layer variable -> (pollutant, unit).
LAYER_META = {
    "PM25_RH35": ("pm25", "μg/m³"),
    "PM25_RH35_GCC": ("pm25", "μg/m³"),
    "NO2": ("no2", "mol/mol"),
    "O3": ("o3", "mol/mol"),
    "CO": ("co", "mol/mol"),
    "SO2": ("so2", "mol/mol"),
}
LAYER_UNKNOWN = ("default", "ppb")

# Global quarter-degree grid (origin, step, cells).
GRID_STEP = 0.25
GRID_SOUTH, GRID_WEST = -90.0, -180.0
GRID_ROWS, GRID_COLS = 721, 1440

# Monitor catalogue file name pattern.
MONITOR_FILE_PATTERN = r"\b[a-zA-Z0-9]*[a-zA-Z]+[a-zA-Z0-9]*\d+[a-zA-Z0-9]*\.json\b"

# Names of the evaluation statistics, in report order.
EVALUATION_NAMES = [
    ("mae", "Mean Absolute Error"),
    ("mse", "Mean Squared Error"),
    ("rmse", "Root Mean Squared Error"),
    ("mape", "Mean Absolute Percentage Error"),
    ("within", "Percentage Within Threshold"),
    ("pearson", "Pearson Correlation"),
    ("spearman", "Spearman Correlation"),
    ("r2", "R-squared"),
    ("autocorr", "Autocorrelation of Residuals"),
    ("std", "Standard Deviation of Residuals"),
    ("bias", "Mean Bias"),
    ("mean_actual", "Mean Actual Value"),
    ("mean_predicted", "Mean Predicted Value"),
]
