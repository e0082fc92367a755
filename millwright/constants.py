"""Fixed values of the data model.

Everything here must equal the published data dictionary and scoring contract, so that results
agree: names, domains, bin edges, labels, cost placeholders and feature order.
"""

# Raw header -> table column.
RAW_TO_CLEAN = {
    "UDI": "machine_id",
    "Product ID": "product_id",
    "Type": "type_code",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
}
CLEAN_TO_RAW = {clean: raw for raw, clean in RAW_TO_CLEAN.items()}

SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
TYPES = ["H", "L", "M"]

# Failure modes in melt order, with their descriptions.
MODES = ["TWF", "HDF", "PWF", "OSF", "RNF"]
UNSPECIFIED = "UNSPECIFIED"
MODE_ROWS = [
    ("TWF", "Tool Wear Failure"),
    ("HDF", "Heat Dissipation Failure"),
    ("PWF", "Power Failure"),
    ("OSF", "Overstrain Failure"),
    ("RNF", "Random Failure (unpredictable, not related to process parameters)"),
    ("UNSPECIFIED", "Machine failure flagged in source data without an attributed specific failure mode"),
]
TYPE_ROWS = [
    ("L", "Low", "Low quality variant product line"),
    ("M", "Medium", "Medium quality variant product line"),
    ("H", "High", "High quality variant product line"),
]
MAINTENANCE_TYPES = ["corrective", "preventive"]
MAINTENANCE_NOTE = "Simulated corrective maintenance for failure mode "

# Right-closed wear bins and their ordered labels.
WEAR_EDGES = [-0.1, 50.0, 100.0, 150.0, 200.0, 253.0]
WEAR_LABELS = ["very_low", "low", "medium", "high", "critical"]

# Right-closed status bands of the overview.
BAND_EDGES = [-0.01, 0.3, 0.7, 1.01]
BAND_LABELS = ["\U0001F7E2 Healthy", "\U0001F7E1 Needs monitoring", "\U0001F534 High failure risk"]
HIGH_RISK = BAND_LABELS[2]

# Scoring input, thresholds and the built-in rule score.
SCORING_COLUMNS = ["Type", "Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]",
                   "Torque [Nm]", "Tool wear [min]"]
DECISION_THRESHOLD = 0.5
ANOMALY_THRESHOLD = 0.6541
RULE_WEAR_FULL, RULE_WEAR_WEIGHT, RULE_WEAR_DEFAULT = 250, 0.6, 50
RULE_TORQUE_FULL, RULE_TORQUE_WEIGHT, RULE_TORQUE_DEFAULT = 80, 0.4, 40

# Cost placeholders.
DOWNTIME_COST = 5000
INSPECTION_COST, FAILURE_COST = 100, 1000
FALSE_ALARM_COST, MISSED_FAILURE_COST = 50, 1000

# The ordered feature vector.
ENGINEERED = ["temp_diff_K", "power_W", "torque_x_toolwear", "speed_torque_ratio"]
GROUPED_Z = "air_temp_z_within_type"
NUMERIC_FEATURES = SENSORS + ENGINEERED + [GROUPED_Z]
FEATURE_NAMES = [
    "num__Air temperature [K]",
    "num__Process temperature [K]",
    "num__Rotational speed [rpm]",
    "num__Torque [Nm]",
    "num__Tool wear [min]",
    "num__temp_diff_K",
    "num__power_W",
    "num__torque_x_toolwear",
    "num__speed_torque_ratio",
    "num__air_temp_z_within_type",
    "cat_onehot__Type_H",
    "cat_onehot__Type_L",
    "cat_onehot__Type_M",
    "cat_ordinal__tool_wear_bucket",
]
LEAKAGE_COLUMNS = ["machine_id", "product_id", "TWF", "HDF", "PWF", "OSF", "RNF"]

SEED = 42

# messages
TELEMETRY_MISSING = "No telemetry record found for Machine ID / UDI "
NOT_FOUND = "No relevant maintenance documentation found."
