"""Feature engineering statements."""

from oracles.base import features, fleet, splits

NUMERIC = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min",
           "temp_diff_K", "power_W", "torque_x_toolwear", "speed_torque_ratio", "air_temp_z_within_type"]
NAMES = ["num__Air temperature [K]", "num__Process temperature [K]", "num__Rotational speed [rpm]", "num__Torque [Nm]",
         "num__Tool wear [min]", "num__temp_diff_K", "num__power_W", "num__torque_x_toolwear", "num__speed_torque_ratio",
         "num__air_temp_z_within_type", "cat_onehot__Type_H", "cat_onehot__Type_L", "cat_onehot__Type_M",
         "cat_ordinal__tool_wear_bucket"]
ENCODED = """CASE WHEN type_code = 'H' THEN 1 ELSE 0 END AS type_H, CASE WHEN type_code = 'L' THEN 1 ELSE 0 END AS type_L,
  CASE WHEN type_code = 'M' THEN 1 ELSE 0 END AS type_M,
  CASE tool_wear_bucket WHEN 'very_low' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3
       WHEN 'critical' THEN 4 ELSE -1 END AS tool_wear_ordinal"""
ENC = f", enc AS (SELECT zed.*, {ENCODED} FROM zed)"
STATS = ", st AS (SELECT " + ", ".join(
    f"AVG({c}) AS m{i}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS d{i}"
    for i, c in enumerate(NUMERIC)) + " FROM enc WHERE split = 'train')"
SCALED = ", ".join(f"ROUND(({c} - m{i}) / d{i}, 6) AS {c}" for i, c in enumerate(NUMERIC))
MATRIX = (ENC + STATS + f", mat AS (SELECT machine_id, split, machine_failure, {SCALED}, type_H, type_L, type_M, "
          "tool_wear_ordinal FROM enc CROSS JOIN st)")

MODE_SPLIT = """
, strata AS (SELECT failure_mode_label AS g, COUNT(*) AS n FROM eng GROUP BY 1)
, want1 AS (SELECT g, n, SUM(n) OVER () AS tot,
    SUM(n) OVER () - CAST(CEIL(SUM(n) OVER () * 30 / 100.0) AS BIGINT) AS want FROM strata)
, cuts AS (SELECT g, n, CAST(want * n // tot AS BIGINT) + CASE WHEN ROW_NUMBER() OVER (ORDER BY (want * n) % tot DESC, g)
    <= want - SUM(want * n // tot) OVER () THEN 1 ELSE 0 END AS c1 FROM want1)
, ranked AS (SELECT eng.*, ROW_NUMBER() OVER (PARTITION BY failure_mode_label
    ORDER BY md5(CONCAT(CAST(machine_id AS VARCHAR), '|42')), machine_id) AS rn FROM eng)
SELECT machine_id, failure_mode_label AS failure_mode, CASE WHEN rn <= c1 THEN 'train' ELSE 'test' END AS split
FROM ranked JOIN cuts ON cuts.g = ranked.failure_mode_label"""

ALIGNED = ", al AS (SELECT machine_id, " + ", ".join(
    f'ROUND({c}, 6) AS "{n}"' for c, n in zip(NUMERIC, NAMES)) + ", " + ", ".join(
    f'{c} AS "{n}"' for c, n in zip(["type_H", "type_L", "type_M", "tool_wear_ordinal"], NAMES[10:])) + " FROM enc)"


def _col(expr):
    return features(f"SELECT machine_id, {expr} FROM eng")


SQL = {
    "f01_select_inputs": fleet("""SELECT type_code, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm,
        tool_wear_min, machine_failure FROM obs"""),
    "f02_stratified_split": splits("SELECT machine_id, machine_failure, split FROM parts"),
    "f02_split_counts": splits("SELECT split, machine_failure, COUNT(*) AS n FROM parts GROUP BY 1, 2"),
    "f03_mode_split": features(MODE_SPLIT),
    "f04_temp_diff": _col("ROUND(temp_diff_K, 6) AS temp_diff_K"),
    "f05_power": _col("ROUND(power_W, 6) AS power_W"),
    "f06_torque_x_toolwear": _col("ROUND(torque_x_toolwear, 6) AS torque_x_toolwear"),
    "f07_speed_torque_ratio": _col("ROUND(speed_torque_ratio, 6) AS speed_torque_ratio"),
    "f08_wear_bucket": _col("tool_wear_min, tool_wear_bucket"),
    "f09_wear_quartile_label": features("""SELECT machine_id, tool_wear_min, CASE WHEN tool_wear_min <= a THEN 'Q1' WHEN tool_wear_min <= b THEN 'Q2'
        WHEN tool_wear_min <= c THEN 'Q3' ELSE 'Q4' END AS tool_wear_bucket FROM eng, (SELECT QUANTILE_CONT(tool_wear_min, 0.25) AS a,
        QUANTILE_CONT(tool_wear_min, 0.5) AS b, QUANTILE_CONT(tool_wear_min, 0.75) AS c FROM eng)"""),
    "f10_grouped_z": splits("SELECT machine_id, split, ROUND(air_temp_z_within_type, 6) AS air_temp_z_within_type FROM zed"),
    "f10_group_statistics": splits("""SELECT COALESCE(type_code, 'ALL') AS type_code, ROUND(AVG(air_temperature_k), 6) AS mean,
        ROUND(STDDEV_SAMP(air_temperature_k), 6) AS std FROM parts WHERE split = 'train' GROUP BY GROUPING SETS ((type_code), ())"""),
    "f11_in_sample_z": features("""SELECT machine_id, ROUND((air_temperature_k - AVG(air_temperature_k) OVER w) / STDDEV_SAMP(air_temperature_k) OVER w, 6)
        AS air_temp_z_within_type FROM eng WINDOW w AS (PARTITION BY type_code)"""),
    "f12_standardised": splits(MATRIX + " SELECT machine_id, split, " + ", ".join(NUMERIC) + " FROM mat"),
    "f13_one_hot": _col("CASE WHEN type_code = 'H' THEN 1 ELSE 0 END AS type_H, CASE WHEN type_code = 'L' THEN 1 ELSE 0 END AS type_L, "
                        "CASE WHEN type_code = 'M' THEN 1 ELSE 0 END AS type_M"),
    "f14_wear_ordinal": _col("CASE tool_wear_bucket WHEN 'very_low' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 "
                             "WHEN 'high' THEN 3 WHEN 'critical' THEN 4 ELSE -1 END AS tool_wear_ordinal"),
    "f15_feature_matrix": splits(MATRIX + " SELECT * FROM mat"),
    "f16_feature_table": features("""SELECT machine_id, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min,
        ROUND(temp_diff_K, 6) AS temp_diff_k, ROUND(torque_nm * (rotational_speed_rpm * 2 * 3.141592653589793E0 / 60), 6) AS mechanical_power_w,
        CASE WHEN type_code = 'H' THEN 1 ELSE 0 END AS type_H, CASE WHEN type_code = 'L' THEN 1 ELSE 0 END AS type_L,
        CASE WHEN type_code = 'M' THEN 1 ELSE 0 END AS type_M, machine_failure FROM eng"""),
    "f17_type_dummies": features("""SELECT type_code, SUM(CASE WHEN type_code = 'H' THEN 1 ELSE 0 END)::BIGINT AS type_H,
        SUM(CASE WHEN type_code = 'L' THEN 1 ELSE 0 END)::BIGINT AS type_L, SUM(CASE WHEN type_code = 'M' THEN 1 ELSE 0 END)::BIGINT AS type_M
        FROM eng GROUP BY type_code"""),
    "f18_aligned": splits(ENC + ALIGNED + " SELECT * FROM al"),
    "f19_display_names": splits(ENC + ALIGNED + " " + " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, '{n.replace("num__", "").replace("cat_onehot__", "").replace("cat_ordinal__", "")}' AS display_name,
        ROUND(AVG("{n}"), 4) AS mean_value FROM al""" for n in NAMES)),
    "f20_normal_training_rows": splits("SELECT machine_id FROM parts WHERE split = 'train' AND machine_failure = 0"),
    "f21_seeded_sample": features("SELECT machine_id, machine_failure FROM eng ORDER BY md5(CONCAT(CAST(machine_id AS VARCHAR), '|42')), machine_id LIMIT 100"),
}
