"""Cleaning, validation and profiling statements."""

from oracles.base import fleet, pct

RAW_COLUMNS = ("machine_id, product_id, type_code, air_temperature_k, process_temperature_k, rotational_speed_rpm, "
               "torque_nm, tool_wear_min, machine_failure, twf AS \"TWF\", hdf AS \"HDF\", pwf AS \"PWF\", "
               "osf AS \"OSF\", rnf AS \"RNF\"")
PROFILE = ("type_code, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min, "
           "machine_failure, twf, hdf, pwf, osf, rnf")
FEED = f", feed AS (SELECT {RAW_COLUMNS} FROM obs)"
SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
FLAGS = ["TWF", "HDF", "PWF", "OSF", "RNF", "machine_failure"]


def _violations(rules):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) AS n_rows, COUNT(*) FILTER (NOT ({test})) AS n_violations FROM feed"
        for name, test in rules)


DOMAIN = [("type_code in domain", "type_code IN ('L','M','H')")] + [
    (f"{f} is binary", f"{f} IN (0, 1)") for f in ["TWF", "HDF", "PWF", "OSF", "RNF", "machine_failure"]]
RANGE = [("air_temperature_k > 0", "air_temperature_k > 0"), ("process_temperature_k > 0", "process_temperature_k > 0"),
         ("rotational_speed_rpm >= 0", "rotational_speed_rpm >= 0"), ("torque_nm >= 0", "torque_nm >= 0"),
         ("tool_wear_min >= 0", "tool_wear_min >= 0")]
EVENT_RULES = [("value is positive", "value > 0"), ("event_type is known", "event_type IN ('click', 'view')"),
               ("user is set", "user_id IS NOT NULL"), ("value below 100", "value < 100")]
LABEL_RULES = [("quality is binary", "quality IN (0, 1)"), ("toxic is binary", "toxic IN (0, 1)"),
               ("quality is set", "quality = 1")]


def _fk(child, column, parent, parent_column):
    return (f"SELECT '{child}.{column}' AS foreign_key, COUNT(*) AS n_rows, "
            f"COUNT(*) FILTER (NOT EXISTS (SELECT 1 FROM {parent} x WHERE x.{parent_column} = c.{column})) AS n_orphans "
            f"FROM {child} c WHERE c.{column} IS NOT NULL")


FLEET_KEYS = [("machines", "type_code", "machine_type", "type_code"), ("sensor_readings", "machine_id", "machines", "machine_id"),
              ("failure_events", "reading_id", "sensor_readings", "reading_id"),
              ("failure_events", "machine_id", "machines", "machine_id"),
              ("failure_events", "failure_mode_code", "failure_mode", "failure_mode_code"),
              ("maintenance_events", "machine_id", "machines", "machine_id"),
              ("maintenance_events", "event_id", "failure_events", "event_id")]
SOURCE_KEYS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
               ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
               ("customer", "c_nationkey", "nation", "n_nationkey"), ("labels", "doc_id", "documents", "doc_id")]


UNIQUE = [("machine_type", "type_code"), ("machines", "machine_id"), ("machines", "product_id"), ("sensor_readings", "reading_id"),
          ("failure_mode", "failure_mode_code"), ("failure_events", "event_id"), ("maintenance_events", "maintenance_id")]


def _rules_on(table, rules):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) AS n_rows, COUNT(*) FILTER (NOT COALESCE({test}, FALSE)) AS n_violations FROM {table}"
        for name, test in rules)


SQL = {
    "a01_raw_scan": fleet(f"""SELECT machine_id AS "UDI", product_id AS "Product ID", type_code AS "Type",
        air_temperature_k AS "Air temperature [K]", process_temperature_k AS "Process temperature [K]",
        rotational_speed_rpm AS "Rotational speed [rpm]", torque_nm AS "Torque [Nm]", tool_wear_min AS "Tool wear [min]",
        machine_failure AS "Machine failure", twf AS "TWF", hdf AS "HDF", pwf AS "PWF", osf AS "OSF", rnf AS "RNF" FROM obs"""),
    "a05_unique_keys": fleet(", sensor_readings AS (SELECT reading_id FROM obs) " + " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS unique_key, COUNT(*) AS n_rows, COUNT(*) - COUNT(DISTINCT {c}) AS n_repeated FROM {t}" for t, c in UNIQUE), machine="p"),
    "b01_drop_copies": "SELECT lang, source, n_chars, md5(text) AS digest FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)",
    "b01_copy_report": """SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS n_distinct,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS n_duplicates FROM documents""",
    "b02_rename": fleet(f"SELECT {RAW_COLUMNS} FROM obs"),
    "b03_coercion": fleet(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n_values, "
        f"COUNT(*) FILTER (TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL) AS n_rejected FROM obs"
        for c in [*SENSORS, "product_id"])),
    "b04_key_violations": """SELECT 'digest' AS key_column, md5(text) AS key_value, COUNT(*) AS n FROM documents GROUP BY 2 HAVING COUNT(*) > 1
        UNION ALL SELECT 'doc_id', CAST(doc_id AS VARCHAR), COUNT(*) FROM documents GROUP BY 2 HAVING COUNT(*) > 1""",
    "b04_key_violations_repeated": fleet("""
        SELECT 'machine_id' AS key_column, CAST(machine_id AS VARCHAR) AS key_value, COUNT(*) AS n FROM obs GROUP BY machine_id HAVING COUNT(*) > 1
        UNION ALL SELECT 'reading_id', CAST(reading_id AS VARCHAR), COUNT(*) FROM obs GROUP BY reading_id HAVING COUNT(*) > 1""", machine="p"),
    "b05_domain_rules": fleet(FEED + _violations(DOMAIN)),
    "b06_range_rules": fleet(FEED + _violations(RANGE)),
    "b06_event_rules": _rules_on("events", EVENT_RULES),
    "b05_label_rules": _rules_on("labels", LABEL_RULES),
    "b07_foreign_keys": fleet(", sensor_readings AS (SELECT reading_id, machine_id FROM obs) "
                              + " UNION ALL ".join(_fk(*k) for k in FLEET_KEYS), machine="p"),
    "b07_source_keys": " UNION ALL ".join(_fk(*k) for k in SOURCE_KEYS),
    "b09_label_consistency": fleet("""SELECT COUNT(*) AS n_rows,
        COUNT(*) FILTER (GREATEST(twf,hdf,pwf,osf,rnf) <> machine_failure) AS inconsistent,
        COUNT(*) FILTER (machine_failure = 1 AND twf+hdf+pwf+osf+rnf = 0) AS failure_without_mode,
        COUNT(*) FILTER (machine_failure = 0 AND twf+hdf+pwf+osf+rnf > 0) AS mode_without_failure,
        COUNT(*) FILTER (twf+hdf+pwf+osf+rnf > 1) AS multi_mode FROM obs"""),
    "b09_inconsistent_rows": fleet("""SELECT machine_id, type_code, machine_failure, twf AS "TWF", hdf AS "HDF", pwf AS "PWF",
        osf AS "OSF", rnf AS "RNF" FROM obs WHERE GREATEST(twf,hdf,pwf,osf,rnf) <> machine_failure"""),
    "b10_missing_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, {pct(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)', 3)} AS missing_pct FROM events"
        for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]),
    "b10_missing_profile_fleet": fleet(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, {pct(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)', 3)} AS missing_pct FROM obs"
        for c in ["machine_id", "product_id", "type_code", *SENSORS, *FLAGS])),
    "b11_duplicate_profile": """SELECT COUNT(*) AS n_rows,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicated_rows,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS duplicated_without_ids FROM documents""",
    "b11_duplicate_profile_fleet": fleet(FEED + f""" SELECT COUNT(*) AS n_rows,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT machine_id, product_id, {PROFILE} FROM feed)) AS duplicated_rows,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {PROFILE} FROM feed)) AS duplicated_without_ids FROM feed"""),
    "b12_id_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS id_column, MIN({c}) AS min_id, MAX({c}) AS max_id, COUNT(DISTINCT {c}) AS n_unique, COUNT(*) AS n_rows,
        (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {c})) AS max_repeats,
        CASE WHEN MAX({c}) - MIN({c}) + 1 = COUNT(DISTINCT {c}) THEN 1 ELSE 0 END AS contiguous FROM {t}"""
        for t, c in [("events", "event_id"), ("events", "user_id")]),
    "b12_id_profile_fleet": fleet(FEED + """ SELECT 'machine_id' AS id_column, MIN(machine_id) AS min_id, MAX(machine_id) AS max_id,
        COUNT(DISTINCT machine_id) AS n_unique, COUNT(*) AS n_rows,
        (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM feed GROUP BY machine_id)) AS max_repeats,
        CASE WHEN MAX(machine_id) - MIN(machine_id) + 1 = COUNT(DISTINCT machine_id) THEN 1 ELSE 0 END AS contiguous FROM feed"""),
    "b13_prefix_agreement": fleet(f"""SELECT COUNT(*) FILTER (SUBSTR(product_id, 1, 1) = type_code) AS n_match, COUNT(*) AS n_rows,
        {pct("COUNT(*) FILTER (SUBSTR(product_id, 1, 1) = type_code)", "COUNT(*)", 1)} AS match_pct FROM obs"""),
    "b14_binary_values": fleet(" UNION ".join(f"SELECT '{f}' AS column_name, {f} AS value FROM obs" for f in FLAGS)),
    "b15_leakage_agreement": fleet(f"""SELECT COUNT(*) FILTER (GREATEST(twf,hdf,pwf,osf,rnf) = machine_failure) AS n_agree,
        COUNT(*) AS n_rows, {pct("COUNT(*) FILTER (GREATEST(twf,hdf,pwf,osf,rnf) = machine_failure)", "COUNT(*)")} AS agreement_pct FROM obs"""),
    "c01_machine_type": fleet("""SELECT t.type_code, t.type_name, t.description, COUNT(*) AS n_machines
        FROM machine_type t JOIN machines m USING (type_code) GROUP BY 1, 2, 3"""),
    "c02_machines": fleet("SELECT * FROM machines"),
    "c02_machines_repeated": fleet("SELECT * FROM machines", machine="p"),
    "c03_sensor_readings": fleet("SELECT reading_id, machine_id, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min FROM obs", machine="p"),
    "c04_failure_mode": fleet("""SELECT m.failure_mode_code, m.description, COUNT(e.reading_id) AS n_events
        FROM failure_mode m LEFT JOIN melted e USING (failure_mode_code) GROUP BY 1, 2"""),
    "c05_melt_failures": fleet("SELECT reading_id, machine_id, failure_mode_code, is_overall_failure FROM melted"),
    "c06_failure_events": fleet("SELECT * FROM failure_events", machine="p"),
    "c07_maintenance_events": fleet("SELECT * FROM maintenance_events"),
    "c08_inverse_one_hot": fleet("""SELECT machine_id, type_code AS "Type", air_temperature_k AS "Air temperature [K]",
        process_temperature_k AS "Process temperature [K]", rotational_speed_rpm AS "Rotational speed [rpm]",
        torque_nm AS "Torque [Nm]", tool_wear_min AS "Tool wear [min]" FROM obs"""),
    "c09_failure_label": fleet("""SELECT machine_id, CASE WHEN twf=1 THEN 'TWF' WHEN hdf=1 THEN 'HDF' WHEN pwf=1 THEN 'PWF'
        WHEN osf=1 THEN 'OSF' WHEN rnf=1 THEN 'RNF' ELSE 'None' END AS failure_mode FROM obs"""),
}
