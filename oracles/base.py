"""Common table expressions the statements start from. Only the delivered tables are registered."""

OBSERVATIONS = """
k AS (
  SELECT l_orderkey * 1000000 - 1 + ROW_NUMBER() OVER (
           PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                            l_returnflag, l_linestatus, l_shipdate) AS udi,
         l_partkey AS p,
         l_partkey * 8191 + l_suppkey * 131 + CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS u,
         CAST(ROUND(l_discount * 100) AS INT) AS disc,
         CAST(ROUND(l_tax * 100) AS INT) AS tax,
         CAST(l_quantity AS INT) AS qty,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem
)"""

SENSE = """
, s AS (
  SELECT udi, p, u,
         CASE WHEN p % 10 < 6 THEN 'L' WHEN p % 10 < 9 THEN 'M' ELSE 'H' END AS type,
         29500 + disc * 90 + CASE WHEN u % 211 = 0 THEN 900 ELSE 0 END AS air_c,
         845 + tax * 40 + CAST(cents % 40 AS INT) AS gap_c,
         1160 + CAST((cents % 42) * (p % 42) AS INT) AS rpm,
         3450 + 115 * (qty - 1) AS watts,
         CAST((u * 7 + p * 31) % 254 AS INT) AS wear
  FROM k
), v AS (
  SELECT udi, p, u, type, air_c, air_c + gap_c AS proc_c, rpm, wear,
         CAST(ROUND(watts * 9.549296585513721E0 * 100 / rpm) AS INT) AS torque_c
  FROM s
), f AS (
  SELECT v.*,
         CASE WHEN wear >= 240 AND u % 5 = 0 THEN 1 ELSE 0 END AS twf,
         CASE WHEN proc_c - air_c < 860 AND rpm < 1380 THEN 1 ELSE 0 END AS hdf,
         CASE WHEN CAST(torque_c AS BIGINT) * rpm < 3342254 OR CAST(torque_c AS BIGINT) * rpm > 8594367 THEN 1 ELSE 0 END AS pwf,
         CASE WHEN torque_c * wear > CASE type WHEN 'L' THEN 1100000 WHEN 'M' THEN 1200000 ELSE 1300000 END THEN 1 ELSE 0 END AS osf,
         CASE WHEN u % 521 = 0 THEN 1 ELSE 0 END AS rnf
  FROM v
), obs AS (
  SELECT udi AS reading_id, {machine} AS machine_id, CONCAT(type, CAST(10000 + {machine} AS VARCHAR)) AS product_id,
         type AS type_code,
         CAST(air_c AS DOUBLE) / 100 AS air_temperature_k, CAST(proc_c AS DOUBLE) / 100 AS process_temperature_k,
         rpm AS rotational_speed_rpm, CAST(torque_c AS DOUBLE) / 100 AS torque_nm, wear AS tool_wear_min, torque_c,
         CASE WHEN twf + hdf + pwf + osf > 0 OR u % 1009 = 0 THEN 1 ELSE 0 END AS machine_failure,
         twf, hdf, pwf, osf, rnf
  FROM f
)"""

DIMENSIONS = """
, machine_type(type_code, type_name, description) AS (
  VALUES ('L', 'Low', 'Low quality variant product line'),
         ('M', 'Medium', 'Medium quality variant product line'),
         ('H', 'High', 'High quality variant product line')
), failure_mode(failure_mode_code, description) AS (
  VALUES ('TWF', 'Tool Wear Failure'), ('HDF', 'Heat Dissipation Failure'), ('PWF', 'Power Failure'),
         ('OSF', 'Overstrain Failure'),
         ('RNF', 'Random Failure (unpredictable, not related to process parameters)'),
         ('UNSPECIFIED', 'Machine failure flagged in source data without an attributed specific failure mode')
), machines AS (
  SELECT DISTINCT machine_id, product_id, type_code FROM obs
), melted AS (
  SELECT reading_id, machine_id, 0 AS mode_order, 'TWF' AS failure_mode_code, machine_failure AS is_overall_failure
    FROM obs WHERE twf = 1
  UNION ALL SELECT reading_id, machine_id, 1, 'HDF', machine_failure FROM obs WHERE hdf = 1
  UNION ALL SELECT reading_id, machine_id, 2, 'PWF', machine_failure FROM obs WHERE pwf = 1
  UNION ALL SELECT reading_id, machine_id, 3, 'OSF', machine_failure FROM obs WHERE osf = 1
  UNION ALL SELECT reading_id, machine_id, 4, 'RNF', machine_failure FROM obs WHERE rnf = 1
  UNION ALL SELECT reading_id, machine_id, 5, 'UNSPECIFIED', 1 FROM obs
    WHERE machine_failure = 1 AND twf + hdf + pwf + osf + rnf = 0
), failure_events AS (
  SELECT ROW_NUMBER() OVER (ORDER BY reading_id, mode_order) AS event_id, reading_id, machine_id,
         failure_mode_code, is_overall_failure
  FROM melted
), maintenance_events AS (
  SELECT e.event_id AS maintenance_id, e.machine_id, e.event_id, 'corrective' AS maintenance_type,
         COALESCE(o.tool_wear_min, 0) AS tool_wear_at_event, 1 AS is_synthetic,
         CONCAT('Simulated corrective maintenance for failure mode ', e.failure_mode_code) AS notes
  FROM failure_events e LEFT JOIN obs o ON o.reading_id = e.reading_id
)"""

FEATURES = """
, eng AS (
  SELECT obs.*, process_temperature_k - air_temperature_k AS temp_diff_K,
         torque_nm * (rotational_speed_rpm * 2 * 3.141592653589793E0 / 60) AS power_W,
         torque_nm * tool_wear_min AS torque_x_toolwear,
         CASE WHEN torque_nm <> 0 THEN rotational_speed_rpm / torque_nm END AS speed_torque_ratio,
         CASE WHEN tool_wear_min <= -0.1 THEN NULL WHEN tool_wear_min <= 50 THEN 'very_low'
              WHEN tool_wear_min <= 100 THEN 'low' WHEN tool_wear_min <= 150 THEN 'medium'
              WHEN tool_wear_min <= 200 THEN 'high' WHEN tool_wear_min <= 253 THEN 'critical' END AS tool_wear_bucket,
         LEAST(GREATEST((CAST(tool_wear_min AS DOUBLE) / 250) * 0.6E0 + (torque_nm / 80) * 0.4E0, 0.0E0), 1.0E0) AS score,
         CASE WHEN twf = 1 THEN 'TWF' WHEN hdf = 1 THEN 'HDF' WHEN pwf = 1 THEN 'PWF' WHEN osf = 1 THEN 'OSF'
              WHEN rnf = 1 THEN 'RNF' ELSE 'None' END AS failure_mode_label
  FROM obs
)"""

SPLIT = """
, strata AS (
  SELECT machine_failure AS g, COUNT(*) AS n FROM obs GROUP BY 1
), want1 AS (
  SELECT g, n, SUM(n) OVER () AS tot,
         (SUM(n) OVER () - CAST(CEIL(SUM(n) OVER () * 30 / 100.0) AS BIGINT)) AS want FROM strata
), deal1 AS (
  SELECT g, n, tot, CAST(want * n // tot AS BIGINT) + CASE WHEN ROW_NUMBER() OVER (ORDER BY (want * n) % tot DESC, g)
           <= want - SUM(want * n // tot) OVER () THEN 1 ELSE 0 END AS c1 FROM want1
), want2 AS (
  SELECT g, n, c1, n - c1 AS h, SUM(n - c1) OVER () AS tot,
         SUM(n - c1) OVER () - CAST(CEIL(SUM(n - c1) OVER () * 50 / 100.0) AS BIGINT) AS want FROM deal1
), cuts AS (
  SELECT g, n, c1, c1 + CAST(want * h // tot AS BIGINT) + CASE WHEN ROW_NUMBER() OVER (ORDER BY (want * h) % tot DESC, g)
           <= want - SUM(want * h // tot) OVER () THEN 1 ELSE 0 END AS c2 FROM want2
), ranked AS (
  SELECT eng.*, ROW_NUMBER() OVER (PARTITION BY machine_failure
           ORDER BY md5(CONCAT(CAST(machine_id AS VARCHAR), '|42')), machine_id) AS rn FROM eng
), parts AS (
  SELECT ranked.*, CASE WHEN rn <= c1 THEN 'train' WHEN rn <= c2 THEN 'val' ELSE 'test' END AS split
  FROM ranked JOIN cuts ON cuts.g = ranked.machine_failure
), typestats AS (
  SELECT type_code, AVG(air_temperature_k) AS m, STDDEV_SAMP(air_temperature_k) AS s
  FROM parts WHERE split = 'train' GROUP BY 1
), allstats AS (
  SELECT AVG(air_temperature_k) AS gm, STDDEV_SAMP(air_temperature_k) AS gs FROM parts WHERE split = 'train'
), zed AS (
  SELECT parts.*, CASE WHEN s IS NULL OR s = 0 THEN (air_temperature_k - gm) / gs
                       ELSE (air_temperature_k - m) / s END AS air_temp_z_within_type
  FROM parts LEFT JOIN typestats USING (type_code) CROSS JOIN allstats
)"""


def fleet(sql: str, machine: str = "udi") -> str:
    """``sql`` over obs and the six tables."""
    return f"WITH {OBSERVATIONS}{SENSE.format(machine=machine)}{DIMENSIONS} {sql}"


def features(sql: str) -> str:
    """``sql`` over obs and eng."""
    return f"WITH {OBSERVATIONS}{SENSE.format(machine='udi')}{FEATURES} {sql}"


def splits(sql: str) -> str:
    """``sql`` over obs, eng, parts (with split) and zed (with the train-fitted z)."""
    return f"WITH {OBSERVATIONS}{SENSE.format(machine='udi')}{FEATURES}{SPLIT} {sql}"


def pct(part: str, whole: str, digits: int = 2) -> str:
    """100 * part / whole rounded half up, from integers."""
    scale = 10**digits
    return (f"CAST((CAST({part} AS HUGEINT) * {200 * scale} + ({whole})) // (({whole}) * 2) AS DOUBLE) / {scale}")


def exact_mean(value: str, digits: int, factor: int = 1) -> str:
    """``factor`` times the mean of ``value`` to nine decimals, rounded half up, from integers."""
    units = f"CAST(FLOOR(({value}) * 1000000000 + 0.5) AS HUGEINT)"
    return f"CAST((SUM({units}) * {2 * factor * 10**digits} + COUNT(*) * 1000000000::HUGEINT) // (COUNT(*) * 2000000000::HUGEINT) AS DOUBLE) / {10**digits}"
