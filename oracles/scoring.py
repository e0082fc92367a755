"""Scoring, evaluation, drift, replay and retrieval statements."""

from oracles.base import exact_mean, features, fleet, splits
from millwright.constants import NOT_FOUND
from millwright.operators.scoring import diagnosis_rules
from oracles.exploration import histogram

BAND = """CASE WHEN {r} <= -0.01 THEN NULL WHEN {r} <= 0.3 THEN '\U0001F7E2 Healthy' WHEN {r} <= 0.7 THEN '\U0001F7E1 Needs monitoring'
  WHEN {r} <= 1.01 THEN '\U0001F534 High failure risk' END"""
STATUS = f", st AS (SELECT eng.*, score AS failure_risk, {BAND.format(r='score')} AS status FROM eng)"
HIGH = "'\U0001F534 High failure risk'"
EV = ", ev AS (SELECT machine_id, score, machine_failure AS label FROM eng)"
PTS = EV + """
, per AS (SELECT score AS threshold, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label <> 1) AS neg FROM ev GROUP BY 1)
, pts AS (SELECT threshold, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
  FROM per WINDOW w AS (ORDER BY threshold DESC))"""
CONF = """SUM(CASE WHEN score < {t} AND label = 0 THEN 1 ELSE 0 END)::BIGINT AS tn, SUM(CASE WHEN score >= {t} AND label = 0 THEN 1 ELSE 0 END)::BIGINT AS fp,
  SUM(CASE WHEN score < {t} AND label = 1 THEN 1 ELSE 0 END)::BIGINT AS fn, SUM(CASE WHEN score >= {t} AND label = 1 THEN 1 ELSE 0 END)::BIGINT AS tp"""
CM = EV + f", cm AS (SELECT {CONF.format(t='0.5')} FROM ev)"
MET = CM + """, met AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
  CASE WHEN fn + tp > 0 THEN fn / (fn + tp) END AS false_negative_rate FROM cm)"""
AP = "SUM(pos / p * (tp / (tp + fp)))"
TRAPEZOID = "SUM(pos / p * (tp / (tp + fp) + CASE WHEN tp + fp - pos - neg > 0 THEN (tp - pos) / (tp + fp - pos - neg) ELSE 1.0 END) / 2)"
ROC = "CAST(SUM(CAST(neg AS HUGEINT) * (2 * (tp - pos) + pos)) AS DOUBLE) / 2 / (MAX(p) * MAX(n))"


def _grid(n):
    step = (0.99 - 0.01) / (n - 1)
    values = [0.01 + i * step for i in range(n - 1)] + [0.99]
    rows = ", ".join(f"({v!r}E0)" for v in values)
    # sums from above over the distinct scores' grid cells, instead of comparing every row with every threshold
    return f""", grid(t) AS (VALUES {rows}), cell AS (SELECT (SELECT MAX(t) FROM grid WHERE t <= s.score) AS t, pos, neg
      FROM (SELECT score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label <> 1) AS neg FROM ev GROUP BY 1) s)
    , cells AS (SELECT t, SUM(pos) AS pos, SUM(neg) AS neg FROM cell GROUP BY 1)
    , sweep AS (SELECT g.t AS threshold, COALESCE(SUM(c.pos) FILTER (c.t >= g.t), 0) AS tp, COALESCE(SUM(c.neg) FILTER (c.t >= g.t), 0) AS fp,
        SUM(c.pos) - COALESCE(SUM(c.pos) FILTER (c.t >= g.t), 0) AS fn FROM grid g CROSS JOIN cells c GROUP BY 1)"""


COSTS = EV + _grid(99) + ", costs AS (SELECT threshold, fp::BIGINT AS fp, fn::BIGINT AS fn, (fp * 50 + fn * 1000)::BIGINT AS cost FROM sweep)"


def _report(label, prediction, table):
    return f""", cl AS (SELECT DISTINCT {label} AS class FROM {table} UNION SELECT DISTINCT {prediction} FROM {table})
    , per AS (SELECT cl.class, COUNT(*) FILTER ({label} = cl.class) AS support, COUNT(*) FILTER ({prediction} = cl.class) AS predicted,
        COUNT(*) FILTER ({label} = cl.class AND {prediction} = cl.class) AS hits FROM cl, {table} GROUP BY 1)
    , rep AS (SELECT CAST(class AS VARCHAR) AS class, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, 2 * hits / (support + predicted) AS f1, support, hits FROM per)
    SELECT class, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1, support FROM rep
    UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 9), ROUND(AVG(recall), 9), ROUND(AVG(f1), 9), SUM(support)::BIGINT FROM rep
    UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 9), ROUND(SUM(recall * support) / SUM(support), 9),
      ROUND(SUM(f1 * support) / SUM(support), 9), SUM(support)::BIGINT FROM rep
    UNION ALL SELECT 'accuracy', ROUND(SUM(hits) / SUM(support), 9), ROUND(SUM(hits) / SUM(support), 9), ROUND(SUM(hits) / SUM(support), 9), SUM(support)::BIGINT FROM rep"""


RULES = [
    ("HDF", "temp_diff_K < 8.6E0 AND rotational_speed_rpm < 1380"),
    ("PWF", "power_W < 3500 OR power_W > 9000"),
    ("OSF", "torque_x_toolwear > CASE type_code WHEN 'L' THEN 11000 WHEN 'M' THEN 12000 ELSE 13000 END"),
    ("TWF", "tool_wear_min BETWEEN 200 AND 240"),
    ("WEAR", "tool_wear_min > 200"),
]
DIAG = ", dg AS (" + " UNION ALL ".join(
    f"SELECT machine_id, {i} AS rule_order, '{c}' AS diagnosis FROM eng WHERE {w}" for i, (c, w) in enumerate(RULES)) + ")"
BP = "CAST(FLOOR(failure_risk * 10000 + 0.5) AS BIGINT)"
TELEMETRY = f"""to_json({{machine_id: machine_id, air_temperature_k: air_temperature_k, process_temperature_k: process_temperature_k,
  rotational_speed_rpm: rotational_speed_rpm, torque_nm: torque_nm, tool_wear_min: tool_wear_min,
  Predicted_Failure_Risk: CONCAT(CAST({BP} // 100 AS VARCHAR), '.', LPAD(CAST({BP} % 100 AS VARCHAR), 2, '0'), '%')}})"""

FEATURE_COLUMNS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min",
                   "temp_diff_K", "power_W", "torque_x_toolwear", "speed_torque_ratio", "air_temp_z_within_type"]
ENC = """, enc AS (SELECT zed.*, CASE WHEN type_code = 'H' THEN 1 ELSE 0 END AS type_H, CASE WHEN type_code = 'L' THEN 1 ELSE 0 END AS type_L,
  CASE WHEN type_code = 'M' THEN 1 ELSE 0 END AS type_M, CASE tool_wear_bucket WHEN 'very_low' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2
  WHEN 'high' THEN 3 WHEN 'critical' THEN 4 ELSE -1 END AS tool_wear_ordinal FROM zed)"""
KS = """, c AS (SELECT feature, value, COUNT(*) FILTER (split = 'train') AS a, COUNT(*) FILTER (split = 'test') AS b FROM lng GROUP BY 1, 2)
, r AS (SELECT feature, SUM(a) OVER w AS ca, SUM(b) OVER w AS cb, SUM(a) OVER (PARTITION BY feature) AS na, SUM(b) OVER (PARTITION BY feature) AS nb
  FROM c WINDOW w AS (PARTITION BY feature ORDER BY value))
, d AS (SELECT feature, MAX(na)::BIGINT AS n_old, MAX(nb)::BIGINT AS n_new, CAST(MAX(ABS(ca * nb - cb * na)) AS DOUBLE) / (CAST(MAX(na) AS DOUBLE) * MAX(nb)) AS s FROM r GROUP BY 1)
, l AS (SELECT *, SQRT(CAST(n_old AS DOUBLE) * n_new / (CAST(n_old AS DOUBLE) + n_new)) * s AS lam FROM d)
, p AS (SELECT l.*, CASE WHEN lam < 0.2 THEN 1.0 ELSE LEAST(GREATEST((SELECT SUM(CASE WHEN j % 2 = 1 THEN 2.0E0 ELSE -2.0E0 END * EXP(-2.0E0 * j * j * lam * lam))
    FROM RANGE(1, 101) q(j)), 0.0), 1.0) END AS p_value FROM l)
SELECT feature, n_old, n_new, ROUND(s, 9) AS statistic, ROUND(p_value, 6) AS p_value, CASE WHEN p_value < 0.05 THEN 'DRIFT' ELSE 'ok' END AS flag FROM p"""


def _drift(columns):
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, split FROM enc WHERE split IN ('train', 'test')" for c in columns)
    return splits(ENC + f", lng AS ({rows})" + KS)


def _noise(step):
    d = f"md5(CONCAT(CAST(machine_id AS VARCHAR), '|{step}|42'))"
    def u(i):
        return f"(CAST(CONCAT('0x', SUBSTR({d}, {i}, 12)) AS BIGINT) / 281474976710656.0E0)"
    return f"SQRT(-2.0E0 * LN(1.0E0 - {u(1)})) * COS(2.0E0 * 3.141592653589793E0 * {u(13)}) * {2.0 * step}E0"


def _rule(torque):
    return f"LEAST(GREATEST((CAST(tool_wear_min AS DOUBLE) / 250) * 0.6E0 + (({torque}) / 80) * 0.4E0, 0.0E0), 1.0E0)"


DEGRADED = features(" UNION ALL ".join(
    f"SELECT {t} AS step, {exact_mean(_rule('torque_nm' if t == 0 else 'torque_nm + ' + _noise(t)), 9)} AS mean_risk FROM eng" for t in range(5)))
SENSORS = FEATURE_COLUMNS[:5]
ATTR = """, mn AS (SELECT AVG(tool_wear_min) AS mw, AVG(torque_nm) AS mt FROM parts WHERE split = 'train')
, att AS (SELECT machine_id, UNNEST([{pairs}], recursive := true) FROM parts CROSS JOIN mn)
, rk AS (SELECT machine_id, feature, contribution, place, ROW_NUMBER() OVER (PARTITION BY machine_id ORDER BY ABS(contribution) DESC, place) AS rank FROM att)"""
_S = "LEAST(GREATEST((CAST({w} AS DOUBLE) / 250) * 0.6E0 + ({t} / 80) * 0.4E0, 0.0E0), 1.0E0)"
_WHAT = {"tool_wear_min": f"score - {_S.format(w='mw', t='torque_nm')}", "torque_nm": f"score - {_S.format(w='tool_wear_min', t='mt')}"}
ATTR = ATTR.format(pairs=", ".join(
    f"{{'feature': '{c}', 'place': {i}, 'contribution': ROUND({_WHAT.get(c, '0.0E0')}, 9)}}" for i, c in enumerate(SENSORS)))

PROTO = """, pr AS (SELECT label, i, AVG(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, RANGE(1, 65) q(i) GROUP BY 1, 2)
, q AS (SELECT label AS query_id, LIST(m ORDER BY i) AS v FROM pr GROUP BY 1)
, sc AS (SELECT query_id, vec_id, ROUND(LIST_COSINE_SIMILARITY(CAST(embedding AS DOUBLE[]), v), 9) AS score FROM embeddings CROSS JOIN q)
, top AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM sc QUALIFY rank <= 3)"""
CHUNKS = """chunks AS (SELECT doc_id, CAST(i AS INT) AS chunk_id, SUBSTR(text, i * 450 + 1, 500) AS chunk
  FROM (SELECT doc_id, text, UNNEST(RANGE(0, CAST(CEIL(GREATEST(LENGTH(text) - 50, 1) / 450.0) AS BIGINT))) AS i FROM documents WHERE LENGTH(text) > 0))"""


def _words(text):
    return f"UNNEST(list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))"


INDEX = CHUNKS + f""", cw AS (SELECT doc_id, chunk_id, {_words('chunk')} AS term FROM chunks)
, tf AS (SELECT doc_id, chunk_id, term, COUNT(*) AS n FROM cw GROUP BY ALL)
, sz AS (SELECT doc_id, chunk_id, SUM(n)::BIGINT AS size FROM tf GROUP BY ALL)
, nt AS (SELECT COUNT(*) AS texts, CAST(SUM(size) AS DOUBLE) / COUNT(*) AS mean FROM sz)
, idf AS (SELECT term, COUNT(*) AS df, CAST(FLOOR(1000 * LN(1 + (texts - COUNT(*) + 0.5::DOUBLE) / (COUNT(*) + 0.5::DOUBLE))) AS BIGINT) AS idf FROM tf, nt GROUP BY term, texts)
, sh AS (SELECT doc_id, chunk_id, term, CAST(FLOOR(2200000.0::DOUBLE * n / (n + 0.3::DOUBLE + 0.9::DOUBLE * (size / mean))) AS BIGINT) AS share
  FROM tf JOIN sz USING (doc_id, chunk_id), nt)"""


def _found(questions):
    """The three best chunks of each row (query_id, text) of ``questions``."""
    return INDEX + f""", qw AS (SELECT query_id, {_words('text')} AS term FROM {questions})
, qt AS (SELECT query_id, term, COUNT(*) AS n FROM qw GROUP BY ALL)
, hit AS (SELECT query_id, doc_id, chunk_id, SUM(qt.n * idf.idf * sh.share)::BIGINT AS score FROM qt JOIN idf USING (term) JOIN sh USING (term) GROUP BY ALL)
, found AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_id) AS INT) AS rank FROM hit WHERE score > 0 QUALIFY rank <= 3)"""


def _questions():
    rows = ", ".join(f"({i}, '{rule.question}')" for i, rule in enumerate(diagnosis_rules()))
    return f"asked(query_id, text) AS (VALUES {rows})"


#: Pieces of at most 450 characters, cut one after the other.
PIECES = """WITH RECURSIVE piece AS (
  SELECT doc_id, 0 AS chunk_id, '' AS cut, text AS rest FROM documents WHERE LENGTH(text) > 0
  UNION ALL
  SELECT doc_id, chunk_id + 1, SUBSTR(rest, 1, size), SUBSTR(rest, size + 1) FROM (
    SELECT doc_id, chunk_id, rest, CASE WHEN LENGTH(rest) <= 450 THEN LENGTH(rest) ELSE COALESCE(
      CASE WHEN b > 0 AND 450 - b + 1 >= 225 THEN 450 - b + 1 END, CASE WHEN l > 0 AND 450 - l + 1 >= 225 THEN 450 - l + 1 END,
      CASE WHEN s > 0 AND 450 - s + 1 >= 225 THEN 450 - s + 1 END, 450) END AS size
    FROM (SELECT doc_id, chunk_id, rest, STRPOS(w, CHR(10) || CHR(10)) AS b, STRPOS(w, CHR(10)) AS l, STRPOS(w, ' ') AS s
      FROM (SELECT *, REVERSE(SUBSTR(rest, 1, 450)) AS w FROM piece WHERE LENGTH(rest) > 0)))
)"""
LINE_SCORES = f"""SELECT machine_id, type_code, torque_nm, tool_wear_min, score AS failure_probability,
  CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_failure, {BAND.format(r='score')} AS status FROM eng"""

ERRORS = ENC + ", st AS (SELECT " + ", ".join(
    f"AVG({c}) AS m{i}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS d{i}"
    for i, c in enumerate(FEATURE_COLUMNS)) + " FROM enc WHERE split = 'train') SELECT machine_id, ROUND((" + " + ".join(
    [f"POWER(({c} - m{i}) / d{i}, 2)" for i, c in enumerate(FEATURE_COLUMNS)] + ["type_H", "4 * type_L", "4 * type_M", "4 * tool_wear_ordinal * tool_wear_ordinal"]
) + ") / 14, 6) AS anomaly_score FROM enc CROSS JOIN st"

SQL = {
    "g05_class_weights": splits("""SELECT machine_failure, COUNT(*) AS n, ROUND((SELECT COUNT(*) FROM parts WHERE split = 'train') / (2 * COUNT(*)), 9) AS balanced_weight,
        CASE WHEN machine_failure = 1 THEN ROUND((SELECT COUNT(*) FROM parts WHERE split = 'train' AND machine_failure = 0) / COUNT(*), 9) ELSE 1.0 END AS positive_weight
        FROM parts WHERE split = 'train' GROUP BY 1"""),
    "h04_anomaly_score": splits(ERRORS),
    "a06_text_documents": "SELECT doc_id, lang, source, LENGTH(text) AS n_characters, md5(text) AS digest FROM documents",
    "a02_flat_sink": fleet("SELECT machine_id, product_id, type_code, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min, machine_failure FROM obs"),
    "a03_feature_sink": splits("SELECT split, machine_failure, COUNT(*) AS n, 14 AS n_features FROM parts GROUP BY 1, 2"),
    "a04_table_refresh": fleet("""SELECT 'machine_type' AS table_name, COUNT(*) AS n_rows FROM machine_type UNION ALL SELECT 'machines', COUNT(*) FROM machines
        UNION ALL SELECT 'sensor_readings', COUNT(*) FROM obs UNION ALL SELECT 'failure_mode', COUNT(*) FROM failure_mode
        UNION ALL SELECT 'failure_events', COUNT(*) FROM failure_events UNION ALL SELECT 'maintenance_events', COUNT(*) FROM maintenance_events""", machine="p"),
    "a07_batch_scoring": features("SELECT machine_id, ROUND(score, 9) AS failure_probability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_failure FROM eng"),
    "a12_feature_table_load": features("SELECT COUNT(*) AS n, ROUND(AVG(power_W), 4) AS mean_power, SUM(machine_failure)::BIGINT AS failures FROM eng"),
    "h01_rule_score": features("SELECT machine_id, score AS failure_probability FROM eng"),
    "h02_predicted_flag": features("SELECT machine_id, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_failure FROM eng"),
    "h03_batch_scores": features("""SELECT machine_id AS "UDI", type_code AS "Type", torque_nm AS "Torque [Nm]", tool_wear_min AS "Tool wear [min]",
        CASE WHEN why = '' THEN score END AS failure_probability, CASE WHEN why = '' THEN CASE WHEN score >= 0.5 THEN 1 ELSE 0 END END AS predicted_failure, NULLIF(why, '') AS rejected_for
        FROM (SELECT *, CONCAT_WS('; ', CASE WHEN type_code NOT IN ('L', 'M', 'H') THEN 'type_code in domain' END,
          CASE WHEN air_temperature_k <= 0 THEN 'air_temperature_k > 0' END, CASE WHEN process_temperature_k <= 0 THEN 'process_temperature_k > 0' END,
          CASE WHEN rotational_speed_rpm < 0 THEN 'rotational_speed_rpm >= 0' END, CASE WHEN torque_nm < 0 THEN 'torque_nm >= 0' END,
          CASE WHEN tool_wear_min < 0 THEN 'tool_wear_min >= 0' END, CASE WHEN air_temperature_k NOT BETWEEN 200 AND 500 THEN 'air temperature plausible' END,
          CASE WHEN process_temperature_k NOT BETWEEN 200 AND 500 THEN 'process temperature plausible' END) AS why FROM eng)"""),
    "h05_anomaly_flag": features("SELECT machine_id, score AS anomaly_score, score >= 0.6541 AS is_anomaly FROM eng"),
    "h06_status_bands": features(STATUS + " SELECT machine_id, failure_risk, status FROM st"),
    "h07_fleet_kpis": features(STATUS + f" SELECT COUNT(*) AS total_machines, COUNT(*) FILTER (status = {HIGH}) AS machines_at_risk, {exact_mean('failure_risk', 6, 100)} AS average_risk_pct FROM st"),
    "h07_anomaly_kpis": features(f"SELECT COUNT(*) FILTER (score >= 0.6541) AS flagged_as_anomaly, {exact_mean('score', 6, 100)} AS average_probability_pct FROM eng"),
    "h08_worklist": features(STATUS + " SELECT machine_id, failure_risk, status, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min FROM st"),
    "h08_worklist_top": features(STATUS + " SELECT machine_id, failure_risk, status FROM st ORDER BY failure_risk DESC, machine_id LIMIT 100"),
    "h09_telemetry_high_risk": features(STATUS + f" SELECT machine_id, {TELEMETRY} AS telemetry FROM st WHERE status = {HIGH}"),
    "h10_diagnosis": features(DIAG + " SELECT dg.*, d.text AS protocol FROM dg LEFT JOIN documents d ON d.doc_id = dg.rule_order"),
    "i01_confusion_matrix": features(CM + " SELECT * FROM cm"),
    "i02_point_metrics": features(MET + " SELECT ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1 FROM met"),
    "i03_false_negative_rate": features(MET + " SELECT ROUND(false_negative_rate, 9) AS false_negative_rate FROM met"),
    "i04_precision_recall": features(PTS + " SELECT threshold, ROUND(tp / (tp + fp), 9) AS precision, ROUND(tp / p, 9) AS recall FROM pts UNION ALL SELECT NULL, 1.0, 0.0"),
    "i05_average_precision": features(PTS + f" SELECT ROUND({AP}, 9) AS average_precision FROM pts"),
    "i06_pr_auc_trapezoid": features(PTS + f" SELECT ROUND({TRAPEZOID}, 9) AS pr_auc_trapezoid FROM pts"),
    "i07_roc_auc": features(PTS + f" SELECT ROUND({ROC}, 9) AS roc_auc FROM pts"),
    "i07_roc_auc_mode_labels": features(PTS.replace("machine_failure AS label", "osf AS label") + f" SELECT ROUND({ROC}, 9) AS roc_auc FROM pts"),
    "i08_threshold_for_precision": features(PTS + " SELECT threshold, ROUND(tp / (tp + fp), 9) AS precision, ROUND(tp / p, 9) AS recall FROM pts WHERE tp / (tp + fp) >= 0.30 ORDER BY threshold LIMIT 1"),
    "i09_f1_threshold": features(PTS + """, pr AS (SELECT threshold, tp / (tp + fp) AS a, tp / p AS b FROM pts)
        SELECT threshold, ROUND(a, 9) AS precision, ROUND(b, 9) AS recall, ROUND(2 * a * b / (a + b + 1e-10), 9) AS f1 FROM pr
        ORDER BY 2 * a * b / (a + b + 1e-10) DESC, threshold LIMIT 1"""),
    "i10_threshold_sweep": features(EV + _grid(100) + """, r AS (SELECT threshold, tp / (tp + fp + 1e-10) AS a, tp / (tp + fn + 1e-10) AS b FROM sweep)
        SELECT threshold, ROUND(a, 9) AS precision, ROUND(b, 9) AS recall, ROUND(2 * a * b / (a + b + 1e-10), 9) AS f1 FROM r"""),
    "i11_cost_sweep": features(COSTS + " SELECT * FROM costs"),
    "i11_cheapest_threshold": features(COSTS + " SELECT threshold, cost FROM costs ORDER BY cost, threshold LIMIT 1"),
    "i12_policy_costs": features(CM + """ SELECT (tp + fn) * 1000 AS reactive_cost, (tp + fp) * 100 + fn * 1000 AS predictive_cost,
        (tp + fn) * 1000 - ((tp + fp) * 100 + fn * 1000) AS savings FROM cm"""),
    "i13_classification_report": features(EV + ", pd AS (SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM ev)" + _report("label", "prediction", "pd")),
    "i13_report_document_labels": "WITH pd AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels)" + _report("label", "prediction", "pd"),
    "i14_class_separation": features(EV + """ SELECT ROUND(AVG(score) FILTER (label = 0), 9) AS mean_normal, ROUND(AVG(score) FILTER (label = 1), 9) AS mean_failure,
        ROUND(AVG(score) FILTER (label = 1) / AVG(score) FILTER (label = 0), 9) AS separation FROM ev"""),
    "i15_score_histogram": features(EV + histogram(", lng AS (SELECT label, score AS value FROM ev)", "label")),
    "i16_rule_comparison": splits(", ".join([""] + [f"""ev{i} AS (SELECT score, machine_failure AS label FROM parts WHERE split = '{sp}'), cm{i} AS (SELECT {CONF.format(t='0.5')} FROM ev{i})
        , per{i} AS (SELECT score AS threshold, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label <> 1) AS neg FROM ev{i} GROUP BY 1)
        , pts{i} AS (SELECT threshold, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM per{i} WINDOW w AS (ORDER BY threshold DESC))"""
        for i, sp in enumerate(["train", "val", "test"])]).lstrip() + " " + " UNION ALL ".join(
        f"""SELECT 'rule score' AS model, '{sp}' AS split, 0.5E0 AS threshold, ROUND(tp / (tp + fp), 9) AS precision, ROUND(tp / (tp + fn), 9) AS recall,
        ROUND(2 * tp / (2 * tp + fp + fn), 9) AS f1, (SELECT ROUND({AP}, 9) FROM pts{i}) AS pr_auc, (SELECT ROUND({TRAPEZOID}, 9) FROM pts{i}) AS pr_auc_trapezoid,
        (SELECT ROUND({ROC}, 9) FROM pts{i}) AS roc_auc, ROUND(fn / (fn + tp), 9) AS false_negative_rate, tn, fp, fn, tp FROM cm{i}"""
        for i, sp in enumerate(["train", "val", "test"]))),
    "j01_ks_drift": _drift([*FEATURE_COLUMNS, "type_H", "type_L", "type_M", "tool_wear_ordinal"]),
    "j02_degradation": DEGRADED,
    "j03_attributions": splits(ATTR + " SELECT machine_id, rank::INT AS rank, feature, contribution FROM rk"),
    "j04_global_attribution": splits(ATTR + f""" SELECT feature, {exact_mean('ABS(contribution)', 9)} AS mean_abs_contribution FROM rk
        WHERE machine_id IN (SELECT machine_id FROM eng ORDER BY md5(CONCAT(CAST(machine_id AS VARCHAR), '|42')), machine_id LIMIT 100) GROUP BY 1"""),
    "k01_replay_scores": features(LINE_SCORES),
    "k02_replay_status": features(f", s2 AS ({LINE_SCORES}) SELECT status, COUNT(*) AS n FROM s2 GROUP BY 1"),
    "l01_chunk_fixed": """SELECT doc_id, CAST(i AS INT) AS chunk_id, SUBSTR(text, i * 450 + 1, 500) AS chunk
        FROM (SELECT doc_id, text, UNNEST(RANGE(0, CAST(CEIL(GREATEST(LENGTH(text) - 50, 1) / 450.0) AS BIGINT))) AS i FROM documents WHERE LENGTH(text) > 0)""",
    "l03_similarity_search": "WITH dummy AS (SELECT 1)" + PROTO + " SELECT query_id, vec_id, score, rank FROM top",
    "l04_context": "WITH dummy AS (SELECT 1)" + PROTO + f""" SELECT q.query_id, COALESCE(STRING_AGG(d.text, CHR(10) || CHR(10) ORDER BY top.rank), '{NOT_FOUND}') AS context
        FROM q LEFT JOIN top USING (query_id) LEFT JOIN documents d ON d.doc_id = top.vec_id GROUP BY 1""",
    "l05_risk_protocols": features(STATUS + DIAG + f""", {_questions()}, {_found('asked')}
        , proto AS (SELECT query_id AS rule_order, STRING_AGG(chunk, CHR(10) || CHR(10) ORDER BY rank) AS protocol FROM found JOIN chunks USING (doc_id, chunk_id) GROUP BY 1)
        , one AS (SELECT machine_id, protocol, MIN(rule_order) AS o FROM dg JOIN proto USING (rule_order) GROUP BY 1, 2)
        , ctx AS (SELECT machine_id, STRING_AGG(protocol, CHR(10) || CHR(10) ORDER BY o) AS context FROM one GROUP BY 1)
        SELECT st.machine_id, failure_risk, COALESCE(context, '{NOT_FOUND}') AS context
        FROM st LEFT JOIN ctx USING (machine_id) WHERE status = {HIGH}"""),
    "l01_chunk_separators": PIECES + """ SELECT doc_id, CAST(chunk_id - 1 AS INT) AS chunk_id,
        COALESCE(RIGHT(LAG(cut) OVER (PARTITION BY doc_id ORDER BY chunk_id), 50), '') || cut AS chunk FROM piece WHERE chunk_id > 0""",
    "l02_term_index": f"WITH {INDEX} SELECT term, df, idf, MAX(share)::BIGINT AS top FROM idf JOIN sh USING (term) GROUP BY ALL",
    "l03_term_search": f"WITH asked AS (SELECT item_id AS query_id, text FROM benchmark), {_found('asked')} SELECT query_id, doc_id, chunk_id, score, rank FROM found",
    "l03_pivot_search": """SELECT query_id, vec_id, score, rank FROM (
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM (
          SELECT q.vec_id AS query_id, e.vec_id, ROUND(LIST_COSINE_SIMILARITY(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS score
          FROM embeddings e CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q)) WHERE rank <= 3""",
    "l01_chunk_lines": """WITH ln AS (SELECT doc_id, UNNEST(string_split(text, CHR(10))) AS line, UNNEST(RANGE(len(string_split(text, CHR(10))))) AS i FROM documents WHERE LENGTH(text) > 0)
        , placed AS (SELECT *, COALESCE(SUM(LENGTH(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ln)
        SELECT doc_id, CAST(s // 500 AS INT) AS chunk_id, STRING_AGG(line, CHR(10) ORDER BY i) AS chunk FROM placed GROUP BY 1, 2""",
}
SQL |= {
    "a09_metadata": features(PTS + f""" SELECT 'rule score' AS model_name, ROUND(threshold, 9) AS threshold, 14 AS n_features
        FROM pts WHERE tp / (tp + fp) >= 0.30 ORDER BY threshold LIMIT 1"""),
    "a10_run_log": features(STATUS + " SELECT 'status' AS run_id, status AS key, 0 AS step, CAST(COUNT(*) AS DOUBLE) AS value FROM st GROUP BY status"),
    "a11_comparison_export": f"SELECT model, split, tn, fp, fn, tp FROM ({SQL['i16_rule_comparison']})",
}
