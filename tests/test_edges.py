"""Hand-made rows for the borders of every rule."""

import pytest
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.operators import evaluation as I
from millwright.operators import exploration as E
from millwright.operators import features as X
from millwright.operators import modelling as M
from millwright.operators import quality as B
from millwright.operators import scoring as H
from millwright.sources import schemas as S


def test_wear_bins(rows):
    df = rows(*[dict(tool_wear_min=w) for w in (0, 50, 51, 100, 150, 200, 201, 253, 254)])
    got = X.encode(X.engineer(df)).orderBy("machine_id").select("tool_wear_bucket", "tool_wear_ordinal").collect()
    assert [tuple(r) for r in got] == [
        ("very_low", 0), ("very_low", 0), ("low", 1), ("low", 1), ("medium", 2), ("high", 3), ("critical", 4),
        ("critical", 4), (None, -1)]


def test_idle_spindle_has_no_ratio(rows):
    assert X.engineer(rows(dict(torque_nm=0.0))).first()["speed_torque_ratio"] is None


def test_unknown_type_is_all_zero(rows):
    row = X.encode(X.engineer(rows(dict(type_code="X")))).first()
    assert (row["type_H"], row["type_L"], row["type_M"]) == (0, 0, 0)


def test_rule_violations_and_rejects(rows):
    df = rows(dict(), dict(type_code="X", HDF=2, air_temperature_k=0.0), dict(torque_nm=None))
    report = {r["rule"]: r["n_violations"] for r in B.rule_report(df, [*S.DOMAIN_RULES, *S.RANGE_RULES]).collect()}
    assert report["type_code in domain"] == 1 and report["HDF is binary"] == 1
    assert report["air_temperature_k > 0"] == 1 and report["torque_nm >= 0"] == 1 and report["TWF is binary"] == 0
    good, bad = B.split_rejects(df, [*S.DOMAIN_RULES, *S.RANGE_RULES])
    assert good.count() == 1 and bad.count() == 2


def test_clean_stops_on_violations(rows):
    from millwright.sources.lineitem_fleet import to_raw

    assert B.clean_observations(to_raw(rows(dict(), dict(machine_id=1)))).count() == 1  # exact copy removed
    with pytest.raises(B.ValidationFailed):
        B.clean_observations(to_raw(rows(dict(), dict(machine_id=1, torque_nm=1.0))))  # repeated key
    with pytest.raises(B.ValidationFailed):
        B.clean_observations(to_raw(rows(dict(type_code="X"))))
    with pytest.raises(B.SchemaMismatch):
        B.clean_observations(rows(dict()))


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("1.5", "a"), ("x", "b"), (None, "c")], "n string, k string")
    good, bad = B.coerce_numeric(df, {"n": "double"}, strict=False)
    assert [r["n"] for r in good.orderBy("k").collect()] == [1.5, None]
    assert bad.first()["failed_columns"] == ["n"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        B.coerce_numeric(df, {"n": "double"})[0].collect()


def test_events(rows):
    df = rows(dict(machine_failure=1), dict(RNF=1), dict(machine_failure=1, HDF=1, OSF=1),
              dict(machine_failure=1, TWF=1, HDF=1, PWF=1, OSF=1, RNF=1), dict())
    events = [tuple(r) for r in M.failure_events(df).orderBy("event_id").collect()]
    assert events == [
        (1, 1, 1, "UNSPECIFIED", 1), (2, 2, 2, "RNF", 0), (3, 3, 3, "HDF", 1), (4, 3, 3, "OSF", 1),
        (5, 4, 4, "TWF", 1), (6, 4, 4, "HDF", 1), (7, 4, 4, "PWF", 1), (8, 4, 4, "OSF", 1), (9, 4, 4, "RNF", 1)]
    labels = [r[0] for r in df.orderBy("machine_id").select(C.first_mode()).collect()]
    assert labels == ["None", "RNF", "HDF", "TWF", "None"]
    counts = B.label_consistency(df).first()
    assert (counts["inconsistent"], counts["failure_without_mode"], counts["mode_without_failure"],
            counts["multi_mode"]) == (2, 1, 1, 2)


def test_maintenance_of_unknown_reading(spark, rows):
    events = spark.createDataFrame([(1, 99, 5, "HDF", 1)], S.FAILURE_EVENTS)
    row = M.maintenance_events(events, M.sensor_readings(rows(dict(tool_wear_min=7)))).first()
    assert row["tool_wear_at_event"] == 0 and row["notes"].endswith("HDF")


def test_orphans(spark, rows):
    readings = M.sensor_readings(rows(dict(), dict(machine_id=9)))
    machines = M.machines(rows(dict()))
    key = S.ForeignKey("sensor_readings", "machine_id", "machines", "machine_id")
    tables = {"sensor_readings": readings, "machines": machines}
    report = B.foreign_key_report(tables, [key]).first()
    assert (report["n_rows"], report["n_orphans"]) == (2, 1)
    assert B.orphans(tables, key).first()["machine_id"] == 9


def test_grouped_z_fallback(rows):
    train = rows(*[dict(type_code=t, air_temperature_k=a) for t, a in
                   [("L", 300.0), ("L", 302.0), ("M", 301.0), ("H", 299.0), ("H", 299.0)]])
    stats = {r["type_code"]: r for r in X.group_statistics(train, "air_temperature_k", "type_code").collect()}
    mean, std = stats[None]["mean"], stats[None]["std"]
    new = rows(dict(type_code="L", air_temperature_k=303.0), dict(type_code="M", air_temperature_k=303.0),
               dict(type_code="H", air_temperature_k=303.0), dict(type_code="X", air_temperature_k=303.0))
    got = [r[0] for r in X.grouped_z(new, train).orderBy("machine_id").select(K.GROUPED_Z).collect()]
    overall = (303.0 - mean) / std
    assert got == pytest.approx([(303.0 - 301.0) / 2**0.5, overall, overall, overall])


def test_constant_column_divides_by_one(rows):
    train = rows(dict(), dict())
    row = X.standardise(train, train, ["torque_nm"]).first()
    assert row["torque_nm"] == 0.0


def test_split_counts_and_leakage(clean):
    from millwright.plans.split import stratified_split

    split = stratified_split(clean, "machine_id", "machine_failure", 42)
    n = clean.count()
    positives = clean.where("machine_failure = 1").count()
    counts = {(r["split"], r["machine_failure"]): r["n"] for r in split.groupBy("split", "machine_failure").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    held = -(-n * 30 // 100)
    assert counts["train", 0] + counts["train", 1] == n - held
    assert counts["test", 0] + counts["test", 1] == -(-held // 2)
    assert abs(counts["train", 1] - 0.7 * positives) <= 1
    again = stratified_split(clean.repartition(13), "machine_id", "machine_failure", 42)
    assert again.exceptAll(split).count() == 0
    held_out_changed = split.withColumn("air_temperature_k", F.when(
        F.col("split") == "train", F.col("air_temperature_k")).otherwise(F.col("air_temperature_k") + 100))
    def fitted(df):
        return X.group_statistics(df.where("split = 'train'"), "air_temperature_k", "type_code").select(
            "type_code", F.round("mean", 9), F.round("std", 9)).orderBy("type_code").collect()
    assert fitted(split) == fitted(held_out_changed)


def test_selected_inputs_hold_no_leak(clean):
    assert not set(X.select_inputs(clean).columns) & {*K.MODES, "machine_id", "product_id"}
    assert not set(X.FEATURE_COLUMNS) & {*K.MODES, "machine_id", "product_id", "machine_failure"}
    assert len(X.FEATURE_COLUMNS) == len(K.FEATURE_NAMES) == 14


def test_align(rows):
    ready = X.engineer(rows(dict()))
    with pytest.raises(X.MissingFeatures):
        X.align(ready)
    filled = X.align(ready, fill=0.0)
    assert filled.columns == ["machine_id", *K.FEATURE_NAMES] and filled.first()["num__air_temp_z_within_type"] == 0.0


def test_bands_and_threshold(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.30001,), (0.7,), (0.70001,), (1.0,)], "r double")
    got = [r[0] for r in df.select(C.status_band("r")).collect()]
    low, mid, high = K.BAND_LABELS
    assert got == [low, low, mid, mid, high, high]
    assert [r[0] for r in df.select(C.at_least("r", 0.3)).collect()] == [0, 1, 1, 1, 1, 1]


def test_rule_score_and_defaults(spark):
    df = spark.createDataFrame([(250, 80.0), (0, 0.0), (500, 500.0)], "tool_wear_min int, torque_nm double")
    assert [r[0] for r in df.select(H.rule_probability(df)).collect()] == [1.0, 0.0, 1.0]
    bare = spark.range(1)
    assert bare.select(H.rule_probability(bare)).first()[0] == pytest.approx(50 / 250 * 0.6 + 40 / 80 * 0.4)


SMOKE = ("M", 298.1, 308.6, 1551, 42.8, 0)
IMPLAUSIBLE = ("H", 300.5, 31.2, 1440, 42.3, 120)


def test_raw_scoring(spark):
    raw = spark.createDataFrame([SMOKE, IMPLAUSIBLE], ", ".join(
        f"`{c}` {t}" for c, t in zip(K.SCORING_COLUMNS, ["string", "double", "double", "int", "double", "int"])))
    scored, rejected = H.score_raw(raw)
    row = scored.first()
    assert scored.count() == 1 and 0.0 <= row["failure_probability"] <= 1.0 and row["predicted_failure"] == 0
    assert rejected.first()["broken_rules"] == ["process temperature plausible"]
    with pytest.raises(B.SchemaMismatch, match="Torque"):
        H.score_raw(raw.drop("Torque [Nm]"))


def test_telemetry_lookup(rows, spark):
    status = H.fleet_status(rows(dict(tool_wear_min=125, torque_nm=40.0)))
    wanted = spark.createDataFrame([(1,), (77,)], "machine_id long")
    got = {r["machine_id"]: r["telemetry"] for r in H.lookup_telemetry(status, wanted).collect()}
    assert '"Predicted_Failure_Risk":"50.00%"' in got[1]
    assert got[77] == "No telemetry record found for Machine ID / UDI 77."


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


def reference_curve(pairs):
    """Precision and recall at every distinct threshold, by counting."""
    out = []
    positives = sum(label for _, label in pairs)
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(label for s, label in pairs if s >= t)
        n = sum(1 for s, _ in pairs if s >= t)
        out.append((t, tp / n, tp / positives if positives else 1.0))
    return out


@pytest.mark.parametrize("pairs", [
    [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)],
    [(0.5, 0), (0.5, 1), (0.5, 1)],
    [(0.2, 0), (0.9, 1), (0.4, 0)],
    [(i % 17 / 17, int(i % 5 == 0)) for i in range(200)],
])
def test_curve_measures(spark, pairs):
    points = I.threshold_points(scored(spark, pairs))
    curve = reference_curve(pairs)
    got = sorted((r["threshold"], r["precision"], r["recall"]) for r in I.precision_recall(points).collect()
                 if r["threshold"] is not None)
    assert [x for row in got for x in row] == pytest.approx([x for row in sorted(curve) for x in row])
    ap = trapezoid = last = 0.0
    height = 1.0
    for _, p, r in curve:
        ap += (r - last) * p
        trapezoid += (r - last) * (p + height) / 2
        last, height = r, p
    assert I.average_precision(points).first()[0] == pytest.approx(ap)
    assert I.pr_auc_trapezoid(points).first()[0] == pytest.approx(trapezoid)
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for a, x in pairs if x for b, y in pairs if not y]
    assert I.roc_auc(points).first()[0] == pytest.approx(sum(wins) / len(wins))
    best = max(curve, key=lambda c: (2 * c[1] * c[2] / (c[1] + c[2] + 1e-10), -c[0]))
    assert I.f1_threshold(points).first()["threshold"] == best[0]


def test_measures_without_positives(spark):
    df = scored(spark, [(0.2, 0), (0.9, 0)])
    points = I.threshold_points(df)
    assert I.average_precision(points).first()[0] == 0.0
    assert I.roc_auc(points).first()[0] is None
    row = I.point_metrics(I.confusion_matrix(df)).first()
    assert (row["precision"], row["recall"], row["f1"], row["false_negative_rate"]) == (0.0, 0.0, 0.0, None)
    assert I.point_metrics(I.confusion_matrix(df), True).first()["false_negative_rate"] == 0.0


def test_grid_counts(spark):
    thresholds = I.grid(99)
    pairs = [(t, i % 2) for i, t in enumerate(thresholds)] + [(0.0, 1), (1.0, 0), (thresholds[40] - 1e-12, 1)]
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in I.grid_counts(scored(spark, pairs), thresholds).collect()}
    for t in thresholds:
        assert got[t] == (
            sum(x for s, x in pairs if s >= t), sum(1 - x for s, x in pairs if s >= t),
            sum(x for s, x in pairs if s < t), sum(1 - x for s, x in pairs if s < t))


def test_mann_whitney_against_pairs(spark):
    values = [(float(i * 7 % 23), int(i % 4 == 0)) for i in range(120)]
    df = spark.createDataFrame(values, "x double, machine_failure int")
    row = E.mann_whitney(df, ["x"]).first()
    u = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, x in values if x == 0 for b, y in values if y == 1)
    assert row["mannwhitney_U"] == u


def test_significance_functions(spark):
    from math import erfc, exp

    from millwright.functions.significance import chi_square_tail, kolmogorov_tail, two_sided_normal

    one = spark.range(1)
    for z in (0.0, 0.5, 1.96, 4.0):
        assert one.select(two_sided_normal(F.lit(z))).first()[0] == pytest.approx(erfc(z / 2**0.5), rel=2e-7)
    for x in (0.5, 3.0, 9.0):
        assert one.select(chi_square_tail(F.lit(x), F.lit(1))).first()[0] == pytest.approx(erfc((x / 2) ** 0.5), rel=1e-6)
        assert one.select(chi_square_tail(F.lit(x), F.lit(2))).first()[0] == pytest.approx(exp(-x / 2))
        assert one.select(chi_square_tail(F.lit(x), F.lit(4))).first()[0] == pytest.approx(exp(-x / 2) * (1 + x / 2))
    p = one.select(kolmogorov_tail(F.lit(0.1923), F.lit(100), F.lit(100))).first()[0]
    assert p == pytest.approx(0.0495, abs=5e-4)


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (5, 1000), (0, 7), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(C.percent("a", "b")).collect()] == [0.13, 33.33, 0.5, 0.0, None]


def test_greatest_is_null_with_a_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(C.greatest_or_null(F.col("a"), F.col("b"))).collect()] == [None, 2.0]


def test_quartile_labels_with_equal_edges(rows):
    df = rows(*[dict(tool_wear_min=w) for w in (0, 0, 0, 0, 0, 0, 1, 2)])
    got = {r["tool_wear_bucket"] for r in X.wear_quartile_label(df).collect()}
    assert "Q1" in got
