"""Every query by name, as a function of (session, folder of delivered tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.functions.columns import first_mode
from millwright.operators import drift as J
from millwright.operators import evaluation as I
from millwright.operators import exploration as E
from millwright.operators import features as X
from millwright.operators import fleet_queries as Q
from millwright.operators import learning as G
from millwright.operators import modelling as M
from millwright.operators import quality as B
from millwright.operators import retrieval as L
from millwright.operators import scoring as H
from millwright.operators.etl import load_fleet, refresh_fleet
from millwright.operators.model_store import fitted
from millwright.operators.modelling import FleetTables
from millwright.operators.text_index import TextIndex, scan_search
from millwright.operators.vector_index import PivotIndex
from millwright.sources import lineitem_fleet as source
from millwright.session import scratch_path, shared_folder, stage
from millwright.sources import readers, writers
from millwright.sources import schemas as S
from millwright.streaming import replay

Query = Callable[[SparkSession, str], DataFrame]


def _tables(make: Callable[..., DataFrame], repeated: bool = False, stored: bool = False, **options) -> Query:
    """A query over the six tables; with ``stored`` the numbered lines are written once, as several of its jobs read them."""
    read = source.repeated_observations if repeated else source.observations
    return lambda spark, folder: make(FleetTables.from_observations(read(spark, folder, stored)), **options)


FLEET_QUERIES: dict[str, Query] = {
    "q01_failure_rate": _tables(Q.failure_rate_by_type, stored=True),
    "q01_failure_rate_repeated": _tables(Q.failure_rate_by_type, repeated=True, stored=True),
    "q02_torque_rank": _tables(Q.torque_rank),
    "q02_torque_rank_all": _tables(Q.torque_rank, limit=None),
    "q03_torque_outliers": _tables(Q.torque_outliers),
    "q03_torque_outliers_all": _tables(Q.torque_outliers, limit=None),
    "q04_highest_stress": _tables(Q.highest_stress),
    "q05_mode_pareto": _tables(Q.failure_mode_pareto),
    "q06_wear_quartile_failures": _tables(Q.wear_quartile_failures, stored=True),
    "q06_wear_quartiles_all": _tables(Q.wear_quartiles, stored=True),
    "q07_multi_mode": _tables(Q.multi_mode_machines),
    "q07_multi_mode_repeated": _tables(Q.multi_mode_machines, repeated=True),
    "q08_maintenance_sequence": _tables(Q.maintenance_sequence, stored=True),
    "q08_maintenance_sequence_repeated": _tables(Q.maintenance_sequence, repeated=True, stored=True),
    "q09_torque_moving_average": _tables(Q.torque_moving_average),
    "q09_torque_moving_average_all": _tables(Q.torque_moving_average, stored=True, limit=None),
    "q10_compound_anomalies": _tables(Q.compound_anomalies),
    "q11_high_torque": _tables(Q.high_torque),
    "q12_failure_cost": _tables(Q.failure_cost),
    "q12_failure_cost_repeated": _tables(Q.failure_cost, repeated=True),
}



def _fleet(make: Callable[..., DataFrame], read=source.observations, **options) -> Query:
    """A query over the wide observations."""
    return lambda spark, folder: make(read(spark, folder), **options)


def _table(name: str, make: Callable[..., DataFrame], *args) -> Query:
    """A query over one delivered table."""
    return lambda spark, folder: make(spark.read.parquet(f"{folder}/{name}.parquet"), *args)


EVENT_RULES = [S.Rule("value is positive", "value > 0"), S.Rule("event_type is known", "event_type IN ('click', 'view')"),
               S.Rule("user is set", "user_id IS NOT NULL"), S.Rule("value below 100", "value < 100")]
LABEL_RULES = [S.Rule("quality is binary", "quality IN (0, 1)"), S.Rule("toxic is binary", "toxic IN (0, 1)"),
               S.Rule("quality is set", "quality = 1")]
SOURCE_KEYS = [
    S.ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    S.ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    S.ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    S.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    S.ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    S.ForeignKey("labels", "doc_id", "documents", "doc_id"),
]


def _text_fields(clean: DataFrame) -> DataFrame:
    """Fields as a text file delivers them."""
    return clean.select(*[F.col(name).cast("string").alias(name) for name in [*K.SENSORS, "product_id"]])


def _source_keys(spark: SparkSession, folder: str) -> DataFrame:
    names = {key.child for key in SOURCE_KEYS} | {key.parent for key in SOURCE_KEYS}
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
    return B.foreign_key_report(tables, SOURCE_KEYS)


_published: dict[tuple[str, str], str] = {}


def _stored_tables(spark: SparkSession, folder: str) -> FleetTables:
    """The six tables written by a refresh and read back; the queries of a session share one refresh of a folder."""
    key = (shared_folder(spark), folder)
    if key not in _published:
        place = scratch_path(spark, "tables")
        refresh_fleet(source.repeated_observations(spark, folder), place)
        _published[key] = place
    return load_fleet(spark, _published[key])


def _stored(make: Callable[..., DataFrame], **options) -> Query:
    """A query over the six stored tables, which join what the wide rows carry together."""
    return lambda spark, folder: make(_stored_tables(spark, folder), **options)


STORED_QUERIES: dict[str, Query] = {
    "q01_failure_rate_stored": _stored(Q.failure_rate_by_type),
    "q02_torque_rank_stored": _stored(Q.torque_rank),
    "q03_torque_outliers_stored": _stored(Q.torque_outliers),
    "q04_highest_stress_stored": _stored(Q.highest_stress),
    "q05_mode_pareto_stored": _stored(Q.failure_mode_pareto),
    "q06_wear_quartiles_stored": _stored(Q.wear_quartiles),
    "q07_multi_mode_stored": _stored(Q.multi_mode_machines),
    "q08_maintenance_sequence_stored": _stored(Q.maintenance_sequence),
    "q09_torque_moving_average_stored": _stored(Q.torque_moving_average),
    "q10_compound_anomalies_stored": _stored(Q.compound_anomalies),
    "q11_high_torque_stored": _stored(Q.high_torque),
    "q12_failure_cost_stored": _stored(Q.failure_cost),
}


def _raw_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The rows as a delivered CSV file, read under the declared schema."""
    path = scratch_path(spark, "raw")
    writers.write_flat(source.to_raw(source.observations(spark, folder)), path, "csv")
    return readers.good_lines(readers.read_raw(spark, path))


def _wide(df: DataFrame) -> DataFrame:
    return df.drop("reading_id")


def _with_machines(t: FleetTables) -> DataFrame:
    counts = t.machines.groupBy("type_code").agg(F.count(F.lit(1)).alias("n_machines"))
    return t.machine_type.join(counts, "type_code")


def _with_events(t: FleetTables) -> DataFrame:
    counts = t.melted.groupBy("failure_mode_code").agg(F.count(F.lit(1)).alias("n"))
    return t.failure_mode.join(counts, "failure_mode_code", "left").select(
        "failure_mode_code", "description", F.coalesce("n", F.lit(0)).alias("n_events"))


QUALITY_QUERIES: dict[str, Query] = {
    "a01_raw_scan": _raw_scan,
    "a05_unique_keys": lambda s, d: B.unique_key_report(_stored_tables(s, d).named(), S.UNIQUE_KEYS),
    "b01_drop_copies": _table("documents", lambda t: B.drop_copies(t.drop("doc_id")).select(
        "lang", "source", "n_chars", F.md5("text").alias("digest"))),
    "b01_copy_report": _table("documents", B.copy_report, ["doc_id"]),
    "b02_rename": lambda s, d: M.rename_raw(source.to_raw(source.observations(s, d))),
    "b03_coercion": lambda s, d: B.coercion_report(
        _text_fields(source.observations(s, d)), dict.fromkeys([*K.SENSORS, "product_id"], "double")),
    "b04_key_violations": _table("documents", lambda t: B.key_violations(
        t.select("doc_id", F.md5("text").alias("digest")), ["doc_id", "digest"])),
    "b04_key_violations_repeated": _fleet(B.key_violations, read=source.repeated_observations, keys=["reading_id", "machine_id"]),
    "b05_domain_rules": _fleet(B.rule_report, rules=S.DOMAIN_RULES),
    "b05_label_rules": _table("labels", B.rule_report, LABEL_RULES),
    "b06_range_rules": _fleet(B.rule_report, rules=S.RANGE_RULES),
    "b06_event_rules": _table("events", B.rule_report, EVENT_RULES),
    "b07_foreign_keys": lambda s, d: B.foreign_key_report(_stored_tables(s, d).named(), S.FOREIGN_KEYS),
    "b07_source_keys": _source_keys,
    "b09_label_consistency": _fleet(B.label_consistency),
    "b09_inconsistent_rows": _fleet(B.inconsistent_rows),
    "b10_missing_profile": _table("events", B.missing_profile),
    "b10_missing_profile_fleet": lambda s, d: B.missing_profile(_wide(source.observations(s, d))),
    "b11_duplicate_profile": _table("documents", B.duplicate_profile, ["doc_id"]),
    "b11_duplicate_profile_fleet": _fleet(B.duplicate_profile),
    "b12_id_profile": _table("events", B.id_profile, ["event_id", "user_id"]),
    "b12_id_profile_fleet": _fleet(B.id_profile),
    "b13_prefix_agreement": _fleet(B.prefix_agreement),
    "b14_binary_values": _fleet(B.binary_values),
    "b15_leakage_agreement": _fleet(B.leakage_agreement),
}

MODEL_QUERIES: dict[str, Query] = {
    "c01_machine_type": _tables(_with_machines),
    "c02_machines": _fleet(M.machines),
    "c02_machines_repeated": _fleet(M.machines, read=source.repeated_observations),
    "c03_sensor_readings": _fleet(M.sensor_readings, read=source.repeated_observations),
    "c04_failure_mode": _tables(_with_events),
    "c05_melt_failures": lambda s, d: M.melt_failures(source.observations(s, d)).drop("mode_order"),
    "c06_failure_events": _fleet(M.failure_events, read=source.repeated_observations),
    "c07_maintenance_events": _tables(lambda t: t.maintenance_events, stored=True),
    "c08_inverse_one_hot": lambda s, d: M.feature_table_to_raw(M.feature_table(source.observations(s, d))),
    "c09_failure_label": lambda s, d: source.observations(s, d).select("machine_id", first_mode().alias("failure_mode")),
}



def _engineered(spark: SparkSession, folder: str) -> DataFrame:
    return X.engineer(source.observations(spark, folder))


def _described(spark: SparkSession, folder: str) -> DataFrame:
    """Engineered features with the in-sample grouped z."""
    return E.with_grouped_z(_engineered(spark, folder))


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """Doubles rounded where two engines may differ in the last bits."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def _feature_column(name: str, *others: str) -> Query:
    doubles = [name] if name in K.ENGINEERED else []
    return lambda s, d: _rounded(X.encode(_engineered(s, d)).select("machine_id", *others, name), doubles)


def _split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return X.split_fleet(source.observations(spark, folder, stored=True))


def _group_statistics(spark: SparkSession, folder: str) -> DataFrame:
    train = _split_rows(spark, folder).where("split = 'train'")
    stats = X.group_statistics(train, "air_temperature_k", "type_code")
    return _rounded(stats.select(F.coalesce("type_code", F.lit("ALL")).alias("type_code"), "mean", "std"), ["mean", "std"])


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(X.align(X.prepared(source.observations(spark, folder, stored=True))), K.FEATURE_NAMES[:10])


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(X.feature_matrix(source.observations(spark, folder, stored=True)), K.NUMERIC_FEATURES)


FEATURE_QUERIES: dict[str, Query] = {
    "f01_select_inputs": _fleet(X.select_inputs),
    "f02_stratified_split": lambda s, d: _split_rows(s, d).select("machine_id", "machine_failure", "split"),
    "f02_split_counts": lambda s, d: _split_rows(s, d).groupBy("split", "machine_failure").agg(F.count(F.lit(1)).alias("n")),
    "f03_mode_split": lambda s, d: X.split_by_mode(source.observations(s, d, stored=True)).select("machine_id", "failure_mode", "split"),
    "f04_temp_diff": _feature_column("temp_diff_K"),
    "f05_power": _feature_column("power_W"),
    "f06_torque_x_toolwear": _feature_column("torque_x_toolwear"),
    "f07_speed_torque_ratio": _feature_column("speed_torque_ratio"),
    "f08_wear_bucket": _feature_column("tool_wear_bucket", "tool_wear_min"),
    "f09_wear_quartile_label": lambda s, d: X.wear_quartile_label(source.observations(s, d)).select(
        "machine_id", "tool_wear_min", "tool_wear_bucket"),
    "f10_grouped_z": lambda s, d: _rounded(X.prepared(source.observations(s, d, stored=True)).select(
        "machine_id", "split", K.GROUPED_Z), [K.GROUPED_Z]),
    "f10_group_statistics": _group_statistics,
    "f11_in_sample_z": lambda s, d: _rounded(_described(s, d).select("machine_id", K.GROUPED_Z), [K.GROUPED_Z]),
    "f12_standardised": lambda s, d: _matrix(s, d).select("machine_id", "split", *K.NUMERIC_FEATURES),
    "f13_one_hot": lambda s, d: X.encode(_engineered(s, d)).select("machine_id", "type_H", "type_L", "type_M"),
    "f14_wear_ordinal": _feature_column("tool_wear_ordinal"),
    "f15_feature_matrix": _matrix,
    "f16_feature_table": lambda s, d: _rounded(M.feature_table(source.observations(s, d)), ["temp_diff_k", "mechanical_power_w"]),
    "f17_type_dummies": lambda s, d: X.encode(_engineered(s, d)).groupBy("type_code").agg(
        *[F.sum(f"type_{t}").alias(f"type_{t}") for t in K.TYPES]),
    "f18_aligned": _aligned,
    "f19_display_names": lambda s, d: _rounded(X.feature_means(_aligned(s, d), K.FEATURE_NAMES), ["mean_value"], 4),
    "f20_normal_training_rows": lambda s, d: X.normal_training_rows(_split_rows(s, d)).select("machine_id"),
    "f21_seeded_sample": lambda s, d: X.seeded_sample(source.observations(s, d)).select("machine_id", "machine_failure"),
}

EXPLORATION_QUERIES: dict[str, Query] = {
    "e01_describe": _fleet(E.describe, features=K.SENSORS),
    "e01_describe_features": lambda s, d: E.describe(_described(s, d), E.CANDIDATES),
    "e02_univariate": _fleet(E.univariate),
    "e03_iqr_outliers": _fleet(E.iqr_outliers),
    "e04_histogram": _fleet(E.sensor_histogram),
    "e05_frequencies": _fleet(E.frequencies),
    "e06_class_balance": _fleet(E.class_balance),
    "e07_mode_summary": _fleet(E.mode_summary),
    "e08_five_numbers": _fleet(E.five_numbers, features=K.SENSORS, flags=[*K.MODES, "machine_failure"]),
    "e08_five_numbers_features": lambda s, d: E.five_numbers(
        _described(s, d), [*K.ENGINEERED, K.GROUPED_Z], ["machine_failure"]),
    "e08_bucket_by_class": lambda s, d: E.bucket_by_class(_engineered(s, d)),
    "e09_mann_whitney": lambda s, d: _rounded(
        E.mann_whitney(source.observations(s, d), K.SENSORS), ["median_normal", "median_failure"]).withColumn(
        "p_value", F.round("p_value", 9)),
    "e09_mann_whitney_features": lambda s, d: _rounded(
        E.mann_whitney(_described(s, d), E.CANDIDATES), ["median_normal", "median_failure"]).withColumn(
        "p_value", F.round("p_value", 9)),
    "e10_crosstab": _fleet(E.crosstab),
    "e11_chi_square": _fleet(E.chi_square),
    "e12_correlations": _fleet(E.correlations, features=K.SENSORS),
    "e12_correlations_features": lambda s, d: E.correlations(_described(s, d), E.CANDIDATES),
    "e13_redundant_pairs": lambda s, d: E.redundant_pairs(_described(s, d), E.CANDIDATES),
    "e14_cohens_d": lambda s, d: E.cohens_d(_described(s, d), E.CANDIDATES),
    "e15_rank_features": lambda s, d: _rounded(E.rank_features(_described(s, d), E.CANDIDATES), ["p_value"], 9),
    "e16_scatter_speed_torque": _fleet(E.scatter_bins, x="rotational_speed_rpm", y="torque_nm"),
    "e16_scatter_air_process": _fleet(E.scatter_bins, x="air_temperature_k", y="process_temperature_k"),
}


def _status(spark: SparkSession, folder: str) -> DataFrame:
    return H.fleet_status(source.observations(spark, folder))


def _scored(spark: SparkSession, folder: str, label: str = "machine_failure") -> DataFrame:
    """(score, label) rows of the rule score."""
    clean = source.observations(spark, folder)
    return clean.select(H.rule_probability(clean).alias("score"), F.col(label).alias("label"))


def _points(make: Callable[[DataFrame], DataFrame], label: str = "machine_failure") -> Query:
    """A measure of the threshold curve, its doubles rounded but for the threshold."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = make(I.threshold_points(_scored(spark, folder, label)))
        return _rounded(result, [c for c in result.columns if c != "threshold"], 9)
    return run


def _scores(make: Callable[..., DataFrame], *rounded: str) -> Query:
    return lambda s, d: _rounded(make(_scored(s, d)), rounded, 9)


def _flat_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "flat")
    writers.write_flat(source.observations(spark, folder), path)
    return spark.read.parquet(path).select(*K.RAW_TO_CLEAN.values())


def _feature_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    writers.write_features(X.feature_matrix(source.observations(spark, folder, stored=True)), path, X.FEATURE_COLUMNS)
    stored = readers.read_feature_table(spark, path)
    return stored.groupBy("split", "machine_failure").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("n_features"))


def _table_refresh(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_tables(spark, folder).named()
    counts = [t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, t in stored.items()]
    return reduce(DataFrame.unionByName, counts)


def _batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "scores")
    scored, rejected = H.score_raw(source.to_raw(source.observations(spark, folder, stored=True)))
    writers.write_scores(scored, rejected, place)
    stored = spark.read.option("header", True).csv(f"{place}/scored")
    return stored.select(
        F.col("UDI").cast("long").alias("machine_id"),
        F.round(F.col("failure_probability").cast("double"), 9).alias("failure_probability"),
        F.col("predicted_failure").cast("int").alias("predicted_failure"))


def _feature_table_load(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "overview")
    M.feature_table(source.observations(spark, folder)).write.parquet(path)
    return readers.read_feature_table(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("mechanical_power_w"), 4).alias("mean_power"),
        F.sum("machine_failure").alias("failures"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_documents(spark, f"{folder}/documents.parquet")


SCORE_COLUMNS = ["failure_probability", "predicted_failure", "rejected_for"]


def _batch_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = H.all_scored(source.to_raw(source.observations(spark, folder)))
    return scored.select("UDI", "Type", "`Torque [Nm]`", "`Tool wear [min]`", *SCORE_COLUMNS)


def _anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """The rule score standing in for the anomaly score, which needs a fitted model."""
    clean = source.observations(spark, folder)
    return H.flag_anomalies(clean.withColumn("anomaly_score", H.rule_probability(clean)))


def _anomaly_kpis(spark: SparkSession, folder: str) -> DataFrame:
    scored = _anomalies(spark, folder).withColumn("mlp_probability", F.col("anomaly_score"))
    return H.anomaly_kpis(scored)


def _telemetry_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    status = _status(spark, folder)
    return H.lookup_telemetry(status, status.where(F.col("status") == K.HIGH_RISK))


def _diagnoses(spark: SparkSession, folder: str) -> DataFrame:
    """Diagnoses with their rule's protocol: the document whose id is the rule's number."""
    protocols = _documents(spark, folder).select(F.col("doc_id").cast("int").alias("rule_order"), F.col("text").alias("protocol"))
    rules = protocols.where(F.col("rule_order") < len(H.diagnosis_rules()))
    return H.with_protocols(H.diagnose(_engineered(spark, folder)), rules)


def _text_index(spark: SparkSession, folder: str) -> TextIndex:
    return TextIndex.build(L.chunk_fixed(_documents(spark, folder)))


def _term_search(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark texts as questions over the chunks of all documents."""
    questions = spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    return _text_index(spark, folder).search(questions)


def _pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every twentieth vector against all vectors."""
    vectors = _embeddings(spark, folder)
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return PivotIndex.build(vectors).search(asked)


def _retrieved_protocols(spark: SparkSession, folder: str) -> DataFrame:
    """For high-risk machines the texts found for the question of each of their diagnoses."""
    rules = H.diagnosis_rules()
    questions = spark.createDataFrame([(i, rule.question) for i, rule in enumerate(rules)], "query_id int, text string")
    chunks = L.chunk_fixed(_documents(spark, folder))
    found = stage(scan_search(chunks, questions), "protocols")  # at most three rows per rule
    texts = chunks.join(F.broadcast(found), ["doc_id", "chunk_id"])
    told = texts.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk"))).alias("found"))
    protocols = told.select(F.col("query_id").alias("rule_order"), F.array_join(F.col("found")["chunk"], L.CONTEXT_SEPARATOR).alias("protocol"))
    engineered = _engineered(spark, folder)
    risk = engineered.withColumn("failure_risk", H.rule_probability(engineered))
    machines = risk.select("machine_id", "failure_risk", C.status_band("failure_risk").alias("status"), H.rules_met(rules).alias("rules"))
    return L.risk_protocols(machines, protocols, len(rules))


def _rule_comparison(spark: SparkSession, folder: str) -> DataFrame:
    clean = stage(_split_rows(spark, folder), "split")
    scored = clean.select("split", H.rule_probability(clean).alias("score"), F.col("machine_failure").alias("label"))
    rows = [I.metrics_row(scored.where(F.col("split") == part), "rule score", part) for part in ("train", "val", "test")]
    measures = ["precision", "recall", "f1", "pr_auc", "pr_auc_trapezoid", "roc_auc", "false_negative_rate"]
    return _rounded(I.compare_models(rows), measures, 9)


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).withColumn("prediction", C.at_least("score", K.DECISION_THRESHOLD))


def _report(df: DataFrame) -> DataFrame:
    return _rounded(I.classification_report(df), ["precision", "recall", "f1"], 9)


def _document_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return labels.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    ready = X.prepared(source.observations(spark, folder, stored=True))
    return _rounded(_rounded(J.ks_drift(ready, X.FEATURE_COLUMNS, "split", "train", "test"), ["statistic"], 9), ["p_value"])


def _attributions(spark: SparkSession, folder: str) -> DataFrame:
    parts = _split_rows(spark, folder)
    return J.attributions(parts, J.reference_means(parts.where("split = 'train'")))


def _global_attribution(spark: SparkSession, folder: str) -> DataFrame:
    parts = _split_rows(spark, folder)
    local = J.attributions(X.seeded_sample(parts), J.reference_means(parts.where("split = 'train'")))
    return J.global_attribution(local)


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def _prototype_queries(spark: SparkSession, folder: str) -> DataFrame:
    return L.prototypes(_embeddings(spark, folder)).withColumnRenamed("label", "query_id")


def _similarity_search(spark: SparkSession, folder: str) -> DataFrame:
    return L.top_k(_prototype_queries(spark, folder), _embeddings(spark, folder))


def _context(spark: SparkSession, folder: str) -> DataFrame:
    texts = _documents(spark, folder).select(F.col("doc_id").alias("vec_id"), "text")
    return L.context(_similarity_search(spark, folder), texts, _prototype_queries(spark, folder))


def _chunk_embedding(spark: SparkSession, folder: str) -> DataFrame:
    chunks = L.chunk_fixed(_documents(spark, folder))
    return L.embed(L.embedder().fit(chunks), chunks).select("doc_id", "chunk_id", "embedding")


def _text_search(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark texts as questions over the chunks of all documents."""
    chunks = L.chunk_fixed(_documents(spark, folder))
    model = L.embedder().fit(chunks)
    embedded = L.embed(model, chunks).select(F.monotonically_increasing_id().alias("vec_id"), "doc_id", "chunk_id", "embedding")
    corpus = stage(embedded, "chunks")  # a chunk's number is fixed once written
    questions = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", F.col("text").alias("chunk"))
    queries = L.embed(model, questions).select(F.col("item_id").alias("query_id"), "embedding")
    found = L.top_k(queries, corpus.select("vec_id", "embedding"))
    return found.join(corpus.select("vec_id", "doc_id", "chunk_id"), "vec_id").drop("vec_id")


def _training(spark: SparkSession, folder: str):
    return G.training_set(source.observations(spark, folder, stored=True))


MEASURES = ["threshold", "precision", "recall", "f1", "pr_auc", "pr_auc_trapezoid", "roc_auc", "false_negative_rate"]


def _trained(name: str, make: Callable[[], object], weighted: bool = False, copies: bool = False) -> Query:
    """Train on the training part, report the metrics row of the validation part."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        _, parts = _training(spark, folder)
        train = G.with_weights(parts["train"]) if weighted else parts["train"]
        train = G.oversample(train) if copies else train
        _, row = G.train_and_evaluate(fitted(make(), train), train, parts["val"], name, already_fitted=True)
        return _rounded(row, MEASURES, 9)
    return run


def _class_weights(spark: SparkSession, folder: str) -> DataFrame:
    train = _split_rows(spark, folder).where("split = 'train'")
    return _rounded(G.class_weights(train), ["balanced_weight", "positive_weight"], 9)


def _search(spark: SparkSession, folder: str) -> DataFrame:
    _, parts = _training(spark, folder)
    return G.random_search(parts["train"]).rows(spark)


def _mode_report(spark: SparkSession, folder: str) -> DataFrame:
    parts = stage(X.split_by_mode(source.observations(spark, folder, stored=True)), "modes")
    train = G.spread(G.with_weights(parts.where("split = 'train'"), "failure_mode"))
    model = G.mode_classifier().fit(train)
    return _report(G.predicted_modes(model, parts.where("split = 'test'")))


def _subspace(spark: SparkSession, folder: str, weights: list[float] | None = None):
    _, parts = _training(spark, folder)
    normal = parts["train"].where("machine_failure = 0")
    return G.SubspaceModel.fit(normal, weights=weights), normal, parts


def _anomaly_metrics(scored: DataFrame, name: str) -> DataFrame:
    rows = scored.select(F.col("anomaly_score").alias("score"), F.col("machine_failure").alias("label"))
    best = I.f1_threshold(I.threshold_points(rows)).first()["threshold"]  # one number
    return _rounded(I.metrics_row(rows, name, "val", best), MEASURES, 9)


def _reconstruction(spark: SparkSession, folder: str) -> DataFrame:
    model, _, parts = _subspace(spark, folder, H.tail_weights(len(X.FEATURE_COLUMNS)))
    return _anomaly_metrics(model.score(parts["val"]), "weighted reconstruction error")


def _centre_distance(spark: SparkSession, folder: str) -> DataFrame:
    model, normal, parts = _subspace(spark, folder)
    return _anomaly_metrics(model.centre_distance(parts["val"], model.centre(normal)), "centre distance")


def _importance(spark: SparkSession, folder: str) -> DataFrame:
    _, parts = _training(spark, folder)
    return G.feature_importance(spark, fitted(G.random_forest(), parts["train"]).stages[0])


def _risk_model(spark: SparkSession, folder: str):
    """The stored pipeline from raw sensors to the risk, and the split rows it was fitted on."""
    parts = stage(_split_rows(spark, folder), "split")
    return fitted(Pipeline(stages=[*G.preparation(), G.decision_tree()]), parts.where("split = 'train'")), parts


def _model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Saved, reloaded, and applied to the raw rows."""
    model, _ = _risk_model(spark, folder)
    scored = H.all_scored(source.to_raw(source.observations(spark, folder)), model)
    return scored.select("UDI", *SCORE_COLUMNS)


def _model_degradation(spark: SparkSession, folder: str) -> DataFrame:
    model, parts = _risk_model(spark, folder)
    return J.model_degradation_risk(parts.drop("split"), model)


def _model_attributions(spark: SparkSession, folder: str) -> DataFrame:
    model, parts = _risk_model(spark, folder)
    means = J.reference_means(parts.where("split = 'train'")).first().asDict()  # one row
    return J.model_attributions(parts.drop("split"), model, means)


def _comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All models on the validation part; each fit is taken from the store where another query did it."""
    _, parts = _training(spark, folder)
    train, val = parts["train"], parts["val"]
    candidates = [("logistic regression", G.logistic_baseline(), train), ("decision tree", G.decision_tree(), train),
                  ("random forest", G.random_forest(), train), ("boosted trees", G.boosted_trees(), train),
                  ("perceptron", G.perceptron(), G.oversample(train)),
                  ("weighted forest", G.random_forest(weight="weight"), G.with_weights(train)),
                  ("tuned forest", G.tuned_forest(G.random_search(train)), train)]
    scores = G.side_by_side([fitted(model, rows) for _, model, rows in candidates], val)
    of = {name: scores.select(F.col(f"score_{i}").alias("score"), "label") for i, (name, _, _) in enumerate(candidates)}
    # each row is written by a job of its own: one plan of all of them takes minutes to make
    rows = [stage(I.metrics_row(of[name], name, "val"), "metrics") for name in of]
    best = I.threshold_for_precision(I.threshold_points(of["weighted forest"])).first()  # one row, or none
    if best:
        rows.append(stage(I.metrics_row(of["weighted forest"], "weighted forest, wanted precision", "val", best["threshold"]), "metrics"))
    return _rounded(I.compare_models(rows), MEASURES, 9)


def _mean_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted squared error against the training mean, which standardised columns have at zero."""
    matrix = X.feature_matrix(source.observations(spark, folder, stored=True)).withColumn("_zero", F.lit(0.0))
    weights = H.tail_weights(len(X.FEATURE_COLUMNS))
    error = H.squared_errors(X.FEATURE_COLUMNS, ["_zero"] * len(X.FEATURE_COLUMNS), weights)
    return _rounded(matrix.select("machine_id", error.alias("anomaly_score")), ["anomaly_score"])


def _run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Machines per status band as the metrics of one run, appended and read back."""
    path = scratch_path(spark, "runs")
    bands = _status(spark, folder).groupBy("status").count().collect()  # three bands
    writers.log_run(spark, path, "status", {"threshold": K.DECISION_THRESHOLD}, [(r["status"], 0, r["count"]) for r in bands])
    return readers.read_run_log(spark, path).where("kind = 'metric'").select("run_id", "key", "step", "value")


def _metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The rule score's threshold at the wanted precision with the feature order, written and read back."""
    path = scratch_path(spark, "metadata")
    best = I.threshold_for_precision(I.threshold_points(_scored(spark, folder))).first()  # one row
    writers.write_metadata(spark, path, "rule score", {}, best["threshold"], K.FEATURE_NAMES, {})
    stored = readers.read_metadata(spark, path)
    return stored.select("model_name", F.round("threshold", 9).alias("threshold"), F.size("feature_names").alias("n_features"))


def _comparison_export(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "comparison")
    writers.write_comparison(_rule_comparison(spark, folder), path)
    stored = spark.read.option("header", True).csv(path)
    return stored.select("model", "split", *[F.col(c).cast("long").alias(c) for c in ("tn", "fp", "fn", "tp")])


TRAINING_QUERIES: dict[str, Query] = {
    "g01_logistic_baseline": _trained("logistic regression", G.logistic_baseline),
    "g02_decision_tree": _trained("decision tree", G.decision_tree),
    "g03_random_forest": _trained("random forest", G.random_forest),
    "g04_boosted_trees": _trained("boosted trees", G.boosted_trees),
    "g05_class_weights": _class_weights,
    "g05_weighted_forest": _trained("weighted forest", lambda: G.random_forest(weight="weight"), weighted=True),
    "g07_search_results": _search,
    "g08_mode_report": _mode_report,
    "g09_perceptron": _trained("perceptron", G.perceptron, copies=True),
    "g10_reconstruction_error": _reconstruction,
    "g11_centre_distance": _centre_distance,
    "g12_feature_importance": _importance,
    "h03_model_scores": _model_scores,
    "h04_anomaly_score": _mean_errors,
    "i16_model_comparison": _comparison,
}

SINK_QUERIES: dict[str, Query] = {
    "a02_flat_sink": _flat_sink,
    "a03_feature_sink": _feature_sink,
    "a04_table_refresh": _table_refresh,
    "a06_text_documents": lambda s, d: _documents(s, d).select(
        "doc_id", "lang", "source", F.length("text").cast("long").alias("n_characters"), F.md5("text").alias("digest")),
    "a07_batch_scoring": _batch_scoring,
    "a09_metadata": lambda s, d: _metadata(s, d),
    "a10_run_log": lambda s, d: _run_log(s, d),
    "a11_comparison_export": lambda s, d: _comparison_export(s, d),
    "a12_feature_table_load": _feature_table_load,
}

SCORING_QUERIES: dict[str, Query] = {
    "h01_rule_score": lambda s, d: H.with_rule_score(source.observations(s, d)).select("machine_id", "failure_probability"),
    "h02_predicted_flag": lambda s, d: H.with_rule_score(source.observations(s, d)).select("machine_id", "predicted_failure"),
    "h03_batch_scores": _batch_scores,
    "h05_anomaly_flag": lambda s, d: _anomalies(s, d).select("machine_id", "anomaly_score", "is_anomaly"),
    "h06_status_bands": lambda s, d: _status(s, d).select("machine_id", "failure_risk", "status"),
    "h07_fleet_kpis": lambda s, d: H.fleet_kpis(_status(s, d)),
    "h07_anomaly_kpis": _anomaly_kpis,
    "h08_worklist": lambda s, d: H.worklist(_status(s, d), "failure_risk"),
    "h08_worklist_top": lambda s, d: H.worklist(_status(s, d), "failure_risk", 100).select(
        "machine_id", "failure_risk", "status"),
    "h09_telemetry_high_risk": _telemetry_high_risk,
    "h10_diagnosis": _diagnoses,
}

EVALUATION_QUERIES: dict[str, Query] = {
    "i01_confusion_matrix": _scores(I.confusion_matrix),
    "i02_point_metrics": lambda s, d: _rounded(
        I.point_metrics(I.confusion_matrix(_scored(s, d))).select("precision", "recall", "f1"), ["precision", "recall", "f1"], 9),
    "i03_false_negative_rate": lambda s, d: _rounded(
        I.point_metrics(I.confusion_matrix(_scored(s, d))).select("false_negative_rate"), ["false_negative_rate"], 9),
    "i04_precision_recall": _points(I.precision_recall),
    "i05_average_precision": _points(I.average_precision),
    "i06_pr_auc_trapezoid": _points(I.pr_auc_trapezoid),
    "i07_roc_auc": _points(I.roc_auc),
    "i07_roc_auc_mode_labels": _points(I.roc_auc, "OSF"),
    "i08_threshold_for_precision": _points(I.threshold_for_precision),
    "i09_f1_threshold": _points(I.f1_threshold),
    "i10_threshold_sweep": _scores(I.threshold_sweep, "precision", "recall", "f1"),
    "i11_cost_sweep": _scores(I.cost_sweep),
    "i11_cheapest_threshold": lambda s, d: I.cheapest_threshold(I.cost_sweep(_scored(s, d))),
    "i12_policy_costs": _scores(I.policy_costs),
    "i13_classification_report": lambda s, d: _report(_predicted(s, d)),
    "i13_report_document_labels": lambda s, d: _report(_document_labels(s, d)),
    "i14_class_separation": _scores(I.class_separation, "mean_normal", "mean_failure", "separation"),
    "i15_score_histogram": _scores(I.score_histogram),
    "i16_rule_comparison": _rule_comparison,
}

DRIFT_QUERIES: dict[str, Query] = {
    "j01_ks_drift": _drift,
    "j02_degradation": lambda s, d: J.degradation_risk(source.observations(s, d)),
    "j02_model_degradation": _model_degradation,
    "j03_attributions": _attributions,
    "j03_model_attributions": _model_attributions,
    "j04_global_attribution": _global_attribution,
    "j04_model_attribution": lambda s, d: J.global_attribution(_model_attributions(s, d)),
}

STREAMING_QUERIES: dict[str, Query] = {
    "k01_replay_scores": replay.replay_scores,
    "k02_replay_status": replay.replay_status,
}

RETRIEVAL_QUERIES: dict[str, Query] = {
    "l01_chunk_fixed": lambda s, d: L.chunk_fixed(_documents(s, d)),
    "l01_chunk_lines": lambda s, d: L.chunk_lines(_documents(s, d)),
    "l01_chunk_separators": lambda s, d: L.chunk_separators(_documents(s, d)),
    "l02_chunk_embedding": _chunk_embedding,
    "l02_term_index": lambda s, d: _text_index(s, d).terms,
    "l03_similarity_search": _similarity_search,
    "l03_text_search": _text_search,
    "l03_term_search": _term_search,
    "l03_pivot_search": _pivot_search,
    "l04_context": _context,
    "l05_risk_protocols": _retrieved_protocols,
}

QUERIES: dict[str, Query] = {
    **SINK_QUERIES, **QUALITY_QUERIES, **MODEL_QUERIES, **FLEET_QUERIES, **STORED_QUERIES, **FEATURE_QUERIES, **EXPLORATION_QUERIES,
    **SCORING_QUERIES, **EVALUATION_QUERIES, **DRIFT_QUERIES, **STREAMING_QUERIES, **RETRIEVAL_QUERIES,
    **TRAINING_QUERIES,
}
