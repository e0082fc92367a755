"""Sources, sinks, streaming, learning, retrieval and plan shapes."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millwright import catalog
from millwright import constants as K
from millwright.catalog import QUERIES
from millwright.operators import evaluation as I
from millwright.operators import features as X
from millwright.operators import learning as G
from millwright.operators import retrieval as L
from millwright.operators import scoring as H
from millwright.operators.modelling import FleetTables
from millwright.operators import fleet_queries as Q
from millwright.operators import forest_search, model_store
from millwright.operators.forest_search import SearchResult, Trees
from millwright.plans.split import folds
from millwright.session import scratch_path
from millwright.sources import readers, writers
from millwright.sources import lineitem_fleet as source
from millwright.sources.schemas import RAW, TABLES
from millwright.streaming import replay


# ---- sources and sinks

def test_csv_keeps_bad_lines_apart(spark, tmp_path):
    header = ",".join(f.name for f in RAW.fields)
    good = "1,M10001,M,298.1,308.6,1551,42.8,0,0,0,0,0,0,0"
    (tmp_path / "raw.csv").write_text(f"{header}\n{good}\n2,L10002,L,hot,308.6,1500,40.0,5,0,0,0,0,0,0\n")
    raw = readers.read_raw(spark, str(tmp_path)).cache()
    assert readers.good_lines(raw).select("UDI", "`Torque [Nm]`").first() == (1, 42.8)
    assert readers.bad_lines(raw).first()[0].startswith("2,L10002")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_raw(spark, str(tmp_path), mode="FAILFAST").collect()


def test_text_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "deep" / "b.txt").write_text("three")
    (tmp_path / "c.md").write_text("no")
    assert sorted(r["text"] for r in readers.read_text_folder(spark, str(tmp_path)).collect()) == ["one\ntwo", "three"]


def test_metadata_round_trip(spark, tmp_path):
    path = str(tmp_path / "meta")
    writers.write_metadata(spark, path, "forest", {"numTrees": 400, "maxDepth": None}, 0.5, K.FEATURE_NAMES, {"f1": 0.875})
    row = readers.read_metadata(spark, path).first()
    assert row["feature_names"] == K.FEATURE_NAMES and row["threshold"] == 0.5
    assert row["best_params"]["numTrees"] == "400" and row["val_metrics"] == {"f1": "0.875"}


def test_metadata_of_pretty_printed_file(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"model_name": "x", "feature_names": ["b", "a"], "threshold": 0.5}, indent=2))
    assert readers.read_metadata(spark, str(tmp_path / "m.json")).first()["feature_names"] == ["b", "a"]


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    writers.log_run(spark, path, "r1", {"sample_size": 100}, [("mean_risk", 0, 0.1), ("mean_risk", 1, 0.2)])
    writers.log_run(spark, path, "r2", {}, [("mean_risk", 0, 0.3)])
    log = readers.read_run_log(spark, path)
    assert log.count() == 4 and log.where("run_id = 'r1' AND kind = 'metric'").count() == 2


def test_table_refresh_is_repeatable(spark, clean, tmp_path):
    folder = str(tmp_path / "tables")
    tables = FleetTables.from_observations(clean)
    for _ in range(2):
        writers.write_tables(tables.named(), folder)
    stored = FleetTables.load(spark, folder)
    for name, schema in TABLES.items():
        assert stored.named()[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]
    assert stored.failure_events.count() == tables.failure_events.count()
    for query in (Q.failure_rate_by_type, Q.torque_outliers, Q.wear_quartile_failures, Q.high_torque, Q.multi_mode_machines):
        assert query(stored).collect() == query(tables).collect()


def test_a_refresh_is_all_or_nothing(spark, clean, tmp_path, monkeypatch):
    from millwright.operators import etl
    from millwright.sources import versions

    folder = str(tmp_path / "fleet")
    with pytest.raises(FileNotFoundError):
        etl.load_fleet(spark, folder)
    few, more = clean.where("machine_id % 7 = 0"), clean.where("machine_id % 3 = 0")
    etl.refresh_fleet(few, folder)
    before = {name: t.count() for name, t in etl.load_fleet(spark, folder).named().items()}
    whole = etl.write_table
    for stop in TABLES:
        def failing(name, df, path, stop=stop):
            if name == stop:
                raise OSError(name)
            whole(name, df, path)
        monkeypatch.setattr(etl, "write_table", failing)
        with pytest.raises(OSError, match=stop):
            etl.refresh_fleet(more, folder)
        assert {name: t.count() for name, t in etl.load_fleet(spark, folder).named().items()} == before
    monkeypatch.setattr(etl, "write_table", lambda name, df, path: whole(name, df.limit(0) if name == "machines" else df, path))
    with pytest.raises(etl.RefreshRejected, match="machine_id"):
        etl.refresh_fleet(more, folder)
    assert {name: t.count() for name, t in etl.load_fleet(spark, folder).named().items()} == before
    monkeypatch.setattr(etl, "write_table", whole)
    held = etl.load_fleet(spark, folder)
    etl.refresh_fleet(more, folder)
    assert etl.load_fleet(spark, folder).machines.count() == more.count() and held.machines.count() == before["machines"]
    etl.refresh_fleet(few, folder)  # the first version expires
    assert len(list((tmp_path / "fleet" / "versions").iterdir())) == 2
    (tmp_path / "fleet" / "commits" / "000000000099").touch()  # cut off while written
    assert etl.load_fleet(spark, folder).machines.count() == before["machines"]
    assert versions.current(spark, str(tmp_path / "nowhere")) is None


def test_lines_are_numbered_only_for_ids(spark, small):
    for name, numbered in (("e12_correlations", False), ("i04_precision_recall", False), ("e06_class_balance", False), ("h01_rule_score", True)):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert ("row_number() windowspecdefinition(l_orderkey" in plan) == numbered, name


def test_events_are_numbered_only_when_asked_for(spark, small, monkeypatch):
    """Cutting the tables runs no job, and a query that counts events by mode numbers neither lines nor events."""
    from millwright.operators import modelling

    monkeypatch.setattr(modelling, "failure_events", None)
    for name in ("c04_failure_mode", "q07_multi_mode_repeated", "q06_wear_quartile_failures"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_linenumber" not in plan if name.startswith("q06") else "row_number" not in plan, name


@pytest.mark.parametrize("name", ["f12_standardised", "f18_aligned", "f19_display_names", "g05_class_weights", "j03_attributions"])
def test_split_rows_number_their_lines_once(spark, small, name, monkeypatch):
    calls = []
    number = source.number_lines
    monkeypatch.setattr(source, "number_lines", lambda lines: calls.append(1) or number(lines))
    plan = QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert len(calls) == 1 and "l_linenumber" not in plan  # the numbered lines are read back


def test_maintenance_events_keep_what_the_stored_tables_give(spark, small):
    observed = FleetTables.from_observations(source.repeated_observations(spark, small, stored=True))
    plain = FleetTables.from_observations(source.repeated_observations(spark, small))
    columns = ["maintenance_id", "machine_id", "event_id", "tool_wear_at_event", "notes"]
    assert sorted(observed.maintenance_events.select(columns).collect()) == sorted(plain.maintenance_events.select(columns).collect())
    assert list(observed.named()) == list(TABLES)


def test_etl_from_csv(spark, clean, tmp_path):
    from millwright.operators.etl import run_etl

    writers.write_flat(source.to_raw(clean), str(tmp_path / "raw"), "csv")
    loaded = run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "tables"))
    tables = FleetTables.from_observations(clean)
    assert loaded.machines.count() == clean.count()
    assert loaded.failure_events.exceptAll(tables.failure_events).count() == 0
    assert loaded.maintenance_events.count() == tables.failure_events.count()


def test_comparison_export(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.5), ("b", 0.9)], "model string, pr_auc double")
    writers.write_comparison(rows, str(tmp_path / "cmp"))
    assert spark.read.option("header", True).csv(str(tmp_path / "cmp")).count() == 2


def test_clean_csv_sink(spark, clean, tmp_path):
    writers.write_flat(clean, str(tmp_path / "flat"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "flat")).count() == clean.count()


def test_one_observation_per_line(spark, small):
    """Every delivered line gives one reading with a unique id whose values come from that line alone."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    numbered = source.number_lines(lines)
    assert numbered.select("udi").distinct().count() == lines.count() == source.observations(spark, small).count()
    values = numbered.drop("udi")
    delivered = lines.select(*[F.col(column).alias(name) for name, column in source.LINE_VALUES.items()])
    assert values.exceptAll(delivered).count() == 0 and delivered.exceptAll(values).count() == 0


def test_many_lines_in_an_order(spark):
    row = "1L l_orderkey, CAST(id % 300 AS INT) l_linenumber, id l_partkey, 0L l_suppkey, 1D l_quantity, 2D l_extendedprice, 0D l_discount"
    lines = spark.sql(f"SELECT {row}, 0D l_tax, 'A' l_returnflag, 'F' l_linestatus, DATE'2020-01-01' l_shipdate FROM range(1200)")
    assert source.number_lines(lines).select("udi").distinct().count() == 1200


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_numbered_in_bounded_tasks(spark, monkeypatch):
    """However few partitions a session has, no task sorts more rows than it should, and no column that no value needs."""
    from millwright.plans import ordering

    row = "id DIV 3 l_orderkey, CAST(id % 2 AS INT) l_linenumber, id % 5 l_partkey, 0L l_suppkey, 1D l_quantity, 2D l_extendedprice, 0D l_discount"
    lines = spark.sql(f"SELECT {row}, 0D l_tax, 'A' l_returnflag, 'F' l_linestatus, DATE'2020-01-01' l_shipdate FROM range(1200)")
    whole = source.number_lines(lines)
    monkeypatch.setattr(ordering, "TASK_ROWS", 100)
    bounded = source.number_lines(lines)
    assert bounded.rdd.getNumPartitions() == 12 and "l_shipdate" not in bounded._jdf.queryExecution().executedPlan().toString()
    assert bounded.exceptAll(whole).count() == 0 and whole.exceptAll(bounded).count() == 0


def test_the_maintenance_log_of_a_refresh_joins_nothing(spark, rows, tmp_path, monkeypatch):
    from millwright.operators import etl
    from millwright.operators.modelling import maintenance_events

    clean = rows(dict(TWF=1, machine_failure=1, tool_wear_min=7), dict(), dict(machine_failure=1, HDF=1, PWF=1, tool_wear_min=9),
                 dict(machine_id=None, product_id="M0", OSF=1, tool_wear_min=5), dict(OSF=1, tool_wear_min=None))
    plans, whole = {}, etl.write_table
    monkeypatch.setattr(etl, "write_table", lambda name, df, path: plans.update({name: _plan(df)}) or whole(name, df, path))
    stored = etl.refresh_fleet(clean, str(tmp_path / "fleet"))
    assert "Join" not in plans["maintenance_events"]
    wanted = maintenance_events(stored.failure_events, stored.sensor_readings)  # by a join
    assert stored.maintenance_events.count() == 5 and stored.maintenance_events.exceptAll(wanted).count() == 0


def test_stored_readings_meet_their_machines_once(spark, clean, tmp_path):
    """Failure rates count readings per machine before the join; wear quartiles read the joined rows back."""
    from millwright.operators import etl

    stored = etl.refresh_fleet(clean.withColumn("machine_id", F.col("machine_id") % 9).drop("product_id", "type_code").selectExpr(
        "*", "concat('M', 10000 + machine_id) AS product_id", "'M' AS type_code"), str(tmp_path / "fleet"))
    rates = Q.failure_rate_by_type(stored)
    assert "Aggregate [machine_id" in _plan(rates)
    assert [r["machine_count"] for r in rates.collect()] == [clean.count()]
    assert [r["failures"] for r in rates.collect()] == [clean.where("machine_failure = 1").count()]
    quartiles = Q.wear_quartiles(stored)
    assert not any("/machines/" in name for name in quartiles.inputFiles())
    assert quartiles.count() == clean.count()


def test_forests_keep_node_ids_and_grow_the_same_trees(spark):
    tuned = G.tuned_forest(SearchResult([{"numTrees": 3}], [0.5], [0.0]))
    for forest in (G.random_forest(), G.random_forest(weight="weight"), tuned, G.mode_classifier().getStages()[2]):
        assert forest.getCacheNodeIds()
    rows = spark.range(400).selectExpr("id % 7 AS a", "id % 11 AS b", "IF(id % 7 > 3 AND id % 11 > 4, 1, 0) AS machine_failure")
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).coalesce(1)
    kept, walked = (G.random_forest(5, 4).setCacheNodeIds(c).fit(train).toDebugString.split("\n", 1)[1] for c in (True, False))
    assert kept == walked


# ---- streaming

def test_replay_equals_batch_and_restarts(spark, small, tmp_path):
    lines = source.number_lines(spark.read.parquet(f"{small}/lineitem.parquet"))
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    lines.repartition(3).write.parquet(folder)
    for _ in range(2):  # the second run finds nothing new
        replay.run_replay(source.observe(replay.replay_source(spark, folder, "*.parquet")), out, check)
    batch = replay.score_rows(source.observations(spark, small))
    stored = spark.read.parquet(out)
    assert stored.count() == lines.count()
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


def test_status_counts_equal_batch(spark, small):
    got = {r["status"]: r["n"] for r in replay.replay_status(spark, small).collect()}
    want = replay.score_rows(source.observations(spark, small)).groupBy("status").count().collect()
    assert got == {r["status"]: r["count"] for r in want}


# ---- learning

@pytest.fixture(scope="module")
def trained(spark, clean):
    return G.training_set(clean)


def test_pipeline_survives_saving(spark, clean, tmp_path):
    train = X.split_fleet(clean).where("split = 'train'")
    model = Pipeline(stages=[*G.preparation(), G.decision_tree()]).fit(train)
    G.save_model(model, str(tmp_path / "model"))
    again = G.load_model(str(tmp_path / "model"))
    raw = source.to_raw(clean)
    ours, _ = H.score_raw(raw, model)
    theirs, _ = H.score_raw(raw, again)
    columns = ["UDI", "failure_probability", "predicted_failure"]
    assert sorted(ours.select(columns).collect()) == sorted(theirs.select(columns).collect())


def test_pipeline_equals_matrix(spark, clean):
    """The fitted stages and the one-plan feature matrix agree on every split."""
    _, parts = G.training_set(clean)
    ours = parts["val"].select("machine_id", *[F.round(c, 6).alias(c) for c in X.FEATURE_COLUMNS])
    plan = X.feature_matrix(clean).where("split = 'val'").select(
        "machine_id", *[F.round(c, 6).alias(c) for c in X.FEATURE_COLUMNS])
    assert sorted(ours.collect()) == sorted(plan.collect())


def test_harness_reuses_fitted_models(trained):
    _, parts = trained
    model, row = G.train_and_evaluate(G.decision_tree(), parts["train"], parts["val"], "tree")
    same, low = G.train_and_evaluate(model, parts["train"], parts["val"], "tree", threshold=0.1, already_fitted=True)
    assert same is model
    first, second = row.first(), low.first()
    assert first["split"] == "val" and first["pr_auc"] == second["pr_auc"] and second["recall"] >= first["recall"]
    assert first["tp"] + first["fn"] == parts["val"].where("machine_failure = 1").count()


def test_folds_are_exactly_stratified(spark):
    for n, k in ((103, 5), (7, 4), (2, 3)):
        df = spark.range(n).selectExpr("id AS machine_id", "IF(id % 7 = 0, 1, 0) AS machine_failure").repartition(3)
        got = [tuple(r) for r in folds(df, "machine_id", "machine_failure", 42, k).groupBy("machine_failure", "fold").count().collect()]
        for label in (0, 1):
            sizes = [c for m, _, c in got if m == label] + [0] * (k - sum(m == label for m, _, _ in got))
            assert max(sizes) - min(sizes) <= 1 and sum(sizes) == df.where(f"machine_failure = {label}").count()


def test_cut_forests_equal_forests_of_their_own(spark, trained):
    import numpy as np
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array

    _, parts = trained
    rows = parts["train"].limit(1500).cache()
    x = np.stack([r[0].toArray() for r in rows.select("features").collect()])

    def fit(depth):
        return RandomForestClassifier(labelCol=G.LABEL, numTrees=6, maxDepth=depth, featureSubsetStrategy="all", seed=1).fit(rows)

    deep = fit(7)
    trees = Trees.of(spark, deep)
    for depth in (1, 3, 7, 30):
        own = [r[0] for r in fit(min(depth, 7)).transform(rows).select(vector_to_array("probability")[1]).collect()]
        np.testing.assert_allclose(trees.scores(x, [(6, depth)])[:, 0], own, atol=1e-12)
    first = [sum(t.predictProbability(v)[1] for t in deep.trees[:2]) / 2 for v in [r[0] for r in rows.select("features").limit(20).collect()]]
    np.testing.assert_allclose(trees.scores(x[:20], [(2, 7), (6, 7)])[:, 0], first, atol=1e-12)


def test_fold_precision_equals_average_precision(spark):
    rows = [(d, f, round(((i * 37 + d * 11 + f) % 50) / 50, 2), int((i + d) % 4 == 0)) for d in range(3) for f in range(2) for i in range(60)]
    scores = spark.createDataFrame(rows, "draw int, fold int, score double, label int")
    got = {(r["draw"], r["fold"]): r["precision"] for r in forest_search.fold_precision(scores).collect()}
    for (d, f), value in got.items():
        own = scores.where(f"draw = {d} AND fold = {f}").select("score", "label")
        assert value == pytest.approx(I.average_precision(I.threshold_points(own)).first()[0])
    assert len(got) == 6


def test_families_share_a_fit():
    draws = G.draw_parameters(G.SEARCH_SPACE)
    groups = forest_search.families(draws)
    assert sorted(i for g in groups for i in g) == list(range(40)) and len(groups) <= 9
    for group in groups:
        assert len({(draws[i]["minInstancesPerNode"], draws[i]["featureSubsetStrategy"]) for i in group}) == 1


def test_models_are_fitted_once(spark, trained, monkeypatch):
    _, parts = trained
    model = model_store.fitted(G.decision_tree(3), parts["train"])
    def second_fit(*_):
        raise AssertionError("fitted again")

    monkeypatch.setattr(model_store.Pipeline, "fit", second_fit)
    again = model_store.fitted(G.decision_tree(3), parts["train"].repartition(3))
    assert again.stages[0].toDebugString.split("\n")[1:] == model.stages[0].toDebugString.split("\n")[1:]
    with pytest.raises(AssertionError, match="again"):
        model_store.fitted(G.decision_tree(4), parts["train"])
    both = G.side_by_side([model, again], parts["val"])
    assert both.where("score_0 != score_1").count() == 0 and both.count() == parts["val"].count()


def test_digest_of_many_rows(spark):
    """The sums of a digest hold more rows than 64 bits do."""
    rows = spark.range(25_000_000)
    assert model_store.rows_digest(rows).startswith("25000000-")


def test_search_and_importance(spark, trained):
    _, parts = trained
    space = {"numTrees": [3, 5], "maxDepth": [2, 3]}
    found = G.random_search(parts["train"], space, draws=4, k=2)
    listed = found.rows(spark).collect()
    assert len(listed) == 4 and listed[0]["mean_test_score"] >= listed[-1]["mean_test_score"] > 0
    assert listed[0]["mean_test_score"] == max(found.means) and G.tuned_forest(found).getNumTrees() == found.best["numTrees"]
    ranked = G.feature_importance(spark, G.random_forest(5, 3).fit(parts["train"]))
    assert ranked.count() == 14 and ranked.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_drawn_parameters_are_distinct_and_repeatable():
    draws = G.draw_parameters(G.SEARCH_SPACE, 40)
    assert draws == G.draw_parameters(G.SEARCH_SPACE, 40)
    assert len({tuple(sorted(d.items())) for d in draws}) == 40


def test_subspace_scores(spark, trained, tmp_path):
    import numpy as np

    _, parts = trained
    normal = parts["train"].where("machine_failure = 0")
    model = G.SubspaceModel.fit(normal, weights=H.tail_weights(14))
    head = parts["val"].orderBy("machine_id").limit(20)
    values = np.array([[r[c] for c in X.FEATURE_COLUMNS] for r in head.collect()], dtype=float)
    rebuilt = values @ model.components @ model.components.T
    want = np.mean((values - rebuilt) ** 2 * np.array(model.weights), axis=1)
    got = [r[0] for r in model.score(head).orderBy("machine_id").select("anomaly_score").collect()]
    assert got == pytest.approx(list(want))
    centre = model.centre(normal)
    far = np.sum((values @ model.components - np.array(centre)) ** 2, axis=1)
    got = [r[0] for r in model.centre_distance(head, centre).orderBy("machine_id").select("anomaly_score").collect()]
    assert got == pytest.approx(list(far)) and all(abs(c) >= 0.1 for c in centre)
    model.save(spark, str(tmp_path / "subspace"))
    assert np.allclose(G.SubspaceModel.load(spark, str(tmp_path / "subspace")).components, model.components)


def test_oversampling_balances(trained):
    _, parts = trained
    counts = {r["machine_failure"]: r["count"] for r in G.oversample(parts["train"]).groupBy("machine_failure").count().collect()}
    assert 0.5 < counts[1] / counts[0] < 1.5


def test_model_drift_and_attribution(clean, trained):
    from pyspark.ml.functions import vector_to_array

    from millwright.operators import drift as J

    train = X.split_fleet(clean).where("split = 'train'")
    model = Pipeline(stages=[*G.preparation(), G.decision_tree(3)]).fit(train)
    steps = J.model_degradation_risk(clean, model, steps=(0, 2)).collect()
    assert {r["step"] for r in steps} == {0, 2} and all(0 <= r["mean_risk"] <= 1 for r in steps)
    means = J.reference_means(train).first().asDict()
    local = J.model_attributions(X.seeded_sample(clean, 5), model, means, top=3)
    assert local.count() == 15 and local.agg(F.max("rank")).first()[0] == 3
    heat = {r["step"]: r["mean_risk"] for r in J.model_degradation_risk(clean, model, steps=(0, 4)).collect()}
    assert heat[0] != heat[4]
    kept = H.all_scored(source.to_raw(clean), model).select("UDI", "`Torque [Nm]`").exceptAll(source.to_raw(clean).select("UDI", "`Torque [Nm]`"))
    assert kept.count() == 0  # the model's scaling does not reach the rows
    four = J.drifted_sensors(4)
    own = model.transform(clean.withColumns(four)).select(vector_to_array("probability")[1].alias("p"))
    assert heat[4] == pytest.approx(own.agg(F.avg("p")).first()[0], abs=1e-8)
    for made in (local, J.model_degradation_risk(clean, model, steps=(0, 2))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(machine_id" not in plan
    # a row's contributions are its score less its score with one sensor at the mean
    row = clean.orderBy("machine_id").limit(1)

    def risk(df):
        return model.transform(df).select(vector_to_array("probability")[1]).first()[0]

    got = {r["feature"]: r["contribution"] for r in J.model_attributions(row, model, means).collect()}
    assert got == {n: pytest.approx(risk(row) - risk(row.withColumn(n, F.lit(float(m)))), abs=1e-8) for n, m in means.items()}


def test_rejected_rows_stay_with_their_reasons(rows):
    raw = source.to_raw(rows({}, {"torque_nm": -1.0}, {"type_code": "X", "air_temperature_k": 30.0}))
    got = {r["UDI"]: r for r in H.all_scored(raw).collect()}
    assert len(got) == 3 and got[1]["rejected_for"] is None and 0 <= got[1]["failure_probability"] <= 1
    assert got[2]["failure_probability"] is None and got[2]["rejected_for"] == "torque_nm >= 0"
    assert got[3]["rejected_for"] == "type_code in domain; air temperature plausible"


# ---- retrieval

def test_fixed_chunk_borders(spark):
    texts = ["", "a" * 500, "b" * 501, "c" * 950, "d" * 951, "line\nbreak \U0001F600" + "e" * 600]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in L.chunk_fixed(df).orderBy("doc_id", "chunk_id").collect():
        got.setdefault(r["doc_id"], []).append(r["chunk"])
    assert 0 not in got
    for i, text in enumerate(texts[1:], start=1):
        starts = range(0, max(len(text) - 50, 1), 450)
        assert got[i] == [text[s:s + 500] for s in starts]


def test_line_chunks(spark):
    lines = ["", "a" * 10, "b" * 600, "", "c", "d" * 499]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, ""), (3, None), (4, "one")], "doc_id long, text string")
    got = {(r["doc_id"], r["chunk_id"]): r["chunk"] for r in L.chunk_lines(df).collect()}
    assert got == {(1, 0): "\n".join(lines[:3]), (1, 1): "\n".join(lines[3:]), (4, 0): "one"}


def test_top_k_against_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    corpus, queries = rng.normal(size=(300, 8)), rng.normal(size=(4, 8))
    corpus[10] = corpus[20]  # a tie
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id int, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in L.top_k(q, c.repartition(7), 5).collect()}
    c32 = corpus.astype("float32").astype("float64")
    scores = np.round((c32 / np.linalg.norm(c32, axis=1, keepdims=True)) @ (
        queries / np.linalg.norm(queries, axis=1, keepdims=True)).T, 9)
    for j in range(4):
        order = np.lexsort((np.arange(300), -scores[:, j]))[:5]
        assert [got[j, r] for r in range(1, 6)] == list(order)
    assert L.top_k(q.limit(0), c).count() == 0


def test_queries_are_searched_in_blocks(spark, monkeypatch):
    corpus = spark.range(50).selectExpr("id AS vec_id", "array(CAST(id AS DOUBLE), 1D) AS embedding")
    queries = spark.range(20).selectExpr("id AS query_id", "array(1D, CAST(id AS DOUBLE)) AS embedding")
    whole = sorted(map(tuple, L.top_k(queries, corpus).collect()))
    monkeypatch.setattr(L, "QUERY_BLOCK", 3)
    assert sorted(map(tuple, L.top_k(queries, corpus).collect())) == whole and len(whole) == 60


def test_context_fallback(spark):
    hits = spark.createDataFrame([(1, 7, 0.9, 1), (1, 8, 0.8, 2)], "query_id int, vec_id long, score double, rank int")
    texts = spark.createDataFrame([(7, "first"), (8, "second")], "vec_id long, text string")
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    got = {r["query_id"]: r["context"] for r in L.context(hits, texts, queries).collect()}
    assert got == {1: "first\n\nsecond", 2: K.NOT_FOUND}


# ---- plans

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


NATIVE = [n for n in QUERIES if n[0] in "bcqefhij" and n not in ("h03_model_scores", "i16_model_comparison", "h04_anomaly_score")]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_cross_joins(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for bad in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_scan_reads_only_needed_columns(spark, small):
    # the fleet's ids order whole lines, so its scans read every column of lineitem; other tables are pruned
    assert "props" not in plan_of(QUERIES["b12_id_profile"](spark, small))
    assert "doc_id" not in plan_of(QUERIES["b01_copy_report"](spark, small))


def test_top_lists_do_not_sort_the_fleet(spark, small):
    for name in ("q02_torque_rank", "q03_torque_outliers", "q04_highest_stress", "q09_torque_moving_average", "h08_worklist_top"):
        plan = plan_of(QUERIES[name](spark, small))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan.split("TakeOrderedAndProject")[-1], name


class StubSession:
    """A session as far as the shared folder is concerned."""

    def __init__(self, configured, master):
        self.conf = self
        self.sparkContext = self
        self.configured, self.master = configured, master

    def get(self, key, default):
        return self.configured if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_a_run_removes_what_it_staged(spark, monkeypatch):
    from millwright import session
    mine = session.stage(spark.range(3), "kept-by-others")
    monkeypatch.setattr(session, "RUN", "anotherrun")
    path = scratch_path(spark, "gone")
    spark.range(5).write.parquet(path)
    session.remove_scratch(spark)
    assert not session.file_exists(spark, path) and mine.count() == 3
    session.create_file(spark, path, "once")
    assert spark.read.text(path).first()[0] == "once" and path.rsplit("/", 1)[1] in session.names_in(spark, path.rsplit("/", 1)[0])
    with pytest.raises(Exception):
        session.create_file(spark, path)


def test_shared_folder_is_the_configured_one():
    assert scratch_path(StubSession("/shared/place/", "spark://x"), "job").startswith("/shared/place/millwright/job-")
    with pytest.raises(RuntimeError):
        scratch_path(StubSession(None, "spark://x"), "job")


def test_metrics_row_names_its_split(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0)], "score double, label int")
    row = I.metrics_row(df, "m", "test").first()
    assert row["split"] == "test" and row["pr_auc"] == 1.0 and row["roc_auc"] == 1.0


def test_training_queries_do_the_whole_job(spark, monkeypatch):
    parts = {name: spark.createDataFrame([(n, n % 2) for n in range(4)], "machine_id long, machine_failure int") for name in ("train", "val")}
    trained, searches = [], []
    scores = spark.createDataFrame([tuple([0.9] * 7 + [1]), tuple([0.2] * 7 + [0])], ", ".join(f"score_{i} double" for i in range(7)) + ", label int")
    found = SearchResult(G.draw_parameters(G.SEARCH_SPACE), [n / 40 for n in range(40)], [0.0] * 40)
    monkeypatch.setattr(catalog, "_training", lambda *_: (None, parts))
    monkeypatch.setattr(catalog, "fitted", lambda model, rows: trained.append(model) or model)
    monkeypatch.setattr(G, "train_and_evaluate", lambda model, train, held, name, already_fitted: (
        model, spark.createDataFrame([(name, "val", 0.5, *[0.5] * 7)], ["model", "split", *catalog.MEASURES])))
    monkeypatch.setattr(G, "side_by_side", lambda models, df: scores)
    monkeypatch.setattr(G, "random_search", lambda *args, **more: searches.append((args[1:], more)) or found)
    catalog.QUERIES["g04_boosted_trees"](spark, "").collect()
    assert trained[-1].getMaxIter() == 300
    assert catalog.QUERIES["g07_search_results"](spark, "").count() == 10
    rows = {r["model"] for r in catalog.QUERIES["i16_model_comparison"](spark, "").collect()}
    assert rows == {"logistic regression", "decision tree", "random forest", "boosted trees", "perceptron", "weighted forest",
                    "weighted forest, wanted precision", "tuned forest"}
    assert [m.getMaxIter() for m in trained if hasattr(m, "getMaxIter")][1:] == [1000, 300, 120]
    assert [m.getNumTrees() for m in trained if hasattr(m, "getNumTrees")] == [300, 300, found.best["numTrees"]]
    assert searches == [((), {})] * 2 and len(found.draws) == 40


def test_trees_are_scored_as_expressions(spark, rows):
    """The same risks as by the fitted pipeline, without vectors or a join, for missing sensors and unknown types too."""
    from pyspark.ml.functions import vector_to_array

    from millwright.operators import drift as J

    ordinary = [{"machine_id": i, "type_code": "LMH"[i % 3], "torque_nm": float(10 + i * 7 % 60), "tool_wear_min": i * 13 % 253,
                 "air_temperature_k": 295 + i % 9 / 2, "machine_failure": int(i * 7 % 60 > 40 and i * 13 % 253 > 100)} for i in range(1, 300)]
    odd = [{"type_code": "X"}, {"type_code": None, "product_id": "p"}, {"torque_nm": None}, {"torque_nm": 0.0}, {"tool_wear_min": None}, {"air_temperature_k": float("nan")},
           {"rotational_speed_rpm": None, "machine_failure": None}]
    clean = rows(*ordinary, *odd)
    inner = Pipeline(stages=[*G.preparation(), G.decision_tree()])
    model = Pipeline(stages=[inner]).fit(clean.where("machine_id <= 299 AND torque_nm > 0 AND air_temperature_k < 400"))  # as the store keeps it
    assert model.stages[0].stages[-1].numNodes >= 5
    risks = H.scored_beside(clean, model, {}, "risk")
    plan = _plan(risks)
    assert "UDF" not in plan and "Join" not in plan
    own = model.transform(clean.withColumn("sensor", F.col("torque_nm"))).select("machine_id", "sensor", vector_to_array("probability")[1].alias("risk"))
    got = risks.select("machine_id", F.col("torque_nm").alias("sensor"), "risk")
    assert got.count() == own.count() and got.exceptAll(own).count() == 0
    assert "UDF" not in _plan(J.model_attributions(clean, model, {"torque_nm": 40.0}))
    logistic = Pipeline(stages=[*G.preparation(), G.logistic_baseline(5)]).fit(clean.where("machine_id <= 250 AND machine_failure >= 0"))
    assert H.scored_beside(clean, logistic, {}, "risk").where("risk BETWEEN 0 AND 1").count() > 0  # any other model by its own transform


def test_groups_beyond_literals_are_joined(spark):
    from millwright.operators import transformers as T

    df = spark.createDataFrame([(f"g{i % 60}", float(i)) for i in range(240)] + [(None, 3.0), ("new", 4.0)], "g string, v double")
    many = T.GroupedZScorer("v", "g", "z").fit(df.where("g <> 'new'"))
    few = T.GroupedZScorer("v", "g", "z").fit(df.where("g <> 'new' AND g < 'g3'"))
    assert len(many.getOrDefault("groups")) > T.FEW_GROUPS >= len(few.getOrDefault("groups"))
    assert "Join" in _plan(many.transform(df)) and "Join" not in _plan(few.transform(df))
    shared = df.where("g IS NULL OR g = 'new' OR g < 'g3'")
    for model in (many, few):
        stats = {g: (m, s) for g, m, s in zip(*(model.getOrDefault(n) for n in ("groups", "means", "stds")))}
        overall = tuple(model.getOrDefault("overall"))
        for r in model.transform(shared).collect():
            mean, std = stats.get(r["g"], overall)
            assert r["z"] == pytest.approx((r["v"] - mean) / std)


def test_degradation_scores_a_row_by_one_expression(spark, clean):
    """Each step's mean is that of the drifted rows scored alone; the model is compiled once; a fleet without rows keeps its steps."""
    from millwright.operators import drift as J

    model = Pipeline(stages=[*G.preparation(), G.decision_tree(3)]).fit(X.split_fleet(clean).where("split = 'train'"))
    made = J.model_degradation_risk(clean, model, steps=(0, 1, 3, 3))
    alone = {s: H.scored_beside(clean, model, J.drifted_sensors(s), "p").agg(F.avg("p")).first()[0] for s in (0, 1, 3)}
    assert [(r["step"], r["mean_risk"]) for r in made.collect()] == [(s, pytest.approx(alone[s], abs=1e-8)) for s in (0, 1, 3, 3)]
    assert "UDF" not in _plan(made) and "Generate explode" in _plan(made)
    assert [tuple(r) for r in J.model_degradation_risk(clean.limit(0), model, steps=(0, 2)).collect()] == [(0, None), (2, None)]


def test_weights_leave_rows_in_their_tasks(spark):
    """Dealt by label, two classes would fill two tasks; each row takes its class's weight, a row without a label none."""
    df = spark.createDataFrame([(i, None if i == 5 else int(i % 10 == 0)) for i in range(200)], "machine_id long, machine_failure int").repartition(4)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a large fleet is under no threshold
    try:
        weighed = G.with_weights(df)
        assert "hashpartitioning(machine_failure" not in weighed._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in weighed._jdf.queryExecution().executedPlan().toString()
        got = {r["machine_id"]: r["weight"] for r in weighed.collect()}
        tasks = weighed.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert tasks == 4 and set(got) == set(range(200)) - {5}
    assert got[0] == 200 / (3 * 20) and got[1] == 200 / (3 * 179)  # a missing label counts as a class of its own, as before


def test_large_forests_grow_in_bounded_fits(spark, trained, monkeypatch, tmp_path):
    """All trees, over all rows, joined to one forest that scores as the mean of its trees; a small one is a single fit."""
    from pyspark.ml.functions import vector_to_array

    import numpy as np

    from millwright.operators import forests

    assert forests.shares(300, 420_000) == [300]
    assert sum(forests.shares(300, 25_200_000)) == 300 and max(forests.shares(300, 25_200_000)) * 25_200_000 <= forests.FOREST_CELLS
    assert set(forests.shares(300, 10**12)) == {forests.LEAST_TREES} and forests.shares(7, 0) == [7]
    _, parts = trained
    sizes, own = [], forests.RandomForestClassifier._fit
    monkeypatch.setattr(forests.RandomForestClassifier, "_fit", lambda self, rows: sizes.append((self.getNumTrees(), rows.count())) or own(self, rows))
    train = G.with_weights(parts["train"])
    n = train.count()
    monkeypatch.setattr(forests, "FOREST_CELLS", 6 * n)
    model = Pipeline(stages=[G.random_forest(16, 3, "weight")]).fit(train)
    assert sizes == [(6, n), (5, n), (5, n)]
    forest = model.stages[0]
    assert forest.getNumTrees == 16 and forest.numClasses == 2 and forest.getOrDefault("weightCol") == "weight"
    assert len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) > 8  # each fit draws for itself
    assert abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9
    model.write().save(str(tmp_path / "forest"))
    again = G.load_model(str(tmp_path / "forest"))
    few = parts["val"].limit(20).cache()
    got = [r[0] for r in again.transform(few).select(vector_to_array("probability")[1]).collect()]
    vectors = [r["features"] for r in few.collect()]
    assert got == pytest.approx([sum(t.predictProbability(v)[1] for t in forest.trees) / 16 for v in vectors])
    cut = Trees.of(spark, forest)
    assert list(cut.scores(np.stack([v.toArray() for v in vectors]), [(16, 3)])[:, 0]) == pytest.approx(got)
