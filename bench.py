"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores, BENCH_QUERIES
optionally the queries to time. Every query is built and its whole result computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millwright.catalog import QUERIES  # noqa: E402
from millwright.session import build_session  # noqa: E402

HEADLINE = [
    "q01_failure_rate", "q02_torque_rank", "q02_torque_rank_all", "q03_torque_outliers", "q04_highest_stress",
    "q05_mode_pareto", "q06_wear_quartile_failures", "q07_multi_mode", "q08_maintenance_sequence",
    "q09_torque_moving_average", "q09_torque_moving_average_all", "q10_compound_anomalies", "q11_high_torque",
    "q12_failure_cost", "b01_drop_copies", "b05_domain_rules", "b07_foreign_keys", "c06_failure_events",
    "c07_maintenance_events", "e01_describe", "e03_iqr_outliers", "e08_five_numbers", "e09_mann_whitney",
    "e12_correlations", "f02_stratified_split", "f10_grouped_z", "f15_feature_matrix", "h01_rule_score",
    "h07_fleet_kpis", "h10_diagnosis", "i04_precision_recall", "i05_average_precision", "i10_threshold_sweep",
    "i11_cost_sweep", "j01_ks_drift", "j02_degradation", "j03_attributions", "k01_replay_scores", "l01_chunk_fixed",
    "l03_similarity_search", "l05_risk_protocols",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus, **{"spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("q01_failure_rate")  # start-up is not a query's time
    times = {name: round(run(name), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
