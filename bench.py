"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and three times for the median. Results go to
the ``noop`` sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perfwatch.plans import catalog, inputs, preprocessing  # noqa: E402
from perfwatch.session import build_session  # noqa: E402

HEADLINE = [
    "a1_row_quantiles", "a5_resource_aggregates", "a8_state_from_long", "w1_difference", "w4_rolling_std", "w5_lags",
    "w7_complete_rows", "w8_chronological_split", "l2_train_thresholds", "l3_anomaly_flags", "l4_label_summary",
    "s10_seeded_sample", "m2_files_index", "m3_samples_index", "e1_regression_metrics", "e2_classification_metrics",
    "e3_roc_auc", "r2_prediction_summary", "r6_risk_windows", "r7_kpi_row", "r8_realtime_series", "r13_graph_degree",
    "r14_service_risk", "r16_incident_log", "r21_incident_trend", "r24_source_health",
]
TEN_MINUTES = 600_000_000


def predictive_ten_minutes(spark, sf_dir):
    """The whole predictive dataset over 10-minute windows (21,600 rows at sf0.1)."""
    telemetry, layout = inputs.telemetry(spark, sf_dir, TEN_MINUTES, stored=True)
    return preprocessing.predictive(telemetry, layout)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()
    chosen = {name: known[name] for name in HEADLINE} | {"predictive_10min": predictive_ten_minutes}
    if len(sys.argv) > 1:
        chosen = {n: q for n, q in chosen.items() if n.startswith(tuple(sys.argv[1:]))}
    times = {}
    for name, build in chosen.items():
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 4)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
