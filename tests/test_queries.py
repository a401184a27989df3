"""Every query against its SQL twin, and the large-input plans against the small ones."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry
from perfwatch import session
from perfwatch.operators import ordering
from perfwatch.plans.catalog import oracles as oracle_sql
from perfwatch.plans.catalog import learning, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def ordered(rows, names):
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in place) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf, duck, name, monkeypatch):
    # rows and ranges do not depend on the size of an ensemble; tests fit small ones
    monkeypatch.setattr(learning, "SIZES", {"random_forest": 4, "hist_gradient_boosting": 3})
    df = queries()[name](spark, sf)
    want = duck.execute(oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.collect(), df.columns) == ordered(want.fetchall(), names)


@pytest.mark.parametrize("name", [
    "w5_lags", "w8_chronological_split", "l2_train_thresholds", "l3_anomaly_flags", "e3_roc_auc", "ml11_metrics_table",
    "s2_batch_slice", "s10_seeded_sample", "r6_risk_windows", "r16_incident_log", "r14_service_risk", "w10_running_step",
    "a8_state_from_long", "w1_difference", "w7_complete_rows", "l4_label_summary", "ml1_median_imputation",
])
def test_large_input_plans_give_the_same(spark, sf, duck, name, monkeypatch):
    """Groups over a few rows are split and reused frames are stored."""
    monkeypatch.setattr(session, "STAGE_BYTES", 0)
    monkeypatch.setattr(ordering, "GROUP_LIMIT", 10)
    test_query_matches_sql(spark, sf, duck, name, monkeypatch)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "target_p95_latency_t_plus_1" in df.columns and "p95_latency_lag_3" in df.columns


def test_every_query_is_named_after_an_inventory_row():
    for name in queries():
        head = name.split("_")[0]
        assert head.rstrip("0123456789") in {"s", "k", "p", "a", "w", "l", "j", "u", "o", "m", "ml", "e", "r", "v"}
    assert set(oracle_sql()) <= set(queries())
