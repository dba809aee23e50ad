"""Registered queries against their SQL.  TEST_ALL=1 runs every key; the default covers each area once or more."""

from __future__ import annotations

import os

import pytest
from compare import compare

from bureaulake import queries as registry

# Keys whose result is empty or trivial on the smallest tables still have to agree.
DEFAULT = """
decision_package decision_inference payment_metrics enquiry_merge diversity_counts default_flag targets feature_provenance
alias_normalize latest_element flatten_report jsonl_partial request_ids batch_applicants model_subset route_messages path_metadata
imputation_params impute_training live_contract gold_features final_decision rules_whatif collect_predictions audit_append
audit_lookup fraud_flags top_contributions profile_missing profile_distribution text_patterns date_formats schema_detect resamples
split_stratified quality_report pii_columns pii_tokenize pii_text_scan internal_schema_check psi drift_verdict trailing_7d
fairness_report binary_metrics multiclass_auc metric_gate champion_snapshot latest_mapping artifact_reuse checksum_compare
training_completion ops_rollup scan_csv scan_jsonl jsonl_lines sink_silver stream_dedup stream_collect stream_daily stream_audit
zscore_outliers profile_examples sample_stats profile_merged error_codes validate_training validate_inference scan_dispatch stream_late stream_drift
""".split()
KEYS = sorted(registry.oracle_sql()) if os.environ.get("TEST_ALL") else DEFAULT


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, duck, sf_dir, key):
    text, _, _ = compare(spark, duck, key, registry.queries()[key], registry.oracle_sql()[key], sf_dir)
    assert text.startswith("ok") and "TYPES" not in text, text


def test_registry_needs_no_session():
    """Keys can be listed before a session exists, and every oracle belongs to a query."""
    import subprocess
    import sys

    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 150"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = registry.queries()["decision_package"]
    try:
        found = []
        for partitions in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append(sorted(map(tuple, query(spark, sf_dir).collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_results_do_not_depend_on_session_zone(spark, sf_dir, duck):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for key in ("enquiry_counts", "stream_daily", "parse_dates"):
            text, _, _ = compare(spark, duck, key, registry.queries()[key], registry.oracle_sql()[key], sf_dir)
            assert text.startswith("ok"), (key, text)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
