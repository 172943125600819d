"""Registered queries against their check SQL on the smallest tables; the quick ones and a few of the others; WAYMARK_ALL=1 runs every one."""

import os

import pytest

from check import DATA, compare, connect
from waymark.queries import MODULES, ORACLES, QUERIES, load_all

load_all()
SF_DIR = f"{DATA}/sf0.001"
SHORT = [
    "eph_by_country", "eph_weighted", "metric_levels", "extrapolated_rates", "threshold_sweep", "calibration_table",
    "reuse_known_routes", "merge_metadata", "sanity_checks", "dedup_rounded_stretch", "time_split_train", "tile_sample", "route_hausdorff",
    "route_mutual_containment", "tile_codes", "stretch_turn_features", "trace_features", "lane_enrichment", "edge_runs", "feature_weights", "matched_features", "matching_balance",
    "published_metrics_view", "lines_in_region", "relations_by_way",
]
# The relational queries are quick: all of them run.
QUICK = [n for n in ORACLES if MODULES[n].endswith("relational") and n not in SHORT]
NAMES = list(ORACLES) if os.environ.get("WAYMARK_ALL") else SHORT + QUICK


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 150


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_check_sql(spark, name):
    message, _ = compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name])
    assert message == ""


# Queries that SQL can't check have rows at least; these fit many models and run with the others only.
SLOW = {"classifier_calibrated", "classifier_scores"}
REST = [n for n in QUERIES if n not in ORACLES and (os.environ.get("WAYMARK_ALL") or n not in SLOW)]


@pytest.mark.parametrize("name", REST)
def test_query_without_check_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()
