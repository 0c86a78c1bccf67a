"""Scale invariants: no driver collects in library code, filters reach the scan, bounded
broadcasts, group limits before shuffles."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from __spark_entry__ import queries

SMOKE = "/root/testdata/sf0.001"
PKG = Path(__file__).resolve().parents[1] / "tessera"

# The only place that brings anything but scalars to the driver: k model centres.
ALLOWED = {("operators/models.py", "model.clusterCenters()")}
#: Results whose size is a parameter: a row for each pair of features; a block of queries.
BOUNDED = {("operators/moments.py", "rows = table.collect()"), ("operators/neighbours.py", "some = asked.where(")}


def test_no_collect_or_topandas_in_library():
    offenders = []
    for path in PKG.rglob("*.py"):
        rel = str(path.relative_to(PKG))
        if rel.startswith("llm/"):  # held to its own list by its own tests
            continue
        for line in path.read_text().splitlines():
            code = line.split("#")[0]
            if any(rel == a and code.strip().startswith(b) for a, b in BOUNDED):
                continue
            if re.search(r"\.(collect|toPandas|toArrow|collectAsMap|toLocalIterator)\(", code):
                offenders.append((rel, line.strip()))
            if ".rdd." in code and not any(rel == a and b in code for a, b in ALLOWED):
                offenders.append((rel, line.strip()))
    assert offenders == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_reaches_both_scans(spark):
    df = queries()["top_rated_for_key"](spark, SMOKE)
    plan = _plan(df)
    assert "EqualTo(o_custkey,78)" in plan and "EqualTo(c_custkey,78)" in plan
    assert "TakeOrderedAndProject" in plan


def test_projection_is_pruned(spark):
    plan = _plan(queries()["value_summary"](spark, SMOKE))
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_lookup_streams_the_part_table(spark):
    plan = _plan(queries()["lookup_key"](spark, SMOKE))
    assert "BroadcastHashJoin" in plan and "EqualTo(l_orderkey,78)" in plan


def test_top_k_per_group_limits_before_shuffle(spark):
    plan = _plan(queries()["top_k_per_group"](spark, SMOKE))
    assert "WindowGroupLimit" in plan


def test_term_frequency_combines_map_side(spark):
    plan = _plan(queries()["term_frequency"](spark, SMOKE))
    assert plan.count("HashAggregate") >= 2


def test_dealt_scan_keeps_pushdown(spark):
    from tessera.sources.tables import SCAN_PARTITIONS, load

    spark.conf.set(SCAN_PARTITIONS, "4")
    try:
        df = load(spark, SMOKE, "documents").where(F.col("lang") == "en").select("doc_id")
    finally:
        spark.conf.unset(SCAN_PARTITIONS)
    plan = _plan(df)
    assert "EqualTo(lang,en)" in plan and "hashpartitioning" in plan
    assert "n_chars" not in plan.split("ReadSchema")[1]
    assert "Exchange" not in _plan(load(spark, SMOKE, "lineitem").select("l_orderkey"))


def test_holdout_limits_ranks_before_the_shuffle(spark):
    plan = _plan(queries()["holdout_per_user"](spark, SMOKE))
    assert "WindowGroupLimit" in plan


def test_median_sorts_only_a_bracket(spark):
    df = queries()["median_value"](spark, SMOKE)
    plan = _plan(df)
    assert "Python" not in plan and "Pandas" not in plan and "rangepartitioning" not in plan


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    for name in ("standardize", "linreg_simple", "kmeans_assign", "als_factors"):
        queries()[name](spark, SMOKE).collect()
        assert "InMemoryTableScan" not in _plan(queries()[name](spark, SMOKE))
