from pyspark.sql import functions as F

from lodestrata.plans import reviews as R

ZERO = {n: 0 for n in [*R.COMPONENT_COUNTS, *R.EDGE_COUNTS, *R.FLOW_COUNTS, *R.MODULE_COUNTS, *R.CAPABILITY_COUNTS, "layer_violations", "known_layers", "deployables", "modules", "modules_without_source", "steps", "missing_steps", "risks", "risks_without_component", "risks_without_module", "dangling"]}
CHECKED = {*range(1, 26)} - {10}
COUNTED = dict(jobs=1, known_layers=1, edges=1, module_candidates=2, candidates=1, early=1)


def review(spark, **counts):
    rows = R.reviewed(spark.createDataFrame([{**ZERO, **counts}]).withColumn("layers", F.lit("Domain=1"))).collect()
    return {r["number"]: r for r in rows}


def test_good_counts_pass_and_constants_are_not_checked(spark):
    got = review(spark, **COUNTED, deployables=1, flows=3, strategies=1, repositories=1, frontend_routes=1, modules=2, unknown=1)
    assert sorted(got) == list(range(1, 33))
    assert {k for k, r in got.items() if r["status"] == "PASS"} == CHECKED and {r["status"] for k, r in got.items() if k not in CHECKED} == {"NOT_CHECKED"}
    assert {r["acceptance"] for r in got.values()} == {"PASS"} and got[1]["evidence"] == "1 deployable units detected." and got[9]["evidence"] == "Detected layers: Domain=1"
    assert got[1]["gap"] == "None." and got[1]["action"] == "No fix needed."


def test_bad_counts_fail_or_are_partial(spark):
    bad = review(spark, major_unknown=1, missing_file=1, modules_without_source=1, risks_without_module=1, missing_to=1, missing_steps=2, partial_flows=1)
    assert {k for k, r in bad.items() if r["status"] == "FAIL"} == {1, 18, 20}
    assert {k for k, r in bad.items() if r["status"] == "PARTIAL"} == {2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, 16, 17, 19, 21, 22, 23, 24, 25}
    assert {r["acceptance"] for r in bad.values()} == {"FAIL"} and bad[1]["action"] == "Review system inventory evidence."
    some = review(spark, **COUNTED, deployables=1, flows=3, strategies=1, repositories=1, frontend_routes=1, modules=2, unknown=1, partial_flows=1)
    assert {r["acceptance"] for r in some.values()} == {"PASS WITH PARTIALS"}
