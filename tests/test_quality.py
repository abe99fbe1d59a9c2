"""Declared checks."""

from wearline.operators import quality
from wearline.plans.medallion import build_silver


def failures(report):
    return {(r["column_name"], r["check_kind"]): r["failures"] for r in report.collect()}


def test_declared_checks():
    checks = [
        *quality.STAGING_CHECKS, *quality.HEALTH_CHECKS,
        *quality.FEATURE_CHECKS, *quality.DRIFT_CHECKS,
    ]
    kinds = [c.kind for c in checks]
    assert (kinds.count("not_null"), kinds.count("accepted_values")) == (17, 2)


def test_counts_per_check(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", None), (None, None)], "kind string, n int"
    )
    rules = [quality.Check("kind"), quality.Check("n"), quality.Check("kind", ("a",))]
    assert failures(quality.run_checks(df, "m", rules)) == {
        ("kind", "not_null"): 1,
        ("n", "not_null"): 2,
        ("kind", "accepted_values"): 1,
    }


def test_empty_table_has_no_failures(spark):
    df = spark.createDataFrame([], "kind string")
    assert failures(quality.run_checks(df, "m", [quality.Check("kind")])) == {("kind", "not_null"): 0}


def test_staging_ids_are_checked_on_valid_rows(make_readings):
    silver = build_silver(make_readings([{}, {"engine_id": None}]))
    assert failures(quality.check_staging(silver))["engine_id", "not_null"] == 0
    assert failures(quality.check_staging(silver, strict=True))["engine_id", "not_null"] == 1


def test_remaining_life_must_fall(spark, series, silver):
    good = silver(series([1.0] * 5))
    assert tuple(quality.rul_violations(good).first())[2:] == (5, 0)
    stuck = good.withColumn("rul", good["max_cycle"] * 0 + 3)
    assert quality.rul_violations(stuck).first()["violations"] == 4
