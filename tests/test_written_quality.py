"""Checks counted by the writes themselves, and the bounded display sample."""

import hashlib

from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import model, quality
from wearline.plans import queries as Q

SMALL = "/root/testdata/sf0.001"


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_the_write_counts_and_nothing_is_read_again(spark, folder):
    tables = Q.tables(spark, SMALL)
    (root, reports), jobs = jobs_of(spark, "write", lambda: tables.write_gold_checked(folder))
    assert jobs > 0 and {r.model for r in reports} == {"health", "features", "drift"}
    shown, more = jobs_of(spark, "report", lambda: [r.table(spark) for r in reports])
    assert more == 0
    found = {tuple(r) for table in shown for r in table.collect()}
    wanted = {tuple(r) for r in Q.quality_report(spark, SMALL).filter("model <> 'staging'").collect()}
    assert found == wanted and len(found) == 15


def test_failures_are_counted_in_the_plan_of_the_write(spark, make_readings, folder):
    rows = make_readings([{"cycle": None}, {"cycle": 2}, {"engine_id": None, "cycle": 3}])
    marked = rows.withColumn("status", F.when(F.col("cycle") == 2, S.VALID).when(F.col("cycle") == 3, "odd").otherwise(S.VALID))
    checked, report = quality.observed(marked, "staging", quality.STAGING_CHECKS, quality.staging_view())
    assert "CollectMetrics" in checked._jdf.queryExecution().executedPlan().toString()
    checked.write.parquet(f"{folder}/t")
    found = {(r["column_name"], r["check_kind"]): r["failures"] for r in report.table(spark).collect()}
    plain = {(r["column_name"], r["check_kind"]): r["failures"] for r in quality.check_staging(marked).collect()}
    assert found == plain == {
        ("engine_id", "not_null"): 0, ("cycle", "not_null"): 1, ("status", "not_null"): 0, ("status", "accepted_values"): 1,
    }


def test_an_empty_table_has_no_failures(spark, make_readings, folder):
    none = make_readings([{"cycle": 1}]).filter("cycle > 1").withColumn("status", F.lit("valid"))
    checked, report = quality.observed(none, "staging", quality.STAGING_CHECKS)
    checked.write.parquet(f"{folder}/t")
    assert {r["failures"] for r in report.table(spark).collect()} == {0}


def test_sample_is_the_same_however_rows_lie(spark):
    rows = [("a" if e % 3 else None, e, c, float(e * c)) for e in range(20) for c in range(30)] + [("b", 1, 1, 2.0)] * 3
    df = spark.createDataFrame(rows, "dataset_id string, engine_id int, cycle int, x double")
    wanted = {}
    for row in rows:
        name = "|".join("-" if v is None else str(v) for v in row[:3])
        wanted.setdefault(row[0], []).append((hashlib.md5(name.encode()).hexdigest(), *row[1:]))
    wanted = sorted((str(d), *r[1:]) for d, found in wanted.items() for r in sorted(found)[:7])
    for parts in (1, 5, 13):
        found = model.display_sample(df.repartition(parts, "x"), 7).collect()
        assert sorted((str(r[0]), *r[1:]) for r in found) == wanted
    plan = model.display_sample(df.repartition(5), 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert model.display_sample(df.limit(0), 7).isEmpty()
