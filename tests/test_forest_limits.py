"""What fits and predictions hold at once: statistics of a pass, rows of side-by-side fits, nodes sent to tasks."""

from pyspark.sql import functions as F

from wearline.operators import model, trees
from wearline.plans import study

FEATURES = ("a", "b")
SETTINGS = {"numTrees": 5, "maxDepth": 6, "minInstancesPerNode": 2}


def test_less_memory_and_remembered_nodes_leave_the_forest_as_it_is(spark, tmp_path):
    draw = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 10.0 for k in range(3)]
    rows = spark.range(0, 4_000, 1, 4).select(draw[0].alias("a"), draw[1].alias("b"), (draw[0] + draw[2]).alias("rul"))
    found = []
    for k, other in enumerate(({}, {"maxMemoryInMB": 2048, "cacheNodeIds": False})):
        forest = model.train_rul(rows, FEATURES, **SETTINGS, **other)
        if not other:
            # Two tasks of an executor hold one each; its heap can be 1,800 MB.
            assert forest.getOrDefault("maxMemoryInMB") <= 512 and forest.getOrDefault("cacheNodeIds")
        forest.write().save(str(tmp_path / str(k)))
        nodes = trees.node_table(spark.read.parquet(str(tmp_path / str(k) / "data")), 0)
        shown = nodes.select("node", "feature", "left", "right", F.round("threshold", 9), F.round("prediction", 9))
        found.append(sorted(map(str, shown.collect())))
    assert len(found[0]) > 100 and found[0] == found[1]


def test_nodes_of_large_forests_are_not_sent_one_by_one(spark):
    """Sent as rows, 1.7 million nodes were more than a driver of 750 MB heap could build."""
    many = spark.range(300_000).selectExpr("0 forest", "int(id % 7) tree", "id node", "0 feature", "0.5D threshold")
    many = many.selectExpr("*", "node left", "node right", "1.0D prediction", "0.0D weighted_gain")
    rows = spark.createDataFrame([("x", 1, 1, 0.5, 2.0)], "dataset_id string, engine_id int, cycle int, a double, rul double")
    forests = spark.createDataFrame([("x", 0)], "dataset_id string, forest int")
    plan = trees.predict(rows, forests, many, 7, 4, ("a",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


def test_large_fits_run_one_after_another():
    assert [study.fits_at_once(n, 4) for n in (0, 20_000, 250_000, 400_000, 1_200_000)] == [4, 4, 4, 2, 1]
