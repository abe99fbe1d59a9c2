"""Forests as node tables: the same predictions and importances as the fitted models."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from wearline.operators import model, trees

FEATURES = ("a", "b", "c")
SETTINGS = {"numTrees": 7, "maxDepth": 4, "minInstancesPerNode": 2}


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    """Two forests, their stored trees, and rows of three datasets (one without a forest)."""
    rng = np.random.default_rng(1)
    rows = [
        (d, int(e), int(c), *rng.normal(size=3).round(2).tolist(), float(rng.integers(0, 90)))
        for d in ("x", "y", "z") for e in range(6) for c in range(40)
    ]
    rows += rows[:5] + [("x", 1, 99, float("nan"), 1e300, -0.0, 3.0)]
    df = spark.createDataFrame(rows, "dataset_id string, engine_id int, cycle int, a double, b double, c double, rul double")
    models, parts = {}, []
    for number, name in enumerate(("x", "y")):
        train = df.filter((df.dataset_id == name) & (df.cycle < 99))
        models[name] = model.train_rul(train.withColumn("rul", train.rul + 9 * train.a), FEATURES, **SETTINGS)
        folder = str(tmp_path_factory.mktemp("forest") / name)
        models[name].write().save(folder)
        parts.append(trees.node_table(spark.read.parquet(f"{folder}/data"), number))
    forests = spark.createDataFrame([("x", 0), ("y", 1)], "dataset_id string, forest int")
    return df, models, forests, parts[0].union(parts[1]).cache()


@pytest.mark.parametrize("sent", [trees.SENT_NODES, 0])
def test_predictions_equal_the_models(fitted, sent):
    df, models, forests, nodes = fitted
    wanted = []
    for name, forest in models.items():
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
        shown = forest.transform(vectors.transform(df.filter(df.dataset_id == name)))
        wanted += [tuple(r) for r in shown.select("dataset_id", "engine_id", "cycle", "rul", "prediction").collect()]
    found = trees.predict(df, forests, nodes, SETTINGS["numTrees"], SETTINGS["maxDepth"], FEATURES, sent_nodes=sent)
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(wanted) == 2 * 240 + 6
    for one, other in zip(sorted(found), sorted(wanted)):
        assert one[:4] == other[:4] and one[4] == pytest.approx(other[4], rel=1e-12)


def test_importances_equal_the_models(fitted):
    _, models, forests, nodes = fitted
    found = {(r[0], r[1]): r[2] for r in trees.importance(forests, nodes, FEATURES).collect()}
    for name, forest in models.items():
        for feature, weight in zip(FEATURES, forest.featureImportances.toArray()):
            assert found[name, feature] == pytest.approx(weight, rel=1e-9)


def test_a_tree_of_one_leaf_and_no_forests(spark, fitted, tmp_path):
    df, _, forests, nodes = fitted
    flat = model.train_rul(df.filter("dataset_id = 'z'").withColumn("rul", df.a * 0 + 4.0), FEATURES, **SETTINGS)
    flat.write().save(str(tmp_path / "z"))
    leaf = trees.node_table(spark.read.parquet(str(tmp_path / "z" / "data")), 5)
    only = spark.createDataFrame([("z", 5)], "dataset_id string, forest int")
    found = trees.predict(df, only, leaf, SETTINGS["numTrees"], 4, FEATURES).collect()
    assert len(found) == 240 and {r["prediction"] for r in found} == {4.0}
    assert {r["importance"] for r in trees.importance(only, leaf, FEATURES).collect()} == {0.0}
    none = spark.createDataFrame([], trees.NODE_SCHEMA)
    assert trees.predict(df, forests.limit(0), none, 7, 4, FEATURES).isEmpty()


def test_one_plan_for_all_datasets(fitted):
    df, _, forests, nodes = fitted
    plan = trees.predict(df, forests, nodes, 7, 4, FEATURES)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan.split("InMemory")[0] and plan.count("BroadcastHashJoin") >= 5


def test_more_nodes_than_are_sent_need_one_join_for_all_steps(fitted):
    """Whole trees as rows: the same predictions, sent or joined, and readings move once at most for their trees."""
    df, _, forests, nodes = fitted
    df = df.union(df.limit(3).selectExpr("dataset_id", "engine_id", "777 cycle", "CAST(NULL AS DOUBLE) a", "b", "c", "rul"))

    def found(sent):
        return trees.predict(df, forests, nodes, 7, 4, FEATURES, sent_nodes=sent)

    wanted = sorted(map(str, (tuple(r) for r in found(trees.SENT_NODES).select("*").collect())))
    for sent in (nodes.count() - 1, 0):
        assert sorted(map(str, (tuple(r) for r in found(sent).collect()))) == wanted
        plan = found(sent)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 2  # with the forests' numbers, and with the trees
    sizes = {(r["__forest"], r["tree"]): len(r["__leaf"]) for r in trees.packed_trees(nodes).collect()}
    assert sizes == {(r["forest"], r["tree"]): r["count"] for r in nodes.groupBy("forest", "tree").count().collect()}
