"""Fitted forests as a table of nodes, and prediction for all of them in one plan.

A node is one row: where it asks, what it asks, and which nodes come next. A leaf
leads to itself, so every reading goes the same number of steps through each tree
of its forest, and each step is a lookup of a node by one 64-bit number. Forests
of many datasets lie in one table; nothing is fitted or held per dataset when
predicting.

The table has at most ``trees * 2**(depth + 1)`` rows a forest. Up to
``SENT_NODES`` rows it is sent to the tasks, once for all steps, and readings do
not move before their mean. Beyond that a tree becomes one row of arrays, which
take less than half the room: a reading meets each of its trees in one join and
goes all steps inside that row. Up to ``PACKED`` times ``SENT_NODES`` nodes these
rows are sent too; with still more nodes that one join moves the readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline import schema as S

SENT_NODES = 250_000  # a sent node takes about 100 bytes, in the driver too
PACKED = 16  # so many times more nodes are sent as arrays: 28 bytes a node
NODE_SCHEMA = (
    "forest int, tree int, node long, feature int, threshold double, left long, right long,"
    " prediction double, weighted_gain double"
)
TREE_BITS, NODE_BITS = 12, 31  # a forest has fewer than 4,096 trees, a tree fewer than 2**31 nodes


def _root(forest, tree):
    return F.shiftleft(F.shiftleft(forest.cast("long"), TREE_BITS) + tree, NODE_BITS)


def node_table(saved: DataFrame, forest: int) -> DataFrame:
    """Nodes of a saved forest (the ``data`` folder that Spark ML writes), numbered across forests."""
    node, split = F.col("nodeData"), F.col("nodeData.split")
    root = _root(F.lit(forest), F.col("treeID"))
    leaf = node["leftChild"] < 0
    own = root + node["id"]
    return saved.select(
        F.lit(forest).alias("forest"),
        F.col("treeID").alias("tree"),
        own.alias("node"),
        F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(leaf, own).otherwise(root + node["leftChild"]).alias("left"),
        F.when(leaf, own).otherwise(root + node["rightChild"]).alias("right"),
        node["prediction"].alias("prediction"),
        (node["gain"] * F.get(node["impurityStats"], F.lit(0))).alias("weighted_gain"),
    )


def predict(
    rows: DataFrame,
    forests: DataFrame,
    nodes: DataFrame,
    trees: int,
    depth: int,
    features: Sequence[str] = S.FEATURES,
    label: str = "rul",
    sent_nodes: int = SENT_NODES,
) -> DataFrame:
    """Actual and predicted values of every row whose dataset has a forest.

    ``forests`` gives the number of a dataset's forest (``dataset_id``, ``forest``).
    """
    shown = [*S.KEY, "cycle", F.col(label).cast("double").alias("label")]
    numbered = rows.select(
        F.monotonically_increasing_id().alias("__row"), *shown, F.array(*features).alias("__x")
    ).join(forests, "dataset_id")
    kept = ["__row", *S.KEY, "cycle", "label"]
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    places = numbered.select(*kept, "__x", "forest", tree.alias("__tree"))
    known = nodes.count()
    if known <= sent_nodes:
        leaves = _leaves_by_node(places, nodes, depth, kept)
    else:
        leaves = _leaves_by_tree(places, nodes, depth, kept, known <= PACKED * sent_nodes)
    return leaves.groupBy(*kept).agg(F.avg("__leaf").alias("prediction")).drop("__row")


def _leaves_by_node(places: DataFrame, nodes: DataFrame, depth: int, kept: Sequence[str]) -> DataFrame:
    """The leaf's value for each reading and tree: every step looks up a sent node."""
    steps = nodes.select(F.col("node").alias("__at"), "feature", "threshold", "left", "right", F.col("prediction").alias("__leaf"))
    steps = F.broadcast(steps)
    places = places.select(*kept, "__x", _root(F.col("forest"), F.col("__tree")).alias("__node"))
    goes_left = F.get("__x", F.col("feature")) <= F.col("threshold")
    for _ in range(depth):
        found = places.join(steps, F.col("__node") == F.col("__at"))
        places = found.select(*kept, "__x", F.when(goes_left, F.col("left")).otherwise(F.col("right")).alias("__node"))
    return places.join(steps, F.col("__node") == F.col("__at"))


def packed_trees(nodes: DataFrame) -> DataFrame:
    """One row per tree: an array per field, in the order of node numbers, which lead to places in the arrays."""
    within = 1 << NODE_BITS
    fields = {
        "feature": F.col("feature"),
        "threshold": F.col("threshold"),
        "left": (F.col("left") % within).cast("int"),
        "right": (F.col("right") % within).cast("int"),
        "leaf": F.col("prediction"),
    }
    node = F.struct("node", *(c.alias(name) for name, c in fields.items()))
    whole = nodes.groupBy("forest", "tree").agg(F.array_sort(F.collect_list(node)).alias("n"))
    return whole.select(
        F.col("forest").alias("__forest"), "tree", *(F.col(f"n.{name}").alias(f"__{name}") for name in fields)
    )


def _leaves_by_tree(
    places: DataFrame, nodes: DataFrame, depth: int, kept: Sequence[str], sent: bool
) -> DataFrame:
    """The leaf's value for each reading and tree: one join, and all steps inside the tree's row."""
    whole = packed_trees(nodes)
    whole = F.broadcast(whole) if sent else whole
    found = places.join(whole, (F.col("forest") == F.col("__forest")) & (F.col("__tree") == F.col("tree")))
    arrays = ("__feature", "__threshold", "__left", "__right", "__leaf")
    found = found.select(*kept, "__x", *arrays, F.lit(0).alias("__at"))
    at = F.col("__at")
    goes_left = F.get("__x", F.get("__feature", at)) <= F.get("__threshold", at)
    for _ in range(depth):
        found = found.withColumn("__at", F.when(goes_left, F.get("__left", at)).otherwise(F.get("__right", at)))
    return found.select(*kept, F.get("__leaf", at).alias("__leaf"))


def importance(forests: DataFrame, nodes: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Impurity importances, largest first: gains per feature, each tree and then each forest summing to one."""
    gains = nodes.filter(F.col("feature").isNotNull()).groupBy("forest", "tree", "feature")
    gains = gains.agg(F.sum("weighted_gain").alias("gain"))
    trees = gains.groupBy("forest", "tree").agg(F.sum("gain").alias("whole"))
    shares = gains.join(trees, ["forest", "tree"]).groupBy("forest", "feature")
    shares = shares.agg(F.sum(F.try_divide(F.col("gain"), F.col("whole"))).alias("share"))
    total = shares.groupBy("forest").agg(F.sum("share").alias("total"))
    names = F.posexplode(F.array(*map(F.lit, features))).alias("feature", "name")
    every = forests.select("dataset_id", "forest", names)
    found = every.join(shares.join(total, "forest"), ["forest", "feature"], "left")
    weight = F.coalesce(F.try_divide(F.col("share"), F.col("total")), F.lit(0.0))
    table = found.select("dataset_id", F.col("name").alias("feature"), weight.alias("importance"))
    return table.orderBy("dataset_id", F.col("importance").desc(), "feature")
