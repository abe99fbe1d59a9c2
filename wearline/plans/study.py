"""The remaining-life study over written layers: features, split, scaling, forest."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline import schema as S
from wearline.operators import model, scaling, split, trees
from wearline.plans.medallion import Medallion
from wearline.workspace import new_folder, settle
from wearline.sources import layers


# Rows that fits may hold at once: each takes about 1.6 KB of the executors while its forest grows.
HELD_ROWS = 1_000_000


def fits_at_once(rows: int, parallelism: int) -> int:
    """How many forests to fit side by side, if the largest learns from so many rows."""
    return max(1, min(parallelism, HELD_ROWS // max(1, rows)))


class Study:
    """Tables and models of one input.

    The small tables (cuts, scalers) are written once, so lookups know their
    size. Row tables stay lazy until the forest needs them.
    """

    def __init__(
        self,
        tables: Medallion,
        digits: tuple[int, int, int] | None = S.FEATURE_DIGITS["model"],
        rul_cap: int | None = S.RUL_CAP,
        fraction: float = 0.8,
        features: Sequence[str] = S.FEATURES,
        forest: dict | None = None,
        parallelism: int = 4,
    ):
        self.tables = tables
        self.digits = digits
        self.rul_cap = rul_cap
        self.fraction = fraction
        self.features = tuple(features)
        self.forest = forest or {}
        self.parallelism = parallelism

    @cached_property
    def cuts(self) -> DataFrame:
        return settle(split.split_cuts(self.tables.valid, self.fraction), "cuts")

    def _stored(self, rows: DataFrame, name: str) -> DataFrame:
        """A row table written by dataset, so that later readers prune to their own part."""
        path = new_folder(self.tables.spark, name)
        layers.overwrite_layer(rows, path)
        return layers.read_layer(self.tables.spark, path, rows.schema)

    @cached_property
    def feature_rows(self) -> DataFrame:
        """Complete feature rows of all datasets with condition and split.

        Written once: the scalers, the scaled rows and the reports all read it,
        and none of them repeats the windows. Rows lie in engine order, so
        ``is_train`` is clustered too and a filter on it skips row groups.
        """
        table = self.tables.ml_features(digits=self.digits, rul_cap=self.rul_cap)
        rows = scaling.complete_rows(table, self.features)
        marked = split.mark_split(scaling.with_op_condition(rows), self.cuts)
        return self._stored(marked, "features")

    @property
    def train(self) -> DataFrame:
        return self.feature_rows.filter("is_train")

    @property
    def test(self) -> DataFrame:
        return self.feature_rows.filter("NOT is_train")

    @cached_property
    def scaler(self) -> DataFrame:
        return settle(scaling.fit_scaler(self.train, self.features), "scaler")

    @cached_property
    def fallback(self) -> DataFrame:
        return settle(scaling.fit_fallback(self.scaler, self.features), "fallback")

    @cached_property
    def global_scaler(self) -> DataFrame:
        fitted = scaling.fit_scaler(self.train, self.features, by=scaling.BY_DATASET)
        return settle(fitted, "global-scaler")

    @property
    def scaled(self) -> DataFrame:
        """Feature rows scaled per condition, with the fallback for unseen ones."""
        return scaling.apply_scaler(
            self.feature_rows, self.scaler, self.features, fallback=self.fallback
        )

    @property
    def scaled_globally(self) -> DataFrame:
        return scaling.apply_scaler(
            self.feature_rows, self.global_scaler, self.features, by=scaling.BY_DATASET
        )

    @cached_property
    def scaled_table(self) -> DataFrame:
        """Scaled rows as a table: each fit scans only its own dataset."""
        return self._stored(self.scaled, "scaled")

    @cached_property
    def datasets(self) -> list[str]:
        """Datasets with train engines, from the cut table (one row per dataset)."""
        rows = self.cuts.filter(F.col("last_train").isNotNull()).orderBy("dataset_id")
        return [row["dataset_id"] for row in rows.select("dataset_id").collect()]

    def _part(self, dataset: str, is_train: bool) -> DataFrame:
        return self.scaled_table.filter(
            (F.col("dataset_id") == dataset) & (F.col("is_train") == is_train)
        )

    @cached_property
    def forests(self) -> DataFrame:
        """The number of each dataset's forest, for datasets with train engines."""
        rows = list(zip(self.datasets, range(len(self.datasets))))
        return settle(self.tables.spark.createDataFrame(rows, "dataset_id string, forest int"), "forests")

    @cached_property
    def nodes(self) -> DataFrame:
        """The fitted trees of all datasets as one table (see ``operators.trees``).

        Each fit is distributed and a few run side by side, large ones one after
        another; a fitted forest is written to the shared folder and let go.
        """
        spark, folder = self.tables.spark, new_folder(self.tables.spark, "forests")
        # The scaled table is written before the fits share it.
        sizes = self.scaled_table.filter("is_train").groupBy("dataset_id").count()
        most = sizes.agg(F.max("count")).first()[0] or 0

        def fit(number: int, dataset: str) -> DataFrame:
            forest = model.train_rul(self._part(dataset, True), self.features, **self.forest)
            forest.write().save(f"{folder}/{number}")
            return trees.node_table(spark.read.parquet(f"{folder}/{number}/data"), number)

        with ThreadPoolExecutor(fits_at_once(most, self.parallelism)) as pool:
            found = list(pool.map(fit, range(len(self.datasets)), self.datasets))
        none = spark.createDataFrame([], trees.NODE_SCHEMA)
        return settle(layers.union_datasets(none, *found), "nodes")

    @property
    def predictions(self) -> DataFrame:
        """Actual and predicted life of the test rows of every dataset, in one plan."""
        settings = {**model.FOREST, **self.forest}
        return trees.predict(
            self.scaled_table.filter("NOT is_train"), self.forests, self.nodes,
            settings["numTrees"], settings["maxDepth"], self.features,
        )

    @property
    def results(self) -> DataFrame:
        return model.evaluate(self.predictions)

    @property
    def importance(self) -> DataFrame:
        return trees.importance(self.forests, self.nodes, self.features)
