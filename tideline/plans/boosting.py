"""Gradient boosting on the pinball loss: trees of MLlib on the loss's sign gradient, with exact quantiles in their leaves.

A round fits one regression tree to the gradient at the present bounds, level - [y < bound], of all levels together: rows stand
once for each level, and the level is a category that the tree may split on. The tree only divides the rows; the value of a
leaf is, for each level, the weighted quantile of the residuals that fell into it, from one selection over (leaf, level). Weights
are rounded to whole numbers, so the values are the same in any order of rows.

Each round's rows are kept in memory and on disk, with the leaves that they fell into, and those of the round before given back;
every WRITTEN rounds they are written, so that no lineage grows beyond that, and the files before them removed. The driver holds
trees and leaf values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import LIMIT, weighted_quantiles
from ..operators.tables import remove, shared, written

WHOLE = 1 << 16  # weights are counted in this part of one
WRITTEN = 8  # rounds from one writing of the rows to the next


class PinballTrees:
    """Bounds at several levels: the sum of `rate` times the leaves that a row falls into, on top of each level's quantile of all rows."""

    def __init__(self, levels: Sequence[float], trees: int, rate: float, depth: int, least: int = 50, seed: int = 7):
        self.levels, self.trees, self.rate, self.depth, self.least, self.seed = tuple(levels), trees, rate, depth, least, seed

    def _assembled(self, rows: DataFrame, x: str, level: Column, out: str) -> DataFrame:
        """x with the level behind it, marked as a category."""
        from pyspark.ml.feature import VectorAssembler

        named = rows.withMetadata(x, rows.schema[x].metadata).withColumn("_level", level.cast("double"))
        values = [str(k) for k in range(max(2, len(self.levels)))]
        named = named.withMetadata("_level", {"ml_attr": {"type": "nominal", "vals": values, "name": "_level"}})
        return VectorAssembler(inputCols=[x, "_level"], outputCol=out).transform(named).drop("_level")

    def _of_level(self, values: dict[int, Column], level: Column) -> Column:
        out = F.lit(None).cast("double")
        for k, v in values.items():
            out = F.when(level == k, v).otherwise(out)
        return out

    def _quantiles(self, rows: DataFrame, keys: Sequence[str], value: str, few: bool) -> DataFrame:
        """(keys, level, v): of each group and level the least value up to which weights reach the level's share of them.

        Few rows are sorted by group; of many, no group is.
        """
        by, share = [*keys, "level"], self._of_level({k: F.lit(p) for k, p in enumerate(self.levels)}, F.col("level"))
        if few:
            group = Window.partitionBy(*by)
            up_to = F.sum("w").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
            ranked = rows.select(*by, F.col(value).alias("v"), "w", up_to.alias("up_to"), F.greatest(F.ceil(share * F.sum("w").over(group)), F.lit(1)).alias("t"))
            return ranked.filter("t <= up_to and t > up_to - w").select(*by, "v")
        found = weighted_quantiles(rows, by, value, "w", {f"q{k}": p for k, p in enumerate(self.levels)})
        return found.select(*by, self._of_level({k: F.col(f"q{k}") for k in range(len(self.levels))}, F.col("level")).alias("v"))

    def fit(self, rows: DataFrame, x: str, y: str, weight: str) -> PinballTrees:
        from pyspark.ml.regression import DecisionTreeRegressor

        whole = F.greatest(F.round(F.col(weight) * WHOLE).cast("long"), F.lit(1).cast("long"))
        levels = F.explode(F.array(*(F.lit(k) for k in range(len(self.levels)))))
        state = rows.select(x, F.col(y).alias("y"), F.col(weight).alias("weight"), whole.alias("w"), levels.alias("level"))
        state = self._assembled(state, x, F.col("level"), "_x").select(F.col("_x").alias("x"), "y", "weight", "w", "level")
        few = state.count() <= LIMIT
        start = {r.level: r.v for r in self._quantiles(state, [], "y", few).collect()}
        self.start = [start[k] for k in range(len(self.levels))]
        state = state.withColumn("bound", self._of_level({k: F.lit(v) for k, v in enumerate(self.start)}, F.col("level")))
        spark, place, kept = rows.sparkSession, shared(rows.sparkSession), []
        state = written(state, place)
        share = self._of_level({k: F.lit(p) for k, p in enumerate(self.levels)}, F.col("level"))
        learner = DecisionTreeRegressor(featuresCol="x", labelCol="slope", weightCol="weight", leafCol="leaf", maxDepth=self.depth, minInstancesPerNode=self.least, seed=self.seed)
        self.model = []  # a tree and the values of its leaves, by level
        try:
            for done in range(1, self.trees + 1):
                tree = learner.fit(state.withColumn("slope", share - (F.col("y") < F.col("bound")).cast("double")))
                kept.append(tree.transform(state).select("x", "y", "weight", "w", "level", "bound", F.col("leaf").cast("int").alias("leaf")).persist())
                residuals = kept[-1].select("w", "level", "leaf", (F.col("y") - F.col("bound")).alias("residual"))
                found = self._quantiles(residuals, ["leaf"], "residual", few).collect()  # two to the depth rows for each level
                leaves = 1 + max(r.leaf for r in found)
                values = [[0.0] * leaves for _ in self.levels]
                for r in found:
                    values[r.level][r.leaf] = r.v
                self.model.append((tree, values))
                state = kept[-1].withColumn("bound", F.col("bound") + self.rate * self._leaf_value(values, F.col("leaf"), F.col("level"))).drop("leaf")
                anew = done % WRITTEN == 0 and done < self.trees
                if anew:
                    before, place = place, shared(spark)
                    state = written(state, place)
                    remove(spark, before)
                while len(kept) > (not anew):
                    kept.pop(0).unpersist()
        finally:
            for rows_kept in kept:
                rows_kept.unpersist()
            remove(spark, place)
        return self

    def _leaf_value(self, values, leaf: Column, level: Column) -> Column:
        return self._of_level({k: F.element_at(F.array(*map(F.lit, v)), leaf + 1) for k, v in enumerate(values)}, level)

    def predict(self, rows: DataFrame, x: str, names: Sequence[str]) -> DataFrame:
        """Adds a column for each level. Levels may cross; the caller orders them."""
        out = rows
        for k, name in enumerate(names):
            out = self._assembled(out, x, F.lit(k), "_x").withColumn(name, F.lit(self.start[k]))
            for tree, values in self.model:
                out = tree.transform(out, {tree.featuresCol: "_x", tree.leafCol: "_leaf", tree.predictionCol: "_p"})
                step = F.element_at(F.array(*map(F.lit, values[k])), F.col("_leaf").cast("int") + 1)
                out = out.withColumn(name, F.col(name) + self.rate * step).drop("_leaf", "_p")
            out = out.drop("_x")
        return out
