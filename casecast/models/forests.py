"""Random forests on counted rows, with the bootstrap of the cases that the rows count."""

from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.models.estimators import _SharesIterations
from casecast.operators.profiles import in_stable_order

#: Trees whose draws are made at once, and trees that grow side by side.
DRAWS, AT_ONCE = 100, 8
#: Rows that make a partition, and the most partitions there are: a tree is a chain of short jobs.
ROWS_PER_PARTITION, MOST_PARTITIONS = 5_000, 64


def _poisson(draws):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def drawn(counts: pd.Series, hashes: pd.Series, seeds: pd.Series) -> pd.Series:
        made = (
            np.random.Generator(np.random.PCG64([h & (1 << 64) - 1, seed & (1 << 64) - 1])).poisson(n, draws).astype(float)
            for n, h, seed in zip(counts, hashes, seeds)
        )
        return pd.Series(list(made), dtype=object)

    return drawn


def with_draws(rows, weight, columns, seed, block=0, draws=DRAWS):
    """`rows` with `draws`: how often each of `draws` trees draws the cases that a row counts.

    A forest on single cases draws each of n cases Poisson(1) times, so a row of n equal ones is drawn Poisson(n) times in
    all. The draws follow from the row's `columns`, in which no two rows agree, the seed and the block alone, so any layout
    of the rows gives the same.
    """
    content = F.xxhash64(*columns)
    return rows.withColumn("draws", _poisson(draws)(F.col(weight), content, F.lit(seed + (block << 32)).cast("bigint")))


def _forest(uid, trees, features, classes):
    sc = SparkContext.getOrCreate()
    kinds = sc._jvm.org.apache.spark.ml.classification
    array = sc._gateway.new_array(kinds.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    return RandomForestClassificationModel(kinds.RandomForestClassificationModel(uid, array, features, classes))


def first_trees(model, count):
    """The forest made of the first `count` trees."""
    if count >= model.getNumTrees:
        return model
    shorter = model._copyValues(_forest(model.uid, list(model._java_obj.trees())[:count], model.numFeatures, model.numClasses))
    return shorter.copy({shorter.numTrees: count})


class CountedForestClassifier(_SharesIterations, RandomForestClassifier):
    """A random forest on rows that count equal cases, with the law of one on the cases.

    Every tree is a fit of its own on the rows it draws, weighted by how often it draws their cases. So training rows are
    bounded by the distinct combinations however many cases there are, at the price of a chain of short jobs for each
    tree. Tree t depends on the seed and t alone, so a smaller forest is the first trees of a larger one and a search
    fits only the largest of points that differ in `numTrees`.
    """

    shared_param = "numTrees"

    def _fit_group(self, dataset, paramMaps, group):
        several = [(count, index) for count, index in group if count > 1]
        for count, index in group:
            if count == 1:  # a single tree looks at all features, where Spark chooses
                yield index, self.fit(dataset, paramMaps[index])
        if several:
            largest = self.fit(dataset, paramMaps[several[-1][1]])
            for count, index in several:
                yield index, first_trees(largest, count).copy(paramMaps[index])

    def _tree(self, number):
        strategy = self.getFeatureSubsetStrategy()
        if strategy == "auto":
            strategy = "sqrt" if self.getNumTrees() > 1 else "all"
        tree = RandomForestClassifier(numTrees=1, bootstrap=False, weightCol="draw", featureSubsetStrategy=strategy)
        for param in ("featuresCol", "labelCol", "impurity", "maxDepth", "maxBins", "minInfoGain", "maxMemoryInMB", "cacheNodeIds"):
            tree.set(tree.getParam(param), self.getOrDefault(param))
        return tree.setSeed((self.getSeed() + 7919 * number) & (1 << 62) - 1)

    def _fit(self, dataset):
        if not self.isDefined(self.weightCol):
            return super()._fit(dataset)
        features, label, weight = self.getFeaturesCol(), self.getLabelCol(), self.getWeightCol()
        # Rows of equal features and label, of other folds for instance, are one: equal rows would be drawn alike.
        values = vector_to_array(features).alias("_values")
        rows = dataset.groupBy(values, label).agg(F.sum(weight).alias(weight))
        count, classes = rows.agg(F.count(F.lit(1)), F.max(label)).first()
        if not count:
            raise ValueError("there are no rows to fit")
        partitions, classes = max(1, min(MOST_PARTITIONS, -(-count // ROWS_PER_PARTITION))), int(classes) + 1
        trees = []
        for block, begin in enumerate(range(0, self.getNumTrees(), DRAWS)):
            grown_at_once = min(DRAWS, self.getNumTrees() - begin)
            drawn = with_draws(rows, weight, ["_values", label], self.getSeed(), block)
            drawn = in_stable_order(drawn, partitions).withColumn(features, array_to_vector("_values"))
            drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)

            def grow(i):
                own = drawn.select(features, label, F.get("draws", F.lit(i)).alias("draw")).where("draw > 0")
                return self._tree(begin + i).fit(own)

            try:
                with ThreadPool(min(AT_ONCE, grown_at_once)) as pool:
                    trees += pool.map(inheritable_thread_target(dataset.sparkSession)(grow), range(grown_at_once))
            finally:
                drawn.unpersist()
        grown = [model._java_obj.trees()[0] for model in trees]
        most = max([classes, 2, *[model.numClasses for model in trees]])
        return self._copyValues(_forest(self.uid, grown, trees[0].numFeatures, most)).copy()  # the copy tells the JVM its parameters
