"""Boosted trees whose split candidates are weighted quantiles, the same on cases and on rows that count them."""

from math import isqrt

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from casecast.models.estimators import CaseGBTClassifier

#: Levels of the sketch for each factor of e: values that differ by more than one part in so many are told apart.
LEVELS = 4096
#: The most bins Spark takes without its square, the size of its sample, leaving the range of an integer.
MOST_BINS = 46_340


def quantile_sketch(dataset, features, weight):
    """How much weight lies in each (`feature`, level) of logarithmic width, with the level's `low` and `high` value.

    Levels are added up before the shuffle and merge across tasks, there are a few ten thousand of them for a feature
    whatever the number of rows, and they follow from the counted cases alone. Whole numbers below 4096 are levels of
    their own.
    """
    value, sign = F.col("value"), F.signum("value")
    level = F.floor(F.log(F.abs(value)) * LEVELS) * sign.cast("int")
    values = dataset.select(F.posexplode(vector_to_array(features)).alias("feature", "value"), weight.alias("weight"))
    merged = values.groupBy("feature", sign.alias("sign"), F.when(value != 0, level).alias("level"))
    return merged.agg(F.sum("weight").alias("weight"), F.min("value").alias("low"), F.max("value").alias("high"))


def candidate_borders(dataset, features, weight, bins):
    """(`feature`, `border`) rows: where a feature may be split into at most `bins` bins.

    A border lies half way between neighbouring levels of the sketch. A feature of at most `bins` levels has all borders,
    another those at which the weight passes a multiple of the `bins`th part.
    """
    of_feature = Window.partitionBy("feature")
    upwards = of_feature.orderBy("low")
    passed = F.sum("weight").over(upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total, levels = F.sum("weight").over(of_feature), F.count(F.lit(1)).over(of_feature)
    ranked = quantile_sketch(dataset, features, weight).where("weight > 0").select(
        "feature",
        ((F.col("high") + F.lead("low").over(upwards)) / 2).alias("border"),
        (levels <= bins).alias("few"),
        (F.floor(passed * bins / total) > F.floor((passed - F.col("weight")) * bins / total)).alias("passes"),
    )
    return ranked.where("border IS NOT NULL AND (few OR passes)").select("feature", "border")


def coded(features, borders):
    """The vector column `features` with each value replaced by the number of its feature's borders below it."""
    values = vector_to_array(features)
    numbers = [sum(((values[i] > b).cast("double") for b in own), F.lit(0.0)) for i, own in enumerate(borders)]
    return array_to_vector(F.array(*numbers))


def _split_at_borders(node, borders):
    """A grown node with borders in the place of numbers of borders."""
    tree = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.tree
    if node.subtreeDepth() == 0:
        return node
    feature = node.split().featureIndex()
    return tree.InternalNode(
        node.prediction(),
        node.impurity(),
        node.gain(),
        _split_at_borders(node.leftChild(), borders),
        _split_at_borders(node.rightChild(), borders),
        tree.ContinuousSplit(feature, borders[feature][int(node.split().threshold())]),
        node.impurityStats(),
    )


class CountedGBTClassifier(CaseGBTClassifier):
    """Boosted trees that are equal on cases and on rows that count them, however many rows there are.

    Beyond 10,000 rows Spark takes split candidates from a sample of the rows, so counted rows and cases give other trees. Here
    the candidates come from a sketch of the counted cases, Spark grows the trees on the numbers of the bins, and the
    splits are set back to values. `maxBins` bounds the bins of a feature. Equal means up to the rounding of sums, by which
    nodes whose cases all agree may be split once more, into leaves of the same prediction.
    """

    def _fit(self, dataset):
        features, bins = self.getFeaturesCol(), self.getMaxBins()
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        first = dataset.select(features).first()
        if first is None:
            raise ValueError("there are no rows to fit")
        borders = [[] for _ in range(first[0].size)]
        for row in candidate_borders(dataset, features, weight, bins).collect():  # below `bins` for each feature
            borders[row.feature].append(row.border)
        borders = [sorted(own) for own in borders]
        numbers = f"{features}_numbers"
        # With as many bins allowed as the root of the rows, Spark looks at all rows for the few numbers there are.
        most = min(MOST_BINS, max(bins, isqrt(dataset.count()) + 1))
        inner = self.copy({self.featuresCol: numbers, self.maxBins: most})
        grown = super(CountedGBTClassifier, inner)._fit(dataset.withColumn(numbers, coded(features, borders)))
        sc = SparkContext.getOrCreate()
        ml, made = sc._jvm.org.apache.spark.ml, grown._java_obj
        count = grown.getNumTrees
        trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, count)
        weights = sc._gateway.new_array(sc._jvm.double, count)
        for i, tree in enumerate(made.trees()):
            root = _split_at_borders(tree.rootNode(), borders)
            trees[i] = ml.regression.DecisionTreeRegressionModel(tree.uid(), root, len(borders))
            weights[i] = made.treeWeights()[i]
        model = ml.classification.GBTClassificationModel(self.uid, trees, weights, len(borders), 2)
        return self._copyValues(GBTClassificationModel(model))
