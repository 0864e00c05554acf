"""Mean imputation as pipeline stages that learn on one table and fill another."""

from functools import reduce

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.operators.prepare import age_as_computed
from casecast.session import small_table, staged

MEAN = "_mean"
ROWS = "_rows"
LACKING = "_lacking"


#: Most groups that an error names.
SHOWN_GROUPS = 20
#: Most groups that count as hot in a table to be filled, which each hold at least one in so many of the rows that lack a
#: value, and how many the sketch that finds them keeps track of.
HEAVY_GROUPS, TRACKED_GROUPS = 1_000, 20_000


class MeanUnknownError(ValueError):
    """A mean was needed but no value was there to take it from."""


#: Sums of fractions depend on their order in the last digits, so their means are rounded to so many before they go up.
MEAN_DIGITS = 9


def weighted_mean_up(value, weight=None, fractional=False):
    """The mean rounded up; with a weight, that of a table in which every row stands for `weight` equal ones.

    Sums of whole numbers are exact. With `fractional` values a mean that is whole but for the order of summation
    counts as whole, so that the layout of the table does not decide.
    """
    if weight is None:
        mean = F.avg(value)
    else:
        counted = F.when(F.col(value).isNotNull(), F.col(weight))
        mean = F.sum(F.col(value) * F.col(weight)) / F.sum(counted)
    return F.ceil(F.round(mean, MEAN_DIGITS) if fractional else mean)


def is_fractional(dataset, column):
    return isinstance(dataset.schema[column].dataType, (T.FloatType, T.DoubleType))


class _GroupMeanParams(HasInputCol, HasOutputCol):
    groupCols = Param(
        Params._dummy(), "groupCols", "columns that name a row's group", typeConverter=TypeConverters.toListString
    )
    meanCol = Param(
        Params._dummy(), "meanCol", "column the mean is taken over", typeConverter=TypeConverters.toString
    )
    weightCol = Param(
        Params._dummy(), "weightCol", "number of rows a row stands for", typeConverter=TypeConverters.toString
    )
    broadcastGroups = Param(
        Params._dummy(),
        "broadcastGroups",
        "most groups whose means are broadcast, and the reciprocal of the share of rows that makes a group hot",
        typeConverter=TypeConverters.toInt,
    )
    unknownMean = Param(
        Params._dummy(),
        "unknownMean",
        "what fills a row whose group has no mean: `error` raises, `overall` takes the mean over all rows",
        typeConverter=TypeConverters.toString,
    )

    def __init__(self):
        super().__init__()
        self._setDefault(groupCols=[], broadcastGroups=10_000, unknownMean="error")

    def _groups(self):
        return self.getOrDefault(self.groupCols)

    def _mean_column(self):
        return self.getOrDefault(self.meanCol) if self.isDefined(self.meanCol) else self.getInputCol()

    def _weight(self):
        return self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None


def _kept(means, limit):
    """Up to `limit` means as a local table, more as a staged one that is never collected, and which of the two.

    The aggregation is cached meanwhile, so that finding out costs no second pass over the data.
    """
    means = means.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        few = means.limit(limit + 1).collect()
        if len(few) <= limit:
            return small_table(means.sparkSession, few, means.schema), True
        return staged(means, "group-means"), False
    finally:
        means.unpersist()


class GroupMeanImputer(Estimator, _GroupMeanParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learn each group's mean, rounded up, to fill nulls with; known values stay as they are.

    Without `groupCols` there is one mean for all rows. A null group column is a group of its own. Fitting is one
    aggregation with map-side partial sums, so a group that holds most rows costs no more than any other.

    A row must never stay without a value unnoticed. By default fitting raises if a group lacks values and has none to
    take a mean over, and filling raises at the first row of a group that was not seen; `unknownMean="overall"` fills
    both with the mean over all rows.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCol=None,
        outputCol=None,
        groupCols=None,
        meanCol=None,
        weightCol=None,
        broadcastGroups=None,
        unknownMean=None,
    ):
        super().__init__()
        if unknownMean not in (None, "error", "overall"):
            raise ValueError(f"unknownMean is 'error' or 'overall', not {unknownMean!r}")
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _fit(self, dataset):
        groups, weight, column = self._groups(), self._weight(), self._mean_column()
        fractional = is_fractional(dataset, column)
        rows = F.sum(weight) if weight else F.count(F.lit(1))
        mean = weighted_mean_up(column, weight, fractional).alias(MEAN)
        lacking = F.sum(F.when(F.col(self.getInputCol()).isNull(), F.col(weight) if weight else F.lit(1)).otherwise(0))
        lacking = lacking.cast("bigint").alias(LACKING)
        means = dataset.groupBy(*groups).agg(mean, rows.cast("bigint").alias(ROWS), lacking)
        if groups:
            means, small = _kept(means, self.getOrDefault(self.broadcastGroups))
        else:
            means, small = small_table(dataset.sparkSession, means.collect(), means.schema), True
        overall = None
        if not groups or self.getOrDefault(self.unknownMean) == "overall":
            overall = dataset.agg(mean).first()[0] if groups else means.first()[MEAN]
        model = GroupMeanImputerModel(means, small, overall)
        return self._copyValues(model)._check()


class GroupMeanImputerModel(Model, _GroupMeanParams, MLReadable, MLWritable):
    """Fills nulls of `inputCol` with the learned mean of the row's group."""

    def __init__(self, means=None, small=True, overall=None):
        super().__init__()
        self.means = means
        self.small = small
        self.overall = overall

    def _check(self):
        column = self._mean_column()
        unknown = self.means.where(F.col(MEAN).isNull() & (F.col(LACKING) > 0))
        if self._groups() and self.overall is None:
            named = [tuple(row) for row in unknown.select(*self._groups()).limit(SHOWN_GROUPS).collect()]
            if named:
                raise MeanUnknownError(f"no known value in {column!r} to take a mean over in {self._groups()} {named}")
        elif self.overall is None and not unknown.isEmpty():
            raise MeanUnknownError(f"no known value in {column!r} to take a mean over")
        return self

    def _transform(self, dataset):
        groups, value, output = self._groups(), self.getInputCol(), self.getOutputCol()
        if not groups:
            return dataset.withColumn(output, F.coalesce(F.col(value), self._overall()))
        kept = [name for name in dataset.columns if name != output]
        if self.small:
            joined = dataset.join(*self._on(dataset, F.broadcast(self._renamed(self.means))), "left")
        else:
            joined = self._met_many(dataset, value)
        return joined.select(*kept, F.coalesce(F.col(value), F.col(MEAN), self._without_mean()).alias(output))

    def _overall(self):
        text = None if self.overall is None else str(self.overall)
        return F.lit(text).cast(self.means.schema[MEAN].dataType)

    def _without_mean(self):
        """What fills a row whose group has no mean: the overall mean, or an error that names the group."""
        if self.overall is not None:
            return self._overall()
        told = F.concat_ws(", ", *[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("null")) for name in self._groups()])
        message = F.concat(F.lit(f"no mean of {self._mean_column()} is known for {', '.join(self._groups())} = "), told)
        return F.raise_error(message).cast(self.means.schema[MEAN].dataType)

    def _renamed(self, means):
        return means.select(*[F.col(name).alias(f"_group_{name}") for name in self._groups()], MEAN)

    def _on(self, dataset, means):
        matches = [dataset[name].eqNullSafe(means[f"_group_{name}"]) for name in self._groups()]
        return means, reduce(lambda a, b: a & b, matches)

    def _met_many(self, dataset, value):
        """Rows with their means where there are too many groups to broadcast.

        A group with at least 1/broadcastGroups of the rows fitted on is hot, and so is one that holds many of the rows to
        be filled (`_heavy`), whether it was rare when fitting or unknown. There can be no more than broadcastGroups and
        HEAVY_GROUPS of those, so their means are broadcast whatever the data. Then `dataset` is read once, to meet these
        and be staged; only rows of other groups that still lack a value are joined with the other means in a shuffle.
        """
        total = self.means.agg(F.sum(ROWS).alias("total")).select("total").scalar()
        heavy = self._heavy(dataset, value)
        is_hot = (F.col(ROWS) * self.getOrDefault(self.broadcastGroups) >= total) | self._named(heavy)
        hot, cold = self._renamed(self.means.where(is_hot)), self._renamed(self.means.where(~is_hot))
        met = dataset.join(*self._on(dataset, F.broadcast(hot)), "left").select(*dataset.columns, MEAN)
        met = staged(met, "imputed")
        is_open = F.col(value).isNull() & F.col(MEAN).isNull() & ~self._named(heavy)
        rest = met.where(is_open).drop(MEAN)
        filled = rest.join(*self._on(rest, cold), "left").select(*met.columns)
        return met.where(~is_open).unionByName(filled)

    def _group_hash(self):
        types = {name: self.means.schema[name].dataType for name in self._groups()}
        return F.xxhash64(*[F.col(f"`{name}`").cast(kind) for name, kind in types.items()])

    def _named(self, hashes):
        return self._group_hash().isin(hashes) if hashes else F.lit(False)

    def _heavy(self, dataset, value):
        """Hashes of the groups that hold at least one in HEAVY_GROUPS of the rows that lack a value, by a sketch of the most
        frequent ones, which tasks make and merge."""
        lacking = dataset.where(F.col(value).isNull()).select(self._group_hash().alias("hash"))
        most = F.expr(f"approx_top_k(hash, {HEAVY_GROUPS}, {TRACKED_GROUPS})")
        rows, found = lacking.agg(F.count(F.lit(1)), most).first()
        return [group["item"] for group in found or [] if group["count"] * HEAVY_GROUPS >= rows]

    def copy(self, extra=None):
        that = super().copy(extra)
        that.means, that.small, that.overall = self.means, self.small, self.overall
        return that

    def write(self):
        return _GroupMeanWriter(self)

    @classmethod
    def read(cls):
        return _GroupMeanReader(cls)


class _GroupMeanWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        overall = None if self.instance.overall is None else str(self.instance.overall)
        kept = {"small": self.instance.small, "overall": overall}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, kept)
        self.instance.means.write.parquet(f"{path}/data")


class _GroupMeanReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/data"), metadata["small"], metadata["overall"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _AsComputedAgeParams(Params):
    weightCol = _GroupMeanParams.weightCol
    maleMean = Param(Params._dummy(), "maleMean", "given to males of unknown age", typeConverter=TypeConverters.toInt)
    otherMean = Param(Params._dummy(), "otherMean", "given to everyone else", typeConverter=TypeConverters.toInt)


class AsComputedAge(Estimator, _AsComputedAgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """The age rule that overwrites known ages: learn the male and the non-male mean over rows of stated sex."""

    @keyword_only
    def __init__(self, *, weightCol=None):
        super().__init__()
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _fit(self, dataset):
        weight = self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None
        male, other = (
            dataset.withColumns(
                {
                    "_male_age": F.when(F.col("male") == 1, F.col("age_of_stated_sex")),
                    "_other_age": F.when(F.col("male") == 0, F.col("age_of_stated_sex")),
                }
            )
            .agg(*[weighted_mean_up(c, weight, is_fractional(dataset, "age_of_stated_sex")) for c in ("_male_age", "_other_age")])
            .first()
        )
        if male is None or other is None:
            raise MeanUnknownError(f"no known age among {'males' if male is None else 'non-males'} to take a mean over")
        model = AsComputedAgeModel()
        model._set(maleMean=male, otherMean=other)
        return self._copyValues(model)


class AsComputedAgeModel(Model, _AsComputedAgeParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        male, other = self.getOrDefault(self.maleMean), self.getOrDefault(self.otherMean)
        return dataset.withColumn("age", age_as_computed(F.lit(male), F.lit(other)))
