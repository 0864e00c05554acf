"""From raw case records to the prepared table and the model input."""

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from casecast.functions import day_gap, death_label, male_flag, mean_up, yes_flag
from casecast.schema import CASE_SCHEMA, CONFIRMED, FEATURE_SETS, KEY, LABEL, WORKING_NAMES


def kept_keys(df, key=KEY):
    """The key column as a list, empty where the table has none."""
    return [key] if key in df.columns else []


def confirmed_cases(cases, key=KEY):
    """The confirmed cases under their working names. Filtering first lets the predicate reach the scan."""
    kept = [name for name in CASE_SCHEMA.names if name != "clasificacion_resumen"]
    return (
        cases.where(F.col("clasificacion_resumen") == CONFIRMED)
        .select(*kept_keys(cases, key), *kept)
        .withColumnsRenamed(WORKING_NAMES)
    )


def derive(confirmed, key=KEY):
    """Flags, day gaps and the label, plus the ages that the imputation takes its means over.

    Whoever is not recorded as male is filled with the mean of the others, but an unstated sex counts in neither mean.
    """
    return confirmed.select(
        *kept_keys(confirmed, key),
        male_flag().alias("male"),
        "age",
        F.when(F.col("sex").isNotNull(), F.col("age")).alias("age_of_stated_sex"),
        yes_flag("icu_raw").alias("icu"),
        yes_flag("ventilator_raw").alias("ventilator"),
        day_gap("symptom_date", "admission_date").alias("days_to_admission"),
        day_gap("symptom_date", "diagnosis_date").alias("days_to_diagnosis"),
        death_label().alias(LABEL),
    )


def group_means(derived):
    """The three means of the preparation as one row, from one aggregation."""
    return derived.agg(
        mean_up(F.when(F.col("male") == 1, F.col("age_of_stated_sex"))).alias("mean_age_m"),
        mean_up(F.when(F.col("male") == 0, F.col("age_of_stated_sex"))).alias("mean_age_other"),
        mean_up(F.col("days_to_diagnosis")).alias("mean_days_dx"),
    )


def age_as_computed(mean_age_m, mean_age_other):
    """Males of unknown age get the male mean and everyone else the other mean, which overwrites known ages."""
    unknown_male = (F.col("male") == 1) & F.col("age").isNull()
    return F.when(unknown_male, mean_age_m).otherwise(mean_age_other).cast("double")


def prepared_as_computed(derived, key=KEY):
    """The prepared table with the means taken over the whole input and read in place as a scalar subquery."""
    means = group_means(derived).select(F.struct("*").alias("means")).scalar()
    return derived.select(
        *kept_keys(derived, key),
        "male",
        age_as_computed(means["mean_age_m"], means["mean_age_other"]).alias("age"),
        "icu",
        "ventilator",
        "days_to_admission",
        F.coalesce("days_to_diagnosis", means["mean_days_dx"]).alias("days_to_diagnosis"),
        LABEL,
    )


def assembler(feature_set="base"):
    """The stage that builds the feature vector; rows with a null or NaN input are dropped."""
    return VectorAssembler(inputCols=FEATURE_SETS[feature_set], outputCol="features", handleInvalid="skip")


def complete_rows(prepared, feature_set="base"):
    """The rows the assembler keeps, still as plain columns.

    Written as null checks, from which the optimizer infers that the dates behind a day gap are known, and tells the
    scan so.
    """
    types = dict(prepared.dtypes)
    known = [
        F.col(name).isNotNull() & ~F.isnan(name) if types[name] in ("double", "float") else F.col(name).isNotNull()
        for name in FEATURE_SETS[feature_set]
    ]
    return prepared.where(reduce(lambda a, b: a & b, known))


def model_inputs(prepared, feature_set="base", key=KEY):
    """Feature vector and label per case; the key stays, so that splits are stable and scores can be joined back."""
    complete = complete_rows(prepared, feature_set)
    return assembler(feature_set).transform(complete).select(*kept_keys(prepared, key), "features", LABEL)
