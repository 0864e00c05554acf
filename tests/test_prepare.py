from datetime import date

import pytest
from pyspark.sql import functions as F

from casecast.operators.impute import AsComputedAge, GroupMeanImputer, MeanUnknownError
from casecast.operators.prepare import (
    complete_rows,
    confirmed_cases,
    derive,
    group_means,
    model_inputs,
    prepared_as_computed,
)

# male, age, icu, ventilator, days to admission, days to diagnosis, label; source row order
AS_COMPUTED = [
    (1, 31.0, 1, 0, 3, 5, 1.0),
    (1, 40.0, 0, 0, 1, 3, 0.0),
    (0, 31.0, 0, 1, None, 2, 0.0),
    (0, 31.0, 0, 1, -2, 0, 0.0),
    (0, 31.0, 0, 0, None, 3, 1.0),
    (0, 31.0, 1, 1, 8, 2, 1.0),
]


def sortable(rows):
    return sorted((tuple(row) for row in rows), key=str)


def test_confirmed_cases_drop_other_and_rename(edge_cases):
    confirmed = confirmed_cases(edge_cases)
    assert confirmed.columns == [
        "sex", "age", "symptom_date", "admission_date", "icu_raw", "ventilator_raw", "classification", "diagnosis_date",
    ]
    assert confirmed.count() == 6
    assert confirmed.where("age = 40").first()["symptom_date"] == date(2020, 5, 1)


def test_group_means(edge_cases):
    assert tuple(group_means(derive(confirmed_cases(edge_cases))).first()) == (40, 31, 3)


def test_prepared_as_computed(edge_cases):
    prepared = prepared_as_computed(derive(confirmed_cases(edge_cases)))
    assert dict(prepared.dtypes) == {
        "male": "int", "age": "double", "icu": "int", "ventilator": "int", "days_to_admission": "int",
        "days_to_diagnosis": "bigint", "label": "double",
    }
    assert sortable(prepared.collect()) == sortable(AS_COMPUTED)


def test_fitted_as_computed_rule_agrees(edge_cases):
    derived = derive(confirmed_cases(edge_cases))
    ages = AsComputedAge().fit(derived).transform(derived).select("age").collect()
    assert sortable(ages) == sortable((row[1],) for row in AS_COMPUTED)


def test_keep_known_ages(edge_cases):
    derived = derive(confirmed_cases(edge_cases))
    imputer = GroupMeanImputer(inputCol="age", outputCol="age", groupCols=["male"], meanCol="age_of_stated_sex")
    ages = imputer.fit(derived).transform(derived).select("age").collect()
    assert sorted(row.age for row in ages) == [30, 31, 31, 40, 40, 50]


def test_incomplete_rows_are_dropped(edge_cases):
    prepared = prepared_as_computed(derive(confirmed_cases(edge_cases)))
    for features, width in (("base", 5), ("with_diagnosis", 6)):
        rows = model_inputs(prepared, features).collect()
        assert len(rows) == complete_rows(prepared, features).count() == 4
        assert {len(row.features) for row in rows} == {width}
        assert sorted(row.label for row in rows) == [0.0, 0.0, 1.0, 1.0]


def test_nan_input_is_dropped_like_null(spark):
    prepared = spark.sql(
        "SELECT 1 AS male, CAST('NaN' AS DOUBLE) AS age, 0 AS icu, 0 AS ventilator, 1 AS days_to_admission, 0.0D AS label"
    )
    assert model_inputs(prepared).count() == complete_rows(prepared).count() == 0


def test_mean_of_nothing_is_a_named_error(edge_cases):
    women = derive(confirmed_cases(edge_cases)).where("male = 0")
    with pytest.raises(MeanUnknownError, match="males"):
        AsComputedAge().fit(women)
    nobody = women.withColumn("age_of_stated_sex", F.lit(None).cast("int"))
    with pytest.raises(MeanUnknownError, match="age_of_stated_sex"):
        GroupMeanImputer(inputCol="age", outputCol="age", meanCol="age_of_stated_sex").fit(nobody)
    # The lazy form leaves the mean null instead.
    assert group_means(women).first()["mean_age_m"] is None
