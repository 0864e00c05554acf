"""What the optimizer makes of the steps: pruned scans, pushed filters, few shuffles."""

import contextlib
import io
import re

import pytest

from casecast.operators.prepare import complete_rows, confirmed_cases, derive, model_inputs, prepared_as_computed
from casecast.plans.training import TrainingSettings, case_profiles
from casecast.schema import CASE_SCHEMA
from casecast.sources import cases_from_orders, read_cases_csv, read_cases_parquet


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    """The columns of the scan, from the plan form that does not shorten them."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    (read,) = re.findall(r"ReadSchema: struct<(.*?)>", text.getvalue())
    return sorted(column.split(":")[0] for column in read.split(","))


@pytest.fixture(scope="module")
def wide_csv(spark, sf_dir, tmp_path_factory):
    """Case files with more columns than the nine, as real ones have."""
    path = str(tmp_path_factory.mktemp("wide") / "cases")
    cases = cases_from_orders(spark, sf_dir)
    cases.selectExpr("'x' AS provincia", "*", "'y' AS origen").write.option("header", True).csv(path)
    return path


def test_csv_scan_reads_and_filters_only_what_is_used(spark, wide_csv):
    derived = derive(confirmed_cases(read_cases_csv(spark, wide_csv)))
    assert "EqualTo(clasificacion_resumen,Confirmado)" in plan_of(derived)
    assert read_columns(derived) == sorted(["case_id", *CASE_SCHEMA.names])


def test_parquet_scan_prunes_to_the_query(spark, edge_cases, tmp_path):
    edge_cases.write.parquet(str(tmp_path / "c"))
    used = derive(confirmed_cases(read_cases_parquet(spark, str(tmp_path / "c")))).select("icu", "label")
    assert "EqualTo(clasificacion_resumen,Confirmado)" in plan_of(used)
    assert read_columns(used) == ["clasificacion", "clasificacion_resumen", "cuidado_intensivo"]


def test_derivation_is_one_narrow_stage(edge_cases):
    plan = plan_of(derive(confirmed_cases(edge_cases)))
    assert "Exchange" not in plan and "Python" not in plan and "UDF" not in plan


def test_the_three_means_cost_one_pass(spark, sf_dir):
    prepared = prepared_as_computed(derive(confirmed_cases(cases_from_orders(spark, sf_dir))))
    rows = prepared.collect()
    assert len(rows) == 1337
    plan = plan_of(prepared)
    assert "Join" not in plan
    # One subquery runs; the other two mentions are reuses of it.
    assert plan.count("ReusedSubquery") >= 2


def test_training_reads_the_cases_once_and_shuffles_counts(spark, wide_csv):
    from pyspark.sql import types as T

    cases = read_cases_csv(spark, wide_csv, types={"case_id": T.LongType()})
    plan = plan_of(case_profiles(cases, TrainingSettings()))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_count" in plan


def test_incomplete_rows_are_filtered_at_the_scan(spark, edge_cases, tmp_path):
    edge_cases.write.parquet(str(tmp_path / "c"))
    prepared = prepared_as_computed(derive(confirmed_cases(read_cases_parquet(spark, str(tmp_path / "c")))))
    for rows in (complete_rows(prepared), model_inputs(prepared), model_inputs(prepared, "with_diagnosis")):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            rows.explain("formatted")
        pushed = [line for line in text.getvalue().splitlines() if line.startswith("PushedFilters")]
        assert any(
            "IsNotNull(fecha_internacion)" in line and "IsNotNull(fecha_inicio_sintomas)" in line for line in pushed
        )
        assert rows.count() == 4
