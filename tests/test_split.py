import pytest
from pyspark.sql import functions as F

from casecast.operators.split import with_split


@pytest.fixture(scope="module")
def cases(spark):
    return spark.range(3000).withColumnRenamed("id", "case_id")


def placed(df):
    return {row.case_id: (row.split, row.fold) for row in df.collect()}


def test_hash_split_does_not_depend_on_layout(cases):
    first = placed(with_split(cases))
    assert len(first) == 3000
    assert first == placed(with_split(cases.repartition(7).orderBy(F.desc("case_id"))))
    assert {split for split, _ in first.values()} == {"train", "test", "validation"}
    assert {fold for _, fold in first.values()} == {0, 1, 2}


def test_hash_split_sizes(cases):
    sizes = dict(with_split(cases).groupBy("split").count().collect())
    assert abs(sizes["train"] - 2100) < 100 and abs(sizes["test"] - 600) < 75 and abs(sizes["validation"] - 300) < 60


def test_other_parts(cases):
    sizes = dict(with_split(cases, parts={"a": 1, "b": 1}).groupBy("split").count().collect())
    assert set(sizes) == {"a", "b"} and sum(sizes.values()) == 3000 and abs(sizes["a"] - 1500) < 120


def test_random_split_needs_no_key(cases):
    keyless = cases.select((F.col("case_id") % 10).alias("x"))
    with pytest.raises(ValueError, match="key"):
        with_split(keyless)
    sizes = dict(with_split(keyless, "random").groupBy("split").count().collect())
    assert sum(sizes.values()) == 3000 and abs(sizes["train"] - 2100) < 100
    assert sizes == dict(with_split(keyless, "random").groupBy("split").count().collect())
    with pytest.raises(ValueError, match="mode"):
        with_split(cases, "alphabetical")


def test_random_parts_are_disjoint_and_cover(cases):
    drawn = with_split(cases, "random").collect()
    assert sorted(row.case_id for row in drawn) == list(range(3000))
    shares = {part: sum(row.split == part for row in drawn) / 3000 for part in ("train", "test", "validation")}
    assert abs(shares["train"] - 0.7) < 0.04 and abs(shares["test"] - 0.2) < 0.03 and abs(shares["validation"] - 0.1) < 0.03


def test_hash_split_is_narrow(cases):
    assert "Exchange" not in with_split(cases)._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(3000).select(F.lit(None).cast("bigint").alias("case_id"), F.col("id").alias("x"))
    first = {row.x: (row.split, row.fold) for row in with_split(rows).collect()}
    assert first == {row.x: (row.split, row.fold) for row in with_split(rows.repartition(5)).collect()}
    train = sum(split == "train" for split, _ in first.values())
    assert abs(train - 2100) < 100 and len(set(first.values())) == 9
