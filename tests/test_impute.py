import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from casecast.operators.impute import (
    AsComputedAge,
    AsComputedAgeModel,
    GroupMeanImputer,
    GroupMeanImputerModel,
    MeanUnknownError,
)
from casecast.session import small_table

ROWS = [("a", 1, 2), ("a", 4, 1), ("a", None, 5), ("b", None, 1), (None, 7, 1), (None, None, 3)]


@pytest.fixture(scope="module")
def table(spark):
    return small_table(spark, ROWS, "g string, x int, n bigint")


def pairs(df):
    return sorted(map(str, df.select("g", "y").collect()))


def expect(*rows):
    return sorted(f"Row(g={g!r}, y={y!r})" for g, y in rows)


def test_groups_and_null_group(table):
    known = table.where("g IS NULL OR g <> 'b'")
    filled = GroupMeanImputer(inputCol="x", outputCol="y", groupCols=["g"]).fit(known).transform(known)
    assert filled.columns == ["g", "x", "n", "y"]
    assert pairs(filled) == expect(("a", 1), ("a", 4), ("a", 3), (None, 7), (None, 7))


@pytest.mark.parametrize("most", [100, 1])
def test_group_without_values(table, most, tmp_path):
    settings = {"inputCol": "x", "outputCol": "y", "groupCols": ["g"], "broadcastGroups": most}
    with pytest.raises(MeanUnknownError, match="'b'"):
        GroupMeanImputer(**settings).fit(table)
    filled = expect(("a", 1), ("a", 4), ("a", 3), ("b", 4), (None, 7), (None, 7))
    model = GroupMeanImputer(**settings, unknownMean="overall").fit(table)
    assert pairs(model.transform(table)) == filled
    model.write().save(str(tmp_path / "m"))
    assert pairs(GroupMeanImputerModel.load(str(tmp_path / "m")).transform(table)) == filled


@pytest.mark.parametrize("most", [100, 1])
def test_group_that_was_not_seen(spark, table, most):
    known = table.where("g IS NULL OR g <> 'b'")
    settings = {"inputCol": "x", "outputCol": "y", "groupCols": ["g"], "broadcastGroups": most}
    new = small_table(spark, [("new", 3, 1), ("new", None, 1)], "g string, x int, n bigint")
    strict = GroupMeanImputer(**settings).fit(known)
    assert pairs(strict.transform(new.where("x IS NOT NULL"))) == expect(("new", 3))
    with pytest.raises(Exception, match="no mean of x is known for g = new"):
        strict.transform(new).collect()
    assert pairs(GroupMeanImputer(**settings, unknownMean="overall").fit(known).transform(new)) == expect(("new", 3), ("new", 4))


def test_other_choices_are_refused():
    with pytest.raises(ValueError, match="unknownMean"):
        GroupMeanImputer(inputCol="x", outputCol="y", unknownMean="zero")


def test_whole_means_of_fractions_do_not_hang_on_the_order(spark):
    values = [0.1] * 10 + [0.2] * 10 + [2.7] * 10  # the mean is 1, but for the last digits
    for order in (values, values[::-1], sorted(values, key=lambda x: (x * 7) % 1)):
        table = small_table(spark, [(x,) for x in order] + [(None,)], "x double").coalesce(1)
        model = GroupMeanImputer(inputCol="x", outputCol="y").fit(table)
        assert model.transform(table).where("x IS NULL").first().y == 1


def test_one_mean_for_all(table):
    filled = GroupMeanImputer(inputCol="x", outputCol="y").fit(table).transform(table)
    assert pairs(filled) == expect(("a", 1), ("a", 4), ("a", 4), ("b", 4), (None, 7), (None, 4))


def test_weights_stand_for_rows(table):
    expanded = table.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    for groups in ([], ["g"]):
        settings = {"inputCol": "x", "outputCol": "y", "groupCols": groups}
        weighted = GroupMeanImputer(weightCol="n", unknownMean="overall", **settings).fit(table)
        repeated = GroupMeanImputer(unknownMean="overall", **settings).fit(expanded)
        assert weighted.overall == repeated.overall
        assert sorted(map(str, weighted.means.collect())) == sorted(map(str, repeated.means.collect()))


def test_many_groups_agree_with_few(spark):
    # A third of all rows in one group, a null group, and 300 small ones.
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 300)).alias("g"),
        F.when(F.col("id") % 4 != 1, F.col("id") % 17).alias("x"),
        "id",
    )
    imputers = [
        GroupMeanImputer(inputCol="x", outputCol="y", groupCols=["g"], broadcastGroups=most, unknownMean="overall")
        for most in (10_000, 20)
    ]
    few, many = (imputer.fit(rows) for imputer in imputers)
    assert few.small and not many.small
    a, b = few.transform(rows), many.transform(rows)
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plan = b._jdf.queryExecution().optimizedPlan().toString()
    # The input itself was read once, to meet the hot groups and be staged; what is left reads staged tables only.
    assert "Range" not in plan and plan.count("Relation [") == plan.count("parquet")


def test_save_and_load(table, tmp_path):
    table = table.where("g IS NULL OR g <> 'b'")
    model = GroupMeanImputer(inputCol="x", outputCol="y", groupCols=["g"], weightCol="n").fit(table)
    model.write().save(str(tmp_path / "m"))
    loaded = GroupMeanImputerModel.load(str(tmp_path / "m"))
    assert loaded.uid == model.uid
    assert pairs(loaded.transform(table)) == pairs(model.transform(table))
    with pytest.raises(Exception, match="(?i)exists"):
        model.write().save(str(tmp_path / "m"))


def test_pipeline_of_imputers_is_saved_whole(spark, tmp_path):
    rows = [(1, None, 40), (1, 40, 40), (0, 20, 20), (0, 33, None), (0, None, None)]
    cases = small_table(spark, rows, "male int, age int, age_of_stated_sex int")
    stages = [AsComputedAge(), GroupMeanImputer(inputCol="age_of_stated_sex", outputCol="known", groupCols=["male"])]
    model = Pipeline(stages=stages).fit(cases)
    model.write().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert isinstance(loaded.stages[0], AsComputedAgeModel)
    result = loaded.transform(cases)
    assert sorted(map(str, result.collect())) == sorted(map(str, model.transform(cases).collect()))
    assert sorted(row.age for row in result.collect()) == [20.0, 20.0, 20.0, 20.0, 40.0]


def test_many_groups_of_decimals(spark):
    rows = spark.sql(
        "SELECT CAST(id % 9 AS STRING) AS g, CASE WHEN id % 2 = 0 THEN CAST(id AS DECIMAL(10, 2)) END AS x FROM range(90)"
    )
    for most in (100, 3):
        imputer = GroupMeanImputer(inputCol="x", outputCol="y", groupCols=["g"], broadcastGroups=most)
        filled = imputer.fit(rows).transform(rows)
        assert filled.where("x IS NULL").agg(F.sum("y")).first()[0] == 5 * sum(
            -(-sum(i for i in range(90) if i % 9 == g and i % 2 == 0) // 5) for g in range(9)
        )


@pytest.mark.parametrize("unseen", [True, False])
def test_groups_that_are_hot_only_in_the_table_to_be_filled(spark, monkeypatch, unseen):
    """A group that was rare or unknown when fitting and holds a third of the rows is not sent to one task."""
    from casecast.operators import impute

    known = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("g"), (F.col("id") % 7).alias("x"))
    hot = "new" if unseen else "5"
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise((F.col("id") % 1000).cast("string")).alias("g"),
        F.lit(None).cast("bigint").alias("x"),
        F.col("id"),
    )
    monkeypatch.setattr(impute, "HEAVY_GROUPS", 20)
    imputer = GroupMeanImputer(inputCol="x", outputCol="x", groupCols=["g"], broadcastGroups=10, unknownMean="overall")
    model = imputer.fit(known)
    assert not model.small
    assert model._heavy(rows, "x") == [rows.where(F.col("g") == hot).select(model._group_hash()).first()[0]]
    assert model._heavy(rows.where("false"), "x") == []
    means = {r.g: r.m for r in known.groupBy("g").agg(F.ceil(F.avg("x")).alias("m")).collect()}
    overall = known.agg(F.ceil(F.avg("x"))).first()[0]
    staged_rows, plain = [], impute.staged
    monkeypatch.setattr(impute, "staged", lambda df, name: staged_rows.append(plain(df, name)) or staged_rows[-1])
    filled = model.transform(rows)
    assert {(r.id, r.x) for r in filled.collect()} == {(r.id, means.get(r.g, overall)) for r in rows.collect()}
    (met,) = staged_rows
    assert met.where(F.col("g") == hot).where(F.col(impute.MEAN).isNull()).count() == (1000 if unseen else 0)
    joined = [line for line in filled._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joined

