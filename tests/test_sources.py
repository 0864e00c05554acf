import pytest
from pyspark.sql import types as T

from casecast.schema import CASE_SCHEMA
from casecast.sources import cases_from_orders, read_cases, read_cases_csv, read_cases_parquet


def write(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEADER = ",".join(CASE_SCHEMA.names)
LINE = "F,31,2020-05-01,2020-05-02,NO,SI,x,2020-05-03,Confirmado"


def test_declared_types(edge_cases):
    assert edge_cases.schema == CASE_SCHEMA


def test_columns_are_found_by_name(spark, tmp_path):
    backwards = ",".join(reversed(CASE_SCHEMA.names))
    line = ",".join(reversed(LINE.split(",")))
    path = write(tmp_path, "cases.csv", "provincia," + backwards + ",id", "Salta," + line + ",77")
    row = read_cases_csv(spark, path, types={"id": T.LongType()}).first()
    assert (row.sexo, row.edad, row.clasificacion_resumen, row.provincia, row.id) == ("F", 31, "Confirmado", "Salta", 77)


def test_other_separator_and_inference(spark, tmp_path):
    path = write(tmp_path, "cases.csv", HEADER.replace(",", ";"), LINE.replace(",", ";"))
    declared, inferred = read_cases_csv(spark, path, sep=";"), read_cases_csv(spark, path, sep=";", infer=True)
    assert declared.schema == inferred.schema
    assert declared.collect() == inferred.collect()


def test_missing_column(spark, tmp_path):
    with pytest.raises(ValueError, match="clasificacion_resumen"):
        read_cases_csv(spark, write(tmp_path, "cases.csv", "sexo,edad", "F,31"))


def test_file_with_another_header_fails(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, LINE)
    write(tmp_path, "b.csv", HEADER.replace("sexo,edad", "edad,sexo"), LINE.replace("F,31", "31,F"))
    with pytest.raises(Exception, match="(?i)header"):
        read_cases_csv(spark, str(tmp_path)).collect()


def test_dirty_lines(spark, tmp_path):
    path = write(tmp_path, "cases.csv", HEADER, LINE, LINE.replace("31", "many"))
    assert [row.edad for row in read_cases_csv(spark, path).collect()] == [31, None]
    kept = read_cases_csv(spark, path, corrupt_column="bad").collect()
    assert [row.bad is None for row in kept] == [True, False]
    assert len(read_cases_csv(spark, path, mode="DROPMALFORMED").collect()) == 1
    with pytest.raises(Exception):
        read_cases_csv(spark, path, mode="FAILFAST").collect()


def test_files_with_other_headers_are_read_by_name_with_a_corrupt_column(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, LINE, LINE.replace("31", "many"))
    write(tmp_path, "b.csv", HEADER.replace("sexo,edad", "edad,sexo"), LINE.replace("F,31", "32,M"))
    (tmp_path / "empty.csv").write_text("")
    rows = read_cases_csv(spark, str(tmp_path), corrupt_column="bad").collect()
    found = {(row.sexo, row.edad, row.cuidado_intensivo, row.bad is None) for row in rows}
    assert found == {("F", 31, "NO", True), ("F", None, "NO", False), ("M", 32, "NO", True)} and len(rows) == 3
    write(tmp_path, "c.csv", "sexo,edad", "F,31")
    with pytest.raises(ValueError, match="c.csv lacks"):
        read_cases_csv(spark, str(tmp_path), corrupt_column="bad")


SWAPPED = HEADER.replace("sexo,edad", "edad,sexo")
SWAPPED_LINE = LINE.replace("F,31", "32,M")


def test_files_with_other_headers_are_read_by_name_when_inferring(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER + ",id,grade", LINE + ",7,1", LINE + ",8,2")
    write(tmp_path, "b.csv", "", "id," + SWAPPED + ",grade", "9," + SWAPPED_LINE + ",x")
    write(tmp_path, "c.csv", SWAPPED, SWAPPED_LINE)
    (tmp_path / "empty.csv").write_text("")
    cases = read_cases_csv(spark, str(tmp_path), infer=True)
    assert dict(cases.dtypes)["id"] == "int" and dict(cases.dtypes)["grade"] == "string" and dict(cases.dtypes)["edad"] == "int"
    rows = {(r.sexo, r.edad, r.cuidado_intensivo, r.id, r.grade) for r in cases.collect()}
    assert rows == {("F", 31, "NO", 7, "1"), ("F", 31, "NO", 8, "2"), ("M", 32, "NO", 9, "x"), ("M", 32, "NO", None, None)}
    write(tmp_path, "d.csv", "sexo,edad", "F,31")
    with pytest.raises(ValueError, match="d.csv lacks"):
        read_cases_csv(spark, str(tmp_path), infer=True)


def test_inference_keeps_named_types_and_corrupt_lines(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER + ",id", LINE + ",7", LINE + ",8,too,many")
    write(tmp_path, "b.csv", "id," + SWAPPED, "9," + SWAPPED_LINE)
    cases = read_cases_csv(spark, str(tmp_path), infer=True, corrupt_column="bad", types={"id": T.StringType()})
    assert cases.columns[-1] == "bad" and dict(cases.dtypes)["id"] == "string"
    assert {(r.sexo, r.edad, r.id, r.bad is None) for r in cases.collect()} >= {("F", 31, "7", True), ("M", 32, "9", True)}


def test_inferred_types_are_widened():
    from casecast.sources.cases import _wider

    assert _wider(T.IntegerType(), T.LongType()) == _wider(T.LongType(), T.IntegerType()) == T.LongType()
    assert _wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert _wider(T.DateType(), T.IntegerType()) == _wider(T.StringType(), T.DoubleType()) == T.StringType()


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    from casecast.sources.cases import header_catalogue

    for i in range(40):
        write(tmp_path, f"{i:02}.csv", SWAPPED if i % 4 == 0 else HEADER, LINE, *[LINE] * (20_000 if i == 1 else 0))
    spark.sparkContext.setJobGroup("headers", "headers")
    files = header_catalogue(spark, str(tmp_path))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {names[:2]: len(own) for names, own in files.items()} == {("sexo", "edad"): 30, ("edad", "sexo"): 10}
    assert len(jobs) <= 1 + 2 * len(files)


def test_no_file_has_a_line(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="header line"):
        read_cases_csv(spark, str(tmp_path), infer=True)


def test_parquet_staging(spark, edge_cases, tmp_path):
    path = str(tmp_path / "cases.parquet")
    edge_cases.write.parquet(path)
    assert sorted(map(str, read_cases(spark, path, "parquet").collect())) == sorted(map(str, edge_cases.collect()))
    edge_cases.select("sexo").write.parquet(path + "2")
    with pytest.raises(ValueError, match="edad"):
        read_cases_parquet(spark, path + "2")
    with pytest.raises(ValueError, match="xml"):
        read_cases(spark, path, "xml")


def test_cases_over_orders(spark, sf_dir):
    assert cases_from_orders(spark, sf_dir).count() == 1500
