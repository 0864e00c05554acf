"""Scans of case files under any Hadoop URI."""

from functools import reduce

import pyarrow as pa
from pyspark.sql import types as T

from casecast.schema import CASE_SCHEMA

#: No file is split for its header: as many bytes are one partition, and opening a file counts as much.
WHOLE_FILE = 1 << 42
#: Types that hold the values of both, where Spark infers two types for one column.
WIDER = [
    (T.IntegerType(), T.LongType()),
    (T.IntegerType(), T.DoubleType()),
    (T.LongType(), T.DoubleType()),
    (T.DateType(), T.TimestampType()),
]


def read_cases_csv(spark, path, *, sep=",", infer=False, mode="PERMISSIVE", corrupt_column=None, types=None):
    """Scan delimited case files that have a header line.

    The nine case columns get their declared types and every other column of the header stays a string, so no pass
    over the data is spent on inference. Columns are found by name: only the header line of one file is read to learn
    their order, and any file whose header differs fails the scan instead of shifting its values. `types` declares
    further columns, such as the key. `infer=True` lets Spark guess all types at the price of a full extra pass.
    `mode` and `corrupt_column` say what happens to lines that do not parse.

    With inference or a corrupt column Spark does not compare headers, so one job first reads those of all files
    (`header_catalogue`), and files are read by their own: columns in another order are found by name, and columns
    that a file lacks are null, unless it is a case column, which is an error. Where files infer different types, the wider one is
    taken, or string if neither is. Files without a line are left out.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", mode)
    declared = {field.name: field.dataType for field in CASE_SCHEMA.fields} | (types or {})
    needed = list(declared) if types or not infer else CASE_SCHEMA.names

    def typed(names, known=declared):
        return T.StructType([T.StructField(name, known.get(name, T.StringType())) for name in names])

    if not infer and not corrupt_column:
        header = reader.csv(path).columns
        _check_columns(path, header, needed)
        return reader.option("enforceSchema", False).schema(typed(header)).csv(path)
    files = header_catalogue(spark, path, sep)
    if not files:
        raise ValueError(f"no file under {path} has a header line")
    for names, own in files.items():
        _check_columns(own[0], names, needed)
    known = declared
    if infer:
        known = _inferred(reader, path, files) | (types or {})
    if len(files) == 1 and not corrupt_column:
        (names,) = files
        return reader.schema(typed(names, known)).csv(path)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    # The extra column is not part of any header, so Spark's own check has to be off for it.
    extra = [T.StructField(corrupt_column, T.StringType())] if corrupt_column else []
    tables = [reader.schema(T.StructType(typed(names, known).fields + extra)).csv(own) for names, own in files.items()]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return whole.select(*[name for name in whole.columns if name != corrupt_column], *[f.name for f in extra])


def _check_columns(path, header, needed):
    missing = [name for name in needed if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")


def _inferred(reader, path, files):
    """The type of each column over all files: that which Spark infers, one pass over each group of equal headers."""
    found = {}
    for own in files.values():
        schema = reader.option("inferSchema", True).csv(path if len(files) == 1 else own).schema
        for field in schema.fields:
            found[field.name] = _wider(found.get(field.name, field.dataType), field.dataType)
    return found


def _wider(a, b):
    if a == b:
        return a
    return next((wide for narrow, wide in WIDER if {narrow, wide} == {a, b}), T.StringType())


def _first_lines(batches):
    """The first line that is not blank of the one file of a partition; what follows is not waited for."""
    for batch in batches:
        for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if line.strip():
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([line])], ["file", "line"])
                return


def header_catalogue(spark, path, sep=","):
    """{column names: files} of all files under `path` that have a line, from one job that reads only how each begins.

    A session of its own makes every file one partition, and its task ends with the first line. The driver gets a line
    for each file, of which it has the list for any scan, and Spark parses one header of each kind.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", WHOLE_FILE)
    own.conf.set("spark.sql.files.openCostInBytes", WHOLE_FILE)
    own.conf.set("spark.sql.files.maxPartitionNum", 2**31 - 1)
    lines = own.read.text(path).selectExpr("_metadata.file_path AS file", "value AS line")
    by_line = {}
    for row in lines.mapInArrow(_first_lines, "file string, line string").collect():
        by_line.setdefault(row.line, []).append(row.file)
    files = {}
    for _, met in sorted(by_line.items()):
        names = spark.read.option("header", True).option("sep", sep).csv(min(met)).columns
        files.setdefault(tuple(names), []).extend(met)
    return {names: sorted(met) for names, met in files.items()}


def read_cases_parquet(spark, path):
    """Scan case files staged as Parquet; filters and the column list reach the scan."""
    cases = spark.read.parquet(path)
    missing = [name for name in CASE_SCHEMA.names if name not in cases.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return cases


def read_cases(spark, path, format="csv", **options):
    if format == "csv":
        return read_cases_csv(spark, path, **options)
    if format == "parquet":
        return read_cases_parquet(spark, path)
    raise ValueError(f"unknown case file format {format!r}")
