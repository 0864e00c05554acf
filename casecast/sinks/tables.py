"""Result tables: Parquet, partitioned by run, feature set and model."""

# Written and read with declared schemas, so that partition values are never guessed into other types.
SCHEMAS = {
    "metrics": "dataset string, metric string, value double",
    "confusion": "dataset string, label double, prediction double, n bigint",
    "tuning": "point int, params string, avg_f1 double, std_f1 double, best boolean",
}
PARTITIONS = "run_id string, features string, model string"


def write_part(df, paths, table, model, mode="errorifexists"):
    """Write one model's part of a result table; a part that exists already is an error unless `mode` says otherwise."""
    df.coalesce(1).write.mode(mode).parquet(paths.table_part(table, model))


def read_table(spark, paths, table):
    """A result table over all runs below the base URI."""
    return spark.read.schema(f"{SCHEMAS[table]}, {PARTITIONS}").parquet(paths.table(table))
