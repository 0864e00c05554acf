"""Session for local runs, and the shared scratch folder used to stage tables and checkpoints."""

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(app="casecast", cpus="*", memory="8g", **settings):
    """A session for tests, the bench and the command line; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()


def checkpoint_dir(spark):
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only where the whole of Spark is this process is a fresh local one made, which goes when the process ends.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="casecast-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(CHECKPOINT_SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark, name):
    """A path below the shared folder that no other call has handed out."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df, name):
    """Write `df` once and go on from the files, so that later passes and lost executors never redo what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark, rows, schema):
    """A table of a few driver rows. Going through Arrow makes it a local scan, with no Python worker behind it."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns), schema)
