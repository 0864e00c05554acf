"""Input and output locations of a run below one base URI of any Hadoop file system."""

import os
from dataclasses import dataclass, field
from datetime import datetime, timezone

# Fixed value: how a run is stamped.
STAMP = "%Y-%m-%d-%H-%M"


def new_run_id():
    return datetime.now(timezone.utc).strftime(STAMP)


def is_written(spark, path):
    """Whether a finished Spark job wrote `path`, on any Hadoop file system."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def _is_new(spark, path):
    """Create an empty file, and whether there was none; of several callers at once one is told so."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getScheme() == "file":  # Hadoop's local files may be created by two at once
        local = mark.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    if files.exists(mark):
        return False
    try:
        files.create(mark, False).close()
    except Exception:  # another one was faster
        if files.exists(mark):
            return False
        raise
    return True


def claim_run(spark, base_uri, features="base", run_id=None):
    """The paths of a run that no other has: its stamp, or with the next free number where runs share a minute.

    The marker is created by the file system, which lets only one of several processes make it.
    """
    stamp, number = run_id or new_run_id(), 1
    while True:
        paths = RunPaths(base_uri, stamp if number == 1 else f"{stamp}-{number}", features)
        if _is_new(spark, paths.claim):
            return paths
        number += 1


@dataclass(frozen=True)
class RunPaths:
    """The folders of one run with one feature set, so that the two feature rounds never share a path."""

    base_uri: str
    run_id: str = field(default_factory=new_run_id)
    features: str = "base"

    @property
    def root(self):
        return f"{self.base_uri.rstrip('/')}/training/{self.run_id}/{self.features}"

    @property
    def claim(self):
        return f"{self.base_uri.rstrip('/')}/training/{self.run_id}/_claimed"

    @property
    def manifest(self):
        return f"{self.root}/manifest"

    @property
    def profiles(self):
        return f"{self.root}/profiles"

    @property
    def preparation(self):
        return f"{self.root}/preparation"

    def model(self, name):
        return f"{self.root}/{name}/model"

    def journal(self, name):
        return f"{self.root}/{name}/search"

    def report(self, name):
        return f"{self.root}/{name}/evaluations"

    def table(self, table):
        """The folder of a result table over all runs."""
        return f"{self.base_uri.rstrip('/')}/tables/{table}"

    def table_part(self, table, model):
        """The part of a result table that belongs to one model of this run."""
        return f"{self.table(table)}/run_id={self.run_id}/features={self.features}/model={model}"
