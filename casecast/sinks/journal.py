"""Scores of the finished points of a search, kept as they come so that a broken search goes on where it stopped."""

import json


class SearchJournal:
    """One model's scores by fold and point, each a small file below `path` on any Hadoop file system.

    A file is written under a hidden name first and renamed, so that none is read half. There are at most as many as the
    folds have points.
    """

    def __init__(self, spark, path):
        self.spark = spark
        self.path = path

    def _hadoop(self, *names):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def add(self, fold, point, params, score):
        name = f"fold-{fold}-point-{point}.json"
        hidden, files = self._hadoop(f"_{name}")
        line = json.dumps({"fold": fold, "point": point, "params": params, "score": score})
        written = files.create(hidden, True)
        written.write(bytearray(f"{line}\n".encode()))
        written.close()
        final, _ = self._hadoop(name)
        if not files.rename(hidden, final) and not files.exists(final):
            raise OSError(f"{hidden} could not be renamed")

    def scores(self, points):
        """Scores by (fold, point) of those whose parameters are the texts `points`."""
        folder, files = self._hadoop()
        if not files.exists(folder):
            return {}
        rows = [json.loads(row.value) for row in self.spark.read.text(self.path).collect()]  # a line per fold and point
        known = dict(enumerate(points))
        return {(r["fold"], r["point"]): r["score"] for r in rows if known.get(r["point"]) == r["params"]}
