"""A ledger in levels that are bucketed by key, so that asking it moves only what asks.

Each update is a level of its own: a table of one row per key, dealt and sorted into the same buckets. What is not done is found by one anti join per
level, for which the work is dealt into the buckets once and no level at all. Levels are merged when the newer ones together reach a
share of the next older one, so that their number grows with the logarithm of the rows and a row is rewritten as often. A list of the levels is
written after them and is what counts: an update that breaks off before leaves the ledger as it was.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import latest
from ..sources.files import LEDGER, _or_empty

LISTED = "level int, path string, n long"


class BucketedLedger:
    """The ledger of one folder, in which a key is one item whatever the stage. buckets must stay as they were first chosen; `share`: newer rows per older row from which on levels merge."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, share: float = 0.5):
        self.spark, self.path, self.buckets, self.share = spark, path.rstrip("/"), buckets, share

    def _listed(self) -> tuple[int, list[tuple[str, int]]]:
        """The number of the last list, and its levels' paths and rows, oldest first."""
        rows = _or_empty(self.spark, f"{self.path}/levels/v=*", f"{LISTED}, v int", lambda: self.spark.read.schema(f"{LISTED}, v int").parquet(f"{self.path}/levels"))
        last = rows.agg(F.max("v")).first()[0]
        return (0, []) if last is None else (last, [(r["path"], r["n"]) for r in rows.where(F.col("v") == last).orderBy("level").collect() if r["path"]])

    def _table(self, path: str) -> DataFrame:
        """A level; the session's catalogue learns of it here, as it keeps the buckets only by name."""
        name = "ledger_" + path.rsplit("/", 1)[1]
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({LEDGER}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        name = uuid.uuid4().hex
        path = f"{self.path}/data/{name}"
        columns = [c.split()[0] for c in LEDGER.split(", ")]
        rows.select(columns).repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(f"ledger_{name}")
        return path, self._table(path).count()

    def _list(self, number: int, levels: list[tuple[str, int]]) -> None:
        rows = [(i, path, n) for i, (path, n) in enumerate(levels)] or [(0, None, 0)]
        self.spark.createDataFrame(rows, LISTED).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/levels/v={number}")

    def levels(self) -> list[DataFrame]:
        """The levels' tables, oldest first."""
        return [self._table(path) for path, _ in self._listed()[1]]

    def not_done(self, work: DataFrame, stage: str | None = None, done: str = "success") -> DataFrame:
        """Work whose key no level holds with the done status."""
        rows = work.repartition(self.buckets, "key")
        for level in self.levels():
            held = level.where(F.col("status") == done)
            held = held if stage is None else held.where(F.col("stage") == stage)
            rows = rows.join(held.select("key").hint("merge"), "key", "left_anti")
        return rows

    def read(self, stage: str | None = None) -> DataFrame:
        """The last row of each key: a level's rows but for those that a newer level has, found in the buckets."""
        levels, whole = self.levels(), self.spark.createDataFrame([], LEDGER)
        for i, level in enumerate(levels):
            for newer in levels[i + 1 :]:
                level = level.join(newer.select("key").hint("merge"), "key", "left_anti")
            whole = whole.unionByName(level)
        return whole if stage is None else whole.where(F.col("stage") == stage)

    def update(self, run: DataFrame) -> None:
        """Adds a run's outcomes, of a key the last one, and merges levels where they have grown alike."""
        number, levels = self._listed()
        made, n = self._write(latest(run))
        if not n:
            return
        levels = [*levels, (made, n)]
        self._list(number + 1, levels)
        newer = n
        start = len(levels) - 1
        while start and newer >= self.share * levels[start - 1][1]:
            start -= 1
            newer += levels[start][1]
        if start < len(levels) - 1:
            merged = None
            tables = [self._table(path) for path, _ in levels[start:]]
            for i, level in enumerate(tables):
                for later in tables[i + 1 :]:
                    level = level.join(later.select("key").hint("merge"), "key", "left_anti")
                merged = level if merged is None else merged.unionByName(level)
            self._list(number + 2, [*levels[:start], self._write(merged)])

    def vacuum(self) -> int:
        """Drops the files of levels that the last list does not name, and older lists; for use when nothing reads. Returns how many levels went."""
        number, levels = self._listed()
        kept = {path.rsplit("/", 1)[1] for path, _ in levels}
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = 0
        for folder, keep in (("data", kept), ("levels", {f"v={number}"})):
            top = fs_path(f"{self.path}/{folder}")
            fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(top) if fs.exists(top) else ():
                name = status.getPath().getName()
                if name not in keep:
                    self.spark.sql(f"DROP TABLE IF EXISTS ledger_{name}") if folder == "data" else None
                    fs.delete(status.getPath(), True)
                    gone += folder == "data"
        return gone
