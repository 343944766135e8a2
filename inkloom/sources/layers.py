"""Tables that grow by committed batches, and what small helper tables need on a cluster.

A batch is a folder that one write filled; it counts from the moment that Spark's own mark of a
finished job is in it. A write that was stopped leaves a folder that nobody reads. Of the rows of one key
those of the newest batch count, so writing a key again replaces it, and a token names a batch that
must be written once only, however often its writer is run.
"""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a batch of rows in a Python worker, where rows hold audio or whole files.
WORKER_BYTES = 16 << 20


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs send rows to Python workers in batches of a bounded size; the session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(WORKER_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage, in the folder that the cluster names. Only a single machine gets one of its own where none is named."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="inkloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return df.checkpoint()


def starts(rows: DataFrame, group: list[str], order: list[str], size: str) -> DataFrame:
    """rows with start: the sum of size over the rows of their group that come before them. The rows are cut into ranges and
    summed within each; only one sum a range and group is summed in order, so that a group may have any number of rows."""
    ranged = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = checkpointed(ranged.withColumn("range", F.spark_partition_id()))
    so_far = Window.partitionBy("range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range", *group).agg(F.sum(size).alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = ranged.withColumn("own", F.coalesce(F.sum(size).over(so_far), F.lit(0)))
    out = own.join(sums.select("range", *group, before.alias("before")), ["range", *group])
    return out.select(*rows.columns, (F.col("own") + F.col("before")).cast("long").alias("start"))


class Layer:
    """The table in a folder. schema: its columns; keys: the columns by which a newer batch replaces rows; the first
    of them parts a batch's files."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: tuple[str, ...] = ("corpus", "stem")):
        self.spark, self.folder, self.schema, self.keys = spark, folder.rstrip("/"), schema, list(keys)
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.columns = [f.name for f in spark.createDataFrame([], schema).schema]

    def _folders(self) -> list[str]:
        """number-token of every batch, committed or not, in the order of their numbers."""
        if not self.fs.exists(self.path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path(self.folder))]
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))

    def _at(self, batch: str) -> str:
        return f"{self.folder}/batch={batch}"

    def _remove(self, batch: str) -> None:
        self.fs.delete(self.path(self._at(batch)), True)

    def batches(self) -> list[str]:
        return [b for b in self._folders() if self.fs.exists(self.path(self._at(b) + "/_SUCCESS"))]

    def _rows(self) -> DataFrame:
        """All columns and batch, of the newest rows of each key."""
        batches = self.batches()
        if not batches:
            return self.spark.createDataFrame([], f"{self.schema}, batch string")
        rows = self.spark.read.schema(f"{self.schema}, batch string").option("basePath", self.folder).parquet(*map(self._at, batches))
        if len(batches) > 1:  # keys and batches only, not what the rows hold
            seen = rows.select(*self.keys, "batch").distinct()
            newest = seen.groupBy(*self.keys).agg(F.max("batch").alias("newest"))
            stale = seen.join(newest, self.keys).filter("batch < newest").select(*self.keys, "batch")
            rows = rows.join(stale, [*self.keys, "batch"], "left_anti")
        return rows.select(*self.columns, "batch")

    def read(self, batch: str | None = None) -> DataFrame:
        """The table, or what counts of one batch."""
        rows = self._rows()
        return (rows if batch is None else rows.filter(F.col("batch") == batch)).drop("batch")

    def add(self, rows: DataFrame, token: str | None = None) -> str | None:
        """The new batch; None where there are no rows, or a batch of that token is there already."""
        token = token or uuid.uuid4().hex[:12]
        folders = self._folders()
        for old in (b for b in folders if b.split("-", 1)[1] == token):
            if self.fs.exists(self.path(self._at(old) + "/_SUCCESS")):
                return None
            self._remove(old)
        batch = f"{1 + max((int(b.split('-', 1)[0]) for b in folders), default=0):08d}-{token}"
        with bounded_batches(self.spark):
            rows.select(*self.columns).write.mode("errorifexists").partitionBy(self.keys[0]).parquet(self._at(batch))
        if len(self.fs.listStatus(self.path(self._at(batch)))) > 1:
            return batch
        self._remove(batch)
        return None

    def drop(self, gone: DataFrame) -> None:
        """Without the rows of the keys in gone. Batches that have such keys go; what else they hold is committed as a new batch first."""
        gone = checkpointed(gone.select(*self.keys).distinct())  # it may read what goes here
        for batch in self.batches():
            rows = self._rows().filter(F.col("batch") == batch)
            if rows.join(gone, self.keys, "left_semi").isEmpty():
                continue
            self.add(rows.join(gone, self.keys, "left_anti"))
            self._remove(batch)
