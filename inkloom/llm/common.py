"""What the operators of this subpackage share.

Conventions, unless an operator's docstring says otherwise:

* a null text counts as the empty text;
* a row whose `doc_id` is null cannot be named by a result that is keyed by
  `doc_id`, so it is left out;
* each row is a document of its own: rows that repeat a `doc_id` each get a row
  of the result. Internally a row is known by (doc_id, hash of its text), so two
  rows alike in both get the same answer and joins never multiply them;
* only the named columns are read; further columns of any name do no harm.
"""

import atexit
import re
import shutil
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python functions travel to the executors by value: no copy of this package has
# to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

# The white space and the letters that all contracts speak of.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# What str.split() takes for white space and the contracts do not.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
WORD = re.compile("[^\x20\x09-\x0d]+")

#: Bytes of one Arrow batch, so that very long texts do not pile up in a worker.
ARROW_BATCH_BYTES = 4 << 20
#: Bytes of the data behind one shard, and what no table has: the planner's estimate where it knows nothing.
SHARD_BYTES, UNKNOWN_BYTES = 128 << 20, 1 << 55


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id (long), text (never null), row_hash; and the named extra columns."""
    limit_batches(docs.sparkSession)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.filter(docs["doc_id"].isNotNull()).select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), *[docs[c] for c in extra]
    )


def with_row_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row_hash", F.xxhash64("text"))


def limit_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def lower_ascii(c: Column | str) -> Column:
    return F.translate(c, UPPER, LOWER)


def shards(spark: SparkSession) -> int:
    """Partitions that data is dealt to; follows the cluster's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shards_for(df: DataFrame) -> int:
    """Partitions so many that one of them has SHARD_BYTES of df at most, by the planner's estimate of its size; at least what
    the cluster's setting says, which is all there is where the planner knows no size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(shards(df.sparkSession), -(-size // SHARD_BYTES) if size < UNKNOWN_BYTES else 1)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a local one, on a single machine only: a cluster's executors would not share it."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="inkloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends here,
    and a lost executor costs no more than what it was just doing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkloom/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables written by this driver and not yet removed.
_written: list[str] = []


def written() -> int:
    """How many tables there are; a mark for forget()."""
    return len(_written)


def forget(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the intermediate tables written after the mark, but for the last `keep`. Results that still need them must have been stored before."""
    end = len(_written) - keep
    for path in _written[since:end]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _written[since:end]


# -- words, on the executors -------------------------------------------------------


def of_worker(key, make):
    """What the tasks of a worker process share under key, made when there is none. A worker outlives its tasks and serves
    other operators next, so it holds one such thing: what another key left is forgotten first."""
    held = sys.__dict__.setdefault("_inkloom_held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def words_of(text: str) -> list[str]:
    """Maximal runs of anything but the six ASCII white-space characters."""
    return WORD.findall(text) if OTHER_SPACE.search(text) else text.split()


class WordHashes(dict):
    """64-bit hashes by word; forgets all when it has LIMIT words, so memory stays bounded."""

    LIMIT = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(hashes: np.ndarray, width: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash for each run of width consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, p = hashes[:n].copy(), np.uint64(factor)
    for k in range(1, width):
        out *= p
        out += hashes[k : k + n]
    return mixed(out)


def smallest_places(hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every run of span hashes the place of the smallest, the first of equals: each such place once, with the first and
    the last start of the runs that have it. Hashes are compared by their upper halves."""
    if len(hashes) < span:
        none = np.zeros(0, np.int64)
        return none, none, none
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    place = (least & low).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], first, np.append(first[1:], len(place)) - 1


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def covered(starts: np.ndarray, counts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of n places covered by windows of width that start at starts, starts+1 ... (counts of them)."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + counts - 1 + width, n), -1)
    return np.cumsum(marks[:-1]) > 0


def with_column(batch: pa.RecordBatch, name: str, values, kind: pa.DataType) -> pa.RecordBatch:
    """batch and one column more. Columns that are only carried stay in Arrow: pandas would make floats of whole numbers with nulls."""
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)], names=[*batch.schema.names, name])


def field_list(df: DataFrame, *without: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in without)
