"""One file a name, with just the bytes given: a sink that Spark's own writers lack.

Rows are pieces of files. A task writes its files under names of its own; they get their real names once
all tasks have ended well, and a job that fails takes what it wrote away again. Any file system that Arrow knows will do.
"""

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from inkloom.sources.layers import bounded_batches


@dataclass
class Written(WriterCommitMessage):
    """Names, and where they were written to."""

    files: list[tuple[str, str]] = field(default_factory=list)


class PieceWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.unfinished = root.rstrip("/"), f".unfinished-{uuid.uuid4().hex}"

    def store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self.store()
        folder, done, last, out = posixpath.join(root, self.unfinished, uuid.uuid4().hex), Written(), None, None
        store.create_dir(folder, recursive=True)
        for batch in iterator:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if name != last:
                    if out:
                        out.close()
                    last, at = name, posixpath.join(folder, str(len(done.files)))
                    done.files.append((name, at))
                    out = store.open_output_stream(at)
                if data.is_valid:
                    out.write(data.as_buffer())
        if out:
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, root = self.store()
        for name, at in (f for m in messages if m for f in m.files):
            target = posixpath.join(root, name)
            store.create_dir(posixpath.dirname(target), recursive=True)
            store.move(at, target)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = self.store()
        from pyarrow import fs

        unfinished = posixpath.join(root, self.unfinished)
        if store.get_file_info(unfinished).type != fs.FileType.NotFound:
            store.delete_dir(unfinished)


class PieceFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "inkloom_files"

    def writer(self, schema, overwrite: bool) -> PieceWriter:
        return PieceWriter(self.options["path"])


def write_files(pieces: DataFrame, path: str, name: Column, data: Column, *order: str) -> None:
    """A file under path for each name, which may have folders in it: the data of its rows in the given order. A file that is
    there is replaced. Null data adds nothing. All pieces of a file go through one task, one batch after the other."""
    spark = pieces.sparkSession
    spark.dataSource.register(PieceFiles)
    rows = pieces.select(name.alias("name"), data.cast("binary").alias("data"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)])
    places = [f"order_{i}" for i in range(len(order))]
    with bounded_batches(spark):
        rows.filter("name IS NOT NULL").repartition("name").sortWithinPartitions("name", *places).select("name", "data").write.format("inkloom_files").mode("append").save(path)
