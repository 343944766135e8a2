"""New documents as they come: the same transformations over a stream of files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkloom.sources.files import stem
from inkloom.sources.layers import Layer


def watch_texts(spark: SparkSession, path: str, suffix: str = ".md") -> DataFrame:
    """name, stem, text of the files of one folder, also of those still to come. Bytes that are no UTF-8 are an error."""
    found = spark.readStream.text(path, wholetext=True, pathGlobFilter=f"*{suffix}")
    name = F.col("_metadata.file_name")
    return found.select(name.alias("name"), stem(name).alias("stem"), F.validate_utf8("value").alias("text"))


def process_new(texts: DataFrame, transform: Callable[[DataFrame], DataFrame], out: Layer, checkpoint: str, source: str = "stream") -> StreamingQuery:
    """Whatever is new since the last run, once, as batches of the layer out, from which the chain takes it. The checkpoint
    says what is done; a batch that comes again after a failure is known by its number, and by source where several
    streams feed a layer: once it is committed, nothing is written anew."""

    def write(batch: DataFrame, number: int) -> None:
        out.add(transform(batch), f"{source}-{number}")

    return texts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
