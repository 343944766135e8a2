"""Target-distribution importance resampling over hashed word runs.

One scan of a document keeps a ring of running CRC states, one for each of the last n
starts: a word extends every state by a space and itself and starts one of its own, and
the states are the hashes of all runs that end at the word. Their buckets are stored, two
bytes a run, and both the counts of the corpus and each document's weight are read from
there. A document's score is its weight and Gumbel noise drawn from its doc_id, so that
the highest scores are a sample without replacement in proportion to the weights.

The draw is over all documents: a histogram of the scores, which are whole numbers of a
bounded range, gives the lowest score drawn; documents of at least that score are sorted
by ranges, and a rank is a place within a range and the sizes of the ranges before.
"""

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import documents, materialize, shards_for

N, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
#: The bytes of words: digits, lower-case letters and all of characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def run_hashes(data: bytes, n: int) -> Iterator[int]:
    """CRC-32 of every run of 1 to n words, joined by a space, in one scan; text in UTF-8. Only A-Z are lower-cased."""
    ring: list[int] = []  # the states of the last starts, the oldest first
    crc32 = zlib.crc32
    for found in WORD.finditer(data.lower()):
        word = found.group()
        if n > 1:
            spaced = b" " + word
            ring = [crc32(spaced, state) for state in ring[-(n - 1) :]]
        else:
            ring = []
        ring.append(crc32(word))
        yield from ring


def n_words(n_features: int, n: int) -> int:
    """How many words have so many runs of 1 to n words."""
    full = n * (n + 1) // 2
    return (n_features + n * (n - 1) // 2) // n if n_features >= full else (math.isqrt(8 * n_features + 1) - 1) // 2


def features(texts: DataFrame, key: str, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """key, n_words, n_features and buckets (binary, little-endian numbers of two or four bytes) of texts (key, text)."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts, out = [], [], []
            for data in batch.column(1):
                own = np.fromiter(run_hashes(data.as_py(), n), np.uint32) % np.uint32(buckets)
                counts.append(len(own)), words.append(n_words(len(own), n)), out.append(own.astype(width).tobytes())
            arrays = [batch.column(0), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_words", "n_features", "buckets"])

    return texts.select(key, F.col("text").cast("binary").alias("text")).mapInArrow(scan, f"`{key}` bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table each bucket has. A task sends one row a bucket, however many documents it has."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), width), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target than in the source, one added to each count."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratios = ((t + 1) * s_all / ((s + 1) * t_all) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(found: DataFrame, key: str, gain: np.ndarray) -> DataFrame:
    """key, n_words, n_features, weight: the mean of the gains of a document's features, rounded down; 0 without any."""
    width = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = (int(gain[np.frombuffer(d.as_buffer(), width)].sum()) for d in batch.column(3))
            weights = [total // n if n else 0 for total, n in zip(sums, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], names=[key, "n_words", "n_features", "weight"])

    return found.mapInArrow(weigh, f"`{key}` bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id, seed: int = SEED):
    """Thousandths of a Gumbel variate by the first 32 bits of a digest of seed and doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document (doc_id, text), by its likeness to the texts of target.

    rank counts from 1 by score, ties by doc_id, and is null for what is not drawn: documents of fewer than least_words
    words, and all beyond the given share of the others. A null text has no words; a row without doc_id is left out, one
    of target counts. Rows that repeat a doc_id are documents of their own, which tie by their number of features.
    Without documents the result is empty; without target texts all buckets weigh by the corpus alone.
    """
    found = materialize(features(documents(docs), "doc_id", n, buckets), "runs")
    wanted = features(target.select(F.lit(0).cast("bigint").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "item", n, buckets)
    scored = weighed(found, "doc_id", gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets)))
    scored = materialize(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")

    # Scores are whole numbers. Gains are logarithms of ratios of counts and the noise has 32 bits, so there are some 100,000 at most.
    able = F.col("n_words") >= least_words
    tally = sorted(((r["score"], r["n"]) for r in scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    left = percent * sum(many for _, many in tally) // 100
    lowest, drawn = (tally[0][0] + 1 if tally else 0), left
    for score, many in tally:
        if left <= 0:
            break
        lowest, left = score, left - many

    high = able & (F.col("score") >= lowest)
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("row").asc()]
    chosen = scored.filter(high).withColumn("row", F.monotonically_increasing_id())  # parts rows that tie in all else
    chosen = chosen.repartitionByRange(shards_for(scored), *order).sortWithinPartitions(*order)
    chosen = materialize(chosen.withColumn("row", F.monotonically_increasing_id()), "drawn").withColumn("part", F.shiftright("row", 33))
    sizes = chosen.groupBy("part").agg(F.count("*").alias("n"))  # a row a range
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.col("row").bitwiseAND((1 << 33) - 1) + F.col("before") + 1
    ranked = chosen.join(F.broadcast(before), "part").withColumn("rank", F.when(rank <= drawn, rank))
    others = scored.filter(~high).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank").unionByName(others.select("doc_id", "n_features", "weight", "score", "rank"))
