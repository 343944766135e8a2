"""Exact dedup over a log-structured merge index of digests.

Each task gathers digests in a memtable of bounded size. A full memtable is
flushed as a sorted run, cut into a few coarse segments by the first bits of the digest. The
first compaction merges the segments of several runs, as many as it takes that what it cuts for each
fine shard has SEGMENT_ROWS digests or so, however many shards there are; so the number of segments grows with the rows and
not with their square. The second merges the segments of a shard. Each segment has a Bloom
filter: a key that no other segment's filter knows is passed on as it is, the rest are merged
and the best identifier of each digest stays. Rows that share a digest are hits, and their bytes are compared.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import WHITE_SPACE, documents, materialize, shards, with_row_hash

MEMTABLE_ROWS = 65_536
#: Rows behind one shard of the index; the number of shards follows the rows.
SHARD_ROWS = 500_000
#: Digests that a segment should have at least, runs that are merged at least, and digests of one merge at most.
SEGMENT_ROWS, LEAST_RUNS, MERGE_ROWS = 1024, 4, 500_000
FILTER_BITS_PER_KEY = 10
FILTER_HASHES = 4


def normalised(text: Column | str) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def sha256_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


# -- the filter ------------------------------------------------------------------


def filter_slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """FILTER_HASHES bit numbers for each 64-bit key."""
    a = keys * np.uint64(0x9E3779B97F4A7C15)
    b = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    steps = np.arange(FILTER_HASHES, dtype=np.uint64)[:, None]
    return ((a + steps * b) >> np.uint64(20)) % np.uint64(bits)


def filter_of(keys: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, bool)
    flags[filter_slots(keys, bits).ravel()] = True
    return np.packbits(flags)


def filter_has(packed: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    return np.unpackbits(packed, count=bits).astype(bool)[filter_slots(keys, bits)].all(axis=0)


def key64(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests), dtype=">u8").astype(np.uint64)


# -- flush and compaction ---------------------------------------------------------


def better(a: tuple[int, int], b: tuple[int, int]) -> bool:
    """Whether row a = (code points, doc_id) stays rather than b."""
    return (-a[0], a[1]) < (-b[0], b[1])


#: n, ids and rows belong to the digests one by one.
SEGMENT = "run bigint, shard int, digests array<binary>, n array<bigint>, ids array<bigint>, rows array<bigint>, filter binary"
COLUMNS = ["run", "shard", "digests", "n", "ids", "rows", "filter"]


@dataclass(frozen=True)
class Levels:
    """How an index of n_shards shards is cut: runs merged together, the coarse shards of a run, and bits of a segment's filter."""

    n_shards: int
    memtable_rows: int

    @property
    def runs(self) -> int:
        return max(LEAST_RUNS, -(-self.n_shards * SEGMENT_ROWS // self.memtable_rows))

    @property
    def coarse(self) -> int:
        return max(1, min(self.n_shards, -(-self.runs * self.memtable_rows // MERGE_ROWS)))

    def bits(self, shards: int, runs: int) -> int:
        return max(64, runs * self.memtable_rows // shards * FILTER_BITS_PER_KEY)


def shard_at(hashed: np.ndarray, n: int) -> np.ndarray:
    """The shard of n by a key's first bits: neighbouring digests are neighbours."""
    return (((hashed >> np.uint64(48)) * np.uint64(n)) >> np.uint64(16)).astype(np.int64)


def segments(run: int, best: dict[bytes, tuple[int, int, int]], n_shards: int, bits: int) -> pd.DataFrame:
    """A sorted run of (n, doc_id, rows) by digest, cut by shards."""
    keys = sorted(best)
    hashed = key64(keys)
    at = shard_at(hashed, n_shards)
    cuts = np.flatnonzero(np.diff(at, prepend=-1))
    rows = []
    for lo, hi in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        part = keys[lo:hi]
        own = np.array([best[k] for k in part], np.int64)
        rows.append((run, int(at[lo]), part, own[:, 0].tolist(), own[:, 1].tolist(), own[:, 2].tolist(), filter_of(hashed[lo:hi], bits).tobytes()))
    return pd.DataFrame(rows, columns=COLUMNS)


def put(best: dict, digest: bytes, n: int, doc_id: int, rows: int) -> None:
    old = best.get(digest)
    best[digest] = (n, doc_id, rows) if old is None else (*((n, doc_id) if better((n, doc_id), old[:2]) else old[:2]), old[2] + rows)


def flusher(levels: Levels) -> Callable:
    bits = levels.bits(levels.coarse, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memtable: dict[bytes, tuple[int, int, int]] = {}
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for digest, n, doc_id in zip(batch["digest"], batch["n"], batch["doc_id"], strict=True):
                put(memtable, bytes(digest), n, doc_id, 1)
                if len(memtable) >= levels.memtable_rows:
                    yield segments(number, memtable, levels.coarse, bits)
                    memtable, number = {}, number + 1
        if memtable:
            yield segments(number, memtable, levels.coarse, bits)

    return run


def merge(held: list, bits: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(digest, n, doc_id, rows) of segments: what only one of their filters knows first, then what is merged."""
    filters = [np.frombuffer(s[-1], np.uint8) for s in held]
    before = [np.zeros_like(filters[0])]
    for f in filters[:-1]:
        before.append(before[-1] | f)
    after = np.zeros_like(filters[0])
    merged: dict[bytes, tuple[int, int, int]] = {}
    for i in reversed(range(len(held))):
        digests, ns, ids, rows, _ = held[i]
        keys = [bytes(d) for d in digests]
        known = filter_has(before[i] | after, key64(keys), bits)
        after = after | filters[i]
        for d, n, doc_id, k, maybe in zip(keys, ns, ids, rows, known, strict=True):
            if maybe:
                put(merged, d, n, doc_id, k)
            else:
                yield d, n, doc_id, k
    for d, best in merged.items():
        yield d, *best


def gathered(batches: Iterator[pd.DataFrame], keys: list[str]) -> dict[tuple, list]:
    held: dict[tuple, list] = {}
    for batch in batches:
        for key, segment in zip(batch[keys].itertuples(index=False, name=None), batch[COLUMNS[2:]].itertuples(index=False, name=None), strict=True):
            held.setdefault(key, []).append(segment)
    return held


def first_compactor(levels: Levels) -> Callable:
    """Segments of a group of runs and a coarse shard as one run, cut by the fine shards."""
    bits, fine = levels.bits(levels.coarse, 1), levels.bits(levels.n_shards, levels.runs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = gathered(batches, ["group", "shard"])
        for group, shard in list(held):
            best = {d: own for d, *own in merge(held.pop((group, shard)), bits)}
            yield segments(group, best, levels.n_shards, fine)

    return run


def last_compactor(levels: Levels) -> Callable:
    fine = levels.bits(levels.n_shards, levels.runs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = gathered(batches, ["shard"])
        for shard in list(held):
            digests, _, ids, rows = zip(*merge(held.pop(shard), fine), strict=True)
            yield pd.DataFrame({"digest": digests, "keep_id": ids, "group_size": rows})

    return run


def shards_of(rows: DataFrame) -> int:
    """Shards for a stored table of digests: SHARD_ROWS rows each, at least what the cluster's setting says."""
    return max(shards(rows.sparkSession), -(-rows.count() // SHARD_ROWS))


def digest_runs(rows: DataFrame, n_shards: int, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """Sorted runs of (digest, n, doc_id) rows, a coarse segment a row."""
    return rows.mapInPandas(flusher(Levels(n_shards, memtable_rows)), SEGMENT)


def merged_runs(runs: DataFrame, n_shards: int, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """The stored runs, merged by groups of several: a fine segment a row."""
    levels = Levels(n_shards, memtable_rows)
    groups = max(1, -(-runs.select("run").distinct().count() // levels.runs))
    dealt = runs.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(groups))).repartition(min(groups * levels.coarse, n_shards), "group", "shard")
    return dealt.mapInPandas(first_compactor(levels), SEGMENT)


def compacted(merged: DataFrame, n_shards: int, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """The merged index: digest, keep_id, group_size. Merged runs of several inputs, made for as many shards, may be united first."""
    return merged.repartition(n_shards, "shard").mapInPandas(last_compactor(Levels(n_shards, memtable_rows)), "digest binary, keep_id bigint, group_size bigint")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept for every row of docs (doc_id, text).

    Texts are equal when identical without white space. Of equal texts the one with
    the most code points, then the smallest doc_id, stays. Null and blank texts are
    equal to one another. Rows that repeat both doc_id and text are all kept when
    theirs is the doc_id that stays. An empty table gives an empty result. digest
    may be weak: rows whose digest collides are told apart by their bytes.
    """
    d = with_row_hash(documents(docs))
    norm = normalised("text")
    rows = materialize(d.select("doc_id", "row_hash", F.length("text").cast("long").alias("n"), digest(norm).alias("digest")), "digests")
    n_shards = shards_of(rows)
    runs = materialize(digest_runs(rows.drop("row_hash"), n_shards, memtable_rows), "runs")
    merged = materialize(merged_runs(runs, n_shards, memtable_rows), "merged-runs")
    index = materialize(compacted(merged, n_shards, memtable_rows), "index")
    found = rows.join(index.hint("merge"), "digest")

    # The bytes of all rows of a digest are the same where their least and their greatest text are.
    hits = found.filter("group_size > 1").select("doc_id", "row_hash", "n", "digest").distinct()
    texts = d.join(hits.hint("merge"), ["doc_id", "row_hash"]).select("doc_id", "row_hash", "n", "digest", norm.alias("norm"))
    spread = texts.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    collided = materialize(spread.filter("least != greatest").select("digest"), "collided")
    plain = found.select("digest", "doc_id", "keep_id", "group_size")
    if not collided.isEmpty():
        apart = materialize(texts.join(collided, "digest"), "collided-texts")
        best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").alias("id")))["id"]
        own = apart.groupBy("digest", "norm").agg(best.alias("own_id"), F.count("*").alias("own_size"))
        own = apart.select("digest", "doc_id", "row_hash", "norm").distinct().join(own, ["digest", "norm"]).drop("norm")
        found = found.join(own, ["digest", "doc_id", "row_hash"], "left")
        plain = found.select("digest", "doc_id", F.coalesce("own_id", "keep_id").alias("keep_id"), F.coalesce("own_size", "group_size").alias("group_size"))
    return plain.select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "digest")
