"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

The exact side of the index is a table of references (key, doc_id), each pair once, and
the table of common keys that follows from it: the number of documents and the largest
doc_id of each key whose count has reached the threshold. Each shard of keys has a cuckoo
filter that holds its common keys. Documents enter and leave: a key that reaches the
threshold is inserted in its shard's filter, one that falls below is deleted from it, so
lines come back when the documents that made them common are gone. An update writes and counts only what it
changes: references that come are stored beside those that are there, and only keys that a document brought
or took are counted again. A line that its
shard's filter does not know needs no look at the exact table. Filters go to the lines
where all of them are at most FILTER_BYTES; beyond, lines and filters meet by shard.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.llm.common import WHITE_SPACE, documents, lower_ascii, materialize, shards_for

MIN_CODE_POINTS = 20
MIN_DOCUMENTS = 3
#: Bytes of all filters up to which each task gets them.
FILTER_BYTES = 32 << 20
#: Documents of one line that meet in one task where they are dealt by shard: so many more copies of the filters are made.
SALT_DOCUMENTS = 500_000
SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a fingerprint has two buckets, and either can be found from the other."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        buckets = 1
        while buckets * SLOTS * 0.8 < max(1, capacity):
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table.copy()

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        return cls(1, np.frombuffer(data, np.uint16).reshape(-1, SLOTS))

    def dump(self) -> bytes:
        return self.table.tobytes()

    @staticmethod
    def hashes(keys: list[bytes] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of keys of 16 bytes: a list, or rows of two whole numbers."""
        raw = keys if isinstance(keys, np.ndarray) else np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
        prints = (raw[:, 1] >> np.uint64(48)).astype(np.uint16)
        return raw[:, 0].copy(), np.where(prints == 0, np.uint16(1), prints)

    def places(self, hashed: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        one = hashed & mask
        return one, self.other(one, prints)

    def other(self, place, prints):
        mask = np.uint64(len(self.table) - 1)
        return (place ^ ((prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & mask)) & mask

    def contains(self, keys: list[bytes] | np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        hashed, prints = self.hashes(keys)
        one, two = self.places(hashed, prints)
        return (self.table[one.astype(np.int64)] == prints[:, None]).any(1) | (self.table[two.astype(np.int64)] == prints[:, None]).any(1)

    def insert(self, keys: list[bytes]) -> bool:
        """False when a key finds no place: the caller builds a larger filter."""
        if not keys:
            return True
        hashed, prints = self.hashes(keys)
        one, two = self.places(hashed, prints)
        random = np.random.default_rng(1)
        for place, second, p in zip(one, two, prints, strict=True):
            for at in (place, second):
                free = np.flatnonzero(self.table[int(at)] == 0)
                if len(free):
                    self.table[int(at), free[0]] = p
                    break
            else:
                at = second
                for _ in range(MAX_KICKS):
                    slot = int(random.integers(SLOTS))
                    p, self.table[int(at), slot] = self.table[int(at), slot], p
                    at = self.other(at, np.uint16(p))
                    free = np.flatnonzero(self.table[int(at)] == 0)
                    if len(free):
                        self.table[int(at), free[0]] = p
                        break
                else:
                    return False
        return True

    def delete(self, keys: list[bytes]) -> None:
        if not keys:
            return
        hashed, prints = self.hashes(keys)
        for place, second, p in zip(*self.places(hashed, prints), prints, strict=True):
            for at in (place, second):
                held = np.flatnonzero(self.table[int(at)] == p)
                if len(held):
                    self.table[int(at), held[0]] = 0
                    break


def built_filter(keys: list[bytes]) -> CuckooFilter:
    capacity = len(keys)
    while not (made := CuckooFilter(capacity)).insert(keys):
        capacity = 2 * capacity + SLOTS
    return made


@dataclass
class LineIndex:
    """references: key, doc_id, each pair once; common: key, n_docs, last_id; filters: shard, data."""

    references: DataFrame
    common: DataFrame
    filters: DataFrame
    n_shards: int
    min_documents: int

    def stored(self) -> "LineIndex":
        """The same with one table of references, for an index that has seen many updates, each of which adds a part to its plan."""
        return LineIndex(materialize(self.references, "line-references"), self.common, self.filters, self.n_shards, self.min_documents)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE_SPACE)))


def key_digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


def text_lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def line_references(docs: DataFrame) -> DataFrame:
    """key, doc_id of the lines that are long enough, once a row of docs."""
    keys = F.filter(F.transform(text_lines("text"), line_key), lambda k: F.length(k) >= MIN_CODE_POINTS)
    return docs.select("doc_id", F.explode(F.array_distinct(keys)).alias("k")).select(key_digest(F.col("k")).alias("key"), "doc_id")


def distinct_references(docs: DataFrame) -> DataFrame:
    """Once a document: only those of rows that repeat a doc_id have to be compared, and mostly there are none."""
    own = line_references(docs)
    many = materialize(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if many.isEmpty():
        return own
    return own.join(many, "doc_id", "left_anti").unionByName(own.join(many, "doc_id", "left_semi").dropDuplicates(["key", "doc_id"])).select("key", "doc_id")


def common_keys(references: DataFrame, min_documents: int) -> DataFrame:
    """The reference counts that reach the threshold; added up within each task before anything moves."""
    counts = references.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id"))
    return counts.filter(F.col("n_docs") >= min_documents)


def shard_of(n: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int").alias("shard")


def build_filters(common: DataFrame, n_shards: int) -> DataFrame:
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, key in zip(batch["shard"], batch["key"], strict=True):
                held.setdefault(shard, []).append(bytes(key))
        for shard, keys in held.items():
            yield pd.DataFrame({"shard": [shard], "data": [built_filter(keys).dump()]})

    return common.select(shard_of(n_shards), "key").repartition(n_shards, "shard").mapInPandas(build, "shard int, data binary")


def build_index(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> LineIndex:
    """The index of docs (doc_id, text). Rows that repeat a doc_id are one document; null and empty texts have no long line, a row
    without doc_id is left out, and an empty table gives an index that knows no line."""
    d = documents(docs)
    n = shards_for(d)
    references = materialize(distinct_references(d), "line-references")
    common = materialize(common_keys(references, min_documents), "common-lines")
    return LineIndex(references, common, materialize(build_filters(common, n), "line-filters"), n, min_documents)


def updated(index: LineIndex, references: DataFrame, changed: DataFrame) -> LineIndex:
    """The index with these references, of which only those of the changed keys (key) are counted: keys that crossed the
    threshold touch a filter, all others stay as they were."""
    changed = materialize(changed.distinct(), "changed-lines")
    recounted = materialize(common_keys(references.join(changed, "key", "left_semi"), index.min_documents), "recounted-lines")
    common = materialize(index.common.join(changed, "key", "left_anti").unionByName(recounted), "common-lines")
    old = index.common.join(changed, "key", "left_semi").select("key", F.lit(1).alias("was"))
    crossed = old.join(recounted.select("key", F.lit(1).alias("now")), "key", "full").filter("was is null or now is null")
    crossed = crossed.select(shard_of(index.n_shards), "key", F.col("now").isNotNull().alias("enters"))

    def apply(key, held: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.load(bytes(held["data"].iloc[0])) if len(held) else CuckooFilter(2 * len(moved))
        f.delete([bytes(k) for k in moved["key"][~moved["enters"].astype(bool)]])
        if not f.insert([bytes(k) for k in moved["key"][moved["enters"].astype(bool)]]):
            return pd.DataFrame({"shard": [int(key[0])], "data": [None]})
        return pd.DataFrame({"shard": [int(key[0])], "data": [f.dump()]})

    filters = materialize(index.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(apply, "shard int, data binary"), "line-filters")
    if not filters.filter("data is null").isEmpty():  # a filter is full: build anew
        filters = materialize(build_filters(common, index.n_shards), "line-filters")
    return LineIndex(references, common, filters, index.n_shards, index.min_documents)


def insert_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """With the documents of docs too; one that the index has already counts once. Only new references are written."""
    own = materialize(line_references(documents(docs)).dropDuplicates(["key", "doc_id"]), "line-references")
    held = index.references.join(own.select("doc_id").distinct(), "doc_id", "left_semi")  # of documents that come again
    fresh = materialize(own.join(held, ["key", "doc_id"], "left_anti"), "line-references")
    return updated(index, index.references.unionByName(fresh), fresh.select("key"))


def delete_documents(index: LineIndex, ids: DataFrame) -> LineIndex:
    """Without the documents whose doc_id is in ids. Nothing but their keys is read of the table of references, which stays."""
    ids = materialize(ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "deleted-ids")
    gone = index.references.join(ids, "doc_id", "left_semi")
    return updated(index, index.references.join(ids, "doc_id", "left_anti").select("key", "doc_id"), gone.select("key"))


def probed(references: DataFrame, index: LineIndex) -> DataFrame:
    """The references whose key its shard's filter knows."""
    size = index.filters.agg(F.sum(F.length("data"))).first()[0] or 0
    return probed_in_place(references, index) if size <= FILTER_BYTES else probed_by_shard(references, index)


def probed_in_place(references: DataFrame, index: LineIndex) -> DataFrame:
    """Filters of at most FILTER_BYTES go to the lines: no line moves before it is known to be common."""
    filters = references.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in index.filters.collect()})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {shard: CuckooFilter.load(data) for shard, data in filters.value.items()}
        for batch in batches:
            shard, keys = batch.column("shard").to_numpy(), raw_keys(batch.column("key"))
            keep = np.zeros(len(batch), bool)
            order = np.argsort(shard, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(at) and (held := loaded.get(int(shard[at[0]]))) is not None:
                    keep[at] = held.contains(keys[at])
            yield batch.filter(pa.array(keep)).select(["key", "doc_id"])

    return references.select(shard_of(index.n_shards), "key", "doc_id").mapInArrow(probe, "key binary, doc_id bigint")


def raw_keys(column: pa.Array) -> np.ndarray:
    """Rows of two whole numbers, from keys of 16 bytes."""
    data = column.cast(pa.binary(16)).buffers()[1] if len(column) else b""
    return np.frombuffer(data, "<u8").reshape(-1, 2)[column.offset : column.offset + len(column)]


def probed_by_shard(references: DataFrame, index: LineIndex) -> DataFrame:
    """Filter and lines of a shard meet in as many tasks as the most common line needs; the filter's row sorts first."""
    n = index.n_shards
    salts = 1 + (index.common.agg(F.max("n_docs")).first()[0] or 0) // SALT_DOCUMENTS
    lines = references.select(shard_of(n), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", F.lit(None).cast("binary").alias("data"))
    zero = F.lit(0).cast("long")  # a null would make pandas read the column as floats
    filters = index.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), zero.alias("doc_id"), "data")

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, None
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            kinds, at = batch["kind"].to_numpy(), batch["shard"].to_numpy()
            edges = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (kinds == 0))
            for lo, hi in zip(edges, [*edges[1:], len(batch)], strict=True):
                if kinds[lo] == 0:
                    shard, held = at[lo], CuckooFilter.load(bytes(batch["data"].iloc[lo]))
                    lo += 1
                if held is not None and hi > lo and shard == at[lo]:
                    keep[lo:hi] = held.contains([bytes(k) for k in batch["key"].iloc[lo:hi]])
            yield batch.loc[keep, ["key", "doc_id"]]

    dealt = lines.unionByName(filters).repartition(n, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInPandas(probe, "key binary, doc_id bigint")


def drop_repeated_lines(docs: DataFrame, index: LineIndex, indexed: bool = False) -> DataFrame:
    """doc_id, text and the other columns of docs, n_lines, n_dropped.

    indexed says that the index is of just these docs: then their lines are not cut and hashed anew to ask it.

    Lines end at \\n; a null or empty text is one empty line. A line's key is the line
    without white space at its ends, A-Z lower-cased. A key of at least 20 code points
    that is in at least index.min_documents documents loses its lines everywhere but in
    the largest doc_id that holds it. Rows that repeat a doc_id are one document, of which
    each row keeps its own text: they count once, and all or none of them lose a line. Rows
    without any dropped line keep their text, null included; a null doc_id cannot be named
    and goes. An empty table gives an empty result. Other columns may have any names but
    n_lines and n_dropped, which are replaced.
    """
    own = probed(index.references if indexed else line_references(documents(docs)), index)
    dropped = own.join(index.common.hint("merge"), "key").filter(F.col("doc_id") < F.col("last_id"))
    dropped = dropped.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    carried = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_dropped")]
    d = docs.filter(docs["doc_id"].isNotNull())
    d = d.select(d["doc_id"].cast("long").alias("doc_id"), d["text"].cast("string").alias("text"), F.struct(F.lit(0).alias("-"), *[d[c] for c in carried]).alias("carried"))
    full = F.coalesce(F.col("text"), F.lit(""))
    stays = F.filter(text_lines(full), lambda x: ~F.array_contains("keys", key_digest(line_key(x))))
    both = d.join(dropped, "doc_id", "left").withColumn("n_lines", F.size(text_lines(full)).cast("long")).withColumn("stays", F.when(F.col("keys").isNotNull(), stays))
    cut = F.col("stays").isNotNull()
    made = {
        "doc_id": F.col("doc_id"),
        "text": F.when(cut, F.array_join("stays", "\n")).otherwise(F.col("text")),
        "n_lines": F.col("n_lines"),
        "n_dropped": F.when(cut, F.col("n_lines") - F.size("stays")).otherwise(0).cast("long"),
    }
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return both.select(*[made.get(c, F.col("carried")[c]).alias(c) for c in order])
