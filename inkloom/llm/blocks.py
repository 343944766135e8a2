"""Where else does a hash occur? Asked by blocks of documents, answered by shards of hashes.

A task gathers documents into a block, settles in the block what it can, and asks the
shards only once for each hash that is left: a hash that a third of all documents hold
costs an entry a block, not an entry a document. A shard sees all blocks that ask for a
hash and answers those for which it counts; the block's own row turns the answers into
places in its documents. Entries travel as packed arrays.

A hash counts as found elsewhere
* by the rule "earlier": when a document with a smaller doc_id holds it;
* by the rule "again": when it occurs a second time anywhere, the same document included.

The shard is taken from further bits, independent of the 64 that are compared, so the
bits that tell two texts apart grow with the number of shards. Blocks are numbered by
partition and order in it: the input should be a stored table, which is read alike again
when a lost task is repeated.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from inkloom.llm.common import mixed, runs_of, shards_for

BLOCK_ENTRIES = 1 << 20


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs; the first byte says how many."""
    for size in (1, 2, 4):
        if not len(values) or values.max() < 1 << (8 * size):
            return bytes([size]) + values.astype(f"<u{size}").tobytes()
    return b"\x08" + values.astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


ASKED = "shard int, block bigint, hashes binary, gaps binary, ids binary, per_id binary, local binary"
ANSWERED = "block bigint, hits binary, gaps binary, ids binary, per_id binary, local binary"
FOUND = "doc_id bigint, row_hash bigint, starts array<int>, counts array<int>"


class Block:
    def __init__(self, n_shards: int, rule: str):
        self.n_shards, self.rule, self.entries, self.docs = n_shards, rule, 0, []

    def add(self, doc_id: int, row_hash: int, hashes: np.ndarray, deal: np.ndarray) -> None:
        """deal: what the shard is taken from, one for each hash."""
        if len(hashes):
            self.docs.append((doc_id, row_hash, hashes, deal))
            self.entries += len(hashes)

    def rows(self, number: int) -> pd.DataFrame:
        docs = sorted(self.docs, key=lambda d: d[:2])
        ids, row_hashes = np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int64)
        starts = np.concatenate(([0], np.cumsum([len(d[2]) for d in docs]))).astype(np.int64)
        hashes = np.concatenate([d[2] for d in docs])
        shard = (np.concatenate([d[3] for d in docs]) % np.uint64(self.n_shards)).astype(np.int32)
        owner = np.repeat(ids, np.diff(starts))
        order = np.argsort(hashes, kind="stable")
        heads = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0)
        sizes = np.diff(np.append(heads, len(order)))
        local = np.zeros(len(hashes), bool)
        if self.rule == "earlier":
            local[order] = owner[order] > np.repeat(owner[order[heads]], sizes)
            asked = np.flatnonzero(~local)
        else:
            local[order] = np.repeat(sizes > 1, sizes)
            asked = np.sort(order[heads])
        out = [(number % self.n_shards, number, None, starts.tobytes(), ids.tobytes(), row_hashes.tobytes(), np.packbits(local).tobytes())]
        asked = asked[np.argsort(shard[asked], kind="stable")]
        cuts = np.flatnonzero(np.diff(shard[asked], prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(asked)], strict=True):
            at = asked[lo:hi]
            who = owner[at]
            first = np.flatnonzero(np.diff(who, prepend=who[0] - 1))
            out.append((int(shard[at[0]]), number, hashes[at].tobytes(), packed(np.diff(at, prepend=0)), who[0].tobytes() + packed(np.diff(who[first], prepend=who[0])), packed(np.diff(np.append(first, len(at)))), None))
        return pd.DataFrame(out, columns=["shard", "block", "hashes", "gaps", "ids", "per_id", "local"])


def asking(hashes_of: Callable, n_shards: int, rule: str, entries: int) -> Callable:
    """hashes_of() -> a function from a text to its hashes and what deals them to shards."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, block, of = TaskContext.get().partitionId() << 24, Block(n_shards, rule), hashes_of()
        for batch in batches:
            for doc_id, row_hash, text in zip(batch["doc_id"], batch["row_hash"], batch["text"], strict=True):
                block.add(doc_id, row_hash, *of(text))
                if block.entries >= entries:
                    yield block.rows(number)
                    number, block = number + 1, Block(n_shards, rule)
        if block.docs:
            yield block.rows(number)

    return run


def settle(asked: list[tuple], rule: str) -> Iterator[tuple[int, np.ndarray]]:
    """For one shard: (block, places in it that are found elsewhere)."""
    hashes = np.concatenate([np.frombuffer(a[1], np.uint64) for a in asked])
    sizes = [len(a[1]) // 8 for a in asked]
    order = np.argsort(hashes, kind="stable")
    heads = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0)
    widths = np.diff(np.append(heads, len(order)))
    hit = np.zeros(len(hashes), bool)
    if rule == "earlier":
        owner = np.concatenate([np.repeat(np.frombuffer(a[3][:8], np.int64) + np.cumsum(unpacked(a[3][8:])), unpacked(a[4])) for a in asked])
        hit[order] = owner[order] > np.repeat(np.minimum.reduceat(owner[order], heads), widths)
    else:
        hit[order] = np.repeat(widths > 1, widths)
    at = 0
    for a, n in zip(asked, sizes, strict=True):
        mine = hit[at : at + n]
        if mine.any():
            yield a[0], np.cumsum(unpacked(a[2]))[mine].astype(np.uint32)
        at += n


def answering(rule: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_shard: dict[int, list] = {}
        for batch in batches:
            own = batch["hashes"].isna()
            if own.any():
                yield batch.loc[own, ["block", "gaps", "ids", "per_id", "local"]].assign(hits=None)
            for shard, *row in batch.loc[~own, ["shard", "block", "hashes", "gaps", "ids", "per_id"]].itertuples(index=False):
                by_shard.setdefault(shard, []).append(row)
        for shard in list(by_shard):
            for block, hits in settle(by_shard.pop(shard), rule):
                yield pd.DataFrame({"block": [block], "hits": [hits.tobytes()], "gaps": None, "ids": None, "per_id": None, "local": None})

    return run


def gathering(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables: dict[int, tuple] = {}
    hits: dict[int, list] = {}
    for batch in batches:
        for block, hit, *table in batch[["block", "hits", "gaps", "ids", "per_id", "local"]].itertuples(index=False):
            if hit is None:
                tables[block] = table
            else:
                hits.setdefault(block, []).append(np.frombuffer(hit, np.uint32))
    for block in list(tables):
        gaps, ids, row_hashes, local = tables.pop(block)
        starts = np.frombuffer(gaps, np.int64)
        flags = np.unpackbits(np.frombuffer(local, np.uint8), count=int(starts[-1])).astype(bool)
        for h in hits.pop(block, []):
            flags[h] = True
        out = []
        for doc_id, row_hash, lo, hi in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(row_hashes, np.int64).tolist(), starts[:-1], starts[1:], strict=True):
            if flags[lo:hi].any():
                first, end = runs_of(flags[lo:hi])
                out.append((doc_id, row_hash, first.astype(np.int32), (end - first).astype(np.int32)))
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "row_hash", "starts", "counts"])


def found_elsewhere(docs: DataFrame, hashes_of: Callable, rule: str, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """For each row of docs (doc_id, row_hash, text) with any: runs of its hashes that are found elsewhere."""
    n = shards_for(docs)
    asked = docs.select("doc_id", "row_hash", "text").mapInPandas(asking(hashes_of, n, rule, entries), ASKED)
    answered = asked.repartition(n, "shard").mapInPandas(answering(rule), ANSWERED)
    return answered.repartition(n, "block").mapInPandas(gathering, FOUND).dropDuplicates(["doc_id", "row_hash"])


def deal_of(hashes: np.ndarray) -> np.ndarray:
    """Bits for the choice of a shard, where only one hash is at hand."""
    return mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(7)
