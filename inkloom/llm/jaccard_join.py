"""Exact n-gram Jaccard join in a metric space of shingle sets.

Between sets, 1 - Jaccard is a metric, but unrelated texts are all at distance 1 from any
pivot, so pivots alone cannot part a corpus. Regions are therefore seeded by shingles that
linked sets are bound to share:

1. The first shingles of each set in the order of their hashes (enough of them that two
   linked sets share a known number) go to shards, which list the sets of each shingle.
2. A shingle of at most COMMON sets gives pairs; those that share too few of the listed
   shingles cannot be linked and are dropped. Pairs form regions around the smallest set
   of their neighbourhood.
3. A shingle of more sets seeds regions of its own, by size of the sets, around the set
   with the largest share of such shingles. Only sets with enough of them can have links
   that step 2 cannot see.
4. In a region, pivots create Voronoi cells. A set goes to the cell of its nearest pivot and,
   by the triangle inequality, to each cell whose pivot is no further than that plus the
   radius; cells are joined recursively, until one is small or splits no more. There, every
   pair is compared that is not yet connected and that no distance to a pivot rules out. Before that, a
   region is thinned: what two sets share is at most what each has of the region's frequent shingles, and some of the
   rare ones. Pairs that the frequent ones alone cannot link are found by the lists of the rare ones; only sets that the
   frequent ones can link with another go on. So versions of one text that are too far apart meet no more.
   A region of more than REGION_SHINGLES shingles is first cut into cells by many tasks, level
   by level. What is connected with a cell's pivot needs no comparison with one another; a cell
   that stays large is compared in blocks, the sets that are not so connected against all.
5. Connected regions are merged into components by alternating large and small stars.

Exact copies of a set are one set until the last step. Sets are told apart by 64-bit hashes
of their shingles' 64-bit hashes.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.llm.common import LOWER, UPPER, WordHashes, documents, materialize, mixed, of_worker, rolling, shards, shards_for, with_row_hash, words_of

WORDS = 5
#: A link: 100 * intersection >= SIMILARITY * union. Distances below are 1 - Jaccard.
SIMILARITY = 80
RADIUS = 1 - SIMILARITY / 100
#: Sets of a shingle up to which its pairs are looked at one by one.
COMMON = 32
BLOCK_SHINGLES = 1 << 21
PAIR_ROWS = 100_000
#: Shingles of all sets of a region that one task joins; larger regions are cut up first.
REGION_SHINGLES = 1 << 21
#: Sets up to which a cell is joined pair by pair, and pivots at most; a cell has as many as the root of its size.
CELL = 4
PIVOTS = 8
#: Sets from which a region is thinned by the frequencies of its shingles, and pairs of sets for each of its shingles then.
THIN = 2 * COMMON
RARE_PAIRS = 4
TO_LOWER = str.maketrans(UPPER, LOWER)

SKETCH = "kind int, shard int, doc_id bigint, row_hash bigint, n int, set_id bigint, shingles binary, sets binary, ns binary, edges binary, per_set binary"
CUT = "kind int, a bigint, b bigint, n int, region bigint, cell int, total bigint, linked boolean"
LISTED = "shingle bigint, sets array<bigint>, ns array<int>, early array<boolean>, weight bigint"


# -- sets and their first shingles ---------------------------------------------------


def shingle_set(text: str, cache: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence where there are fewer words."""
    h = cache.of(words_of(text.translate(TO_LOWER)))
    return np.unique(rolling(h, min(WORDS, len(h)))) if len(h) else h


def early(n):
    """Shingles from the front of which two linked sets share at least one. Works on ints, arrays and Columns."""
    return n - needed(n) + 1


def needed(n):
    """The least intersection that a link leaves a set of n shingles."""
    return ((SIMILARITY * n + 99) / 100).cast("int") if isinstance(n, Column) else (SIMILARITY * n + 99) // 100


def linkable(both, na, nb):
    """Whether sets of na and nb shingles link that share so many. Works on ints, arrays and Columns."""
    return (100 + SIMILARITY) * both >= SIMILARITY * (na + nb)


def listed(n: int) -> int:
    """Shingles of a set that are listed: `shared` more than one of them are in a linked set's list too."""
    return min(n, early(n) + n // 10 + 1)


def shared(n: int) -> int:
    """Two linked sets have at least the smaller of their two values in common among their listed shingles."""
    return listed(n) - early(n) + 1


def sketching(n_shards: int):
    def flush(sets: dict[int, tuple[int, np.ndarray]]) -> pd.DataFrame:
        ids = np.array(list(sets), np.int64)
        ns = np.array([s[0] for s in sets.values()], np.int32)
        edges = np.array([s[1][early(s[0]) - 1] for s in sets.values()], np.uint64)
        counts = [len(s[1]) for s in sets.values()]
        shingles = np.concatenate([s[1] for s in sets.values()])
        owner = np.repeat(np.arange(len(ids)), counts)
        shard = (mixed(shingles) % np.uint64(n_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        rows = []
        for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
            at = order[lo:hi]
            who = owner[at]
            first = np.flatnonzero(np.diff(who, prepend=-1))
            rows.append((1, int(shard[at[0]]), 0, 0, 0, 0, shingles[at].tobytes(), ids[who[first]].tobytes(), ns[who[first]].tobytes(), edges[who[first]].tobytes(), np.diff(np.append(first, len(at))).astype(np.uint32).tobytes()))
        return pd.DataFrame(rows, columns=["kind", "shard", "doc_id", "row_hash", "n", "set_id", "shingles", "sets", "ns", "edges", "per_set"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, held, size = of_worker("words", WordHashes), {}, 0
        for batch in batches:
            docs = []
            for doc_id, row_hash, text in zip(batch["doc_id"], batch["row_hash"], batch["text"], strict=True):
                s = shingle_set(text, cache)
                set_id = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0
                docs.append((0, -1, doc_id, row_hash, len(s), set_id, None, None, None, None, None))
                if len(s) and set_id not in held:
                    held[set_id] = (len(s), s[: listed(len(s))])
                    size += listed(len(s))
                if size >= BLOCK_SHINGLES:
                    yield flush(held)
                    held, size = {}, 0
            yield pd.DataFrame(docs, columns=["kind", "shard", "doc_id", "row_hash", "n", "set_id", "shingles", "sets", "ns", "edges", "per_set"])
        if held:
            yield flush(held)

    return run


# -- the sets of each shingle ----------------------------------------------------------


def lists_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each shard: equal lists of sets once, with the number of shingles that have them (shingle 0), and
    the shingles of more than COMMON sets, in parts."""
    by_shard: dict[int, list] = {}
    for batch in batches:
        for shard, *row in batch[["shard", "shingles", "sets", "ns", "edges", "per_set"]].itertuples(index=False):
            by_shard.setdefault(shard, []).append(row)
    for shard in list(by_shard):
        rows = by_shard.pop(shard)
        shingles = np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows])
        per_set = [np.frombuffer(r[4], np.uint32) for r in rows]
        sets = np.concatenate([np.repeat(np.frombuffer(r[1], np.int64), k) for r, k in zip(rows, per_set, strict=True)])
        ns = np.concatenate([np.repeat(np.frombuffer(r[2], np.int32), k) for r, k in zip(rows, per_set, strict=True)])
        front = shingles <= np.concatenate([np.repeat(np.frombuffer(r[3], np.uint64), k) for r, k in zip(rows, per_set, strict=True)])
        order = np.argsort(shingles, kind="stable")
        shingles, sets, ns, front = shingles[order], sets[order], ns[order], front[order]
        edges = np.flatnonzero(np.diff(shingles, prepend=~shingles[:1]) != 0)
        sizes = np.diff(np.append(edges, len(shingles)))
        lists: dict[bytes, list] = {}
        out = []
        for lo, n in zip(edges[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            own, at = np.unique(sets[lo : lo + n], return_index=True)
            if len(own) < 2:
                continue
            if len(own) <= COMMON:
                known = lists.get(own.tobytes())
                if known:
                    known[1] += 1
                else:
                    lists[own.tobytes()] = [ns[lo : lo + n][at], 1]
                continue
            shingle = int(shingles[lo].astype(np.int64))
            own_ns, own_front = ns[lo : lo + n][at], front[lo : lo + n][at]
            for a in range(0, len(own), 4096):
                out.append((shingle, own[a : a + 4096], own_ns[a : a + 4096], own_front[a : a + 4096], 0))
        for sets_, (ns_, weight) in lists.items():
            out.append((0, np.frombuffer(sets_, np.int64), ns_, None, weight))
        for a in range(0, len(out), 5000):
            yield pd.DataFrame(out[a : a + 5000], columns=["shingle", "sets", "ns", "early", "weight"])


def pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of each list that their sizes allow a link, some PAIR_ROWS at a time."""
    made: list[tuple] = []
    rows = 0
    hand_on = lambda: pd.DataFrame(dict(zip(("a", "b", "na", "nb", "w"), map(np.concatenate, zip(*made, strict=True)), strict=True)))
    for batch in batches:
        for sets, ns, weight in zip(batch["sets"], batch["ns"], batch["weight"], strict=True):
            sets, ns = np.asarray(sets), np.asarray(ns, np.int64)
            i, j = np.triu_indices(len(sets), 1)
            fits = 100 * np.minimum(ns[i], ns[j]) >= SIMILARITY * np.maximum(ns[i], ns[j])
            i, j = i[fits], j[fits]
            made.append((sets[i], sets[j], ns[i], ns[j], np.full(len(i), weight)))
            rows += len(i)
            if rows >= PAIR_ROWS:
                yield hand_on()
                made, rows = [], 0
    if made:
        yield hand_on()


def shared_column(n: Column) -> Column:
    e = early(n)
    return F.least(n, e + (n / 10).cast("int") + 1) - e + 1


# -- within a region ---------------------------------------------------------------------


class Region:
    def __init__(self, sets: list[np.ndarray], linked: np.ndarray | None = None):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.n)))
        distinct, self.at = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(distinct), np.int32)
        self.common = self.n  # shingles of each set by which compare() has to find its links
        self.label = np.arange(len(sets))
        if linked is not None and linked.any():
            self.label[linked] = linked.argmax()
        self.links: list[tuple[int, int]] = []

    def distances(self, pivot: int, others: np.ndarray) -> np.ndarray:
        """Of each other set from pivot; those within RADIUS are connected with it."""
        own = self.at[self.start[pivot] : self.start[pivot + 1]]
        self.mark[own] = 1
        n = self.n[others]
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        where = np.arange(n.sum()) + np.repeat(self.start[others] - first, n)
        both = np.add.reduceat(self.mark[self.at[where]], first).astype(np.int64)
        self.mark[own] = 0
        union = n + self.n[pivot] - both
        for x in others[100 * both >= SIMILARITY * union].tolist():
            if self.label[x] != self.label[pivot]:
                self.links.append((pivot, x))
                self.label[self.label == self.label[x]] = self.label[pivot]
        return 1 - both / union

    def thin(self) -> np.ndarray:
        """Connects the pairs that cannot be linked by frequent shingles alone, and gives the sets that can, those with the
        largest share of them first. What counts as frequent bounds the pairs; it has no effect on the links."""
        times = np.bincount(self.at)
        each = np.bincount(times[times <= COMMON], minlength=COMMON + 1) * (np.arange(COMMON + 1) * np.arange(-1, COMMON) // 2)
        most = max(1, int(np.searchsorted(np.cumsum(each), RARE_PAIRS * len(self.at), side="right")) - 1)
        self.common = np.add.reduceat((times > most)[self.at].astype(np.int64), self.start[:-1])
        rare = (times[self.at] > 1) & (times[self.at] <= most)
        shingle, owner = self.at[rare], np.repeat(np.arange(len(self.n)), self.n)[rare]
        order = np.argsort(shingle, kind="stable")
        owner, size = owner[order], times[shingle[order]]
        pairs = [np.zeros(0, np.int64)]
        for k in range(2, most + 1):
            lists = owner[size == k].reshape(-1, k)
            i, j = np.triu_indices(k, 1)
            pairs.append((lists[:, i] * len(self.n) + lists[:, j]).ravel())
        pairs, weight = np.unique(np.concatenate(pairs), return_counts=True)
        a, b = np.divmod(pairs, len(self.n))
        least = np.minimum(self.common[a], self.common[b])
        ask = ~linkable(least, self.n[a], self.n[b]) & linkable(least + weight, self.n[a], self.n[b])
        a, b = a[ask], b[ask]
        edges = np.flatnonzero(np.diff(a, prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(a)), strict=False):  # no edges, no pairs
            others = b[lo:hi][self.label[b[lo:hi]] != self.label[a[lo]]]
            if len(others):
                self.distances(a[lo], others)
        left = np.flatnonzero(linkable(self.common, self.n, np.maximum(needed(self.n), self.n.min())))
        return left[np.argsort(-self.common[left] / self.n[left], kind="stable")]

    def join(self, members: np.ndarray) -> None:
        """Connects all members that a chain of links connects; pairs by Voronoi cells."""
        if len(members) <= CELL:
            return self.compare(members)
        _, head = np.unique(self.label[members], return_index=True)
        pivots = members[np.sort(head)[: min(PIVOTS, math.isqrt(len(members)))]]
        d = np.ones((len(pivots), len(members)))
        for k, p in enumerate(pivots):
            rest = members != p
            d[k, rest] = self.distances(p, members[rest])
            d[k, ~rest] = 0
        left = ~np.isin(members, pivots)
        members, d = members[left], d[:, left]
        if len(np.unique(self.label[members])) < 2:
            return None
        near = d.min(0)
        cells = [members[(d[k] <= near + RADIUS + 1e-9) & (d[k] < 1)] for k in range(len(pivots))]
        cells.append(members[near >= 1 - RADIUS - 1e-9])
        cells = [cell for cell in cells if len(cell) > 1 and len(np.unique(self.label[cell])) > 1]
        sizes = np.array([len(cell) for cell in cells])
        if (sizes >= 0.8 * len(members)).any() or (sizes**2).sum() >= len(members) ** 2:
            return self.compare(members)  # cells that overlap so much have more pairs than there are
        for cell in cells:
            self.join(cell)
        return None

    def compare(self, members: np.ndarray) -> None:
        """Every pair of sets that are not connected, unless sizes or a distance rule it out. Sets of
        the largest connected part come last as pivots: they need none when the others have been one."""
        open_ = np.ones(len(members), bool)
        known: list[np.ndarray] = []
        while True:
            labels = self.label[members]
            values, counts = np.unique(labels, return_counts=True)
            if len(values) < 2:
                return
            todo = np.flatnonzero(open_ & (labels != values[counts.argmax()]))
            if not len(todo):
                return
            p = int(todo[0])
            open_[p] = False
            common = self.common[members]
            ask = (labels != labels[p]) & linkable(np.minimum(common, common[p]), self.n[members], self.n[members[p]])
            ask[p] = False
            for d in known:
                with np.errstate(invalid="ignore"):
                    ask &= ~(np.abs(d - d[p]) > RADIUS + 1e-9)
            if not ask.any():
                continue
            d = np.full(len(members), np.nan)
            d[ask] = self.distances(members[p], members[ask])
            d[p] = 0
            if len(known) < PIVOTS:
                known.append(d)


def region_links(sets: list[np.ndarray], linked: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links that connect what the links among these sets connect, but for the sets that are linked
    with one another from the start; the first set is the first pivot."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * both >= SIMILARITY * (len(sets[0]) + len(sets[1]) - both) else []
    region = Region(sets, None if linked is None else np.array(linked, bool))
    members = region.thin() if len(sets) > THIN else np.arange(len(sets))
    if len(members):
        region.join(members)
    return region.links


def joining(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by region, the pivot first; one region is held at a time."""
    cache = of_worker("words", WordHashes)
    region, ids, sets, linked = None, [], [], []

    def finish() -> pd.DataFrame:
        links = region_links(sets, linked) if len(sets) > 1 else []
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype="int64")

    for batch in batches:
        for r, set_id, known, text in zip(batch["region"], batch["set_id"], batch["linked"], batch["text"], strict=True):
            if r != region:
                yield finish()
                region, ids, sets, linked = r, [], [], []
            ids.append(set_id)
            linked.append(known)
            sets.append(shingle_set(text, cache))
    yield finish()


# -- regions that are too large for one task ----------------------------------------------


def spreading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each shingle of region, set_id, text."""
    cache = of_worker("words", WordHashes)
    for batch in batches:
        for at in range(0, len(batch), 64):
            part = batch.iloc[at : at + 64]
            sets = [shingle_set(text, cache) for text in part["text"]]
            n = np.array([len(own) for own in sets], np.int64)
            columns = {c: np.repeat(part[c].to_numpy(np.int64), n) for c in ("region", "set_id")}
            yield pd.DataFrame({**columns, "n": np.repeat(n, n), "shingle": np.concatenate(sets).view(np.int64)})


def thinned(big: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What thin() does, of regions of any size: regions of the sets that frequent shingles can link, and regions of two."""
    members = big.select("region", "set_id").join(texts.hint("merge"), "set_id").select("region", "set_id", "text")
    times = F.count("*").over(Window.partitionBy("region", "shingle")).alias("times")
    spread = members.mapInPandas(spreading, "region bigint, set_id bigint, n int, shingle bigint").select("*", times).filter("times > 1")
    spread = materialize(spread, "spread")
    held = spread.groupBy("region", "set_id", "n").agg(F.sum(F.when(F.col("times") > COMMON, 1).otherwise(0)).alias("common"))
    held = materialize(held, "held")
    least = held.groupBy("region").agg(F.min("n").alias("least"))
    partner = F.greatest(needed(F.col("n")), F.col("least"))
    core = held.join(least, "region").filter(linkable(F.col("common"), F.col("n"), partner)).select("region", "set_id")
    core = big.join(core, ["region", "set_id"]).select("region", "set_id", "n", "first", "linked")

    rare = spread.filter(F.col("times") <= COMMON).select("region", "shingle", "set_id").join(held, ["region", "set_id"])
    one, two = (rare.select("region", "shingle", F.col("set_id").alias(x), F.col("n").alias(f"n{x}"), F.col("common").alias(f"c{x}")) for x in "ab")
    na, nb, both = F.col("na"), F.col("nb"), F.least("ca", "cb")
    pairs = one.join(two, ["region", "shingle"]).filter("a < b").filter(linkable(F.least(na, nb), na, nb) & ~linkable(both, na, nb))
    pairs = pairs.groupBy("region", "a", "b", "na", "nb", "ca", "cb").agg(F.count("*").alias("weight")).filter(linkable(both + F.col("weight"), na, nb))
    ends = F.array(*[F.struct(F.col(x).alias("set_id"), F.col(f"n{x}").alias("n")) for x in "ab"])
    pairs = pairs.select(F.xxhash64("region", "a", "b").alias("region"), F.explode(ends).alias("s"))
    pairs = pairs.select("region", "s.set_id", "s.n", F.lit(False).alias("first"), F.lit(False).alias("linked"))
    return core, materialize(pairs, "rare-pairs")


class Pivots:
    """At most eight sets, and the distances of other sets from each of them."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.n = ids, np.array([len(s) for s in sets], np.int64)
        self.shingles, at = np.unique(np.concatenate(sets), return_inverse=True)
        self.bits = np.zeros((len(self.shingles), len(sets)), np.int32)
        self.bits[at, np.repeat(np.arange(len(sets)), self.n)] = 1

    def compare(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances, and which of them are links."""
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        both = self.bits[at[self.shingles[at] == own]].sum(0).astype(np.int64)
        union = self.n + len(own) - both
        return 1 - both / union, 100 * both >= SIMILARITY * union


def cutting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by region and salt, the pivots first; only the pivots are held. Gives links with
    pivots (kind 0: a, b) and the cells of each other set (kind 1: a, n, region, cell, total, linked)."""
    cache = of_worker("words", WordHashes)
    at, ids, sets, pivots = None, [], [], None
    for batch in batches:
        rows = []
        for region, salt, pivot, set_id, total, text in batch[["region", "salt", "pivot", "set_id", "total", "text"]].itertuples(index=False):
            if (region, salt) != at:
                at, ids, sets, pivots = (region, salt), [], [], None
            own = shingle_set(text, cache)
            if pivot:
                if sets and salt == 0:
                    rows += [(0, ids[k], set_id, 0, region, 0, 0, True) for k in np.flatnonzero(Pivots(ids, sets).compare(own)[1])]
                ids.append(set_id)
                sets.append(own)
                continue
            if set_id in ids:
                continue
            pivots = pivots or Pivots(ids, sets)
            d, link = pivots.compare(own)
            rows += [(0, ids[k], set_id, 0, region, 0, 0, True) for k in np.flatnonzero(link)]
            near = d.min()
            cells = np.flatnonzero((d <= near + RADIUS + 1e-9) & (d < 1)).tolist()
            rows += [(1, set_id, 0, len(own), region, k, total, bool(link[k])) for k in cells]
            if near >= 1 - RADIUS - 1e-9:
                rows.append((1, set_id, 0, len(own), region, len(ids), total, False))
        yield pd.DataFrame(rows, columns=["kind", "a", "b", "n", "region", "cell", "total", "linked"])


def sizes(regions: DataFrame) -> DataFrame:
    """region, sets, total and the part of it in sets that are not linked with the region's pivot; added up within each task first."""
    return regions.groupBy("region").agg(F.count("*").alias("sets"), F.sum("n").alias("total"), F.sum(F.when(~F.col("linked"), F.col("n")).otherwise(0)).alias("open"))


def cells_of(big: DataFrame, texts: DataFrame, level: int) -> DataFrame:
    """One level of cells of regions (with their total); members of a region are dealt to tasks, its pivots go to each."""
    salts = F.ceil(F.col("total") / REGION_SHINGLES).cast("int")
    rank = F.struct((~F.col("first")).alias("later"), F.xxhash64("set_id", F.lit(level)).alias("h"), "set_id")
    bucket = F.pmod(F.xxhash64("set_id", F.lit(level), F.lit(1)), F.lit(PIVOTS)).alias("bucket")
    pivots = big.groupBy("region", "total", bucket).agg(F.min(rank).alias("p")).select("region", "total", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(True).alias("pivot"), F.col("p.set_id").alias("set_id"))
    members = big.select("region", "total", F.pmod(F.xxhash64("set_id"), salts).cast("int").alias("salt"), F.lit(False).alias("pivot"), "set_id")
    dealt = pivots.unionByName(members).join(texts.hint("merge"), "set_id")
    # As many tasks as parts: the planner's estimate of joins is the product of their sides, which would deal to thousands.
    tasks = big.select("region", salts.alias("salts")).distinct().agg(F.sum("salts")).first()[0]
    return dealt.repartition(max(shards(big.sparkSession), tasks), "region", "salt").sortWithinPartitions("region", "salt", F.desc("pivot")).mapInPandas(cutting, CUT)


def in_blocks(stuck: DataFrame) -> DataFrame:
    """Regions (with total and open) as regions of two blocks: of the sets not linked with the pivot, and of all sets."""
    half = REGION_SHINGLES / 2
    every, rest = F.ceil(F.col("total") / half).cast("int"), F.ceil(F.col("open") / half).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    carried = ["region", "set_id", "n", "linked"]
    all_sets = stuck.select(*carried, F.pmod(F.xxhash64("set_id"), every).cast("int").alias("j"), each(rest).alias("i"))
    not_linked = stuck.filter("not linked").select(*carried, F.pmod(F.xxhash64("set_id", F.lit(1)), rest).cast("int").alias("i"), each(every).alias("j"))
    return all_sets.unionByName(not_linked).select(F.xxhash64("region", "i", "j").alias("region"), "set_id", "n", F.lit(False).alias("first"), "linked").distinct()


def bounded_regions(regions: DataFrame, texts_of) -> tuple[DataFrame, list[DataFrame]]:
    """Regions (region, set_id, n, first, linked) that a task can hold, and the links found on the way to them.
    texts_of(set ids) gives set_id, text. A level only goes on with cells of less than 0.8 of what they came
    from, so there are few levels."""
    done, links, texts = [], [], None
    while True:
        large = materialize(sizes(regions).filter(F.col("total") > REGION_SHINGLES).select("region", "total", "sets"), "large-regions")
        if large.isEmpty():
            for part in done:
                regions = regions.unionByName(part)
            return regions, links
        done.append(regions.join(large, "region", "left_anti"))
        big = materialize(regions.join(large, "region"), "large")
        if texts is None:
            texts = materialize(texts_of(big.select("set_id").distinct()), "large-texts")
            core, pairs = thinned(big.filter(F.col("sets") > THIN), texts)
            done.append(pairs)
            regions = materialize(core.unionByName(big.filter(F.col("sets") <= THIN).select(core.columns)), "thinned")
            continue
        cut = materialize(cells_of(big, texts, len(links)), "cells")
        links.append(cut.filter("kind = 0").select("a", "b"))
        cells = cut.filter("kind = 1").select(F.xxhash64("region", "cell", F.lit(len(links))).alias("region"), F.col("a").alias("set_id"), "n", F.lit(False).alias("first"), "linked", F.col("total").alias("before"))
        cells = cells.join(sizes(cells).filter("open > 0"), "region")
        cells = materialize(cells.withColumn("stuck", (F.col("total") > REGION_SHINGLES) & (F.col("total") >= 0.8 * F.col("before"))), "sized-cells")
        done.append(in_blocks(cells.filter("stuck")))
        regions = cells.filter("not stuck").select("region", "set_id", "n", "first", "linked")


# -- components ----------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of links (a, b)."""
    down = lambda e: e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges, seen = materialize(down(links), "edges"), None
    while True:
        print_ = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if print_ == seen or not print_["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = print_
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).transform(down), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.transform(down), "small-star")


# -- the join ---------------------------------------------------------------------------------


def candidate_regions(lists: DataFrame) -> DataFrame:
    """region, set_id, n, first (the pivot), linked (false): any two linked sets share a region."""
    many = lists.filter("shingle != 0").select("shingle", F.explode(F.arrays_zip("sets", "ns", "early")).alias("s")).select("shingle", F.col("s.sets").alias("set_id"), F.col("s.ns").alias("n"), F.col("s.early").alias("early"))
    many = materialize(many, "common-shingles")
    held = materialize(many.groupBy("set_id").agg(F.count("*").alias("f"), F.first("n").alias("n")), "common-counts")

    # Pairs of lists, less those that share too few listed shingles even if all their common ones are shared.
    pairs = lists.filter("shingle = 0").groupBy("sets", "ns").agg(F.sum("weight").alias("weight"))
    pairs = pairs.mapInPandas(pairs_of, "a bigint, b bigint, na int, nb int, w bigint")
    pairs = pairs.groupBy("a", "b").agg(F.sum("w").alias("w"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    least = F.least(shared_column(F.col("na")), shared_column(F.col("nb")))
    f = held.select("set_id", "f")
    pairs = pairs.join(f.withColumnsRenamed({"set_id": "a", "f": "fa"}), "a", "left").join(f.withColumnsRenamed({"set_id": "b", "f": "fb"}), "b", "left")
    pairs = materialize(pairs.filter(F.col("w") + F.least(F.coalesce("fa", F.lit(0)), F.coalesce("fb", F.lit(0))) >= least).select("a", "b", "na", "nb"), "pairs")
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    placed = pairs.join(low.withColumnsRenamed({"m": "ma"}), "a").join(low.withColumnsRenamed({"a": "b", "m": "mb"}), "b")
    ends = F.array(*[F.struct(F.col(x).alias("set_id"), F.col(f"n{x}").alias("n")) for x in "ab"])
    placed = placed.select(F.least("ma", "mb").alias("region"), F.explode(ends).alias("s")).select("region", "s.set_id", "s.n")

    # Sets that may share listed shingles with a linked set which are all common ones.
    n = F.col("n")
    heavy = held.filter(F.col("f") >= F.greatest(F.lit(1), (needed(n) / 10).cast("int") + 1))
    band = F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / SIMILARITY))).cast("int")
    rank = F.struct((-F.col("f") / n).alias("share"), F.xxhash64("set_id").alias("h"), F.col("set_id").alias("id"))
    # The first common shingle of two linked sets is among the early ones of both.
    seeds = many.filter("early").select("shingle", "set_id").join(heavy.select("set_id", "n", rank.alias("rank"), band.alias("band")), "set_id")
    pivots = seeds.groupBy("shingle", "band").agg(F.min("rank").alias("pivot"), F.count("*").alias("k")).select("shingle", "band", F.col("pivot.id").alias("region"))
    # Linked sets are of one band or of two next to each other: the lower one's region holds both.
    spread = seeds.select("shingle", "set_id", "n", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("band"))
    seeded = spread.join(pivots, ["shingle", "band"]).select("region", "set_id", "n")
    every = placed.union(seeded).distinct()
    return every.withColumn("first", F.col("region") == F.col("set_id")).withColumn("linked", F.lit(False))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, row_hash (of the text) for every row of docs (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text's set holds its
    distinct shingles of WORDS words; with fewer words, the whole sequence. Two texts link when
    100 * intersection >= 80 * union. component_id is the smallest doc_id that links reach.
    Null, empty and blank texts have the empty set and link with nothing, not even each other:
    their component_id is their own doc_id. Rows with equal texts are linked, those that repeat a
    doc_id too. An empty table gives an empty result.
    """
    d = with_row_hash(documents(docs))
    n_shards = max(1, shards_for(d) // 2)
    sketch = materialize(d.mapInPandas(sketching(n_shards), SKETCH), "sketch")
    lists = sketch.filter("kind = 1").select("shard", "shingles", "sets", "ns", "edges", "per_set").repartition(n_shards, "shard")
    lists = materialize(lists.mapInPandas(lists_of, LISTED), "lists")
    regions = materialize(candidate_regions(lists), "regions")

    own = sketch.filter("kind = 0").select("doc_id", "row_hash", "n", "set_id")

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = own.filter("n > 0").join(ids, "set_id", "left_semi")
        wanted = wanted.groupBy("set_id").agg(F.min(F.struct("doc_id", "row_hash")).alias("row")).select("set_id", "row.*")
        return d.join(wanted.hint("merge"), ["doc_id", "row_hash"]).select("set_id", "text").dropDuplicates(["set_id"])

    regions, found = bounded_regions(regions, texts_of)
    texts = texts_of(regions.select("set_id").distinct())
    dealt = regions.hint("merge").join(texts.hint("merge"), "set_id").select("region", "first", "linked", "set_id", "text")
    dealt = dealt.repartition(shards_for(d), "region").sortWithinPartitions("region", F.desc("first"), "set_id")
    links = dealt.mapInPandas(joining, "a bigint, b bigint")
    for more in found:
        links = links.unionByName(more)
    # Each set goes by its smallest doc_id from here on, so the smallest node of a component is what its documents get.
    named = materialize(own.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least")), "sets")
    for end in "ab":
        links = links.join(named.withColumnsRenamed({"set_id": end, "least": f"least_{end}"}), end)
    root = components(links.select(F.col("least_a").alias("a"), F.col("least_b").alias("b")))
    component = named.join(root.withColumnRenamed("node", "least"), "least", "left").select("set_id", F.coalesce("root", "least").alias("component_id"))
    with_words = own.filter("n > 0").join(component.hint("merge"), "set_id").select("doc_id", "n", "component_id", "row_hash")
    every = with_words.unionByName(own.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), "row_hash"))
    return every.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "row_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without near-duplicates: of each component one row stays, of the smallest doc_id, and of its rows the
    one whose text has the smallest hash. Texts without words are all kept, each of a doc_id once. Null ids go."""
    found = jaccard_components(docs)
    wordless = F.when(F.col("n_shingles") == 0, F.col("row_hash"))
    keep = found.filter("doc_id = component_id").groupBy("component_id", wordless.alias("wordless")).agg(F.min("row_hash").alias("row_hash"))
    d = docs.filter(docs["doc_id"].isNotNull())
    d = d.select(F.struct(*[d[c] for c in d.columns]).alias("carried"), d["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(d["text"].cast("string"), F.lit(""))).alias("row_hash"))
    keep = keep.select(F.col("component_id").alias("doc_id"), "row_hash")
    return d.join(keep.hint("merge"), ["doc_id", "row_hash"], "left_semi").dropDuplicates(["doc_id", "row_hash"]).select("carried.*")
